"""Language-model scoring with an n-gram trie in Elias-Fano levels.

The trie is cut by the hash of the first word into shards, one file each. Level 1 has the words'
hashes and exact counts. Level k + 1 has, for every entry of level k in turn, its successors in
ascending order: an Elias-Fano sequence of pointers says where those of an entry begin, and a second
one holds the successors relative to their context, made monotone by the context's number. An entry
keeps its smoothed probability, and its weight as a context, as 8-bit codes of a table. Tasks map the
files into memory and find a successor by its number relative to the context.

Counts cover all training text. Higher orders keep n-grams that occur at least ``min_count`` times,
with ``ALL`` every one; what the others have is left to the shorter context, so every distribution
adds up to one. The number of shards grows with the text, which bounds what a task holds.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, batch, mapped, mix64, slices, utf8, write_once
from ledgerlens.session import materialise, scratch_path

ORDER = 3
MIN_COUNT = 2
ALL = 1  # the ``min_count`` that keeps every n-gram
DISCOUNT = 0.75
SLICE_BYTES = 8 << 20
BLOCK_BYTES = 128 << 10
HELD_NGRAMS = 1_500_000
# Text bytes of a shard: no level of it has more n-grams than half of that, but for skew.
SHARD_BYTES = 8 << 20
CHUNK = 1 << 18
CODES = 256

END = np.uint64(1)  # stands for the end of a text; no word hashes to it
BLOBS = "part int, grams binary, counts binary"
_BLOBS = pa.schema([("part", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])


def _low_type(bits: int) -> str:
    return next(f"<u{n}" for n in (1, 2, 4, 8) if bits <= 8 * n)


class EliasFano:
    """A non-decreasing sequence: low bits in the smallest whole number type, high bits in unary with a directory.

    The low bits are as many as leave one or two values to an upper part, so a search there is a few steps.
    """

    def __init__(self, n, low_bits, low, high, ranks):
        self.n, self.low_bits, self.low, self.high, self.ranks = n, low_bits, low, high, ranks
        self.zeros = None

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = min(63, max(0, (top // max(n, 1)).bit_length() - 1))
        low = (values & np.uint64((1 << low_bits) - 1)).astype(_low_type(low_bits)) if low_bits else np.zeros(0, np.uint8)
        upper = (values >> np.uint64(low_bits)).astype(np.int64)
        size = int(upper[-1]) + n + 1 if n else 1
        bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        bits[upper + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype("<u4")
        return cls(n, low_bits, low, words, ranks)

    def get(self, index: np.ndarray) -> np.ndarray:
        """Values at positions: the place of the set bit in the high part, then the low part."""
        index = np.asarray(index, dtype=np.int64)
        word = np.searchsorted(self.ranks, index, side="right") - 1
        place = _select(self.high[word], index - self.ranks[word])
        return (word * 64 + place - index).astype(np.uint64) << np.uint64(self.low_bits) | self._lows(index)

    def _lows(self, index: np.ndarray) -> np.ndarray:
        return self.low[index].astype(np.uint64) if self.low_bits else np.zeros(len(index), dtype=np.uint64)

    def _zero(self, number: np.ndarray) -> np.ndarray:
        """Place of the zero with that number in the high part: where the values of an upper part end."""
        if self.zeros is None:
            self.zeros = 64 * np.arange(len(self.ranks), dtype=np.int64) - self.ranks
        word = np.searchsorted(self.zeros, number, side="right") - 1
        return word * 64 + _select(~self.high[word], number - self.zeros[word])

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, -1 where it is missing: the successor search stays among those
        that share its upper part and compares the low parts alone."""
        out = np.full(len(values), -1)
        if not self.n:
            return out
        upper = (values >> np.uint64(self.low_bits)).astype(np.int64)
        rows = np.flatnonzero(upper < 64 * len(self.high) - self.n)
        upper = upper[rows]
        low = np.where(upper > 0, self._zero(np.maximum(upper - 1, 0)) - upper + 1, 0)
        stop = self._zero(upper) - upper
        wanted = values[rows] & np.uint64((1 << self.low_bits) - 1)
        high, left = stop.copy(), np.flatnonzero(low < stop)
        while len(left):
            middle = (low[left] + high[left]) >> 1
            less = self._lows(middle) < wanted[left]
            low[left] = np.where(less, middle + 1, low[left])
            high[left] = np.where(less, high[left], middle)
            left = left[low[left] < high[left]]
        inside = np.flatnonzero(low < stop)
        hit = inside[self._lows(low[inside]) == wanted[inside]]
        out[rows[hit]] = low[hit]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<QQQ", self.n, self.low_bits, len(self.high))
        pad = b"\0" * (-self.low.nbytes % 8)
        more = b"\0" * (-4 * len(self.ranks) % 8)
        return head + self.low.tobytes() + pad + self.high.tobytes() + self.ranks.tobytes() + more

    @classmethod
    def from_buffer(cls, data, at: int) -> tuple[EliasFano, int]:
        n, low_bits, words = struct.unpack_from("<QQQ", data, at)
        at += 24
        low = np.frombuffer(data, _low_type(low_bits), n if low_bits else 0, at)
        at += -(-low.nbytes // 8) * 8
        high = np.frombuffer(data, "<u8", words, at)
        at += 8 * words
        ranks = np.frombuffer(data, "<u4", words + 1, at)
        return cls(n, low_bits, low, high, ranks), at + -(-4 * len(ranks) // 8) * 8


_BYTES = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)
_PLACE = np.zeros((256, 8), dtype=np.uint8)
for _byte in range(256):
    for _rank, _bit in enumerate([b for b in range(8) if _byte >> b & 1]):
        _PLACE[_byte, _rank] = _bit


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit with ``rank`` (from 0) in each 64-bit word."""
    rank = rank.astype(np.uint64)
    twos = words - (words >> np.uint64(1) & np.uint64(0x5555555555555555))
    fours = (twos & np.uint64(0x3333333333333333)) + (twos >> np.uint64(2) & np.uint64(0x3333333333333333))
    # Each byte: the set bits up to it.
    upto = (fours + (fours >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _BYTES
    # Eight times the number of bytes that end before the wanted bit.
    shift = ((((rank * _BYTES | _TOPS) - upto & _TOPS) >> np.uint64(7)) * _BYTES >> np.uint64(56)) << np.uint64(3)
    rest = rank - (upto << np.uint64(8) >> shift & np.uint64(255))
    return shift.astype(np.int64) + _PLACE[words >> shift & np.uint64(255), rest]


_MIX = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
# A 64-bit number for every byte value, mixed with the byte's place in its word.
_BYTE_HASH = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MIX)
# The same for the first places of a word: few words are longer.
PLACES = 64
_PLACED = mix64(_BYTE_HASH + np.arange(PLACES, dtype=np.uint64)[:, None] * _MIX).ravel()


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words, then one end, text by text) and each text's number of tokens.

    A word's hash is the mixed sum, over its bytes, of a mix of the byte and its place.
    """
    stops = np.cumsum([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), dtype=np.uint8)
    inside = np.concatenate([[False], _IS_WORD[data], [False]]).view(np.int8)
    edges = np.diff(inside)
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    text = np.searchsorted(stops, first, side="right")
    sizes = np.bincount(text, minlength=len(texts)) + 1
    out = np.full(len(first) + len(texts), END, dtype=np.uint64)
    lengths = last - first
    upto = np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < len(first):
        # Whole words of about BLOCK_BYTES, which stay in the processor's cache.
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + BLOCK_BYTES)) - 1)
        starts = upto[at:to] - upto[at]
        place = np.arange(upto[to] - upto[at]) - np.repeat(starts, lengths[at:to])
        letters = data[np.repeat(first[at:to], lengths[at:to]) + place]
        if lengths[at:to].max() <= PLACES:
            mixed = _PLACED[place << 8 | letters]
        else:
            mixed = mix64(_BYTE_HASH[letters] + place.astype(np.uint64) * _MIX)
        h = mix64(np.add.reduceat(mixed, starts))
        out[np.arange(at, to) + text[at:to]] = np.maximum(h, np.uint64(2))
        at = to
    return out, sizes


def spread(h: np.ndarray) -> np.ndarray:
    """Shard hash: another mix than the words' own, so the end token goes anywhere."""
    return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def _dealt(part: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each shard that has some, in order. Numbers of 16 bits are sorted by radix, far faster."""
    order = np.argsort(part.astype(np.uint16) if shards <= 1 << 16 else part, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=shards))])
    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield p, order[a:b]


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in the smallest type that holds them all."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _wide(data, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, dtype=np.int64)


def _differences(keys: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte: all lowest bytes first, without the bytes no one needs."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_differences(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :data[0]] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


class Counter:
    """Counts of n-grams of a task, given out as blobs for each shard.

    Rows are a word's hash, or the numbers of a context and of the word after it; a number leaves its
    shard when divided by the number of shards. A blob has one key a row: the hash, or the word
    relative to the context's number in its shard, as in a level.
    """

    def __init__(self, width: int, shards: int, span: int):
        self.width, self.shards, self.span, self.held, self.size = width, shards, span, [], 0

    def add(self, grams: np.ndarray) -> None:
        self.held.append(_count(grams, None))
        self.size += len(self.held[-1][1])

    def blobs(self):
        if not self.held:
            return
        grams, counts = _count(np.concatenate([g for g, _ in self.held]), np.concatenate([c for _, c in self.held]))
        self.held, self.size = [], 0
        if not len(grams):
            return
        first = spread(grams[:, 0]) if self.width == 1 else grams[:, 0]
        part = (first % np.uint64(self.shards)).astype(np.int64)
        found = list(_dealt(part, self.shards))
        keys = grams[:, 0]
        if self.width == 2:
            keys = grams[:, 0] // np.uint64(self.shards) * np.uint64(self.span) + grams[:, 1]
        yield batch(_BLOBS, [p for p, _ in found], [_differences(keys[o]) for _, o in found],
                    [_narrow(counts[o]) for _, o in found])


def _count(grams: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in ascending order, with the sums of their counts."""
    if not len(grams):
        return grams, np.zeros(0, dtype=np.int64)
    single = grams[:, 0]
    if grams.shape[1] == 2:
        # Both numbers in one, where they fit: that sorts many times faster.
        base = int(grams[:, 1].max()) + 1
        fits = (int(single.max()) + 1) * base < 2**64
        single = single * np.uint64(base) + grams[:, 1] if fits else None
    if single is not None and counts is None:
        kinds, sums = np.unique(single, return_counts=True)
    elif single is not None:
        order = np.argsort(single)
        single = single[order]
        starts = np.flatnonzero(np.concatenate([[True], single[1:] != single[:-1]]))
        kinds, sums = single[starts], np.add.reduceat(counts[order], starts)
    else:
        order = np.lexsort(grams.T[::-1])
        grams = grams[order]
        starts = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]).any(axis=1)]))
        weights = np.ones(len(grams), dtype=np.int64) if counts is None else counts[order]
        return grams[starts], np.add.reduceat(weights, starts)
    if grams.shape[1] == 1:
        return kinds[:, None], sums
    return np.stack([kinds // np.uint64(base), kinds % np.uint64(base)], axis=1), sums


def _read_blobs(batches: Iterator[pa.RecordBatch]) -> tuple[int, np.ndarray, np.ndarray]:
    """The shard of a group of blobs, its distinct keys and their counts."""
    part, keys, counts = 0, [], []
    for b in batches:
        part = b.column("part")[0].as_py() if b.num_rows else part
        for g, c in zip(b.column("grams").to_pylist(), b.column("counts").to_pylist()):
            keys.append(_from_differences(g))
            counts.append(_wide(c, len(keys[-1])))
    grams, counts = _count(np.concatenate(keys)[:, None], np.concatenate(counts))
    return part, grams[:, 0], counts


def quantise(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes of base-10 logarithms and their table: the values, or even steps if they are too many."""
    if not len(logs):
        return np.zeros(0, np.uint8), np.zeros(1)
    kinds = np.unique(logs)
    table = kinds if len(kinds) <= CODES else np.linspace(kinds[0], kinds[-1], CODES)
    middle = (table[1:] + table[:-1]) / 2
    return np.searchsorted(middle, logs).astype(np.uint8), table


def _pack(*parts) -> bytes:
    """Arrays and sequences one after another, each starting at a multiple of eight bytes."""
    out = []
    for p in parts:
        data = p.to_bytes() if isinstance(p, EliasFano) else struct.pack("<Q", len(p)) + p.tobytes()
        out.append(data + b"\0" * (-len(data) % 8))
    return b"".join(out)


class Reader:
    def __init__(self, data):
        self.data, self.at = data, 0

    def array(self, kind) -> np.ndarray:
        (n,) = struct.unpack_from("<Q", self.data, self.at)
        out = np.frombuffer(self.data, kind, n, self.at + 8)
        self.at += -(-(8 + out.nbytes) // 8) * 8
        return out

    def sequence(self) -> EliasFano:
        out, self.at = EliasFano.from_buffer(self.data, self.at)
        return out


class Words:
    """Level 1 of a shard: ascending hashes of its words and their counts."""

    def __init__(self, reader: Reader):
        self.hashes, self.counts = reader.array(np.uint64), reader.array("<i8")

    def find(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


class Level:
    """Successors of the entries of the level above."""

    def __init__(self, reader: Reader):
        self.pointers, self.followers = reader.sequence(), reader.sequence()
        self.span = int(reader.array("<i8")[0])
        self.codes, self.table = reader.array(np.uint8), reader.array("<f8")
        self.weights, self.weight_table = reader.array(np.uint8), reader.array("<f8")

    @staticmethod
    def encode(context: np.ndarray, word: np.ndarray, n_contexts: int, span: int, logs: np.ndarray, weight_codes, weight_table) -> bytes:
        """Entries in ascending order of ``context`` (number in the level above) and ``word`` (id)."""
        pointers = np.searchsorted(context, np.arange(n_contexts + 1))
        relative = context.astype(np.uint64) * np.uint64(span) + word.astype(np.uint64)
        codes, table = quantise(logs)
        return _pack(EliasFano.encode(pointers), EliasFano.encode(relative), np.array([span], "<i8"), codes, table, weight_codes, weight_table)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Entry of each successor of its context, -1 where there is none."""
        return self.followers.find(context.astype(np.uint64) * np.uint64(self.span) + word.astype(np.uint64))

    def successors(self, context: int) -> np.ndarray:
        """Words after a context, ascending: what lies between its pointers."""
        start, stop = self.pointers.get(np.array([context, context + 1])).astype(np.int64)
        return (self.followers.get(np.arange(start, stop)) - np.uint64(context * self.span)).astype(np.int64)

    def log(self, entry: np.ndarray) -> np.ndarray:
        return self.table[self.codes[entry]]

    def weight(self, context: np.ndarray) -> np.ndarray:
        """Logarithm of what a context of the level above leaves to the shorter one."""
        return self.weight_table[self.weights[context]]


class Trie:
    """All shards' files, mapped when they are first asked; a process keeps them."""

    def __init__(self, folder: str, shards: int, parts: list[int], span: int, n_tokens: int, n_words: int):
        self.folder, self.shards, self.parts, self.span = folder, shards, set(parts), span
        self.n_tokens, self.n_words = n_tokens, n_words
        self.open: dict[tuple[int, int], object] = {}

    def __getstate__(self):
        return {**self.__dict__, "open": {}}

    def level(self, k: int, part: int):
        if (k, part) not in self.open:
            reader = Reader(mapped(f"{self.folder}/level{k}-{part:05d}"))
            self.open[k, part] = Words(reader) if k == 1 else Level(reader)
        return self.open[k, part]

    def _by_part(self, part: np.ndarray):
        return ((p, rows) for p, rows in _dealt(part, self.shards) if p in self.parts)

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: not learned) and count of each word hash."""
        kinds, where = np.unique(h, return_inverse=True)
        number, count = np.full(len(kinds), -1), np.zeros(len(kinds), dtype=np.int64)
        for p, rows in self._by_part((spread(kinds) % np.uint64(self.shards)).astype(np.int64)):
            words = self.level(1, p)
            at = words.find(kinds[rows])
            known = at >= 0
            number[rows[known]] = at[known] * self.shards + p
            count[rows[known]] = words.counts[at[known]]
        return number[where], count[where]

    def counts_of(self, number: np.ndarray) -> np.ndarray:
        """Counts of words by number."""
        out = np.zeros(len(number), dtype=np.int64)
        for p, rows in self._by_part(number % self.shards):
            out[rows] = self.level(1, p).counts[number[rows] // self.shards]
        return out

    def lower(self, k: int, part: int, context: np.ndarray, word: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Logarithm of ``word`` in the context shorter by one of entries ``context`` of level k - 1.

        An entry's last word is its follower's number; the chain of those words from the second on is
        the shorter context, which is followed level by level.
        """
        chain, entry = [], context
        for j in range(k - 1, 1, -1):
            level = self.level(j, part)
            relative = level.followers.get(entry).astype(np.int64)
            chain.append(relative % self.span)
            entry = relative // self.span
        logs, by_level = first, [first]
        for j in range(2, k):
            # The word after ever longer ends of the chain.
            end = chain[:j - 1][::-1]
            context_now = end[0]
            for i, w in enumerate(end[1:], 2):
                context_now, _ = self.follow(i, context_now, w, np.zeros(len(w)))
            _, logs = self.follow(j, context_now, word, by_level[-1])
            by_level.append(logs)
        return logs

    def first_order(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.n_tokens + self.n_words + 1))

    def follow(self, k: int, context: np.ndarray, word: np.ndarray, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each context of level k - 1 (-1: none): the entry of ``word`` after it in level k (-1: none)
        and the logarithm of its probability, ``shorter`` being that in the shorter context."""
        entry, logs = np.full(len(context), -1), shorter.copy()
        rows = np.flatnonzero(context >= 0)
        for p, some in self._by_part(context[rows] % self.shards):
            some = rows[some]
            level, local = self.level(k, p), context[some] // self.shards
            logs[some] += level.weight(local)
            known = some[word[some] >= 0]
            # Running text repeats itself: each kind of pair is searched once.
            kinds, where = np.unique(
                (context[known] // self.shards).astype(np.uint64) * np.uint64(self.span) + word[known].astype(np.uint64),
                return_inverse=True)
            at = level.followers.find(kinds)[where]
            hit = at >= 0
            entry[known[hit]] = at[hit] * self.shards + p
            logs[known[hit]] = level.log(at[hit])
        return entry, logs

    def score(self, h: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count and first-order logarithm of every token, and its logarithm under the whole model.

        The first token of a text follows an end."""
        number, count = self.words(h)
        base = self.first_order(count)
        start = np.zeros(len(h), dtype=bool)
        start[np.cumsum(sizes)[:-1]] = True
        start[:1] = True
        end_number = self.words(np.array([END]))[0][0]
        context = np.where(start, end_number, np.concatenate([[end_number], number[:-1]]))
        logs = base
        for k in range(2, order + 1):
            entry, logs = self.follow(k, context, number, logs)
            # The longer context of the next token is this entry; a text's first token has none.
            context = np.where(start, -1, np.concatenate([[-1], entry[:-1]]))
        return count, base, logs


def _train(docs: DataFrame, held_out: Column) -> DataFrame:
    return docs.filter(~held_out).select(utf8(F.col("text")).alias("text"))


def _counted(texts: DataFrame, grams_of, width: int, shards: int, span: int = 0) -> DataFrame:
    """Blobs with the counts of the rows that ``grams_of(hashes, sizes)`` gives for every slice of texts."""

    def run(batches):
        counter = Counter(width, shards, span)
        for b in batches:
            for part in slices(b, "text", SLICE_BYTES):
                counter.add(grams_of(*hash_words(part.column("text").to_pylist())))
                if counter.size > HELD_NGRAMS:
                    yield from counter.blobs()
        yield from counter.blobs()

    return texts.mapInArrow(run, BLOBS)


def learn(docs: DataFrame, held_out: Column, order: int = ORDER, min_count: int = MIN_COUNT, discount: float = DISCOUNT) -> Trie:
    """Counts, smooths and writes the trie level by level; each level is one pass over the text.

    A level's n-grams are looked up in the levels before it, so only those whose shorter n-grams are
    kept can be: an n-gram of ``min_count`` has none that is rarer. The driver gets a row a shard.
    """
    folder = scratch_path(docs.sparkSession, "trie")
    texts = _train(docs, held_out)
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // SHARD_BYTES))
    ddl = "part int, n_words long, n_tokens long"
    schema = arrow(ddl)

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, hashes, counts = _read_blobs(batches)
        write_once(f"{folder}/level1-{part:05d}", _pack(hashes, counts.astype("<i8")))
        yield batch(schema, [part], [len(counts)], [int(counts.sum())])

    words = _counted(texts, lambda h, sizes: h[:, None], 1, shards).groupBy("part").applyInArrow(write_words, ddl)
    rows = materialise(words, "trie-words").collect()
    parts = [r.part for r in rows]
    span = shards * max([r.n_words for r in rows], default=0)
    trie = Trie(folder, shards, parts, span, sum(r.n_tokens for r in rows), sum(r.n_words for r in rows))
    everyone = docs.sparkSession.createDataFrame(
        [(p, b"", b"") for p in parts], BLOBS) if parts else None
    for k in range(2, order + 1 if parts else 0):
        def grams_of(h, sizes):
            number, count = trie.words(h)
            start = np.zeros(len(h), dtype=bool)
            start[np.cumsum(sizes)[:-1]] = True
            start[:1] = True
            end_number = trie.words(np.array([END]))[0][0]
            context = np.where(start, end_number, np.concatenate([[end_number], number[:-1]]))
            zero = np.zeros(len(h))
            for j in range(2, k):
                entry, _ = trie.follow(j, context, number, zero)
                shorter = entry
                context = np.where(start, -1, np.concatenate([[-1], entry[:-1]]))
            keep = (context >= 0) & (count >= min_count)
            if k > 2:
                keep &= shorter >= 0
            return np.stack([context[keep], number[keep]], axis=1).astype(np.uint64)

        def write_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, keys, counts = _read_blobs(batches)
            keep = counts >= min_count
            keys, counts = keys[keep], counts[keep]
            context, word = (keys // np.uint64(trie.span)).astype(np.int64), (keys % np.uint64(trie.span)).astype(np.int64)
            above = trie.level(k - 1, part)
            totals = above.counts if k == 2 else _wide(mapped(f"{folder}/counts{k - 1}-{part:05d}"), above.followers.n)
            n = len(totals)
            given = np.bincount(context, counts - discount, n)
            left = 1.0 - given / np.maximum(totals, 1)
            logs = np.empty(len(context))
            for a in range(0, len(context), CHUNK):
                some = slice(a, a + CHUNK)
                lower = trie.first_order(trie.counts_of(word[some]))
                if k > 2:
                    lower = trie.lower(k, part, context[some], word[some], lower)
                logs[some] = np.log10((counts[some] - discount) / totals[context[some]] + left[context[some]] * 10.0 ** lower)
            weights, table = quantise(np.log10(left))
            if k < order:
                write_once(f"{folder}/counts{k}-{part:05d}", _narrow(counts))
            write_once(f"{folder}/level{k}-{part:05d}", Level.encode(context, word, n, trie.span, logs, weights, table))
            yield batch(schema, [part], [len(counts)], [int(counts.sum())])

        # Every shard writes a level, also one without n-grams.
        blobs = _counted(texts, grams_of, 2, shards, span).unionByName(everyone)
        materialise(blobs.groupBy("part").applyInArrow(write_level, ddl), "trie-level")
    return trie


def score(docs: DataFrame, trie: Trie, order: int = ORDER) -> DataFrame:
    """Per document: ``doc_id, n_tokens, n_known, base_score, score``; scores are base-10 logarithms.

    Tokens are lower-cased (A-Z) words and one end; null and empty texts are an end alone. A word that
    was not learned is one unknown word. Repeated rows and null ids are scored like any other.
    """
    ddl = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    schema = arrow(ddl)
    top = order if trie.parts else 1

    def run(batches):
        for b in batches:
            for part in slices(b, "text", SLICE_BYTES):
                h, sizes = hash_words(part.column("text").to_pylist())
                count, base, logs = trie.score(h, sizes, top)
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                add = lambda x: np.add.reduceat(x, starts)
                yield batch(schema, part.column("doc_id"), pa.array(sizes), add((count > 0).astype(np.int64)), add(base), add(logs))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text")).mapInArrow(run, ddl)


def held_out_column() -> Column:
    """Documents that are not learned from: crc32 of the id as text leaves 2 when divided by 7."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def learn_and_score(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Scores all documents with a model of those that are not held out."""
    trie = learn(docs, held_out_column(), min_count=min_count)
    return score(docs, trie).select(
        "doc_id", held_out_column().alias("held_out"), "n_tokens", "n_known",
        F.lit(trie.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
