"""Token ids in binary files of directly addressable codes.

A file holds the ids of a run of documents. Every id is cut into chunks of ``WIDTH`` bits; level k
holds the k-th chunk of those ids that have one, a bitmap tells which of them go on to level k + 1,
and a rank directory counts the set bits before every block of the bitmap. The place of any token's
next chunk is the rank of its bit, so a token is read from a few addresses, without decoding others.

File: magic, number of documents, tokens and levels; the documents' ids, first tokens and null flags;
then for each level its length, chunks, bitmap and directory. All numbers are little-endian.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, batch, files, slices, utf8, write_once
from ledgerlens.session import scratch_path

MAGIC = b"DACTOK01"
WIDTH = 8
RANK_BLOCK = 512  # bits of bitmap for each entry of its directory
ROLL_TOKENS = 4_000_000
END_ID = 1
LEARN_BYTES = 4 << 20  # texts whose new words are learned together
END_BYTES = END_ID.to_bytes(4, "little")
CACHE_PIECES = 700_000

MANIFEST = "file string, n_docs long, n_tokens long, n_bytes long, sha256 string"
DOCS = "file string, doc_id long, local_start long, n_tokens long, ids_crc32 long"

_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint32)


class Codes:
    """Directly addressable codes of an array of unsigned 32-bit numbers."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def encode(cls, values: np.ndarray) -> Codes:
        levels, rest = [], np.asarray(values, dtype=np.uint32)
        while True:
            more = rest >= (1 << WIDTH)
            bits = np.packbits(more, bitorder="little")
            bits = np.pad(bits, (0, -len(bits) % (RANK_BLOCK // 8)))
            blocks = _ONES[bits].reshape(-1, RANK_BLOCK // 8).sum(axis=1, dtype=np.uint32)
            ranks = np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")
            levels.append(((rest & ((1 << WIDTH) - 1)).astype(np.uint8), bits, ranks))
            rest = rest[more] >> WIDTH
            if not len(rest):
                return cls(levels)

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values at any positions: one chunk, one bit and one rank a level for those that go on."""
        index = np.asarray(index, dtype=np.int64)
        out = np.zeros(len(index), dtype=np.uint32)
        rows = np.arange(len(index))
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[rows] |= chunks[index].astype(np.uint32) << np.uint32(WIDTH * k)
            on = (bits[index >> 3] >> (index & 7).astype(np.uint8)) & 1 == 1
            rows, index = rows[on], index[on]
            if not len(index):
                break
            block = index // RANK_BLOCK
            inside = bits.reshape(-1, RANK_BLOCK // 8)[block]
            byte = (index % RANK_BLOCK) >> 3
            full = np.where(np.arange(RANK_BLOCK // 8)[None, :] < byte[:, None], _ONES[inside], 0).sum(axis=1)
            part = _ONES[bits[index >> 3] & ((1 << (index & 7)) - 1).astype(np.uint8)]
            index = (ranks[block] + full + part).astype(np.int64)
        return out

    def all(self) -> np.ndarray:
        """Every value, level by level from the last."""
        rest = np.zeros(0, dtype=np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            on = np.unpackbits(bits, bitorder="little")[:len(chunks)].astype(bool)
            values = chunks.astype(np.uint32)
            values[on] |= rest << np.uint32(WIDTH)
            rest = values
        return rest

    def to_bytes(self) -> bytes:
        out = [struct.pack("<I", len(self.levels))]
        for chunks, bits, ranks in self.levels:
            out += [struct.pack("<QQQ", len(chunks), len(bits), len(ranks)), chunks.tobytes(), bits.tobytes(), ranks.tobytes()]
        return b"".join(out)

    @classmethod
    def from_buffer(cls, data, at: int = 0) -> Codes:
        (n,) = struct.unpack_from("<I", data, at)
        at, levels = at + 4, []
        for _ in range(n):
            sizes = struct.unpack_from("<QQQ", data, at)
            at, parts = at + 24, []
            for size, kind in zip(sizes, (np.uint8, np.uint8, np.dtype("<u4"))):
                parts.append(np.frombuffer(data, dtype=kind, count=size, offset=at))
                at += size * np.dtype(kind).itemsize
            levels.append(tuple(parts))
        return cls(levels)


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    plain = np.array([d or 0 for d in doc_ids], dtype="<i8")
    head = MAGIC + struct.pack("<QQ", len(doc_ids), len(ids))
    return b"".join([head, plain.tobytes(), starts.tobytes(), known.tobytes(), Codes.encode(ids).to_bytes()])


class TokenFile:
    """Reads one file: ``doc(i)`` or ``tokens(positions)`` without decoding the rest."""

    def __init__(self, data):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        n, self.n_tokens = struct.unpack_from("<QQ", data, 8)
        at = 24
        plain = np.frombuffer(data, "<i8", n, at)
        self.starts = np.frombuffer(data, "<i8", n + 1, at + 8 * n)
        known = np.frombuffer(data, np.uint8, n, at + 16 * n + 8)
        self.doc_ids = [int(d) if k else None for d, k in zip(plain, known)]
        self.codes = Codes.from_buffer(data, at + 17 * n + 8)

    def tokens(self, positions) -> np.ndarray:
        return self.codes.at(positions)

    def doc(self, i: int) -> np.ndarray:
        return self.codes.at(np.arange(self.starts[i], self.starts[i + 1]))


# Texts of these characters are cut into pieces here: normal forms and lower case act on each alone.
_LATIN = re.compile(r"[ -~\t-\r¡-ÿĀ-įı-ȹ]*")
# How the tokenizer's own file splits lower-cased text into pieces, for these characters.
_LETTERS, _DIGITS = "a-zªµºß-öø-ȹ", "0-9²³¹¼½¾"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")
_BLANK = re.compile("[ \t-\r]+")
_LINE = 64


class WordEncoder:
    """Ids of whole texts, each distinct piece of a text encoded once by the tokenizer.

    Latin text is cut into the pieces that the tokenizer itself makes: it never joins two of them.
    Any other text is cut at white space, which the tokenizer drops, and its odd words are encoded
    whole. Pieces are encoded many to a line and told apart by the mark that the vocabulary puts on
    the last token of each. A memory that grows beyond ``CACHE_PIECES`` is emptied.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        lines = [pieces[i:i + _LINE] for i in range(0, len(pieces), _LINE)]
        out: list[bytes] = []
        for line, ids in zip(lines, self._encode([" ".join(line) for line in lines])):
            ends = 4 * (np.flatnonzero(self.last[np.frombuffer(ids, "<u4")]) + 1)
            if len(ends) != len(line) or ends[-1] != len(ids):
                out += self._encode(line)
            else:
                out += [ids[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
        return out

    def _cut(self, text: str, odd: set[str]) -> list[str]:
        if _LATIN.fullmatch(text) and "<|" not in text:
            return _PIECES.findall(text.lower())
        out = []
        for word in _BLANK.split(text):
            if _LATIN.fullmatch(word) and "<|" not in word:
                out += _PIECES.findall(word.lower())
            else:
                odd.add(word)
                out.append(word)
        return out

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, the end id last. What the texts have that is new is learned at once."""
        odd: set[str] = set()
        cuts = [self._cut(t.decode(), odd) for t in texts]
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        new = set().union(*cuts).difference(self.known)
        plain, whole = list(new - odd), list(new & odd)
        self.known.update(zip(plain, self._encode_pieces(plain)))
        self.known.update(zip(whole, self._encode(whole)))
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, cut)) + END_BYTES, dtype="<u4") for cut in cuts]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and tokenizer, so its memory outlives a task."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, roll_tokens: int = ROLL_TOKENS) -> DataFrame:
    """Encodes ``docs`` (``doc_id, text``) and writes files in ascending ``doc_id``; returns the manifest.

    Null and empty texts give the end id alone; a null id comes first; repeated ids are separate
    documents, ordered by text. File names ascend with the documents. An empty table gives no file.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", utf8(F.col("text")).alias("text")).repartitionByRange(
        parts, "doc_id").sortWithinPartitions("doc_id", "text")
    schema = arrow(MANIFEST)

    def write(batches):
        from pyspark import TaskContext

        encode, part, rolled = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, lengths, ids, size = [], [], [], 0

        def close():
            nonlocal rolled, doc_ids, lengths, ids, size
            name = f"tokens-{part:05d}-{rolled:05d}.dac"
            data = encode_file(doc_ids, lengths, np.concatenate(ids))
            row = [name, len(doc_ids), size, len(data), write_once(f"{folder}/{name}", data)]
            rolled, doc_ids, lengths, ids, size = rolled + 1, [], [], [], 0
            return batch(schema, *[[x] for x in row])

        for b in batches:
            for part_of in slices(b, "text", LEARN_BYTES):
                for doc_id, found in zip(part_of.column("doc_id").to_pylist(), encode(part_of.column("text").to_pylist())):
                    doc_ids.append(doc_id)
                    lengths.append(len(found))
                    ids.append(found)
                    size += len(found)
                    if size >= roll_tokens:
                        yield close()
        if doc_ids:
            yield close()

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/_manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: ``file, doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the tokens of all documents before it: a running total over the manifest, which
    has one row a file, is added to the place inside the file.
    """
    schema = arrow(DOCS)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select(F.col("file").alias("name"), "sha256",
                            F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def read(batches):
        for b in batches:
            for name, content in zip(b.column("name"), b.column("content")):
                data = content.as_buffer()
                file = TokenFile(data)
                ids = file.codes.all().astype("<u4")
                starts = file.starts
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(starts, starts[1:])]
                yield batch(schema, [name.as_py()] * len(crc), file.doc_ids, pa.array(starts[:-1]), pa.array(np.diff(starts)), crc)

    stored = files(manifest, folder, "*.dac").select("name", "content")
    return stored.mapInArrow(read, DOCS).join(bases, F.col("file") == F.col("name")).select(
        "file", "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, roll_tokens: int = ROLL_TOKENS) -> DataFrame:
    """Writes token files to the shared folder and reads the documents back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_documents(write_tokens(docs, folder, tokenizer, roll_tokens), folder)
