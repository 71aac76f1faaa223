"""Repeated passages by a sparse suffix array that a distributed, prefix-aware merge sort builds.

A passage of ``length`` bytes that occurs twice has the same least fingerprint of ``anchor`` bytes in
both places (winnowing), so only suffixes that start at such an anchor can tell a repeat, and only
anchors whose fingerprint occurs again are sorted. A fingerprint is all that is exchanged to find
those out. Their suffixes are cut after ``length`` bytes, sorted where they lie into runs, front-coded
(every string holds only what follows its common prefix with the one before it), dealt out by range,
and merged by a loser tree that compares two strings only from the prefix that they are known to
share. The merge gives the common prefixes of neighbours, from which the repeats follow exactly.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, batch, slices, utf8
from ledgerlens.session import drop, settled

LENGTH = 400
SLICE_BYTES = 256 << 10
RUN_BYTES = 8 << 20
STRETCH = 1 << 18  # windows whose fingerprints are held at once
SAMPLE_DOCS = 2_000

FOUND = "part int, prints binary, contexts binary, docs binary, places binary"
PLACES = "uid long, place int, sorted boolean"
RUNS = "part int, run binary"
PASSAGES = "part int, prints binary, docs binary, starts binary, stops binary"
SPANS = "uid long, start int, stop int"

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANK = frozenset(b" \t\n\v\f\r")
_P = 0x9E3779B97F4A7C15 | 1


def _mix(h):
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchor_of(length: int) -> int:
    """Bytes of an anchor: the greatest power of two in ``length``."""
    return 1 << (length.bit_length() - 1)


def reach_of(length: int) -> int:
    """How far before its anchor a passage may start."""
    return length - anchor_of(length)


def fingerprints(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes (a power of two) from every position, by doubling."""
    h = _mix((data.astype(np.uint64) + np.uint64(1)) * np.uint64(_P))
    step, factor = 1, _P
    while step < width and len(h) > step:
        factor = factor * factor % 2**64
        h = h[:-step] * np.uint64(factor) + h[step:]
        step *= 2
    return _mix(h) if step == width else h[:0]


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of anchors and their fingerprints; ``ends`` are where the texts in ``data`` end.

    Of every window of ``length`` bytes inside a text the least fingerprint is taken, the first of equals.
    A window is judged by its own bytes alone, so windows are taken ``STRETCH`` at a time: memory does not
    grow with the longest text.
    """
    starts = np.concatenate([[0], ends[:-1]])
    full = ends - starts >= length
    first, stop = starts[full], ends[full] - length + 1
    found, prints = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for low in range(0, len(data), STRETCH):
        high = min(low + STRETCH, len(data))
        valid = np.zeros(high - low + 1, dtype=np.int32)
        np.add.at(valid, np.clip(first, low, high) - low, 1)
        np.add.at(valid, np.clip(stop, low, high) - low, -1)
        windows = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        if len(windows):
            at, h = _least(data[low:high + length - 1], windows, length)
            found.append(at + low)
            prints.append(h)
    at, one = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(prints)[one]


def _least(data: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of the anchors of the ``windows``, told by their starts."""
    h = fingerprints(data, anchor_of(length))
    place = np.uint64((1 << 28) - 1)
    least = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    step, width = 1, reach_of(length) + 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    chosen = np.minimum(least[windows], least[windows + width - step]) & place
    found = np.unique(chosen).astype(np.int64)
    return found, h[found]


def _texts(part: pa.RecordBatch) -> tuple[bytes, np.ndarray]:
    texts = part.column("text").to_pylist()
    return b"".join(texts), np.cumsum([len(t) for t in texts])


def _with_uid(docs: DataFrame) -> DataFrame:
    """``uid`` names a document by id and text: rows that are equal in both share it and their result."""
    text = utf8(F.col("text"))
    return docs.withColumn("uid", F.xxhash64("doc_id", "text")).withColumn("text", text)


def find_places(texts: DataFrame, parts: int, length: int) -> DataFrame:
    """Anchors that occur again: ``uid, place, sorted``.

    Those with equal surroundings (all that any passage around the anchor could cover) are told by a
    hash alone; of each kind of surroundings one, with ``sorted``, goes into the sort if others differ.
    """
    schema, out, reach = arrow(FOUND), arrow(PLACES), reach_of(length)

    def run(batches):
        for b in batches:
            for rows in slices(b, "text", SLICE_BYTES):
                data, ends = _texts(rows)
                if not data:
                    continue
                at, prints = anchors(np.frombuffer(data, dtype=np.uint8), ends, length)
                if not len(at):
                    continue
                doc = np.searchsorted(ends, at, side="right")
                starts = np.concatenate([[0], ends[:-1]])[doc]
                left, right = np.maximum(at - reach, starts), np.minimum(at + length, ends[doc])
                view = memoryview(data)
                contexts = np.fromiter(
                    (xxhash.xxh3_64_intdigest(view[x:y], seed=int(a - x)) for x, y, a in zip(left, right, at)),
                    dtype=np.uint64, count=len(at))
                uid = rows.column("uid").to_numpy()[doc]
                to = (prints % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((prints, to))
                cuts = np.searchsorted(to[order], np.arange(parts + 1))
                cut = [(p, order[x:y]) for p, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
                yield batch(schema, [p for p, _ in cut], *[
                    [c[o].tobytes() for _, o in cut] for c in (prints, contexts, uid, (at - starts).astype(np.int32))])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        prints, contexts, uid, place = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t)
            for c, t in (("prints", np.uint64), ("contexts", np.uint64), ("docs", np.int64), ("places", np.int32)))
        order = np.lexsort((place, uid, contexts, prints))
        prints, contexts, uid, place = prints[order], contexts[order], uid[order], place[order]
        new_print = np.concatenate([[True], prints[1:] != prints[:-1]])
        new_context = new_print | np.concatenate([[True], contexts[1:] != contexts[:-1]])
        size = lambda new: np.diff(np.append(np.flatnonzero(new), len(new)))[np.cumsum(new) - 1]
        kinds = np.add.reduceat(new_context.astype(np.int64), np.flatnonzero(new_print))[np.cumsum(new_print) - 1]
        copied, several = size(new_context) > 1, kinds > 1
        for keep, to_sort in ((copied, False), (new_context & several, True)):
            yield batch(out, uid[keep], place[keep], np.full(int(keep.sum()), to_sort))

    return texts.select("uid", "text").mapInArrow(run, FOUND).groupBy("part").applyInArrow(again, PLACES)


def _common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Common prefix with the string before, length of the rest, and the rests of sorted strings."""
    shared = [0] + [_common(a, b) for a, b in zip(strings, strings[1:])] if strings else []
    rests = [s[n:] for s, n in zip(strings, shared)]
    return np.array(shared, dtype="<u2"), np.array([len(r) for r in rests], dtype="<u2"), b"".join(rests)


def encode_run(items: list[tuple[bytes, bytes, int, int]]) -> bytes:
    """A sorted run of ``(suffix, reversed text before it, uid, place)``."""
    shared, rest, body = front_code([i[0] for i in items])
    before = [i[1] for i in items]
    columns = [shared, rest, np.array([len(b) for b in before], dtype="<u2"),
               np.array([i[2] for i in items], dtype="<i8"), np.array([i[3] for i in items], dtype="<i4")]
    return struct.pack("<II", len(items), len(body)) + b"".join(c.tobytes() for c in columns) + body + b"".join(before)


def decode_run(data: bytes):
    """Yields ``(common prefix with the one before, suffix, before, uid, place)`` in order."""
    n, size = struct.unpack_from("<II", data)
    at, columns = 8, []
    for kind in ("<u2", "<u2", "<u2", "<i8", "<i4"):
        columns.append(np.frombuffer(data, kind, n, at).tolist())
        at += n * np.dtype(kind).itemsize
    left, last = at + size, b""
    for shared, rest, before, uid, place in zip(*columns):
        last = last[:shared] + data[at:at + rest]
        at += rest
        yield shared, last, data[left:left + before], uid, place
        left += before


def merge_runs(runs: list):
    """Merges runs of ``(common prefix with the one before, suffix, ...)`` by a loser tree.

    Every string in the tree knows its common prefix with the last string that went out. Of two, the
    one with the longer prefix is smaller without a look; with equal prefixes the comparison starts
    behind them, and the loser keeps what it shares with the winner. Yields the strings in order,
    the first entry replaced by the common prefix with the string that went out before.
    """
    k = 1
    while k < len(runs):
        k *= 2
    runs = [iter(r) for r in runs] + [iter(())] * (k - len(runs))
    heads = [next(r, None) for r in runs]
    known = [0] * k
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = _common(x[1], y[1], known[a])
        winner, loser = (a, b) if x[1][n:n + 1] <= y[1][n:n + 1] else (b, a)
        known[loser] = n
        return winner, loser

    level = list(range(k))
    at = k
    while len(level) > 1:
        at //= 2
        games = [play(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        for i, (_, loser) in enumerate(games):
            losers[at + i] = loser
        level = [w for w, _ in games]
    winner = level[0]
    while heads[winner] is not None:
        yield known[winner], *heads[winner][1:]
        following = next(runs[winner], None)
        heads[winner] = following
        known[winner] = following[0] if following else 0
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def repeated(items: list, shared: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted ``items`` with common prefixes ``shared``: the first and last byte counts before the
    anchor at which a repeated passage starts, -1 if none does.

    A passage that starts x bytes before an anchor occurs again if another suffix shares
    length - x bytes after its anchor and x bytes before it.
    """
    n = len(items)
    after, before = (np.array([len(i[f]) for i in items]) for f in (1, 2))
    order = sorted(range(n), key=lambda i: items[i][2])
    lefts = [items[i][2] for i in order]
    left_shared = np.array([0] + [_common(a, b) for a, b in zip(lefts, lefts[1:])])
    order = np.array(order)
    least, most = np.full(n, -1), np.full(n, -1)
    left_class = np.empty(n, dtype=np.int64)
    for x in range(reach_of(length) + 1):
        fits = np.flatnonzero((before >= x) & (after >= length - x))
        if len(fits) < 2:
            continue
        left_class[order] = np.cumsum(left_shared < x)
        key = np.cumsum(shared < length - x)[fits] * np.int64(n + 1) + left_class[fits]
        sort = np.argsort(key, kind="stable")
        same = key[sort][1:] == key[sort][:-1]
        twice = np.zeros(len(fits), dtype=bool)
        twice[sort[1:][same]] = True
        twice[sort[:-1][same]] = True
        hit = fits[twice]
        least[hit] = np.where(least[hit] < 0, x, least[hit])
        most[hit] = x
    return least, most


def sort_and_compare(texts: DataFrame, places: DataFrame, parts: int, length: int) -> DataFrame:
    """Spans ``uid, start, stop`` of passages around the ``places`` (``uid, places``) that occur again."""
    schema, out, reach = arrow(RUNS), arrow(SPANS), reach_of(length)

    def suffixes_of(rows: pa.RecordBatch):
        for uid, text, where in zip(rows.column("uid").to_pylist(), rows.column("text").to_pylist(), rows.column("places").to_pylist()):
            for a in sorted(set(where)):
                yield text[a:a + length], text[max(0, a - reach):a][::-1], uid, a

    def some(batches):
        for b in batches:
            yield batch(arrow_some, [s[:32] for s, *_ in suffixes_of(b)])

    arrow_some = arrow("start binary")
    few = places.orderBy(F.xxhash64("uid", F.lit(1)), "uid").limit(SAMPLE_DOCS)
    seen = texts.join(F.broadcast(few), "uid").select("uid", "text", "places").mapInArrow(some, "start binary")
    seen = seen.orderBy(F.xxhash64("start"), "start").limit(256 * parts).collect()
    starts = sorted(bytes(r[0]) for r in seen)
    cuts = sorted({starts[i * len(starts) // parts] for i in range(1, parts)}) if starts else []

    def make_runs(batches):
        held, size = [], 0

        def flush():
            held.sort()
            where = [bisect.bisect_right(cuts, i[0][:32]) for i in held]
            found, start = [], 0
            for j in range(1, len(held) + 1):
                if j == len(held) or where[j] != where[start]:
                    found.append((where[start], encode_run(held[start:j])))
                    start = j
            return batch(schema, *map(list, zip(*found)))

        for b in batches:
            for item in suffixes_of(b):
                held.append(item)
                size += 2 * length
                if size >= RUN_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [r for b in batches for r in b.column("run").to_pylist()]
        held: list = []

        def spans():
            shared = np.array([i[0] for i in held])
            shared[0] = 0
            least, most = repeated(held, shared, length)
            hit = np.flatnonzero(most >= 0)
            at = np.array([held[i][4] for i in hit], dtype=np.int64)
            return batch(out, [held[i][3] for i in hit], at - most[hit], at - least[hit] + length)

        for item in merge_runs([decode_run(r) for r in runs]):
            # Suffixes that share less than an anchor have nothing to do with each other.
            if item[0] < anchor_of(length) and len(held) >= 20_000:
                yield spans()
                held = []
            held.append(item)
        if len(held) > 1:
            yield spans()

    rows = texts.join(places, "uid").select("uid", "text", "places")
    return rows.mapInArrow(make_runs, RUNS).groupBy("part").applyInArrow(merge, SPANS)


def joined(row: np.ndarray, start: np.ndarray, stop: np.ndarray, rows: int) -> pa.ListArray:
    """For each of ``rows`` rows the maximal runs that its ranges (``row``, ``start``, ``stop``) cover together.

    Done on whole columns: as objects the ranges of a batch take ten times the memory.
    """
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order].astype(np.int64), stop[order]
    base = row.astype(np.int64) << 32  # no range reaches into the next row
    reach = np.maximum.accumulate(base + stop)
    first = np.flatnonzero(np.concatenate([[True], base[1:] + start[1:] > reach[:-1]])) if len(row) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(row))[:len(first)] - 1
    runs = [pa.array(x.astype(np.int32)) for x in (start[first], reach[last] - base[first])]
    offsets = np.searchsorted(row[first], np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(runs, ["start", "stop"]))


def _pairs(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of pairs of numbers: each pair's row and its two numbers, -1 for null."""
    flat = lists.flatten()
    return pc.list_parent_indices(lists).to_numpy(), *(pc.fill_null(c, -1).to_numpy() for c in flat.flatten())


def _marks(docs: DataFrame, length: int) -> DataFrame:
    """Per ``uid`` the ``marks`` of what repeats: ``place`` and, where it is no copied anchor, ``stop``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    only = _with_uid(docs).select("uid", "text")
    places = settled(find_places(only, parts, length), "suffix-places")
    to_sort = settled(places.filter("sorted").groupBy("uid").agg(F.collect_set("place").alias("places")), "suffix-lists")
    spans = settled(sort_and_compare(only, to_sort, parts, length), "suffix-spans")
    marks = places.filter("NOT sorted").select("uid", "place", F.lit(None).cast("int").alias("stop")).unionByName(
        spans.select("uid", F.col("start").alias("place"), "stop")).distinct()
    marks = settled(marks.groupBy("uid").agg(F.collect_list(F.struct("place", "stop")).alias("marks")), "suffix-marks")
    drop(places, to_sort, spans)
    return marks


def _repeating(docs: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    @F.arrow_udf("array<struct<start:int,stop:int>>")
    def ranges(lengths: pa.Array, found: pa.Array) -> pa.Array:
        row, start, stop = _pairs(found)
        # An anchor that is copied with all its surroundings covers them, if a passage fits in.
        copied, end = stop < 0, lengths.to_numpy()[row]
        stop = np.where(copied, np.minimum(end, start + length), stop)
        start = np.where(copied, np.maximum(0, start - reach_of(length)), start)
        keep = ~copied | (stop - start >= length)
        return joined(row[keep], start[keep], stop[keep], len(found))

    marked = _with_uid(docs).join(marks, "uid", "left")
    return marked.withColumn("removed", ranges(F.octet_length("text"), F.col("marks"))).drop("marks", "uid")


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with ``removed``: the byte ranges (start, stop) that repeat, ascending and apart.

    A byte repeats if a string of ``length`` bytes that covers it starts at another place too, in the same
    or another document; strings never cross documents. The texts' UTF-8 bytes count; null text is
    empty. All columns are kept, and ``text`` becomes its bytes; a row that occurs twice repeats as a
    whole if it is long enough. Rows without id take part. An empty table gives no rows.
    """
    return _repeating(docs, _marks(docs, length), length)


def find_passages(found: DataFrame, words: int, parts: int) -> DataFrame:
    """Passages ``uid, start, stop`` of ``words`` words, inside the ranges ``removed``, that occur again.

    As with anchors, a batch sends each part its passages' 128-bit hashes in one row.
    """
    schema, out = arrow(PASSAGES), arrow(SPANS)

    def windows(batches):
        for b in batches:
            for rows in slices(b, "text", SLICE_BYTES):
                prints, spans = [], []
                for uid, text, ranges in zip(rows.column("_uid").to_pylist(), rows.column("text").to_pylist(), rows.column("removed").to_pylist()):
                    for r in ranges:
                        at = [m.span() for m in _WORD.finditer(text, r["start"], r["stop"])]
                        # A word that a range begins or ends in is not whole.
                        at = [(x, y) for x, y in at if (x == 0 or text[x - 1] in _BLANK) and (y == len(text) or text[y] in _BLANK)]
                        for (x, _), (_, y) in zip(at, at[words - 1:]):
                            prints.append(xxhash.xxh3_128_digest(text[x:y]))
                            spans.append((uid, x, y))
                if not spans:
                    continue
                prints = np.frombuffer(b"".join(prints), dtype=np.uint64).reshape(-1, 2)
                spans = np.array(spans, dtype=np.int64)
                to = (prints[:, 0] % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cuts = np.searchsorted(to[order], np.arange(parts + 1))
                cut = [(p, order[x:y]) for p, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
                places = spans[:, 1:].astype(np.int32)
                yield batch(schema, [p for p, _ in cut], *[
                    [c[o].tobytes() for _, o in cut] for c in (prints, spans[:, 0], places[:, 0], places[:, 1])])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        prints, uid, start, stop = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t)
            for c, t in (("prints", np.uint64), ("docs", np.int64), ("starts", np.int32), ("stops", np.int32)))
        low, high = prints[::2], prints[1::2]
        order = np.lexsort((high, low))
        low, high = low[order], high[order]
        new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]), [True]])
        twice = order[~(new[:-1] & new[1:])]
        yield batch(out, uid[twice], start[twice], stop[twice])

    return found.select("_uid", "text", "removed").mapInArrow(windows, PASSAGES).groupBy("part").applyInArrow(again, SPANS)


def repeated_words(docs: DataFrame, words: int) -> DataFrame:
    """Like ``repeats``, for passages of ``words`` whole words and what stands between them, byte by byte.

    A passage that occurs again has ``2 * words - 1`` bytes at least, so it lies in a range of ``repeats``
    of that length. Only there the passages' 128-bit hashes are counted, as a range may join repeats
    of fewer words.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = _marks(docs, 2 * words - 1)
    found = _repeating(docs, marks, 2 * words - 1).withColumn("_uid", F.xxhash64("doc_id", "text"))
    found = settled(found, "word-ranges")
    drop(marks)
    passages = find_passages(found.filter(F.size("removed") > 0), words, parts).distinct()
    marks = settled(passages.groupBy("uid").agg(F.collect_list(F.struct("start", "stop")).alias("marks")), "word-marks")

    @F.arrow_udf("array<struct<start:int,stop:int>>")
    def ranges(found: pa.Array) -> pa.Array:
        return joined(*_pairs(found), len(found))

    rows = found.drop("removed").join(marks, F.col("_uid") == F.col("uid"), "left")
    return rows.withColumn("removed", ranges("marks")).drop("marks", "uid", "_uid")


def cut_out(text: Column, ranges: Column, characters: bool = False) -> Column:
    """The bytes outside the ranges, joined; with ``characters``, without bytes of a cut character."""

    @F.arrow_udf("binary")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        row, starts, stops = _pairs(found)
        first = np.searchsorted(row, np.arange(len(found) + 1)).tolist()
        starts, stops = starts.tolist(), stops.tolist()
        out = []
        for text, x, y in zip(texts, first, first[1:]):
            text = text.as_py()
            if x < y:
                kept = [text[a:b] for a, b in zip([0, *stops[x:y]], [*starts[x:y], len(text)])]
                if characters:
                    kept = [k.decode("utf-8", "ignore").encode() for k in kept]
                text = b"".join(kept)
            out.append(text)
        return pa.array(out, type=pa.binary())

    return cut(text, ranges)


def digest(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``text``, what is
    left of it; a character that a cut goes through is replaced there, not in the checksum."""
    found = repeats(docs.select("doc_id", "text"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"])
    cut = found.withColumn("kept", cut_out(F.col("text"), F.col("removed")))
    left = [F.make_valid_utf8(F.col("kept").cast("string")).alias("text")] if with_text else []
    return cut.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), length.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), *left)
