"""Alignment of two tokenizers, and how often their tokens meet over the whole corpus.

The byte offsets where a token of either side ends cut a document into groups; all tokens of one side
in a group are linked with all of the other. How many documents hold a pair of ids linked is counted
out of memory: every slice of documents sorts its pair-document records side-major (id of A, id of B,
document), radix-partitions them by the id of A and writes each partition as a zstd run. A k-way heap
merge walks the runs of a partition by the id of A: all pairs of an id come together, so its counts and
their maximum are known at once and stream back to the documents.

Frequent ids make large partitions. Counts are therefore merged first, from runs that hold a number for
each pair of a slice, and the records of a partition then go back in cells of a bounded number of bytes,
each beside the partition's counts.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, slices, utf8
from ledgerlens.session import materialise

SLICE_BYTES = 4 << 20
SEND_BYTES = 4 << 20  # of group texts that go to the JVM at once
LINE = 64
CACHE_CHUNKS = 250_000  # a memory of chunks that grows beyond this is emptied
PARTS = 64  # radix partitions of the ids of A
FAN = 256  # runs that one merge takes
CELL_BYTES = 16 << 20  # compressed records of a partition that one group of a task takes

DOC = "slice long, ord int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
RUN = "part int, counted binary, records binary, n_bytes long"
TOTALS = "part int, counted binary"
BACK = "slice long, found binary"
SUMS = "slice long, ord int, n_best long, count_sum long"
PAIRS = "a int, b int, n_docs long, best boolean"

# A blank between such characters is where both tokenizers start a new token: see ``Aligner``.
_SAFE = r"[!-~\w]"
_CUT = re.compile(rf"(?<={_SAFE}) (?={_SAFE})")
_UNSAFE = re.compile(rf"(?<!{_SAFE}) | (?!{_SAFE})")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the
    others in turn for code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: ids of a text, and the bytes of every id."""

    def __init__(self, pieces: list[bytes], encode):
        self.pieces, self.encode = pieces, encode
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)

    @classmethod
    def byte_level(cls, path: str) -> Side:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        pieces = [b""] * (max(tokenizer.get_vocab().values()) + 1)
        for token, i in tokenizer.get_vocab().items():
            # A token that is not written in byte letters is a special one: its own text.
            known = all(c in letters for c in token)
            pieces[i] = bytes(letters[c] for c in token) if known else token.encode()

        def encode(lines: list[str]) -> list[list[int]]:
            found = tokenizer.encode_batch_fast([" " + t for t in lines], add_special_tokens=False)
            return [e.ids for e in found]

        return cls(pieces, encode)

    @classmethod
    def sentence_pieces(cls, path: str) -> Side:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [
            bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
        ]
        return cls(pieces, lambda lines: model.encode(lines, num_threads=1))

    def ids(self, lines: list[str]) -> np.ndarray:
        """Ids of all lines in turn, a blank before each."""
        found = self.encode(lines)
        return np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found)))

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())) == text


class Chunks:
    """Chunks with their tokens, groups and links, one after another."""

    def __init__(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, ends: np.ndarray):
        """Ids and byte ends of both sides over all chunks in a line, and the byte ends of the chunks."""
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_stop, b_stop = (np.searchsorted(x, cuts, side="right") for x in (a_ends, b_ends))
        self.a, self.b, self.a_stop, self.b_stop = a, b, a_stop, b_stop
        a_size, b_size = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        self.stops = np.searchsorted(cuts, ends, side="right")  # groups up to the end of each chunk
        n_links = a_size * b_size
        self.n_groups = np.diff(self.stops, prepend=0)
        self.n_a, self.n_b, self.n_links = map(self._per_chunk, (a_size, b_size, n_links))
        # Every token of A in a group with every token of B there.
        of = np.repeat(np.arange(len(cuts)), n_links)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(n_links) - n_links, n_links)
        at_a = (a_stop - a_size)[of] + inside // np.maximum(b_size[of], 1)
        at_b = (b_stop - b_size)[of] + inside % np.maximum(b_size[of], 1)
        self.links = a[at_a] << 32 | b[at_b]

    def _per_chunk(self, x: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(x)])[self.stops], prepend=0)

    def texts(self) -> list[str]:
        """The groups of each chunk as text: ids of A, a bar, ids of B; groups parted by semicolons."""
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        out, i, j = [], 0, 0
        for m, n in zip(self.a_stop.tolist(), self.b_stop.tolist()):
            out.append(f"{a[i]}|{b[j]}" if m - i == 1 == n - j else f"{','.join(a[i:m])}|{','.join(b[j:n])}")
            i, j = m, n
        stops = self.stops.tolist()
        return [out[i] if k - i == 1 else ";".join(out[i:k]) for i, k in zip([0, *stops], stops)]


class Aligner:
    """Tokens, groups and links of whole texts, each distinct chunk encoded once.

    A text with a blank before it is a row of chunks that each begin with one blank, cut where a blank
    stands between two characters of ``_SAFE``, none of which is white space. There A's splitting starts
    a piece, as its pieces take a blank at their start only; and no piece of B has a blank behind another
    character, so nothing is merged across. A text with a chunk that a side does not spell is encoded
    whole, and has no tokens if a side does not spell it either.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = Side.byte_level(a_path), Side.sentence_pieces(b_path)
        # Chunk: ids of A and of B as bytes and its groups as text, or None where a side does not spell it.
        self.known: dict[str, tuple[bytes, bytes, str] | None] = {}

    def chunks_of(self, text: str) -> list[str]:
        return text.split(" ") if not _UNSAFE.search(text) else _CUT.split(text)

    def _line(self, chunks: list[str]) -> bool:
        """Learns chunks, ``LINE`` of them encoded as one text; not where a side does not spell it or a token crosses two."""
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        lines = [" ".join(chunks[i:i + LINE]) for i in range(0, len(chunks), LINE)]
        whole, sides, parts = "".join(" " + x for x in lines).encode(), [], []
        for side in (self.a, self.b):
            ids = side.ids(lines)
            upto = np.cumsum(side.sizes[ids])
            stop = np.searchsorted(upto, ends)
            if not side.spells(ids, whole) or not np.array_equal(upto[stop], ends):
                return False
            sides += [ids, upto]
            raw, stop = ids.astype("<u4").tobytes(), (4 * (stop + 1)).tolist()
            parts.append([raw[i:k] for i, k in zip([0, *stop], stop)])
        self.known.update(zip(chunks, zip(*parts, Chunks(*sides, ends).texts())))
        return True

    def learn(self, chunks: list[str]) -> None:
        if chunks and not self._line(chunks):
            if len(chunks) == 1:
                self.known[chunks[0]] = None
            else:
                half = len(chunks) // 2
                self.learn(chunks[:half])
                self.learn(chunks[half:])

    def _cut(self, text: bytes | None) -> list[str]:
        """Chunks of a text; none where a side does not spell it."""
        try:
            text = (text or b"").decode()
        except UnicodeDecodeError:
            return []
        return self.chunks_of(text) if text else []

    def __call__(self, texts: list[bytes | None]) -> tuple[Chunks, list[str], np.ndarray, np.ndarray]:
        """The distinct chunks of a slice and their group texts; the chunk numbers of all texts in turn,
        and how many each text has."""
        if len(self.known) > CACHE_CHUNKS:
            self.known.clear()
        cuts = [self._cut(t) for t in texts]
        kinds = dict.fromkeys(chain.from_iterable(cuts))
        self.learn([c for c in kinds if c not in self.known])
        odd = {c for c in kinds if self.known[c] is None}
        if odd:
            # A text with such a chunk is a chunk of its own.
            for i, cut in enumerate(cuts):
                if not odd.isdisjoint(cut):
                    whole = " ".join(cut)
                    if whole not in self.known:
                        self.learn([whole])
                    cuts[i] = [] if self.known[whole] is None else [whole]
            kinds = dict.fromkeys(chain.from_iterable(cuts))
        found = list(map(self.known.__getitem__, kinds))
        a, b = (np.frombuffer(b"".join([f[k] for f in found]), "<u4").astype(np.int64) for k in (0, 1))
        a_ends = np.cumsum(self.a.sizes[a])
        ends = a_ends[np.cumsum([len(f[0]) // 4 for f in found]) - 1] if found else a_ends
        chunks = Chunks(a, a_ends, b, np.cumsum(self.b.sizes[b]), ends)
        sizes = np.array([len(cut) for cut in cuts], dtype=np.int64)
        number = dict(zip(kinds, range(len(kinds))))
        flat = np.fromiter(map(number.__getitem__, chain.from_iterable(cuts)), np.int64, int(sizes.sum()))
        return chunks, [f[2] for f in found], flat, sizes


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One a worker process and pair of tokenizers, so that what it has learned outlives a task."""
    if (a_path, b_path) not in _aligners:
        _aligners.clear()
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


# --- records and runs ----------------------------------------------------------------------------

def records_of(chunks: Chunks, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, document, times)`` of a slice, each document's pairs once, in order of pair and document."""
    n = max(len(chunks.n_links), 1)
    kinds, times = np.unique(np.repeat(np.arange(len(sizes)), sizes) * n + flat, return_counts=True)
    doc, chunk = kinds // n, kinds % n
    size = chunks.n_links[chunk]
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat((np.cumsum(chunks.n_links) - chunks.n_links)[chunk], size) + inside
    pairs, links = np.unique(chunks.links, return_inverse=True)
    key = links[at] * len(sizes) + np.repeat(doc, size)
    order = np.argsort(key)
    key, times = key[order], np.repeat(times, size)[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return pairs[key[first] // len(sizes)], key[first] % len(sizes), np.add.reduceat(times, first) if len(first) else times


def pack(*arrays: np.ndarray) -> bytes:
    """A zstd run of arrays of 64-bit numbers: each as its low and high bytes in turn, which repeat."""
    parts = []
    for x in arrays:
        planes = np.ascontiguousarray(x, dtype="<i8").view(np.uint8).reshape(-1, 8).T
        parts += [struct.pack("<Q", len(x)), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(run: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(run), 0, []
    while at < len(data):
        (n,) = struct.unpack_from("<Q", data, at)
        planes = np.frombuffer(data, np.uint8, 8 * n, at + 8).reshape(8, n)
        out.append(np.ascontiguousarray(planes.T).view("<i8").ravel())
        at += 8 + 8 * n
    return out


def runs_of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """``(part, counted, records)``: the records radix-partitioned by the id of A, in side-major order."""
    start = np.flatnonzero(np.diff(pair, prepend=-1))
    kind, n = pair[start], np.diff(np.append(start, len(pair)))
    part = (kind >> 32) % PARTS
    for p in np.unique(part).tolist():
        mine = np.flatnonzero(part == p)
        at = np.repeat(start[mine], n[mine]) + np.arange(int(n[mine].sum())) - np.repeat(
            np.cumsum(n[mine]) - n[mine], n[mine])
        counted = (kind[mine] >> 32, kind[mine] & 0xFFFFFFFF, n[mine])
        yield p, pack(*counted), pack(*counted, doc[at], times[at])


def merged(runs: list[list[np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """k-way heap merge of counted runs: ``(a, ids of B, documents)`` for every id of A in turn."""
    blocks = []
    for a, _, _ in runs:
        start = np.flatnonzero(np.diff(a, prepend=-1))
        blocks.append((a[start].tolist(), [*start.tolist(), len(a)]))
    heap = [(of[0], i, 0) for i, (of, _) in enumerate(blocks) if of]
    heapq.heapify(heap)
    while heap:
        a, parts = heap[0][0], []
        while heap and heap[0][0] == a:
            _, i, k = heap[0]
            parts.append((i, slice(blocks[i][1][k], blocks[i][1][k + 1])))
            if k + 1 < len(blocks[i][0]):
                heapq.heapreplace(heap, (blocks[i][0][k + 1], i, k + 1))
            else:
                heapq.heappop(heap)
        b, where = np.unique(np.concatenate([runs[i][1][at] for i, at in parts]), return_inverse=True)
        n = np.zeros(len(b), dtype=np.int64)
        np.add.at(n, where, np.concatenate([runs[i][2][at] for i, at in parts]))
        yield a, b, n


def merge_runs(runs: list[bytes]) -> bytes:
    """One counted run of many, with a mark on the pairs whose count is their id of A's highest."""
    out = [(np.full(len(b), a), b, n, n == n.max()) for a, b, n in merged([unpack(r)[:3] for r in runs])]
    return pack(*(np.concatenate(x) for x in zip(*out)))


def contributions(run: bytes, totals: list[np.ndarray]) -> bytes:
    """Per document of a run of records: how often its links are the best of their id of A, and the sum
    of their counts."""
    a, b, n, doc, times = unpack(run)
    at = np.searchsorted(totals[0] << 32 | totals[1], a << 32 | b)
    order = np.argsort(doc, kind="stable")
    doc, times, at = doc[order], times[order], np.repeat(at, n)[order]
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    return pack(doc[first], np.add.reduceat(times * totals[3][at], first), np.add.reduceat(times * totals[2][at], first))


# --- the job -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Aligned:
    docs: DataFrame  # doc_id, n_a, n_b, n_groups, n_links, what is kept of groups, n_best, count_sum
    pairs: DataFrame  # a, b, n_docs, best: every pair of ids that is linked in a document


def _spill(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of documents and of runs; a slice's documents are numbered in it."""
    ddl = f"{DOC}, {RUN}"
    schema = arrow(ddl)

    def rows_of(columns: dict) -> pa.RecordBatch:
        n = len(columns["slice"])
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, f.type) if f.name not in columns else c if isinstance(c := columns[f.name], pa.Array)
             else pa.array(c, f.type) for f in schema], schema=schema)

    def spill(batches):
        from pyspark import TaskContext

        align, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for rows in batches:
            for part in slices(rows, "text", SLICE_BYTES):
                chunks, texts, flat, sizes = align(part.column("text").to_pylist())
                stops = np.cumsum(sizes)
                totals = {c: np.diff(np.concatenate([[0], np.cumsum(getattr(chunks, c)[flat])])[stops], prepend=0)
                          for c in ("n_a", "n_b", "n_groups", "n_links")}
                start, size, groups = 0, 0, []
                for i, (stop, n) in enumerate(zip(stops.tolist(), sizes.tolist())):
                    groups.append(";".join([texts[c] for c in flat[stop - n:stop].tolist()]))
                    size += len(groups[-1])
                    if size >= SEND_BYTES or i == len(sizes) - 1:
                        mine = slice(start, i + 1)
                        yield rows_of({
                            "slice": [number] * len(groups), "ord": range(start, i + 1),
                            "doc_id": part.column("doc_id")[mine], "groups": groups,
                            **{c: x[mine] for c, x in totals.items()}})
                        start, size, groups = i + 1, 0, []
                runs = list(runs_of(*records_of(chunks, flat, sizes)))
                if runs:
                    radix, counted, records = zip(*runs)
                    yield rows_of({"slice": [number] * len(runs), "part": radix, "counted": counted,
                                   "records": records, "n_bytes": [len(r) for r in records]})
                number += 1

    return docs.select(F.col("doc_id").cast("long"), utf8(F.col("text")).alias("text")).mapInArrow(spill, ddl)


def _totals(runs: DataFrame) -> DataFrame:
    """One counted run a partition, by rounds of merges of about ``FAN`` runs."""
    schema = arrow(TOTALS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for b in batches:
            held += b.column("counted").to_pylist()
            part = b.column("part")[0].as_py() if b.num_rows else part
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([merge_runs(held)])], schema=schema)

    n = runs.select("slice").distinct().count()
    counted = runs.select("part", "counted", F.xxhash64("slice").alias("draw"))
    while True:
        n = -(-n // FAN)
        done = counted.groupBy("part", F.pmod("draw", F.lit(max(n, 1))).alias("salt")).applyInArrow(merge, TOTALS)
        if n <= 1:
            return done
        counted = materialise(done, "merged").withColumn("draw", F.xxhash64("counted"))


def align(docs: DataFrame, a_path: str, b_path: str, keep: dict[str, Column] | None = None) -> Aligned:
    """Groups and links of every row of ``docs`` (``doc_id, text``; other columns are not read), and the
    counts of the pairs over all rows.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of decimal ids; ``keep`` names the columns that are made
    of it instead. Null or empty texts, and texts whose tokens of a side do not spell a blank and the
    text, have no tokens: zeros and an empty text. Every row is a document of its own, also where rows
    or ids repeat or ids are null. An empty table gives none.
    """
    keep = keep or {"groups": F.col("groups")}
    spilled = _spill(docs, a_path, b_path)
    names = [c for c in spilled.columns if c != "groups"]
    spilled = materialise(spilled.select(*names, *[c.alias(n) for n, c in keep.items()]), "alignment")
    documents = spilled.filter("ord IS NOT NULL")
    runs = spilled.filter("part IS NOT NULL").select("slice", "part", "counted", "records", "n_bytes")
    totals = materialise(_totals(runs), "alignment-totals")

    # As many rows as there are partitions: the number of cells of each.
    cells = materialise(runs.groupBy("part").agg(
        F.ceil(F.sum("n_bytes") / CELL_BYTES).cast("int").alias("cells")), "alignment-cells")
    placed = runs.select("slice", "part", "records").join(F.broadcast(cells), "part").withColumn(
        "cell", F.pmod(F.xxhash64("slice"), F.col("cells")).cast("int"))
    copies = cells.select("part", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("beside"))
    beside = totals.join(F.broadcast(copies.withColumnRenamed("part", "of")), F.col("part") == F.col("of")).select(
        F.col("of"), "beside", "counted")
    back = arrow(BACK)

    def stream_back(held: pa.Table, counts: pa.Table) -> pa.Table:
        if not held.num_rows:
            return back.empty_table()
        known = unpack(counts.column("counted")[0].as_py())
        found = [contributions(r.as_py(), known) for r in held.column("records")]
        return pa.table([held.column("slice"), pa.array(found, pa.binary())], schema=back)

    streamed = placed.groupBy("part", "cell").cogroup(beside.groupBy("of", "beside")).applyInArrow(stream_back, BACK)
    sums = arrow(SUMS)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, found = None, []
        for b in batches:
            found += [unpack(x) for x in b.column("found").to_pylist()]
            number = b.column("slice")[0].as_py() if b.num_rows else number
        doc, best, total = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(doc, kind="stable")
        first = np.flatnonzero(np.diff(doc[order], prepend=-1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([number] * len(first), pa.int64()), pa.array(doc[order][first], pa.int32()),
             *(pa.array(np.add.reduceat(x[order], first)) for x in (best, total))], schema=sums)

    added = streamed.groupBy("slice").applyInArrow(add_up, SUMS)
    result = documents.join(added, ["slice", "ord"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *keep,
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")])
    return Aligned(result, _pairs(totals))


def _pairs(totals: DataFrame) -> DataFrame:
    schema = arrow(PAIRS)

    def read(batches):
        for rows in batches:
            for run in rows.column("counted").to_pylist():
                a, b, n, best = unpack(run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(n), pa.array(best == 1)], schema=schema)

    return totals.select("counted").mapInArrow(read, PAIRS)


def digest(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Counts of every document and a checksum of its groups; no checksum without tokens."""
    checksum = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align(docs, a_path, b_path, {"groups_sha256": checksum}).docs.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
