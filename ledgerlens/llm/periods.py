"""Periodic runs of words by online sparse diagonals.

A run is a stretch of words with smallest period q, at least ``max(least, TIMES * q)`` words long, that
no neighbouring word extends. On the diagonal of lag q it shows as a chain of words that equal the
word q before them. Words are taken in order; each one's earlier occurrence increments the match length
of its lag, and a diagonal that is not incremented has ended and emits its run at once if long enough.

Only diagonals that can become runs are kept. The chain of a run of period q has ``max(least - q,
(TIMES - 1) * q)`` words or more, so an occurrence counts only where a whole window of words before it
occurs there as well: windows of ``base`` words for lags up to ``base``, and of w words for lags of
w/2 + 1 to w. Of the earlier occurrences of a window the nearest is enough: inside a run of smallest
period q, windows of q words and more that were equal at a smaller lag would give the run a smaller
period. The nearest lag is never a multiple of the period either, so each run is emitted once. Naming
all windows takes a sort for each doubling, of those alone that occur again; a text of n words costs
n log n steps even where it is one word repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, slices, utf8

LEAST = 24
TIMES = 3
SLICE_BYTES = 1 << 20
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def _longer(names: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows ``step`` words longer, from the names of the windows that end at every place.

    ``names`` is -1 where a window occurs once. Returns the new names, the places whose new window
    occurs again, in order, and for each of them the distance to the occurrence before (0: none).
    """
    at = at[at >= step]
    at = at[names[at - step] >= 0]
    key = names[at - step] * (int(names.max(initial=0)) + 1) + names[at]
    order = np.argsort(key, kind="stable")
    key, place = key[order], at[order]
    same = np.zeros(len(key), dtype=bool)
    same[1:] = key[1:] == key[:-1]
    again = same.copy()
    again[:-1] |= same[1:]
    out = np.full(len(names), -1, dtype=np.int64)
    out[place[again]] = np.cumsum(~same)[again]
    lag = np.zeros(len(names), dtype=np.int64)
    lag[place[1:]] = np.where(same[1:], place[1:] - place[:-1], 0)
    at = np.sort(place[again])
    return out, at, lag[at]


def occurrences(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(place, lag, width)`` of the occurrences that count, in order of place and lag."""
    base = min(max(least - q, (TIMES - 1) * q) for q in range(1, least + 1))
    names, at, width, lags = ids.astype(np.int64), np.arange(len(ids)), 1, np.zeros(len(ids), np.int64)
    found = []
    while len(at):
        if width >= base:
            chosen = (lags > (0 if width == base else width // 2)) & (lags <= width)
            found.append((at[chosen], lags[chosen], np.full(int(chosen.sum()), width)))
        step = min(width, base - width) if width < base else width
        names, at, lags = _longer(names, at, step)
        width += step
    if not found:
        return at, at, at
    place, lag, wide = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((lag, place))
    return place[order], lag[order], wide[order]


def online_runs(ids: np.ndarray, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, each when its diagonal ends."""
    active: dict[int, list[int]] = {}  # lag: last word, match length

    def ended(before: int) -> Iterator[tuple[int, int, int]]:
        for lag in [q for q, (last, _) in active.items() if last < before]:
            last, matched = active.pop(lag)
            if matched + lag >= max(least, TIMES * lag):
                yield last + 1 - matched - lag, matched + lag, lag

    now = -1
    for place, lag, width in zip(*(x.tolist() for x in occurrences(ids, least))):
        if place != now:
            yield from ended(place - 1)
            now = place
        diagonal = active.get(lag)
        if diagonal is None or diagonal[0] != place - 1:
            active[lag] = [place, width]
        else:
            diagonal[0] = place
            diagonal[1] += 1
    yield from ended(len(ids))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words after the contract's rewriting: every tenth id, by its crc32, repeats from a word on."""
    import zlib

    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def _numbered(docs: list[list[bytes]]) -> np.ndarray:
    """Numbers of all words in turn; equal within a document only, so that no match crosses two."""
    out, base = [], 0
    for words in docs:
        known = {w: i for i, w in enumerate(dict.fromkeys(words), base)}
        out.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        base += len(known)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _found(rows: pa.RecordBatch, schema: pa.Schema, rewrite, least: int) -> pa.RecordBatch:
    ids = rows.column("doc_id").to_pylist()
    docs = [rewrite(i, t.split()) for i, t in zip(ids, rows.column("text").to_pylist())]
    starts = np.concatenate([[0], np.cumsum([len(w) for w in docs])]).astype(np.int64)
    runs = np.array(sorted((s, q, n) for s, n, q in online_runs(_numbered(docs), least)),
                    dtype=np.int64).reshape(-1, 3)
    kept = np.ones(int(starts[-1]), dtype=bool)
    for start, period, length in runs.tolist():
        kept[start + period:start + length] = False
    of = np.searchsorted(starts, runs[:, 0], side="right") - 1
    structs = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - starts[of]), pa.array(runs[:, 2]), pa.array(runs[:, 1])],
        fields=list(schema.field("runs").type.value_type))
    offsets = pa.array(np.searchsorted(of, np.arange(len(docs) + 1)), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, structs, type=schema.field("runs").type)
    texts = [
        b" ".join([w for w, k in zip(words, kept[a:b].tolist()) if k]) if hit else b" ".join(words)
        for words, a, b, hit in zip(docs, starts[:-1], starts[1:], np.diff(offsets.to_numpy()))
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(np.diff(starts)), lists, pa.array(texts, pa.binary())], schema=schema)


def find_runs(docs: DataFrame, rewrite=lambda doc_id, words: words, least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, its ``runs`` (by start, then period) and the
    ``collapsed`` text: the words, joined by a space, without those that a run contains after its first
    period.

    Whole texts; null, empty and blank texts have no words and no runs. Rows are taken as they come: a
    repeated row or id, or a null id, gives a row each time, an empty table none; other columns are not
    read. ``rewrite(doc_id, words)`` changes the words first.
    """
    schema = arrow(FOUND)

    def search(batches):
        for rows in batches:
            for part in slices(rows, "text", SLICE_BYTES):
                yield _found(part, schema, rewrite, least)

    return docs.select(F.col("doc_id").cast("long"), utf8(F.col("text")).alias("text")).mapInArrow(search, FOUND)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first. Null without runs."""
    def better(best, run):
        return F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)


def digest(docs: DataFrame, rewrite=planted) -> DataFrame:
    """Number of runs, the strongest one, and checksums of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = find_runs(docs, rewrite).withColumn("best", strongest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
