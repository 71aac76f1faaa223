"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

A block of vectors is kept as one list a dimension, sorted by component. A query reads its lists in
parallel, from the end that its own component favours, scores every vector as it is first met, and
stops when the best that an unseen vector could score, the sum over the lists of the query's
component times the component read last, is below the k-th result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, batch
from ledgerlens.llm.vectors import (
    BLOCK_ROWS, QUERY_ROWS, best, by_first_id, copies_of, in_blocks, matrix, meetings, top_rows, usable,
)
from ledgerlens.session import materialise

FOUND = "query_id long, vec_id long, score long"
FIRST_DEPTH = 16


def exact_type(x: np.ndarray, q: np.ndarray):
    """The fastest number type in which no inner product is rounded or overflows."""
    most = int(np.abs(x.astype(object)).max(initial=0)) * int(np.abs(q.astype(object)).max(initial=0)) * max(1, x.shape[1])
    return np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


def sorted_lists(x: np.ndarray) -> np.ndarray:
    """``lists[0, d]``: rows in ascending order of component d; ``lists[1, d]``: in descending order."""
    rising = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
    return np.stack([rising, rising[:, ::-1]])


def threshold_search(x: np.ndarray, lists: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows met and their scores; every row not met scores below the k-th of these.

    The lists are read in steps that double, so the bound is tested a few times only. Where the
    components are alike and independent, rows are met in all lists long before the bound falls; the
    search then ends when no row is left to meet.
    """
    n = len(x)
    used = np.flatnonzero(q != 0)
    if not len(used):
        return np.arange(n), x @ q  # a query of zeros: everything scores zero
    way = (q[used] > 0).astype(np.int8)
    unmet = np.ones(n, dtype=bool)
    rows, scores = [], np.zeros(0, dtype=x.dtype)
    depth, before = min(FIRST_DEPTH, n), 0
    while True:
        reading = np.zeros(n, dtype=bool)
        reading[lists[way, used, before:depth].ravel()] = True
        new = np.flatnonzero(reading & unmet)
        unmet[new] = False
        rows.append(new)
        scores = np.concatenate([scores, x[new] @ q])
        bound = (x[lists[way, used, depth - 1], used] * q[used]).sum()
        if len(scores) == n or len(scores) >= k and np.partition(scores, len(scores) - k)[len(scores) - k] > bound:
            return np.concatenate(rows), scores
        before, depth = depth, min(2 * depth, n)


def search(
    embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of rows whose ``vec_id`` is divisible by ``every``.

    ``embeddings`` has ``vec_id, embedding``; components become ``floor(scale * x)`` and the score is
    the inner product of these integers, exact. Vectors that are null, empty or hold null or
    non-finite components take no part, nor do rows without id; vectors of another length than a
    query's are not its candidates; zero vectors count. Equal vectors are stored once with their
    ``k + 1`` smallest ids, which are enough for every answer. A query's own id never answers it;
    fewer candidates give fewer rows. A score beyond 64 bits is cut to the nearest 64-bit number.
    """
    clean = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(
        "vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("vector"))
    rows = in_blocks(materialise(copies_of(clean, k + 1), "topk-vectors"), block_rows)
    asked = clean.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    queries = in_blocks(materialise(asked, "topk-queries"), QUERY_ROWS, "qblock")
    out = arrow(FOUND)
    most, least = 2**63 - 1, -(2**63)

    def answer(key, left, right):
        found: list[tuple] = []
        lengths = np.array([len(v) for v in left.column("vector")]), np.array([len(v) for v in right.column("vector")])
        for length in np.intersect1d(*lengths):
            data, asked = (t.filter(pa.array(n == length)) for t, n in zip((left, right), lengths))
            data = by_first_id(data)
            x, q = matrix(data.column("vector"), np.int64), matrix(asked.column("vector"), np.int64)
            kind = exact_type(x, q)
            lists, ids = sorted_lists(x), data.column("ids").to_pylist()
            x, q = x.astype(kind), q.astype(kind)
            for name, one in zip(asked.column("query_id").to_pylist(), q):
                rows, scores = threshold_search(x, lists, one, k + 1)
                found += top_rows(name, scores, [ids[j] for j in rows], k)
        columns = list(map(list, zip(*found))) if found else [[], [], []]
        columns[2] = [min(max(int(s), least), most) for s in columns[2]]
        return pa.Table.from_batches([batch(out, *columns)])

    left, right = meetings(rows, queries)
    return best(left.cogroup(right).applyInArrow(answer, FOUND), k, "score")
