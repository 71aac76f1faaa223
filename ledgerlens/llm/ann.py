"""Approximate nearest neighbours by a permutation index.

Every vector is known by its nearest pivots in order. The inverted file of a pivot posts the vectors
that have it among theirs, with its place. A query walks the files of its own pivots, which gives
every posted vector's footrule distance: the sum of the differences of places, where a pivot that
one side lacks stands at the end. The vectors with the least distance are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, batch
from ledgerlens.llm.vectors import (
    BLOCK_ROWS, QUERY_ROWS, best, by_first_id, copies_of, in_blocks, matrix, meetings, top_rows, usable,
)
from ledgerlens.session import materialise

# The more pivots share out a block's postings, the fewer of them a query reads with its own prefix.
PIVOTS = 512
PREFIX = 64
# Share of a block's vectors that is compared exactly, and the least number. At a full block the share
# decides, and the recall must hold there.
RERANK_SHARE = 0.12
RERANK_LEAST = 512

POSTINGS = "block int, pivot int, rows binary, places binary"
FOUND = "query_id long, vec_id long, score double"


def pick_pivots(vectors: DataFrame, pivots: int, seed: int) -> np.ndarray:
    """A bounded sample of ``pivots`` distinct vectors, chosen by a stable hash: the index's only fit."""
    rows = vectors.orderBy(F.xxhash64("vector", F.lit(seed)), "vector").limit(pivots).select("vector").collect()
    return np.array([r[0] for r in rows], dtype=np.float64)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots, nearest first: largest cosine, ties in the order to the smaller number."""
    unit = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)
    close = x @ unit.T
    if prefix == close.shape[1]:
        return np.argsort(-close, axis=1, kind="stable")
    some = np.sort(np.argpartition(-close, prefix - 1, axis=1)[:, :prefix], axis=1)
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(close, some, 1), axis=1, kind="stable"), 1)


def inverted_files(orders: np.ndarray, pivots: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``pivot, rows, places`` for every pivot that some row has among its nearest."""
    rows, places = np.indices(orders.shape)
    flat = orders.ravel()
    by_pivot = np.argsort(flat, kind="stable")
    cuts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
    rows, places = rows.ravel()[by_pivot].astype("<i4"), places.ravel()[by_pivot].astype("<i2")
    return [(p, rows[a:b], places[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def footrule(order: np.ndarray, files: dict, n_rows: int, prefix: int) -> np.ndarray:
    """Distance of every row of a block to a query with the given pivots, from inverted files alone.

    A row without any of the query's pivots is at the greatest distance. Pivots that only the row has
    cost what is left of its own places.
    """
    everything = prefix * (prefix + 1) // 2  # sum of (prefix - place) over all places
    met = [(place, *files[pivot]) for place, pivot in enumerate(order) if pivot in files]
    if not met:
        return np.full(n_rows, 2 * everything, dtype=np.int64)
    # Without a match both sides would pay (prefix - place); with it they pay the difference, which saves
    # twice what the later of the two places would pay.
    saved = np.concatenate([2 * (prefix - np.maximum(places, place)) for place, _, places in met])
    gain = np.bincount(np.concatenate([rows for _, rows, _ in met]), saved, n_rows)
    return 2 * everything - gain.astype(np.int64)


def nearest_rows(far: np.ndarray, n: int) -> np.ndarray:
    """Rows with the ``n`` least distances, and all that tie with the last of them."""
    if n >= len(far):
        return np.arange(len(far))
    edge = np.searchsorted(np.cumsum(np.bincount(far)), n)
    return np.flatnonzero(far <= edge)


def search(
    embeddings: DataFrame, every: int = 20, k: int = 20, pivots: int = PIVOTS, prefix: int = PREFIX,
    share: float = RERANK_SHARE, least: int = RERANK_LEAST, seed: int = 3,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of rows whose ``vec_id`` is divisible by ``every``.

    ``embeddings`` has ``vec_id, embedding``. Vectors that are null, zero, empty or hold null or
    non-finite components take no part, nor do rows without id; vectors of another length than a
    query's are not its candidates. Score is the inner product in double precision of the vectors as
    given. Equal vectors are indexed once and share their place, so a thousand copies cost one; the
    ``k + 1`` smallest ids of a copied vector are enough for every answer. Repeated rows are separate
    candidates except that a query's own id never answers it. Fewer candidates give fewer rows.
    """
    spark = embeddings.sparkSession
    clean = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable(F.col("vector"))).filter(F.exists("vector", lambda x: x != 0.0))
    rows = in_blocks(materialise(copies_of(clean, k + 1), "ann-vectors"), block_rows)
    asked = clean.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    queries = in_blocks(materialise(asked, "ann-queries"), QUERY_ROWS, "qblock")
    answers = None
    for (length,) in rows.select(F.size("vector")).distinct().collect():
        found = _search_length(
            rows.filter(F.size("vector") == length), queries.filter(F.size("vector") == length),
            k, pivots, prefix, share, least, seed)
        answers = found if answers is None else answers.unionByName(found)
    if answers is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return best(answers, k, "score")


def _search_length(rows, queries, k, pivots, prefix, share, least, seed):
    centres = pick_pivots(rows, pivots, seed)
    depth = min(prefix, len(centres))
    schema, out = arrow(POSTINGS), arrow(FOUND)

    def post(key, table):
        orders = nearest_pivots(matrix(by_first_id(table).column("vector")), centres, depth)
        lists = inverted_files(orders, len(centres))
        return pa.Table.from_batches([batch(
            schema, [key[0].as_py()] * len(lists), [p for p, _, _ in lists],
            [r.tobytes() for _, r, _ in lists], [s.tobytes() for _, _, s in lists])])

    index = materialise(rows.groupBy("block").applyInArrow(post, POSTINGS), "ann-postings")

    def answer(key, left, right):
        """``left``: a block's vectors and its inverted files; ``right``: a block of queries."""
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema=out)
        data = by_first_id(left.filter(pc.is_valid(left.column("ids"))))
        lists = left.filter(pc.is_null(left.column("ids")))
        files = {
            p.as_py(): (np.frombuffer(r.as_buffer(), "<i4"), np.frombuffer(s.as_buffer(), "<i2"))
            for p, r, s in zip(lists.column("pivot"), lists.column("rows"), lists.column("places"))}
        x, ids = matrix(data.column("vector")), data.column("ids").to_pylist()
        q, names = matrix(right.column("vector")), right.column("query_id").to_pylist()
        orders = nearest_pivots(q, centres, depth)
        n = min(len(x), max(least, k + 1, int(np.ceil(share * len(x)))))
        found: list[tuple] = []
        for i, name in enumerate(names):
            far = footrule(orders[i], files, len(x), depth)
            near = nearest_rows(far, n)
            found += top_rows(name, x[near] @ q[i], [ids[j] for j in near], k)
        columns = list(map(list, zip(*found))) if found else [[], [], []]
        return pa.Table.from_batches([batch(out, *columns)])

    stored = rows.select("block", "ids", "vector").unionByName(
        index.select("block", "pivot", "rows", "places"), allowMissingColumns=True)
    left, right = meetings(stored, queries)
    return left.cogroup(right).applyInArrow(answer, FOUND)
