"""Vector columns for the searches: clean rows, blocks of candidates, query blocks, merged answers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Vectors of one candidate block; a block and one block of queries are all that a task holds.
BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def copies_of(clean: DataFrame, keep: int) -> DataFrame:
    """``vector`` and the ``keep`` smallest of its ids, ascending: one row a distinct vector.

    Ids are first cut down inside salted groups, so a vector that fills the table is spread out.
    """
    order = Window.partitionBy("vector", "_salt").orderBy("vec_id")
    few = clean.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn(
        "_n", F.row_number().over(order)).filter(F.col("_n") <= keep)
    return few.groupBy("vector").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, keep).alias("ids"))


def in_blocks(df: DataFrame, rows: int, block: str = "block") -> DataFrame:
    """Deals the rows of a written table into even blocks of about ``rows`` by a hash of their content."""
    n = max(1, -(-df.count() // rows))
    return df.withColumn(block, F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int"))


def meetings(rows: DataFrame, queries: DataFrame) -> tuple:
    """Groups ``(block, qblock)`` of both sides: the stated query set against all rows, in blocks.

    What is broadcast are the numbers of the blocks alone.
    """
    left = rows.crossJoin(F.broadcast(queries.select(F.col("qblock").alias("asked")).distinct()))
    right = queries.crossJoin(F.broadcast(rows.select(F.col("block").alias("stored")).distinct()))
    return left.groupBy("block", "asked"), right.groupBy("stored", "qblock")


def by_first_id(table: pa.Table) -> pa.Table:
    """A block's vectors in the order of their smallest id: the order that an index counts in."""
    return table.take(pc.sort_indices(pc.list_element(table.column("ids"), 0)))


def top_rows(name: int, scores: np.ndarray, ids: list, k: int) -> list[tuple]:
    """``(query, vec_id, score)`` of the k best ids but the query's own; ties to the smaller id.

    ``ids[i]`` are the smallest ids of a vector; the k + 1 best vectors hold every answer but for
    ties, so all vectors that reach the last of them are looked at.
    """
    if len(scores) > k + 1:
        edge = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    found = sorted((-scores[i], v) for i in keep for v in ids[i] if v != name)[:k]
    return [(name, v, -s) for s, v in found]


def matrix(column, dtype=np.float64) -> np.ndarray:
    """An Arrow list column as rows of one matrix; all lists have the same length."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(array), -1)


def best(found: DataFrame, k: int, score: str) -> DataFrame:
    """The ``k`` best of each query over all blocks, ranked; ties to the smaller ``vec_id``."""
    order = Window.partitionBy("query_id").orderBy(F.col(score).desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score)
