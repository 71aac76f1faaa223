"""Row numbers and running totals over a whole table, without an un-partitioned window.

The rows are cut into buckets by a monotone function of the order, each bucket is numbered on its
own task, and the bucket's start is added. Only the list of buckets, whose length is fixed by the
bucket function, ever meets in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stable_hash(key: Column | str, seed: int | str) -> Column:
    """Hex text that depends only on the key and the seed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def unit_interval(hash_text: Column) -> Column:
    """First eight hex digits of a stable hash as a number in [0, 1)."""
    return F.conv(F.substring(hash_text, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _with_offsets(
    df: DataFrame, cut: DataFrame, groups: list[str], weight: Column
) -> DataFrame:
    """Adds ``_offset`` (weight of the earlier buckets of the group) and ``_total`` (of the group).

    ``df`` is already laid out by group and bucket, so the join moves only the short bucket list.
    """
    sizes = cut.groupBy(*groups, "_bucket").agg(F.sum(weight).alias("_size"))
    group = Window.partitionBy(*[F.col(g) for g in groups]) if groups else Window.partitionBy(F.lit(0))
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(group).alias("_total"),
    )
    match = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return df.join(offsets, match).drop("_b", *[f"_g{i}" for i in range(len(groups))])


def global_row_number(
    df: DataFrame, groups: list[str], bucket: Column, order: list, name: str = "rn",
    total: str | None = None,
) -> DataFrame:
    """``row_number() over (partition by groups order by order)``, spread over all tasks.

    ``bucket`` must never decrease along ``order``. ``total`` names a column for the group size.
    """
    cut = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    placed = _with_offsets(cut.withColumn("_pos", F.row_number().over(inside)), cut, groups, F.lit(1))
    out = placed.withColumn(name, (F.col("_offset") + F.col("_pos")).cast("long"))
    if total:
        out = out.withColumn(total, F.col("_total").cast("long"))
    return out.drop("_bucket", "_pos", "_offset", "_total")


def hash_row_number(
    df: DataFrame, groups: list[str], key: str, seed: int, name: str = "rn", total: str | None = None
) -> DataFrame:
    """Row number in the order of a stable hash of the key: a repeatable shuffle."""
    hashed = df.withColumn("_hash", stable_hash(key, seed))
    bucket = F.substring("_hash", 1, 3)  # 4,096 even buckets, monotone in the text order
    return global_row_number(hashed, groups, bucket, ["_hash", key], name, total).drop("_hash")


def first_by_hash(
    df: DataFrame, group: str, key: str, seed: int | str, wanted: Column, name: str
) -> DataFrame:
    """Adds boolean ``name``: whether a row is among the first ``wanted`` of its group in the order of
    a stable hash of the key. ``wanted`` may use ``_of``, the size of the group.

    Rows are counted per hash bucket, only the bucket in which the count is reached is ranked, and the
    last row taken becomes the group's limit: all other rows are decided in the scan, unshuffled.
    Rows that repeat a key stay together, on the side of their first one.
    """
    hashed = df.select(
        F.col(group).alias("_group"), F.col(key).alias("_key"), stable_hash(key, seed).alias("_hash")
    ).withColumn("_bucket", F.substring("_hash", 1, 3))
    sizes = hashed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy("_group")
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (
        sizes.withColumn("_upto", F.sum("_size").over(upto))
        .withColumn("_of", F.sum("_size").over(whole))
        .withColumn("_rank", wanted - (F.col("_upto") - F.col("_size")))
        .where("_rank BETWEEN 1 AND _size")
        .select(F.col("_group").alias("_g"), F.col("_bucket").alias("_b"), "_rank")
    )
    here = F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_bucket") == F.col("_b"))
    # One row per group on the small side of both joins.
    in_order = Window.partitionBy("_group").orderBy("_hash", "_key")
    limits = (
        hashed.join(F.broadcast(edge), here)
        .withColumn("_rn", F.row_number().over(in_order))
        .where("_rn = _rank")
        .select(F.col("_group").alias("_g"), F.struct("_hash", "_key").alias("_limit"))
    )
    at = F.struct(stable_hash(key, seed).alias("_hash"), F.col(key).alias("_key"))
    placed = df.join(F.broadcast(limits), F.col(group).eqNullSafe(F.col("_g")), "left")
    return placed.withColumn(name, F.coalesce(at <= F.col("_limit"), F.lit(False))).drop("_g", "_limit")


def running_count(
    counts: DataFrame, groups: list[str], value: str, n: str, bucket: Column
) -> DataFrame:
    """For distinct ``(groups, value)`` rows with count ``n``: adds ``upto`` (rows with a value not
    above this one) and ``total`` (rows of the group)."""
    cut = counts.withColumn("_bucket", bucket)
    inside = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = _with_offsets(cut.withColumn("_run", F.sum(n).over(inside)), cut, groups, F.col(n))
    return placed.select(
        *counts.columns,
        (F.col("_offset") + F.col("_run")).cast("long").alias("upto"),
        F.col("_total").cast("long").alias("total"),
    )


def magnitude_bucket(value: Column | str) -> Column:
    """Sign and logarithm cut into steps of 0.4 %: monotone, and few enough for one window."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * 256).cast("long")
