"""Exploration tables: contingency tables, box-plot statistics, correlations, profiles."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import pct_round
from ledgerlens.operators.ranking import magnitude_bucket, running_count
from ledgerlens.session import broadcast_if_small, materialise

# Fixed value: name of the margin of a contingency table.
ALL = "All"

# Fixed values of the box plot: quartiles and whisker length.
QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5


# --- contingency tables --------------------------------------------------------------------------

def crosstab_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    """``(row_value, col_value, margin, n)`` with margins named All; missing cells are absent.

    ``margin`` tells them from real values of that name: 0 a cell, 1 summed over the column values,
    2 over the row values, 3 over both. The data are counted once; the margins come from the small
    table of counts.
    """
    cells = (
        df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(F.col(row).cast("string").alias("row_value"), F.col(col).cast("string").alias("col_value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        cells.cube("row_value", "col_value")
        .agg(F.grouping_id().cast("int").alias("margin"), F.sum("n").alias("total"))
        .select(
            F.when(F.col("margin") >= 2, ALL).otherwise(F.col("row_value")).alias("row_value"),
            F.when(F.col("margin") % 2 == 1, ALL).otherwise(F.col("col_value")).alias("col_value"),
            "margin",
            F.col("total").alias("n"),
        )
    )


def _shares(df: DataFrame, row: str, col: str) -> DataFrame:
    """Share of each column value within its row, the All row included."""
    counts = crosstab_counts(df, row, col).where(F.col("margin") % 2 == 0)
    within = Window.partitionBy("row_value", "margin")
    return counts.withColumn("share", F.col("n") / F.sum("n").over(within))


def crosstab_row_pct(df: DataFrame, row: str, col: str) -> DataFrame:
    return _shares(df, row, col).select("row_value", "col_value", pct_round("share").alias("pct"))


def crosstab_wide(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts with one column per value of ``col`` found in the data, plus All; a missing cell is 0.

    Where a value is called All, the margin's column is All_.
    """
    counts = materialise(crosstab_counts(df, row, col), "crosstab")
    values = sorted(r[0] for r in counts.where("margin = 0").select("col_value").distinct().collect())
    total = ALL
    while total in values:
        total += "_"
    named = F.when(F.col("margin") % 2 == 1, total).otherwise(F.col("col_value"))
    return (
        counts.withColumn("_named", named)
        .groupBy("row_value", (F.col("margin") >= 2).alias("_margin"))
        .pivot("_named", [*values, total])
        .agg(F.sum("n"))
        .fillna(0)
        .drop("_margin")
    )


def eda_categorical(df: DataFrame, column: str, by: str = "is_fraudster") -> DataFrame:
    """Counts and row percentages of ``column`` by the fraud flag, in long form."""
    return _shares(df, by, column).select(
        "row_value", "col_value", "n", pct_round("share").alias("pct")
    )


# --- box plot ------------------------------------------------------------------------------------

def quartiles(counts: DataFrame, groups: list[str], value: str, n: str) -> DataFrame:
    """Exact quartiles per group, linear interpolation, from distinct values with counts.

    The values are ranked in magnitude buckets on all tasks, so no task ever holds a whole group.
    """
    ranked = running_count(counts, groups, value, n, magnitude_bucket(value))
    below = F.col("upto") - F.col(n)

    def at(rank: Column) -> Column:
        return F.max(F.when((below <= rank) & (rank < F.col("upto")), F.col(value)))

    last = (F.col("total") - 1).cast("double")
    measures = [F.max("total").alias("n")]
    for i, p in enumerate(QUARTILES, 1):
        measures += [
            at(F.floor(last * p)).alias(f"lo{i}"),
            at(F.ceil(last * p)).alias(f"hi{i}"),
            F.max(last * p - F.floor(last * p)).alias(f"part{i}"),
        ]
    picked = ranked.groupBy(*groups).agg(*measures)
    between = [
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(q)
        for i, q in enumerate(("q1", "median", "q3"), 1)
    ]
    return picked.select(*groups, "n", *between)


def boxplot_stats(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Per group: count, quartiles, whisker ends (last value within 1.5 IQR), outlier count."""
    keep = F.col(value).isNotNull()
    for g in groups:
        keep = keep & F.col(g).isNotNull()
    counts = materialise(
        df.where(keep)
        .groupBy(*groups, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("weight")),
        "boxplot",
    )
    box = materialise(quartiles(counts, groups, "value", "weight"), "quartiles")
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(broadcast_if_small(box), groups)
        .groupBy(*groups, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("weight"))), F.lit(0)).alias("outliers"),
        )
    )


def boxplot_stats_approx(df: DataFrame, groups: list[str], value: str, accuracy: int = 10000) -> DataFrame:
    """Count and quartiles only, from a bounded sketch in one pass: for a quick look."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups)
        .agg(
            F.count(value).alias("n"),
            F.percentile_approx(value, list(QUARTILES), accuracy).alias("q"),
        )
        .select(
            *groups, "n",
            F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
        )
    )


# --- slices --------------------------------------------------------------------------------------

def range_slices(features: DataFrame) -> DataFrame:
    """The amount and delay slices of the exploration as one bucket column each."""
    first, mean, delay = F.col("first_amount"), F.col("mean_amount"), F.col("diff_date")
    return features.select(
        "id",
        F.when(first < 100, "small").when(first > 100, "big").alias("first_amount_slice"),
        F.when((first > 0) & (first < 100), "yes").otherwise("no").alias("first_amount_0_100"),
        F.when(mean < 1000, "small").when(mean >= 1000, "big").alias("mean_amount_slice"),
        F.when(delay < 1000, "fast").when(delay > 1000, "slow").alias("diff_date_slice"),
    )


# --- correlation and profile ---------------------------------------------------------------------

def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("boolean", "integer", "long", "double", "float", "short", "byte")
    return [f.name for f in df.schema if f.dataType.typeName() in kinds]


def _pair_corr(a: str, b: str) -> Column:
    """Correlation over the rows that have both values; NULL where one of them is constant."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation ``(a, b, corr)`` of all pairs with a <= b, pairwise complete.

    A constant column has no correlation: NULL. Columns without NULLs share one pass over the rows
    that adds up the matrix of products; only pairs with a gap are aggregated one by one.
    """
    columns = sorted(columns or numeric_columns(df))
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    numbers = materialise(numbers, "numbers")
    filled = numbers.agg(F.count(F.lit(1)).alias("*"), *[F.count(c).alias(c) for c in columns]).first()
    whole = [c for c in columns if filled[c] == filled["*"]]
    found: dict[tuple[str, str], float | None] = {}
    if len(whole) > 1 and filled["*"] > 1:
        vectors = VectorAssembler(inputCols=whole, outputCol="v").transform(numbers)
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
        spread = numbers.agg(*[(F.min(c) < F.max(c)).alias(c) for c in whole]).first()
        for i, a in enumerate(whole):
            for j in range(i, len(whole)):
                known = spread[a] and spread[whole[j]]
                found[a, whole[j]] = float(matrix[i, j]) if known else None
    pairs = list(combinations_with_replacement(columns, 2))
    gaps = [p for p in pairs if p not in found]
    if gaps:
        row = numbers.agg(*[_pair_corr(a, b).alias(f"{a}|{b}") for a, b in gaps]).first()
        found |= {(a, b): row[f"{a}|{b}"] for a, b in gaps}
    return df.sparkSession.createDataFrame(
        [(a, b, found[a, b]) for a, b in pairs], "a string, b string, corr double"
    )


def profile_table(df: DataFrame) -> DataFrame:
    """Row count, non-null count and type per column, one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("*"), *[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    return counted.unpivot(["*"], df.columns, "column_name", "non_null").select(
        "column_name", F.col("`*`").alias("n_rows"), "non_null",
        types[F.col("column_name")].alias("type"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def head(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.orderBy(key).limit(n)
