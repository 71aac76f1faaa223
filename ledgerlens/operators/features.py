"""Per-user feature table, one-hot columns and scaling."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import (
    fill_na_by_config,
    flag,
    seconds_between,
    whole_days_between,
)
from ledgerlens.operators.facts import user_facts
from ledgerlens.operators.fx import convert_to_usd_daily
from ledgerlens.session import materialise
from ledgerlens.settings import (
    CATEGORICAL_FEATURES,
    FILL_DEFAULT,
    FILL_TERMS_VERSION,
    LABEL,
    NUMERIC_FEATURES,
)
from ledgerlens.sources.files import scan_table_by_key


def min_created_date(users: DataFrame) -> DataFrame:
    return users.agg(F.min("created_date").alias("min_date"))


def days_since_min(
    df: DataFrame, column: str, name: str, min_date: dt.datetime | DataFrame | None = None
) -> DataFrame:
    """Whole days since the column's minimum, or since a given one.

    The minimum is a scalar subquery: one small aggregate, no window and no join.
    """
    if min_date is None:
        min_date = df.agg(F.min(column).alias("min_date"))
    start = min_date.scalar() if isinstance(min_date, DataFrame) else F.lit(min_date).cast("timestamp_ntz")
    return df.withColumn(name, whole_days_between(F.col(column), start))


def convert_users(users: DataFrame, min_date: dt.datetime | DataFrame | None = None) -> DataFrame:
    """Users with the creation date in days, text copy of the terms version and lock flag."""
    kept = users.withColumn("created_date_origin", F.col("created_date"))
    return (
        days_since_min(kept, "created_date", "created_date", min_date)
        .withColumn("terms_version_origin", F.date_format("terms_version", "yyyy-MM-dd"))
        .withColumn("is_lock", flag(F.col("state") == "LOCK"))
        .drop("state")
    )


def build_features(
    users: DataFrame, transactions_usd: DataFrame, min_date: dt.datetime | DataFrame | None = None
) -> DataFrame:
    """Feature table from users and transactions with USD amounts, before the fill."""
    facts = user_facts(transactions_usd)
    joined = convert_users(users, min_date).join(facts, F.col("id") == F.col("user_id"), "left")
    return joined.select(
        "id",
        flag(F.col("has_email")).alias("has_email"),
        "phone_country",
        "is_fraudster",
        "terms_version",
        "created_date",
        "country",
        "birth_year",
        "kyc",
        "failed_sign_in_attempts",
        "created_date_origin",
        "terms_version_origin",
        "is_lock",
        "first_amount",
        "first_date",
        flag(F.col("country") == "GB").alias("country_gb"),
        seconds_between("first_date", "created_date_origin").alias("diff_date"),
        flag(F.col("first_amount") > 0).alias("first_success"),
        "source_freq",
        "type_freq",
        "state_freq",
        flag(F.col("source_freq") == "MINOS").alias("source_minos"),
        flag(F.array_contains("merchant_countries", F.col("country"))).alias("is_user_country"),
        flag(F.col("user_id").isNotNull()).alias("has_transactions"),
        F.coalesce("cnt_currency", F.lit(0)).alias("cnt_currency"),
        "mean_amount",
    )


def fill_features(features: DataFrame) -> DataFrame:
    return fill_na_by_config(features, {"terms_version": FILL_TERMS_VERSION}, FILL_DEFAULT)


def user_feature_table(
    users: DataFrame,
    transactions: DataFrame,
    fx_rates: DataFrame,
    currency_details: DataFrame,
    min_date: dt.datetime | DataFrame | None = None,
) -> DataFrame:
    usd = convert_to_usd_daily(transactions, fx_rates, currency_details)
    return fill_features(build_features(users, usd, min_date))


def user_feature_table_by_key(
    users: DataFrame,
    transactions: DataFrame,
    fx_rates: DataFrame,
    currency_details: DataFrame,
    keys,
    min_date: dt.datetime | DataFrame,
) -> DataFrame:
    """Feature rows of the given users only, with the training minimum date."""
    return user_feature_table(
        scan_table_by_key(users, "id", keys),
        scan_table_by_key(transactions, "user_id", keys),
        fx_rates,
        currency_details,
        min_date,
    )


# --- model matrix --------------------------------------------------------------------------------

# The most values that may become columns of a plan. Any more go through ``category_dictionary``.
WIDE_VALUES = 10_000


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``(name, value)`` of the columns, found in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).where("value IS NOT NULL").distinct()


def categories(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted values of each categorical column.

    Each value is to become a column, so the values, and nothing else, reach the driver: at most
    ``WIDE_VALUES`` of them. With more this is refused, and ``one_hot_vector`` makes no columns.
    """
    rows = _values(df, columns).limit(WIDE_VALUES + 1).collect()
    if len(rows) > WIDE_VALUES:
        raise ValueError(f"more than {WIDE_VALUES} values in {columns}: use one_hot_vector")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for name, value in sorted(rows):
        found[name].append(value)
    return found


def one_hot_expressions(values: dict[str, list[str]]) -> dict[str, str]:
    """SQL text per one-hot column, named ``column_value``, values in sorted order."""
    out = {}
    for column, known in values.items():
        for v in known:
            quoted = v.replace("\\", "\\\\").replace("'", "\\'")
            out[f"{column}_{v}"] = (
                f"CASE WHEN CAST(`{column}` AS STRING) = '{quoted}' THEN 1 ELSE 0 END"
            )
    return out


def one_hot(
    df: DataFrame, columns: list[str], values: dict[str, list[str]] | None = None
) -> DataFrame:
    """Replace the columns by one 0/1 column per value; none is dropped."""
    values = values or categories(df, columns)
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    dummies = [f"{sql} AS `{name}`" for name, sql in one_hot_expressions(values).items()]
    return df.selectExpr(*kept, *dummies)


@dataclass(frozen=True)
class Dictionary:
    """``table`` has ``(name, value, at)``: the place of each value among the sorted ones of its column;
    ``sizes`` how many there are."""

    table: DataFrame
    sizes: dict[str, int]


def category_dictionary(df: DataFrame, columns: list[str]) -> Dictionary:
    """Numbers the values of categorical columns without bringing them together.

    The values are range-partitioned in order and numbered inside each part; the sizes of the parts
    give their offsets. The driver sees one number a column.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _values(df, columns).repartitionByRange(parts, "name", "value")
    # Written with the number of its part, which a second run might draw elsewhere.
    ranged = materialise(ranged.withColumn("part", F.spark_partition_id()), "categories")
    sizes = ranged.groupBy("name", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("name", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("name", "part").orderBy("value"))
    numbered = ranged.withColumn("pos", inside - 1).join(F.broadcast(offsets), ["name", "part"])
    table = materialise(numbered.select("name", "value", (F.col("offset") + F.col("pos")).alias("at")), "dictionary")
    found = {r["name"]: r.n for r in table.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Dictionary(table, {c: found.get(c, 0) for c in columns})


def one_hot_vector(df: DataFrame, columns: list[str], dictionary: Dictionary | None = None) -> DataFrame:
    """Each column replaced by a sparse vector with a place for every value in sorted order.

    For any number of values; NULL, and a value that the dictionary lacks, has a place of its own, the
    last one. The dictionary is joined: broadcast where its stored size allows, else by shuffle.
    """
    dictionary = dictionary or category_dictionary(df, columns)
    names = [f"_{c}_at" for c in columns]
    placed = df
    for c, name in zip(columns, names):
        mine = dictionary.table.where(F.col("name") == c).select(F.col("value").alias(f"_{c}_value"), F.col("at").alias(name))
        joined = placed.join(mine, F.col(f"`{c}`").cast("string") == F.col(f"_{c}_value"), "left").drop(f"_{c}_value")
        placed = joined.withColumn(name, F.coalesce(name, F.lit(dictionary.sizes[c])).cast("double"))
    # The encoder needs to see the last place only.
    last = df.sparkSession.createDataFrame([[float(dictionary.sizes[c]) for c in columns]], ", ".join(f"`{n}` double" for n in names))
    coder = OneHotEncoder(inputCols=names, outputCols=columns, dropLast=False).fit(last)
    return coder.transform(placed.drop(*columns)).drop(*names)


def align_columns(df: DataFrame, columns: list[str], fill: float = 0.0) -> DataFrame:
    """Exactly the training columns in their order; one that is missing gets the fill value."""
    have = set(df.columns)
    return df.select(
        *[F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in columns]
    )


def cast_features_double(df: DataFrame, columns: list[str]) -> DataFrame:
    wanted = set(columns)
    return df.select(
        *[F.col(f"`{c}`").cast("double").alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns]
    )


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of means and population deviations; a constant column divides by 1."""
    measures = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        spread = F.stddev_pop(value)
        measures += [
            F.avg(value).alias(f"m{i}"),
            F.when(F.min(value) == F.max(value), F.lit(1.0)).otherwise(spread).alias(f"s{i}"),
        ]
    return df.agg(*measures)


def standard_scale(df: DataFrame, columns: list[str], stats=None) -> DataFrame:
    """Z-scores with population deviation; pass ``stats`` (a row) to reuse an earlier fit."""
    row = stats or scaler_stats(df, columns).first()
    scaled = {
        c: (F.col(f"`{c}`").cast("double") - F.lit(row[f"m{i}"])) / F.lit(row[f"s{i}"])
        for i, c in enumerate(columns)
    }
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(f"`{c}`") for c in df.columns])


def model_matrix(features: DataFrame, values: dict[str, list[str]] | None = None) -> DataFrame:
    """``id``, the unscaled one-hot feature columns as doubles, and the 0/1 ``label``."""
    chosen = features.select(
        "id",
        *NUMERIC_FEATURES,
        *[F.col(c).cast("string").alias(c) for c in CATEGORICAL_FEATURES],
        flag(F.col(LABEL)).alias("label"),
    )
    wide = one_hot(chosen, CATEGORICAL_FEATURES, values)
    columns = [c for c in wide.columns if c not in ("id", "label")]
    return cast_features_double(wide, columns).select(
        "id", *[F.col(f"`{c}`") for c in columns], "label"
    )


def melt(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Long form ``(keys, feature, value)``."""
    return df.unpivot(
        [F.col(k) for k in keys], [F.col(f"`{c}`") for c in columns], "feature", "value"
    )
