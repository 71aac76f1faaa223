"""Load job: raw files to clean tables: staged, checked while they are written, and swapped in."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.scalar import (
    clean_merchant_country,
    pair_base,
    pair_quote,
    project_declared,
    strip_leading_zeros,
)
from ledgerlens.settings import TABLE_COLUMNS, JobSettings, TableSettings
from ledgerlens.sources import schemas as S
from ledgerlens.sources.checks import column_rules
from ledgerlens.sources.files import drop_path, header_of, scan_csv, swap_table, write_table


# --- preparation, one function per table ---------------------------------------------------------

def prepare_currency_details(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnRenamed("currency", "ccy")
    return project_declared(renamed, TABLE_COLUMNS["currency_details"])


def prepare_users(raw: DataFrame, fraudsters: DataFrame) -> DataFrame:
    """Users plus the fraud label; the list may repeat a user."""
    listed = fraudsters.select(F.col("user_id").alias("id")).where("id IS NOT NULL").distinct()
    labelled = raw.join(listed.withColumn("_listed", F.lit(True)), "id", "left")
    labelled = labelled.withColumn("is_fraudster", F.coalesce("_listed", F.lit(False)))
    return project_declared(labelled, TABLE_COLUMNS["users"])


def country_dictionary(countries: DataFrame) -> DataFrame:
    """``(key, code2)`` from 3-letter and numeric codes.

    Rows with any NULL are left out; a numeric key beats a letter key. Where the file gives one key
    two codes the greatest is taken, as Spark rows have no file order.
    """
    known = countries.dropna("any").select(
        F.upper("code").alias("code2"), F.upper("code3").alias("code3"), "numcode"
    )
    letters = known.select(F.col("code3").alias("key"), "code2", F.lit(0).alias("priority"))
    numbers = known.select(
        F.col("numcode").cast("string").alias("key"), "code2", F.lit(1).alias("priority")
    )
    return (
        letters.unionByName(numbers)
        .groupBy("key")
        .agg(F.max(F.struct("priority", "code2")).alias("best"))
        .select("key", F.col("best.code2").alias("code2"))
    )


def merchant_country_to_code2(
    df: DataFrame, countries: DataFrame, column: str = "merchant_country"
) -> DataFrame:
    """Replace known codes by their 2-letter form; unknown ones stay as they are.

    The country file is stored, so Spark knows its size and broadcasts it by its own threshold.
    """
    codes = country_dictionary(countries)
    joined = df.withColumn("_key", strip_leading_zeros(column)).join(
        codes, F.col("_key") == F.col("key"), "left"
    )
    return joined.withColumn(column, F.coalesce("code2", "_key")).select(*df.columns)


def overlong_merchant_country(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count_if(F.length("merchant_country") > 3).alias("overlong"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def prepare_transactions(raw: DataFrame, countries: DataFrame) -> DataFrame:
    cleaned = raw.withColumn("merchant_country", clean_merchant_country("merchant_country"))
    mapped = merchant_country_to_code2(cleaned, countries)
    return project_declared(mapped, TABLE_COLUMNS["transactions"])


def prepare_fx_rates(sheet: DataFrame) -> DataFrame:
    """Wide sheet (time, then one column per pair) to one row per quote."""
    first, *pairs = sheet.columns
    return (
        sheet.withColumnRenamed(first, "ts")
        .unpivot("ts", pairs, "pair", "rate")
        .where("rate IS NOT NULL")
        .select(
            "ts",
            pair_base("pair").alias("base_ccy"),
            pair_quote("pair").alias("ccy"),
            F.abs("rate").alias("rate"),
        )
    )


# --- raw files -> prepared table -----------------------------------------------------------------

def _load_users(spark: SparkSession, t: TableSettings) -> DataFrame:
    return prepare_users(
        scan_csv(spark, t.file, S.RAW_USERS, t.sep),
        scan_csv(spark, t.extra_file, S.RAW_FRAUDSTERS, t.sep),
    )


def _load_transactions(spark: SparkSession, t: TableSettings) -> DataFrame:
    return prepare_transactions(
        scan_csv(spark, t.file, S.RAW_TRANSACTIONS, t.sep),
        scan_csv(spark, t.extra_file, S.RAW_COUNTRIES, t.sep),
    )


def _load_currency_details(spark: SparkSession, t: TableSettings) -> DataFrame:
    return prepare_currency_details(scan_csv(spark, t.file, S.RAW_CURRENCIES, t.sep))


def _load_fx_rates(spark: SparkSession, t: TableSettings) -> DataFrame:
    first, *pairs = header_of(spark, t.file, t.sep)
    schema = T.StructType(
        [T.StructField(first, T.TimestampNTZType())]
        + [T.StructField(p, T.DoubleType()) for p in pairs]
    )
    return prepare_fx_rates(scan_csv(spark, t.file, schema, t.sep))


LOADERS: dict[str, Callable[[SparkSession, TableSettings], DataFrame]] = {
    "users": _load_users,
    "transactions": _load_transactions,
    "currency_details": _load_currency_details,
    "fx_rates": _load_fx_rates,
}


# --- stage, check, publish -----------------------------------------------------------------------

_RECONCILED = "table_name string, loaded long, expected long, ok boolean, violations long"


class ConstraintViolation(ValueError):
    """Prepared rows that a table's rules refuse: ``(table, column, rule, violations)``."""

    def __init__(self, found: list[tuple[str, str, str, int]]):
        super().__init__("; ".join(f"{t}.{c}: {n} x {rule}" for t, c, rule, n in found))
        self.found = found


@dataclass(frozen=True)
class Staged:
    """A table written beside the one it is to replace, with what was seen on the way."""

    name: str
    path: str
    staged: str
    expected: int
    loaded: int
    violations: list[tuple[str, str, str, int]]

    @property
    def ok(self) -> bool:
        return self.loaded == self.expected and not self.violations


def stage(prepared: DataFrame, name: str, path: str) -> Staged:
    """Writes the prepared rows to a staging folder.

    The rows and the violations of every column rule are counted by the write itself; the keys by one
    aggregate over the stored key columns, which also counts the stored rows.
    """
    spark, table = prepared.sparkSession, S.TABLES[name]
    seen = Observation()
    rules = column_rules(table)
    counted = [m.alias(f"r{i}") for i, (_, _, m) in enumerate(rules)]
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    write_table(prepared.observe(seen, F.count(F.lit(1)).alias("n"), *counted), staged)
    found = [(name, column, rule, int(seen.get[f"r{i}"])) for i, (column, rule, _) in enumerate(rules)]
    stored = spark.read.schema(prepared.schema).parquet(staged)
    keys = stored.groupBy(*table.primary_key).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count_if(F.col("count") > 1).alias("repeated")).first()
    found.append((name, "+".join(table.primary_key), "primary_key", int(keys.repeated)))
    return Staged(name, path, staged, int(seen.get["n"]), int(keys.n), [f for f in found if f[3]])


def publish(spark: SparkSession, tables: list[Staged]) -> None:
    """Swaps in all staged tables, if all of them are whole and clean; else refuses all of them and
    leaves the published ones as they are."""
    bad = [v for t in tables for v in t.violations]
    bad += [(t.name, "*", "stored rows", abs(t.expected - t.loaded)) for t in tables if t.loaded != t.expected]
    for t in tables:
        if bad:
            drop_path(spark, t.staged)
        else:
            swap_table(spark, t.staged, t.path)
    if bad:
        raise ConstraintViolation(bad)


def _reconciled(t: Staged) -> tuple:
    return t.name, t.loaded, t.expected, t.loaded == t.expected, sum(v[3] for v in t.violations)


def reconcile_counts(prepared: DataFrame, name: str, path: str) -> DataFrame:
    """Stages, checks and publishes one table; one row of stored and prepared rows."""
    spark = prepared.sparkSession
    staged = stage(prepared, name, path)
    publish(spark, [staged])
    return spark.createDataFrame([_reconciled(staged)], _RECONCILED)


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def load_all_tables(spark: SparkSession, settings: JobSettings) -> DataFrame:
    """Load the tables marked for it, only count the others; one row per table.

    All tables are staged and checked before the first is published: a file with rows that the rules of
    its table refuse stops the load with ``ConstraintViolation``, and nothing has changed.
    """
    staged, rows = [], []
    for name, table in settings.tables.items():
        path = f"{settings.warehouse}/{name}"
        if table.insert or settings.insert_all:
            staged.append(stage(LOADERS[name](spark, table), name, path))
            rows.append(_reconciled(staged[-1]))
        else:
            rows.append((name, spark.read.parquet(path).count(), None, None, None))
    publish(spark, staged)
    return spark.createDataFrame(rows, _RECONCILED)
