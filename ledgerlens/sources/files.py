"""Scans, writes and table replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.scalar import nan_to_null, normalize_columns

# Texts read as a missing value from raw files.
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a delimited file, lower-cased; reads one line."""
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    return [n.lower() for n in names]


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a line has an odd number of quotes, that is a quoted cell goes on in the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", quoted_breaks: bool | None = None
) -> DataFrame:
    """Delimited file with a header row, typed by column **name** from ``schema``.

    The header decides the order of the cells and may hold columns the schema lacks; those are not
    kept. Files are split at line ends and read in many tasks; where quoted cells hold line breaks
    (``quoted_breaks``; found by a look at the lines when it is not given) a file is one task. Cells are
    read as text, missing-value texts become NULL, and then each is cast once, so a
    cell that does not fit its type fails the job instead of vanishing.
    """
    raw = normalize_columns(
        spark.read.option("header", True)
        .option("sep", sep)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", has_quoted_breaks(spark, path) if quoted_breaks is None else quoted_breaks)
        .csv(path)
    )
    typed = []
    for f in schema:
        cell = F.when(~F.col(f"`{f.name}`").isin(NULL_TEXTS), F.col(f"`{f.name}`"))
        if isinstance(f.dataType, T.IntegerType | T.LongType):
            # A column with gaps may have been exported as 840.0.
            cell = F.regexp_replace(cell, r"\.0+$", "")
        typed.append(cell.cast(f.dataType).alias(f.name))
    return nan_to_null(raw.select(*typed))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``; the commit is all or nothing."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The file system of a path and the path, as Spark itself sees them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def swap_table(spark: SparkSession, staged: str, path: str) -> None:
    """Puts a staged table in the place of the table at ``path`` by renaming; the old one goes last.

    A run that ends between the two renames leaves the old table under ``path`` with ``.old`` behind it.
    """
    files, new = _file_system(spark, staged)
    _, here = _file_system(spark, path)
    _, old = _file_system(spark, f"{path}.old")
    if files.exists(here):
        files.delete(old, True)
        if not files.rename(here, old):
            raise OSError(f"cannot move {path} away")
    if not files.rename(new, here):
        raise OSError(f"cannot publish {path}")
    files.delete(old, True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this run has written."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def replace_table(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Replace a catalog table, or create it."""
    df.write.format("parquet").mode("overwrite").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Empty table unless it is there already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def drop_all(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        drop_table(spark, name)


def create_all(spark: SparkSession, schemas: dict[str, T.StructType]) -> None:
    for name, schema in schemas.items():
        create_table(spark, name, schema)


def scan_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], **options) -> DataFrame:
    """Same scan over a database; pass partitionColumn, lowerBound, upperBound and numPartitions."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)


def scan_table_by_key(df: DataFrame, key: str, keys) -> DataFrame:
    """Rows of one key, or of a DataFrame of keys (first column), by filter or semi join."""
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
        return df.join(wanted, key, "left_semi")
    return df.where(F.col(key) == F.lit(keys))


def run_sql_file(spark: SparkSession, path: str, views: dict[str, DataFrame]) -> DataFrame:
    """Run the text of a .sql file over the given tables."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    text = "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    return spark.sql(text)
