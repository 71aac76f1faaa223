"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import langid, mixing, neardup, packing, suffixes
from ledgerlens.llm.common import n_words
from ledgerlens.session import materialise, settled  # noqa: F401  materialise is for callers that write a stage

# A text whose code is longer than eight bits a byte is in no learned language: plain bytes are shorter.
MOST_BITS = 8.0
PASSAGE_WORDS = 51


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; ``lang`` becomes the predicted one."""
    models = langid.fit(docs, langid.held_out_column())
    found = langid.identify(docs, models).filter(
        (F.col("predicted.lang") != langid.UNKNOWN) & (F.col("predicted.bits") <= MOST_BITS))
    return found.withColumn("lang", F.col("predicted.lang")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates.

    Of rows that repeat an id one is kept; rows without id stay.
    """
    found = neardup.near_duplicates(docs.select("doc_id", "text"))
    keep = found.filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    first = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).join(keep, "doc_id", "left_semi")
    return first.unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of over 50 words that repeat out of the texts; a character that a cut goes through goes with it."""
    found = suffixes.repeated_words(docs, PASSAGE_WORDS)
    left = F.decode(suffixes.cut_out(F.col("text"), F.col("removed"), characters=True), "UTF-8")
    text = F.when(F.size("removed") > 0, left).otherwise(F.decode("text", "UTF-8"))
    return found.withColumn("text", text).withColumn(
        "n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents, or leaves them out, so that the sources meet their target weights.

    Every row counts by itself, also where ids are null or repeat. Rows that are equal in all columns
    share what is taken of them as evenly as it goes. Null and empty texts are not taken, null sources
    are one source, an empty table gives none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    names = docs.columns
    rows = docs.withColumn("_row", F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]))))
    mixed = mixing.mix(mixing.with_quality(rows, labels, keep=("_row",)), keep=("_row",))
    times = mixed.groupBy(F.col("_row").alias("_taken")).agg(
        F.count(F.lit(1)).alias("_equal"), F.sum(F.try_divide("taken", "size")).cast("long").alias("_times")).filter("_times > 0")
    taken = rows.join(times, F.col("_row") == F.col("_taken"))
    place = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    each = F.expr("_times DIV _equal") + F.when(place <= F.col("_times") % F.col("_equal"), 1).otherwise(0)
    counted = taken.withColumn("_each", each.cast("int")).filter("_each > 0")
    return counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_each")))).select(
        *[F.col(f"`{c}`") for c in names])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts documents into sequences and places them in length buckets and batches."""
    return packing.pack(docs.select("doc_id", n_words(F.col("text")).alias("n_words")), "n_words")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Code lengths, signatures and dynamic programming have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
