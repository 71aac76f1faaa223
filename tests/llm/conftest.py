import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet, " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns that clash."""
    rows = [
        (1, "a b c", "en", "s1"), (2, None, None, None), (3, "", "de", "s1"), (4, LONG, "en", "s2"),
        (5, " \t\n ", "fr", None), (6, "a b c", "en", "s1"), (6, "a b c", "en", "s1"), (None, "x y z w v u", "en", "s2"),
        (7, "Straße ÜBER naïve <|endoftext|> don't", "de", "s3"), (8, "1234 5678 !!! ---", None, "s3"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumn("n_chars", F.length("text").cast("long")).withColumns(
        {c: F.lit(1) for c in ("_weight_", "size", "target", "rank", "n", "digest", "name", "key", "component_id", "piece")})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
