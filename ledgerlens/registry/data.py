"""Fixture tables of one run, built on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import facts, features, fx
from ledgerlens.session import materialise, scratch_path
from ledgerlens.sources import fixtures


class Data:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def users(self) -> DataFrame:
        return fixtures.users(self.spark, self.sf_dir)

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return fixtures.raw_transactions(self.spark, self.sf_dir)

    @cached_property
    def transactions(self) -> DataFrame:
        return fixtures.transactions(self.spark, self.sf_dir)

    @cached_property
    def fx_rates(self) -> DataFrame:
        return fixtures.fx_rates(self.spark, self.sf_dir)

    @cached_property
    def fx_wide(self) -> DataFrame:
        return fixtures.fx_wide(self.spark, self.sf_dir)

    @cached_property
    def currency_details(self) -> DataFrame:
        return fixtures.currency_details(self.spark)

    @cached_property
    def countries(self) -> DataFrame:
        return fixtures.countries(self.spark)

    @cached_property
    def fraudsters(self) -> DataFrame:
        return fixtures.fraudsters(self.spark, self.sf_dir)

    @cached_property
    def transactions_usd(self) -> DataFrame:
        return fx.convert_to_usd_daily(self.transactions, self.fx_rates, self.currency_details)

    @cached_property
    def enriched(self) -> DataFrame:
        return facts.enrich_transactions(self.transactions_usd, self.users)

    @cached_property
    def features(self) -> DataFrame:
        """The per-user feature table; the mean amount is rounded for the comparison with SQL."""
        table = features.fill_features(features.build_features(self.users, self.transactions_usd))
        return table.withColumn("mean_amount", F.round("mean_amount", 6))

    @cached_property
    def stored_features(self) -> DataFrame:
        """The feature table written once, for queries that scan it more than once."""
        return materialise(self.features, "features")

    @cached_property
    def scored(self) -> DataFrame:
        """Every user with the fixed score of FIXTURES.md."""
        score = F.expr("CAST(id * 37 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)")
        return self.users.select("id", F.col("is_fraudster").cast("int").alias("label")).select(
            "id", "label", score.alias("score"), (score >= 0.5).cast("double").alias("prediction")
        )

    @cached_property
    def points(self) -> DataFrame:
        """Every user as a labelled two-dimensional point."""
        return self.spark.read.parquet(f"{self.sf_dir}/customer.parquet").selectExpr(
            "c_custkey AS id",
            "CAST(c_custkey % 101 AS DOUBLE) AS x1",
            "c_acctbal AS x2",
            "CAST(c_acctbal < 0 AS INT) AS label",
        )

    def path(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def csv(self, df: DataFrame, name: str) -> str:
        """``df`` written as CSV with an upper-case header; returns the folder."""
        path = self.path(name)
        write_raw_csv(df, path)
        return path


def write_raw_csv(df: DataFrame, path: str) -> None:
    """CSV as a raw file would come: mixed-case header, blanks kept."""
    df.toDF(*[c.upper() for c in df.columns]).write.options(
        header=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss",
    ).csv(path)
