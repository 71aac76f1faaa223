"""Plans: filters reach the scan, only needed columns are read, no pair joins, hot keys are split."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from ledgerlens.operators import facts, fx
from ledgerlens.plans.report import users_first_tx_over_10usd
from ledgerlens.registry.data import Data
from ledgerlens.session import materialise
from ledgerlens.sources import files


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    d = Data(spark, sf_dir)
    return {n: materialise(getattr(d, n), n) for n in ("users", "transactions", "fx_rates", "currency_details")}


def test_report_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(users_first_tx_over_10usd(stored["transactions"], stored["fx_rates"], stored["currency_details"]))
    assert "EqualTo(type,CARD_PAYMENT)" in plan and "EqualTo(state,COMPLETED)" in plan
    assert "merchant_country" not in plan and "entry_method" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_daily_conversion_does_not_shuffle_transactions(stored):
    df = fx.convert_to_usd_daily(stored["transactions"], stored["fx_rates"], stored["currency_details"])
    plan = plan_of(df)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_key_filter_is_pushed(stored):
    plan = plan_of(files.scan_table_by_key(stored["transactions"], "user_id", 7))
    assert "EqualTo(user_id,7)" in plan


def test_base_currency_filter_is_pushed(stored):
    assert "EqualTo(base_ccy,USD)" in plan_of(fx.daily_mean_fx(stored["fx_rates"]))


CHECKED = [
    "users_first_tx_over_10usd", "asof_fx_rate", "transactions_enriched", "user_feature_table", "days_since_min",
    "stratified_split", "roc_auc", "crosstab_counts", "prepare_transactions", "standard_scale", "smote", "smote_enn", "model_knn",
]


@pytest.mark.parametrize("key", CHECKED)
def test_no_pair_joins_and_no_row_python(spark, sf_dir, key):
    plan = plan_of(entry_points.queries()[key](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan


def test_hot_join_key_is_split(spark):
    """A third of all rows on one (currency, day) when the quotes are too many to broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        times = F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(id % 9000 AS INT)")
        df = spark.range(0, 150000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, "EUR").otherwise(F.concat(F.lit("C"), F.col("id") % 90)).alias("currency"),
            F.when(F.col("id") % 3 == 0, F.expr("TIMESTAMP_NTZ '2020-01-05 10:00:00'")).otherwise(times).alias("created_date"),
        )
        rates = spark.range(0, 900).select(
            times.alias("ts"), F.lit("USD").alias("base_ccy"),
            F.when(F.col("id") % 90 == 0, "EUR").otherwise(F.concat(F.lit("C"), F.col("id") % 90)).alias("ccy"),
            F.lit(2.0).alias("rate"),
        )
        original, fx.broadcast_if_small = fx.broadcast_if_small, lambda side, max_rows=0: side
        try:
            joined = fx.asof_fx_rate(df, rates)
        finally:
            fx.broadcast_if_small = original
        assert len(joined.collect()) == 150000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_asof_reads_the_rates_once(spark, stored):
    """All that the lookup needs of the rates comes from one job over them; the join itself reads none."""
    days = fx.day_quotes(stored["fx_rates"])
    assert plan_of(days).count("Location: ") == 1
    folder = stored["fx_rates"].inputFiles()[0].rsplit("/", 1)[0]
    joined = fx.asof_fx_rate(stored["transactions"], stored["fx_rates"])
    assert folder.removeprefix("file://") not in plan_of(joined)
    assert "SortMergeJoin" not in plan_of(joined)


def test_heavy_user_is_combined_before_the_shuffle(stored):
    plan = plan_of(facts.first_date_by_user(stored["transactions"]))
    assert "partial_min" in plan
