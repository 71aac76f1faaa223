"""Action for a scored user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.settings import (
    ACTION_LABELS,
    THRESHOLD_ALERT,
    THRESHOLD_AMOUNT,
    THRESHOLD_LOCK,
    THRESHOLD_SUSPECT,
)


def action_code(probability: Column | str = "probability", ignore_case: bool = False) -> Column:
    """Rule table over the filled feature columns; ``ignore_case`` compares the failed check
    without regard to case."""
    p = F.col(probability) if isinstance(probability, str) else probability
    failed = (F.lower("kyc") if ignore_case else F.col("kyc")) == "failed"
    grave = (F.col("is_lock") == 1) | (F.col("mean_amount") >= THRESHOLD_AMOUNT) | failed
    doubtful = (F.col("kyc") != "SUCCESS") | (F.col("source_minos") == 1)
    return (
        F.when(F.col("has_transactions") == 0, "NOTHING")
        .when(p >= THRESHOLD_LOCK, "BOTH")
        .when((p >= THRESHOLD_ALERT) & grave, "BOTH")
        .when(p >= THRESHOLD_ALERT, "ALERT")
        .when((p >= THRESHOLD_SUSPECT) & doubtful, "ALERT")
        .otherwise("NOTHING")
    )


def decide_action(scored: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Adds ``action`` and its printed ``action_label``."""
    labels = F.create_map(*[F.lit(x) for pair in ACTION_LABELS.items() for x in pair])
    return scored.withColumn("action", action_code(ignore_case=ignore_case)).withColumn(
        "action_label", labels[F.col("action")]
    )
