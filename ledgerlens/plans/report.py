"""SQL report: users whose first transaction is a completed card payment worth enough USD."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import minor_units_to_usd
from ledgerlens.operators.facts import first_completed_card
from ledgerlens.operators.fx import asof_fx_rate, left_join_currency

# Fixed value: smallest USD amount reported.
MIN_USD = 10


def first_card_amounts(
    transactions: DataFrame, fx_rates: DataFrame, currency_details: DataFrame
) -> DataFrame:
    """First completed card payments with their USD amount by as-of rate."""
    rated = asof_fx_rate(first_completed_card(transactions), fx_rates)
    return left_join_currency(rated, currency_details).withColumn(
        "amount_usd", minor_units_to_usd("currency", "rate", "amount", "exponent")
    )


def users_first_tx_over_10usd(
    transactions: DataFrame, fx_rates: DataFrame, currency_details: DataFrame
) -> DataFrame:
    """``(user_id, amount_usd)``, largest amount first."""
    return (
        first_card_amounts(transactions, fx_rates, currency_details)
        .where(F.col("amount_usd") >= MIN_USD)
        .select("user_id", "amount_usd")
        .orderBy(F.desc("amount_usd"))
    )
