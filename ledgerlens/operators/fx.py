"""Currency conversion: as-of rate and mean rate of the nearest day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import USD, minor_units_to_usd, nearest_day, stable_avg
from ledgerlens.session import broadcast_if_small, materialise


def filter_base_usd(fx_rates: DataFrame) -> DataFrame:
    return fx_rates.where(F.col("base_ccy") == USD)


# --- as-of ---------------------------------------------------------------------------------------

def day_quotes(fx_rates: DataFrame) -> DataFrame:
    """``(ccy, day, quotes)``: the USD-based quotes ``(ts, rate)`` of a currency's day in order of time."""
    return (
        filter_base_usd(fx_rates)
        .groupBy("ccy", F.to_date("ts").alias("day"))
        .agg(F.sort_array(F.collect_list(F.struct("ts", "rate"))).alias("quotes"))
    )


def last_quoted_day(days: DataFrame) -> DataFrame:
    return days.agg(F.max("day").alias("last_day"))


def rate_pieces(days: DataFrame) -> DataFrame:
    """Validity pieces of the quotes: ``(ccy, day, since, until, rate_ts, rate)``.

    A piece covers part of one day, so an as-of lookup is an equality on (currency, day) plus a
    range, and few currencies never make few partitions. A quote that stays valid over quiet days is
    repeated once for each of them, so the table grows with the calendar, not with the lookups.
    Past the last day with any quote one closing piece per currency stands for all later days.
    ``since`` or ``until`` is NULL where the piece reaches the edge of its day.

    ``days`` is ``day_quotes``, stored: only its one row a currency and day is ever sorted.
    """
    quotes = F.col("quotes")
    within = days.select("ccy", "day", F.inline(F.transform(quotes, lambda q, i: F.struct(
        q["ts"].alias("since"), F.get(quotes, i + 1)["ts"].alias("until"), q["ts"].alias("rate_ts"), q["rate"].alias("rate")))))
    by_day = Window.partitionBy("ccy").orderBy("day")
    last = F.element_at("quotes", -1)
    closing_day = F.date_add(last_quoted_day(days).scalar(), 1)
    spans = days.select(
        "ccy", last["ts"].alias("rate_ts"), last["rate"].alias("rate"),
        F.date_add("day", 1).alias("from_day"),
        F.coalesce(F.lead("day").over(by_day), closing_day).alias("to_day"),
        F.lead(quotes[0]["ts"]).over(by_day).alias("next_opens"),
    )
    carried = spans.withColumn(
        "day", F.explode(F.sequence("from_day", "to_day", F.expr("INTERVAL 1 DAY")))
    ).select(
        "ccy", "day", F.lit(None).cast("timestamp_ntz").alias("since"),
        F.when(F.col("day") == F.col("to_day"), F.col("next_opens")).alias("until"),
        "rate_ts", "rate",
    )
    return within.unionByName(carried)


def asof_fx_rate(df: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Adds ``rate_ts`` and ``rate``: last USD-based quote of the row's currency at or before its
    time, however old; NULL where there is none. The rates are read once."""
    days = materialise(day_quotes(fx_rates), "day-quotes")
    pieces = broadcast_if_small(rate_pieces(days)).select(
        F.col("ccy").alias("_ccy"), F.col("day").alias("_day"), "since", "until", "rate_ts", "rate"
    )
    closing_day = F.date_add(last_quoted_day(days).scalar(), 1)
    keyed = df.withColumn("_lookup", F.least(F.to_date("created_date"), closing_day))
    at = F.col("created_date")
    found = (
        (F.col("currency") == F.col("_ccy"))
        & (F.col("_lookup") == F.col("_day"))
        & (F.col("since").isNull() | (F.col("since") <= at))
        & (F.col("until").isNull() | (at < F.col("until")))
    )
    return keyed.join(pieces, found, "left").drop("_lookup", "_ccy", "_day", "since", "until")


def left_join_currency(df: DataFrame, currency_details: DataFrame) -> DataFrame:
    """Adds ``exponent``; NULL for an unknown currency.

    The table is stored, so Spark knows its size and broadcasts it by its own threshold.
    """
    details = currency_details.select(F.col("ccy").alias("_ccy"), "exponent")
    return df.join(details, F.col("currency") == F.col("_ccy"), "left").drop("_ccy")


def inner_join_currency(df: DataFrame, currency_details: DataFrame) -> DataFrame:
    """Adds ``exponent``; rows of an unknown currency drop out."""
    details = currency_details.select(F.col("ccy").alias("_ccy"), "exponent")
    return df.join(details, F.col("currency") == F.col("_ccy")).drop("_ccy")


# --- mean of the nearest day ---------------------------------------------------------------------

def daily_mean_fx(fx_rates: DataFrame) -> DataFrame:
    """Mean USD-based rate per (nearest day, currency)."""
    return (
        filter_base_usd(fx_rates)
        .groupBy(nearest_day("ts").alias("day"), "ccy")
        .agg(stable_avg("rate").alias("rate"))
    )


def daily_fx_join(df: DataFrame, daily: DataFrame) -> DataFrame:
    """Adds ``rate``: the daily mean of the row's nearest day and currency, or NULL."""
    rates = broadcast_if_small(daily).select(
        F.col("day").alias("_day"), F.col("ccy").alias("_ccy"), "rate"
    )
    same = (nearest_day("created_date") == F.col("_day")) & (F.col("currency") == F.col("_ccy"))
    return df.join(rates, same, "left").drop("_day", "_ccy")


def convert_to_usd_daily(
    transactions: DataFrame, fx_rates: DataFrame, currency_details: DataFrame
) -> DataFrame:
    """Adds ``amount_usd`` by key: NULL where the currency or the day's rate is unknown.

    With the small sides broadcast the transactions are neither shuffled nor sorted.
    """
    rated = daily_fx_join(transactions, daily_mean_fx(fx_rates))
    return (
        left_join_currency(rated, currency_details)
        .withColumn("amount_usd", minor_units_to_usd("currency", "rate", "amount", "exponent"))
        .drop("rate", "exponent")
    )
