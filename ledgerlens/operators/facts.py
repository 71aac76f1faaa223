"""Facts about each user's transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import flag, stable_avg
from ledgerlens.session import broadcast_if_small

# Fixed values the rules compare with.
COMPLETED = "COMPLETED"
CARD_PAYMENT = "CARD_PAYMENT"


def first_date_by_user(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("user_id").agg(F.min("created_date").alias("first_date"))


def is_completed_card() -> Column:
    return (F.col("type") == CARD_PAYMENT) & (F.col("state") == COMPLETED)


def _at_first_instant(rows: DataFrame, transactions: DataFrame) -> DataFrame:
    """Rows at their user's first instant, ties kept.

    The join key is (user, time): rows of one heavy user spread over all tasks.
    """
    first = first_date_by_user(transactions).select(
        F.col("user_id").alias("_user"), F.col("first_date").alias("_first")
    )
    here = (F.col("user_id") == F.col("_user")) & (F.col("created_date") == F.col("_first"))
    return rows.join(first, here).drop("_user", "_first")


def first_transactions_join(transactions: DataFrame) -> DataFrame:
    return _at_first_instant(transactions, transactions)


def first_completed_card(transactions: DataFrame) -> DataFrame:
    """Distinct ``(user_id, created_date, currency, amount)`` of completed card payments at the
    user's first instant.

    The first instant counts every transaction; only the rows to keep are filtered, at the scan,
    and copies collapse before they are shuffled.
    """
    cards = (
        transactions.where(is_completed_card())
        .select("user_id", "created_date", "currency", "amount")
        .distinct()
    )
    return _at_first_instant(cards, transactions)


def fraud_users(users: DataFrame) -> DataFrame:
    return users.where("is_fraudster").select(F.col("id").alias("user_id")).distinct()


def membership_flag(df: DataFrame, key: str, members: DataFrame, name: str) -> DataFrame:
    """Adds boolean ``name``: whether ``key`` is in the first column of ``members``."""
    listed = broadcast_if_small(
        members.select(F.col(members.columns[0]).alias("_member")).where("_member IS NOT NULL").distinct()
    )
    joined = df.join(listed, F.col(key) == F.col("_member"), "left")
    return joined.withColumn(name, F.col("_member").isNotNull()).drop("_member")


def mark_first_transactions(transactions: DataFrame) -> DataFrame:
    """Adds ``first_date`` (own time where it is the user's earliest) and ``first_amount`` (USD
    amount where that transaction is also completed)."""
    first = first_date_by_user(transactions).select(
        F.col("user_id").alias("_user"), F.col("first_date").alias("_first")
    )
    here = (F.col("user_id") == F.col("_user")) & (F.col("created_date") == F.col("_first"))
    completed = F.col("_first").isNotNull() & (F.col("state") == COMPLETED)
    return (
        transactions.join(first, here, "left")
        .withColumn("first_date", F.col("_first"))
        .withColumn("first_amount", F.when(completed, F.col("amount_usd")))
        .drop("_user", "_first")
    )


def enrich_transactions(transactions_usd: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions with USD amount, first-transaction marks and the fraud flag of the user."""
    return membership_flag(
        mark_first_transactions(transactions_usd), "user_id", fraud_users(users), "is_fraudster"
    )


def first_transaction_per_user(transactions_usd: DataFrame) -> DataFrame:
    """One first transaction per user, ties broken by the smallest id.

    A minimum over structs: every map task sends one row per user, so heavy users cost nothing.
    """
    picked = transactions_usd.groupBy("user_id").agg(
        F.min(F.struct("created_date", "id", "state", "amount_usd")).alias("t")
    )
    return picked.select(
        "user_id",
        F.col("t.created_date").alias("first_date"),
        F.when(F.col("t.state") == COMPLETED, F.col("t.amount_usd")).alias("first_amount"),
    )


def count_by_user_value(transactions: DataFrame, variable: str) -> DataFrame:
    return (
        transactions.where(F.col(variable).isNotNull())
        .groupBy("user_id", F.col(variable).alias("value"))
        .agg(F.count("id").alias("cnt"))
    )


def mode_by_user(transactions: DataFrame, variables: list[str]) -> DataFrame:
    """Most frequent value of each variable per user; ties give the smallest value."""
    return transactions.where("user_id IS NOT NULL").groupBy("user_id").agg(
        *[F.mode(v, True).alias(f"{v}_freq") for v in variables]
    )


def top_value_by_user(transactions: DataFrame, variable: str) -> DataFrame:
    """Highest-count value per user with its count: counts first, then the top row of each user."""
    best = Window.partitionBy("user_id").orderBy(F.desc("cnt"), "value")
    return (
        count_by_user_value(transactions, variable)
        .withColumn("rn", F.row_number().over(best))
        .where("rn = 1")
        .drop("rn")
    )


def user_facts(transactions_usd: DataFrame) -> DataFrame:
    """Everything the feature table needs from transactions, in one grouping by user.

    All measures combine on the map side. The two sets hold currency and merchant-country codes,
    which the table limits to three characters, so they stay short for any user.
    """
    first = F.min(F.struct("created_date", "id", "state", "amount_usd"))
    return (
        transactions_usd.where("user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(
            first.alias("t"),
            *[F.mode(v, True).alias(f"{v}_freq") for v in ("source", "type", "state")],
            F.collect_set("currency").alias("currencies"),
            F.collect_set("merchant_country").alias("merchant_countries"),
            stable_avg("amount_usd").alias("mean_amount"),
        )
        .select(
            "user_id",
            F.col("t.created_date").alias("first_date"),
            F.when(F.col("t.state") == COMPLETED, F.col("t.amount_usd")).alias("first_amount"),
            "source_freq", "type_freq", "state_freq",
            F.size("currencies").alias("cnt_currency"),
            "merchant_countries",
            "mean_amount",
        )
    )


def user_transaction_features(users: DataFrame, transactions_usd: DataFrame) -> DataFrame:
    """Per user: country match, any transaction, distinct currencies, mean USD amount."""
    facts = transactions_usd.where("user_id IS NOT NULL").groupBy("user_id").agg(
        F.collect_set("merchant_country").alias("merchant_countries"),
        F.size(F.collect_set("currency")).alias("cnt_currency"),
        stable_avg("amount_usd").alias("mean_amount"),
    )
    joined = users.select("id", "country").join(facts, F.col("id") == F.col("user_id"), "left")
    return joined.select(
        F.col("id").alias("user_id"),
        flag(F.array_contains("merchant_countries", F.col("country"))).alias("is_user_country"),
        flag(F.col("user_id").isNotNull()).alias("has_transactions"),
        F.coalesce("cnt_currency", F.lit(0)).alias("cnt_currency"),
        "mean_amount",
    )


def any_flag(df: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """1 for each key with at least one row that meets the condition, else 0."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(flag(condition)).alias(name))


def max_amount_by_user(transactions: DataFrame) -> DataFrame:
    return (
        transactions.where("user_id IS NOT NULL AND is_fraudster IS NOT NULL")
        .groupBy("user_id", "is_fraudster")
        .agg(F.max("amount_usd").alias("amount_usd"))
    )


def users_of_fraud_countries(users: DataFrame) -> DataFrame:
    """Users whose country has at least one fraud user."""
    countries = users.where("is_fraudster").select(F.col("country").alias("_country")).distinct()
    return users.join(
        broadcast_if_small(countries), F.col("country") == F.col("_country"), "left_semi"
    )
