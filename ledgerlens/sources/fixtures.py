"""The four tables of the data model, derived by Spark from customer, orders and lineitem.

Every row of the base tables is used. The expressions are plain SQL that Spark and DuckDB read
alike (see FIXTURES.md), so the oracle text is built from the same definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

USERS = {
    "id": "c_custkey",
    "has_email": "c_custkey % 10 <> 0",
    "phone_country": "CASE c_nationkey % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' ELSE NULL END",
    "is_fraudster": "c_acctbal < 0",
    "terms_version": "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 2 = 0"
    " THEN DATE '1994-05-25' ELSE DATE '1994-09-20' END",
    "created_date": "{ntz} '1994-06-01 00:00:00' + INTERVAL '1' SECOND"
    " * CAST(c_custkey * 79193 % 126144000 AS INT)",
    "state": "CASE WHEN c_acctbal < 0 AND c_custkey % 3 <> 0 THEN 'LOCK' ELSE 'ACTIVE' END",
    "country": "CASE c_nationkey % 5 WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' WHEN 2 THEN 'DE'"
    " WHEN 3 THEN 'US' ELSE 'LT' END",
    "birth_year": "CASE WHEN c_custkey % 17 = 0 THEN NULL"
    " ELSE CAST(1950 + c_custkey % 50 AS INT) END",
    "kyc": "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_acctbal < 0 AND c_custkey % 2 = 0"
    " THEN 'FAILED' WHEN c_custkey % 5 = 0 THEN 'NONE' ELSE 'SUCCESS' END",
    "failed_sign_in_attempts": "CAST(c_custkey % 3 AS INT)",
}

# One key in ten hands its orders to its neighbour, which leaves users without transactions.
TRANSACTIONS = {
    "id": "o_orderkey",
    "currency": "CASE WHEN o_orderkey % 97 = 0 THEN 'ZZZ' WHEN o_orderkey % 5 = 0 THEN 'USD'"
    " WHEN o_orderkey % 5 = 1 THEN 'EUR' WHEN o_orderkey % 5 = 2 THEN 'GBP'"
    " WHEN o_orderkey % 5 = 3 THEN 'JPY' ELSE 'BTC' END",
    "amount": "CASE WHEN o_custkey % 4 = 0 THEN CAST(round(o_totalprice / 100) AS BIGINT)"
    " ELSE CAST(round(o_totalprice * 100) AS BIGINT) END",
    "state": "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING'"
    " ELSE 'DECLINED' END",
    "created_date": "o_orderdate + INTERVAL '1' SECOND * CAST(o_orderkey % 48 * 1800 AS INT)",
    "merchant_category": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'shop' END",
    "merchant_country": "CASE o_orderkey % 8 WHEN 0 THEN 'GBR' WHEN 1 THEN '840' WHEN 2 THEN ' us'"
    " WHEN 3 THEN 'FRA' WHEN 4 THEN '036' WHEN 5 THEN 'gbr' WHEN 6 THEN NULL"
    " ELSE 'BerlinDEU' END",
    "entry_method": "CASE o_orderkey % 3 WHEN 0 THEN 'chip' WHEN 1 THEN 'mags' ELSE 'manu' END",
    "user_id": "CASE WHEN o_custkey % 10 = 3 THEN o_custkey - 1 ELSE o_custkey END",
    "type": "CASE o_orderpriority WHEN '1-URGENT' THEN 'ATM' WHEN '2-HIGH' THEN 'CARD_PAYMENT'"
    " WHEN '3-MEDIUM' THEN 'CARD_PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'BANK_TRANSFER'"
    " ELSE 'TOPUP' END",
    "source": "CASE o_orderkey % 4 WHEN 0 THEN 'MINOS' WHEN 1 THEN 'GAIA' ELSE 'HERA' END",
}

# Three quotes a day for EUR, GBP and BTC; JPY is quoted about once a week.
FX_KEYS = {
    "ts": "CASE WHEN l_suppkey % 4 = 2"
    " THEN l_shipdate - INTERVAL '1' DAY * CAST((dayofmonth(l_shipdate) - 1) % 7 AS INT)"
    " ELSE l_shipdate + INTERVAL '1' SECOND * CAST(l_linenumber % 3 * 28800 AS INT) END",
    "base_ccy": "'USD'",
    "ccy": "CASE l_suppkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY'"
    " ELSE 'BTC' END",
}
FX_RATE = "0.5 + CAST(sum(l_orderkey % 1000) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)"

# The raw rate sheet: one column per pair, one pair with the wrong sign.
FX_WIDE = {
    "usdeur": "max(CASE WHEN ccy = 'EUR' THEN rate END)",
    "usdgbp": "-max(CASE WHEN ccy = 'GBP' THEN rate END)",
    "usdjpy": "max(CASE WHEN ccy = 'JPY' THEN rate END)",
    "usdbtc": "max(CASE WHEN ccy = 'BTC' THEN rate END)",
}

CURRENCY_DETAILS = (
    "SELECT ccy, CAST(iso_code AS INT) AS iso_code, CAST(exponent AS INT) AS exponent, is_crypto"
    " FROM (VALUES ('USD', 840, 2, false), ('EUR', 978, 2, false), ('GBP', 826, 2, false),"
    " ('JPY', 392, 0, false), ('BTC', NULL, 8, true)) AS t(ccy, iso_code, exponent, is_crypto)"
)
COUNTRIES = (
    "SELECT code, code3, CAST(numcode AS INT) AS numcode"
    " FROM (VALUES ('GB', 'GBR', 826), ('US', 'USA', 840), ('FR', 'FRA', 250), ('DE', 'DEU', 276),"
    " ('AU', 'AUS', 36), ('AQ', NULL, NULL)) AS t(code, code3, numcode)"
)
FRAUDSTERS = {"user_id": "c_custkey"}


def _base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(
        *[f"{sql.format(ntz='TIMESTAMP_NTZ')} AS {name}" for name, sql in columns.items()]
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_base(spark, sf_dir, "customer"), USERS)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_base(spark, sf_dir, "orders"), TRANSACTIONS)


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    lines = _base(spark, sf_dir, "lineitem")
    quotes = lines.selectExpr("l_orderkey", *[f"{sql} AS {name}" for name, sql in FX_KEYS.items()])
    return quotes.groupBy(*FX_KEYS).agg(F.expr(FX_RATE).cast("double").alias("rate"))


def fx_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    return fx_rates(spark, sf_dir).groupBy("ts").agg(
        *[F.expr(sql).alias(name) for name, sql in FX_WIDE.items()]
    )


def currency_details(spark: SparkSession) -> DataFrame:
    return spark.sql(CURRENCY_DETAILS)


def countries(spark: SparkSession) -> DataFrame:
    return spark.sql(COUNTRIES)


def fraudsters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_base(spark, sf_dir, "customer").where("c_acctbal < 0"), FRAUDSTERS)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as the load job stores them: merchant countries cleaned."""
    from ledgerlens.sources.load import prepare_transactions

    return prepare_transactions(raw_transactions(spark, sf_dir), countries(spark))
