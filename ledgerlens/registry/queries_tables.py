"""Queries of the load layer, scalar functions, filters, joins and aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import scalar
from ledgerlens.operators import explore, facts, features, fx
from ledgerlens.plans import report
from ledgerlens.registry.data import Data, write_raw_csv
from ledgerlens.settings import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TABLE_COLUMNS, JobSettings
from ledgerlens.sources import checks, files, fixtures, load, schemas


def _day_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text, so that every client compares them alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


# --- load layer ----------------------------------------------------------------------------------

_FRAUD_FILE = T.StructType([T.StructField("user_id", T.LongType())])
_TX_FILE = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name in ("id", "user_id") else f.dataType)
        for f in schemas.RAW_TRANSACTIONS
    ]
)


def scan_csv(d: Data) -> DataFrame:
    path = d.csv(d.raw_transactions, "transactions-csv")
    return files.scan_csv(d.spark, path, _TX_FILE)


def normalize_columns(d: Data) -> DataFrame:
    upper = d.raw_transactions.toDF(*[c.upper() for c in d.raw_transactions.columns])
    return scalar.normalize_columns(upper)


def nan_to_null(d: Data) -> DataFrame:
    odd = d.fx_rates.withColumn("rate", F.expr("CASE WHEN ccy = 'JPY' THEN DOUBLE('NaN') ELSE rate END"))
    return scalar.nan_to_null(odd)


def write_table(d: Data) -> DataFrame:
    path = d.path("written")
    files.write_table(d.raw_transactions, path)
    return files.scan_table(d.spark, path)


def replace_table(d: Data) -> DataFrame:
    """Written twice to one place: the second version replaces the first."""
    path = d.path("replaced")
    files.write_table(d.users.where("is_fraudster"), path)
    files.write_table(d.users, path)
    return _day_text(files.scan_table(d.spark, path), "terms_version")


def reconcile_counts(d: Data) -> DataFrame:
    rows = load.prepare_transactions(d.raw_transactions, d.countries)
    return load.reconcile_counts(rows, "transactions", d.path("rec")).select("table_name", "loaded", "expected", "ok")


def load_all_tables(d: Data) -> DataFrame:
    """The whole load job over raw CSV files written from the fixture tables, and all four tables read
    back: values and a checksum of their texts for every column."""
    raw = d.path("raw")

    def put(df: DataFrame, name: str) -> None:
        write_raw_csv(df, f"{raw}/{name}")

    put(d.users.drop("is_fraudster"), "train_users.csv")
    put(d.fraudsters, "train_fraudsters.csv")
    put(d.raw_transactions, "train_transactions.csv")
    put(d.countries, "countries.csv")
    put(d.currency_details.withColumnRenamed("ccy", "currency"), "currency_details.csv")
    put(d.fx_wide, "fx_rates.csv")
    settings = JobSettings.for_folders(raw, d.path("tables"), d.path("model"))
    report = load.load_all_tables(d.spark, settings).select("table_name", "loaded", "ok")
    sums = [_column_sums(files.scan_table(d.spark, f"{settings.warehouse}/{n}"), t) for n, t in schemas.TABLES.items()]
    return reduce(DataFrame.unionByName, sums).join(report, "table_name")


def _column_sums(df: DataFrame, table: schemas.Table) -> DataFrame:
    """``(table_name, column_name, n_values, checksum)``: a sum over hashes of the values' texts."""
    def text(c: schemas.Column):
        value = F.col(c.name)
        if isinstance(c.type, T.TimestampNTZType):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        if isinstance(c.type, T.DoubleType):
            value = F.round(value * 10000)
        return (value.cast("long") if isinstance(c.type, T.BooleanType | T.DoubleType) else value).cast("string")

    hashed = {c.name: F.conv(F.substring(F.md5(text(c)), 1, 8), 16, 10).cast("long") for c in table.columns}
    summed = df.agg(*[F.struct(F.count(c).alias("n_values"), F.sum(h).alias("checksum")).alias(c) for c, h in hashed.items()])
    return summed.unpivot([], list(hashed), "column_name", "sums").select(
        F.lit(table.name).alias("table_name"), "column_name", "sums.n_values", "sums.checksum")


def scan_table(d: Data) -> DataFrame:
    path = d.path("scan")
    files.write_table(d.fx_rates, path)
    return files.scan_table(d.spark, path, TABLE_COLUMNS["fx_rates"])


def scan_table_by_key(d: Data) -> DataFrame:
    """Transactions of all fraud users: a table of keys instead of one."""
    return files.scan_table_by_key(d.raw_transactions, "user_id", d.fraudsters)


def run_sql_file(d: Data) -> DataFrame:
    path = d.path("report.sql")
    text = (
        "SELECT user_id, count(*) AS n, min(created_date) AS first_date\n"
        "FROM ledger_transactions GROUP BY user_id"
    )
    d.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return files.run_sql_file(d.spark, path, {"ledger_transactions": d.raw_transactions})


def validate_constraints(d: Data) -> DataFrame:
    return checks.validate_constraints(
        [
            (d.users, schemas.USERS),
            (d.raw_transactions, schemas.TRANSACTIONS),
            (d.fx_rates, schemas.FX_RATES),
            (d.currency_details, schemas.CURRENCY_DETAILS),
        ]
    )


# --- projections and scalar functions ------------------------------------------------------------

def prepare_currency_details(d: Data) -> DataFrame:
    """Currency table, with how many transactions use each currency."""
    raw = d.currency_details.withColumnRenamed("ccy", "currency")
    used = d.raw_transactions.groupBy(F.col("currency").alias("ccy")).agg(F.count("id").alias("n_used"))
    return load.prepare_currency_details(raw).join(used, "ccy", "left")


def parse_ccy_pair(d: Data) -> DataFrame:
    first, *pairs = d.fx_wide.columns
    cells = d.fx_wide.unpivot(first, pairs, "pair", "rate")
    return cells.groupBy(
        "pair",
        scalar.pair_base("pair").alias("base_ccy"),
        scalar.pair_quote("pair").alias("ccy"),
    ).agg(F.count("rate").alias("n_rates"))


def abs_rate(d: Data) -> DataFrame:
    first, *pairs = d.fx_wide.columns
    cells = d.fx_wide.unpivot(first, pairs, "pair", "rate").where("rate IS NOT NULL")
    return cells.select("ts", "pair", F.abs("rate").alias("rate"))


def merchant_country_clean(d: Data) -> DataFrame:
    return d.raw_transactions.select(
        "id", scalar.clean_merchant_country("merchant_country").alias("merchant_country")
    )


def strip_leading_zeros(d: Data) -> DataFrame:
    return d.raw_transactions.select(
        "id", scalar.strip_leading_zeros("merchant_country").alias("merchant_country")
    )


def merchant_country_to_code2(d: Data) -> DataFrame:
    cleaned = d.raw_transactions.select(
        "id", scalar.clean_merchant_country("merchant_country").alias("merchant_country")
    )
    return load.merchant_country_to_code2(cleaned, d.countries)


def round_to_day(d: Data) -> DataFrame:
    days = d.raw_transactions.select("id", "created_date", scalar.nearest_day("created_date").alias("day"))
    return _day_text(days, "day")


def days_since_min(d: Data) -> DataFrame:
    return features.days_since_min(d.users.select("id", "created_date"), "created_date", "days")


def seconds_between(d: Data) -> DataFrame:
    first = facts.first_date_by_user(d.transactions)
    joined = d.users.join(first, F.col("id") == F.col("user_id"), "left")
    return joined.select("id", scalar.seconds_between("first_date", "created_date").alias("diff_date"))


def flag_columns(d: Data) -> DataFrame:
    """All flags of the feature table, and the label."""
    return d.features.select(
        "id", "is_lock", "has_email", "country_gb", "first_success", "source_minos", "is_user_country",
        "has_transactions", scalar.flag(F.col("is_fraudster")).alias("label"),
    )


def cast_terms_version(d: Data) -> DataFrame:
    return d.users.select("id", F.date_format("terms_version", "yyyy-MM-dd").alias("terms_version_origin"))


def copy_and_drop_columns(d: Data) -> DataFrame:
    converted = features.convert_users(d.users)
    return converted.select("id", "created_date_origin", "is_lock")


def minor_units_to_usd(d: Data) -> DataFrame:
    """Amounts by the mean rate of the nearest day."""
    rated = fx.daily_fx_join(d.raw_transactions, fx.daily_mean_fx(d.fx_rates))
    known = fx.left_join_currency(rated, d.currency_details)
    usd = scalar.minor_units_to_usd("currency", "rate", "amount", "exponent")
    return known.select("id", usd.alias("amount_usd"))


def fill_na_by_config(d: Data) -> DataFrame:
    return _day_text(features.fill_features(d.users), "terms_version")


def one_hot(d: Data) -> DataFrame:
    wide = features.one_hot(d.stored_features.select("id", *CATEGORICAL_FEATURES), CATEGORICAL_FEATURES)
    return features.melt(wide, ["id"], [c for c in wide.columns if c != "id"])


def align_columns(d: Data) -> DataFrame:
    """Fraud users against the columns of all users, missing ones filled with -1."""
    values = features.categories(d.users, ["kyc", "country"])
    training = ["id", *features.one_hot_expressions(values)]
    fraud = d.users.where("is_fraudster").select("id", "kyc", "country")
    wide = features.align_columns(features.one_hot(fraud, ["kyc", "country"]), training, -1.0)
    return features.melt(features.cast_features_double(wide, training[1:]), ["id"], training[1:])


def cast_features_double(d: Data) -> DataFrame:
    return features.cast_features_double(d.features.select("id", *NUMERIC_FEATURES), NUMERIC_FEATURES)


def pct_round(d: Data) -> DataFrame:
    return d.users.groupBy("country").agg(
        scalar.pct_round(F.avg(F.col("is_fraudster").cast("int"))).alias("fraud_pct")
    )


def prepare_users(d: Data) -> DataFrame:
    return _day_text(load.prepare_users(d.users.drop("is_fraudster"), d.fraudsters), "terms_version")


# --- filters -------------------------------------------------------------------------------------

def filter_completed_card(d: Data) -> DataFrame:
    return facts.first_completed_card(d.transactions)


def filter_min_amount(d: Data) -> DataFrame:
    """Daily-rate USD amounts of at least 10; unknown amounts drop out."""
    return d.transactions_usd.where(F.col("amount_usd") >= report.MIN_USD).select("id", "amount_usd")


def filter_not_null(d: Data) -> DataFrame:
    """Country dictionary of complete rows, with the cleaned merchant codes it covers."""
    cleaned = d.raw_transactions.select(
        scalar.strip_leading_zeros(scalar.clean_merchant_country("merchant_country")).alias("key")
    )
    used = cleaned.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return load.country_dictionary(d.countries).join(used, "key", "left")


def range_slices(d: Data) -> DataFrame:
    return explore.range_slices(d.features)


def empty_input_guard(d: Data) -> DataFrame:
    """Features against an empty transactions table: every user, typed NULL and zero facts."""
    none = d.transactions.where(F.lit(False))
    table = features.user_feature_table(d.users, none, d.fx_rates, d.currency_details)
    return table.select("id", "has_transactions", "cnt_currency", "mean_amount", "source_freq", "first_date")


# --- joins ---------------------------------------------------------------------------------------

def asof_fx_rate(d: Data) -> DataFrame:
    return fx.asof_fx_rate(d.transactions.select("id", "currency", "created_date"), d.fx_rates)


def left_join_currency(d: Data) -> DataFrame:
    return fx.left_join_currency(d.transactions.select("id", "currency"), d.currency_details)


def daily_fx_join(d: Data) -> DataFrame:
    return fx.daily_fx_join(
        d.transactions.select("id", "currency", "created_date"), fx.daily_mean_fx(d.fx_rates)
    )


def inner_join_currency(d: Data) -> DataFrame:
    return fx.inner_join_currency(d.transactions.select("id", "currency"), d.currency_details)


def users_left_join_facts(d: Data) -> DataFrame:
    first = facts.first_transaction_per_user(d.transactions_usd)
    mode = facts.mode_by_user(d.transactions, ["source"]).withColumnRenamed("user_id", "mode_user")
    users = d.users.select("id", "country")
    return (
        users.join(first, F.col("id") == F.col("user_id"), "left")
        .join(mode, F.col("id") == F.col("mode_user"), "left")
        .drop("user_id", "mode_user")
    )


def membership_flag(d: Data) -> DataFrame:
    return facts.membership_flag(
        d.transactions.select("id", "user_id"), "user_id", facts.fraud_users(d.users), "is_fraudster"
    )


def semi_join_fraud_countries(d: Data) -> DataFrame:
    return facts.users_of_fraud_countries(d.users).select("id", "country", "is_fraudster")


# --- aggregations --------------------------------------------------------------------------------

def latest_rate_ts(d: Data) -> DataFrame:
    """Latest quote time of each distinct first completed card payment."""
    return fx.asof_fx_rate(facts.first_completed_card(d.transactions), d.fx_rates).select(
        "user_id", "created_date", "currency", "amount", "rate_ts"
    )


def daily_mean_fx(d: Data) -> DataFrame:
    return _day_text(fx.daily_mean_fx(d.fx_rates), "day")


def any_flag(d: Data) -> DataFrame:
    return facts.any_flag(d.transactions, "user_id", F.col("source") == "MINOS", "any_minos")


def max_amount_by_user(d: Data) -> DataFrame:
    return facts.max_amount_by_user(d.enriched)


def crosstab_wide(d: Data) -> DataFrame:
    return explore.crosstab_wide(d.users, "is_fraudster", "kyc")


_ROUND = 6


def _box(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    stats = explore.boxplot_stats(df, groups, value)
    return stats.withColumns(
        {c: F.round(c, _ROUND) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")}
    )


def correlation_matrix(d: Data) -> DataFrame:
    return explore.correlation_matrix(d.features.drop("id")).withColumn("corr", F.round("corr", _ROUND))


def profile_table(d: Data) -> DataFrame:
    """Users and transactions."""
    parts = [
        explore.profile_table(df).withColumn("table_name", F.lit(name))
        for name, df in (("users", d.users), ("transactions", d.raw_transactions))
    ]
    return parts[0].unionByName(parts[1])


# --- composites ----------------------------------------------------------------------------------

def transactions_enriched(d: Data) -> DataFrame:
    return d.enriched


def users_converted(d: Data) -> DataFrame:
    return _day_text(features.convert_users(d.users), "terms_version")


def user_feature_table(d: Data) -> DataFrame:
    return _day_text(d.features, "terms_version")


def user_feature_table_by_key(d: Data) -> DataFrame:
    """Feature rows of all fraud users, with the minimum date of all users."""
    table = features.user_feature_table_by_key(
        d.users, d.transactions, d.fx_rates, d.currency_details, d.fraudsters,
        features.min_created_date(d.users),
    )
    return _day_text(table.withColumn("mean_amount", F.round("mean_amount", _ROUND)), "terms_version")


def feature_label_matrix(d: Data) -> DataFrame:
    matrix = features.model_matrix(d.stored_features)
    return features.melt(matrix, ["id", "label"], [c for c in matrix.columns if c not in ("id", "label")])


QUERIES = {
    "scan_csv": scan_csv,
    "normalize_columns": normalize_columns,
    "nan_to_null": nan_to_null,
    "project_declared": lambda d: scalar.project_declared(
        d.raw_transactions, TABLE_COLUMNS["transactions"]
    ),
    "write_table": write_table,
    "replace_table": replace_table,
    "reconcile_counts": reconcile_counts,
    "load_all_tables": load_all_tables,
    "scan_table": scan_table,
    "scan_table_by_key": scan_table_by_key,
    "run_sql_file": run_sql_file,
    "validate_constraints": validate_constraints,
    "prepare_currency_details": prepare_currency_details,
    "prepare_fx_rates": lambda d: load.prepare_fx_rates(d.fx_wide),
    "parse_ccy_pair": parse_ccy_pair,
    "abs_rate": abs_rate,
    "merchant_country_clean": merchant_country_clean,
    "strip_leading_zeros": strip_leading_zeros,
    "merchant_country_to_code2": merchant_country_to_code2,
    "overlong_merchant_country": lambda d: load.overlong_merchant_country(d.raw_transactions),
    "round_to_day": round_to_day,
    "days_since_min": days_since_min,
    "seconds_between": seconds_between,
    "flag_columns": flag_columns,
    "cast_terms_version": cast_terms_version,
    "copy_and_drop_columns": copy_and_drop_columns,
    "minor_units_to_usd": minor_units_to_usd,
    "fill_na_by_config": fill_na_by_config,
    "one_hot": one_hot,
    "align_columns": align_columns,
    "cast_features_double": cast_features_double,
    "pct_round": pct_round,
    "prepare_users": prepare_users,
    "prepare_transactions": lambda d: load.prepare_transactions(d.raw_transactions, d.countries),
    "filter_base_usd": lambda d: fx.filter_base_usd(d.fx_rates),
    "filter_completed_card": filter_completed_card,
    "filter_min_amount": filter_min_amount,
    "filter_not_null": filter_not_null,
    "range_slices": range_slices,
    "empty_input_guard": empty_input_guard,
    "first_transactions_join": lambda d: facts.first_transactions_join(d.transactions),
    "asof_fx_rate": asof_fx_rate,
    "left_join_currency": left_join_currency,
    "daily_fx_join": daily_fx_join,
    "inner_join_currency": inner_join_currency,
    "first_flag_left_join": lambda d: facts.mark_first_transactions(d.transactions_usd).select(
        "id", "user_id", "first_date"
    ),
    "users_left_join_facts": users_left_join_facts,
    "membership_flag": membership_flag,
    "semi_join_fraud_countries": semi_join_fraud_countries,
    "first_date_by_user": lambda d: facts.first_date_by_user(d.transactions),
    "latest_rate_ts": latest_rate_ts,
    "daily_mean_fx": daily_mean_fx,
    "count_by_user_value": lambda d: facts.count_by_user_value(d.transactions, "source"),
    "user_transaction_features": lambda d: facts.user_transaction_features(
        d.users, d.transactions_usd
    ).withColumn("mean_amount", F.round("mean_amount", _ROUND)),
    "any_flag": any_flag,
    "max_amount_by_user": max_amount_by_user,
    "crosstab_counts": lambda d: explore.crosstab_counts(d.users, "is_fraudster", "kyc"),
    "crosstab_wide": crosstab_wide,
    "crosstab_row_pct": lambda d: explore.crosstab_row_pct(d.users, "is_fraudster", "kyc"),
    "crosstab_long": lambda d: explore.crosstab_row_pct(d.users, "is_fraudster", "country"),
    "correlation_matrix": correlation_matrix,
    "profile_table": profile_table,
    "distinct_values": lambda d: explore.distinct_values(d.users.where("is_fraudster"), "country"),
    "row_count": lambda d: load.row_count(d.transactions, "transactions"),
    "mark_first_transactions": lambda d: facts.mark_first_transactions(d.transactions_usd).select(
        "id", "user_id", "first_date", "first_amount"
    ),
    "first_transaction_per_user": lambda d: facts.first_transaction_per_user(d.transactions_usd),
    "mode_by_user": lambda d: facts.mode_by_user(d.transactions, ["source", "type", "state"]),
    "order_by_amount": lambda d: d.transactions_usd.select("id", "amount_usd").orderBy(
        F.desc("amount_usd")
    ),
    "sort_for_top1": lambda d: facts.top_value_by_user(d.transactions, "type"),
    "head": lambda d: _day_text(explore.head(d.users, 5, "id"), "terms_version"),
    "users_first_tx_over_10usd": lambda d: report.users_first_tx_over_10usd(
        d.transactions, d.fx_rates, d.currency_details
    ),
    "convert_to_usd_daily": lambda d: d.transactions_usd.select("id", "amount_usd"),
    "transactions_enriched": transactions_enriched,
    "users_converted": users_converted,
    "user_feature_table": user_feature_table,
    "user_feature_table_by_key": user_feature_table_by_key,
    "feature_label_matrix": feature_label_matrix,
}

# Exploration settings: one contingency table per column, one box plot per measure.
_USER_COLUMNS = (
    "kyc", "terms_version", "has_email", "failed_sign_in_attempts", "cnt_currency",
    "is_user_country", "has_transactions",
)
for _c in _USER_COLUMNS:
    QUERIES[f"eda_categorical_{_c}"] = lambda d, c=_c: explore.eda_categorical(d.features, c)
QUERIES["eda_categorical_country"] = lambda d: explore.eda_categorical(
    facts.users_of_fraud_countries(d.stored_features), "country"
)
for _c in ("type", "state", "source", "entry_method"):
    QUERIES[f"eda_categorical_{_c}"] = lambda d, c=_c: explore.eda_categorical(
        facts.membership_flag(
            d.transactions, "user_id", facts.fraud_users(d.users), "is_fraudster"
        ),
        c,
    )

_BY = ["is_fraudster"]
_BOXES = {
    "created_date": lambda d: (d.features, _BY, "created_date"),
    "birth_year": lambda d: (d.features, _BY, "birth_year"),
    "amount_by_state_small": lambda d: (
        d.enriched.where("first_amount < 100"), [*_BY, "state"], "amount_usd"),
    "amount_by_state_big": lambda d: (
        d.enriched.where("first_amount > 100"), [*_BY, "state"], "amount_usd"),
    "max_amount_small": lambda d: (
        facts.max_amount_by_user(d.enriched).where("amount_usd < 1000"), _BY, "amount_usd"),
    "max_amount_big": lambda d: (
        facts.max_amount_by_user(d.enriched).where("amount_usd > 1000"), _BY, "amount_usd"),
    "mean_amount_small": lambda d: (d.features.where("mean_amount < 1000"), _BY, "mean_amount"),
    "mean_amount_big": lambda d: (d.features.where("mean_amount >= 1000"), _BY, "mean_amount"),
    "diff_date_fast": lambda d: (d.features.where("diff_date < 1000"), _BY, "diff_date"),
    "diff_date_slow": lambda d: (d.features.where("diff_date > 1000"), _BY, "diff_date"),
    "first_amount_by_country": lambda d: (
        facts.users_of_fraud_countries(d.features).where("first_amount > 0 AND first_amount < 100"),
        [*_BY, "country"], "first_amount"),
}
QUERIES["boxplot_stats"] = lambda d: _box(d.transactions_usd, ["currency"], "amount_usd")
for _name, _make in _BOXES.items():
    QUERIES[f"eda_continuous_{_name}"] = lambda d, make=_make: _box(*make(d))
