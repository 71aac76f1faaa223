"""SQL with the same results, for DuckDB over the base tables."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerlens.sources import fixtures as fx
from ledgerlens.sources import schemas


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql.format(ntz='TIMESTAMP')} AS {name}" for name, sql in columns.items())


_DICTIONARY = (
    "SELECT upper(code3) AS key, upper(code) AS code2 FROM countries"
    " WHERE code IS NOT NULL AND code3 IS NOT NULL AND numcode IS NOT NULL"
    " UNION ALL SELECT CAST(numcode AS VARCHAR), upper(code) FROM countries"
    " WHERE code IS NOT NULL AND code3 IS NOT NULL AND numcode IS NOT NULL"
)
_DIGITS = (
    "CASE WHEN regexp_full_match({c}, '[0-9]+')"
    " THEN CAST(TRY_CAST({c} AS BIGINT) AS VARCHAR) ELSE {c} END"
)
_TX = (
    "id, currency, amount, state, created_date, merchant_category, {mc} AS merchant_country,"
    " entry_method, user_id, type, source"
)
_DAY = "(DATE '1970-01-01' + CAST(round_even(epoch_us({t}) / 86400000000.0, 0) AS INTEGER))"
# The shortest decimals of the values, summed exactly, in any order.
_MEAN = (
    "CAST(CAST(sum(CAST(CAST({v} AS VARCHAR) AS DECIMAL(38, 18))) AS VARCHAR) AS DOUBLE) / count({v})"
)

# Six decimals of the shortest decimal text, halves away from zero.
_HALF_UP = "CAST(CAST(CAST(CAST({v} AS VARCHAR) AS DECIMAL(38, 6)) AS VARCHAR) AS DOUBLE)"

# Common tables, each written with the ones before it.
CTES = {
    "users": f"SELECT {_columns(fx.USERS)} FROM customer",
    "raw_transactions": f"SELECT {_columns(fx.TRANSACTIONS)} FROM orders",
    "fx_rates": f"SELECT ts, base_ccy, ccy, CAST({fx.FX_RATE} AS DOUBLE) AS rate"
    f" FROM (SELECT l_orderkey, {_columns(fx.FX_KEYS)} FROM lineitem) GROUP BY ts, base_ccy, ccy",
    "fx_wide": f"SELECT ts, {_columns(fx.FX_WIDE)} FROM fx_rates GROUP BY ts",
    "currency_details": fx.CURRENCY_DETAILS,
    "countries": fx.COUNTRIES,
    "fraudsters": f"SELECT {_columns(fx.FRAUDSTERS)} FROM customer WHERE c_acctbal < 0",
    "dictionary": _DICTIONARY,
    "keyed": "SELECT *, trim(upper(right(merchant_country, 3))) AS cleaned FROM raw_transactions",
    "transactions": "SELECT "
    + _TX.format(mc=f"coalesce(code2, {_DIGITS.format(c='cleaned')})")
    + f" FROM keyed LEFT JOIN dictionary ON key = {_DIGITS.format(c='cleaned')}",
    "daily": f"SELECT {_DAY.format(t='ts')} AS day, ccy, {_MEAN.format(v='rate')} AS rate"
    " FROM fx_rates WHERE base_ccy = 'USD' GROUP BY 1, 2",
    "transactions_usd": "SELECT t.*, CASE WHEN currency = 'USD' THEN CAST(1 AS DOUBLE) ELSE rate END"
    " * amount / pow(CAST(10 AS DOUBLE), exponent) AS amount_usd"
    f" FROM transactions t LEFT JOIN daily d ON {_DAY.format(t='t.created_date')} = d.day"
    " AND t.currency = d.ccy LEFT JOIN currency_details c ON t.currency = c.ccy",
    "first_dates": "SELECT user_id AS u, min(created_date) AS first_created FROM transactions GROUP BY 1",
    "marked": "SELECT t.*, first_created AS first_date, CASE WHEN first_created IS NOT NULL"
    " AND state = 'COMPLETED' THEN amount_usd END AS first_amount,"
    " user_id IN (SELECT user_id FROM fraudsters) AS is_fraudster"
    " FROM transactions_usd t LEFT JOIN first_dates ON user_id = u AND created_date = first_created",
    "first_cards": "SELECT DISTINCT t.user_id, t.created_date, t.currency, t.amount"
    " FROM transactions t JOIN first_dates ON t.user_id = u AND t.created_date = first_created"
    " WHERE t.type = 'CARD_PAYMENT' AND t.state = 'COMPLETED'",
    "first_one": "SELECT user_id, created_date AS first_date,"
    " CASE WHEN state = 'COMPLETED' THEN amount_usd END AS first_amount FROM (SELECT *,"
    " row_number() OVER (PARTITION BY user_id ORDER BY created_date, id) AS rn"
    " FROM transactions_usd) WHERE rn = 1",
    "facts": "SELECT user_id, count(DISTINCT currency) AS cnt_currency,"
    f" {_HALF_UP.format(v=_MEAN.format(v='amount_usd'))} AS mean_amount FROM transactions_usd GROUP BY 1",
}
for _v in ("source", "type", "state"):
    CTES[f"{_v}_counts"] = (
        f"SELECT user_id, {_v} AS value, count(*) AS cnt FROM transactions GROUP BY 1, 2"
    )
    CTES[f"{_v}_mode"] = (
        f"SELECT user_id, value, cnt FROM (SELECT *, row_number() OVER (PARTITION BY user_id"
        f" ORDER BY cnt DESC, value) AS rn FROM {_v}_counts) WHERE rn = 1"
    )
CTES["user_match"] = (
    "SELECT u.id, max(CASE WHEN t.merchant_country = u.country THEN 1 ELSE 0 END) AS is_user_country"
    " FROM users u LEFT JOIN transactions t ON t.user_id = u.id GROUP BY 1"
)
_DAYS = "CAST(floor(epoch(created_date - (SELECT min(created_date) FROM users)) / 86400) AS INTEGER)"
CTES["features"] = (
    "SELECT u.id, CAST(u.has_email AS INTEGER) AS has_email,"
    " coalesce(u.phone_country, '-1') AS phone_country, u.is_fraudster,"
    " strftime(coalesce(u.terms_version, DATE '2000-01-01'), '%Y-%m-%d') AS terms_version,"
    f" {_DAYS.replace('created_date -', 'u.created_date -')} AS created_date,"
    " coalesce(u.country, '-1') AS country,"
    " coalesce(u.birth_year, -1) AS birth_year, coalesce(u.kyc, '-1') AS kyc,"
    " u.failed_sign_in_attempts, u.created_date AS created_date_origin,"
    " coalesce(strftime(u.terms_version, '%Y-%m-%d'), '-1') AS terms_version_origin,"
    " CASE WHEN u.state = 'LOCK' THEN 1 ELSE 0 END AS is_lock,"
    " coalesce(o.first_amount, -1) AS first_amount, o.first_date,"
    " CASE WHEN u.country = 'GB' THEN 1 ELSE 0 END AS country_gb,"
    " coalesce(epoch(o.first_date - u.created_date), -1) AS diff_date,"
    " CASE WHEN o.first_amount > 0 THEN 1 ELSE 0 END AS first_success,"
    " coalesce(sm.value, '-1') AS source_freq, coalesce(tm.value, '-1') AS type_freq,"
    " coalesce(st.value, '-1') AS state_freq,"
    " CASE WHEN sm.value = 'MINOS' THEN 1 ELSE 0 END AS source_minos, m.is_user_country,"
    " CASE WHEN f.user_id IS NOT NULL THEN 1 ELSE 0 END AS has_transactions,"
    " CAST(coalesce(f.cnt_currency, 0) AS INTEGER) AS cnt_currency,"
    " coalesce(f.mean_amount, -1) AS mean_amount"
    " FROM users u LEFT JOIN first_one o ON o.user_id = u.id LEFT JOIN facts f ON f.user_id = u.id"
    " LEFT JOIN source_mode sm ON sm.user_id = u.id LEFT JOIN type_mode tm ON tm.user_id = u.id"
    " LEFT JOIN state_mode st ON st.user_id = u.id JOIN user_match m ON m.id = u.id"
)

_NEEDS = {
    "fx_wide": ["fx_rates"],
    "dictionary": ["countries"],
    "keyed": ["raw_transactions"],
    "transactions": ["keyed", "dictionary"],
    "daily": ["fx_rates"],
    "transactions_usd": ["transactions", "daily", "currency_details"],
    "first_dates": ["transactions"],
    "marked": ["transactions_usd", "first_dates", "fraudsters"],
    "first_cards": ["transactions", "first_dates"],
    "first_one": ["transactions_usd"],
    "facts": ["transactions_usd"],
    "user_match": ["users", "transactions"],
    "features": ["users", "first_one", "facts", "source_mode", "type_mode", "state_mode", "user_match"],
    **{f"{v}_counts": ["transactions"] for v in ("source", "type", "state")},
    **{f"{v}_mode": [f"{v}_counts"] for v in ("source", "type", "state")},
}


def sql(select: str, *tables: str, **extra: str) -> str:
    """``select`` preceded by the common tables it names and by its own extra ones."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for before in _NEEDS.get(name, []):
            need(before)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        need(name)
    parts = [f"{name} AS ({CTES[name]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {select}"


_USERS_OUT = (
    "id, has_email, phone_country, is_fraudster, {tv} AS terms_version, created_date, state, country,"
    " birth_year, kyc, failed_sign_in_attempts"
)
_TV = "strftime(terms_version, '%Y-%m-%d')"
_RAW = _TX.format(mc="merchant_country")
_NOT_NULL = {
    "users": ["id", "has_email", "is_fraudster", "created_date", "state"],
    "transactions": ["id", "currency", "amount", "state", "created_date", "entry_method", "user_id",
                     "type", "source"],
    "fx_rates": ["ts", "base_ccy", "ccy"],
    "currency_details": ["ccy", "is_crypto"],
}
_LENGTHS = {
    "users": {"phone_country": 300, "state": 25, "country": 2, "kyc": 20},
    "transactions": {"currency": 3, "state": 25, "merchant_category": 100, "merchant_country": 3,
                     "entry_method": 4, "type": 20, "source": 20},
    "fx_rates": {"base_ccy": 3, "ccy": 10},
    "currency_details": {"ccy": 10},
}
_KEYS = {"users": ["id"], "transactions": ["id"], "fx_rates": ["ts", "base_ccy", "ccy"],
         "currency_details": ["ccy"]}


def _column_sums() -> str:
    """Values and checksum of every column of the four tables as they are loaded."""
    parts = []
    for table in schemas.TABLES.values():
        for c in table.columns:
            text = f"CAST({c.name} AS VARCHAR)"
            if isinstance(c.type, T.TimestampNTZType):
                text = f"strftime({c.name}, '%Y-%m-%d %H:%M:%S')"
            elif isinstance(c.type, T.DoubleType):
                text = f"CAST(CAST(round({c.name} * 10000) AS BIGINT) AS VARCHAR)"
            elif isinstance(c.type, T.BooleanType):
                text = f"CAST(CAST({c.name} AS INTEGER) AS VARCHAR)"
            parts.append(
                f"SELECT '{table.name}' AS table_name, '{c.name}' AS column_name, count({c.name}) AS n_values,"
                f" CAST(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) AS BIGINT) AS checksum,"
                f" count(*) AS loaded, true AS ok FROM {table.name}")
    return " UNION ALL ".join(parts)


def _constraints() -> str:
    parts = []
    for t, names in _NOT_NULL.items():
        source = "raw_transactions" if t == "transactions" else t
        for c in names:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS rule,"
                         f" count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {source}")
        for c, n in _LENGTHS[t].items():
            parts.append(f"SELECT '{t}', '{c}', 'max_length',"
                         f" count(*) FILTER (WHERE length({c}) > {n}) FROM {source}")
        key = ", ".join(_KEYS[t])
        parts.append(f"SELECT '{t}', '{'+'.join(_KEYS[t])}', 'primary_key', count(*) FROM"
                     f" (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)")
    return sql(" UNION ALL ".join(parts), "users", "raw_transactions", "fx_rates", "currency_details")


def _crosstab(table: str, row: str, col: str, where: str = "true") -> dict[str, str]:
    """Cells and margins of a contingency table, as text."""
    return {
        "base": f"SELECT CAST({row} AS VARCHAR) AS r, CAST({col} AS VARCHAR) AS c FROM {table}"
        f" WHERE {row} IS NOT NULL AND {col} IS NOT NULL AND {where}",
        "cells": "SELECT r AS row_value, c AS col_value, 0 AS margin, count(*) AS n FROM base GROUP BY 1, 2"
        " UNION ALL SELECT 'All', c, 2, count(*) FROM base GROUP BY 2"
        " UNION ALL SELECT r, 'All', 1, count(*) FROM base GROUP BY 1"
        " UNION ALL SELECT 'All', 'All', 3, count(*) FROM base HAVING count(*) > 0",
        "totals": "SELECT row_value AS tr, margin - 1 AS tm, n AS total FROM cells WHERE margin % 2 = 1",
    }


_PCT = "round(100 * (CAST(n AS DOUBLE) / total), 2) AS pct"
_SHARES = f"{_PCT} FROM cells JOIN totals ON row_value = tr AND margin = tm"


def _eda(table: str, col: str, where: str = "true") -> str:
    return sql(f"SELECT row_value, col_value, n, {_SHARES}", table, "fraudsters",
               **_crosstab(table, "is_fraudster", col, where))


def _box(table: str, groups: str, value: str, where: str = "true", source: str | None = None) -> str:
    same = " AND ".join(f"b.{g.strip()} = q.{g.strip()}" for g in groups.split(","))
    present = " AND ".join(f"{g.strip()} IS NOT NULL" for g in groups.split(","))
    q = ", ".join(f"q.{g.strip()}" for g in groups.split(","))
    inside = "v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return sql(
        f"SELECT {q}, q.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,"
        f" round(min(v) FILTER (WHERE {inside}), 6) AS whisker_low,"
        f" round(max(v) FILTER (WHERE {inside}), 6) AS whisker_high,"
        f" count(*) FILTER (WHERE NOT ({inside})) AS outliers"
        f" FROM b JOIN q ON {same} GROUP BY {q}, q.n, q1, median, q3",
        table,
        b=f"SELECT {groups}, CAST({value} AS DOUBLE) AS v FROM {source or table}"
        f" WHERE {value} IS NOT NULL AND {present} AND {where}",
        q=f"SELECT {groups}, count(*) AS n, quantile_cont(v, 0.25) AS q1,"
        f" quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM b GROUP BY {groups}",
    )


_ONE_HOT = {
    "terms_version": ["1994-05-25", "1994-09-20", "2000-01-01"],
    "type_freq": ["-1", "ATM", "BANK_TRANSFER", "CARD_PAYMENT", "TOPUP"],
    "state_freq": ["-1", "COMPLETED", "DECLINED", "PENDING"],
    "kyc": ["-1", "FAILED", "NONE", "SUCCESS"],
}
_NUMERIC = ["created_date", "birth_year", "has_email", "source_minos", "first_success", "country_gb",
            "diff_date", "has_transactions", "cnt_currency"]


def _long_one_hot(extra_keys: str = "", cast: str = "INTEGER") -> list[str]:
    """Every value that occurs in the table against every row."""
    return [
        f"SELECT f.id{extra_keys}, '{c}_' || v.value AS feature,"
        f" CAST(CASE WHEN f.{c} = v.value THEN 1 ELSE 0 END AS {cast}) AS value"
        f" FROM features f CROSS JOIN (SELECT DISTINCT {c} AS value FROM features) v"
        for c in _ONE_HOT
    ]


def _matrix() -> str:
    parts = [
        f"SELECT id, CAST(is_fraudster AS INTEGER) AS label, '{c}' AS feature,"
        f" CAST({c} AS DOUBLE) AS value FROM features"
        for c in _NUMERIC
    ]
    parts += _long_one_hot(", CAST(f.is_fraudster AS INTEGER) AS label", "DOUBLE")
    return " UNION ALL ".join(parts)


def _align() -> str:
    parts = [
        f"SELECT u.id, '{c}_' || v.value AS feature, CASE WHEN NOT v.seen THEN -1.0"
        f" WHEN u.{c} = v.value THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM users u CROSS JOIN"
        f" (SELECT {c} AS value, bool_or(is_fraudster) AS seen FROM users WHERE {c} IS NOT NULL"
        f" GROUP BY {c}) v WHERE u.is_fraudster"
        for c in ("kyc", "country")
    ]
    return sql(" UNION ALL ".join(parts), "users")


_CORR = sorted([
    "has_email", "is_fraudster", "created_date", "birth_year", "failed_sign_in_attempts", "is_lock",
    "first_amount", "country_gb", "diff_date", "first_success", "source_minos", "is_user_country",
    "has_transactions", "cnt_currency", "mean_amount",
])


def _correlation() -> str:
    nums = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CORR)
    parts = [
        f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0"
        f" THEN round(corr({a}, {b}), 6) END AS corr FROM nums"
        for i, a in enumerate(_CORR) for b in _CORR[i:]
    ]
    return sql(" UNION ALL ".join(parts), "features", nums=f"SELECT {nums} FROM features")


def _profile() -> str:
    kind = (
        "CASE typeof(any_value({c})) WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'"
        " WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof(any_value({c}))) END"
    )
    return sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS n_rows,"
            f" count({c}) AS non_null, {kind.format(c=c)} AS type FROM {table}"
            for name, table, columns in (
                ("users", "users", fx.USERS), ("transactions", "raw_transactions", fx.TRANSACTIONS))
            for c in columns
        ),
        "users", "raw_transactions",
    )


_PAIRS = " UNION ALL ".join(
    f"SELECT ts, '{p}' AS pair, {p} AS rate FROM fx_wide" for p in fx.FX_WIDE
)
_ASOF = (
    "SELECT t.*, r.ts AS rate_ts, r.rate FROM {t} t ASOF LEFT JOIN"
    " (SELECT * FROM fx_rates WHERE base_ccy = 'USD') r ON t.currency = r.ccy AND t.created_date >= r.ts"
)
# The report, joined to every earlier rate and then to the latest of them.
_REPORT = sql(
    "SELECT user_id, amount_usd FROM converted WHERE amount_usd >= 10 ORDER BY amount_usd DESC",
    "first_cards", "fx_rates", "currency_details",
    latest="SELECT f.user_id, f.created_date, f.currency, f.amount, max(r.ts) AS rate_ts"
    " FROM first_cards f LEFT JOIN fx_rates r ON r.ccy = f.currency AND r.base_ccy = 'USD'"
    " AND r.ts <= f.created_date GROUP BY 1, 2, 3, 4",
    converted="SELECT l.user_id, CASE WHEN l.currency = 'USD' THEN CAST(1 AS DOUBLE) ELSE r.rate END"
    " * l.amount / pow(CAST(10 AS DOUBLE), c.exponent) AS amount_usd FROM latest l"
    " LEFT JOIN fx_rates r ON r.ts = l.rate_ts AND r.ccy = l.currency AND r.base_ccy = 'USD'"
    " LEFT JOIN currency_details c ON c.ccy = l.currency",
)
_FEATURES_OUT = "SELECT * FROM features"

ORACLES = {
    "scan_csv": sql(f"SELECT {_RAW} FROM raw_transactions", "raw_transactions"),
    "normalize_columns": sql(f"SELECT {_RAW} FROM raw_transactions", "raw_transactions"),
    "nan_to_null": sql(
        "SELECT ts, base_ccy, ccy, CASE WHEN ccy <> 'JPY' THEN rate END AS rate FROM fx_rates", "fx_rates"),
    "project_declared": sql(f"SELECT {_RAW} FROM raw_transactions", "raw_transactions"),
    "write_table": sql(f"SELECT {_RAW} FROM raw_transactions", "raw_transactions"),
    "replace_table": sql(f"SELECT {_USERS_OUT.format(tv=_TV)} FROM users", "users"),
    "reconcile_counts": "SELECT 'transactions' AS table_name, count(*) AS loaded,"
    " count(*) AS expected, true AS ok FROM orders",
    "load_all_tables": sql(
        _column_sums(), "users", "raw_transactions", "transactions", "fx_rates", "currency_details", "fraudsters"),
    "scan_table": sql("SELECT ts, base_ccy, ccy, rate FROM fx_rates", "fx_rates"),
    "scan_table_by_key": sql(
        f"SELECT {_RAW} FROM raw_transactions WHERE user_id IN (SELECT user_id FROM fraudsters)",
        "raw_transactions", "fraudsters"),
    "run_sql_file": sql(
        "SELECT user_id, count(*) AS n, min(created_date) AS first_date FROM raw_transactions GROUP BY 1",
        "raw_transactions"),
    "validate_constraints": _constraints(),
    "prepare_currency_details": sql(
        "SELECT ccy, iso_code, exponent, is_crypto, n_used FROM currency_details LEFT JOIN (SELECT currency,"
        " count(*) AS n_used FROM raw_transactions GROUP BY 1) ON currency = ccy",
        "currency_details", "raw_transactions"),
    "prepare_fx_rates": sql(
        "SELECT ts, upper(left(pair, 3)) AS base_ccy, upper(substr(pair, 4)) AS ccy, abs(rate) AS rate"
        f" FROM ({_PAIRS}) WHERE rate IS NOT NULL", "fx_wide"),
    "parse_ccy_pair": sql(
        "SELECT pair, upper(left(pair, 3)) AS base_ccy, upper(substr(pair, 4)) AS ccy,"
        f" count(rate) AS n_rates FROM ({_PAIRS}) GROUP BY 1, 2, 3", "fx_wide"),
    "abs_rate": sql(
        f"SELECT ts, pair, abs(rate) AS rate FROM ({_PAIRS}) WHERE rate IS NOT NULL", "fx_wide"),
    "merchant_country_clean": sql("SELECT id, cleaned AS merchant_country FROM keyed", "keyed"),
    "strip_leading_zeros": sql(
        f"SELECT id, {_DIGITS.format(c='merchant_country')} AS merchant_country FROM raw_transactions",
        "raw_transactions"),
    "merchant_country_to_code2": sql("SELECT id, merchant_country FROM transactions", "transactions"),
    "overlong_merchant_country": sql(
        "SELECT count(*) FILTER (WHERE length(merchant_country) > 3) AS overlong, count(*) AS n_rows"
        " FROM raw_transactions", "raw_transactions"),
    "round_to_day": sql(
        f"SELECT id, created_date, strftime({_DAY.format(t='created_date')}, '%Y-%m-%d') AS day"
        " FROM raw_transactions", "raw_transactions"),
    "days_since_min": sql(f"SELECT id, created_date, {_DAYS} AS days FROM users", "users"),
    "seconds_between": sql(
        "SELECT id, epoch(first_created - created_date) AS diff_date FROM users"
        " LEFT JOIN first_dates ON u = id", "users", "first_dates"),
    "flag_columns": sql(
        "SELECT id, is_lock, has_email, country_gb, first_success, source_minos, is_user_country,"
        " has_transactions, CAST(is_fraudster AS INTEGER) AS label FROM features", "features"),
    "cast_terms_version": sql(f"SELECT id, {_TV} AS terms_version_origin FROM users", "users"),
    "copy_and_drop_columns": sql(
        "SELECT id, created_date AS created_date_origin, CASE WHEN state = 'LOCK' THEN 1 ELSE 0 END"
        " AS is_lock FROM users", "users"),
    "minor_units_to_usd": sql(
        "SELECT id, amount_usd FROM transactions_usd", "transactions_usd"),
    "fill_na_by_config": sql(
        "SELECT id, has_email, coalesce(phone_country, '-1') AS phone_country, is_fraudster,"
        " strftime(coalesce(terms_version, DATE '2000-01-01'), '%Y-%m-%d') AS terms_version,"
        " created_date, state, coalesce(country, '-1') AS country, coalesce(birth_year, -1) AS birth_year,"
        " coalesce(kyc, '-1') AS kyc, failed_sign_in_attempts FROM users", "users"),
    "one_hot": sql(" UNION ALL ".join(_long_one_hot()), "features"),
    "align_columns": _align(),
    "cast_features_double": sql(
        "SELECT id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC) + " FROM features",
        "features"),
    "pct_round": sql(
        "SELECT country, round(avg(CAST(is_fraudster AS INTEGER)) * 100, 2) AS fraud_pct FROM users"
        " GROUP BY 1", "users"),
    "prepare_users": sql(f"SELECT {_USERS_OUT.format(tv=_TV)} FROM users", "users"),
    "prepare_transactions": sql("SELECT * FROM transactions", "transactions"),
    "filter_base_usd": sql("SELECT * FROM fx_rates WHERE base_ccy = 'USD'", "fx_rates"),
    "filter_completed_card": sql("SELECT * FROM first_cards", "first_cards"),
    "filter_min_amount": sql(
        "SELECT id, amount_usd FROM transactions_usd WHERE amount_usd >= 10", "transactions_usd"),
    "filter_not_null": sql(
        "SELECT key, code2, n FROM dictionary LEFT JOIN (SELECT"
        f" {_DIGITS.format(c='cleaned')} AS k, count(*) AS n FROM keyed WHERE cleaned IS NOT NULL GROUP BY 1)"
        " ON k = key", "dictionary", "keyed"),
    "range_slices": sql(
        "SELECT id, CASE WHEN first_amount < 100 THEN 'small' WHEN first_amount > 100 THEN 'big' END"
        " AS first_amount_slice, CASE WHEN first_amount > 0 AND first_amount < 100 THEN 'yes' ELSE 'no' END"
        " AS first_amount_0_100, CASE WHEN mean_amount < 1000 THEN 'small' WHEN mean_amount >= 1000"
        " THEN 'big' END AS mean_amount_slice, CASE WHEN diff_date < 1000 THEN 'fast'"
        " WHEN diff_date > 1000 THEN 'slow' END AS diff_date_slice FROM features", "features"),
    "empty_input_guard": "SELECT c_custkey AS id, 0 AS has_transactions, 0 AS cnt_currency,"
    " CAST(-1 AS DOUBLE) AS mean_amount, '-1' AS source_freq, CAST(NULL AS TIMESTAMP) AS first_date"
    " FROM customer",
    "first_transactions_join": sql(
        "SELECT t.* FROM transactions t JOIN first_dates ON user_id = u AND created_date = first_created",
        "transactions", "first_dates"),
    "asof_fx_rate": sql(
        _ASOF.format(t="(SELECT id, currency, created_date FROM transactions)"), "transactions", "fx_rates"),
    "left_join_currency": sql(
        "SELECT id, currency, exponent FROM transactions LEFT JOIN currency_details ON ccy = currency",
        "transactions", "currency_details"),
    "daily_fx_join": sql(
        "SELECT id, currency, created_date, rate FROM transactions LEFT JOIN daily"
        f" ON day = {_DAY.format(t='created_date')} AND ccy = currency", "transactions", "daily"),
    "inner_join_currency": sql(
        "SELECT id, currency, exponent FROM transactions JOIN currency_details ON ccy = currency",
        "transactions", "currency_details"),
    "first_flag_left_join": sql("SELECT id, user_id, first_date FROM marked", "marked"),
    "users_left_join_facts": sql(
        "SELECT u.id, u.country, o.first_date, o.first_amount, m.value AS source_freq FROM users u"
        " LEFT JOIN first_one o ON o.user_id = u.id LEFT JOIN source_mode m ON m.user_id = u.id",
        "users", "first_one", "source_mode"),
    "membership_flag": sql("SELECT id, user_id, is_fraudster FROM marked", "marked"),
    "semi_join_fraud_countries": sql(
        "SELECT id, country, is_fraudster FROM users WHERE country IN"
        " (SELECT country FROM users WHERE is_fraudster)", "users"),
    "first_date_by_user": sql(
        "SELECT u AS user_id, first_created AS first_date FROM first_dates", "first_dates"),
    "latest_rate_ts": sql(
        "SELECT f.user_id, f.created_date, f.currency, f.amount, max(r.ts) AS rate_ts FROM first_cards f"
        " LEFT JOIN fx_rates r ON r.ccy = f.currency AND r.base_ccy = 'USD' AND r.ts <= f.created_date"
        " GROUP BY 1, 2, 3, 4", "first_cards", "fx_rates"),
    "daily_mean_fx": sql("SELECT strftime(day, '%Y-%m-%d') AS day, ccy, rate FROM daily", "daily"),
    "count_by_user_value": sql("SELECT user_id, value, cnt FROM source_counts", "source_counts"),
    "user_transaction_features": sql(
        "SELECT u.id AS user_id, m.is_user_country, CASE WHEN f.user_id IS NOT NULL THEN 1 ELSE 0 END"
        " AS has_transactions, coalesce(f.cnt_currency, 0) AS cnt_currency, f.mean_amount FROM users u"
        " LEFT JOIN facts f ON f.user_id = u.id JOIN user_match m ON m.id = u.id",
        "users", "facts", "user_match"),
    "any_flag": sql(
        "SELECT user_id, max(CASE WHEN source = 'MINOS' THEN 1 ELSE 0 END) AS any_minos FROM transactions"
        " GROUP BY 1", "transactions"),
    "max_amount_by_user": sql(
        "SELECT user_id, is_fraudster, max(amount_usd) AS amount_usd FROM marked GROUP BY 1, 2", "marked"),
    "crosstab_counts": sql(
        "SELECT row_value, col_value, margin, n FROM cells", "users", **_crosstab("users", "is_fraudster", "kyc")),
    "crosstab_wide": sql(
        "SELECT row_value, " + ", ".join(
            f"CAST(coalesce(sum(n) FILTER (WHERE col_value = '{v}'), 0) AS BIGINT) AS \"{v}\""
            for v in ("FAILED", "NONE", "SUCCESS", "All")) + " FROM cells GROUP BY 1",
        "users", **_crosstab("users", "is_fraudster", "kyc")),
    "crosstab_row_pct": sql(
        f"SELECT row_value, col_value, {_SHARES}", "users", **_crosstab("users", "is_fraudster", "kyc")),
    "crosstab_long": sql(
        f"SELECT row_value, col_value, {_SHARES}", "users", **_crosstab("users", "is_fraudster", "country")),
    "correlation_matrix": _correlation(),
    "profile_table": _profile(),
    "distinct_values": sql("SELECT DISTINCT country FROM users WHERE is_fraudster", "users"),
    "row_count": "SELECT 'transactions' AS table_name, count(*) AS n_rows FROM orders",
    "mark_first_transactions": sql("SELECT id, user_id, first_date, first_amount FROM marked", "marked"),
    "first_transaction_per_user": sql("SELECT * FROM first_one", "first_one"),
    "mode_by_user": sql(
        "SELECT s.user_id, s.value AS source_freq, t.value AS type_freq, x.value AS state_freq"
        " FROM source_mode s JOIN type_mode t ON t.user_id = s.user_id"
        " JOIN state_mode x ON x.user_id = s.user_id", "source_mode", "type_mode", "state_mode"),
    "order_by_amount": sql(
        "SELECT id, amount_usd FROM transactions_usd ORDER BY amount_usd DESC NULLS LAST", "transactions_usd"),
    "sort_for_top1": sql("SELECT user_id, value, cnt FROM type_mode", "type_mode"),
    "head": sql(f"SELECT {_USERS_OUT.format(tv=_TV)} FROM users ORDER BY id LIMIT 5", "users"),
    "users_first_tx_over_10usd": _REPORT,
    "convert_to_usd_daily": sql("SELECT id, amount_usd FROM transactions_usd", "transactions_usd"),
    "transactions_enriched": sql("SELECT * FROM marked", "marked"),
    "users_converted": sql(
        f"SELECT id, has_email, phone_country, is_fraudster, {_TV} AS terms_version,"
        f" {_DAYS} AS created_date, country, birth_year, kyc, failed_sign_in_attempts,"
        f" created_date AS created_date_origin, {_TV} AS terms_version_origin,"
        " CASE WHEN state = 'LOCK' THEN 1 ELSE 0 END AS is_lock FROM users", "users"),
    "user_feature_table": sql(_FEATURES_OUT, "features"),
    "user_feature_table_by_key": sql(_FEATURES_OUT + " WHERE is_fraudster", "features"),
    "feature_label_matrix": sql(_matrix(), "features"),
}
for _c in ("kyc", "terms_version", "has_email", "failed_sign_in_attempts", "cnt_currency",
           "is_user_country", "has_transactions"):
    ORACLES[f"eda_categorical_{_c}"] = _eda("features", _c)
ORACLES["eda_categorical_country"] = _eda(
    "features", "country", "country IN (SELECT country FROM features WHERE is_fraudster)")
for _c in ("type", "state", "source", "entry_method"):
    ORACLES[f"eda_categorical_{_c}"] = _eda("marked", _c)

_MAXED = "(SELECT user_id, is_fraudster, max(amount_usd) AS amount_usd FROM marked GROUP BY 1, 2)"
ORACLES |= {
    "boxplot_stats": _box("transactions_usd", "currency", "amount_usd"),
    "eda_continuous_created_date": _box("features", "is_fraudster", "created_date"),
    "eda_continuous_birth_year": _box("features", "is_fraudster", "birth_year"),
    "eda_continuous_amount_by_state_small": _box(
        "marked", "is_fraudster, state", "amount_usd", "first_amount < 100"),
    "eda_continuous_amount_by_state_big": _box(
        "marked", "is_fraudster, state", "amount_usd", "first_amount > 100"),
    "eda_continuous_max_amount_small": _box(
        "marked", "is_fraudster", "amount_usd", "amount_usd < 1000", _MAXED),
    "eda_continuous_max_amount_big": _box(
        "marked", "is_fraudster", "amount_usd", "amount_usd > 1000", _MAXED),
    "eda_continuous_mean_amount_small": _box("features", "is_fraudster", "mean_amount", "mean_amount < 1000"),
    "eda_continuous_mean_amount_big": _box("features", "is_fraudster", "mean_amount", "mean_amount >= 1000"),
    "eda_continuous_diff_date_fast": _box("features", "is_fraudster", "diff_date", "diff_date < 1000"),
    "eda_continuous_diff_date_slow": _box("features", "is_fraudster", "diff_date", "diff_date > 1000"),
    "eda_continuous_first_amount_by_country": _box(
        "features", "is_fraudster, country", "first_amount",
        "first_amount > 0 AND first_amount < 100"
        " AND country IN (SELECT country FROM features WHERE is_fraudster)"),
}
