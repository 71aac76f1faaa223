"""Hand-made tables with exact expected rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalar
from ledgerlens.operators import explore, facts, features, fx, metrics
from ledgerlens.operators.actions import decide_action
from ledgerlens.plans.report import users_first_tx_over_10usd
from ledgerlens.sources import load

TX = (
    "id long, currency string, amount long, state string, created_date timestamp_ntz,"
    " merchant_category string, merchant_country string, entry_method string, user_id long,"
    " type string, source string"
)
FX = "ts timestamp_ntz, base_ccy string, ccy string, rate double"
CUR = "ccy string, iso_code int, exponent int, is_crypto boolean"
USERS = (
    "id long, has_email boolean, phone_country string, is_fraudster boolean, terms_version date,"
    " created_date timestamp_ntz, state string, country string, birth_year int, kyc string,"
    " failed_sign_in_attempts int"
)


def t(text):
    return dt.datetime.fromisoformat(text)


def tx(id, user, when, ccy="USD", amount=1234, state="COMPLETED", type="CARD_PAYMENT", source="GAIA", mc="GB"):
    return (id, ccy, amount, state, t(when), None, mc, "chip", user, type, source)


def user(id, country="GB", fraud=False, kyc="SUCCESS", terms=None, when="2020-01-01"):
    return (id, True, None, fraud, terms, t(when), "ACTIVE", country, None, kyc, 0)


@pytest.fixture(scope="module")
def currencies(spark):
    rows = [("USD", 840, 2, False), ("EUR", 978, 2, False), ("JPY", 392, 0, False), ("BTC", None, 8, True)]
    return spark.createDataFrame(rows, CUR)


@pytest.fixture(scope="module")
def rates(spark):
    rows = [
        (t("2020-01-02 08:00"), "USD", "EUR", 2.0),
        (t("2020-01-02 20:00"), "USD", "EUR", 4.0),
        (t("2020-01-05 00:00"), "USD", "EUR", 3.0),
        (t("2020-01-01 00:00"), "USD", "JPY", 0.5),
        (t("2020-01-01 00:00"), "GBP", "EUR", 99.0),
    ]
    return spark.createDataFrame(rows, FX)


def amounts(spark, currencies, rates, rows):
    df = users_first_tx_over_10usd(spark.createDataFrame(rows, TX), rates, currencies)
    return sorted((r.user_id, r.amount_usd) for r in df.collect())


def test_tie_at_first_instant(spark, currencies, rates):
    rows = [tx(1, 7, "2020-01-03"), tx(2, 7, "2020-01-03", amount=5000), tx(3, 7, "2020-01-04", amount=9900)]
    assert amounts(spark, currencies, rates, rows) == [(7, 12.34), (7, 50.0)]
    usd = fx.convert_to_usd_daily(spark.createDataFrame(rows, TX), rates, currencies)
    first = facts.first_transaction_per_user(usd).collect()
    assert [(r.user_id, r.first_amount) for r in first] == [(7, 12.34)]


def test_first_must_itself_be_a_completed_card_payment(spark, currencies, rates):
    rows = [tx(1, 7, "2020-01-03", type="ATM"), tx(2, 7, "2020-01-04")]
    assert amounts(spark, currencies, rates, rows) == []


def test_report_currency_cases(spark, currencies, rates):
    rows = [
        tx(1, 1, "2020-01-01", "EUR", 5000),  # first rate is later
        tx(2, 2, "2020-01-03", "ZZZ", 5000),  # unknown currency
        tx(3, 3, "2020-01-03", "JPY", 5000),  # no minor units
        tx(4, 4, "2020-01-02 07:59", "EUR", 5000),  # one minute early
        tx(5, 5, "2020-01-02 08:00", "EUR", 5000),  # exactly at the quote
        tx(6, 6, "2020-01-04 23:00", "EUR", 5000),  # carried over quiet days
        tx(7, 7, "2030-01-01", "EUR", 5000),  # long after the last quote
        tx(8, 8, "2020-01-03", "USD", 999),  # below the minimum
        tx(9, 9, "2020-01-02 12:00", "EUR", 5000),  # between two quotes of one day
        tx(10, 10, "2020-01-05 00:00", "EUR", 5000),  # quote at midnight
    ]
    assert amounts(spark, currencies, rates, rows) == [
        (3, 2500.0), (5, 100.0), (6, 200.0), (7, 150.0), (9, 100.0), (10, 150.0)
    ]


def test_asof_rate_far_from_threshold_uses_shuffle_join(spark, rates, monkeypatch):
    """The same rows when the quotes are too many to broadcast."""
    rows = [tx(i, i, f"2020-01-0{1 + i % 6} {i % 24:02d}:30", "EUR") for i in range(1, 60)]
    df = spark.createDataFrame(rows, TX).select("id", "currency", "created_date")
    small = sorted(fx.asof_fx_rate(df, rates).collect())
    monkeypatch.setattr(fx, "broadcast_if_small", lambda side, max_rows=0: side)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = fx.asof_fx_rate(df, rates)
        assert sorted(large.collect()) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_daily_conversion_keeps_rows_of_unknown_currency(spark, currencies, rates):
    rows = [tx(1, 1, "2020-01-02 09:00", "EUR", 100), tx(2, 1, "2020-01-02", "ZZZ"), tx(3, 1, "2020-01-02", "USD")]
    usd = fx.convert_to_usd_daily(spark.createDataFrame(rows, TX), rates, currencies)
    # 08:00 rounds to the 2nd, 20:00 to the 3rd.
    assert sorted((r.id, r.amount_usd) for r in usd.collect()) == [(1, 2.0), (2, None), (3, 12.34)]
    known = fx.inner_join_currency(spark.createDataFrame(rows, TX), currencies)
    assert sorted(r.id for r in known.collect()) == [1, 3]


def test_nearest_day(spark):
    rows = [("2020-01-01 12:00",), ("2020-01-02 12:00",), ("2020-01-02 11:59:59",), ("2020-01-02 12:00:01",),
            ("1969-12-30 12:00",), ("1969-12-31 12:00",)]
    df = spark.createDataFrame([(t(r[0]),) for r in rows], "ts timestamp_ntz")
    days = [r[0] for r in df.select(F.date_format(scalar.nearest_day("ts"), "yyyy-MM-dd")).collect()]
    assert days == ["2020-01-01", "2020-01-03", "2020-01-02", "2020-01-03", "1969-12-30", "1970-01-01"]


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(t("2021-03-28 12:00"), t("2021-03-27 12:00"))], "a timestamp_ntz, b timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = df.select(
            scalar.seconds_between("a", "b"), scalar.whole_days_between("b", "a"),
            F.date_format(scalar.nearest_day("a"), "yyyy-MM-dd"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (86400.0, -1, "2021-03-28")


def test_mode_ties_and_nulls(spark):
    rows = [tx(i, 1, "2020-01-01", source=s) for i, s in enumerate(["b", "a", "a", "b"])]
    rows += [tx(9, 2, "2020-01-01", source=None)]
    df = spark.createDataFrame(rows, TX)
    assert sorted(tuple(r) for r in facts.mode_by_user(df, ["source"]).collect()) == [(1, "a"), (2, None)]
    assert [tuple(r) for r in facts.top_value_by_user(df, "source").collect()] == [(1, "a", 2)]


def test_user_without_transactions(spark, currencies, rates):
    users = spark.createDataFrame([user(1), user(2, kyc=None)], USERS)
    rows = spark.createDataFrame([tx(1, 1, "2020-01-03", source="MINOS")], TX)
    table = features.user_feature_table(users, rows, rates, currencies)
    got = {r.id: r for r in table.collect()}
    assert (got[2].has_transactions, got[2].cnt_currency, got[2].mean_amount) == (0, 0, -1.0)
    assert (got[2].kyc, got[2].source_freq, got[2].source_minos, got[2].diff_date) == ("-1", "-1", 0, -1.0)
    assert (got[1].has_transactions, got[1].source_minos, got[1].is_user_country) == (1, 1, 1)
    assert got[1].diff_date == 2 * 86400 and got[1].terms_version == dt.date(2000, 1, 1)
    assert got[2].first_date is None
    action = decide_action(table.withColumn("probability", F.lit(0.99))).where("id = 2").first()
    assert action.action == "NOTHING" and action.action_label == "NON FRAUDSTER"


def test_country_of_null_users_never_matches(spark, currencies, rates):
    users = spark.createDataFrame([user(1, country=None)], USERS)
    rows = spark.createDataFrame([tx(1, 1, "2020-01-03", mc=None)], TX)
    usd = fx.convert_to_usd_daily(rows, rates, currencies)
    assert facts.user_transaction_features(users, usd).first().is_user_country == 0


def test_duplicate_first_instants_do_not_multiply_users(spark, currencies, rates):
    users = spark.createDataFrame([user(1), user(2)], USERS)
    rows = [tx(5, 1, "2020-01-03", amount=100), tx(4, 1, "2020-01-03", amount=200), tx(6, 2, "2020-01-04", amount=300)]
    table = features.user_feature_table(users, spark.createDataFrame(rows, TX), rates, currencies)
    assert sorted((r.id, r.first_amount) for r in table.collect()) == [(1, 2.0), (2, 3.0)]


def test_training_minimum_date_is_kept_when_scoring_one_user(spark, currencies, rates):
    users = spark.createDataFrame([user(1, when="2020-01-01"), user(2, when="2020-03-01")], USERS)
    rows = spark.createDataFrame([tx(1, 2, "2020-03-02")], TX)
    start = features.min_created_date(users)
    table = features.user_feature_table_by_key(users, rows, rates, currencies, 2, start)
    assert [(r.id, r.created_date) for r in table.collect()] == [(2, 60)]


def test_empty_input(spark, currencies, rates):
    users = spark.createDataFrame([], USERS)
    rows = spark.createDataFrame([], TX)
    full = features.user_feature_table(spark.createDataFrame([user(1)], USERS), rows, rates, currencies)
    empty = features.user_feature_table(users, rows, rates, currencies)
    assert empty.count() == 0 and empty.schema == full.schema
    assert users_first_tx_over_10usd(rows, rates, currencies).count() == 0


def test_merchant_codes(spark):
    countries = spark.createDataFrame(
        [("au", "aus", 36), ("DE", "DEU", 276), ("AQ", None, None)], "code string, code3 string, numcode int"
    )
    raw = spark.createDataFrame(
        [(i, v) for i, v in enumerate(["036", "BerlinDEU", " us", "XYZ", None, "\tde\n", "000"])],
        "id long, merchant_country string",
    )
    cleaned = raw.withColumn("merchant_country", scalar.clean_merchant_country("merchant_country"))
    out = load.merchant_country_to_code2(cleaned, countries).orderBy("id").collect()
    assert [r.merchant_country for r in out] == ["AU", "DE", "US", "XYZ", None, "DE", "0"]


def test_numeric_code_wins_over_letters(spark):
    countries = spark.createDataFrame(
        [("XA", "12", 99), ("XB", "BBB", 12)], "code string, code3 string, numcode int"
    )
    assert dict(map(tuple, load.country_dictionary(countries).collect()))["12"] == "XB"


def test_wide_rates(spark):
    sheet = spark.createDataFrame(
        [(t("2020-01-01"), None, -2.0, 1.5)], "x timestamp_ntz, usdeur double, usdgbp double, usdusdtx double"
    )
    rows = sorted(tuple(r)[1:] for r in load.prepare_fx_rates(sheet).collect())
    assert rows == [("USD", "GBP", 2.0), ("USD", "USDTX", 1.5)]


def test_fill_leaves_times_null(spark):
    df = spark.createDataFrame(
        [(None, None, None, float("nan"))], "a int, b string, c timestamp_ntz, d double"
    )
    assert tuple(scalar.fill_na_by_config(df, {}, -1).first()) == (-1, "-1", None, -1.0)


@pytest.mark.parametrize(
    "p, lock, mean, kyc, minos, action",
    [
        (0.7, 0, 0.0, "SUCCESS", 0, "BOTH"),
        (0.6, 0, 0.0, "SUCCESS", 0, "ALERT"),
        (0.6999, 1, 0.0, "SUCCESS", 0, "BOTH"),
        (0.65, 0, 1000.0, "SUCCESS", 0, "BOTH"),
        (0.65, 0, 999.0, "failed", 0, "BOTH"),
        (0.65, 0, 999.0, "FAILED", 0, "ALERT"),
        (0.5, 0, 0.0, "SUCCESS", 0, "NOTHING"),
        (0.5, 0, 0.0, "SUCCESS", 1, "ALERT"),
        (0.5, 0, 0.0, "-1", 0, "ALERT"),
        (0.4999, 1, 5000.0, "-1", 1, "NOTHING"),
    ],
)
def test_action_edges(spark, p, lock, mean, kyc, minos, action):
    df = spark.createDataFrame(
        [(p, 1, lock, mean, kyc, minos)],
        "probability double, has_transactions int, is_lock int, mean_amount double, kyc string, source_minos int",
    )
    assert decide_action(df).first().action == action
    upper = decide_action(df, ignore_case=True).first().action
    assert upper == ("BOTH" if kyc == "FAILED" else action)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0, 0.3), (1, 0.3), (0, 0.3), (1, 0.3)], "label int, score double")
    assert metrics.roc_auc(df).first().auc == 0.5
    one_class = df.where("label = 1")
    assert metrics.roc_auc(one_class).first().auc is None


def test_profile_has_types(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert sorted(map(tuple, explore.profile_table(df).collect())) == [("a", 1, 1, "int"), ("b", 1, 0, "string")]


def test_correlation_with_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, 7.0, 5.0, 0.0), (4.0, 8.0, 5.0, 3.0)]
    got = {
        (r.a, r.b): r["corr"]
        for r in explore.correlation_matrix(spark.createDataFrame(rows, "a double, b double, c double, d double")).collect()
    }
    assert len(got) == 10 and got["a", "c"] is None and got["c", "c"] is None and got["c", "d"] is None
    import numpy as np

    a, b, d = (np.array([r[i] for r in rows], dtype=float) for i in (0, 1, 3))
    assert got["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert got["b", "d"] == pytest.approx(np.corrcoef(b[1:], d[1:])[0, 1])
