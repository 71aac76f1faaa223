"""Every query that has SQL gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry_points
from check_oracles import compare

ORACLES = entry_points.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, key):
    ok, text, _ = compare(spark, key, sf_dir)
    assert ok, text


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["user_id", "amount_usd"]
    assert df.count() > 0
