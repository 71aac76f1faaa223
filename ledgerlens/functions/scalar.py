"""Column expressions: all built-in functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base currency, and the characters that count as white space.
USD = "USD"
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """Boolean as 0/1; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


# --- exchange-rate sheet -------------------------------------------------------------------------

def pair_base(pair: Column | str) -> Column:
    return F.upper(F.substring(_col(pair), 1, 3))


def pair_quote(pair: Column | str) -> Column:
    """Everything after the third character, however long."""
    pair = _col(pair)
    return F.upper(pair.substr(F.lit(4), F.length(pair)))


# --- merchant country ----------------------------------------------------------------------------

def clean_merchant_country(code: Column | str) -> Column:
    """Last three characters, upper case, white space of any kind stripped."""
    return F.trim(F.upper(F.right(_col(code), F.lit(3))), F.lit(WHITE_SPACE))


def strip_leading_zeros(code: Column | str) -> Column:
    """All-digit codes without leading zeros (036 is 36, 000 is 0); others untouched."""
    return F.regexp_replace(_col(code), "^0+(?=[0-9]+$)", "")


# --- time ----------------------------------------------------------------------------------------

def _second_of_day(ts: Column) -> Column:
    return (
        F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    )


def seconds_between(end: Column | str, start: Column | str) -> Column:
    """``end - start`` in seconds, negative when reversed; independent of the session time zone."""
    end, start = _col(end), _col(start)
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("double")
    return days * 86400 + (_second_of_day(end) - _second_of_day(start))


def whole_days_between(end: Column | str, start: Column | str) -> Column:
    return F.floor(seconds_between(end, start) / 86400).cast("int")


def nearest_day(ts: Column | str) -> Column:
    """Nearest day; exact noon goes to the even day number counted from 1970-01-01."""
    ts = _col(ts)
    day = F.unix_date(F.to_date(ts))
    noon = F.to_date(ts).cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    at = ts.cast("timestamp_ntz")
    shift = F.when(at > noon, 1).when(at == noon, F.pmod(day, F.lit(2))).otherwise(0)
    return F.date_from_unix_date(day + shift)


# --- money ---------------------------------------------------------------------------------------

def minor_units_to_usd(
    currency: Column | str, rate: Column | str, amount: Column | str, exponent: Column | str
) -> Column:
    """Minor units to USD; USD needs no rate, a missing rate or exponent gives NULL."""
    applied = F.when(_col(currency) == USD, F.lit(1.0)).otherwise(_col(rate))
    return applied * _col(amount) / F.pow(F.lit(10.0), _col(exponent))


def stable_avg(value: Column | str) -> Column:
    """Plain mean; nothing is cut from the values.

    Where all of them are decimals of at most 18 places they are summed as such, so that the result
    does not depend on row order, task layout or retries. Other values are averaged as doubles.
    """
    value = _col(value).cast("double")
    exact = value.try_cast("decimal(38,18)")

    def number(c: Column) -> Column:
        return c.cast("string").cast("double")  # by way of text: the direct cast is off by a bit

    whole = F.bool_and(number(exact).eqNullSafe(value))
    mean = number(F.try_sum(exact)) / F.nullif(F.count(value), F.lit(0))
    return F.coalesce(F.when(whole, mean), F.avg(value))


def pct_round(share: Column | str) -> Column:
    return F.round(_col(share) * 100, 2)


# --- table-level helpers -------------------------------------------------------------------------

def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )


def project_declared(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def fill_na_by_config(df: DataFrame, per_column: dict, default) -> DataFrame:
    """Fill the named columns, then every other number or text column with the default.

    Dates and times without a fill of their own stay NULL: they cannot hold the default.
    """
    filled = []
    for f in df.schema:
        kind, value = f.dataType.typeName(), F.col(f.name)
        if f.name in per_column:
            value = F.coalesce(value, F.lit(per_column[f.name]).cast(f.dataType))
        elif kind in ("string", "double", "float", "integer", "long", "short", "byte", "decimal"):
            value = F.coalesce(value, F.lit(default).cast(f.dataType))
            if kind in ("double", "float"):
                value = F.nanvl(value, F.lit(default).cast(f.dataType))
        filled.append(value.alias(f.name))
    return df.select(*filled)
