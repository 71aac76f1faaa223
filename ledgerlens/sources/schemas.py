"""Declared table schemas and the constraints that go with them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    nullable: bool = True
    max_length: int | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = field(default=())

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, c.nullable) for c in self.columns])


_text, _int, _bool = T.StringType(), T.IntegerType(), T.BooleanType()
_time = T.TimestampNTZType()

USERS = Table(
    "users",
    (
        Column("id", _text, False),
        Column("has_email", _bool, False),
        Column("phone_country", _text, True, 300),
        Column("is_fraudster", _bool, False),
        Column("terms_version", T.DateType()),
        Column("created_date", _time, False),
        Column("state", _text, False, 25),
        Column("country", _text, True, 2),
        Column("birth_year", _int),
        Column("kyc", _text, True, 20),
        Column("failed_sign_in_attempts", _int),
    ),
    ("id",),
)
TRANSACTIONS = Table(
    "transactions",
    (
        Column("id", _text, False),
        Column("currency", _text, False, 3),
        Column("amount", T.LongType(), False),
        Column("state", _text, False, 25),
        Column("created_date", _time, False),
        Column("merchant_category", _text, True, 100),
        Column("merchant_country", _text, True, 3),
        Column("entry_method", _text, False, 4),
        Column("user_id", _text, False),
        Column("type", _text, False, 20),
        Column("source", _text, False, 20),
    ),
    ("id",),
)
FX_RATES = Table(
    "fx_rates",
    (
        Column("ts", _time, False),
        Column("base_ccy", _text, False, 3),
        Column("ccy", _text, False, 10),
        Column("rate", T.DoubleType()),
    ),
    ("ts", "base_ccy", "ccy"),
)
CURRENCY_DETAILS = Table(
    "currency_details",
    (
        Column("ccy", _text, False, 10),
        Column("iso_code", _int),
        Column("exponent", _int),
        Column("is_crypto", _bool, False),
    ),
    ("ccy",),
)
TABLES = {t.name: t for t in (USERS, TRANSACTIONS, CURRENCY_DETAILS, FX_RATES)}

# Raw files: column name -> type. The first header cell of the rate sheet is empty.
RAW_COUNTRIES = T.StructType(
    [
        T.StructField("code", _text),
        T.StructField("code3", _text),
        T.StructField("numcode", _int),
    ]
)
RAW_FRAUDSTERS = T.StructType([T.StructField("user_id", _text)])
RAW_CURRENCIES = T.StructType(
    [
        T.StructField("currency", _text),
        T.StructField("iso_code", _int),
        T.StructField("exponent", _int),
        T.StructField("is_crypto", _bool),
    ]
)
RAW_USERS = T.StructType([f for f in USERS.struct if f.name != "is_fraudster"])
RAW_TRANSACTIONS = TRANSACTIONS.struct
