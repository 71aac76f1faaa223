"""Constraint checks: what a database would refuse, counted in one pass per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.schemas import Table


def column_rules(table: Table) -> list[tuple[str, str, Column]]:
    """``(column, rule, count of violations)`` of the NOT NULL and length rules."""
    rules = []
    for c in table.columns:
        if not c.nullable:
            rules.append((c.name, "not_null", F.count_if(F.col(c.name).isNull())))
        if c.max_length is not None:
            too_long = F.length(F.col(c.name).cast("string")) > c.max_length
            rules.append((c.name, "max_length", F.count_if(too_long)))
    return rules


def _column_violations(df: DataFrame, table: Table) -> DataFrame:
    counted = df.agg(*[m.alias(f"{name}|{rule}") for name, rule, m in column_rules(table)])
    return (
        counted.unpivot([], counted.columns, "measure", "violations")
        .select(
            F.lit(table.name).alias("table_name"),
            F.split_part("measure", F.lit("|"), F.lit(1)).alias("column_name"),
            F.split_part("measure", F.lit("|"), F.lit(2)).alias("rule"),
            "violations",
        )
    )


def key_violations(df: DataFrame, table: Table) -> DataFrame:
    key = list(table.primary_key)
    repeated = df.groupBy(*key).count().where("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table.name).alias("table_name"),
        F.lit("+".join(key)).alias("column_name"),
        F.lit("primary_key").alias("rule"),
        "violations",
    )


def validate_constraints(tables: list[tuple[DataFrame, Table]]) -> DataFrame:
    """``(table_name, column_name, rule, violations)`` for NOT NULL, length and key rules."""
    parts = []
    for df, table in tables:
        parts += [_column_violations(df, table), key_violations(df, table)]
    return reduce(DataFrame.unionByName, parts)
