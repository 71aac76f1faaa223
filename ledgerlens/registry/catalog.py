"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.registry.data import Data
from ledgerlens.registry.oracles_learning import ORACLES as LEARNING_ORACLES
from ledgerlens.registry.oracles_tables import ORACLES as TABLE_ORACLES
from ledgerlens.registry.queries_learning import QUERIES as LEARNING_QUERIES
from ledgerlens.registry.queries_tables import QUERIES as TABLE_QUERIES


def _bind(query: Callable[[Data], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Data(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(query) for name, query in {**TABLE_QUERIES, **LEARNING_QUERIES}.items()}


def oracles() -> dict[str, str]:
    return {**TABLE_ORACLES, **LEARNING_ORACLES}
