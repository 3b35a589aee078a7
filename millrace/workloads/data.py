"""Test tables, and the registry of queries run on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str) -> Callable[[Query], Query]:
    """Register a query under its function name with the SQL that checks it."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = oracle
        return function

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
