"""Catalog scans and batches of SQL texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_partition(spark: SparkSession, table: str, predicate: str) -> DataFrame:
    """Rows under a partition predicate; only that partition's files are listed."""
    return spark.table(table).where(F.expr(predicate))


def frames_of(spark: SparkSession, texts: Sequence[str]) -> list[DataFrame]:
    """One lazy DataFrame per SQL text, in the given order."""
    return [spark.sql(text) for text in texts]


def named_frames_of(spark: SparkSession, texts: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.sql(text) for name, text in texts.items()}
