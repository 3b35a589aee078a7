"""Rule tables: one row per updated column, turned into ordered update jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the rule table, by name.
RULE_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("batch_number", T.LongType()),
        T.StructField("partition_column", T.StringType()),
        T.StructField("temporary_partition", T.StringType()),
        T.StructField("from_clause", T.StringType()),
        T.StructField("update_column", T.StringType()),
        T.StructField("case_when", T.StringType()),
        T.StructField("enabled_flag", T.StringType()),
    ]
)
JOB_KEY = ["table_name", "batch_number", "partition_column"]
ENABLED = "Y"


def enabled_rules(rules: DataFrame, only: Column | None = None) -> DataFrame:
    enabled = rules.where(F.col("enabled_flag") == ENABLED)
    return enabled if only is None else enabled.where(only)


def update_worklist(rules: DataFrame, only: Column | None = None) -> DataFrame:
    """Distinct update jobs in the order they apply.

    Without a from-clause the job reads its own table. Batches sort as numbers,
    since later batches see the results of earlier ones.
    """
    return _with_source(enabled_rules(rules, only), []).distinct().orderBy(*JOB_KEY)


def job_rules(rules: DataFrame, only: Column | None = None) -> DataFrame:
    """The rules behind the work list, one row per updated column."""
    columns = [F.lower("update_column").alias("update_column"), F.col("case_when")]
    return _with_source(enabled_rules(rules, only), columns)


def _with_source(rules: DataFrame, more: list[Column]) -> DataFrame:
    source = F.coalesce(F.nullif(F.col("from_clause"), F.lit("")), F.col("table_name"))
    return rules.select(
        "table_name",
        F.col("batch_number").cast("bigint").alias("batch_number"),
        "partition_column",
        "temporary_partition",
        source.alias("from_clause"),
        *more,
    )

