"""Audit trail: one row per job run."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import audit_time, whole_seconds
from millrace.operators.tables import append_by_position

# The audit table's columns, by name and order.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("batch_number", T.StringType()),
        T.StructField("source_tbl_name", T.StringType()),
        T.StructField("des_tbl_name", T.StringType()),
        T.StructField("refresh_mode", T.StringType()),
        T.StructField("refresh_rec_count", T.LongType()),
        T.StructField("refresh_start_time", T.StringType()),
        T.StructField("refresh_end_time", T.StringType()),
        T.StructField("refresh_status", T.StringType()),
        T.StructField("refresh_runtime", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)
# Fixed values.
SUCCESS = "SUCCESS"
FAILED = "FAILED"
NO_MODE = "NA"

# Audit rows of a stream's batches: their mode, what they count, and the number of
# a row for what no batch has reported.
STREAM_MODE = "STREAM"
COUNTS = ["read", "decoded", "quarantined"]
SETTLED = "settled"
BATCH_SCHEMA = (
    "batch_number string, job string, target string, read bigint, decoded bigint, "
    "quarantined bigint, start_ms bigint, end_ms bigint"
)

RUN_SCHEMA = (
    "batch_number string, app_identifier string, start_ms bigint, end_ms bigint, "
    "status string, message string"
)


def audit_rows(runs: DataFrame, values: dict[str, Column] | None = None) -> DataFrame:
    """Audit records of finished runs given as :data:`RUN_SCHEMA`.

    The job's name stands for both its source and its target, unless ``values``
    has something else for a column.
    """
    columns = [
        F.col("batch_number").cast("string").alias("batch_number"),
        F.col("app_identifier").alias("source_tbl_name"),
        F.col("app_identifier").alias("des_tbl_name"),
        F.lit(NO_MODE).alias("refresh_mode"),
        F.lit(0).cast("bigint").alias("refresh_rec_count"),
        audit_time(F.timestamp_millis("start_ms")).alias("refresh_start_time"),
        audit_time(F.timestamp_millis("end_ms")).alias("refresh_end_time"),
        F.col("status").alias("refresh_status"),
        whole_seconds(F.col("start_ms"), F.col("end_ms")).alias("refresh_runtime"),
        F.col("message").alias("message"),
    ]
    other = values or {}
    names = AUDIT_SCHEMA.names
    return runs.select(
        *[other.get(name, column).alias(name) for name, column in zip(names, columns, strict=True)]
    )


def batch_rows(batches: DataFrame) -> DataFrame:
    """Audit records of a stream's batches given as :data:`BATCH_SCHEMA`.

    The record count is that of the rows read; the message has all three counts.
    """
    counts = [F.concat(F.lit(f"{name}="), F.col(name)) for name in COUNTS]
    runs = batches.select(
        "batch_number",
        F.col("job").alias("app_identifier"),
        "start_ms",
        "end_ms",
        F.lit(SUCCESS).alias("status"),
        F.concat_ws(" ", *counts).alias("message"),
        "target",
        "read",
    )
    values = {
        "des_tbl_name": F.col("target"),
        "refresh_mode": F.lit(STREAM_MODE),
        "refresh_rec_count": F.col("read"),
    }
    return audit_rows(runs, values)


def record_batch(
    spark: SparkSession,
    table: str,
    job: str,
    target: str,
    number: str,
    counts: dict[str, int],
    start_ms: int,
) -> None:
    """One audit row for a batch; none for a batch without rows."""
    if not any(counts.values()):
        return
    end_ms = time.time_ns() // 1_000_000
    row = (number, job, target, *[counts[name] for name in COUNTS], start_ms, end_ms)
    append_by_position(batch_rows(spark.createDataFrame([row], BATCH_SCHEMA)), table)


def batch_counts(spark: SparkSession, table: str, job: str, target: str) -> DataFrame:
    """``batch_number`` and the counts of every audit row of a stream into ``target``."""
    spark.catalog.refreshTable(table)
    rows = spark.table(table).where(
        (F.col("refresh_mode") == STREAM_MODE)
        & (F.col("source_tbl_name") == job)
        & (F.col("des_tbl_name") == target)
    )
    counts = [
        F.regexp_extract("message", f"{name}=(-?[0-9]+)", 1).cast("bigint").alias(name)
        for name in COUNTS
    ]
    return rows.select("batch_number", *counts)


def recorded_counts(
    spark: SparkSession, table: str, job: str, target: str, number: str | None = None
) -> dict[str, int]:
    """Sums of what is recorded of a stream, or of one of its batches."""
    rows = batch_counts(spark, table, job, target)
    if number is not None:
        rows = rows.where(F.col("batch_number") == number)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]).first().asDict()


def create_audit_table(spark: SparkSession, table: str) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in AUDIT_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def record_runs(runs: DataFrame, table: str) -> None:
    append_by_position(audit_rows(runs), table)


@dataclass
class Run:
    """A job run in progress; the last ``message`` goes to the audit row."""

    batch_number: str
    job: str
    start_ms: int = field(default_factory=lambda: time.time_ns() // 1_000_000)
    message: str = ""


@contextmanager
def audited(spark: SparkSession, job: str, table: str | None) -> Iterator[Run]:
    """Write one audit row when the block ends, also when it fails."""
    run = Run(spark.sparkContext.applicationId, job)
    status = FAILED
    try:
        yield run
        status = SUCCESS
    except Exception as error:
        run.message = f"{run.message}: {error}" if run.message else str(error)
        raise
    finally:
        if table is not None:
            end_ms = time.time_ns() // 1_000_000
            row = (run.batch_number, run.job, run.start_ms, end_ms, status, run.message)
            record_runs(spark.createDataFrame([row], RUN_SCHEMA), table)
