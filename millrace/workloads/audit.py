"""Queries over the audit trail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import digits_grouped
from millrace.functions.times import audit_time, whole_seconds
from millrace.plans import audit
from millrace.session import Workspace
from millrace.workloads.data import load, query


@query("""
SELECT CAST(event_id AS VARCHAR) AS batch_number, event_type AS source_tbl_name,
       event_type AS des_tbl_name, 'NA' AS refresh_mode, CAST(0 AS BIGINT) AS refresh_rec_count,
       strftime(date_trunc('day', ts), '%Y-%m-%d %I:%M:%S') AS refresh_start_time,
       strftime(ts, '%Y-%m-%d %I:%M:%S') AS refresh_end_time,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS refresh_status,
       (epoch_us(ts) // 1000 - epoch_us(CAST(date_trunc('day', ts) AS TIMESTAMP)) // 1000) // 1000
         AS refresh_runtime,
       props AS message
FROM events
""")
def audit_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event audited as a run that began at midnight and ended at its time."""
    work = Workspace(spark, "audit_record")
    table = work.table("spark_ingestion_audit")
    audit.create_audit_table(spark, table)
    runs = load(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) as batch_number",
        "event_type as app_identifier",
        "unix_millis(cast(date_trunc('day', ts) as timestamp)) as start_ms",
        "unix_millis(cast(ts as timestamp)) as end_ms",
        "if(event_type = 'error', 'FAILED', 'SUCCESS') as status",
        "props as message",
    )
    audit.record_runs(runs, table)
    return spark.table(table)


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %I:%M:%S') AS audit_time FROM events")
def audit_time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return events.select("event_id", audit_time(F.col("ts")).alias("audit_time"))


@query("""
SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) // 1000 AS runtime,
       format('{:,}', CAST(round(o_totalprice * 100) AS BIGINT) // 1000) AS runtime_text
FROM orders
""")
def audit_runtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole seconds of runs whose length in milliseconds is the order's price in cents."""
    runs = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "unix_millis(cast(o_orderdate as timestamp)) as end_ms",
        "unix_millis(cast(o_orderdate as timestamp)) - cast(round(o_totalprice * 100) as bigint)"
        " as start_ms",
    )
    runtime = whole_seconds(F.col("start_ms"), F.col("end_ms"))
    return runs.select(
        "o_orderkey",
        runtime.alias("runtime"),
        digits_grouped(runtime).alias("runtime_text"),
    )
