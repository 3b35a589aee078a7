"""Audit rows of a stream's batches: rows read, decoded and set apart."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.plans import audit

# How long to wait for the reports of a query that has ended; what is missing is settled.
REPORT_SECONDS = 60


def counts() -> list[Column]:
    """What is counted of decoded messages while they are written."""
    return [
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("quarantined").isNull()).alias("decoded"),
        F.count("quarantined").alias("quarantined"),
    ]


def metric_name(table: str) -> str:
    return f"decoded into {table}"


def settle(spark: SparkSession, table: str, audit_table: str, job: str) -> None:
    """Record what is in the table and in no audit row, as one row without a batch.

    It reads one column of the table.
    """
    start_ms = time.time_ns() // 1_000_000
    held = dict.fromkeys(audit.COUNTS, 0)
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
        held = spark.table(table).agg(*counts()).first().asDict()
    known = audit.recorded_counts(spark, audit_table, job, table)
    left = {name: held[name] - known[name] for name in audit.COUNTS}
    audit.record_batch(spark, audit_table, job, table, audit.SETTLED, left, start_ms)


class _Reports(StreamingQueryListener):
    """Writes an audit row for every batch that a query reports."""

    def __init__(self, spark: SparkSession, table: str, audit_table: str, job: str):
        self.spark, self.table, self.audit_table, self.job = spark, table, audit_table, job
        self.lock, self.open = threading.Lock(), True
        self.changed, self.ended = threading.Condition(), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = (progress.observedMetrics or {}).get(metric_name(self.table))
        if seen is None:
            return
        found = {name: seen[name] or 0 for name in audit.COUNTS}
        took = (progress.durationMs or {}).get("triggerExecution", 0)
        with self.lock:
            if self.open:
                audit.record_batch(
                    self.spark, self.audit_table, self.job, self.table,
                    str(progress.batchId), found, time.time_ns() // 1_000_000 - took,
                )

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def close(self, run: str | None) -> None:
        if run is not None:
            with self.changed:
                self.changed.wait_for(lambda: run in self.ended, REPORT_SECONDS)
        with self.lock:
            self.open = False


def run_audited(
    spark: SparkSession,
    start: Callable[[], StreamingQuery],
    table: str,
    audit_table: str,
    job: str,
) -> None:
    """Run a query of ``decode_to_table`` to its end, with an audit row for every batch.

    Reports come after a batch is done, so a lost driver may leave one unrecorded.
    What is missing is settled before the query starts and after it has ended:
    then the rows of the audit add up to those of the table.
    """
    settle(spark, table, audit_table, job)
    reports = _Reports(spark, table, audit_table, job)
    spark.streams.addListener(reports)
    run = None
    try:
        query = start()
        run = str(query.runId)
        query.awaitTermination()
    finally:
        reports.close(run)
        spark.streams.removeListener(reports)
        settle(spark, table, audit_table, job)
