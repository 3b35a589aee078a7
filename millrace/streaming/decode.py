"""Continuous decoding of Base64 messages into a table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.codec import decode_records
from millrace.operators.tables import PartitionSpec, overwrite_partition
from millrace.plans import audit
from millrace.streaming.audit import counts, metric_name

# Fixed value: how often the topic is polled.
POLL_INTERVAL = "2 seconds"
AVAILABLE = "available"
CONSUME_JOB = "message_consume"
BATCH_COLUMN = "batch_id"
RANGE_COLUMN = "batch_range"
# Batches that share a partition: at the poll interval some 43 partitions a day.
BATCHES_PER_PARTITION = 1000


def _trigger(trigger: str) -> dict:
    """``available`` works the backlog off and ends; else an interval."""
    return {"availableNow": True} if trigger == AVAILABLE else {"processingTime": trigger}


def decode_to_table(
    messages: DataFrame,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    *,
    trigger: str = POLL_INTERVAL,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append decoded messages to a table, each exactly once.

    The work is stateless and per record, so every source partition is a task
    and nothing is shuffled. The file sink logs finished batches; a restart on
    the same checkpoint neither loses nor repeats any. Batches are counted as they
    are written; ``streaming.audit.run_audited`` records that.
    """
    return (
        decode_records(messages, schema)
        .observe(metric_name(table), *counts())
        .writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(trigger))
        .toTable(table)
    )


def decode_to_batches(
    messages: DataFrame,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    *,
    trigger: str = POLL_INTERVAL,
    batches_per_partition: int = BATCHES_PER_PARTITION,
    audit_table: str | None = None,
    job: str = CONSUME_JOB,
) -> StreamingQuery:
    """Same into an existing table with the columns ``quarantined, batch_id, batch_range``.

    The table is partitioned by ``batch_range``, which so many successive
    batches share. Any engine can read it without the file sink's log. A batch
    is appended. Only the first batch of a query can be one that an earlier
    query has begun to write: what there is of it is taken out of its partition
    first, by a switch to files without it, so repeating it changes nothing.

    With ``audit_table`` every batch has an audit row, written after its rows and
    before the batch is done. A first batch that an earlier query has recorded is
    recorded again only by what differs, so the audit adds up to the table.
    """
    begun: list[int] = []
    reader = messages.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, part = batch.sparkSession, batch_id // batches_per_partition
        start_ms, first, seen = time.time_ns() // 1_000_000, not begun, Observation()
        if first:
            _take_out(spark.table(table), table, batch_id, part)
            begun.append(batch_id)
        counted = batch.observe(seen, *counts())
        counted.select(
            *batch.columns,
            F.lit(batch_id).cast("bigint").alias(BATCH_COLUMN),
            F.lit(part).cast("bigint").alias(RANGE_COLUMN),
        ).write.mode("append").insertInto(table)
        # Batches have a session of their own; the caller's shall see the files.
        reader.catalog.refreshTable(table)
        if audit_table is None:
            return
        found, number = seen.get, str(batch_id)
        if first:
            known = audit.recorded_counts(spark, audit_table, job, table, number)
            found = {name: found[name] - known[name] for name in known}
        audit.record_batch(spark, audit_table, job, table, number, found, start_ms)
        reader.catalog.refreshTable(audit_table)

    return (
        decode_records(messages, schema)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(trigger))
        .start()
    )


def _take_out(rows: DataFrame, table: str, batch_id: int, part: int) -> None:
    """Remove the rows of one batch from its partition, if there are any."""
    spark = rows.sparkSession
    spark.catalog.refreshTable(table)
    held = spark.table(table).where(F.col(RANGE_COLUMN) == part)
    if held.where(F.col(BATCH_COLUMN) == batch_id).isEmpty():
        return
    others = held.where(F.col(BATCH_COLUMN) != batch_id).drop(RANGE_COLUMN)
    overwrite_partition(spark, table, others, PartitionSpec(RANGE_COLUMN, str(part)))
