"""Ledger of finished update jobs, so that each fires once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import without_quotes
from millrace.operators.tables import append_by_position

DONE = "SUCCESS"


def create_ledger(spark: SparkSession, table: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (table_name string, batch_number bigint, "
        "partition_key string, status string, application_id string, recorded_at timestamp) "
        "USING parquet"
    )


def record_done(
    spark: SparkSession, ledger: str, table: str, batches: list[int], partition: str
) -> None:
    """Note batches of a partition as finished, all in one append."""
    each = F.explode(F.array(*[F.lit(batch).cast("bigint") for batch in batches]))
    done = spark.range(0, 1, 1, 1).select(each.alias("batch")).select(
        F.lit(table),
        "batch",
        without_quotes(F.lit(partition)),
        F.lit(DONE),
        F.lit(spark.sparkContext.applicationId),
        F.current_timestamp(),
    )
    append_by_position(done, ledger)


def pending(rules: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rules whose (table, batch, partition) has not been finished yet."""
    done = ledger.where(F.col("status") == DONE)
    return rules.alias("r").join(
        done.alias("d"),
        (F.col("r.table_name") == F.col("d.table_name"))
        & (F.col("r.batch_number") == F.col("d.batch_number"))
        & (without_quotes(F.col("r.partition_column")) == F.col("d.partition_key")),
        "left_anti",
    )


def finished(ledger: DataFrame, table: str, batch: int) -> set[str]:
    """Partitions, without quotes, in which a batch of a table has been finished."""
    done = ledger.where(
        (F.col("status") == DONE) & (F.col("table_name") == table) & (F.col("batch_number") == batch)
    )
    return {row.partition_key for row in done.select("partition_key").distinct().collect()}
