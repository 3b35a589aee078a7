"""Merging the small files of partitions, beside writers and readers of the table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.errors import ConcurrentChangeError
from millrace.operators import manifest
from millrace.operators.guards import require_same_rows
from millrace.operators.tables import (
    PartitionSpec,
    drop_table,
    new_folder,
    partition_location,
    partitions_below,
    purge_location,
    require_partition,
    require_partition_column,
    session_setting,
)
from millrace.sources.catalog import read_partition

TARGET_BYTES = 128 * 1024 * 1024
# A partition is left alone unless merging makes at most this share of its files.
WORTH_SHARE = 0.5


@dataclass(frozen=True)
class Merged:
    """What became of a partition: its files before and after, or why it was left alone."""

    partition: str
    files_before: int
    files_after: int
    left_because: str | None = None


def merge_files(
    spark: SparkSession, table: str, spec: PartitionSpec, target_bytes: int = TARGET_BYTES
) -> Merged:
    """Rewrite a partition of many small files as few of about the target size.

    Spark's own packing of files by size into read tasks makes the bins, so
    nothing is shuffled and a task writes one file. The new files are compared
    with the old rows, then one change of location switches readers over. If
    another writer has changed the partition meanwhile it is left as it is;
    files that come between the last look and the switch bring the old files
    back. So no row is lost or doubled, and a later call tries again.
    """
    require_partition_column(spark, table, spec)
    require_partition(spark, table, spec)
    old = partition_location(spark, table, spec)
    sizes = manifest.list_files(spark, old).agg(
        F.count("name").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")
    )
    files, size = sizes.first()
    wanted = max(1, -(-size // target_bytes))
    if wanted > files * WORTH_SHARE:
        return Merged(spec.predicate, files, files, "few files")
    folder = new_folder(spark, table, "merge")
    noted, shadow = folder + "-files", f"{table}_merge_{uuid.uuid4().hex[:8]}"
    try:
        spark.catalog.refreshTable(table)
        manifest.note_files(spark, old, noted)
        spark.sql(f"CREATE TABLE {shadow} LIKE {table} LOCATION '{noted}'")
        spark.sql(f"ALTER TABLE {shadow} ADD PARTITION ({spec.sql}) LOCATION '{folder}'")
        kept = [f.name for f in spark.table(table).schema.fields if f.name.lower() not in spec.columns]
        columns = ", ".join(f"`{c}`" for c in kept)
        with (
            session_setting(spark, "spark.sql.files.maxPartitionBytes", str(target_bytes)),
            session_setting(spark, "spark.sql.files.openCostInBytes", "0"),
            session_setting(spark, "spark.sql.files.minPartitionNum", "1"),
        ):
            spark.sql(
                f"INSERT OVERWRITE TABLE {shadow} PARTITION ({spec.sql}) "
                f"SELECT {columns} FROM {table} WHERE {spec.predicate}"
            )
        before = read_partition(spark, table, spec.predicate)
        require_same_rows(before, spark.table(shadow), kept, f"{table} {spec.predicate}")
        changed = bool(manifest.changes(spark, old, noted))
    except Exception:
        _give_up(spark, shadow, folder, noted)
        raise
    if changed:
        _give_up(spark, shadow, folder, noted)
        return Merged(spec.predicate, files, files, "changed meanwhile")
    made = folder + "-made"
    manifest.note_files(spark, folder, made)
    target = f"ALTER TABLE {table} PARTITION ({spec.sql}) SET LOCATION "
    spark.sql(f"{target}'{folder}'")
    if manifest.changes(spark, old, noted):
        spark.sql(f"{target}'{old}'")
        if manifest.changes(spark, folder, made):
            raise ConcurrentChangeError(
                f"{table} {spec.predicate} is at {old} again; rows that came meanwhile are also "
                f"in files of {folder} that {made} does not name"
            )
        purge_location(spark, shadow, made)
        _give_up(spark, shadow, folder, noted)
        return Merged(spec.predicate, files, files, "changed meanwhile")
    drop_table(spark, shadow)
    now = manifest.list_files(spark, folder).count()
    for done in (old, noted, made):
        purge_location(spark, shadow, done)
    return Merged(spec.predicate, files, now)


def _give_up(spark: SparkSession, shadow: str, folder: str, noted: str) -> None:
    drop_table(spark, shadow)
    for each in (folder, noted):
        purge_location(spark, shadow, each)


def merge_finished(
    spark: SparkSession,
    table: str,
    order_column: str,
    target_bytes: int = TARGET_BYTES,
) -> list[Merged]:
    """Merge the partitions that a stream has done with: all but the last by ``order_column``.

    The stream appends to the last one only, so it is left to a later call. The
    column holds whole numbers, as ``batch_range`` does.
    """
    shown = spark.sql(f"SHOW PARTITIONS {table}").collect()
    numbers = sorted({int(_value(row.partition, order_column)) for row in shown})
    found = []
    for number in numbers[:-1]:
        for below in partitions_below(spark, table, PartitionSpec(order_column, str(number))):
            found.append(merge_files(spark, table, below, target_bytes))
    return found


def _value(name: str, column: str) -> str:
    levels = dict(part.partition("=")[::2] for part in name.split("/"))
    return levels[column]
