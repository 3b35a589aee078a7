"""Helpers the operators share: tables in the shared folder and positions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import Workspace

# Fixed value: words as the contracts define them, runs of other than ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks it ran, never the whole
    plan, and later steps do not compute the rows again.
    """
    path = work.path(name)
    df.write.option("compression", "zstd").parquet(path)
    return work.spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows a few at a time: what a task makes of a batch is often far larger."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def hash63(*columns: Column) -> Column:
    """Non-negative 63-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def with_position(df: DataFrame, order: Column, work: Workspace, name: str) -> DataFrame:
    """Adds ``position``, the 0-based rank by ``order``.

    The rows are dealt out by range and numbered inside each range; only one
    row for each range, not the rows themselves, meets in a single task.
    """
    dealt = keep(
        df.repartitionByRange(order).withColumn("range_no", F.spark_partition_id()),
        work,
        name,
    )
    counts = dealt.groupBy("range_no").agg(F.count("*").alias("n"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("range_no").orderBy(order)) - 1
    return (
        dealt.withColumn("inside", inside)
        .join(starts, "range_no")
        .withColumn("position", F.col("start") + F.col("inside"))
        .drop("range_no", "start", "inside")
    )


def hashed_sample(rows: DataFrame, group: str, counts: dict, n: int, doc_id: str = "doc_id") -> DataFrame:
    """The ``n`` rows of each group in ``counts`` with the smallest hashes of their ids.

    ``counts`` tells the rows of each group. Hashes beyond what twice as many
    rows need are left out where the rows lie, so what meets in a task does not
    grow with the group.
    """
    known = {value: size for value, size in counts.items() if size}
    if not known:
        return rows.limit(0)
    pairs = [F.lit(x) for value, size in known.items() for x in (value, min(1.0, 2.0 * n / size + 100 / size))]
    share = F.element_at(F.create_map(*pairs), F.col(group))
    place = hash63(F.col(doc_id))
    order = Window.partitionBy(group).orderBy(place, doc_id)
    near = rows.where(F.col(group).isin(list(known)) & (place / F.lit(2.0**63) <= share))
    return near.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= n).drop("turn")
