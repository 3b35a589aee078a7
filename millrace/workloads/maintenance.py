"""Queries over table maintenance and catalog scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import tables
from millrace.operators.tables import PartitionSpec
from millrace.session import Workspace
from millrace.sources import catalog
from millrace.workloads.data import load, query
from millrace.workloads.updates import partitioned_lineitem


@query("SELECT * FROM lineitem WHERE l_returnflag = 'A'")
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "partition_scan")
    table = partitioned_lineitem(spark, sf_dir, work)
    return catalog.read_partition(spark, table, "l_returnflag='A'")


@query("""
SELECT * FROM lineitem WHERE l_returnflag <> 'N'
UNION ALL
SELECT * REPLACE (0.0 AS l_tax) FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 10
""")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new rows come from the partition they replace."""
    work = Workspace(spark, "partition_overwrite")
    table = partitioned_lineitem(spark, sf_dir, work)
    rows = (
        spark.table(table)
        .where("l_returnflag = 'N' AND l_quantity > 10")
        .withColumn("l_tax", F.lit(0.0))
        .drop("l_returnflag")
    )
    tables.overwrite_partition(spark, table, rows, PartitionSpec("l_returnflag", "N"))
    return spark.table(table)


@query("""
SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN 'R_old' ELSE l_returnflag END
                  AS l_returnflag)
FROM lineitem
""")
def partition_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "partition_rename")
    table = partitioned_lineitem(spark, sf_dir, work)
    old, new = PartitionSpec("l_returnflag", "R"), PartitionSpec("l_returnflag", "R_old")
    tables.rename_partition(spark, table, old, new)
    return spark.table(table)


@query("SELECT * FROM lineitem WHERE l_returnflag <> 'A'")
def partition_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "partition_drop")
    table = partitioned_lineitem(spark, sf_dir, work)
    tables.drop_partition(spark, table, PartitionSpec("l_returnflag", "A"))
    return spark.table(table)


@query("""
SELECT 'current' AS held_in, * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
UNION ALL
SELECT 'previous', * FROM orders
""")
def stage_swap_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes; each reads both the table and its backup while replacing them."""
    work = Workspace(spark, "stage_swap")
    table = work.table("orders")
    load(spark, sf_dir, "orders").withColumn("o_totalprice", F.lit(0.0)).write.saveAsTable(table)
    tables.refresh_by_swap(spark, table, load(spark, sf_dir, "orders"))
    # The backup holds the zeroes now.
    backup = spark.table(table + "_temp").select("o_orderkey", F.col("o_totalprice").alias("zero"))
    rows = (
        spark.table(table)
        .join(backup, "o_orderkey")
        .withColumn("o_totalprice", F.col("o_totalprice") + F.col("zero") + 1)
        .drop("zero")
    )
    tables.refresh_by_swap(spark, table, rows)
    current = spark.table(table).withColumn("held_in", F.lit("current"))
    previous = spark.table(table + "_temp").withColumn("held_in", F.lit("previous"))
    return current.unionAll(previous)


@query("""
SELECT 'customer' AS found_in, * REPLACE (0.0 AS c_acctbal) FROM customer
UNION ALL
SELECT 'customer_temp', * FROM customer
""")
def table_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "table_swap")
    table = work.table("customer")
    rows = load(spark, sf_dir, "customer")
    rows.write.saveAsTable(table)
    rows.withColumn("c_acctbal", F.lit(0.0)).write.saveAsTable(table + "_temp")
    tables.swap_tables(spark, table)
    found = spark.table(table).withColumn("found_in", F.lit("customer"))
    other = spark.table(table + "_temp").withColumn("found_in", F.lit("customer_temp"))
    return found.unionAll(other)


@query("""
SELECT 'orders' AS found_in, * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
UNION ALL
SELECT 'orders_temp', * FROM orders
""")
def swap_after_lost_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A driver lost after the first of three renames has left no ``orders``; the next call has."""
    work = Workspace(spark, "lost_swap")
    table = work.table("orders")
    rows = load(spark, sf_dir, "orders")
    rows.write.saveAsTable(table)
    rows.withColumn("o_totalprice", F.col("o_totalprice") + 1).write.saveAsTable(table + "_temp")
    moves = {table: table + "_temp", table + "_temp": table}
    tables.mark_renames(spark, moves)
    tables.rename_table(spark, table, table + "_temp2")
    tables.swap_tables(spark, table)
    found = spark.table(table).withColumn("found_in", F.lit("orders"))
    other = spark.table(table + "_temp").withColumn("found_in", F.lit("orders_temp"))
    return found.unionAll(other)


@query("""
SELECT 'segments' AS name, c_mktsegment AS label, count(*) AS n FROM customer GROUP BY 2
UNION ALL
SELECT 'flags', l_returnflag, count(*) FROM lineitem GROUP BY 2
UNION ALL
SELECT 'priorities', o_orderpriority, count(*) FROM orders GROUP BY 2
""")
def sql_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three SQL texts, run as one batch and tagged with their names."""
    counts = "SELECT {column} AS label, count(*) AS n FROM parquet.`{path}` GROUP BY 1"
    texts = {
        name: counts.format(column=column, path=f"{sf_dir}/{table}.parquet")
        for name, table, column in [
            ("segments", "customer", "c_mktsegment"),
            ("flags", "lineitem", "l_returnflag"),
            ("priorities", "orders", "o_orderpriority"),
        ]
    }
    tagged = [
        frame.select(F.lit(name).alias("name"), "label", "n")
        for name, frame in catalog.named_frames_of(spark, texts).items()
    ]
    return tagged[0].unionAll(tagged[1]).unionAll(tagged[2])


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal < 0")
def table_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table emptied and filled again keeps its columns and none of its rows."""
    work = Workspace(spark, "table_truncate")
    table = work.table("supplier")
    rows = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    rows.write.saveAsTable(table)
    tables.truncate_table(spark, table)
    if spark.table(table).limit(1).count():
        raise RuntimeError(f"{table} is not empty")
    tables.append_by_position(rows.where("s_acctbal < 0"), table)
    return spark.table(table)
