"""Queries over CSV scans and the indirect load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.codec import base64_token
from millrace.plans.load import create_rejects_table, load_listed_files
from millrace.session import Workspace
from millrace.sources import csv, infer
from millrace.sources.schema import schema_of
from millrace.workloads.data import load, query


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("timestampNTZFormat", csv.TIMESTAMP_PATTERN).csv(path, header=True)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, to_base64(encode(c_name)) AS name_token,
       to_base64(encode(c_mktsegment)) AS segment_token
FROM customer
""")
def csv_bulk_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded fields read back as text, none mistaken for a number."""
    work = Workspace(spark, "csv_bulk")
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey",
        base64_token(F.col("c_name")).alias("name_token"),
        base64_token(F.col("c_mktsegment")).alias("segment_token"),
    )
    write_csv(rows, work.path("customer"))
    return csv.read_bulk_csv(spark, work.path("customer"))


@query("SELECT * REPLACE (CAST(p_partkey AS INTEGER) AS p_partkey) FROM part")
def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "csv_inferred")
    write_csv(load(spark, sf_dir, "part"), work.path("part"))
    found = csv.read_bulk_csv(spark, work.path("part"), infer=True)
    return found.withColumn("p_partkey", F.col("p_partkey").cast("int"))


@query("SELECT * FROM orders")
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "csv_typed")
    orders = load(spark, sf_dir, "orders")
    write_csv(orders, work.path("orders"))
    return csv.read_typed_csv(spark, work.path("orders"), orders.schema)


@query("""
SELECT c_custkey, c_name, CAST(c_nationkey AS SMALLINT) AS c_nationkey,
       CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer
""")
def schema_from_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types in mixed case; ``varchar`` is unknown and falls back to string."""
    work = Workspace(spark, "schema_spec")
    write_csv(load(spark, sf_dir, "customer"), work.path("customer"))
    spec = [
        ("c_custkey", "Long"),
        ("c_name", "String"),
        ("c_nationkey", "SHORT"),
        ("c_acctbal", "float"),
        ("c_mktsegment", "varchar"),
    ]
    rows = csv.read_typed_csv(spark, work.path("customer"), schema_of(spec))
    return rows.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS code,
       CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS price, o_orderdate::DATE AS day,
       o_orderkey % 10 || 'e' || o_custkey % 7 AS lookalike, o_orderkey % 2 = 0 AS even,
       'int,string,decimal,date,string,boolean' AS kinds
FROM orders
""")
def csv_lossless_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types are found, but codes with leading zeros and tokens like ``1e5`` stay as they are."""
    work = Workspace(spark, "csv_lossless")
    rows = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "lpad(cast(o_orderkey as string), 12, '0') as code",
        "cast(o_totalprice as decimal(15, 2)) as price",
        "cast(o_orderdate as date) as day",
        "concat(o_orderkey % 10, 'e', o_custkey % 7) as lookalike",
        "o_orderkey % 2 = 0 as even",
    )
    write_csv(rows, work.path("orders"))
    found = infer.read_lossless(spark, work.path("orders"))
    kinds = ",".join(kind.partition("(")[0] for _, kind in found.dtypes)
    return found.withColumn("price", F.col("price").cast("string")).withColumn("kinds", F.lit(kinds))


@query("""
WITH rows AS (
  SELECT c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS c_custkey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN '0' ELSE '' END || c_custkey AS code,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey % 2 = 0 END AS even
  FROM customer)
SELECT segment, 'c_custkey' AS "column", count(*) AS filled, 'int' AS type FROM rows GROUP BY segment
UNION ALL SELECT segment, 'code', count(*), CASE WHEN segment = 'MACHINERY' THEN 'string' ELSE 'int' END
FROM rows GROUP BY segment
UNION ALL SELECT segment, 'even', count(even), CASE WHEN segment = 'BUILDING' THEN 'string' ELSE 'boolean' END
FROM rows GROUP BY segment
""")
def csv_types_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each file says of its columns: one has padded codes, one an empty column."""
    work = Workspace(spark, "csv_types")
    rows = load(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment",
        "c_custkey",
        "concat(if(c_mktsegment = 'MACHINERY', '0', ''), c_custkey) as code",
        "if(c_mktsegment = 'BUILDING', null, c_nationkey % 2 = 0) as even",
    )
    base = work.path("csv")
    rows.repartition("c_mktsegment").write.partitionBy("c_mktsegment").csv(base, header=True)
    found = infer.types_by_file(spark, [f"{base}/*"])
    segment = F.url_decode(F.regexp_extract("file_path", "c_mktsegment=([^/]*)/", 1))
    return found.select(segment.alias("segment"), "column", "filled", "type")


NAMES_FROM_PAGES = """
  'page_' || page_id || CASE WHEN url LIKE '%.html' THEN '.xml' WHEN url LIKE '%#top' THEN '_xls'
                             WHEN url LIKE '%ref=x' THEN '.XLS' ELSE '.csv' END"""


@query(f"""
SELECT filename FROM (SELECT {NAMES_FROM_PAGES} AS filename FROM pages)
WHERE filename LIKE '%xls' OR filename LIKE '%xml'
""")
def file_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "file_list")
    names = load(spark, sf_dir, "pages").select(F.expr(NAMES_FROM_PAGES).alias("filename"))
    names.write.text(work.path("filelist"))
    return csv.with_suffixes(csv.read_file_list(spark, work.path("filelist")))


@query("""
WITH listed AS (
  SELECT *, 'c_mktsegment=' || c_mktsegment || '/customers[1] {a}*.csv' AS file_name FROM customer)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, file_name FROM listed
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, file_name FROM listed
WHERE c_mktsegment = 'MACHINERY'
""")
def indirect_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customer files are listed, those of one segment twice; others are not.

    The names hold signs that mean something else in a pattern, files that such
    a pattern would match lie beside them, and the base is spelled with a
    doubled slash.
    """
    work = Workspace(spark, "indirect_load")
    base = work.path("csv")
    customer = load(spark, sf_dir, "customer")
    customer.repartition("c_mktsegment").write.partitionBy("c_mktsegment").csv(base, header=True)
    names = _rename_parts(spark, base, "customers[1] {a}*.csv")
    load(spark, sf_dir, "supplier").coalesce(1).write.csv(f"{base}/beside", header=True)
    _rename_parts(spark, base, "customers1 aX.csv", folders="beside")

    twice = [name for name in names if name.startswith("c_mktsegment=MACHINERY/")]
    lines = spark.createDataFrame([(name,) for name in names + twice], "filename string")
    lines.write.text(work.path("indirect"))

    target = work.table("flat_file")
    spark.sql(
        f"CREATE TABLE {target} (c_custkey bigint, c_name string, c_nationkey int, "
        "c_acctbal string, file_name string) USING parquet"
    )
    spec = [
        ("c_custkey", "long"),
        ("c_name", "String"),
        ("c_nationkey", "Integer"),
        ("c_acctbal", "double"),
    ]
    folder, _, last = base.rpartition("/")
    load_listed_files(spark, work.path("indirect"), f"{folder}//{last}", target, spec=spec)
    return spark.table(target).select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "file_name",
    )


@query("""
WITH lines AS (
  SELECT *, CASE WHEN c_custkey % 7 = 3 THEN 'n/a' WHEN c_custkey % 11 = 5 THEN ''
                 ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
         c_custkey % 13 = 1 AS longer, c_custkey % 17 = 2 AS shorter,
         CASE WHEN c_custkey % 7 = 3 THEN 'c_nationkey is not of type int' END AS bad
  FROM customer)
SELECT 'c_mktsegment=' || c_mktsegment || '/customers.csv' AS file_name, c_custkey,
       CASE WHEN bad IS NULL AND NOT longer THEN CAST(nullif(nation, '') AS INTEGER) END AS c_nationkey,
       CASE WHEN bad IS NULL AND NOT longer AND NOT shorter THEN c_name END AS c_name,
       nullif(concat_ws('; ', bad, CASE WHEN longer THEN 'more than 3 fields' END), '') AS cause
FROM lines
""")
def indirect_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a bad number or a surplus field are set apart; short ones are padded."""
    work = Workspace(spark, "load_rejects")
    base = work.path("csv")
    nation = (
        "if(c_custkey % 7 = 3, 'n/a', if(c_custkey % 11 = 5, '', cast(c_nationkey as string)))"
    )
    line = (
        f"concat(c_custkey, ',', {nation}, "
        "if(c_custkey % 17 = 2 and c_custkey % 13 <> 1, '', concat(',', c_name)), "
        "if(c_custkey % 13 = 1, ',more', ''))"
    )
    customer = load(spark, sf_dir, "customer").selectExpr(f"{line} as value", "c_mktsegment")
    customer.repartition("c_mktsegment").write.partitionBy("c_mktsegment").text(base)
    names = _rename_parts(spark, base, "customers.csv")
    spark.createDataFrame([(n,) for n in names], "filename string").write.text(work.path("list"))
    target, rejects = work.table("flat_file"), work.table("rejects")
    spark.sql(
        f"CREATE TABLE {target} (c_custkey bigint, c_nationkey int, c_name string, "
        "file_name string) USING parquet"
    )
    create_rejects_table(spark, rejects)
    spec = [("c_custkey", "long"), ("c_nationkey", "integer"), ("c_name", "string")]
    load_listed_files(
        spark, work.path("list"), base, target, spec=spec, rejects=rejects, header=False
    )
    good = spark.table(target).withColumn("cause", F.lit(None).cast("string"))
    bad = spark.table(rejects).select(
        F.split("line", ",")[0].cast("long").alias("c_custkey"),
        F.lit(None).cast("int").alias("c_nationkey"),
        F.lit(None).cast("string").alias("c_name"),
        "file_name",
        "cause",
    )
    return good.unionByName(bad)


def _rename_parts(spark: SparkSession, base: str, name: str, folders: str = "c_mktsegment=") -> list[str]:
    """Give the one file in each folder below ``base`` a name; tells the names from ``base``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for folder in system.listStatus(path(base)):
        if folder.getPath().getName().startswith(folders):
            for file in system.listStatus(folder.getPath()):
                if file.getPath().getName().startswith("part-"):
                    system.rename(file.getPath(), path(folder.getPath(), name))
                    found.append(f"{folder.getPath().getName()}/{name}")
    return found
