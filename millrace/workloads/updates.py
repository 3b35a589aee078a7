"""Queries over the update framework."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import equals_ignoring_quotes
from millrace.operators import guards, rewrite, tables, worklist
from millrace.operators.rewrite import Rule
from millrace.operators.tables import PartitionSpec
from millrace.plans import update
from millrace.session import Workspace
from millrace.workloads.data import load, query

DISCOUNT_RULE = "when l_tax > 0.05 then l_discount / 2 when l_quantity >= 40 then 0.0"
TAX_RULE = "when l_discount > 0.05 then l_tax + l_discount"


@query(f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       CASE {DISCOUNT_RULE} ELSE l_discount END AS l_discount,
       CASE {TAX_RULE} ELSE l_tax END AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem
""")
def conditional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rules that read each other's old values; one rule has two branches."""
    rules = [Rule("L_DISCOUNT", DISCOUNT_RULE), Rule("l_tax", TAX_RULE)]
    return rewrite.conditional_update(load(spark, sf_dir, "lineitem"), rules)


JOIN_RULE = "when p_size > 25 then l_discount + 0.01 when p_size is null then 0.0"


@query(f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       CASE {JOIN_RULE} ELSE l_discount END AS l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def update_from_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").select("p_partkey", "p_size")
    return rewrite.update_from_join(
        load(spark, sf_dir, "lineitem"),
        part,
        [("l_partkey", "p_partkey")],
        [Rule("l_discount", JOIN_RULE)],
    )


def partitioned_lineitem(spark: SparkSession, sf_dir: str, work: Workspace) -> str:
    """Copy of ``lineitem`` as a table partitioned by ``l_returnflag``."""
    table = work.table("lineitem")
    rows = load(spark, sf_dir, "lineitem")
    rows.write.format("parquet").partitionBy("l_returnflag").saveAsTable(table)
    return table


def rule_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, worklist.RULE_SCHEMA)


R_PART = "l_returnflag='R'"
R_OLD = "l_returnflag='R_old'"


def two_batches(spark: SparkSession, table: str, mode: str, work: Workspace) -> None:
    """Batch 2 reads what batch 1 wrote; a third rule is switched off."""
    rules = rule_rows(
        spark,
        [
            (table, 2, R_PART, R_OLD, None, "l_tax", "when l_discount = 0 then 0.5", "Y"),
            (table, 1, R_PART, R_OLD, "", "L_Discount", "when l_quantity < 25 then 0", "Y"),
            (table, 1, R_PART, R_OLD, "", "l_quantity", "when l_tax > 0.04 then 1", "Y"),
            (table, 3, R_PART, R_OLD, None, "l_tax", "when true then -1", "N"),
        ],
    )
    update.run_updates(spark, rules, mode=mode, ledger=work.table("ledger"))


TWO_BATCHES = f"""
WITH first AS (
  SELECT * REPLACE (
    CASE WHEN l_returnflag = 'R' AND l_quantity < 25 THEN 0 ELSE l_discount END AS l_discount,
    CASE WHEN l_returnflag = 'R' AND l_tax > 0.04 THEN 1 ELSE l_quantity END AS l_quantity)
  FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount,
       CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN 0.5 ELSE l_tax END AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM first
"""


@query(TWO_BATCHES)
def partition_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "partition_update")
    table = partitioned_lineitem(spark, sf_dir, work)
    two_batches(spark, table, update.OVERWRITE, work)
    return spark.table(table)


@query(TWO_BATCHES)
def partition_update_by_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "update_by_rename")
    table = partitioned_lineitem(spark, sf_dir, work)
    two_batches(spark, table, update.RENAME, work)
    return spark.table(table)


@query(TWO_BATCHES)
def partition_update_by_relocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "update_by_relocation")
    table = partitioned_lineitem(spark, sf_dir, work)
    two_batches(spark, table, update.RELOCATE, work)
    return spark.table(table)


@query("""
SELECT * REPLACE (CASE WHEN l_returnflag = 'R' AND l_quantity < 25 THEN 0 ELSE l_tax END AS l_tax)
FROM (SELECT * FROM lineitem
      UNION ALL
      SELECT * REPLACE (-l_orderkey AS l_orderkey) FROM lineitem
      WHERE l_returnflag = 'R' AND l_linenumber = 1)
""")
def partition_update_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended after a run has staged and checked, and then been lost, are kept.

    The rules apply to them too, since the next run stages them.
    """
    work = Workspace(spark, "late_rows")
    table = partitioned_lineitem(spark, sf_dir, work)
    rule = (table, 1, R_PART, R_OLD, None, "l_tax", "when l_quantity < 25 then 0", "Y")
    rules = rule_rows(spark, [rule])
    for job in update.pending_jobs(spark, rules):
        update.stage_only(spark, job)
    late = spark.table(table).where(f"{R_PART} and l_linenumber = 1")
    tables.append_by_position(late.withColumn("l_orderkey", -F.col("l_orderkey")), table)
    update.run_updates(spark, rules, ledger=work.table("ledger"))
    return spark.table(table)


MANY_BATCHES = [
    ("l_quantity", "when l_quantity > 30 then l_quantity - 30"),
    ("l_discount", "when l_quantity < 10 then 0.25"),
    ("l_tax", "when l_discount = 0.25 then l_tax + l_discount"),
    ("l_linestatus", "when l_tax > 0.3 then 'X' when l_quantity = 1 then 'Y'"),
    ("l_quantity", "when l_linestatus = 'X' then 0"),
]


def nested_cases(batches: list[tuple[str, str]], source: str, where: str) -> str:
    for column, rule in batches:
        case = f"CASE WHEN {where} THEN CASE {rule} ELSE {column} END ELSE {column} END"
        source = f"(SELECT * REPLACE ({case} AS {column}) FROM {source})"
    return f"SELECT * FROM {source}"


@query(nested_cases(MANY_BATCHES, "lineitem", "l_returnflag = 'R'"))
def partition_update_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five batches that read one another's results, in one rewrite of the partition."""
    work = Workspace(spark, "fused")
    table = partitioned_lineitem(spark, sf_dir, work)
    rules = rule_rows(
        spark,
        [(table, k, R_PART, R_OLD, None, *rule, "Y") for k, rule in enumerate(MANY_BATCHES, 1)],
    )
    update.run_updates(spark, rules, ledger=work.table("ledger"))
    return spark.table(table)


LEVEL_RULE = "when l_quantity > 40 then 0.5"


@query(f"""
SELECT * REPLACE (
  CASE WHEN l_returnflag = 'N' THEN CASE {LEVEL_RULE} ELSE l_tax END
       WHEN l_returnflag = 'A' THEN 0.0 ELSE l_tax END AS l_tax,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'R_old' ELSE l_returnflag END
    AS l_returnflag)
FROM lineitem
WHERE l_returnflag <> 'A' OR l_linestatus = 'F' AND l_quantity > 10
""")
def partition_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partition columns: an update and an overwrite below the first, a rename of both."""
    work = Workspace(spark, "levels")
    table = work.table("lineitem")
    levels = ["l_returnflag", "l_linestatus"]
    load(spark, sf_dir, "lineitem").write.partitionBy(*levels).saveAsTable(table)
    part, aside = "l_returnflag='N'", "l_returnflag='N_old'"
    rules = rule_rows(spark, [(table, 1, part, aside, None, "l_tax", LEVEL_RULE, "Y")])
    update.run_updates(spark, rules, ledger=work.table("ledger"))
    kept = spark.table(table).where("l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 10")
    rows = kept.withColumn("l_tax", F.lit(0.0)).drop("l_returnflag")
    tables.overwrite_partition(spark, table, rows, PartitionSpec("l_returnflag", "A"))
    old = PartitionSpec.parse("l_returnflag='R' AND l_linestatus='O'")
    if tables.partition_exists(spark, table, old):
        tables.rename_partition(spark, table, old, PartitionSpec("l_returnflag", "R_old"))
    return spark.table(table)


@query("""
SELECT * REPLACE (
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'A' ELSE l_returnflag END
    AS l_returnflag,
  CASE WHEN l_returnflag = 'N' AND l_tax > 0.04 THEN 0 ELSE l_tax END AS l_tax)
FROM lineitem
""")
def partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule on the partition column: rows leave N and join A's rows."""
    work = Workspace(spark, "partition_move")
    table = partitioned_lineitem(spark, sf_dir, work)
    part, aside = "l_returnflag='N'", "l_returnflag='N_old'"
    rules = rule_rows(
        spark,
        [
            (table, 1, part, aside, None, "l_returnflag", "when l_linestatus='F' then 'A'", "Y"),
            (table, 1, part, aside, None, "l_tax", "when l_tax > 0.04 then 0", "Y"),
        ],
    )
    update.run_updates(spark, rules)
    return spark.table(table)


@query("""
SELECT * REPLACE (
  CASE WHEN l_returnflag = 'A' AND p_size > 25 THEN p_retailprice ELSE l_extendedprice END
    AS l_extendedprice)
FROM (SELECT lineitem.*, p_size, p_retailprice
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
""".replace("SELECT * REPLACE", "SELECT * EXCLUDE (p_size, p_retailprice) REPLACE"))
def partition_update_from_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The from-clause of the rule table names the lookup join."""
    work = Workspace(spark, "update_from_join")
    table = partitioned_lineitem(spark, sf_dir, work)
    load(spark, sf_dir, "part").write.format("parquet").saveAsTable(work.table("part"))
    source = f"{table} left join {work.table('part')} on l_partkey = p_partkey"
    rule = "when p_size > 25 then p_retailprice"
    rules = rule_rows(
        spark,
        [(table, 1, "l_returnflag='A'", "l_returnflag='A_old'", source,
          "l_extendedprice", rule, "Y")],
    )
    update.run_updates(spark, rules)
    return spark.table(table)


SHOWN_COLUMNS = (
    "`l_orderkey`, `l_partkey`, `l_suppkey`, `l_linenumber`, `l_quantity`, `l_extendedprice`, "
    "`l_discount`, {tax}, {rest}"
)
SHOWN_PLAIN = SHOWN_COLUMNS.format(tax="`l_tax`", rest="`l_linestatus`, `l_shipdate`")
SHOWN_TAX = SHOWN_COLUMNS.format(
    tax="cast(case when l_discount = 0 then 0.5 else `l_tax` end as double) as `l_tax`",
    rest="`l_linestatus`, `l_shipdate`, `l_returnflag`",
)
SHOWN_MOVE = SHOWN_COLUMNS.format(
    tax="`l_tax`",
    rest="`l_linestatus`, `l_shipdate`, "
    "cast(case when l_linestatus = 'F' then 'A' else `l_returnflag` end as string) as `l_returnflag`",
)


def _shown(step: str, statement: str) -> str:
    return f"('{step}', '{statement.replace(chr(39), chr(39) * 2)}')"


def _shown_steps(batch: int, stage: str, steps: list[tuple[str, str]]) -> str:
    rows = [
        f"({batch}, {number}, " + _shown(step, text.format(s=stage))[1:]
        for number, (step, text) in enumerate(steps, 1)
    ]
    return ", ".join(rows)


# The stage's name ends in a checksum of the partition.
STAGE_MARK = f"{zlib.crc32(R_PART.replace(chr(39), '').encode()):08x}"
R_SHOWN = "`l_returnflag`='R'"
SHOWN = ", ".join(
    [
        _shown_steps(
            1,
            f"db.lineitem_tmp_1_{STAGE_MARK}",
            [
                (
                    "COLUMN_TRANSFORMATION_COMPLETE",
                    f"CREATE TABLE {{s}} USING parquet LOCATION 'folder' AS SELECT {SHOWN_PLAIN} "
                    f"FROM (SELECT {SHOWN_TAX} FROM db.lineitem WHERE {R_SHOWN})",
                ),
                (
                    "INSERT_TRANSFORMED_DATA_TO_SOURCE",
                    f"ALTER TABLE db.lineitem PARTITION ({R_SHOWN}) SET LOCATION 'folder'",
                ),
                (
                    "DROP_TEMP_PARTITION",
                    "CREATE TABLE {s}_old (x int, p string) USING parquet PARTITIONED BY (p)",
                ),
                (
                    "DROP_TEMP_PARTITION",
                    "ALTER TABLE {s}_old ADD PARTITION (p='0') LOCATION 'folder'",
                ),
                ("DROP_TEMP_PARTITION", "ALTER TABLE {s}_old DROP PARTITION (p='0')"),
                ("DROP_TEMP_PARTITION", "DROP TABLE {s}_old"),
                ("DROP_TEMP_PARTITION", "DROP TABLE {s}"),
            ],
        ),
        _shown_steps(
            2,
            f"db.lineitem_tmp_2_{STAGE_MARK}",
            [
                (
                    "COLUMN_TRANSFORMATION_COMPLETE",
                    f"CREATE TABLE {{s}} USING orc LOCATION 'folder' AS SELECT {SHOWN_MOVE} "
                    f"FROM db.lineitem WHERE {R_SHOWN}",
                ),
                (
                    "PARTITION_RENAMED",
                    f"ALTER TABLE db.lineitem PARTITION ({R_SHOWN}) "
                    "RENAME TO PARTITION (`l_returnflag`='R_old')",
                ),
                (
                    "INSERT_TRANSFORMED_DATA_TO_SOURCE",
                    "INSERT INTO db.lineitem SELECT /*+ REBALANCE(`l_returnflag`) */ * FROM {s}",
                ),
                (
                    "DROP_TEMP_PARTITION",
                    "ALTER TABLE db.lineitem DROP IF EXISTS PARTITION (`l_returnflag`='R_old')",
                ),
                ("DROP_TEMP_PARTITION", "DROP TABLE {s}"),
            ],
        ),
    ]
)


@query(f"""
WITH counts AS (SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R'),
steps(batch_number, step_no, step, statement) AS (VALUES {SHOWN})
SELECT CAST(batch_number AS BIGINT) AS batch_number, step_no, step, statement,
       n AS row_count
FROM steps, counts
""")
def update_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements and row counts of two jobs; the second moves rows between partitions.

    Only the database's name and the folders, new in every run, are replaced.
    """
    work = Workspace(spark, "dry_run")
    table = partitioned_lineitem(spark, sf_dir, work)
    move = "when l_linestatus = 'F' then 'A'"
    rules = rule_rows(
        spark,
        [
            (table, 1, R_PART, R_OLD, None, "l_tax", "when l_discount = 0 then 0.5", "Y"),
            (table, 2, R_PART, R_OLD, None, "l_returnflag", move, "Y"),
        ],
    )
    shown = update.dry_run(spark, rules, ledger=work.table("ledger"))
    named = F.regexp_replace("statement", "LOCATION '[^']*'", "LOCATION 'folder'")
    return shown.select(
        "batch_number",
        "step_no",
        "step",
        F.replace(named, F.lit(work.database), F.lit("db")).alias("statement"),
        "row_count",
    )


def rules_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule table as large as ``part``, with quoted and bare partition values."""
    return load(spark, sf_dir, "part").selectExpr(
        "lower(p_brand) as table_name",
        "cast(p_size as bigint) as batch_number",
        "case when p_retailprice < 950 then concat('p_type=''', p_type, '''') "
        "else concat('p_type=', p_type) end as partition_column",
        "concat('p_type=''', p_type, '_old''') as temporary_partition",
        "case when p_name like 'red%' then '' when p_name like 'blue%' then 'lookup' end "
        "as from_clause",
        "case when p_name like '%bolt' then upper(p_name) else p_name end as update_column",
        "concat('when p_size > ', p_size, ' then 0') as case_when",
        "case when p_name like 'small%' then 'N' else 'Y' end as enabled_flag",
    )


RULES_FROM_PARTS = """
rules AS (
  SELECT lower(p_brand) AS table_name, CAST(p_size AS BIGINT) AS batch_number,
         CASE WHEN p_retailprice < 950 THEN 'p_type=''' || p_type || ''''
              ELSE 'p_type=' || p_type END AS partition_column,
         'p_type=''' || p_type || '_old''' AS temporary_partition,
         CASE WHEN p_name LIKE 'red%' THEN '' WHEN p_name LIKE 'blue%' THEN 'lookup' END
           AS from_clause,
         CASE WHEN p_name LIKE '%bolt' THEN upper(p_name) ELSE p_name END AS update_column,
         'when p_size > ' || p_size || ' then 0' AS case_when,
         CASE WHEN p_name LIKE 'small%' THEN 'N' ELSE 'Y' END AS enabled_flag
  FROM part)
"""


@query(f"""
WITH {RULES_FROM_PARTS}
SELECT DISTINCT table_name, batch_number, partition_column, temporary_partition,
       coalesce(nullif(from_clause, ''), table_name) AS from_clause
FROM rules WHERE enabled_flag = 'Y' ORDER BY table_name, batch_number
""")
def update_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.update_worklist(rules_from_parts(spark, sf_dir))


@query(f"""
WITH {RULES_FROM_PARTS}
SELECT table_name, batch_number, replace(partition_column, '''', '') AS partition_key,
       lower(update_column) AS update_column, count(*) AS times
FROM rules WHERE enabled_flag = 'Y' GROUP BY 1, 2, 3, 4 HAVING count(*) > 1
""")
def duplicate_update_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.duplicate_update_columns(rules_from_parts(spark, sf_dir))


@query("""
SELECT p_partkey, quoted, bare, replace(quoted, '''', '') = replace(bare, '''', '') AS same
FROM (SELECT p_partkey, 'p_type=''' || p_type || '''' AS quoted,
             CASE WHEN p_size > 25 THEN 'p_type=' || p_type ELSE 'p_type=' || p_name END AS bare
      FROM part)
""")
def quote_insensitive_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = load(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "concat('p_type=''', p_type, '''') as quoted",
        "concat('p_type=', if(p_size > 25, p_type, p_name)) as bare",
    )
    same = equals_ignoring_quotes(F.col("quoted"), F.col("bare"))
    return specs.withColumn("same", same)


@query("SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer")
def string_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        "c_custkey", F.lower("c_mktsegment").alias("segment")
    )


@query("""
SELECT 'lineitem to orders' AS join_name, (SELECT count(*) FROM lineitem) AS original_count,
       (SELECT count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) AS new_count,
       (SELECT count(*) FROM lineitem)
         = (SELECT count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) AS matches
UNION ALL
SELECT 'orders to lineitem', (SELECT count(*) FROM orders),
       (SELECT count(*) FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey),
       (SELECT count(*) FROM orders)
         = (SELECT count(*) FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
UNION ALL
SELECT 'rewrite in place', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem), true
""")
def row_count_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup join that keeps the rows, one that fans out, and a plain rewrite."""
    lineitem = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    good = guards.join_count_guard(lineitem, orders, [("l_orderkey", "o_orderkey")])
    fans_out = guards.join_count_guard(orders, lineitem, [("o_orderkey", "l_orderkey")])
    rules = [Rule("l_tax", TAX_RULE)]
    plain = guards.row_count_guard(lineitem, rewrite.conditional_update(lineitem, rules))
    tagged = [
        frame.select(F.lit(name).alias("join_name"), "original_count", "new_count", "matches")
        for name, frame in [
            ("lineitem to orders", good),
            ("orders to lineitem", fans_out),
            ("rewrite in place", plain),
        ]
    ]
    return tagged[0].unionAll(tagged[1]).unionAll(tagged[2])


@query("""
SELECT 'shuffled' AS rows_are, count(*) AS original_count, count(*) AS new_count, true AS same
FROM lineitem
UNION ALL
SELECT 'traded', count(*), count(*), NOT EXISTS (
  SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
  EXCEPT ALL
  SELECT l_orderkey, l_linenumber,
         l_quantity + CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END FROM lineitem)
FROM lineitem
""")
def row_multiset_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rows in another order, and as many of which some are others."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    rows = load(spark, sf_dir, "lineitem").select(*columns)
    change = F.when(F.col("l_linenumber") == 1, 1).when(F.col("l_linenumber") == 2, -1).otherwise(0)
    found = [
        ("shuffled", rows.repartition(7, "l_quantity")),
        ("traded", rows.withColumn("l_quantity", F.col("l_quantity") + change)),
    ]
    guards_found = [
        guards.row_multiset_guard(rows, other, columns).withColumn("rows_are", F.lit(name))
        for name, other in found
    ]
    return guards_found[0].unionAll(guards_found[1])
