from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace import jobs
from millrace.functions import codec
from millrace.operators.worklist import RULE_SCHEMA
from millrace.plans import audit, update


def test_arguments():
    assert jobs.options_of(["Rules = a.b", "x=y=z", "flag"]) == {"rules": "a.b", "x": "y=z"}
    assert jobs.columns_of("a:long, b,c:date") == [("a", "long"), ("b", "string"), ("c", "date")]
    with pytest.raises(SystemExit):
        jobs.main(["nothing"])


def test_update_job(spark, work, capsys):
    table, rules, trail = work.table("t"), work.table("rules"), work.table("audit")
    spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string").write.partitionBy(
        "p"
    ).saveAsTable(table)
    rows = [
        (table, n, "p='a'", "p='a_old'", None, "x", f"when true then x + {n}", "Y") for n in (1, 2)
    ]
    spark.createDataFrame(rows, RULE_SCHEMA).write.saveAsTable(rules)
    audit.create_audit_table(spark, trail)
    options = {"rules": rules, "audit": trail, "batch_number": "2", "table_name": table}
    jobs.run_update(spark, {**options, "displayonly": "TRUE"})
    printed = capsys.readouterr().out
    assert "SET LOCATION" in printed and printed.count("statement=") == 7
    assert spark.table(trail).count() == 1
    shown = work.path("shown")
    jobs.run_update(spark, {"rules": rules, "displayonly": "true", "out": shown})
    assert spark.read.json(shown).count() == 7  # one rewrite for both batches
    jobs.run_update(spark, {"rules": rules, "displayonly": "true", "out": shown + "2", "fuse": "false"})
    assert spark.read.json(shown + "2").count() == 14
    assert sorted(spark.table(table).collect()) == [(1, "a"), (2, "b")]
    jobs.run_update(spark, options)
    assert sorted(spark.table(table).collect()) == [(2, "b"), (3, "a")]
    assert {r.refresh_status for r in spark.table(trail).collect()} == {"SUCCESS"}


def test_every_statement_is_shown(spark, work, capsys):
    """More statements than a screen holds: 4,500 and some."""
    table, rules = work.table("t"), work.table("rules")
    spark.createDataFrame([(1, "a")], "x int, p string").write.format("json").partitionBy(
        "p"
    ).saveAsTable(table)
    rows = [(table, n, "p='a'", "p='a_old'", None, "x", "when x < 0 then 0", "Y") for n in range(501)]
    spark.createDataFrame(rows, RULE_SCHEMA).write.saveAsTable(rules)
    plans = update._plans

    def known(spark, found, mode, files):  # one plan for all: only the printing is of interest
        first = plans(spark, found[:1], mode, files)[0]
        return [replace(first, job=j) for j in found]

    update._plans, counted = known, update._checked_count
    update._checked_count = lambda *_: 1
    try:
        jobs.run_update(spark, {"rules": rules, "displayonly": "true", "fuse": "false"})
    finally:
        update._plans, update._checked_count = plans, counted
    assert capsys.readouterr().out.count("statement=") == 9 * 501


@pytest.mark.parametrize("sink", ["table", "batches"])
def test_consume_job(spark, work, sink):
    tokens = spark.range(20).select(codec.base64_token(F.col("id")))
    codec.rows_to_messages(tokens).write.text(work.path("topic"))
    table = work.table("out")
    if sink == "batches":
        spark.sql(
            f"CREATE TABLE {table} (n bigint, quarantined string, batch_id bigint, batch_range bigint) "
            "USING parquet PARTITIONED BY (batch_range)"
        )
    options = {
        "path": work.path("topic"), "table": table, "checkpoint": work.path("ck"), "sink": sink,
        "columns": "n:long", "trigger": "available", "batches_per_partition": "10",
    }
    jobs.run_consume(spark, options, fmt="text")
    assert sorted(r.n for r in spark.table(table).collect()) == list(range(20))
    with pytest.raises(SystemExit):
        jobs.run_consume(spark, {**options, "sink": "nowhere"}, fmt="text")


def test_load_job(spark, work, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,b\n")
    (tmp_path / "list.txt").write_text("a.csv\n")
    target = work.table("flat")
    spark.sql(f"CREATE TABLE {target} (x bigint, y string, f string) USING parquet")
    jobs.run_load(
        spark,
        {
            "list": str(tmp_path / "list.txt"),
            "base": str(tmp_path),
            "target": target,
            "columns": "x:long,y",
        },
    )
    assert [tuple(r) for r in spark.table(target).collect()] == [(1, "b", "a.csv")]
