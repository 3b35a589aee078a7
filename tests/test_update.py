import re
from pathlib import Path

import pytest
from conftest import fail_in_a_task
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.errors import (
    ConcurrentChangeError,
    ConflictingRulesError,
    DuplicateColumnError,
    RowCountMismatchError,
    UnfinishedJobError,
    UnknownColumnError,
    WrongPartitionError,
)
from millrace.operators import tables, worklist
from millrace.plans import audit, update


class Setup:
    def __init__(self, spark, work):
        self.spark, self.work = spark, work
        self.table = work.table("t")
        self.audit = work.table("audit")
        self.ledger = work.table("ledger")
        rows = [(1, 1.0, "a"), (2, 2.0, "a"), (3, 3.0, "b"), (4, None, "b")]
        spark.createDataFrame(rows, "Id int, v double, p string").write.partitionBy(
            "p"
        ).saveAsTable(self.table)
        audit.create_audit_table(spark, self.audit)

    def rule(self, column, case_when, *, batch=1, part="p='a'", source=None, flag="Y",
             aside="p='a_old'", table=None):
        return (table or self.table, batch, part, aside, source, column, case_when, flag)

    def rules(self, *rows):
        return self.spark.createDataFrame(list(rows), worklist.RULE_SCHEMA)

    def run(self, *rows, **options):
        options = {"audit_table": self.audit, **options}
        return update.run_updates(self.spark, self.rules(*rows), **options)

    def rows(self):
        return sorted((tuple(r) for r in self.spark.table(self.table).collect()), key=str)

    def statuses(self):
        return [r.refresh_status for r in self.spark.table(self.audit).collect()]

    def tables(self):
        return {t.name for t in self.spark.catalog.listTables(self.work.database)}


@pytest.fixture
def t(spark, work):
    return Setup(spark, work)


MODES = pytest.mark.parametrize("mode", [*update.MODES, None])
LEDGER = pytest.mark.parametrize("noted", [True, False], ids=["ledger", "no ledger"])


@MODES
def test_batches_apply_in_numeric_order(t, mode):
    t.run(
        t.rule("v", "when v = 20 then 5", batch=10),
        t.rule("V", "when id = 2 then 20", batch=9),
        t.rule("ID", "when v = 2 then 7", batch=9, part="p=a"),
        t.rule("v", "when true then -1", batch=11, flag="N"),
        mode=mode,
    )
    assert t.rows() == [(1, 1.0, "a"), (3, 3.0, "b"), (4, None, "b"), (7, 5.0, "a")]
    assert t.statuses() == ["SUCCESS"]
    assert t.tables() == {"t", "audit"}


@MODES
@pytest.mark.parametrize("part", ["d = 20240102", "D='20240102'"])
def test_partition_column_may_be_a_number(t, mode, part):
    table = t.work.table("numbers")
    t.spark.createDataFrame([(1, 20240101), (2, 20240102)], "x int, d int").write.partitionBy(
        "d"
    ).saveAsTable(table)
    t.run(
        t.rule("x", "when d > 20240101 then x * 10", part=part, aside="d=0", table=table),
        mode=mode,
    )
    assert sorted(tuple(r) for r in t.spark.table(table).collect()) == [
        (1, 20240101), (20, 20240102),
    ]


def test_number_of_files_can_be_asked_for(t):
    t.spark.range(1000).selectExpr("id", "'x' as p").write.partitionBy("p").saveAsTable(
        t.work.table("big")
    )
    rule = t.rule("id", "when true then id", part="p='x'", table=t.work.table("big"))
    t.run(rule, mode=update.RELOCATE, files=3)
    assert len(t.spark.table(t.work.table("big")).inputFiles()) == 3


def test_only_filters_the_worklist(t):
    done = t.run(
        t.rule("v", "when true then 0", batch=1),
        t.rule("v", "when true then 9", batch=2),
        only=F.col("batch_number") == 1,
    )
    assert [j.batch for j in done] == [1]
    assert (1, 0.0, "a") in t.rows()


@MODES
def test_each_batch_fires_once(t, mode):
    rule = t.rule("v", "when true then v + 1")
    for _ in range(2):
        t.run(rule, mode=mode, ledger=t.ledger)
    t.run(t.rule("v", "when true then v + 1", part="p=a"), mode=mode, ledger=t.ledger)
    assert (1, 2.0, "a") in t.rows() and (2, 3.0, "a") in t.rows()
    assert t.statuses() == ["SUCCESS"] * 3


def break_statement(monkeypatch, starts, times=1):
    """Make the session fail on statements with a given start."""
    from pyspark.sql import SparkSession

    real = SparkSession.sql
    left = [times]

    def sql(self, text, *args, **kwargs):
        if text.startswith(starts) and left[0]:
            left[0] -= 1
            raise RuntimeError(f"lost: {starts}")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(SparkSession, "sql", sql)


def lose(monkeypatch, module, name):
    """The driver dies when it calls this function."""

    def call(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(module, name, call)


def lose_append_mark(monkeypatch):
    """The driver dies after the rows were appended, before the stage says so."""
    real = update._set_stage_property

    def mark(spark, stage, key, value):
        if value == update.APPENDED:
            raise RuntimeError("lost driver")
        real(spark, stage, key, value)

    monkeypatch.setattr(update, "_set_stage_property", mark)


SWITCHES = pytest.mark.parametrize("mode", [update.OVERWRITE, update.RELOCATE])


@SWITCHES
@LEDGER
def test_failed_commit_leaves_target_and_resumes(t, monkeypatch, mode, noted):
    before = t.rows()
    rule = t.rule("v", "when true then v + 1")
    how = {"mode": mode, "ledger": t.ledger if noted else None}
    break_statement(monkeypatch, f"ALTER TABLE {t.table} PARTITION")
    with pytest.raises(RuntimeError):
        t.run(rule, **how)
    assert t.rows() == before
    assert t.statuses() == ["FAILED"]
    message = t.spark.table(t.audit).first().message
    assert update.TRANSFORMED in message and "(2 rows)" in message and "lost" in message
    t.run(rule, **how)
    assert (1, 2.0, "a") in t.rows() and len(t.rows()) == 4
    assert t.tables() == {"t", "audit"} | ({"ledger"} if noted else set())


AFTER = [(1, 2.0, "a"), (2, 3.0, "a"), (3, 3.0, "b"), (4, None, "b")]


@LEDGER
def test_an_append_that_fails_in_a_task_loses_nothing(t, monkeypatch, noted):
    rule = t.rule("v", "when true then v + 1")
    how = {"mode": update.RENAME, "ledger": t.ledger if noted else None}
    with monkeypatch.context() as broken:
        fail_in_a_task(broken, f"INSERT INTO {t.table} ")
        for _ in range(2):
            with pytest.raises(Exception, match="lost task"):
                t.run(rule, **how)
            kept = {name for name in t.tables() if name.startswith("t_tmp_")}
            assert len(kept) == 1
            assert t.spark.table(f"{t.work.database}.{kept.pop()}").count() == 2
    assert t.statuses() == ["FAILED"] * 2
    t.run(rule, **how)
    assert t.rows() == AFTER
    assert sorted(t.statuses()) == ["FAILED", "FAILED", "SUCCESS"]
    assert t.tables() == {"t", "audit"} | ({"ledger"} if noted else set())


@LEDGER
@pytest.mark.parametrize("mode", update.MODES)
def test_a_stage_that_fails_in_a_task_changes_nothing(t, mode, noted):
    before = t.rows()
    how = {"mode": mode, "ledger": t.ledger if noted else None}
    with pytest.raises(Exception, match="lost task|CAST_OVERFLOW"):
        t.run(t.rule("id", "when id = 2 then 3000000000"), **how)
    assert t.rows() == before
    t.run(t.rule("v", "when true then v + 1"), **how)
    assert t.rows() == AFTER


@pytest.mark.parametrize("mode", update.MODES)
def test_a_checked_stage_is_kept_from_other_rules(t, monkeypatch, mode):
    rename = mode == update.RENAME
    break_statement(monkeypatch, "INSERT INTO" if rename else f"ALTER TABLE {t.table} PARTITION")
    with pytest.raises(RuntimeError):
        t.run(t.rule("v", "when true then v + 1"), mode=mode)
    before = t.rows()
    with pytest.raises(UnfinishedJobError):
        t.run(t.rule("v", "when true then v + 2"), mode=mode)
    assert t.rows() == before and len(t.tables()) == 3
    t.run(t.rule("v", "when true then v + 1"), mode=mode)
    assert t.rows() == AFTER


def test_default_mode_follows_the_format(t):
    job = update.UpdateJob(t.table, 1, "p='a'", None, t.table, (update.Rule("v", "when true then 0"),))
    assert update.plan_job(t.spark, job).mode == update.RELOCATE
    other = t.work.table("lines")
    t.spark.table(t.table).write.format("json").partitionBy("p").saveAsTable(other)
    job = update.UpdateJob(other, 1, "p='a'", None, other, (update.Rule("v", "when true then 0"),))
    assert update.plan_job(t.spark, job).mode == update.OVERWRITE
    with pytest.raises(ValueError, match="cannot relocate"):
        update.plan_job(t.spark, job, update.RELOCATE)
    t.run(t.rule("v", "when true then v + 1", table=other))
    assert sorted(r.v for r in t.spark.table(other).where("p = 'a'").collect()) == [2.0, 3.0]


@MODES
@pytest.mark.parametrize(
    "part", ["p='zz'", "p='a' and x='1'", "v='1.0'", "id=1", "p='a', q='b'"]
)
def test_wrong_partitions_are_refused(t, part, mode):
    before = t.rows()
    good = t.rule("v", "when true then 0", batch=1)
    with pytest.raises(WrongPartitionError):
        t.run(good, t.rule("v", "when true then 0", batch=2, part=part), mode=mode, ledger=t.ledger)
    assert t.rows() == before
    names = [r.partition for r in t.spark.sql(f"SHOW PARTITIONS {t.table}").collect()]
    assert names == ["p=a", "p=b"] and t.statuses() == ["FAILED"]
    assert t.tables() == {"t", "audit"}


MONTHS = [(1, "2023", "12"), (2, "2024", "01"), (3, "2024", "02"), (4, "2024", "02")]


def months(t, fmt="parquet"):
    table = t.work.table("months")
    frame = t.spark.createDataFrame(MONTHS, "x int, y string, m string")
    frame.write.format(fmt).partitionBy("y", "m").saveAsTable(table)
    return table


def values(t, table):
    return sorted(tuple(r) for r in t.spark.table(table).collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("part", ["y='2024', m='02'", "m=02 AND Y='2024'"])
def test_a_partition_of_several_levels(t, part, fmt):
    table = months(t, fmt)
    t.run(t.rule("x", "when x > 3 then x * 10", part=part, table=table), ledger=t.ledger)
    assert values(t, table) == [*MONTHS[:3], (40, "2024", "02")]


@MODES
def test_all_partitions_below_the_first_levels(t, mode, monkeypatch):
    table = months(t)
    rule = t.rule("x", "when true then x * 10", part="y='2024'", aside="y='2024_old'", table=table)
    done = update.ledgers.record_done
    lose(monkeypatch, update.ledgers, "record_done")  # after the first of two partitions
    with pytest.raises(RuntimeError):
        t.run(rule, mode=mode, ledger=t.ledger)
    monkeypatch.setattr(update.ledgers, "record_done", done)
    for _ in range(2):
        t.run(rule, mode=mode, ledger=t.ledger)
        assert values(t, table) == [MONTHS[0], (20, "2024", "01"), (30, "2024", "02"), (40, "2024", "02")]
    assert t.tables() == {"t", "audit", "ledger", "months"}


@pytest.mark.parametrize("part", ["m='02'", "y='2024', z='1'", "y='1999'", "y='2024', m='07'"])
def test_wrong_levels_are_refused(t, part):
    table = months(t)
    with pytest.raises(WrongPartitionError):
        t.run(t.rule("x", "when true then 0", part=part, table=table))
    assert values(t, table) == MONTHS


def test_rows_move_between_levels(t):
    table = months(t)
    rule = t.rule("m", "when x = 3 then '03'", part="y='2024', m='02'", aside="m='02_old'", table=table)
    t.run(rule)
    assert values(t, table) == [*MONTHS[:2], (3, "2024", "03"), MONTHS[3]]


def test_a_partition_may_come_from_rows_that_move(t):
    t.run(
        t.rule("p", "when id = 1 then 'c'", batch=1),
        t.rule("v", "when true then 9", batch=2, part="p='c'", aside="p='c_old'"),
    )
    assert t.rows() == [(1, 9.0, "c"), (2, 2.0, "a"), (3, 3.0, "b"), (4, None, "b")]
    with pytest.raises(WrongPartitionError):
        t.run(
            t.rule("p", "when id = 3 then 'a'", batch=1, part="p='b'", aside="p='b_old'"),
            t.rule("v", "when true then 9", batch=2, part="p='d'"),
        )


@MODES
def test_a_join_that_trades_rows_is_refused(t, mode):
    """One row twice and one not at all: the totals agree."""
    before = t.rows()
    t.spark.createDataFrame([(1, 5), (1, 6)], "k int, w int").write.saveAsTable(t.work.table("l"))
    rule = t.rule("v", "when w > 0 then w", source=f"{t.table} join {t.work.table('l')} on id = k")
    with pytest.raises(RowCountMismatchError, match="more than once"):
        t.run(rule, mode=mode)
    with pytest.raises(RowCountMismatchError, match="more than once"):
        update.dry_run(t.spark, t.rules(rule), mode=mode)
    assert t.rows() == before and t.tables() == {"t", "audit", "l"}


@pytest.mark.parametrize("mode", [update.OVERWRITE, update.RELOCATE])
def test_crash_after_commit_does_not_apply_twice(t, monkeypatch, mode):
    rule = t.rule("v", "when true then v + 1")
    lose(monkeypatch, update.ledgers, "record_done")
    with pytest.raises(RuntimeError):
        t.run(rule, ledger=t.ledger, mode=mode)
    monkeypatch.undo()
    assert (1, 2.0, "a") in t.rows()
    t.run(rule, ledger=t.ledger, mode=mode)
    assert (1, 2.0, "a") in t.rows() and (2, 3.0, "a") in t.rows()
    assert t.tables() == {"t", "audit", "ledger"}


def test_relocation_deletes_what_it_replaces(t):
    spec = tables.PartitionSpec("p", "a")
    first = tables.partition_location(t.spark, t.table, spec)
    for batch in (1, 2):
        t.run(t.rule("v", "when true then v + 1", batch=batch), mode=update.RELOCATE)
        now = tables.partition_location(t.spark, t.table, spec)
        assert tables.REWRITTEN in now and now != first
        assert not Path(first.removeprefix("file:")).exists()
        first = now
    assert (1, 3.0, "a") in t.rows() and (2, 4.0, "a") in t.rows()
    rows = t.spark.createDataFrame([(9, 9.0)], "id int, v double")
    tables.overwrite_partition(t.spark, t.table, rows, spec)
    assert t.rows() == [(3, 3.0, "b"), (4, None, "b"), (9, 9.0, "a")]


def test_refused_relocation_leaves_no_files(t):
    t.spark.createDataFrame([(1, 5), (1, 6)], "k int, w int").write.saveAsTable(t.work.table("s"))
    source = f"{t.table} left join {t.work.table('s')} on id = k"
    before = t.rows()
    with pytest.raises(RowCountMismatchError):
        t.run(t.rule("v", "when w > 0 then w", source=source), mode=update.RELOCATE)
    assert t.rows() == before
    root = Path(tables.table_location(t.spark, t.table).removeprefix("file:"))
    rewritten = root / tables.REWRITTEN
    assert not rewritten.exists() or list(rewritten.iterdir()) == []


def test_rename_restores_when_the_insert_fails(t, monkeypatch):
    before = t.rows()
    rule = t.rule("v", "when true then v + 1")
    break_statement(monkeypatch, "INSERT INTO")
    with pytest.raises(RuntimeError):
        t.run(rule, mode=update.RENAME, ledger=t.ledger)
    assert t.rows() == before
    t.run(rule, mode=update.RENAME, ledger=t.ledger)
    assert (1, 2.0, "a") in t.rows() and len(t.rows()) == 4


@pytest.mark.parametrize("lost", ["append mark", "ledger"])
def test_interrupted_rename_resumes(t, monkeypatch, lost):
    rule = t.rule("v", "when true then v + 1")
    if lost == "ledger":
        lose(monkeypatch, update.ledgers, "record_done")
    else:
        lose_append_mark(monkeypatch)
    with pytest.raises(RuntimeError):
        t.run(rule, mode=update.RENAME, ledger=t.ledger)
    monkeypatch.undo()
    t.run(rule, mode=update.RENAME, ledger=t.ledger)
    assert t.rows() == [(1, 2.0, "a"), (2, 3.0, "a"), (3, 3.0, "b"), (4, None, "b")]
    assert t.tables() == {"t", "audit", "ledger"}


def test_rows_move_between_partitions(t):
    t.run(t.rule("p", "when id = 1 then 'b' when id = 2 then 'c'"))
    assert t.rows() == [(1, 1.0, "b"), (2, 2.0, "c"), (3, 3.0, "b"), (4, None, "b")]


def test_a_hot_value_gets_more_files_than_small_ones(t):
    """Nine tenths of the rows move to one value, the rest to many, from many tasks."""
    table = t.work.table("wide")
    value = "if(id % 10 > 0, 'hot', concat('v', id % 70))"
    rows = t.spark.range(200_000, numPartitions=8).selectExpr("id", "sha2(cast(id as string), 256) as s", f"{value} as q", "'x' as p")
    rows.write.partitionBy("p").saveAsTable(table)
    rule = t.rule("p", "when true then q", part="p='x'", aside="p='x_old'", table=table)
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    with tables.session_setting(t.spark, *list(settings.items())[0]), tables.session_setting(t.spark, *list(settings.items())[1]):
        t.run(rule)
    files = t.spark.table(table).selectExpr("p", "_metadata.file_name f", "_metadata.file_size n").distinct()
    by_value = {r.p: (r.files, r.most) for r in files.groupBy("p").agg(F.count("f").alias("files"), F.max("n").alias("most")).collect()}
    assert len(by_value) == 8 and by_value["hot"][0] > 4
    assert max(most for _, most in by_value.values()) < 4_000_000
    # Those that share the hot value's shuffle partition are split along with it.
    assert sum(n <= 2 for n, _ in by_value.values()) >= 4
    assert t.spark.table(table).where("p <> q").isEmpty() and t.spark.table(table).count() == 200_000


def test_interrupted_move_is_not_guessed(t, monkeypatch):
    rule = t.rule("p", "when id = 1 then 'b'")
    lose_append_mark(monkeypatch)
    with pytest.raises(RuntimeError):
        t.run(rule, ledger=t.ledger)
    monkeypatch.undo()
    with pytest.raises(ConflictingRulesError, match="by hand"):
        t.run(rule, ledger=t.ledger)


def test_move_finished_but_not_noted_is_not_repeated(t, monkeypatch):
    rule = t.rule("p", "when id = 1 then 'b'")
    lose(monkeypatch, update.ledgers, "record_done")
    with pytest.raises(RuntimeError):
        t.run(rule, ledger=t.ledger)
    monkeypatch.undo()
    t.run(rule, ledger=t.ledger)
    assert t.rows() == [(1, 1.0, "b"), (2, 2.0, "a"), (3, 3.0, "b"), (4, None, "b")]


def test_from_clause_join(t):
    t.spark.createDataFrame([(1, 100.0, 5)], "Id int, v double, extra int").write.saveAsTable(
        t.work.table("s")
    )
    source = f"{t.table} left join {t.work.table('s')} on t.id = s.id"
    t.run(t.rule("v", "when s.v > 0 then s.v + t.v", source=source))
    assert t.rows()[:2] == [(1, 101.0, "a"), (2, 2.0, "a")]


def test_fan_out_is_refused_before_the_target_changes(t):
    before = t.rows()
    t.spark.createDataFrame([(1, 5), (1, 6)], "k int, w int").write.saveAsTable(t.work.table("s"))
    source = f"{t.table} left join {t.work.table('s')} on id = k"
    rule = t.rule("v", "when w > 0 then w", source=source)
    with pytest.raises(RowCountMismatchError, match="more than once"):
        t.run(rule)
    lines = t.work.table("lines")
    t.spark.table(t.table).write.format("json").partitionBy("p").saveAsTable(lines)
    source = f"{lines} left join {t.work.table('s')} on id = k"
    with pytest.raises(RowCountMismatchError, match="2 rows before the rewrite, 3 after"):
        t.run(t.rule("v", "when w > 0 then w", source=source, table=lines))
    assert t.rows() == before
    assert t.tables() == {"t", "audit", "s", "lines"}
    with pytest.raises(RowCountMismatchError):
        update.dry_run(t.spark, t.rules(rule))


@pytest.mark.parametrize(
    "rows, error",
    [
        ([("v", "when true then 1", {}), ("V", "when true then 2", {"part": "p=a"})],
         DuplicateColumnError),
        ([("nope", "when true then 1", {})], UnknownColumnError),
        ([("v", "when true then 1", {}), ("id", "when true then 1", {"aside": "p='z'"})],
         ConflictingRulesError),
        ([("v", "when nope then 1", {})], AnalysisException),
        ([("p", "when true then 'b'", {"aside": None})], ConflictingRulesError),
        ([("v", "when true then 1", {"part": None})], ConflictingRulesError),
    ],
)
def test_bad_rules_change_nothing(t, rows, error):
    before = t.rows()
    with pytest.raises(error):
        t.run(*[t.rule(c, w, **more) for c, w, more in rows])
    assert t.rows() == before
    assert t.statuses() == ["FAILED"]


def test_dry_run_shows_what_runs(t, monkeypatch):
    before = t.rows()
    rows = [t.rule("v", "when true then 0"), t.rule("p", "when id=1 then 'b'", batch=2)]
    steps = update.dry_run(
        t.spark, t.rules(*rows), mode=update.OVERWRITE, ledger=t.ledger, audit_table=t.audit
    ).collect()
    assert t.rows() == before and t.tables() == {"t", "audit"}
    trail = t.spark.table(t.audit).first()
    assert trail.refresh_status == "SUCCESS" and "2 jobs with 14 statements" in trail.message
    assert [s.step for s in steps] == [
        *[update.TRANSFORMED] * 3, update.INSERTED, *[update.TEMP_DROPPED] * 5,
        update.TRANSFORMED, update.RENAMED, update.INSERTED,
        update.TEMP_DROPPED, update.TEMP_DROPPED,
    ]
    assert {s.row_count for s in steps} == {2}
    from pyspark.sql import SparkSession

    real, ran = SparkSession.sql, []

    def sql(self, text, *args, **kwargs):
        ran.append(text)
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(SparkSession, "sql", sql)
    t.run(*rows, mode=update.OVERWRITE)
    # Every run has folders of its own.
    shown, ran = ([re.sub("LOCATION '[^']*'", "", x) for x in y] for y in ([s.statement for s in steps], ran))
    assert [x for x in ran if x in shown] == shown


def test_a_long_dry_run_is_shown_whole(t):
    rows = [t.rule("v", "when true then 0", batch=n) for n in range(12)]
    assert update.dry_run(t.spark, t.rules(*rows), fuse=False).count() == 12 * 7
    assert update.dry_run(t.spark, t.rules(*rows)).count() == 7


def test_worklist(t):
    found = worklist.update_worklist(
        t.rules(
            t.rule("v", "w", batch=10), t.rule("id", "w", batch=10), t.rule("v", "w", batch=9),
            t.rule("v", "w", batch=8, source="x join y"), t.rule("v", "w", batch=7, flag="N"),
            t.rule("v", "w", batch=9, source=""), t.rule("v", "w", batch=6, flag=None),
        )
    ).collect()
    assert [(r.batch_number, r.from_clause) for r in found] == [
        (8, "x join y"), (9, t.table), (10, t.table),
    ]


def test_partition_is_rewritten_without_shuffle(t):
    job = update.UpdateJob(t.table, 1, "p='a'", None, t.table,
                           (update.Rule("v", "when true then 0"),))
    plan = t.spark.sql(update.plan_job(t.spark, job).select)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "(p#" in text[text.index("PartitionFilters"):]


class Lost(BaseException):
    """The driver dies: no handler runs."""


def before_statement(monkeypatch, starts, do, times=1):
    """Do something right before the next statements with a given start."""
    from pyspark.sql import SparkSession

    real, left = SparkSession.sql, [times]

    def sql(self, text, *args, **kwargs):
        if text.startswith(starts) and left[0]:
            left[0] -= 1
            do()
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(SparkSession, "sql", sql)


def other_writer(t, number=9, part="a", table=None):
    """Another session's append: its files show up in the partition's folder."""
    def write():
        place = tables.partition_location(t.spark, table or t.table, tables.PartitionSpec("p", part))
        row = t.spark.createDataFrame([(number, 0.5)], "Id int, v double")
        row.write.mode("append").format(tables.table_provider(t.spark, table or t.table)).save(place)

    return write


def commit_of(t, mode):
    name = "RENAME" if mode == update.RENAME else "SET LOCATION"
    return f"ALTER TABLE {t.table} PARTITION (`p`='a') {name}"


ALL = pytest.mark.parametrize("mode", update.MODES)


@ALL
@LEDGER
def test_rows_appended_between_runs_are_rewritten_too(t, monkeypatch, mode, noted):
    rule = t.rule("v", "when true then v + 1")
    how = {"mode": mode, "ledger": t.ledger if noted else None}

    def die():
        raise Lost

    with monkeypatch.context() as broken:
        before_statement(broken, commit_of(t, mode), die)
        with pytest.raises(Lost):
            t.run(rule, **how)
    other_writer(t)()
    t.run(rule, **how)
    t.spark.catalog.refreshTable(t.table)
    assert t.rows() == [*AFTER[:2], (3, 3.0, "b"), (4, None, "b"), (9, 1.5, "a")]
    assert t.tables() == {"t", "audit"} | ({"ledger"} if noted else set())


@ALL
def test_rows_appended_while_staging_are_rewritten_too(t, monkeypatch, mode):
    real, left = update._checked_count, [1]

    def checked(*args):
        n = real(*args)
        if left[0]:
            left[0] -= 1
            other_writer(t)()
        return n

    monkeypatch.setattr(update, "_checked_count", checked)
    t.run(t.rule("v", "when true then v + 1"), mode=mode)
    t.spark.catalog.refreshTable(t.table)
    assert (9, 1.5, "a") in t.rows() and len(t.rows()) == 5
    assert t.tables() == {"t", "audit"}


@ALL
def test_rows_appended_right_before_the_commit_are_kept(t, monkeypatch, mode):
    """After the last check: they are found beside the old files and stay as they are."""
    before_statement(monkeypatch, commit_of(t, mode), other_writer(t))
    t.run(t.rule("v", "when true then v + 1"), mode=mode, ledger=t.ledger)
    t.spark.catalog.refreshTable(t.table)
    assert t.rows() == [*AFTER[:2], (3, 3.0, "b"), (4, None, "b"), (9, 0.5, "a")]
    assert t.tables() == {"t", "audit", "ledger"}
    left = Path(tables.table_location(t.spark, t.table).removeprefix("file:")) / tables.REWRITTEN
    assert len(list(left.glob("*"))) == (mode != update.RENAME)


@ALL
def test_a_driver_lost_while_late_rows_are_appended_is_reported(t, monkeypatch, mode):
    rule = t.rule("v", "when true then v + 1")
    commit = commit_of(t, mode)

    def die():
        raise Lost

    with monkeypatch.context() as broken:
        before_statement(broken, commit, other_writer(t))
        before_statement(broken, f"INSERT INTO {t.table} PARTITION", die)
        with pytest.raises(Lost):
            t.run(rule, mode=mode)
    with pytest.raises(UnfinishedJobError, match="late rows"):
        t.run(rule, mode=mode)
    assert len(t.rows()) >= 4


@ALL
def test_a_partition_replaced_meanwhile_is_left_alone(t, monkeypatch, mode):
    def replace():
        place = tables.partition_location(t.spark, t.table, tables.PartitionSpec("p", "a"))
        t.spark.createDataFrame([(8, 8.0)], "Id int, v double").write.mode("overwrite").parquet(place)

    rule = t.rule("v", "when true then v + 1")
    with monkeypatch.context() as broken:
        before_statement(broken, commit_of(t, mode), replace)
        with pytest.raises(ConcurrentChangeError):
            t.run(rule, mode=mode)
    t.spark.catalog.refreshTable(t.table)
    assert t.rows() == [(3, 3.0, "b"), (4, None, "b"), (8, 8.0, "a")]
    t.run(rule, mode=mode)
    t.spark.catalog.refreshTable(t.table)
    assert t.rows() == [(3, 3.0, "b"), (4, None, "b"), (8, 9.0, "a")]


@ALL
def test_a_partition_that_never_rests_is_given_up(t, monkeypatch, mode):
    real = update._checked_count

    def checked(*args):
        n = real(*args)
        other_writer(t)()
        return n

    monkeypatch.setattr(update, "_checked_count", checked)
    with pytest.raises(ConcurrentChangeError, match="5 attempts"):
        t.run(t.rule("v", "when true then v + 1"), mode=mode)
    t.spark.catalog.refreshTable(t.table)
    assert [r for r in t.rows() if r[0] != 9] == [(1, 1.0, "a"), (2, 2.0, "a"), (3, 3.0, "b"), (4, None, "b")]
    assert t.tables() == {"t", "audit"}


@SWITCHES
def test_a_driver_lost_at_any_statement_loses_nothing(t, monkeypatch, mode):
    """The run is stopped before each of its statements in turn and then run again."""
    def die():
        raise Lost

    for n in range(1, 40, 2):
        rule = t.rule("v", "when true then v + 1", batch=n)
        seen = []
        with monkeypatch.context() as broken:
            def count(seen=seen, n=n):
                seen.append(1)
                if len(seen) == n:
                    die()

            before_statement(broken, ("ALTER", "CREATE TABLE", "DROP", "INSERT"), count, times=10**6)
            try:
                t.run(rule, mode=mode, ledger=t.ledger)
                break
            except Lost:
                pass
        t.run(rule, mode=mode, ledger=t.ledger)
        assert t.rows() == [(1, 1.0 + n, "a"), (2, 2.0 + n, "a"), (3, 3.0, "b"), (4, None, "b")]
    assert 8 < n < 39


@pytest.mark.parametrize("fmt", ["orc", "json", "parquet"])
def test_a_join_that_trades_rows_is_refused_in_any_format(t, fmt):
    """One row twice and another not at all: the numbers agree, the rows do not."""
    table = t.work.table("other")
    t.spark.table(t.table).write.format(fmt).partitionBy("p").saveAsTable(table)
    t.spark.createDataFrame([(1, 5), (1, 6)], "k int, w int").write.saveAsTable(t.work.table("l"))
    for source in (f"{table} join {t.work.table('l')} on id = k", f"{table} o join {t.work.table('l')} on id = k"):
        rule = t.rule("v", "when w > 0 then w", source=source, table=table)
        for act in (lambda rule=rule: t.run(rule), lambda rule=rule: update.dry_run(t.spark, t.rules(rule))):
            with pytest.raises(RowCountMismatchError, match="not the same ones|more than once"):
                act()
    assert sorted(r.Id for r in t.spark.table(table).collect()) == [1, 2, 3, 4]


def many_batches(t, n=6):
    return [
        t.rule("v", f"when id % 2 = {k % 2} then v * 2 + {k}", batch=k, part="p='a'" if k % 3 else "p=a")
        for k in range(n)
    ]


@MODES
def test_batches_of_a_partition_are_fused(t, monkeypatch, mode):
    """One rewrite, with the result of all batches in turn."""
    from pyspark.sql import SparkSession

    rules = [*many_batches(t), t.rule("id", "when v > 40 then 100", batch=6)]
    rules.append(t.rule("v", "when true then -1", batch=3, part="p='b'"))
    ran, real = [], SparkSession.sql
    monkeypatch.setattr(SparkSession, "sql", lambda self, text, *a, **k: ran.append(text) or real(self, text, *a, **k))
    done = t.run(*rules, mode=mode, ledger=t.ledger)
    monkeypatch.undo()
    assert len(done) == 8
    assert sum(" AS SELECT " in x and x.startswith("CREATE") or x.startswith("INSERT OVERWRITE") for x in ran) == 2
    fused = t.rows()
    noted = {(r.batch_number, r.partition_key) for r in t.spark.table(t.ledger).collect()}
    assert noted == {(3, "p=b"), *((k, "p=a" if k < 6 or k == 6 else "") for k in range(7))}
    before = t.spark.createDataFrame([(1, 1.0), (2, 2.0)], "Id int, v double")
    for k in range(6):
        before = before.selectExpr("Id", f"case when id % 2 = {k % 2} then v * 2 + {k} else v end as v")
    want = before.selectExpr("case when v > 40 then 100 else Id end as Id", "v", "'a' as p").collect()
    assert fused == sorted([*map(tuple, want), (3, -1.0, "b"), (4, -1.0, "b")], key=str)
    assert t.run(*rules, mode=mode, ledger=t.ledger) == []


def test_what_may_depend_on_other_jobs_is_not_fused(t):
    def batches(*rules):
        jobs = update.expand_jobs(t.spark, update.pending_jobs(t.spark, t.rules(*rules)))
        return [[step.batch for step in job.steps] for job in update.fuse_jobs(t.spark, jobs)]

    plain = [t.rule("v", "when true then 1", batch=k) for k in (1, 2, 3)]
    assert batches(*plain) == [[1, 2, 3]]
    assert batches(plain[0], t.rule("p", "when id = 1 then 'b'", batch=2), plain[2]) == [[1], [2], [3]]
    query = f"when v > (select max(v) from {t.table}) then 0"
    assert batches(plain[0], t.rule("v", query, batch=2), plain[2]) == [[1], [2], [3]]
    assert batches(plain[0], t.rule("v", "when true then 2", batch=2, source=f"{t.table} x"), plain[2]) == [[1], [2], [3]]
    assert batches(plain[0], t.rule("v", "when t.v > 0 then 2", batch=2), plain[2]) == [[1, 2, 3]]


def test_a_batch_that_fails_leaves_those_before_it(t):
    rules = [t.rule("v", "when true then v + 1", batch=1), t.rule("id", "when id = 2 then 3000000000", batch=2)]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        t.run(*rules, t.rule("v", "when true then 0", batch=3), ledger=t.ledger)
    assert t.rows() == AFTER
    assert [r.batch_number for r in t.spark.table(t.ledger).collect()] == [1]


def test_an_interrupted_fused_job_resumes_beside_new_batches(t, monkeypatch):
    rules = many_batches(t, 2)
    break_statement(monkeypatch, commit_of(t, update.RELOCATE))
    with pytest.raises(RuntimeError):
        t.run(*rules, ledger=t.ledger)
    t.run(*rules, t.rule("v", "when true then v + 0.25", batch=5), ledger=t.ledger)
    assert t.rows()[:2] == [(1, 3.25, "a"), (2, 4.25, "a")]
    assert sorted(r.batch_number for r in t.spark.table(t.ledger).collect()) == [0, 1, 5]


def test_a_dry_run_counts_what_earlier_jobs_leave(t):
    t.spark.createDataFrame([(1, 5), (3, 6)], "k int, w int").write.saveAsTable(t.work.table("l"))
    lookup = f"{t.table} left join {t.work.table('l')} on t.id = k"
    rows = [
        t.rule("p", "when id = 1 then 'b' when id = 2 then 'c'", batch=1),
        t.rule("v", "when true then 9", batch=2, part="p='b'", aside="p='b_old'"),
        t.rule("v", "when w > 0 then w", batch=3, part="p='b'", source=lookup),
        t.rule("p", "when v = 9 then 'c'", batch=4, part="p='b'", aside="p='b_old'"),
        t.rule("v", "when true then 0", batch=5, part="p='c'", aside="p='c_old'"),
    ]
    before = t.rows()
    shown = update.dry_run(t.spark, t.rules(*rows)).collect()
    assert {s.batch_number: s.row_count for s in shown} == {1: 2, 2: 3, 3: 3, 4: 3, 5: 4}
    assert t.rows() == before
