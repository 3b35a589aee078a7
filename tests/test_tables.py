from pathlib import Path

import pytest
from conftest import fail_in_a_task
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.errors import SchemaMismatchError, WrongPartitionError
from millrace.operators import tables
from millrace.operators.tables import PartitionSpec


def values(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


@pytest.fixture
def parted(spark, work):
    table = work.table("parted")
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x int, p string").write.partitionBy(
        "p"
    ).saveAsTable(table)
    return table


def pair(spark, work):
    table = work.table("t")
    spark.createDataFrame([(1,)], "x int").write.saveAsTable(table)
    spark.createDataFrame([(2,)], "x int").write.saveAsTable(table + "_temp")
    return table


def test_partition_spec():
    assert PartitionSpec.parse(" `p` = 'it is' ") == PartitionSpec("p", "it is")
    assert PartitionSpec.parse("p=5") == PartitionSpec("p", "5")
    assert PartitionSpec("p", "o'x\\").sql == "`p`='o\\'x\\\\'"


def test_swap_twice_restores(spark, work):
    table = pair(spark, work)
    tables.swap_tables(spark, table)
    assert (values(spark, table), values(spark, table + "_temp")) == ([(2,)], [(1,)])
    tables.swap_tables(spark, table)
    assert (values(spark, table), values(spark, table + "_temp")) == ([(1,)], [(2,)])


def test_failed_swap_is_undone(spark, work):
    table = pair(spark, work)
    tables.drop_table(spark, table + "_temp")
    with pytest.raises(AnalysisException):
        tables.swap_tables(spark, table)
    assert values(spark, table) == [(1,)]
    assert not spark.catalog.tableExists(table + "_temp2")


def test_refresh_may_read_table_and_backup(spark, work):
    table = pair(spark, work)
    both = spark.table(table).unionAll(spark.table(table + "_temp"))
    tables.refresh_by_swap(spark, table, both)
    assert values(spark, table) == [(1,), (2,)]
    assert values(spark, table + "_temp") == [(1,)]
    assert {t.name for t in spark.catalog.listTables(work.database)} == {"t", "t_temp"}


def test_refresh_without_backup_and_failed_refresh(spark, work):
    table = work.table("t")
    spark.createDataFrame([(1,)], "x int").write.saveAsTable(table)
    failing = spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        tables.refresh_by_swap(spark, table, failing)
    assert values(spark, table) == [(1,)]
    assert len(spark.catalog.listTables(work.database)) == 1
    with pytest.raises(SchemaMismatchError):
        tables.refresh_by_swap(spark, table, spark.range(1))
    tables.refresh_by_swap(spark, table, spark.createDataFrame([(5,)], "other int"))
    assert (values(spark, table), values(spark, table + "_temp")) == ([(5,)], [(1,)])


FORMATS = pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])


def table_of(spark, work, fmt):
    table = work.table(f"as_{fmt}")
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x int, p string")
    rows.write.format(fmt).partitionBy("p").saveAsTable(table)
    return table


@FORMATS
@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrite_touches_one_partition(spark, work, mode, fmt):
    table = table_of(spark, work, fmt)
    with tables.session_setting(spark, tables.OVERWRITE_MODE, mode):
        for _ in range(2):
            rows = spark.table(table).where("p = 'a'").selectExpr("x * 10L as y")
            tables.overwrite_partition(spark, table, rows, PartitionSpec("p", "a"))
        tables.overwrite_partition(
            spark, table, spark.createDataFrame([(7,)], "y int"), PartitionSpec("P", "c")
        )
        tables.overwrite_partition(spark, table, spark.range(0), PartitionSpec("p", "b"))
        assert spark.conf.get(tables.OVERWRITE_MODE) == mode
    assert values(spark, table) == [(7, "c"), (100, "a"), (200, "a")]
    assert [t.name for t in spark.catalog.listTables(work.database)] == [table.split(".")[1]]


@FORMATS
@pytest.mark.parametrize("source", ["other", "itself"])
def test_failed_overwrite_leaves_the_old_rows(spark, work, fmt, source):
    """Failures inside a task: a value that does not fit, and an error in the rows."""
    table = table_of(spark, work, fmt)
    before = values(spark, table)
    rows = spark.table(table).where("p = 'a'") if source == "itself" else spark.range(1, 9).toDF("x")
    for new in ("x + 3000000000L", "if(x = 2, raise_error('no'), x)"):
        with pytest.raises(Exception, match="CAST_OVERFLOW|no"):
            tables.overwrite_partition(spark, table, rows.selectExpr(f"{new} as x"), PartitionSpec("p", "a"))
        assert values(spark, table) == before
        assert len(spark.catalog.listTables(work.database)) == 1
    rewritten = Path(tables.table_location(spark, table).removeprefix("file:")) / tables.REWRITTEN
    assert not rewritten.exists() or list(rewritten.iterdir()) == []


def test_a_failing_last_write_leaves_the_old_rows(spark, work, monkeypatch):
    table = table_of(spark, work, "json")
    fail_in_a_task(monkeypatch, "INSERT OVERWRITE")
    with pytest.raises(Exception, match="lost task"):
        tables.overwrite_partition(spark, table, spark.range(5, 7), PartitionSpec("p", "a"))
    monkeypatch.undo()
    assert values(spark, table) == [(1, "a"), (2, "a"), (3, "b")]
    assert len(spark.catalog.listTables(work.database)) == 1


def test_overwrite_writes_with_the_tables_options(spark, work):
    table = work.table("lines")
    spark.sql(f"CREATE TABLE {table} (x int, s string, p string) USING csv OPTIONS (sep '|', header 'true') PARTITIONED BY (p)")
    spark.sql(f"INSERT INTO {table} VALUES (1, 'a,b', 'q')")
    rows = spark.createDataFrame([(2, "c|d"), (3, None)], "x int, s string")
    tables.overwrite_partition(spark, table, rows, PartitionSpec("p", "q"))
    assert values(spark, table) == [(2, "c|d", "q"), (3, None, "q")]
    place = tables.partition_location(spark, table, PartitionSpec("p", "q")).removeprefix("file:")
    assert any(f.read_text().startswith("x|s\n") for f in Path(place).glob("*.csv"))


@pytest.fixture
def months(spark, work):
    table = work.table("months")
    rows = [(1, "2023", "12"), (2, "2024", "01"), (3, "2024", "02")]
    spark.createDataFrame(rows, "x int, y string, m string").write.partitionBy("y", "m").saveAsTable(table)
    return table


def test_overwrite_one_of_several_levels(spark, months):
    spec = PartitionSpec.parse("m='02', y='2024'")
    for _ in range(2):
        tables.overwrite_partition(spark, months, spark.range(7, 9), spec)
    assert values(spark, months) == [(1, "2023", "12"), (2, "2024", "01"), (7, "2024", "02"), (8, "2024", "02")]
    tables.overwrite_partition(spark, months, spark.range(1), PartitionSpec.parse("y=2025, m=1"))
    tables.overwrite_partition(spark, months, spark.range(0), spec)
    assert values(spark, months) == [(0, "2025", "1"), (1, "2023", "12"), (2, "2024", "01")]


def test_overwrite_all_below_the_first_level(spark, months):
    rows = spark.table(months).where("y = '2024'").selectExpr("x * 10 as x", "if(x = 2, '01', '03') as m")
    for factor in (10, 100):
        tables.overwrite_partition(spark, months, rows, PartitionSpec("y", "2024"))
        assert values(spark, months)[0] == (1, "2023", "12")
        assert sorted(r.x for r in spark.table(months).where("y = '2024'").collect()) == [2 * factor, 3 * factor]
    names = [r.partition for r in spark.sql(f"SHOW PARTITIONS {months}").collect()]
    assert names == ["y=2023/m=12", "y=2024/m=03"]
    failing = spark.range(1).selectExpr("cast(raise_error('no') as int) as x", "'05' as m")
    with pytest.raises(Exception, match="no"):
        tables.overwrite_partition(spark, months, failing, PartitionSpec("y", "2024"))
    assert len(values(spark, months)) == 3
    with pytest.raises(WrongPartitionError):
        tables.overwrite_partition(spark, months, rows, PartitionSpec("m", "01"))


def test_rename_and_drop_all_below_the_first_level(spark, months):
    tables.rename_partition(spark, months, PartitionSpec("y", "2024"), PartitionSpec("y", "2024_old"))
    assert values(spark, months) == [(1, "2023", "12"), (2, "2024_old", "01"), (3, "2024_old", "02")]
    with pytest.raises(WrongPartitionError, match="already"):
        tables.rename_partition(spark, months, PartitionSpec("y", "2024_old"), PartitionSpec("y", "2024_old"))
    tables.drop_partition(spark, months, PartitionSpec("y", "2024_old"))
    assert values(spark, months) == [(1, "2023", "12")]
    with pytest.raises(WrongPartitionError):
        tables.drop_partition(spark, months, PartitionSpec("y", "2024_old"))


class Lost(BaseException):
    """The driver dies: no handler runs."""


def lost_at(monkeypatch, starts, number):
    """Die before the statement of this number, from 0, with a given start."""
    from pyspark.sql import SparkSession

    real, left = SparkSession.sql, [number]

    def sql(self, text, *args, **kwargs):
        if text.startswith(starts):
            left[0] -= 1
            if left[0] < 0:
                raise Lost
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(SparkSession, "sql", sql)


@pytest.mark.parametrize("number", range(8))
def test_a_swap_is_finished_after_a_lost_driver(spark, work, monkeypatch, number):
    """Two marks, three renames, two marks taken off."""
    table = pair(spark, work)
    with monkeypatch.context() as broken:
        lost_at(broken, "ALTER TABLE", number)
        if number < 7:
            with pytest.raises(Lost):
                tables.swap_tables(spark, table)
        else:
            tables.swap_tables(spark, table)
    if number < 5:
        tables.swap_tables(spark, table)
    else:
        assert tables.finish_renames(spark, table) is False  # all renames had ended
    assert (values(spark, table), values(spark, table + "_temp")) == ([(2,)], [(1,)])
    tables.swap_tables(spark, table)
    assert (values(spark, table), values(spark, table + "_temp")) == ([(1,)], [(2,)])
    assert {t.name for t in spark.catalog.listTables(work.database)} == {"t", "t_temp"}


@pytest.mark.parametrize("number", range(10))
@pytest.mark.parametrize("backup", [True, False])
def test_a_refresh_is_finished_after_a_lost_driver(spark, work, monkeypatch, number, backup):
    table = pair(spark, work)
    if not backup:
        tables.drop_table(spark, table + "_temp")
    with monkeypatch.context() as broken:
        lost_at(broken, ("ALTER TABLE", "DROP TABLE"), number)
        if number < (10 if backup else 7):
            with pytest.raises(Lost):
                tables.refresh_by_swap(spark, table, spark.createDataFrame([(5,)], "x int"))
        else:
            tables.refresh_by_swap(spark, table, spark.createDataFrame([(5,)], "x int"))
    begun = number >= (3 if backup else 2)
    tables.refresh_by_swap(spark, table, spark.createDataFrame([(6,)], "x int"))
    assert (values(spark, table), values(spark, table + "_temp")) == ([(6,)], [(5,) if begun else (1,)])
    assert {t.name for t in spark.catalog.listTables(work.database)} == {"t", "t_temp"}


def test_other_tables_are_not_taken_for_helpers(spark, work):
    table = pair(spark, work)
    for name in ("t_incoming_notes", "t_template", "t_retired_cafe"):
        spark.range(1).write.saveAsTable(work.table(name))
    tables.refresh_by_swap(spark, table, spark.createDataFrame([(5,)], "x int"))
    assert len(spark.catalog.listTables(work.database)) == 5


def test_overwrite_checks_columns(spark, parted):
    spec = PartitionSpec("p", "a")
    with pytest.raises(SchemaMismatchError):
        tables.overwrite_partition(spark, parted, spark.table(parted), spec)
    with pytest.raises(SchemaMismatchError):
        tables.overwrite_partition(spark, parted, spark.range(1).selectExpr("1", "2"), spec)
    with pytest.raises(WrongPartitionError):
        tables.overwrite_partition(spark, parted, spark.range(1).toDF("p"), PartitionSpec("x", "1"))
    assert len(values(spark, parted)) == 3


@pytest.mark.parametrize(
    "text, value",
    [
        ("p='a'", "a"), (" `p` = 'a b' ", "a b"), ("p=a", "a"), ("p = 2024-01-02", "2024-01-02"),
        ("p=''", ""), (r"p='it\'s \\ here'", "it's \\ here"), ("p='x=1 and y'", "x=1 and y"),
    ],
)
def test_partition_spelling(text, value):
    assert PartitionSpec.parse(text) == PartitionSpec("p", value)


@pytest.mark.parametrize(
    "text", ["p='a' x='1'", "p=a b", "p", "p=", "p='a", "p=a'", "p='a''b'", "p in (1)", "p<=3", "a.p=1", "p='a',", "p='a' or q='b'", "p='a', P='b'", ""]
)
def test_wrong_partition_spelling(text):
    with pytest.raises(WrongPartitionError):
        PartitionSpec.parse(text)


def test_rename_and_drop_partition(spark, parted):
    a, aside = PartitionSpec("p", "a"), PartitionSpec("p", "a_old")
    tables.rename_partition(spark, parted, a, aside)
    assert values(spark, parted) == [(1, "a_old"), (2, "a_old"), (3, "b")]
    assert tables.partition_exists(spark, parted, aside)
    assert not tables.partition_exists(spark, parted, a)
    tables.drop_partition(spark, parted, aside)
    assert values(spark, parted) == [(3, "b")]


def test_stage_truncate_append(spark, work):
    table = work.table("s")
    tables.stage_table(spark.range(100), table, files=3)
    assert len(spark.table(table).inputFiles()) == 3
    tables.truncate_table(spark, table)
    assert spark.table(table).count() == 0
    tables.append_by_position(spark.range(2).withColumnRenamed("id", "any"), table)
    assert spark.table(table).count() == 2


def test_refresh_of_a_partitioned_table(spark, work, parted):
    rows = spark.table(parted).selectExpr("x + 1 as x", "if(x = 1, 'z', p) as p")
    tables.refresh_by_swap(spark, parted, rows)
    assert values(spark, parted) == [(2, "z"), (3, "a"), (4, "b")]
    assert values(spark, parted + "_temp") == [(1, "a"), (2, "a"), (3, "b")]
    spec = PartitionSpec("p", "z")
    tables.overwrite_partition(spark, parted, spark.createDataFrame([(0,)], "x int"), spec)
    assert values(spark, parted) == [(0, "z"), (3, "a"), (4, "b")]


def test_swap_of_partitioned_tables(spark, work, parted):
    rows = [(9, "a/b c"), (8, None), (7, "a")]
    spark.createDataFrame(rows, "x int, p string").write.partitionBy("p").saveAsTable(
        parted + "_temp"
    )
    before = None
    for _ in range(3):
        pair = (spark.table(parted).collect(), spark.table(parted + "_temp").collect())
        now = tuple(sorted(map(tuple, side), key=str) for side in pair)
        if before is not None:
            assert now == (before[1], before[0])
        before = now
        tables.swap_tables(spark, parted)
    assert before[0] == [(1, "a"), (2, "a"), (3, "b")]
    assert before[1] == [(7, "a"), (8, None), (9, "a/b c")]
