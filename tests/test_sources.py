import datetime as dt
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from millrace.errors import UnknownTypeError
from millrace.plans import audit
from millrace.plans.load import create_rejects_table, load_listed_files
from millrace.sources import catalog, csv
from millrace.sources.indirect import read_listed
from millrace.sources.schema import schema_of, type_named


def test_types_are_matched_without_case_and_fall_back():
    assert type_named("STRING") == T.StringType()
    assert type_named("Timestamp") == T.TimestampType()
    for unknown in ["double", "int", "bigint", "decimal(3,1)", "strng"]:
        assert type_named(unknown) == T.StringType()
        with pytest.raises(UnknownTypeError):
            type_named(unknown, strict=True)
    schema = schema_of([("a", "Long"), ("b", "boolean")])
    assert schema == T.StructType(
        [T.StructField("a", T.LongType(), True), T.StructField("b", T.BooleanType(), True)]
    )


def test_typed_csv_is_permissive(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        "x,y,z\n 1 , text ,2024-01-31 13:05:06\n2\n\n3,,\n4,four,2024-02-01 00:00:00,extra\nbad,b,\n"
    )
    schema = schema_of([("n", "integer"), ("s", "string"), ("t", "timestamp")])
    rows = [tuple(r) for r in csv.read_typed_csv(spark, str(path), schema).collect()]
    assert rows == [
        (1, "text", dt.datetime(2024, 1, 31, 13, 5, 6)),
        (2, None, None),
        (3, None, None),
        (4, "four", dt.datetime(2024, 2, 1)),
        (None, "b", None),
    ]


def test_bulk_csv_keeps_codes_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,name\n0012,x\n")
    assert csv.read_bulk_csv(spark, str(tmp_path)).first() == ("0012", "x")
    assert csv.read_bulk_csv(spark, str(tmp_path), infer=True).first() == (12, "x")


def test_suffix_filter(spark, tmp_path):
    path = tmp_path / "list"
    path.write_text(" a.xls \nb.xml\nc.csv\naxls\nd.XLS\n\n")
    names = csv.with_suffixes(csv.read_file_list(spark, str(path)))
    assert sorted(r.filename for r in names.collect()) == ["a.xls", "axls", "b.xml"]


SPEC = [("a", "integer"), ("b", "string")]


@pytest.fixture
def files(tmp_path):
    base = tmp_path / "in put"
    (base / "sub").mkdir(parents=True)
    names = ["a.csv", "b c.csv", "p+q.csv", "hundred%20.csv", "sub/é.csv", "empty.csv"]
    for i, name in enumerate(names[:-1]):
        (base / name).write_text(f"a,b\n{i},{name}\n{i + 10},\n")
    (base / "empty.csv").write_text("a,b\n")
    (base / "unlisted.csv").write_text("a,b\n99,no\n")
    return base, names


def listing(base: Path, names: list[str]) -> str:
    path = base.parent / "list.txt"
    path.write_text("".join(n + "\n" for n in names))
    return str(path)


def test_listed_files_with_lineage(spark, files):
    base, names = files
    listed = listing(base, [*names, names[1]])
    out = read_listed(spark, listed, str(base), schema_of(SPEC))
    got = sorted((r.a, r.file_name) for r in out.collect())
    want = [(i, n) for i, n in enumerate(names[:-1])] + [
        (i + 10, n) for i, n in enumerate(names[:-1])
    ]
    want += [(1, names[1]), (11, names[1])]
    assert got == sorted(want)
    assert out.columns == ["a", "b", "file_name"]


def test_base_may_be_a_uri(spark, files):
    base, names = files
    out = read_listed(spark, listing(base, names[:2]), f"file://{base}/", schema_of(SPEC))
    assert {r.file_name for r in out.collect()} == set(names[:2])


@pytest.mark.parametrize("spelling", ["{b}", "{b}/", "file:{b}", "{p}//{n}", "{p}/./{n}"])
def test_names_are_literal_and_lineage_is_true(spark, files, spelling):
    base, _ = files
    odd = ["a[1].csv", "*.csv", "x{a,b}.csv", "q?.csv", "back\\slash.csv"]
    for name in [*odd, "a1.csv", "xa.csv", "q1.csv"]:
        (base / name).write_text(f'a,b\n1,"{name}"\n')
    listed = base.parent / "odd.txt"
    listed.write_text("".join(f'"{n}"\n' for n in odd if "\\" not in n) + "back\\slash.csv\n")
    root = spelling.format(b=base, p=base.parent, n=base.name)
    out = read_listed(spark, str(listed), root, schema_of(SPEC)).collect()
    assert sorted(r.file_name for r in out) == sorted(odd)


def test_empty_list(spark, files):
    base, _ = files
    out = read_listed(spark, listing(base, []), str(base), schema_of(SPEC))
    assert out.columns == ["a", "b", "file_name"] and out.count() == 0


def test_load_is_all_or_nothing_and_audited(spark, work, files):
    base, names = files
    target, trail = work.table("flat"), work.table("audit")
    spark.sql(f"CREATE TABLE {target} (x int, y string, origin string) USING parquet")
    audit.create_audit_table(spark, trail)
    load_listed_files(
        spark, listing(base, names), str(base), target, spec=SPEC, audit_table=trail
    )
    assert spark.table(target).count() == 10
    with pytest.raises(AnalysisException):
        load_listed_files(
            spark,
            listing(base, [names[0], "absent.csv"]),
            str(base),
            target,
            spec=SPEC,
            audit_table=trail,
        )
    assert spark.table(target).count() == 10
    trail_rows = spark.table(trail).collect()
    assert sorted(r.refresh_status for r in trail_rows) == ["FAILED", "SUCCESS"]
    failed = next(r for r in trail_rows if r.refresh_status == "FAILED")
    assert "absent.csv" in failed.message
    assert failed.batch_number == spark.sparkContext.applicationId


def test_partition_scan_prunes(spark, work):
    table = work.table("t")
    spark.range(10).selectExpr("id", "id % 2 as p").write.partitionBy("p").saveAsTable(table)
    one = catalog.read_partition(spark, table, "p=1")
    assert one.count() == 5
    assert "PartitionFilters: [isnotnull(p" in plan_of(one)


def test_sql_batches_keep_order(spark):
    frames = catalog.frames_of(spark, ["select 2 as x", "select 1 as x"])
    assert [f.first().x for f in frames] == [2, 1]
    named = catalog.named_frames_of(spark, {"b": "select 2 as x", "a": "select 1 as x"})
    assert list(named) == ["b", "a"]


def test_rejected_lines_keep_text_and_cause(spark, tmp_path):
    lines = [
        "n,d,s", "1,2024-01-02,a", "x1,2024-01-02,b", " 2 , , c ", "3,yesterday,c,4,5", "4", '5,2024-02-30,"q,r"',
        "", '6,,"a""b"', "99999999999,2024-01-02,z", '7,,"x,y",', ",,,w", ",,",
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    schema = schema_of([("n", "integer"), ("d", "date"), ("s", "string")])
    found = csv.read_checked_csv(spark, str(tmp_path / "a.csv"), schema).collect()
    assert len(found) == 11  # all but the header and the blank line
    good = [(r.n, str(r.d) if r.d else None, r.s) for r in found if r.rejected is None]
    assert sorted(good, key=str) == sorted(
        [(1, "2024-01-02", "a"), (2, None, "c"), (4, None, None), (6, None, '"a""b"'), (7, None, "x,y"), (None, None, None)], key=str
    )
    assert {r.rejected.line: r.rejected.cause for r in found if r.rejected} == {
        lines[2]: "n is not of type int",
        lines[4]: "d is not of type date; more than 3 fields",
        lines[6]: "d is not of type date",
        lines[9]: "n is not of type int",
        lines[11]: "more than 3 fields",
    }


def test_load_with_rejects_counts_every_line(spark, work, files):
    base, names = files
    Path(base, names[0]).write_text("x,y\n1,a\nno,b\n2,c,d\n")
    target, rejects, trail = (work.table(n) for n in ("flat", "rejects", "audit"))
    spark.sql(f"CREATE TABLE {target} (x int, y string, origin string) USING parquet")
    create_rejects_table(spark, rejects)
    audit.create_audit_table(spark, trail)
    spec = [("x", "integer"), ("y", "string")]
    load_listed_files(spark, listing(base, [names[0]] * 2), str(base), target, spec=spec, rejects=rejects, audit_table=trail)
    assert [tuple(r) for r in spark.table(target).collect()] == [(1, "a", names[0])] * 2
    found = sorted((r.file_name, r.line, r.cause) for r in spark.table(rejects).collect())
    assert found == [(names[0], "2,c,d", "more than 2 fields")] * 2 + [(names[0], "no,b", "x is not of type int")] * 2
    assert "2 rows, 4 rejected" in spark.table(trail).first().message
    load_listed_files(spark, listing(base, []), str(base), target, spec=spec, rejects=rejects)
    assert spark.table(target).count() == 2
