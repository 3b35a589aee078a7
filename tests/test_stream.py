from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import codec
from millrace.operators import compact, tables
from millrace.plans import audit
from millrace.sources.messages import kafka_sink_options, kafka_source_options, message_stream
from millrace.streaming import decode
from millrace.streaming import audit as stream_audit

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def publish(spark, path, start, end):
    rows = spark.range(start, end).select(
        codec.base64_token(F.col("id")), codec.base64_token(F.concat(F.lit("s"), "id"))
    )
    codec.rows_to_messages(rows).write.mode("append").text(path)


def stream(spark, work, table, sink):
    messages = message_stream(spark, {"path": work.path("in")}, fmt="text")
    query = sink(messages, SCHEMA, table, work.path("offsets"), trigger=decode.AVAILABLE)
    query.awaitTermination()
    return query


def make_batch_table(spark, table):
    spark.sql(
        f"CREATE TABLE {table} (n bigint, s string, quarantined string, batch_id bigint, "
        "batch_range bigint) USING parquet PARTITIONED BY (batch_range)"
    )


@pytest.mark.parametrize("sink", [decode.decode_to_table, decode.decode_to_batches])
def test_restart_adds_only_what_is_new(spark, work, sink):
    table = work.table("out")
    if sink is decode.decode_to_batches:
        make_batch_table(spark, table)
    publish(spark, work.path("in"), 0, 1000)
    for _ in range(2):
        stream(spark, work, table, sink)
        assert spark.table(table).count() == 1000
    publish(spark, work.path("in"), 1000, 1500)
    spark.createDataFrame([("damaged#",)], "value string").write.mode("append").text(
        work.path("in")
    )
    stream(spark, work, table, sink)
    out = spark.table(table)
    assert out.where("quarantined is null and s = concat('s', n)").count() == 1500
    assert [r.quarantined for r in out.where("quarantined is not null").collect()] == ["damaged#"]
    assert out.select("n").distinct().count() == 1501


def test_replayed_batch_changes_nothing(spark, work):
    """A batch written a second time under its number, as after a crash."""
    table = work.table("out")
    make_batch_table(spark, table)
    publish(spark, work.path("in"), 0, 10)
    stream(spark, work, table, decode.decode_to_batches)
    first = sorted(spark.table(table).collect())
    # Rows of another batch in the same partition stay as they are.
    spark.sql(f"INSERT INTO {table} VALUES (99, 's99', null, 7, 0)")
    other = work.path("fresh_offsets")
    messages = message_stream(spark, {"path": work.path("in")}, fmt="text")
    decode.decode_to_batches(
        messages, SCHEMA, table, other, trigger=decode.AVAILABLE
    ).awaitTermination()
    spark.catalog.refreshTable(table)
    assert sorted(spark.table(table).where("batch_id <> 7").collect()) == first
    assert spark.table(table).where("batch_id = 7").count() == 1


def test_many_batches_share_a_partition(spark, work):
    table = work.table("out")
    make_batch_table(spark, table)
    for start in range(7):
        publish(spark, work.path(f"in/{start}"), start, start + 1)
    options = {"path": work.path("in/*"), "maxFilesPerTrigger": "1"}
    decode.decode_to_batches(
        message_stream(spark, options, fmt="text"), SCHEMA, table, work.path("offsets"),
        trigger=decode.AVAILABLE, batches_per_partition=4,
    ).awaitTermination()
    spark.catalog.refreshTable(table)
    rows = spark.table(table).collect()
    assert sorted(r.n for r in rows) == list(range(7))
    assert all(r.batch_range == r.batch_id // 4 for r in rows)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() < len({r.batch_id for r in rows})


def many_files(spark, work, table, batches=12):
    make_batch_table(spark, table)
    for n in range(batches):
        spark.sql(f"INSERT INTO {table} VALUES ({n}, 's{n}', null, {n}, {n // 4})")


def files_of(spark, table):
    spark.catalog.refreshTable(table)
    found = spark.table(table).selectExpr("batch_range r", "_metadata.file_path f").distinct()
    return {r.r: r["count"] for r in found.groupBy("r").count().collect()}


def test_finished_ranges_are_merged(spark, work):
    table = work.table("out")
    many_files(spark, work, table)
    before = sorted(spark.table(table).collect())
    assert files_of(spark, table) == {0: 4, 1: 4, 2: 4}
    found = compact.merge_finished(spark, table, decode.RANGE_COLUMN)
    assert [(m.files_before, m.files_after) for m in found] == [(4, 1), (4, 1)]
    assert files_of(spark, table) == {0: 1, 1: 1, 2: 4}
    assert sorted(spark.table(table).collect()) == before
    again = compact.merge_finished(spark, table, decode.RANGE_COLUMN)
    assert {m.left_because for m in again} == {"few files"}
    assert {t.name for t in spark.catalog.listTables(work.database)} == {"out"}


def test_files_are_merged_to_a_size(spark, work):
    table = work.table("out")
    rows = spark.range(40_000, numPartitions=40).selectExpr("id", "sha2(cast(id as string), 256) s", "0 as r")
    rows.write.partitionBy("r").saveAsTable(table)
    size = compact.manifest.list_files(spark, tables.partition_location(spark, table, tables.PartitionSpec("r", "0"))).selectExpr("sum(length)").first()[0]
    found = compact.merge_files(spark, table, tables.PartitionSpec("r", "0"), size // 4)
    assert found.files_before == 40 and 4 <= found.files_after <= 6
    assert spark.table(table).distinct().count() == 40_000


@pytest.mark.parametrize("when", ["INSERT OVERWRITE", "ALTER TABLE {t} PARTITION (`batch_range`='0') SET LOCATION"])
def test_a_batch_that_comes_meanwhile_is_kept(spark, work, monkeypatch, when):
    table = work.table("out")
    many_files(spark, work, table)
    place = tables.partition_location(spark, table, tables.PartitionSpec("batch_range", "0"))
    real, left = type(spark).sql, [1]

    def sql(self, text, *args, **kwargs):
        if text.startswith(when.format(t=table)) and left[0]:
            left[0] = 0
            row = self.createDataFrame([(77, "late", None, 3)], "n long, s string, quarantined string, batch_id long")
            row.write.mode("append").parquet(place)
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    found = compact.merge_finished(spark, table, decode.RANGE_COLUMN)
    monkeypatch.undo()
    assert found[0].left_because == "changed meanwhile" and found[1].files_after == 1
    assert files_of(spark, table)[0] == 5
    assert sorted(r.n for r in spark.table(table).collect()) == [*range(12), 77]
    assert compact.merge_finished(spark, table, decode.RANGE_COLUMN)[0].files_after == 1
    spark.catalog.refreshTable(table)
    assert sorted(r.n for r in spark.table(table).collect()) == [*range(12), 77]


def totals(spark, table):
    spark.catalog.refreshTable(table)
    return spark.table(table).agg(*stream_audit.counts()).first().asDict()


def add(spark, work, start, end, bad=0):
    publish(spark, work.path("in"), start, end)
    if bad:
        spark.createDataFrame([("damaged#",)] * bad, "value string").write.mode("append").text(work.path("in"))


def to_batches(spark, work, table, audits):
    options = {"path": work.path("in"), "maxFilesPerTrigger": "2"}
    return decode.decode_to_batches(
        message_stream(spark, options, fmt="text"), SCHEMA, table, work.path("offsets"),
        trigger=decode.AVAILABLE, audit_table=audits,
    )


def test_batches_are_audited_once_each(spark, work, monkeypatch):
    """Over restarts, a driver lost before the audit row, and one lost after it."""
    table, audits = work.table("out"), work.table("audit")
    make_batch_table(spark, table)
    audit.create_audit_table(spark, audits)

    def known():
        return audit.recorded_counts(spark, audits, decode.CONSUME_JOB, table)

    add(spark, work, 0, 100, bad=3)
    to_batches(spark, work, table, audits).awaitTermination()
    assert known() == totals(spark, table) == {"read": 103, "decoded": 100, "quarantined": 3}
    to_batches(spark, work, table, audits).awaitTermination()
    assert known()["read"] == 103

    add(spark, work, 100, 150, bad=1)
    def lost(*args):
        raise RuntimeError("lost")
    monkeypatch.setattr(audit, "record_batch", lost)
    with pytest.raises(Exception, match="lost"):
        to_batches(spark, work, table, audits).awaitTermination()
    monkeypatch.undo()
    assert known()["read"] == 103
    to_batches(spark, work, table, audits).awaitTermination()
    assert known() == totals(spark, table) == {"read": 154, "decoded": 150, "quarantined": 4}

    commits = Path(work.path("offsets"), "commits")
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    for file in (f"{last}", f".{last}.crc"):
        (commits / file).unlink(missing_ok=True)
    to_batches(spark, work, table, audits).awaitTermination()
    assert known() == totals(spark, table) == {"read": 154, "decoded": 150, "quarantined": 4}
    rows = audit.batch_counts(spark, audits, decode.CONSUME_JOB, table)
    assert rows.count() == rows.select("batch_number").distinct().count()
    row = spark.table(audits).where("refresh_mode = 'STREAM'").first()
    assert row.source_tbl_name == "message_consume" and row.des_tbl_name == table
    assert row.message.startswith(f"read={row.refresh_rec_count} ")


def test_the_audit_of_a_table_is_settled(spark, work):
    """Batches are reported one by one; what no report told is recorded by the next run."""
    table, audits = work.table("out"), work.table("audit")
    audit.create_audit_table(spark, audits)
    options = {"path": work.path("in"), "maxFilesPerTrigger": "2"}

    def start():
        messages = message_stream(spark, options, fmt="text")
        return decode.decode_to_table(
            messages, SCHEMA, table, work.path("offsets"), trigger=decode.AVAILABLE
        )

    def run():
        stream_audit.run_audited(spark, start, table, audits, "job")
        assert audit.recorded_counts(spark, audits, "job", table) == totals(spark, table)
        return {r.batch_number: r.read for r in audit.batch_counts(spark, audits, "job", table).collect()}

    add(spark, work, 0, 100, bad=3)
    first = run()
    assert sum(first.values()) == 103 and audit.SETTLED not in first and len(first) > 1
    assert run() == first
    add(spark, work, 100, 150)
    start().awaitTermination()
    assert run() == {**first, audit.SETTLED: 50}


def test_decoding_needs_no_shuffle(spark, work):
    publish(spark, work.path("in"), 0, 10)
    plan = plan_of(codec.decode_records(spark.read.text(work.path("in")), SCHEMA))
    assert "Exchange" not in plan and "Python" not in plan


def test_kafka_options():
    assert kafka_source_options("h:1", minPartitions="8") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "Banking_Encrypted",
        "startingOffsets": "earliest",
        "minPartitions": "8",
    }
    assert kafka_sink_options("h:1", "x") == {"kafka.bootstrap.servers": "h:1", "topic": "x"}
