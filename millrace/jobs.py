"""Jobs to submit, configured by key=value arguments.

    spark-submit jobs.py update rules=db.update_definitions audit=db.audit
        [ledger=db.ledger] [mode=overwrite|rename|relocate] [files=10]
        [table_name=db.t] [batch_number=3] [displayonly=true [out=/shown]] [fuse=false]
    spark-submit jobs.py load list=/in/Indirect.txt base=/in/CSVFiles target=db.flat_file
        [audit=db.audit] [columns=field1:string,field2:long] [rejects=db.rejects]
    spark-submit jobs.py publish path=/in/visit_details.csv servers=host:port
        [topic=name] [audit=db.audit]
    spark-submit jobs.py consume servers=host:port table=db.visits checkpoint=/ck/visits
        columns=visit_id:long,name:string [topic=name] [audit=db.audit]
        [sink=table|batches] [trigger="2 seconds"|available] [rate=100000]
        [min_partitions=64] [batches_per_partition=1000]
    spark-submit jobs.py merge table=db.visits [bytes=134217728] [audit=db.audit]
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import compact
from millrace.plans import load, publish, update
from millrace.plans.audit import audited
from millrace.session import build_session
from millrace.sources.messages import (
    TOPIC,
    kafka_sink_options,
    kafka_source_options,
    message_stream,
)
from millrace.sources.schema import schema_of
from millrace.streaming.audit import run_audited
from millrace.streaming.decode import (
    CONSUME_JOB,
    POLL_INTERVAL,
    RANGE_COLUMN,
    decode_to_batches,
    decode_to_table,
)


def options_of(arguments: list[str]) -> dict[str, str]:
    pairs = (a.split("=", 1) for a in arguments if "=" in a)
    return {key.strip().lower(): value.strip() for key, value in pairs}


def columns_of(text: str) -> list[tuple[str, str]]:
    """``name:type,name:type``; a column without a type is a string."""
    names = (part.partition(":") for part in text.split(","))
    return [(name.strip(), kind.strip() or "string") for name, _, kind in names]


def only(options: dict[str, str]) -> Column | None:
    """Restriction of the work list to one table, one batch, or both."""
    chosen = None
    if "table_name" in options:
        chosen = F.col("table_name") == options["table_name"]
    if "batch_number" in options:
        batch = F.col("batch_number").cast("bigint") == int(options["batch_number"])
        chosen = batch if chosen is None else chosen & batch
    return chosen


def run_update(spark: SparkSession, options: dict[str, str]) -> None:
    rules = spark.table(options["rules"])
    how = {
        "mode": options.get("mode"),
        "files": int(options["files"]) if "files" in options else None,
        "ledger": options.get("ledger"),
        "audit_table": options.get("audit"),
        "only": only(options),
        "fuse": options.get("fuse", "").lower() != "false",
    }
    if options.get("displayonly", "").lower() != "true":
        update.run_updates(spark, rules, **how)
        return
    shown = update.dry_run(spark, rules, **how)
    if "out" in options:
        shown.write.json(options["out"])
        return
    for row in shown.toLocalIterator():
        print(*[f"{name}={value}" for name, value in row.asDict().items()], sep="  ")


def run_load(spark: SparkSession, options: dict[str, str]) -> None:
    spec = columns_of(options["columns"]) if "columns" in options else load.ADJUSTMENT_SPEC
    load.load_listed_files(
        spark,
        options["list"],
        options["base"],
        options["target"],
        spec=spec,
        rejects=options.get("rejects"),
        audit_table=options.get("audit"),
    )


def run_publish(spark: SparkSession, options: dict[str, str]) -> None:
    sink = kafka_sink_options(options["servers"], options.get("topic", TOPIC))
    publish.publish_csv(spark, options["path"], sink, audit_table=options.get("audit"))


# What the source calls the options that bound and spread a batch.
RATE_OPTIONS = {"rate": "maxOffsetsPerTrigger", "min_partitions": "minPartitions"}


def run_consume(spark: SparkSession, options: dict[str, str], *, fmt: str = "kafka") -> None:
    """Runs until it is stopped, or until the backlog is done with ``trigger=available``.

    With an audit table every batch has a row in it, and the whole run one.
    """
    if fmt == "kafka":
        bounds = {name: options[key] for key, name in RATE_OPTIONS.items() if key in options}
        source = kafka_source_options(options["servers"], options.get("topic", TOPIC), **bounds)
    else:
        source = {"path": options["path"]}
    how = {"trigger": options.get("trigger", POLL_INTERVAL)}
    sink = options.get("sink", "table")
    if sink not in SINKS:
        raise SystemExit(f"unknown sink: {sink}")
    if sink == "batches" and "batches_per_partition" in options:
        how["batches_per_partition"] = int(options["batches_per_partition"])
    table, audit_table = options["table"], options.get("audit")
    if sink == "batches":
        how["audit_table"] = audit_table

    def start() -> StreamingQuery:
        return SINKS[sink](
            message_stream(spark, source, fmt=fmt),
            schema_of(columns_of(options["columns"]), strict=True),
            table,
            options["checkpoint"],
            **how,
        )

    with audited(spark, CONSUME_JOB, audit_table):
        if sink == "table" and audit_table is not None:
            run_audited(spark, start, table, audit_table, CONSUME_JOB)
        else:
            start().awaitTermination()


SINKS = {"table": decode_to_table, "batches": decode_to_batches}


def run_merge(spark: SparkSession, options: dict[str, str]) -> None:
    """Merges the files of the ranges that ``consume`` with the sink ``batches`` has done with."""
    target = int(options.get("bytes", compact.TARGET_BYTES))
    with audited(spark, "file_merge", options.get("audit")) as run:
        found = compact.merge_finished(spark, options["table"], RANGE_COLUMN, target)
        before, after = sum(m.files_before for m in found), sum(m.files_after for m in found)
        run.message = f"{len(found)} partitions: {before:,} files before, {after:,} after"


JOBS = {
    "merge": run_merge,
    "update": run_update,
    "load": run_load,
    "publish": run_publish,
    "consume": run_consume,
}


def main(arguments: list[str]) -> None:
    if not arguments or arguments[0] not in JOBS:
        raise SystemExit(__doc__)
    name, *rest = arguments
    spark = build_session(name, dynamic_partitions=name == "update", hive=True)
    try:
        JOBS[name](spark, options_of(rest))
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
