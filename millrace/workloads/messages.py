"""Queries over encoded messages, batch and streaming, and key=value tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import codec
from millrace.functions.params import extract_params
from millrace.operators import compact
from millrace.plans import audit
from millrace.plans.publish import publish_csv
from millrace.session import Workspace
from millrace.sources.messages import message_stream, publish_rows
from millrace.streaming import decode
from millrace.streaming.audit import run_audited
from millrace.workloads.data import load, query


@query("""
SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name || ','
       || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') || ','
       || CAST(CAST(c_acctbal AS DECIMAL(15, 2)) AS VARCHAR) AS value
FROM customer
""")
def row_to_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows published as messages, read back as text."""
    work = Workspace(spark, "row_to_message")
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.nullif("c_mktsegment", F.lit("BUILDING")),
        F.col("c_acctbal").cast("decimal(15,2)"),
    )
    publish_rows(rows, {"path": work.path("topic")}, fmt="text")
    return spark.read.text(work.path("topic"))


@query("""
WITH tokens AS (
  SELECT doc_id, text, lang = 'en' AND doc_id % 5 <> 0 AS is_valid FROM documents)
SELECT doc_id, CASE WHEN is_valid THEN text ELSE '(invalid)' END AS text,
       CASE WHEN is_valid THEN text ELSE '(invalid)' END AS text_by_sql, is_valid
FROM tokens
""")
def base64_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded and decoded; other languages' tokens, and some more, are damaged."""
    codec.register_converter(spark)
    token = codec.base64_token(F.col("text"))
    damaged = (
        F.when(F.col("lang") == "de", F.concat(F.lit("#"), token))
        .when(F.col("lang") == "fr", F.concat(token, F.lit("\n")))
        .when(F.col("lang") == "es", F.concat(token, F.lit("\r\n")))
        .when(F.col("doc_id") % 5 == 0, F.concat(token, F.lit(" ")))
        .otherwise(token)
    )
    tokens = load(spark, sf_dir, "documents").select("doc_id", damaged.alias("token"))
    decoded = tokens.select(
        "doc_id",
        codec.base64_text(F.col("token")).alias("text"),
        F.expr("converter(token)").alias("text_by_sql"),
    )
    return decoded.select(
        "doc_id",
        F.coalesce("text", F.lit("(invalid)")).alias("text"),
        F.coalesce("text_by_sql", F.lit("(invalid)")).alias("text_by_sql"),
        F.col("text").isNotNull().alias("is_valid"),
    )


@query("""
WITH messages AS (
  SELECT o_orderkey, to_base64(encode(o_orderstatus)) || ',' || to_base64(encode(o_orderpriority))
         || CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN ',' ELSE ',,' END AS value
  FROM orders),
fields AS (
  SELECT o_orderkey, string_split(value, ',') AS kept,
         string_split(rtrim(value, ','), ',') AS dropped
  FROM messages)
SELECT o_orderkey, CAST(len(kept) AS INTEGER) AS fields_kept,
       CAST(len(dropped) AS INTEGER) AS fields_dropped,
       array_to_string(list_transform(kept, lambda x: decode(from_base64(x))), '|') AS decoded
FROM fields
""")
def message_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with none, one or two trailing empty fields."""
    empties = (
        F.when(F.col("o_orderstatus") == "F", "")
        .when(F.col("o_orderstatus") == "O", ",")
        .otherwise(",,")
    )
    message = F.concat(
        codec.base64_token(F.col("o_orderstatus")),
        F.lit(","),
        codec.base64_token(F.col("o_orderpriority")),
        empties,
    )
    messages = load(spark, sf_dir, "orders").select("o_orderkey", message.alias("value"))
    value = F.col("value")
    return messages.select(
        "o_orderkey",
        F.size(codec.split_fields(value)).alias("fields_kept"),
        F.size(codec.split_fields(value, drop_trailing_empty=True)).alias("fields_dropped"),
        F.array_join(codec.decode_fields(value), "|").alias("decoded"),
    )


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_tokens(type_token: Column) -> list[Column]:
    tokens = {name: codec.base64_token(F.col(name)) for name in EVENT_SCHEMA.names}
    tokens["event_type"] = type_token
    return [token.alias(name) for name, token in tokens.items()]


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of encoded events, published as messages and streamed into a table."""
    work = Workspace(spark, "stream_decode")
    tokens = event_tokens(codec.base64_token(F.col("event_type")))
    load(spark, sf_dir, "events").select(*tokens).write.csv(work.path("file"), header=True)
    publish_csv(spark, work.path("file"), {"path": work.path("topic")}, fmt="text")
    stream = message_stream(spark, {"path": work.path("topic")}, fmt="text")
    table = work.table("events")
    decode.decode_to_table(
        stream, EVENT_SCHEMA, table, work.path("offsets"), trigger=decode.AVAILABLE
    ).awaitTermination()
    return spark.table(table).select(*EVENT_SCHEMA.names)


@query("""
SELECT event_id, event_type,
       to_base64(encode(CAST(event_id AS VARCHAR))) AS first_token
FROM events
""")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type token of error events is damaged: their messages are kept as text.

    Streamed in batches of a few files, which share partitions.
    """
    work = Workspace(spark, "stream_quarantine")
    token = codec.base64_token(F.col("event_type"))
    damaged = F.when(F.col("event_type") == "error", F.lit("err or")).otherwise(token)
    rows = load(spark, sf_dir, "events").select(*event_tokens(damaged)).repartition(5)
    publish_rows(rows, {"path": work.path("topic")}, fmt="text")
    table = work.table("events")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}, quarantined string, batch_id bigint, "
        "batch_range bigint) USING parquet PARTITIONED BY (batch_range)"
    )
    options = {"path": work.path("topic"), "maxFilesPerTrigger": "1"}
    stream = message_stream(spark, options, fmt="text")
    decode.decode_to_batches(
        stream,
        EVENT_SCHEMA,
        table,
        work.path("offsets"),
        trigger=decode.AVAILABLE,
        batches_per_partition=2,
    ).awaitTermination()
    fields = codec.split_fields(F.col("quarantined"))
    event_id = F.coalesce("event_id", codec.base64_text(fields[0]).cast("bigint"))
    kind = F.when(F.col("quarantined").isNull(), F.col("event_type")).otherwise(
        F.when(fields[3] == "err or", "error")
    )
    return spark.table(table).select(
        event_id.alias("event_id"),
        kind.alias("event_type"),
        F.coalesce(fields[0], codec.base64_token(F.col("event_id"))).alias("first_token"),
    )


@query("""
SELECT event_id, event_type, value, ts FROM events
""")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of one small file each; the finished ranges end as one file each."""
    work = Workspace(spark, "stream_merge")
    tokens = event_tokens(codec.base64_token(F.col("event_type")))
    rows = load(spark, sf_dir, "events").select(*tokens).repartition(8)
    publish_rows(rows, {"path": work.path("topic")}, fmt="text")
    table = work.table("events")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}, quarantined string, batch_id bigint, "
        "batch_range bigint) USING parquet PARTITIONED BY (batch_range)"
    )
    stream = message_stream(
        spark, {"path": work.path("topic"), "maxFilesPerTrigger": "1"}, fmt="text"
    )
    decode.decode_to_batches(
        stream,
        EVENT_SCHEMA,
        table,
        work.path("offsets"),
        trigger=decode.AVAILABLE,
        batches_per_partition=4,
    ).awaitTermination()
    merged = compact.merge_finished(spark, table, decode.RANGE_COLUMN)
    if not merged or any(m.files_after != 1 for m in merged):
        raise RuntimeError(f"not merged: {merged}")
    return spark.table(table).select("event_id", "event_type", "value", "ts")


@query("""
SELECT event_id, true AS counted, count(*) OVER () AS read,
       count(*) FILTER (event_type <> 'error') OVER () AS decoded,
       count(*) FILTER (event_type = 'error') OVER () AS quarantined
FROM events
""")
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sinks audited over a restart; each row of the one has its batch's counts."""
    work = Workspace(spark, "stream_audit")
    token = codec.base64_token(F.col("event_type"))
    damaged = F.when(F.col("event_type") == "error", F.lit("err or")).otherwise(token)
    rows = load(spark, sf_dir, "events").select(*event_tokens(damaged)).repartition(4)
    table, sunk, audits = work.table("events"), work.table("sunk"), work.table("audit")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}, quarantined string, batch_id bigint, "
        "batch_range bigint) USING parquet PARTITIONED BY (batch_range)"
    )
    audit.create_audit_table(spark, audits)
    options = {"path": work.path("topic"), "maxFilesPerTrigger": "1"}

    def sink(how, target: str, **more):
        stream = message_stream(spark, options, fmt="text")
        offsets = work.path(f"offsets_{target}")
        return how(stream, EVENT_SCHEMA, target, offsets, trigger=decode.AVAILABLE, **more)

    early = F.unbase64(F.split("value", ",")[0]).cast("string").cast("bigint") % 2 == 0
    messages = codec.rows_to_messages(rows)
    for half in (messages.where(early), messages.where(~early)):
        half.write.mode("append").text(work.path("topic"))
        sink(decode.decode_to_batches, table, audit_table=audits).awaitTermination()
        run_audited(
            spark, lambda: sink(decode.decode_to_table, sunk), sunk, audits, decode.CONSUME_JOB
        )
    known = audit.recorded_counts(spark, audits, decode.CONSUME_JOB, sunk)
    batches = audit.batch_counts(spark, audits, decode.CONSUME_JOB, table)
    each = spark.table(table).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("quarantined").alias("bad")
    )
    agrees = (F.col("n") == F.col("read")) & (F.col("bad") == F.col("quarantined"))
    agrees = agrees & (F.col("n") - F.col("bad") == F.col("decoded"))
    counted = batches.join(each, F.col("batch_number") == F.col("batch_id").cast("string"))
    first = F.split("quarantined", ",")[0]
    event_id = F.coalesce("event_id", codec.base64_text(first).cast("bigint"))
    return (
        spark.table(table)
        .select(event_id.alias("event_id"), "batch_id")
        .join(counted.select("batch_id", agrees.alias("counted")), "batch_id")
        .select("event_id", "counted", *[F.lit(known[c]).cast("bigint").alias(c) for c in known])
    )


@query("""
WITH tokens AS (
  SELECT page_id, pos, tokens[pos] AS token
  FROM (SELECT page_id, string_split(split_part(split_part(url, '#', 1), '?', 2), '&') AS tokens
        FROM pages), range(1, 100) AS r(pos)
  WHERE pos <= len(tokens)),
pairs AS (
  SELECT page_id, pos,
         CASE WHEN strpos(token, '=') > 1 THEN trim(split_part(token, '=', 1)) ELSE token END
           AS key,
         CASE WHEN strpos(token, '=') > 1 THEN trim(substr(token, strpos(token, '=') + 1))
              ELSE token END AS value
  FROM tokens)
SELECT page_id, key, arg_max(value, pos) AS value
FROM pairs WHERE key IN ('page', 'ref') GROUP BY page_id, key
""")
def param_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed parameters of every page address."""
    address = F.split_part("url", F.lit("#"), F.lit(1))
    tokens = F.split(F.split_part(address, F.lit("?"), F.lit(2)), "&")
    return load(spark, sf_dir, "pages").select(
        "page_id", F.explode(extract_params(tokens, ["page", "ref"])).alias("key", "value")
    )
