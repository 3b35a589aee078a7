"""Message endpoints: Kafka in production, any file format elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.codec import rows_to_messages

# Fixed value: the topic both ends of the pipeline agree on.
TOPIC = "Banking_Encrypted"


def kafka_source_options(servers: str, topic: str = TOPIC, **extra: str) -> dict[str, str]:
    """Options of a streaming read; offsets live in the query's checkpoint.

    ``maxOffsetsPerTrigger`` bounds a batch after a backlog and ``minPartitions``
    splits topic partitions that hold most of the records over several tasks.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **extra,
    }


def kafka_sink_options(servers: str, topic: str = TOPIC, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **extra}


def publish_rows(
    rows: DataFrame, options: dict[str, str], *, fmt: str = "kafka", mode: str = "append"
) -> None:
    """Send every row as one keyless message, written by the executors in parallel."""
    rows_to_messages(rows).write.format(fmt).options(**options).mode(mode).save()


def message_stream(
    spark: SparkSession, options: dict[str, str], *, fmt: str = "kafka"
) -> DataFrame:
    """Streaming DataFrame with the text column ``value``.

    A file source needs a folder in ``path``; ``text`` files already carry the
    column ``value``.
    """
    stream = spark.readStream.format(fmt).options(**options).load()
    return stream.select(stream["value"].cast("string").alias("value"))
