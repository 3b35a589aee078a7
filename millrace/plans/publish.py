"""Bulk publication of a flat file as messages."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.plans.audit import audited
from millrace.sources.csv import read_bulk_csv
from millrace.sources.messages import publish_rows


def publish_csv(
    spark: SparkSession,
    path: str,
    options: dict[str, str],
    *,
    fmt: str = "kafka",
    infer: bool = False,
    audit_table: str | None = None,
    job_name: str = "message_publish",
) -> None:
    """Send every row of the files as one message.

    Fields pass as text unless ``infer`` is set, so encoded values that look
    like numbers arrive unchanged.
    """
    with audited(spark, job_name, audit_table) as run:
        publish_rows(read_bulk_csv(spark, path, infer=infer), options, fmt=fmt)
        run.message = f"published the rows of {path}"
