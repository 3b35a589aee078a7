"""Indirect flat-file load: append the files a list names, with their names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.operators.tables import append_by_position, stage_table
from millrace.plans.audit import audited
from millrace.session import Workspace
from millrace.sources.indirect import FILE_NAME, read_listed
from millrace.sources.schema import schema_of

# Columns of the manual adjustment files.
ADJUSTMENT_SPEC = [
    ("field1", "String"),
    ("field2", "String"),
    ("metric_adjusted", "String"),
    ("week_no___fw", "String"),
    ("fiscal_year", "string"),
]


def load_listed_files(
    spark: SparkSession,
    list_path: str,
    base: str,
    target: str,
    *,
    spec: Sequence[tuple[str, str]] = ADJUSTMENT_SPEC,
    header: bool = True,
    rejects: str | None = None,
    audit_table: str | None = None,
    job_name: str = "flat_file_load",
) -> None:
    """One append for all files: either every listed file is loaded or none is.

    With a table of ``rejects`` (see :func:`create_rejects_table`) lines that do
    not fit the types go there, with file and cause, and not into the target;
    so the lines of each file are in one of the two. The files are parsed once
    into a stage, which both appends read.
    """
    with audited(spark, job_name, audit_table) as run:
        if rejects is None:
            rows = read_listed(spark, list_path, base, schema_of(spec), header=header)
            append_by_position(rows, target)
            run.message = f"loaded the files of {list_path}"
            return
        with Workspace(spark, "load") as work:
            stage = work.table("lines")
            rows = read_listed(
                spark, list_path, base, schema_of(spec), header=header, checked=True
            )
            stage_table(rows, stage)
            lines = spark.table(stage)
            counts = lines.agg(F.count_if(F.col("rejected").isNull()), F.count("rejected")).first()
            # Rejects first: a run that fails between the two has loaded nothing.
            bad = lines.where("rejected IS NOT NULL")
            if counts[1]:
                application = F.lit(spark.sparkContext.applicationId)
                append_by_position(
                    bad.select(FILE_NAME, "rejected.line", "rejected.cause", application), rejects
                )
            append_by_position(lines.where("rejected IS NULL").drop("rejected"), target)
        run.message = f"loaded the files of {list_path}: {counts[0]:,} rows, {counts[1]:,} rejected"


def create_rejects_table(spark: SparkSession, table: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} "
        "(file_name string, line string, cause string, application_id string) USING parquet"
    )
