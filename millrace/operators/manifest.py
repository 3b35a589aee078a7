"""Which files a partition consisted of, to tell later what other writers did to it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "name string, length bigint, modified timestamp"


@dataclass(frozen=True)
class Changes:
    """Files that came since a folder was noted, and how many noted ones are gone or differ."""

    late: tuple[str, ...]
    gone: int

    def __bool__(self) -> bool:
        return bool(self.late or self.gone)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name, length and time of each file; the files are listed, not read."""
    try:
        found = spark.read.format("binaryFile").load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    return found.select(
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def note_files(spark: SparkSession, folder: str, noted: str, mode: str = "overwrite") -> None:
    """Write the list of a folder's files to another folder."""
    list_files(spark, folder).write.mode(mode).parquet(noted)


def changes(spark: SparkSession, folder: str, noted: str) -> Changes:
    """What has happened to the folder since its files were noted.

    The lists are compared in Spark; names of late files come to the driver,
    which are those written between two steps of a job.
    """
    now = list_files(spark, folder).withColumn("held", F.lit(True))
    then = spark.read.schema(FILES).parquet(noted).withColumn("held", F.lit(False))
    same = (F.min("length") == F.max("length")) & (F.min("modified") == F.max("modified"))
    files = now.unionAll(then).groupBy("name").agg(
        F.bool_or("held").alias("is_there"), F.bool_and("held").alias("is_late"), same.alias("same")
    )
    row = files.agg(
        F.array_sort(F.collect_list(F.when(F.col("is_late"), F.col("name")))).alias("late"),
        F.count_if(~F.col("is_there") | ~F.col("is_late") & ~F.col("same")).alias("gone"),
    ).first()
    return Changes(tuple(row["late"]), row["gone"])
