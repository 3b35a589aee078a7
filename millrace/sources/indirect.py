"""Indirect scan: read the files that a list file names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.csv import read_checked_csv, read_file_list, read_typed_csv

FILE_NAME = "file_name"
REJECTED = "struct<line: string, cause: string>"
# Signs with a meaning of their own in a path that Spark reads.
GLOB_SIGNS = re.compile(r"[\\*?\[\]{}]")


def literal_path(path: str) -> str:
    """The path, its signs taken as they are."""
    return GLOB_SIGNS.sub(lambda sign: "\\" + sign[0], path)


def qualified(spark: SparkSession, path: str) -> str:
    """The folder as its file system spells it, without scheme and host."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(folder).toUri().getPath().rstrip("/")


def relative_name(spark: SparkSession, base: str) -> Column:
    """Path of the row's file below ``base``, as a list file spells it.

    The metadata path is percent-encoded. ``url_decode`` would also turn a plus
    sign into a space, so plus signs are encoded first. A file that does not lie
    below ``base`` ends the query.
    """
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    # file:///a, file:/a and hdfs://host/a: all begin a path at the same slash.
    path = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    root = qualified(spark, base) + "/"
    outside = F.raise_error(F.concat(F.lit(f"not below {root}: "), path)).cast("string")
    return F.when(F.startswith(path, F.lit(root)), F.substr(path, F.lit(len(root) + 1))).otherwise(outside)


def read_listed(
    spark: SparkSession,
    list_path: str,
    base: str,
    schema: T.StructType,
    *,
    header: bool = True,
    checked: bool = False,
) -> DataFrame:
    """Rows of every listed file, with the listed name as last column.

    With ``checked`` the column ``rejected`` follows, see :func:`read_checked_csv`.

    Names are taken literally: files that are not listed are never opened, a
    file listed twice counts twice, and a listed file that does not exist fails
    the read. One plan reads all files, so small ones share tasks and large ones
    are split; the driver holds all names, as Spark does for any set of files.
    """
    root = literal_path(base.rstrip("/"))
    names = read_file_list(spark, list_path).where("filename IS NOT NULL")
    paths = [f"{root}/{literal_path(row.filename)}" for row in names.toLocalIterator()]
    if not paths:
        lineage = T.StructField(FILE_NAME, T.StringType(), True)
        none = spark.createDataFrame([], T.StructType([*schema.fields, lineage]))
        return none.withColumn("rejected", F.lit(None).cast(REJECTED)) if checked else none
    rows = (read_checked_csv if checked else read_typed_csv)(spark, paths, schema, header=header)
    more = ["rejected"] if checked else []
    names = [f"`{name}`" for name in schema.names]
    return rows.select(*names, relative_name(spark, base).alias(FILE_NAME), *more)
