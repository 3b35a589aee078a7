"""CSV scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import has_suffix

# Fixed value: how timestamps are written in the flat files.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Column for the text of a line that does not fit the schema.
RAW_LINE = "_raw_line"

FILE_LIST_SCHEMA = T.StructType([T.StructField("filename", T.StringType(), True)])


def read_bulk_csv(
    spark: SparkSession, path: str | Sequence[str], *, infer: bool = False
) -> DataFrame:
    """Files with a header row.

    All columns are text by default: inference costs a second pass over the
    data and turns codes such as ``0012`` into numbers.
    """
    return spark.read.csv(path, header=True, inferSchema=infer)


def read_typed_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    header: bool = True,
    recursive: bool = False,
) -> DataFrame:
    """Files read under a declared schema.

    Fields are trimmed, blank fields are NULL, short rows are padded with NULL,
    surplus fields and blank lines are dropped. A path given twice is read twice.
    """
    return spark.read.csv(
        list(path) if not isinstance(path, str) else path,
        schema=schema,
        header=header,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        timestampFormat=TIMESTAMP_PATTERN,
        recursiveFileLookup=recursive,
    )


def read_checked_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    header: bool = True,
) -> DataFrame:
    """Files read under a declared schema, with the column ``rejected`` beside the declared ones.

    It is NULL for lines that fit. Else it holds the ``line`` and the ``cause``:
    the columns whose text is not of their type, or that there are more fields
    than columns. Lines with fewer fields fit; the rest is NULL. One pass: the
    reader keeps a line that did not fit, and only such lines are parsed again.
    """
    whole = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType(), True)])
    options = {
        "ignoreLeadingWhiteSpace": True,
        "ignoreTrailingWhiteSpace": True,
        "timestampFormat": TIMESTAMP_PATTERN,
    }
    rows = spark.read.csv(
        list(path) if not isinstance(path, str) else path,
        schema=whole,
        header=header,
        columnNameOfCorruptRecord=RAW_LINE,
        mode="PERMISSIVE",
        **options,
    )
    # The same line with all fields as text, and one field more.
    texts = T.StructType([T.StructField(f"t{k}", T.StringType(), True) for k in range(len(schema) + 1)])
    parsed = F.from_csv(F.col(RAW_LINE), texts.simpleString()[7:-1].replace(":", " "), {k: str(v).lower() if v is True else v for k, v in options.items()})
    bad = [
        F.when(
            F.col(f"`{f.name}`").isNull() & (F.length(F.coalesce(parsed[f"t{k}"], F.lit(""))) > 0),
            F.lit(f"{f.name} is not of type {f.dataType.simpleString()}"),
        )
        for k, f in enumerate(schema.fields)
    ]
    surplus = F.when(parsed[f"t{len(schema)}"].isNotNull(), F.lit(f"more than {len(schema)} fields"))
    causes = F.array_compact(F.array(*bad, surplus))
    cause = F.when(F.col(RAW_LINE).isNotNull() & (F.size(causes) > 0), F.concat_ws("; ", causes))
    rejected = F.when(cause.isNotNull(), F.struct(F.col(RAW_LINE).alias("line"), cause.alias("cause")))
    return rows.withColumn("rejected", rejected).drop(RAW_LINE)


def read_file_list(spark: SparkSession, path: str) -> DataFrame:
    """A file that names other files, one per line, as the column ``filename``."""
    return read_typed_csv(spark, path, FILE_LIST_SCHEMA, header=False)


def with_suffixes(names: DataFrame, suffixes: Sequence[str] = ("xls", "xml")) -> DataFrame:
    """Names ending in one of the suffixes; no dot is required before it."""
    return names.where(has_suffix(F.col("filename"), list(suffixes)))
