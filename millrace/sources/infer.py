"""Column types of text files, such that no value changes its spelling.

A value fits a type if the type's own text of it is the value again, so ``0012``,
``+5``, ``1e3``, ``1.50`` beside ``1.5`` and tokens that merely look like numbers
stay text. What is known of a column (``facts``) is a few flags and bounds. They are
found in one pass, may be kept for each file, and are merged without reading a file
twice: flags by AND, bounds by their extremes. Types follow from merged facts only:

    int < bigint < decimal of no places < string; decimals of equally many places,
    double, date, timestamp without zone and boolean < string

Empty fields are NULL and fit all; a column of nothing else is text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_DIGITS = 38
WHOLE = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?\z"
MINUS_ZERO = r"^-0([.]0+)?\z"
INT, BIGINT = r"^-?[0-9]{1,10}\z", r"^-?[0-9]{1,19}\z"
DOUBLE = r"^-?[0-9]+[.][0-9]+(E-?[0-9]+)?\z"
FLAGS = ["is_number", "is_int", "is_bigint", "is_double", "is_date", "is_timestamp", "is_boolean"]
BOUNDS = {"digits": F.max, "least_places": F.min, "most_places": F.max}


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _facts_of(value: Column, name: str, position: int) -> Column:
    def again(kind: str) -> Column:
        return value.try_cast(kind).cast("string") == value

    number = value.rlike(WHOLE) & ~value.rlike(MINUS_ZERO)
    places = F.when(number, F.length(F.split_part(value, F.lit("."), F.lit(2))))
    digits = F.when(number, F.length(F.ltrim(F.split_part(value, F.lit("."), F.lit(1)), F.lit("-"))))
    tests = {
        "is_number": number,
        # Only what is written like a number of a kind is parsed: a failed parse is slow.
        "is_int": F.when(number & value.rlike(INT), again("int")),
        "is_bigint": F.when(number & value.rlike(BIGINT), again("bigint")),
        "is_double": F.when(value.rlike(DOUBLE), again("double")),
        "is_date": again("date"),
        "is_timestamp": again("timestamp_ntz"),
        "is_boolean": value.isin("true", "false"),
    }
    held = [
        F.bool_and(F.when(value.isNotNull(), F.coalesce(tests[flag], F.lit(False)))).alias(flag)
        for flag in FLAGS
    ]
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(name).alias("column"),
        F.count(value).alias("filled"),
        *held,
        F.max(digits).alias("digits"),
        F.min(places).alias("least_places"),
        F.max(places).alias("most_places"),
    )


def facts(texts: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """One row per text column, and per value of ``by``, in one pass over ``texts``."""
    columns = [c for c in texts.columns if c not in by]
    if not columns:
        raise ValueError("no columns to find types of")
    found = F.array(*[_facts_of(_named(c), c, k) for k, c in enumerate(columns)])
    keys = [_named(c) for c in by]
    rows = texts.groupBy(*keys).agg(found.alias("_facts"))
    return rows.select(*keys, F.inline("_facts"))


def merge(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Facts of all files from facts of some: columns of one name are one column."""
    every = reduce(lambda a, b: a.unionByName(b), others, first)
    return every.groupBy("column").agg(
        F.min("position").alias("position"),
        F.sum("filled").alias("filled"),
        *[F.bool_and(flag).alias(flag) for flag in FLAGS],
        *[how(bound).alias(bound) for bound, how in BOUNDS.items()],
    )


def typed(found: DataFrame) -> DataFrame:
    """Facts with the ``type`` that follows from them."""
    precision = F.col("digits") + F.col("most_places")
    even = (F.col("least_places") == F.col("most_places")) & (precision <= MAX_DIGITS)
    decimal = F.format_string("decimal(%d,%d)", precision, F.col("most_places"))
    kind = (
        F.when(F.col("is_int"), "int")
        .when(F.col("is_bigint"), "bigint")
        .when(F.col("is_number") & even, decimal)
        .when(F.col("is_double"), "double")
        .when(F.col("is_date"), "date")
        .when(F.col("is_timestamp"), "timestamp_ntz")
        .when(F.col("is_boolean"), "boolean")
        .otherwise("string")
    )
    return found.withColumn("type", kind)


def read_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Files with a header row as text; files whose headers differ are an error."""
    return spark.read.csv(path, header=True, enforceSchema=False)


def types_by_file(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Facts and types of every column in every file: which file makes a column text."""
    texts = read_texts(spark, path).withColumn("file_path", F.col("_metadata.file_path"))
    return typed(facts(texts, by=["file_path"]))


def read_lossless(
    spark: SparkSession, path: str | Sequence[str], known: DataFrame | None = None
) -> DataFrame:
    """Files with a header row, each column of the narrowest type that keeps its spelling.

    ``known`` are facts of these files found before; without them one pass finds
    them. Values are cast as they were tested. A value that a stale ``known`` does
    not cover fails the read in ANSI mode.
    """
    texts = read_texts(spark, path)
    rows = typed(merge(known if known is not None else facts(texts))).collect()
    types = {r["column"]: r["type"] for r in rows}
    return texts.select(*[_named(c).cast(types.get(c, "string")).alias(c) for c in texts.columns])
