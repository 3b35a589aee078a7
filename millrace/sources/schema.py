"""Schemas declared as (column, type name) pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from millrace.errors import UnknownTypeError

# The type names a spec may use, in any letter case.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "date": T.DateType(),
    "short": T.ShortType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def type_named(name: str, *, strict: bool = False) -> T.DataType:
    """Spark type of a declared name; an unknown name means string unless strict."""
    found = TYPE_NAMES.get(name.lower())
    if found is not None:
        return found
    if strict:
        raise UnknownTypeError(f"unsupported type name: {name!r}")
    return T.StringType()


def schema_of(spec: Sequence[tuple[str, str]], *, strict: bool = False) -> T.StructType:
    """Schema with every declared column nullable."""
    return T.StructType(
        [T.StructField(name, type_named(kind, strict=strict), True) for name, kind in spec]
    )
