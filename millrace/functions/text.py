"""Small text expressions used by the rule tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to the space, which is what a Java-style trim removes;
# Spark's own trim removes spaces only.
CONTROL_AND_SPACE = "".join(map(chr, range(0x21)))


def trim_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(CONTROL_AND_SPACE))


def without_quotes(text: Column) -> Column:
    """Text with every single quote removed."""
    return F.translate(text, "'", "")


def equals_ignoring_quotes(left: Column, right: Column) -> Column:
    return without_quotes(left) == without_quotes(right)


def has_suffix(text: Column, suffixes: list[str]) -> Column:
    """True where the text ends with one of the suffixes, case-sensitively."""
    match = F.lit(False)
    for suffix in suffixes:
        match = match | text.endswith(suffix)
    return match


def digits_grouped(number: Column) -> Column:
    """Integer with thousands separators, for messages people read."""
    return F.format_number(number, 0)
