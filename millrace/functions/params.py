"""key=value tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import trim_blank


def extract_params(tokens: Column, fields: Sequence[str], separator: str = "=") -> Column:
    """Allowed parameters of an array of tokens as ``map<string,string>``.

    A token is cut at its first separator and both sides are trimmed. A token
    without separator, or starting with it, is its own key and value, untrimmed.
    Keys outside ``fields`` are left out; of a repeated key the last value stays.
    The work is local to the row: nothing is exploded, grouped or shuffled.
    """

    def parse(token: Column) -> Column:
        at = F.instr(token, separator)
        cut = at > 1
        key = trim_blank(F.substr(token, F.lit(1), at - 1))
        value = trim_blank(F.substr(token, at + len(separator)))
        return F.struct(
            F.when(cut, key).otherwise(token).alias("key"),
            F.when(cut, value).otherwise(token).alias("value"),
        )

    allowed = list(dict.fromkeys(fields))
    if not allowed:
        return F.create_map().cast("map<string,string>")
    kept = F.filter(F.transform(tokens, parse), lambda p: p["key"].isin(allowed))

    def last_of(field: str) -> Column:
        same = F.filter(kept, lambda p: p["key"] == field)
        return F.try_element_at(same, F.lit(-1))

    found = F.filter(F.array(*[last_of(f) for f in allowed]), lambda p: p.isNotNull())
    return F.map_from_entries(found)
