"""Join to a lookup with unique keys.

One key, NULL among them, may hold a third of the rows of the big side. The
lookup has at most one row per key, so a hot partition of the big side can be
cut anywhere: adaptive execution cuts it by the map tasks its rows come from
and reads the lookup's part of it for each cut. That holds for left and inner
joins with the big side on the left, and it is decided from the sizes that were
written, not from estimates. A lookup below Spark's own broadcast limit is
broadcast and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    *,
    how: str = "left",
    project: Callable[[DataFrame], DataFrame] = lambda joined: joined,
) -> DataFrame:
    """Left or inner join on (left column, lookup column) pairs.

    ``lookup`` must hold each key that matches at most once. ``project`` picks
    the result's columns; in it the sides are called ``target`` and ``source``.
    """
    left = left.alias("target")
    lookup = lookup.alias("source")
    condition = F.lit(True)
    for a, b in on:
        if left.schema[a].dataType != lookup.schema[b].dataType:
            raise ValueError(f"cast {a} and {b} to one type before joining on them")
        condition = condition & (F.col(f"target.`{a}`") == F.col(f"source.`{b}`"))
    return project(left.join(lookup, condition, how))
