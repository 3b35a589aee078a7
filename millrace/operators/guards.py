"""Checks that stop a bad update before it touches the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.errors import FanOutError, RowCountMismatchError
from millrace.functions.text import without_quotes


def row_count_guard(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: both counts and whether they match. Neither side's columns are read."""
    one = F.count(F.lit(1))
    zero = F.lit(0).cast("bigint")
    counts = before.agg(one.alias("original_count")).select(
        "original_count", zero.alias("new_count")
    )
    counts = counts.unionAll(
        after.agg(one.alias("new_count")).select(zero.alias("original_count"), "new_count")
    )
    return _with_verdict(
        counts.agg(
            F.sum("original_count").alias("original_count"),
            F.sum("new_count").alias("new_count"),
        )
    )


def join_count_guard(
    before: DataFrame, source: DataFrame, on: Sequence[tuple[str, str]]
) -> DataFrame:
    """Same row for a left join to ``source``, without performing that join.

    Both sides are counted per key before anything is joined, so neither a hot
    key nor a fan-out can blow up: the joined size is the sum of products.
    """
    left = before.groupBy([F.col(f"`{a}`").alias(f"_k{i}") for i, (a, _) in enumerate(on)])
    right = source.groupBy([F.col(f"`{b}`").alias(f"_k{i}") for i, (_, b) in enumerate(on)])
    keys = [f"_k{i}" for i in range(len(on))]
    sizes = left.agg(F.count(F.lit(1)).alias("_rows")).join(
        right.agg(F.count(F.lit(1)).alias("_matches")), keys, "left"
    )
    counts = sizes.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("original_count"),
        F.coalesce(F.sum(F.col("_rows") * F.coalesce("_matches", F.lit(1))), F.lit(0)).alias(
            "new_count"
        ),
    )
    return _with_verdict(counts)


def _with_verdict(counts: DataFrame) -> DataFrame:
    return counts.withColumn("matches", F.col("original_count") == F.col("new_count"))


def require_equal_counts(original: int, new: int, what: str) -> None:
    if original != new:
        raise RowCountMismatchError(
            f"{what}: {original:,} rows before the rewrite, {new:,} after"
        )


def _sums(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of rows and two sums over their hashes.

    The order of the rows does not matter, copies do. A hash is added in halves,
    whose sums stay in range for billions of rows.
    """
    fields = {f.name: f.dataType.typeName() for f in rows.select(*_quoted(columns)).schema.fields}
    # Maps have no hash; their entries in order have one.
    parts = [
        F.array_sort(F.map_entries(f"`{c}`")) if kind == "map" else F.col(f"`{c}`")
        for c, kind in fields.items()
    ]
    whole = F.xxhash64(F.lit(0), *parts)
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.shiftrightunsigned(whole, 32)), F.lit(0)).alias("high"),
        F.coalesce(F.sum(whole.bitwiseAND(0xFFFFFFFF)), F.lit(0)).alias("low"),
    )


def fingerprint(rows: DataFrame, columns: Sequence[str]) -> tuple[int, int, int]:
    """Equal for equal multisets of rows, whatever their order."""
    return tuple(_sums(rows, columns).first())


def row_multiset_guard(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: both counts, and whether the rows are the same in ``columns``, copies counted."""
    tagged = [
        _sums(side, columns).withColumn("at", F.lit(at)) for at, side in enumerate((before, after))
    ]
    one = [F.max(F.when(F.col("at") == at, F.struct("n", "high", "low"))).alias(f"s{at}") for at in (0, 1)]
    both = tagged[0].unionAll(tagged[1]).agg(*one)
    return both.select(
        F.col("s0.n").alias("original_count"),
        F.col("s1.n").alias("new_count"),
        (F.col("s0") == F.col("s1")).alias("same"),
    )


def _quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def require_same_rows(
    original: DataFrame, new: DataFrame, columns: Sequence[str], what: str
) -> int:
    """Refuse rows that are not, in ``columns``, the original ones; gives their number."""
    before, after = fingerprint(original, columns), fingerprint(new, columns)
    require_equal_counts(before[0], after[0], what)
    if before != after:
        raise RowCountMismatchError(
            f"{what}: as many rows as before the rewrite, but not the same ones"
        )
    return after[0]


def require_no_fan_out(
    target: DataFrame, source: DataFrame, on: Sequence[tuple[str, str]]
) -> None:
    """Refuse a source key that occurs twice and that target rows match.

    Only the source's key columns are read; the target's are too when, and only
    when, the source repeats a key.
    """
    keys = [f"`{b}`" for _, b in on]
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    for _, b in on:
        repeated = repeated.where(F.col(f"`{b}`").isNotNull())
    if repeated.isEmpty():
        return
    # Distinct first, so that a hot key reaches the join as one row.
    asked = target.select(*[F.col(f"`{a}`").alias(f"_k{i}") for i, (a, _) in enumerate(on)])
    condition = F.lit(True)
    for i, (_, b) in enumerate(on):
        condition = condition & (F.col(f"t._k{i}") == F.col(f"s.`{b}`"))
    hits = repeated.alias("s").join(asked.distinct().alias("t"), condition, "left_semi").head(3)
    if hits:
        found = [tuple(h[b] for _, b in on) for h in hits]
        raise FanOutError(f"lookup keys matched more than once, such as {found}")


def duplicate_update_columns(rules: DataFrame) -> DataFrame:
    """Columns that one batch of enabled rules rewrites more than once in a partition."""
    enabled = rules.where(F.col("enabled_flag") == "Y")
    return (
        enabled.groupBy(
            "table_name",
            "batch_number",
            without_quotes(F.col("partition_column")).alias("partition_key"),
            F.lower("update_column").alias("update_column"),
        )
        .agg(F.count(F.lit(1)).alias("times"))
        .where("times > 1")
    )
