"""Sharding by a minimax contiguous partition of atomic groups.

Groups (documents with equal text) are ordered by a hash of their text. The
smallest capacity for which a greedy walk over the ordered group sizes needs no
more shards than there are is found by binary search, and the groups are cut
where that walk cuts them.

The walk does not need every group. The order is first seen as a histogram of
at most 65,536 cells. A walk that cuts only at cell edges gives an upper bound
for the capacity, one that may cut inside a cell a lower bound. Only cells that
hold a cut of a walk between the two bounds are split further, until the
bounds meet. The result is exact, and the driver holds a bounded histogram at
any number of documents.

A group above the mean of what is left for the other shards would set the
capacity alone and leave shards empty. Such groups, fewer than there are
shards, get a shard each, and the partition runs over the others.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import hash63, keep
from millrace.session import Workspace

HASH_BITS = 63
# Cells of the histogram that the driver holds at a time: a bound, not a cut.
CELL_BITS = 16
# Rows numbered together in one window.
SLOT_ROWS = 2000


def shard_by_bytes(
    docs: DataFrame,
    work: Workspace,
    *,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = 16,
) -> DataFrame:
    """Every row with its shard and its slot there.

    Gives ``doc_id, size, text_crc32, shard, slot``. The size is the text's
    UTF-8 bytes plus ``overhead``. NULL text counts no bytes, has the checksum
    of no bytes (0) and forms a group of its own; a NULL id is kept. Repeated
    rows are rows like others. An empty table gives no rows. Other columns of
    the input are not looked at, whatever their names.
    """
    text = F.col(f"`{text_col}`")
    rows = keep(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead).alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            hash63(text).alias("key"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        work,
        "rows",
    )
    groups = keep(
        rows.groupBy("key").agg(F.sum("size").alias("bytes")), work, "groups"
    )
    placed = rows.withColumn("shard", shard_column(groups, shards))
    return _with_slots(placed, shards).select("doc_id", "size", "text_crc32", "shard", "slot")


def shard_column(groups: DataFrame, shards: int) -> Column:
    """The shard as an expression of ``key``, for groups of (``key``, ``bytes``)."""
    largest = groups.orderBy(F.desc("bytes"), "key").limit(shards).collect()
    rest = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = []
    for row in largest:
        if row["bytes"] * (shards - len(alone)) <= rest:
            break
        alone.append(row["key"])
        rest -= row["bytes"]
    others = groups.where(~F.col("key").isin(alone)) if alone else groups
    shared = shards - len(alone)
    cuts = minimax_cuts(others, shared)
    # Literal arrays keep the plan small: each is one value in it.
    begun = F.filter(_longs(cuts), lambda cut: cut <= F.col("key"))
    own = F.array_position(_longs(alone), F.col("key"))
    return F.when(own > 0, own - 1 + shared).otherwise(F.size(begun)).cast("int")


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values]).cast("array<long>")


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """Keys at which new shards begin, for the least possible largest shard."""
    bits = CELL_BITS
    cells = _cells(groups, bits)
    while True:
        lower, upper = _bounds(cells, shards)
        open_cells = _undecided(cells, shards, lower, upper)
        if lower == upper or not len(open_cells) or bits == HASH_BITS:
            return [int(cells["start"][i]) for i in _walk(cells, upper, shards) if i < len(cells)]
        finer = min(HASH_BITS, bits + max(1, CELL_BITS - int(len(open_cells)).bit_length()))
        chosen = groups.sparkSession.createDataFrame(
            [(int(cells["start"][i]) >> (HASH_BITS - bits),) for i in open_cells], "cell long"
        )
        shift = HASH_BITS - bits
        inside = groups.join(
            F.broadcast(chosen), F.shiftright("key", shift) == F.col("cell"), "left_semi"
        )
        stay = np.delete(cells, open_cells)
        cells = np.sort(np.concatenate([stay, _cells(inside, finer)]), order="start")
        bits = finer


def _cells(groups: DataFrame, bits: int) -> np.ndarray:
    """Histogram of the key's first ``bits`` bits, in their order."""
    cell = F.shiftright("key", HASH_BITS - bits)
    found = (
        groups.groupBy(cell.alias("cell"))
        .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.max("bytes").alias("most"))
        .collect()
    )
    made = [(r["cell"] << (HASH_BITS - bits), r["bytes"], r["n"], r["most"]) for r in found]
    kind = [("start", "i8"), ("bytes", "i8"), ("n", "i8"), ("most", "i8")]
    return np.sort(np.array(made, dtype=kind), order="start")


def _walk(cells: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Where a greedy walk that cuts at cell edges begins each further shard."""
    ends = np.concatenate([[0], np.cumsum(cells["bytes"])])
    at, cuts = 0, []
    for _ in range(shards):
        at = int(np.searchsorted(ends, ends[at] + capacity, side="right")) - 1
        cuts.append(at)
    return cuts


def _loose_walk(cells: np.ndarray, capacity: int, shards: int) -> list[int]:
    """The same in bytes, for a walk that may cut anywhere in a cell of many groups."""
    ends = np.concatenate([[0], np.cumsum(cells["bytes"])])
    at, cuts = 0, []
    for _ in range(shards):
        at = min(at + capacity, int(ends[-1]))
        i = int(np.searchsorted(ends, at, side="right")) - 1
        if i < len(cells) and cells["n"][i] == 1:
            at = int(ends[i])
        cuts.append(at)
    return cuts


def _least(low: int, high: int, fits) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def _bounds(cells: np.ndarray, shards: int) -> tuple[int, int]:
    """Capacities between which the smallest feasible one lies."""
    total = int(cells["bytes"].sum())
    if not total:
        return 0, 0
    floor = max(int(cells["most"].max()), -(-total // shards))
    upper = _least(floor, total, lambda c: _walk(cells, c, shards)[-1] == len(cells))
    lower = _least(floor, upper, lambda c: _loose_walk(cells, c, shards)[-1] == total)
    return lower, upper


def _undecided(cells: np.ndarray, shards: int, lower: int, upper: int) -> np.ndarray:
    """Cells of several groups that a cut of a walk between the bounds may meet."""
    ends = np.concatenate([[0], np.cumsum(cells["bytes"])])
    first = ends[_walk(cells, lower, shards)]
    last = _loose_walk(cells, upper, shards)
    met = np.zeros(len(cells), dtype=bool)
    for a, b in zip(first, last, strict=True):
        met |= (ends[1:] > a) & (ends[:-1] <= b)
    return np.flatnonzero(met & (cells["n"] > 1))


def _with_slots(placed: DataFrame, shards: int) -> DataFrame:
    """Gapless numbers from 0 in each shard, given in parts of a few thousand rows."""
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    sizes = _longs([max(1, counts.get(shard, 0) // SLOT_ROWS) for shard in range(shards)])
    parts = F.element_at(sizes, F.col("shard") + 1)
    # Dealt by their place, so that rows that repeat id and text do not meet in one part.
    dealt = placed.withColumn("part", F.pmod(hash63("row_no"), parts))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "part")
        .agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    )
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "key")
    return (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "part"])
        .withColumn("slot", F.col("first_slot") + F.col("inside"))
    )
