"""A stated query set against all rows, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import hash63, keep
from millrace.session import Workspace

# Rows of a block, queries that search it together, and queries that one copy of
# the block, and one index made of it, serve.
DATA_ROWS = 8192
QUERY_ROWS = 1024
QUERY_GROUP = 65536

FOUND = "query_id long, vec_id long, score {score}"


def usable_vectors(table: DataFrame, id_col: str, vector_col: str, *, zero: bool) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part.

    Left out are rows without an id, NULL vectors, those with a NULL, NaN or
    infinite component and, unless ``zero``, those without any other than 0.
    Rows that repeat an id count once; of several vectors under one id the
    smallest in Spark's order of arrays stands.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    chosen = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    wanted = F.col("vec_id").isNotNull() & v.isNotNull() & finite
    if not zero:
        wanted = wanted & F.exists(v, lambda x: x != 0)
    return chosen.where(wanted).groupBy("vec_id").agg(F.min("vector").alias("vector"))


# From the ids and vectors of a block, what searches it: query ids and queries to
# query positions, row positions and scores.
Index = Callable[[np.ndarray, np.ndarray], Callable[[np.ndarray, np.ndarray], tuple]]

PLACE = ["dims", "d", "q"]


def search_in_blocks(
    vectors: DataFrame, every: int, k: int, index: Index, score_type: str, work: Workspace
) -> DataFrame:
    """The best ``k`` for each vector whose id is divisible by ``every``.

    Rows are dealt by hash into blocks of about ``DATA_ROWS`` rows, queries into
    groups of about ``QUERY_GROUP``. Every pair of a block and a group comes to one
    task, the block first: ``index`` is made of it once, and the queries stream
    past, ``QUERY_ROWS`` at a time, so a task holds one block and one such part.
    Each gives at most ``k`` rows for a query. Vectors are compared with vectors
    of their own length only. Gives ``query_id, rank, vec_id, score``, best first,
    ties by the smaller id.
    """
    vectors = keep(vectors.withColumn("dims", F.size("vector")), work, "vectors")
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = max(1, -(-vectors.count() // DATA_ROWS))
    groups = max(1, -(-queries.count() // QUERY_GROUP))
    deal, step = hash63("vec_id"), QUERY_ROWS

    def placed(rows: DataFrame, own: str, of: int, other: str, others: int, asks: bool) -> DataFrame:
        every_other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        rows = rows.withColumn(own, F.pmod(deal, F.lit(of)).cast("int")).withColumn(other, every_other)
        return rows.select(*PLACE, F.lit(asks).alias("asks"), "vec_id", "vector")

    rows = placed(vectors, "d", blocks, "q", groups, False).unionAll(
        placed(queries, "q", groups, "d", blocks, True)
    )
    kind = pa.int64() if score_type == "long" else pa.float64()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for place, asks, part in _runs(batches):
            if place != at:
                at, held, ready = place, [], None
            if not asks:
                held.append(part)
                continue
            if ready is None:
                # No vector of this length was dealt to the block.
                if not held:
                    continue
                block = _matrix(pa.concat_tables(held))
                ready, held = (block[0], index(*block)), []
            for first in range(0, part.num_rows, step):
                query_ids, asked = _matrix(part.slice(first, step))
                at_query, at_row, scores = ready[1](query_ids, asked)
                columns = [query_ids[at_query], ready[0][at_row], scores]
                kinds = [pa.int64(), pa.int64(), kind]
                made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.record_batch(made, ["query_id", "vec_id", "score"])

    order = [*PLACE, "asks", "vec_id"]
    dealt = rows.repartition(*PLACE).sortWithinPartitions(*order)
    found = dealt.mapInArrow(search, FOUND.format(score=score_type))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.Table]]:
    """Sorted rows cut where place or kind changes; a long run comes in several parts."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        keys = np.column_stack([table[c].to_numpy().astype(np.int64) for c in [*PLACE, "asks"]])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for first, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            *place, asks = keys[first].tolist()
            yield tuple(place), bool(asks), table.slice(first, end - first)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, in the order they come in: that of the ids."""
    flat = table["vector"].combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    ids = table["vec_id"].to_numpy()
    return ids, flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores, ties by the smaller id, without ``own``."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:k]
