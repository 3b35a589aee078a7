"""Exact top-k by inner product with a vector-approximation file.

Every component of a block's vectors is quantised to a cell, one byte. The cell
edges bound a component, and so a whole inner product: a scan of the cells,
with the lower or the upper edge by the sign of the query's component, gives an
upper bound for every vector. Exact vectors are then read in the order of
falling bounds, and reading ends when the next bound is below the kth score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.blocks import best_of, search_in_blocks, usable_vectors
from millrace.session import Workspace

SCALE = 1024
CELLS = 256
# Components up to here leave sums of products in the range of doubles.
LARGEST = 1e140
# Exact vectors read at a time.
READ = 64


def exact_top_k(
    table: DataFrame,
    work: Workspace,
    *,
    every: int = 100,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` largest integer inner products.

    Components become ``floor(1024 * x)``. Queries are the vectors whose id is
    divisible by ``every``, candidates all others. Rows without an id, NULL
    vectors and vectors with NULL or non-finite components take no part; rows
    that repeat an id count once; vectors meet only those of their own length.
    Ties go to the smaller id; fewer candidates than ``k`` give all of them. A
    score beyond a long is given as the nearest long. An empty table gives no
    rows. Other columns are not looked at, whatever their names. Finite
    components of any size are scored exactly; a block in which products leave
    the range of doubles has no bounds and is read whole.
    """

    def index(ids, vectors):
        bounded = np.abs(vectors).max(initial=0) <= LARGEST
        file = CellFile(np.floor(vectors * SCALE)) if bounded else None

        def search(query_ids, queries):
            if file is None or np.abs(queries).max(initial=0) > LARGEST:
                return read_all(query_ids, queries, ids, vectors, k)
            return top_k(query_ids, np.floor(queries * SCALE), ids, file, k)

        return search

    vectors = usable_vectors(table, id_col, vector_col, zero=True)
    return search_in_blocks(vectors, every, k, index, "long", work)


class CellFile:
    """A block's cells and edges, made once, and its exact vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.largest = float(np.abs(vectors).max(initial=0))
        empty = np.zeros(vectors.shape, np.uint8), np.zeros((CELLS + 1, 0))
        self.cells, self.edges = quantise(vectors) if vectors.shape[1] else empty
        self._exact: dict[type, np.ndarray] = {}

    def exact(self, kind: type) -> np.ndarray:
        """The vectors as whole numbers, of 64 bits or of any size."""
        if kind not in self._exact:
            self._exact[kind] = _integers(self.vectors, kind)
        return self._exact[kind]


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of every component, and the ``CELLS + 1`` edges of each dimension."""
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    edges = low + (high - low) * np.linspace(0, 1, CELLS + 1)[:, None]
    edges[-1] = high
    cells = np.empty(vectors.shape, dtype=np.uint8)
    for d in range(vectors.shape[1]):
        cells[:, d] = np.clip(np.searchsorted(edges[:, d], vectors[:, d], side="right") - 1, 0, CELLS - 1)
    return cells, edges


def upper_bounds(queries: np.ndarray, cells: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A bound no inner product of a query (row) and a vector (column) exceeds."""
    dims = np.arange(cells.shape[1])
    low, high = edges[cells, dims], edges[cells.astype(np.int64) + 1, dims]
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    # Sums of doubles are rounded: leave room for that.
    size = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T
    return bounds + size * 1e-12 + 1


def top_k(query_ids, queries, ids, file: CellFile, k):
    """Positions of queries and rows, and scores, of each query's best ``k`` in the block."""
    dims = file.vectors.shape[1]
    reach = float(np.abs(queries).max(initial=0)) * file.largest * max(1, dims)
    exact = np.int64 if reach < 2**62 else object
    whole = file.exact(exact)
    asked = _integers(queries, exact)
    bounds = upper_bounds(queries, file.cells, file.edges)
    at_query, at_row, scores = [], [], []
    for q in range(len(queries)):
        order = np.argsort(-bounds[q], kind="stable")
        order = order[ids[order] != query_ids[q]]
        read, found = 0, np.empty(0, dtype=exact)
        while read < len(order):
            if read >= k and bounds[q][order[read]] < _kth(found, k):
                break
            part = order[read : read + READ]
            found = np.concatenate([found, whole[part] @ asked[q]])
            read += len(part)
        seen = order[:read]
        best = best_of(found, ids[seen], query_ids[q], k)
        at_query += [q] * len(best)
        at_row += seen[best].tolist()
        scores += [int(min(max(s, -(2**63)), 2**63 - 1)) for s in found[best]]
    return np.array(at_query, dtype=np.int64), np.array(at_row, dtype=np.int64), scores


def read_all(query_ids, queries, ids, vectors, k):
    """The same as ``top_k`` by whole numbers alone, for components of any size."""
    held, asked = _exactly(vectors), _exactly(queries)
    at_query, at_row, scores = [], [], []
    for q in range(len(asked)):
        found = np.array([sum(a * b for a, b in zip(asked[q], row, strict=True)) for row in held], dtype=object)
        best = best_of(found, ids, query_ids[q], k)
        at_query += [q] * len(best)
        at_row += best.tolist()
        scores += [int(min(max(s, -(2**63)), 2**63 - 1)) for s in found[best]]
    return np.array(at_query, dtype=np.int64), np.array(at_row, dtype=np.int64), scores


def _exactly(matrix: np.ndarray) -> list[list[int]]:
    """``floor(SCALE * x)`` of doubles as whole numbers of any size."""
    return [[(n * SCALE) // d for n, d in (float(x).as_integer_ratio() for x in row)] for row in matrix]


def _integers(matrix: np.ndarray, kind: type) -> np.ndarray:
    if kind is np.int64:
        return matrix.astype(np.int64)
    return np.array([[int(x) for x in row] for row in matrix], dtype=object).reshape(matrix.shape)


def _kth(scores: np.ndarray, k: int):
    return np.partition(scores, len(scores) - k)[len(scores) - k]
