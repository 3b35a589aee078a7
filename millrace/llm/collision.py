"""Approximate nearest neighbours by collision counting.

Each block's vectors are projected on random lines, and the projections on one
line are kept as a sorted array. A query opens a window around its own
projection in every array. A vector whose place lies in the window of a line
collides there; vectors that collide on enough lines are verified with the
exact measure. All windows of a query have one width, from a row in which each
is the last by one factor (virtual rehashing): the first at which enough vectors
are found. As wider windows find no fewer, it is searched for from where other
queries have found theirs, and not always from the first width.

Largest inner product is nearest distance once every vector gets one more
component that brings it to the block's greatest length, and the query a 0
there, both scaled to length 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.blocks import best_of, search_in_blocks, usable_vectors
from millrace.session import Workspace

# Lines, the half width of the first windows, their growth, the share of the
# lines on which a verified vector collides, and the share of a block, and the
# number, that is verified before a query ends. They hold for vectors scaled to
# length 1, whose distances are about 1: the first windows are somewhat narrower
# than what near vectors need, and grow slowly, so that few more are verified
# than asked for.
LINES = 192
FIRST_HALF = 0.75
GROWTH = 1.04
COLLISIONS = 0.6
VERIFIED = 0.1
LEAST_VERIFIED = 250
# Queries of a part that tell the others which width to try first.
SCOUTS = 16


def nearest(
    table: DataFrame,
    work: Workspace,
    *,
    every: int = 20,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` largest inner products found.

    Queries are the vectors whose id is divisible by ``every``, candidates all
    others; every vector is in the index. Scores are exact, in doubles. Rows
    without an id, NULL or zero vectors and vectors with NULL or non-finite
    components take no part; rows that repeat an id count once; vectors meet
    only those of their own length. Ties go to the smaller id; fewer candidates
    than ``k`` give all of them. An empty table gives no rows. Other columns
    are not looked at, whatever their names.
    """

    def index(ids, vectors):
        made = sorted_arrays(vectors, LINES)
        return lambda query_ids, queries: collide(query_ids, queries, ids, vectors, k, made=made)

    vectors = usable_vectors(table, id_col, vector_col, zero=False)
    return search_in_blocks(vectors, every, k, index, "double", work)


def to_sphere(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 whose order by distance to a query is that by inner product."""
    scaled = vectors / np.abs(vectors).max()
    square = (scaled**2).sum(axis=1)
    rest = np.sqrt(np.maximum(square.max() - square, 0))
    return np.column_stack([scaled, rest]) / np.sqrt(square.max())


def sorted_arrays(vectors: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The index of a block: directions, each line's sorted projections, rows' places there."""
    directions = np.random.default_rng(5).standard_normal((vectors.shape[1] + 1, lines))
    projected = (to_sphere(vectors) @ directions).T
    orders = np.argsort(projected, axis=1, kind="stable")
    kind = np.uint16 if len(vectors) < 2**16 else np.uint32
    places = np.empty(orders.shape, dtype=kind)
    np.put_along_axis(places, orders, np.arange(len(vectors), dtype=kind)[None, :], axis=1)
    return directions, np.take_along_axis(projected, orders, axis=1), places


def collisions(places: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """On how many lines a row's place is in the window from ``left`` to before ``right``."""
    # Places before the window wrap around to large numbers.
    inside = (places - left[:, None]) < (right - left)[:, None]
    return inside.view(np.uint8).sum(axis=0, dtype=np.uint8 if len(places) < 256 else np.uint16)


def collide(query_ids, queries, ids, vectors, k, **options):
    """Positions of queries and rows, and scores, of what each query found in the block.

    A list given as ``read`` gets the number of verified vectors of each query;
    ``made`` are the block's sorted arrays, if there are any yet.
    """
    lines = options.get("lines", LINES)
    half, growth = options.get("half", FIRST_HALF), options.get("growth", GROWTH)
    needed = max(1, round(options.get("collisions", COLLISIONS) * lines))
    n = len(vectors)
    enough = min(n, k + 1 + max(LEAST_VERIFIED, int(options.get("verified", VERIFIED) * n)))
    directions, arrays, places = options.get("made") or sorted_arrays(vectors, lines)
    lengths = np.abs(queries).max(axis=1, keepdims=True)
    unit = queries / lengths
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    centres = unit @ directions[:-1]

    def colliding(asked: np.ndarray, widths: np.ndarray) -> list[np.ndarray]:
        """For each query the rows that collide on enough lines in windows of its width."""
        reach = half * growth**widths
        left = np.empty((lines, len(asked)), dtype=places.dtype)
        right = left.copy()
        for i in range(lines):
            centre = centres[asked, i]
            # Neighbours are looked up after one another.
            order = np.argsort(centre)
            centre, near = centre[order], reach[order]
            left[i, order] = np.searchsorted(arrays[i], centre - near)
            right[i, order] = np.searchsorted(arrays[i], centre + near, side="right")
        counts = (collisions(places, left[:, j], right[:, j]) for j in range(len(asked)))
        return [np.flatnonzero(count >= needed) for count in counts]

    found: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
    width, start = np.zeros(len(queries), dtype=np.int64), 0
    # A few queries tell the others where to look first.
    for first, end in [(0, SCOUTS), (SCOUTS, len(queries))]:
        asked = np.arange(first, min(end, len(queries)))
        # The widest too narrow, the narrowest wide enough (-1: none yet).
        narrow, wide = np.full(len(queries), -1), np.full(len(queries), -1)
        width[asked], tries = start, 0
        while len(asked):
            for q, rows in zip(asked, colliding(asked, width[asked]), strict=True):
                if len(rows) >= enough:
                    wide[q], found[q] = width[q], rows
                else:
                    narrow[q] = width[q]
            asked = asked[(wide[asked] < 0) | (wide[asked] - narrow[asked] > 1)]
            below, above, stride = narrow[asked], wide[asked], 2 ** max(0, tries - 2)
            up, down = below + stride, np.maximum(above - stride, 0)
            between = np.where(below >= 0, (below + above) // 2, down)
            width[asked] = np.where(above < 0, up, between)
            tries += 1
        if end == SCOUTS and len(queries):
            start = int(np.median(wide[: min(end, len(queries))]))
    at_query, at_row, scores = [], [], []
    for q in range(len(queries)):
        candidates = found[q]
        options.get("read", []).append(len(candidates))
        exact = vectors[candidates] @ queries[q]
        best = best_of(exact, ids[candidates], query_ids[q], k)
        at_query.append(np.full(len(best), q))
        at_row.append(candidates[best])
        scores.append(exact[best])
    return np.concatenate(at_query), np.concatenate(at_row), np.concatenate(scores)
