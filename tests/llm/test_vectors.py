"""The two vector searches against brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from millrace.llm import blocks, collision, vafile

SCHEMA = "vec_id long, embedding array<float>, score double, `rank` int, vector string"


def made(spark, rows):
    return spark.createDataFrame([(i, v, 0.5, 1, "x") for i, v in rows], SCHEMA)


def table():
    rng = random.Random(4)
    vector = lambda n=16: [rng.gauss(0, 1) for _ in range(n)]
    common = vector()
    rows = [(k, vector()) for k in range(300)]
    rows += [(k, common) for k in range(300, 400)]  # ties
    rows += [(400 + k, vector(5)) for k in range(40)]
    rows += [(0, [9.0] * 16), (20, rows[20][1]), (20, rows[20][1])]  # ids that repeat
    rows += [(500, None), (520, [None] + vector(15)), (540, [math.nan] * 16), (560, [math.inf] * 16)]
    rows += [(580, [0.0] * 16), (None, vector()), (600, [])]
    return [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def usable(rows, zero):
    found = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not (zero or any(v)):
            continue
        found[i] = min(found.get(i, v), v)
    return found


def exact(vectors, every, k, score):
    out = {}
    for q in vectors:
        if q % every == 0:
            others = [i for i in vectors if i != q and len(vectors[i]) == len(vectors[q])]
            ranked = sorted((-score(vectors[q], vectors[i]), i) for i in others)[:k]
            out |= {(q, n): (i, -s) for n, (s, i) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("data_rows", [64, 8192])
def test_exact_top_k(spark, work, data_rows, monkeypatch):
    monkeypatch.setattr(blocks, "DATA_ROWS", data_rows)
    monkeypatch.setattr(blocks, "QUERY_ROWS", 7)
    monkeypatch.setattr(blocks, "QUERY_GROUP", 10)
    rows = table()
    found = vafile.exact_top_k(made(spark, rows), work, every=20, k=10).collect()
    whole = lambda v: [math.floor(1024 * x) for x in v]
    score = lambda a, b: sum(x * y for x, y in zip(whole(a), whole(b), strict=True))
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == exact(usable(rows, True), 20, 10, score)


def test_every_pair_of_blocks_meets(spark, work, monkeypatch):
    """Also where each of many groups has a partition of its own, as on a cluster."""
    for name, value in [("DATA_ROWS", 40), ("QUERY_ROWS", 8)]:
        monkeypatch.setattr(blocks, name, value)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {name: spark.conf.get(name) for name in settings}
    rows = table()
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = vafile.exact_top_k(made(spark, rows), work, every=20, k=10).collect()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    whole = lambda v: [math.floor(1024 * x) for x in v]
    score = lambda a, b: sum(x * y for x, y in zip(whole(a), whole(b), strict=True))
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == exact(usable(rows, True), 20, 10, score)


def test_exact_top_k_of_huge_components(spark, work):
    rows = [(0, [3e38, 1.0]), (1, [3e38, 2.0]), (2, [-3e38, 0.0]), (3, [1e-3, 0.0])]
    found = vafile.exact_top_k(made(spark, rows), work, every=100, k=10).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])][0] == (1, 2**63 - 1)
    assert found[-1]["score"] == -(2**63)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    vectors, queries = np.floor(rng.standard_normal((200, 8)) * 1024), np.floor(rng.standard_normal((20, 8)) * 1024)
    assert (vafile.upper_bounds(queries, *vafile.quantise(vectors)) >= queries @ vectors.T).all()


@pytest.mark.parametrize("data_rows", [100, 8192])
def test_nearest(spark, work, data_rows, monkeypatch):
    monkeypatch.setattr(blocks, "DATA_ROWS", data_rows)
    monkeypatch.setattr(blocks, "QUERY_ROWS", 5)
    monkeypatch.setattr(blocks, "QUERY_GROUP", 12)
    rows = table()
    found = collision.nearest(made(spark, rows), work, every=20, k=20).collect()
    vectors = usable(rows, False)
    want = exact(vectors, 20, 20, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found}
    assert got.keys() == want.keys()
    for (query, _), (vec, score) in got.items():
        assert score == pytest.approx(np.dot(vectors[query], vectors[vec]), rel=1e-12, abs=1e-12)
    hits = sum(got[q, n][0] in {want[q, m][0] for m in range(1, 21) if (q, m) in want} for q, n in got)
    assert hits >= 0.9 * len(want)


def test_few_verified_still_find_most():
    """Where a small share of many vectors is verified, most of the nearest are among them."""
    rng = np.random.default_rng(7)
    middles = rng.standard_normal((40, 32))
    vectors = middles[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 32))
    ids, queries = np.arange(6000), np.arange(0, 6000, 200)
    at_query, at_row, _ = collision.collide(ids[queries], vectors[queries], ids, vectors, 20)
    hits = 0
    for k, q in enumerate(queries):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20]) & set(at_row[at_query == k]))
    assert hits >= 0.9 * 20 * len(queries)


@pytest.mark.parametrize("spread", ["clusters", "none"])
def test_a_small_share_of_many_vectors_is_verified(spread):
    """Recall and share over 24,576 vectors, in blocks as the search has them."""
    rng = np.random.default_rng(11)
    vectors = rng.standard_normal((3 * blocks.DATA_ROWS, 64))
    if spread == "clusters":
        vectors += rng.standard_normal((200, 64))[rng.integers(0, 200, len(vectors))]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids, queries, read = np.arange(len(vectors)), np.arange(0, len(vectors), 1500), []
    found = {q: [] for q in range(len(queries))}
    for first in range(0, len(vectors), blocks.DATA_ROWS):
        part = slice(first, first + blocks.DATA_ROWS)
        at_query, at_row, scores = collision.collide(ids[queries], vectors[queries], ids[part], vectors[part], 20, read=read)
        for q, row, score in zip(at_query, at_row, scores, strict=True):
            found[q].append((-score, first + row))
    hits = 0
    for k, q in enumerate(queries):
        exact = vectors @ vectors[q]
        exact[q] = -np.inf
        hits += len(set(np.argsort(-exact)[:20]) & {row for _, row in sorted(found[k])[:20]})
    # Without any structure the nearest are hardly nearer than the rest.
    assert hits >= (0.9 if spread == "clusters" else 0.8) * 20 * len(queries)
    assert sum(read) < 0.2 * len(queries) * len(vectors)


def test_exact_top_k_of_the_largest_doubles(spark, work):
    rows = [(0, [1.7e308, 1.0]), (1, [1.7e308, -2.5]), (2, [-1.7e308, 0.0]), (3, [0.25, 1e300]), (4, [1e-3, 2.0])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    found = vafile.exact_top_k(docs, work, every=1, k=10).collect()
    whole = lambda v: [math.floor(1024 * Fraction(x)) for x in v]
    clip = lambda n: max(-(2**63), min(2**63 - 1, n))
    score = lambda a, b: sum(x * y for x, y in zip(whole(a), whole(b), strict=True))
    want = {}
    for q, v in rows:
        ranked = sorted((-clip(score(v, w)), i) for i, w in rows if i != q)
        want |= {(q, n): (i, -s) for n, (s, i) in enumerate(ranked, 1)}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == want


def test_an_index_serves_all_queries_of_a_group(spark, work, monkeypatch):
    """However many parts the queries come in, a block's index is made once for them."""
    for name, value in [("DATA_ROWS", 150), ("QUERY_ROWS", 2)]:
        monkeypatch.setattr(blocks, name, value)
    made_indexes = spark.sparkContext.accumulator(0)

    def index(ids, vectors):
        made_indexes.add(1)
        assert (np.diff(ids) > 0).all()
        return lambda query_ids, queries: vafile.top_k(query_ids, queries, ids, vafile.CellFile(vectors), 3)

    rows = [(k, [float(k % 7), float(k % 5)]) for k in range(600)]
    vectors = blocks.usable_vectors(made(spark, rows), "vec_id", "embedding", zero=True)
    found = blocks.search_in_blocks(vectors, 10, 3, index, "long", work).collect()
    want = exact(dict(rows), 10, 3, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == want
    assert made_indexes.value == 4


def test_no_vectors(spark, work):
    assert vafile.exact_top_k(made(spark, []), work).collect() == []
    assert collision.nearest(made(spark, []), work.__class__(spark, "none")).collect() == []
