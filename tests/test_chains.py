import random

import pytest
from conftest import plan_of

from millrace.operators import chains

EDGES = [("Kol", "Ban"), ("Del", "Kol"), ("Ban", "Ran"), ("Koc", "Mum"), ("Mum", "Che")]


def frame(spark, edges, kind="string"):
    return spark.createDataFrame(edges, f"src {kind}, dst {kind}")


def expected(edges):
    forward, backward = {}, {}
    for s, d in edges:
        forward[s] = min(d, forward.get(s, d))
    for s, d in forward.items():
        backward[d] = min(s, backward.get(d, s))

    def follow(node, step):
        seen = set()
        while node in step:
            if node in seen:
                return None
            seen.add(node)
            node = step[node]
        return node

    nodes = set(forward) | set(forward.values())
    return {n: (follow(n, backward), follow(n, forward)) for n in nodes}


def run(spark, work, edges, kind="string", **options):
    found = chains.chain_endpoints(frame(spark, edges, kind), work, **options).collect()
    assert len({r.node for r in found}) == len(found)
    for r in found:
        assert r.in_cycle == (r.origin is None or r.terminal is None)
    return {r.node: (r.origin, r.terminal) for r in found}


def test_worked_example(spark, work):
    ends = chains.chain_endpoints(frame(spark, EDGES), work)
    asked = spark.createDataFrame(
        [("Ban", "Mum"), ("Ran", "Ran"), ("X", "Y"), (None, None)],
        "source string, destination string",
    )
    got = [tuple(r) for r in chains.chain_lookup(asked, ends).collect()]
    assert sorted(got, key=str) == sorted(
        [
            ("Ban", "Mum", "Del", "Che"),
            ("Ran", "Ran", "Del", "Ran"),
            ("X", "Y", chains.NO_SOURCE, chains.NO_DESTINATION),
            (None, None, chains.NO_SOURCE, chains.NO_DESTINATION),
        ],
        key=str,
    )


@pytest.mark.parametrize(
    "edges",
    [
        [(1, 2), (2, 3), (3, 1), (4, 1), (5, 4), (7, 8)],
        [(1, 1)],
        [(1, 2), (1, 3), (3, 4), (0, 4)],
        [(i, i + 1) for i in range(100)],
        [(i, 0) for i in range(1, 50)] + [(0, 100), (100, 101), (101, 102)],
        [(1, 2), (1, 2), (2, 1)],
        [(1, None), (None, 2), (3, 4)],
    ],
    ids=["cycle with tail", "loop", "branches", "path", "broom", "two cycle", "null ends"],
)
def test_shapes(spark, work, edges):
    whole = [e for e in edges if None not in e]
    assert run(spark, work, edges, "int") == expected(whole)


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_random_graphs_match_brute_force(spark, work, broadcast):
    pick = random.Random(5)
    edges = [(pick.randrange(400), pick.randrange(400)) for _ in range(250)]
    edges += [(1000 + i, 1000 + i // 2) for i in range(2, 200)]
    edges += [(2000 + i, 2001 + i) for i in range(70)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert run(spark, work, edges, "int") == expected(edges)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cycles_are_labelled(spark, work):
    ends = chains.chain_endpoints(frame(spark, [("a", "b"), ("b", "a"), ("c", "a")]), work)
    asked = spark.createDataFrame([("c", "c"), ("a", "b")], "source string, destination string")
    got = sorted(tuple(r) for r in chains.chain_lookup(asked, ends).collect())
    assert got == [("a", "b", chains.CYCLE, chains.CYCLE), ("c", "c", "c", chains.CYCLE)]


def test_hot_requests(spark, work):
    ends = chains.keep(chains.chain_endpoints(frame(spark, EDGES), work), work, "ends")
    asked = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'Ban', concat('u', id)) as source", "'Mum' as destination"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = chains.chain_lookup(asked, ends)
        assert out.count() == 3000
        assert out.where("final_source = 'Del' and final_destination = 'Che'").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_round_is_one_write(spark, work):
    """Depth 64 takes seven rounds; counts come with the writes."""
    edges = frame(spark, [(i, i + 1) for i in range(64)])
    spark.sparkContext.setJobGroup("chain-rounds", "")
    chains.chain_endpoints(edges, work)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chain-rounds")
    assert len(jobs) <= 40
