import random

import pytest
from test_chains import expected, frame

from millrace.operators import chain_state, chains


def ends(state):
    rows = state.collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: (r.origin, r.terminal) for r in rows}


def after(spark, work, edges, added, removed, kind="int"):
    """The state after a batch, and the changed rows; checked against a full run."""
    before = frame(spark, edges, kind)
    state = chains.keep(chain_state.build(before, work), work, "state")
    whole = [e for e in edges if None not in e]
    assert ends(state) == expected(whole)
    changed = chain_state.changes(
        state, before, work, added=frame(spark, added, kind), removed=frame(spark, removed, kind)
    )
    changed = chains.keep(changed, work, "changed")
    left = [e for e in whole if e not in removed] + [e for e in added if None not in e]
    new = chain_state.apply(state, changed)
    assert ends(new) == expected(left)
    forward = {}
    for s, d in left:
        forward[s] = min(d, forward.get(s, d))
    assert {r.node: r.next for r in new.collect() if r.next is not None} == forward
    return changed


PATH = [(i, i + 1) for i in range(40)]


CASES = [
    (PATH, [(40, 41)], []),
    (PATH, [(-1, 0)], []),
    (PATH, [], [(20, 21)]),
    (PATH, [], PATH),
    ([], PATH, []),
    (PATH, [(40, 0)], []),
    (PATH + [(40, 0)], [], [(7, 8)]),
    (PATH + [(40, 0), (100, 3), (101, 100)], [(101, 102)], [(7, 8), (100, 3)]),
    (PATH, [(20, 5)], []),
    ([(1, 2), (1, 3), (3, 4), (0, 4)], [], [(1, 2)]),
    ([(1, 2), (1, 2)], [(2, 3)], [(1, 2)]),
    ([(1, 2)], [(1, 2), (None, 4), (4, None)], [(1, 2), (9, 9)]),
    ([(1, 2), (5, 6)], [(2, 5), (6, 1)], []),
    ([(1, 1)], [(1, 0)], []),
    ([(1, 2)], [], []),
]


def shifted(edges, by):
    return [tuple(n if n is None else n + by for n in e) for e in edges]


def test_batches_of_many_kinds_at_once(spark, work):
    parts = [[], [], []]
    for number, case in enumerate(CASES):
        for part, edges in zip(parts, case, strict=True):
            part += shifted(edges, 1000 * number)
    after(spark, work, *parts)


@pytest.mark.parametrize("number", [3, 4, 7, 14], ids=["all gone", "from nothing", "cycle cut", "no batch"])
def test_one_batch(spark, work, number):
    after(spark, work, *CASES[number])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_equal_a_full_run(spark, work, seed):
    pick = random.Random(seed)
    edges = [(pick.randrange(150), pick.randrange(150)) for _ in range(100)]
    edges += [(1000 + i, 1000 + i // 2) for i in range(2, 80)]
    edges += [(2000 + i, 2001 + i) for i in range(50)]
    nodes = sorted({n for e in edges for n in e}) + [5000, 5001]
    added = [(pick.choice(nodes), pick.choice(nodes)) for _ in range(12)]
    after(spark, work, edges, added, pick.sample(edges, 12))


def test_only_touched_chains_change(spark, work):
    edges = [(100 * k + i, 100 * k + i + 1) for k in range(50) for i in range(9)]
    changed = after(spark, work, edges, [(9, 100), (700, 1)], [(304, 305)])
    assert {r.node // 100 for r in changed.collect()} <= {0, 1, 3, 7}


def test_several_batches_of_text(spark, work):
    edges = [("a", "b"), ("c", "d")]
    after(spark, work, edges, [("b", "c"), ("", "a")], [("c", "d")], kind="string")
