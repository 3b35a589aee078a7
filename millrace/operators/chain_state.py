"""End points of chains kept up to date as edges come and go.

The state has one row per node: ``node``, ``next`` and ``previous`` (its pointers),
``origin`` and ``terminal`` (where they lead, NULL into a cycle). A batch of edges
moves few pointers, and only chains that hold one of them are looked at:

* A chain whose end gets a pointer is contracted to that end. All its nodes take
  what the end resolves to, in a graph of the batch's size.
* A chain that is cut is followed anew, with the moved pointers left out, up to
  the cuts; these are then ends as above.

The result are the rows that change. A chain is all that leads to one end, so a
cut in a large tree looks at that tree, and one in a cycle at whatever leads into
cycles; no other row is joined to more than the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.chains import follow, keep
from millrace.operators.lookup import lookup_join
from millrace.session import Workspace

COLUMNS = ["node", "next", "previous", "origin", "terminal"]


def _edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    ends = edges.select(F.col(src).alias("n"), F.col(dst).alias("p"))
    return ends.where("n IS NOT NULL AND p IS NOT NULL")


def build(edges: DataFrame, work: Workspace, *, src: str = "src", dst: str = "dst") -> DataFrame:
    """The state of an edge table, with the end points of ``chains.chain_endpoints``.

    It reads the tables of ``work``; write it before ``work`` is dropped.
    """
    onward = _edges(edges, src, dst).groupBy("n").agg(F.min("p").alias("p"))
    back = onward.groupBy(F.col("p").alias("n")).agg(F.min("n").alias("p"))
    both = onward.select(F.lit(True).alias("onward"), "n", "p").unionAll(
        back.select(F.lit(False).alias("onward"), "n", "p")
    )
    pointers = keep(both, work, "state_pointers")
    ends = follow(pointers, work, "state_rounds").withColumnRenamed("p", "end")
    rows = pointers.join(ends, ["onward", "n"]).withColumnRenamed("n", "node")

    def one(onward: bool, column: str):
        return F.max(F.when(F.col("onward") == onward, F.col(column)))

    # Without a pointer a node is its own end.
    def end(onward: bool):
        has = F.count_if(F.col("onward") == onward) > 0
        return F.when(has, one(onward, "end")).otherwise(F.col("node"))

    return rows.groupBy("node").agg(
        one(True, "p").alias("next"),
        one(False, "p").alias("previous"),
        end(False).alias("origin"),
        end(True).alias("terminal"),
    )


def changes(
    state: DataFrame,
    edges: DataFrame,
    work: Workspace,
    *,
    added: DataFrame,
    removed: DataFrame,
    src: str = "src",
    dst: str = "dst",
) -> DataFrame:
    """Rows of the state that a batch changes, with ``gone`` for nodes without an edge left.

    ``edges`` is the table before the batch and ``state`` was made from it, as a kept
    table. All copies of a removed edge go; an edge both removed and added is there.
    """
    moved = keep(_moved(state, edges, added, removed, src, dst), work, "moved")
    forms = [("next", "terminal", True), ("previous", "origin", False)]
    sides = [
        state.select(
            F.lit(onward).alias("onward"),
            F.col("node").alias("n"),
            F.col(pointer).alias("p"),
            F.col(end).alias("end"),
        )
        for pointer, end, onward in forms
    ]
    long = sides[0].unionAll(sides[1])
    key = ["onward", "n"]

    # Chains that are cut, by their ends; NULL stands for those into cycles.
    cut = moved.where("before IS NOT NULL").select(*key)
    hit = lookup_join(long, cut, [("onward", "onward"), ("n", "n")], how="inner", project=_target)
    groups = keep(hit.select("onward", "end").distinct(), work, "groups")
    same = (F.col("l.onward") == F.col("g.onward")) & F.col("l.end").eqNullSafe(F.col("g.end"))

    def in_groups(how: str) -> DataFrame:
        return long.alias("l").join(groups.alias("g"), same, how).select("l.*")

    inside = keep(in_groups("left_semi"), work, "inside")
    rest = inside.where("p IS NOT NULL").join(cut, key, "left_anti").select("onward", "n", "p")
    led = follow(keep(rest, work, "rest"), work, "rest_rounds")
    reached = _looked_up(inside, led, "n", own="n").select(*key, "end", F.col("found").alias("reach"))
    reached = keep(reached, work, "reached")

    # Every moved pointer leads from an end to where its target reached before.
    steps = moved.where("after IS NOT NULL").select("onward", "n", F.col("after").alias("y"))
    wanted = steps.select("onward", F.col("y").alias("n")).distinct()
    of_state = lookup_join(
        long, wanted, [("onward", "onward"), ("n", "n")], how="inner", project=_target
    )
    known = of_state.join(reached.select(*key, "reach"), key, "left_anti").select(*key, "end")
    known = known.unionAll(
        reached.join(wanted, key, "left_semi").select(*key, F.col("reach").alias("end"))
    ).withColumnRenamed("end", "p")
    led = _looked_up(steps, known, "y", own="y")
    # What leads into a cycle is made a cycle of its own.
    contracted = led.select("onward", "n", F.coalesce("found", "n").alias("p"))
    ends = keep(follow(keep(contracted, work, "contracted"), work, "end_rounds"), work, "ends")

    # All whose end may be another one: cut chains, chains with a moved end, new nodes.
    whole = in_groups("left_anti")
    lengthened = lookup_join(
        whole,
        ends.select("onward", F.col("n").alias("end")),
        [("onward", "onward"), ("end", "end")],
        how="inner",
        project=_target,
    ).select(*key, "end", F.col("end").alias("reach"))
    nodes = moved.select("n").unionAll(moved.where("after IS NOT NULL").select("after")).distinct()
    new = nodes.join(state.select(F.col("node").alias("n")), "n", "left_anti")
    fresh = new.select(F.explode(F.array(F.lit(True), F.lit(False))).alias("onward"), "n")
    fresh = fresh.select(*key, F.lit(None).cast(state.schema["node"].dataType), F.col("n"))
    candidates = reached.unionAll(lengthened).unionAll(fresh)
    ended = _looked_up(candidates, ends, "reach", own="reach")
    ended = ended.where(~F.col("found").eqNullSafe(F.col("end")))
    return _patched(state, moved, ended)


def apply(state: DataFrame, changed: DataFrame) -> DataFrame:
    """The state after the batch."""
    rest = state.join(changed.select("node"), "node", "left_anti").select(COLUMNS)
    return rest.unionAll(changed.where("NOT gone").select(COLUMNS))


def _target(joined: DataFrame) -> DataFrame:
    return joined.select("target.*")


def _looked_up(rows: DataFrame, ends: DataFrame, by: str, own: str) -> DataFrame:
    """``rows`` with ``found``: what ``ends`` (onward, n, p) has for ``by``, else ``own``."""
    marked = ends.select("onward", "n", "p", F.lit(True).alias("there"))
    found = F.when(F.col("source.there"), F.col("source.p")).otherwise(F.col(f"target.{own}"))
    return lookup_join(
        rows,
        marked,
        [("onward", "onward"), (by, "n")],
        project=lambda joined: joined.select("target.*", found.alias("found")),
    )


def _moved(
    state: DataFrame, edges: DataFrame, added: DataFrame, removed: DataFrame, src: str, dst: str
) -> DataFrame:
    """(onward, n, before, after): pointers that the batch changes."""
    gone, put = _edges(removed, src, dst).distinct(), _edges(added, src, dst).distinct()
    named = put.select("n").unionAll(gone.select("n")).distinct()
    held = lookup_join(_edges(edges, src, dst), named, [("n", "n")], how="inner", project=_target)
    left = held.distinct().join(gone, ["n", "p"], "left_anti").unionAll(put)
    after = left.groupBy("n").agg(F.min("p").alias("after"))

    def changed(asked: DataFrame, column: str, after: DataFrame) -> DataFrame:
        rows = state.select(F.col("node").alias("n"), F.col(column).alias("before"))
        before = lookup_join(rows, asked, [("n", "n")], how="inner", project=_target)
        both = asked.join(before, "n", "left").join(after, "n", "left")
        return both.where(~F.col("before").eqNullSafe(F.col("after")))

    onward = changed(named, "next", after)
    # Nodes that got or lost a pointer to them choose anew who comes before.
    asked = onward.select(F.explode(F.array("before", "after")).alias("n"))
    asked = asked.where("n IS NOT NULL").distinct()
    pairs = state.select(F.col("next").alias("n"), F.col("node").alias("p"))
    holders = lookup_join(pairs, asked, [("n", "n")], how="inner", project=_target)
    stay = holders.join(onward.select(F.col("n").alias("p")), "p", "left_anti").select("n", "p")
    come = onward.where("after IS NOT NULL").select(F.col("after").alias("n"), F.col("n").alias("p"))
    back = changed(asked, "previous", stay.unionAll(come).groupBy("n").agg(F.min("p").alias("after")))
    columns = ["n", "before", "after"]
    return onward.select(F.lit(True).alias("onward"), *columns).unionAll(
        back.select(F.lit(False).alias("onward"), *columns)
    )


def _patched(state: DataFrame, moved: DataFrame, ended: DataFrame) -> DataFrame:
    """Changed rows from moved pointers and from other ends, each (onward, n, ...)."""
    pointers = moved.select("n", "onward", F.lit(True).alias("is_pointer"), F.col("after").alias("v"))
    others = ended.select("n", "onward", F.lit(False).alias("is_pointer"), F.col("found").alias("v"))
    kinds = {"next": (True, True), "previous": (True, False), "terminal": (False, True), "origin": (False, False)}
    values = []
    for name, (is_pointer, onward) in kinds.items():
        chosen = (F.col("is_pointer") == is_pointer) & (F.col("onward") == onward)
        values += [
            F.max(F.when(chosen, F.col("v"))).alias(f"new_{name}"),
            (F.count_if(chosen) > 0).alias(f"has_{name}"),
        ]
    patch = pointers.unionAll(others).groupBy(F.col("n").alias("node")).agg(*values)
    both = patch.join(state, "node", "left")
    new = {n: F.when(F.col(f"has_{n}"), F.col(f"new_{n}")).otherwise(F.col(n)) for n in kinds}
    gone = new["next"].isNull() & new["previous"].isNull()
    return both.select("node", *[new[n].alias(n) for n in COLUMNS[1:]], gone.alias("gone"))
