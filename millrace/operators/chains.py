"""End points of chains in a table of directed edges, by pointer doubling.

Every node keeps one pointer along its chain. In each round a pointer jumps to
where the node it points at points to, so its reach doubles and a chain of
depth d is resolved in about log2(d) rounds. Only nodes that still move are
joined and written again; each round is a table in the shared folder, which
cuts the lineage and survives the loss of executors.

Nodes may have one outgoing and one incoming edge that counts: where the table
holds several, the smallest neighbour is taken. Edges with a NULL end are not
edges and are left out.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.lookup import lookup_join
from millrace.session import Workspace

# What a lookup answers for a node no edge mentions.
NO_SOURCE = "No Source Found"
NO_DESTINATION = "No Destination Found"
CYCLE = "CYCLE"


def keep(df: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage."""
    path = work.path(name)
    df.write.parquet(path)
    return work.spark.read.schema(df.schema).parquet(path)


def chain_endpoints(
    edges: DataFrame,
    work: Workspace,
    *,
    src: str = "src",
    dst: str = "dst",
) -> DataFrame:
    """First and last node of the chain through every node of the edge table.

    Gives ``node``, ``origin`` and ``terminal``, with NULL for an end that a
    cycle keeps out of reach and ``in_cycle`` telling so. ``work`` holds the
    round tables the result reads; drop it when the result has been used.
    """
    ends = edges.select(F.col(src).alias("n"), F.col(dst).alias("p"))
    ends = ends.where("n IS NOT NULL AND p IS NOT NULL")
    onward = ends.groupBy("n").agg(F.min("p").alias("p"))
    back = onward.groupBy(F.col("p").alias("n")).agg(F.min("n").alias("p"))
    # Both directions are followed in the same rounds.
    pointers = onward.select(F.lit(True).alias("onward"), "n", "p").unionAll(
        back.select(F.lit(False).alias("onward"), "n", "p")
    )
    found = follow(keep(pointers, work, "pointers"), work)

    last = found.where("onward").alias("last")
    first = found.where("NOT onward").alias("first")
    both = last.join(first, F.col("last.n") == F.col("first.n"), "full")
    node = F.coalesce("last.n", "first.n")
    # A side without a row has no pointer at all: the node is its own end there.
    ended = F.col("last.n").isNull()
    begun = F.col("first.n").isNull()
    origin = F.when(begun, node).otherwise(F.col("first.p"))
    terminal = F.when(ended, node).otherwise(F.col("last.p"))
    return both.select(
        node.alias("node"),
        origin.alias("origin"),
        terminal.alias("terminal"),
        (origin.isNull() | terminal.isNull()).alias("in_cycle"),
    )


def chain_lookup(
    requests: DataFrame,
    endpoints: DataFrame,
    *,
    source: str = "source",
    destination: str = "destination",
) -> DataFrame:
    """Adds ``final_source`` and ``final_destination`` to every request.

    Unknown nodes and cycles are answered with their labels, so both are text.
    ``endpoints`` is read once per question; hand in a kept result.
    """
    answers = endpoints.select(
        "node",
        F.coalesce(F.col("origin").cast("string"), F.lit(CYCLE)).alias("_origin"),
        F.coalesce(F.col("terminal").cast("string"), F.lit(CYCLE)).alias("_terminal"),
    )

    def add(df: DataFrame, asked: str, found: str, label: str, out: str) -> DataFrame:
        kept = [F.col(f"target.`{c}`") for c in df.columns]
        answer = F.coalesce(F.col(f"source.{found}"), F.lit(label)).alias(out)
        return lookup_join(
            df,
            answers.select("node", found),
            [(asked, "node")],
            project=lambda joined: joined.select(*kept, answer),
        )

    with_source = add(requests, source, "_origin", NO_SOURCE, "final_source")
    return add(with_source, destination, "_terminal", NO_DESTINATION, "final_destination")


def follow(pointers: DataFrame, work: Workspace, name: str = "rounds") -> DataFrame:
    """(onward, n, p): the end of each pointer chain, NULL where it meets a cycle.

    ``name`` is the folder of the rounds in ``work``, one for each call.
    """
    spark, folder = work.spark, work.path(name)
    plain = pointers.schema
    added = [T.StructField("round", T.IntegerType()), T.StructField("arrived", T.BooleanType())]
    stored = T.StructType([*plain.fields, *added])

    def jump(rows: DataFrame, lookup: DataFrame, how: str) -> DataFrame:
        # Whoever points at a node without a pointer has arrived.
        return lookup_join(
            rows,
            lookup,
            [("onward", "onward"), ("p", "n")],
            how=how,
            project=lambda joined: joined.select(
                "target.onward",
                "target.n",
                F.coalesce("source.p", "target.p").alias("p"),
                F.coalesce("source.arrived", F.lit(True)).alias("arrived"),
            ),
        )

    def store(state: DataFrame, number: int) -> tuple[DataFrame, DataFrame | None, int]:
        """Keep a round; gives all that later rounds look up, who moves, how many."""
        path = f"{folder}/round={number}"
        # Counted while it is written: no job of its own.
        seen = Observation()
        counted = state.observe(seen, F.count_if(~F.col("arrived")).alias("left"))
        counted.write.partitionBy("arrived").parquet(path)
        left = seen.get["left"]
        rounds = spark.read.schema(stored).parquet(folder)
        lookup = rounds.where(f"arrived OR round = {number}")
        # Read from its own folder, the moving part shows Spark its true size.
        moving = spark.read.schema(plain).parquet(f"{path}/arrived=false") if left else None
        return lookup, moving, left

    # The first round only finds who has arrived already.
    nowhere = F.lit(None).cast(plain["p"].dataType).alias("p")
    start = pointers.select("onward", "n", nowhere, F.lit(False).alias("arrived"))
    lookup, moving, left = store(jump(pointers, start, "left"), 0)
    for number in count(1):
        if not left:
            break
        # Nodes that move point at nodes with a pointer: an inner join matches
        # all, and lets Spark broadcast the moving side once few are left, so
        # that late rounds shuffle nothing.
        before = left
        lookup, moving, left = store(jump(moving, lookup, "inner"), number)
        if left == before:
            # Depths have no gaps, so a round that resolves none leaves only
            # nodes in a cycle or on the way into one.
            break
    return lookup.select("onward", "n", F.when(F.col("arrived"), F.col("p")).alias("p"))
