"""Connected components of a table of links, by spreading the smallest label."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep
from millrace.session import Workspace


def connected_components(links: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``), without NULLs.

    ``root`` is the smallest node of the component. In each round a node takes
    the smallest label among itself and its neighbours, and then the label of
    that label, so distances shrink geometrically. Rounds are written to the
    shared folder; the driver sees one number a round.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = keep(both.where("a <> b").distinct(), work, f"{name}_edges")
    first = edges.groupBy("a").agg(F.min("b").alias("low"))
    labels = keep(
        first.select(F.col("a").alias("node"), F.least("a", "low").alias("root")), work, f"{name}_0"
    )
    for turn in count(1):
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        better = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        moved = keep(
            better.join(jump, "mid").select(
                "node", F.least("mid", "far").alias("root"), (F.least("mid", "far") != F.col("old")).alias("moved")
            ),
            work,
            f"{name}_{turn}",
        )
        labels = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return labels
