"""Queries over chain end points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import chain_state, chains
from millrace.session import Workspace
from millrace.workloads.data import load, query

# Every event leads to the next one unless it is an error.
EVENT_EDGES = """
edges AS (SELECT event_id AS src, event_id + 1 AS dst FROM events WHERE event_type <> 'error')
"""

# Orders lead to customers, customers to nations, nations to regions, so that
# most chains end in one of a few nodes.
TREE_EDGES = """
edges AS (
  SELECT 'O' || o_orderkey AS src, 'C' || o_custkey AS dst FROM orders
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation)
"""

ENDPOINTS = """
forward AS (SELECT src, min(dst) AS dst FROM edges GROUP BY src),
backward AS (SELECT dst, min(src) AS src FROM forward GROUP BY dst),
terminals AS (
  SELECT dst AS node, dst AS terminal FROM backward
  WHERE dst NOT IN (SELECT src FROM forward)
  UNION ALL
  SELECT forward.src, terminals.terminal FROM terminals JOIN forward ON forward.dst = node),
origins AS (
  SELECT src AS node, src AS origin FROM forward
  WHERE src NOT IN (SELECT dst FROM backward)
  UNION ALL
  SELECT backward.dst, origins.origin FROM origins JOIN backward ON backward.src = node),
endpoints AS (SELECT node, origin, terminal FROM origins JOIN terminals USING (node))
"""


def event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").where("event_type <> 'error'")
    return events.select(F.col("event_id").alias("src"), (F.col("event_id") + 1).alias("dst"))


@query(f"WITH RECURSIVE {EVENT_EDGES}, {ENDPOINTS} SELECT * FROM endpoints")
def chain_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "chain_endpoints")
    found = chains.chain_endpoints(event_edges(spark, sf_dir), work)
    return found.select("node", "origin", "terminal")


@query(f"WITH RECURSIVE {TREE_EDGES}, {ENDPOINTS} SELECT * FROM endpoints")
def chain_tree_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "chain_tree")

    def edge(table: str, src: str, dst: str) -> DataFrame:
        rows = load(spark, sf_dir, table)
        return rows.select(F.expr(src).alias("src"), F.expr(dst).alias("dst"))

    edges = (
        edge("orders", "concat('O', o_orderkey)", "concat('C', o_custkey)")
        .unionAll(edge("customer", "concat('C', c_custkey)", "concat('N', c_nationkey)"))
        .unionAll(edge("nation", "concat('N', n_nationkey)", "concat('R', n_regionkey)"))
    )
    return chains.chain_endpoints(edges, work).select("node", "origin", "terminal")


@query(f"""
WITH RECURSIVE {EVENT_EDGES}, {ENDPOINTS},
requests AS (SELECT event_id AS request_id, event_id * 2 AS source,
                    event_id + user_id AS destination FROM events)
SELECT request_id, source, destination,
       coalesce(CAST(s.origin AS VARCHAR), 'No Source Found') AS final_source,
       coalesce(CAST(d.terminal AS VARCHAR), 'No Destination Found') AS final_destination
FROM requests LEFT JOIN endpoints s ON s.node = source
              LEFT JOIN endpoints d ON d.node = destination
""")
def chain_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event; many ask for nodes no edge mentions."""
    work = Workspace(spark, "chain_lookup")
    found = chains.chain_endpoints(event_edges(spark, sf_dir), work)
    endpoints = chains.keep(found, work, "endpoints")
    requests = load(spark, sf_dir, "events").selectExpr(
        "event_id as request_id", "event_id * 2 as source", "event_id + user_id as destination"
    )
    return chains.chain_lookup(requests, endpoints)


# Some edges go and some of the errors lead on after all.
CHANGED_EDGES = """
edges AS (SELECT event_id AS src, event_id + 1 AS dst FROM events
          WHERE CASE WHEN event_type = 'error' THEN event_id % 31 = 0 ELSE event_id % 499 <> 0 END)
"""


@query(f"WITH RECURSIVE {CHANGED_EDGES}, {ENDPOINTS} SELECT * FROM endpoints")
def chain_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of all chains, brought up to date with a batch of edges that come and go."""
    work = Workspace(spark, "chain_update")
    edges = event_edges(spark, sf_dir)
    state = chains.keep(chain_state.build(edges, work), work, "state")
    events = load(spark, sf_dir, "events")
    added = events.where("event_type = 'error' AND event_id % 31 = 0")
    changed = chain_state.changes(
        state,
        edges,
        work,
        added=added.selectExpr("event_id AS src", "event_id + 1 AS dst"),
        removed=edges.where("src % 499 = 0"),
    )
    changed = chains.keep(changed, work, "changed")
    return chain_state.apply(state, changed).select("node", "origin", "terminal")
