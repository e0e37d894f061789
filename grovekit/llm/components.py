"""Connected components by alternating large-star and small-star steps.

Each step replaces edges by edges to smaller ids: a node tells the smallest node of its
neighbourhood to its larger neighbours (large-star) or to its smaller ones (small-star).
The number of edges never grows and no neighbourhood is gathered: the smallest neighbour is
an aggregate with map-side combining, and edges are joined with it by key, where a hub's
edges can be split. Lineage is cut by reliable checkpoints after every round.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.session import cut_lineage

_EDGES_PER_TASK = 200_000


def _larger_first(edges):
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _both_ways(edges):
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges):
    """Smallest node of each neighbourhood, itself included."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges):
    both = _both_ways(edges)
    return _larger_first(both.join(_star(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges):
    low = _star(edges)
    return _larger_first(
        edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(low.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of ids, in any order, repeated or not; returns node, component (smallest id in reach).

    Nodes without an edge to another node are not listed. An empty table gives no rows.
    """
    edges = cut_lineage(_larger_first(edges))
    # The number of edges never grows, so that of the first ones bounds all rounds.
    tasks = 1 + edges.count() // _EDGES_PER_TASK
    edges = edges.coalesce(tasks)
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)).coalesce(tasks))
        # Done when every node points at a node that points nowhere, and only at that one.
        split = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        chained = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").select("u")
        if not split.select("u").unionByName(chained).limit(1).count():
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
