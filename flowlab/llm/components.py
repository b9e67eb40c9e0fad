"""Connected components of a graph, by alternating star steps (Kiveris et al., Connected Components in MapReduce)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlab.llm.tables import written

#: A node with more than this share of all edges is a hub, so there are at most as many hubs as its inverse.
HUB_SHARE = 1 / 1024


def _state(edges: DataFrame) -> tuple[int, int]:
    """Size and checksum; equal states of two rounds mean that nothing changed."""
    r = edges.select(F.xxhash64("u", "v").bitwiseAND((1 << 40) - 1).alias("h")).agg(F.count("*"), F.sum("h")).first()
    return r[0], r[1] or 0


def with_least(edges: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """``u, v, m`` and ``u, m``: each edge, and each node, with the least ``v`` of the edges from ``u``; ``rows``: edges.

    Least nodes are aggregated before the shuffle. Edges of hubs never move: at most 1 / ``HUB_SHARE`` hubs are broadcast.
    Those of all other nodes are joined by ``u``, no more than ``rows * HUB_SHARE`` under one key.
    """
    low = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least-neighbours")
    hub = F.col("n") > rows * HUB_SHARE
    hubs = F.broadcast(low.filter(hub).select(F.col("u").alias("hub"), "m"))
    marked = edges.join(hubs, F.col("u") == F.col("hub"), "left")
    at_hubs = marked.filter("hub is not null").select("u", "v", "m")
    elsewhere = marked.filter("hub is null").select("u", "v").join(low.filter(~hub).select("u", "m"), "u")
    return at_hubs.union(elsewhere.select("u", "v", "m")), low.select("u", "m")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that has an edge; a component is named by its smallest node.

    Each round points every larger neighbour, then every smaller one, to the smallest node in reach. Only minima of
    nodes are taken, no neighbourhood is gathered, and every round is written before the next. Edges with a null end and
    those from a node to itself are left out, repeated ones count once.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined, _ = with_least(both, 2 * state[0])
        large = joined.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = written(large, "large-star")
        joined, low = with_least(large, state[0])
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        # A node whose only neighbour is its minimum keeps that edge; others hand their neighbours on and keep it too.
        edges = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
