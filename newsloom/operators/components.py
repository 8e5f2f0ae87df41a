"""Connected components of a distributed edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(node, least): map-side combined, so a hub's edges don't meet in one task.

    Written, since AQE splits a skewed partition only of joins whose both sides are plain shuffles: behind an aggregate's
    exchange it can't. Where the table is below Spark's broadcast threshold, the edges aren't shuffled at all.
    """
    return materialise(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")), "least")


def _nodes(edges: DataFrame) -> DataFrame:
    """(node, least, up, root): the least of a node and its neighbours, its edges to smaller nodes, whether larger ones lead to it."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("least"), F.lit(1).alias("up"), F.lit(False).alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("least"), F.lit(0).alias("up"), F.lit(True).alias("root"))
    )
    return materialise(ends.groupBy("node").agg(F.min("least").alias("least"), F.sum("up").alias("up"), F.max("root").alias("root")), "nodes")


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge to another one. A written table.

    Loops and repeated edges don't matter; an edge with a null end is no edge; without edges the result is empty. Every
    edge runs from a larger to a smaller node and both steps keep what is connected, so the result is right, exactly,
    as soon as the edges are stars (every node is a root or has one edge, which leads to a root); that is what ends the
    loop. Each round is written to the shared folder, so lineage stays short; joins on hubs are inner joins that AQE can
    split. A round is four written tables and a look at one of them: what a job costs the driver counts, as graphs of few
    edges go through the same rounds.
    """
    now = edges.select(F.greatest(u, v).alias("u"), F.least(F.col(u), F.col(v)).alias("v"))
    now = materialise(now.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    while True:
        nodes = _nodes(now)
        if nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & F.col("root"))).isEmpty():
            return nodes.select("node", F.col("least").alias("component"))
        low = nodes.select("node", "least")
        # every edge runs from the larger to the smaller node, before and after
        large = now.join(low, now["v"] == low["node"]).select("u", F.col("least").alias("v"))
        large = materialise(large.distinct(), "large")
        low = _least_neighbour(large)
        others = large.join(low, large["u"] == low["node"]).where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        now = materialise(others.unionByName(low.select(F.col("node").alias("u"), F.col("least").alias("v"))).distinct(), "edges")
