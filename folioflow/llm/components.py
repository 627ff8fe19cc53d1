"""Connected components by alternating large-star and small-star steps.

Each step is an aggregation and a join on node ids.  The minima are pre-aggregated, and written before the join, so
that the adaptive join can split the edges of a node with very many neighbours.  After each round the edges are
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import table


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's smallest neighbour."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = table(down.groupBy("u").agg(F.min("v").alias("m")), "minima")
    joined = down.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for each node of edges (u, v) that isn't the smallest itself.

    Self-loops, repeated edges and edges in both directions are allowed; nulls are left out."""
    current = table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _digest(current)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        current = table(_small_star(table(_large_star(current), "edges")), "edges")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
