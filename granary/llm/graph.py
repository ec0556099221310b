"""Connected components by alternating stars, on data of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node, joined to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, joined to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Smallest node reachable from each node that has an edge, as (node, component).

    ``edges`` has columns a and b, in any direction. Each round is written to the
    shared folder, and edges never get more. A hub's edges are summed map side,
    and its joins are skewed joins that adaptive execution splits. The number of
    rounds grows with the logarithm of a component's size.
    """
    now = stage(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        now = stage(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40)), F.sum(F.col("b") % (1 << 40))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components are not settled after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
