"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import saved


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root is the smallest node reachable.

    Each half step is an aggregation to one minimum a node and a join, so no neighbourhood is
    ever gathered in one place; the join on a hub splits under AQE. Every round is written to the
    shared folder. Stops when every node hangs directly on its root; raises if it does not get
    there within ``rounds`` (rounds grow with the logarithm of the longest path).
    """
    current = saved(_ordered(edges), "edges")
    for _ in range(rounds):
        large = saved(_star(_both(current), larger=True), "large")
        small = saved(_star(large, larger=False), "small")
        if _finished(small):
            return small.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                small.select("lo", "lo")).distinct()
        current = small
    raise RuntimeError("components did not converge")


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Connect the (larger, or smaller) neighbours of each node to its smallest neighbour."""
    least = pairs.groupBy("hi").agg(F.min("lo").alias("least")).withColumn("least", F.least("hi", "least"))
    joined = pairs.join(least, "hi")
    if larger:
        moved = joined.where("lo > hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    else:
        moved = joined.select(F.col("lo").alias("hi"), F.col("least").alias("lo")).union(joined.select("hi", "least"))
    return moved.where("hi <> lo").distinct()


def _finished(pairs: DataFrame) -> bool:
    """Every node has one parent and no parent is a child."""
    two = pairs.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").limit(1)
    chained = pairs.select(F.col("lo").alias("hi")).join(pairs.select("hi"), "hi", "left_semi").limit(1)
    return two.isEmpty() and chained.isEmpty()
