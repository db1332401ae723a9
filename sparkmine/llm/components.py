"""Connected components of an edge table by alternating star rounds, all in joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import saved


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang every node's larger (or not larger) neighbours on the least of its neighbours and itself.

    ``edges`` have the larger node first; so has the result, which may repeat an edge.
    """
    near = _both(edges) if large else edges
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    hung = near.join(least, "a")
    if large:
        return hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and on one that hangs on none."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).filter("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a long, b long); comp is its component's least node.

    Each round is stored, so a lost executor costs one round; the number of rounds grows with the
    logarithm of the largest component. A node with very many neighbours is one key of a partial
    sum and of a join that Spark may split.
    """
    now = saved(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if _settled(now):
            break
        now = saved(_star(_star(now, large=True), large=False).distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
