"""Connected components by alternating large-star and small-star rounds; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that the join below has plain exchanges on both sides and a hot node's edges can be split
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most and no node has edges both ways: all components are stars."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v): component is the smallest node reachable.

    Edges are undirected; loops, repeats and nulls are ignored.
    """
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        if _settled(now):
            break
        now = materialise(_small_star(_large_star(now)), "stars")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
