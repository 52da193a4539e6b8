"""Connected components of an edge table by alternating stars.

Large-star links every larger neighbour of a node to its smallest neighbour,
small-star every smaller one; after O(log^2 n) rounds each node is linked to
the smallest node of its component.  Each round is a grouped minimum (with
partial sums in the tasks) and a join back, so a hub with most of the edges
is one aggregated row per task and a skew-split join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.llm import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v); result has u > v."""
    both = edges.union(edges.select("v", "u")) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    near = both.join(least, "u")
    if large:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.where("u <> m").select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none itself."""
    forks = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    chained = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    return not forks.union(chained).limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long): the smallest
    node reachable.  Each round is written to the shared folder."""
    now = common.written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .where("u <> v").distinct(), "edges")
    while not _is_stars(now):
        now = common.written(_star(_star(now, True), False), "edges")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
