"""Connected components of an edge table, by alternating star contractions.

Large-star links every larger neighbour of a node to the node's smallest
neighbour; small-star links the smaller ones.  Both are a grouped minimum
(combined map-side, so a hub's edges are reduced before the shuffle) and one
join back, which AQE can split when a hub is hot.  Each round is written
to the shared folder, until the edges are stars around the smallest nodes.
Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import shared_table


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def _is_star_forest(e: DataFrame) -> bool:
    """Every node on the left once and none on both sides: nothing to contract."""
    n = e.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("d")).first()
    return n["n"] == n["d"] and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of one orderable type -> (node, component) for every
    node with an edge to another node; the component is its smallest node.
    Self-loops, nulls and repeated edges are ignored."""
    e = edges.where(F.col("u") != F.col("v"))
    e = shared_table(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _is_star_forest(e):
        e = shared_table(_small_star(_large_star(e)), "stars")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
