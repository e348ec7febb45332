"""Connected components by alternating large-star and small-star.

Both steps keep the components and move edges towards each component's
smallest node; they end when the edges are stars.  Degrees are never gathered:
a node's smallest neighbour is a partial aggregate, and the join that spreads
it reads them from a staged table, one row a node, so Spark can split a hub's
rows on the other side.  Every
round is a staged table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaestor.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return (both.join(least.hint("merge"), "u").where("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or none and edges from above."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("above"))
            .unionAll(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("above"))))
    return (ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("above").alias("above"))
            .where("down > 1 or (down = 1 and above = 1)").isEmpty())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is
    its smallest node.  Loops and repeated edges do no harm; no edges, no rows."""
    now = staged(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _is_stars(now):
        now = staged(_small_star(staged(_large_star(now))))
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
