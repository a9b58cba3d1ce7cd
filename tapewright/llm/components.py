"""Connected components of a link table, by shuffles of bounded groups.

Alternating large-star and small-star steps (Kiveris et al., 2014): every node is linked to the
smallest node among its neighbours, by group minima that are combined before the shuffle, so a hub
is never gathered in one task. Each step is a written table, so lost executors cost no lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return larger.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and that one on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes with a link. ``edges``: a, b (integers)."""
    now = materialize(edges.where("a <> b").select("a", "b").distinct(), "links")
    while True:
        now = materialize(_small_star(_large_star(now)), "stars")
        if _settled(now):
            break
    found = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    return found.unionByName(roots)
