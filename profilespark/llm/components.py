"""Connected components of an edge table by alternating large and small stars, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its smallest node.

    Each round keeps at most one row per edge and joins it to one minimum per node, so no node's
    neighbours are ever in one row. The number of rounds grows with the logarithm of a component's width.
    """
    edges = materialize(_both(edges).filter("u > v").distinct())
    before = None
    while True:
        stars = _small_star(_large_star(edges))
        edges = materialize(stars)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    inner = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return inner.unionByName(inner.select(F.col("component").alias("node"), "component").distinct())


def _both(edges: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to the smallest of its neighbourhood."""
    ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = ways.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, are tied to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
