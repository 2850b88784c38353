"""Connected components of an edge table, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of ``edges(a, b)``; the root is the least vertex.

    Each step takes minima of neighbours (combined before the shuffle) and joins them
    back on the vertex, so a vertex with very many neighbours is never gathered in a
    list.  The number of steps grows with the logarithm of the longest path.
    """
    edges = stored(_tidy(edges), "component_edges")
    last = None
    for _ in range(MAX_ROUNDS):
        edges = stored(_tidy(_small_star(_large_star(edges))), "component_edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("v")).distinct()
    return (edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
            .unionByName(roots.withColumn("root", F.col("v"))).distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges without loops, the larger vertex first."""
    a, b = F.col("a"), F.col("b")
    return (edges.filter(a != b)
            .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")) \
        .select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = _tidy(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))
