"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Each step points nodes at the smallest node they know of; after a number of rounds that
grows with the logarithm of the longest path, every node points at the smallest node of
its component. Edges stay in Spark: each round is a few aggregations and joins on the
node, written as a table, so nothing is collected and a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._shared import materialise


def _round(edges: DataFrame) -> DataFrame:
    """edges (u, v) with u > v; the same components, closer to stars."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return small.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b); root is the smallest node of its component. Edges may repeat."""
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = materialise(_round(now), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
