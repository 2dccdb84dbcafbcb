"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.frames import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour to the smallest of a node's neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them; ``u`` is the larger end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (
        moved.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionAll(least.select("u", F.col("m").alias("v"))).distinct()
    )


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges`` has ``u`` and ``v`` of any ordered type; returns (node, root), root the least node reachable.

    Nodes without an edge are absent. Each round is written to the shared folder, where it replaces the one before; the number of
    rounds grows with the logarithm of the longest path, and no round gathers a component in one place.
    """
    directed = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = Scratch(spark)
    current = before.staged(directed, "links")
    state_of = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    state = state_of(current)
    while True:
        after = Scratch(spark)
        current = after.staged(_small_star(_large_star(current)), "links")
        before.clear()
        before, last, state = after, state, state_of(current)
        if state == last:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
