"""Connected components of a graph given as an edge table.

Alternating large-star and small-star rounds: every round is two aggregations
and two joins over the edges, the number of rounds grows with the logarithm of
the component size, and the edge table never grows. A node with very many
neighbours is reduced by map-side minimum before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.session import cut_lineage, discard


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(lowest, "u")
            .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(lowest, "b").select(F.col("m"), F.col("a").alias("v"))
    return (moved.unionByName(lowest.select("m", F.col("b").alias("v")))
            .where(F.col("m") != F.col("v"))
            .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 50) -> DataFrame:
    """Component of every node that has an edge: the smallest node it is linked to."""
    current = cut_lineage(
        edges.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"))
        .where(F.col("a") != F.col("b")).distinct())
    before = _fingerprint(current)
    for _ in range(max_rounds):
        following = cut_lineage(_small_star(_large_star(current)))
        discard(current)
        current = following
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    leaves = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.unionByName(roots)
