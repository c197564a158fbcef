"""Joins and set operations that come up in several audiences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Share of each row in the total of its group, for rows that are already aggregated."""
    total = F.sum(value).over(Window.partitionBy(*groups))
    return df.withColumn("share", F.round(F.col(value) / total, 6))


def conflicting_payloads(df: DataFrame, key: str) -> DataFrame:
    """Keys stored with several different payloads.

    Counting distinct payloads per key finds what a self-join on the key with
    unequal payloads finds, without pairing the copies of a key.
    """
    payload = [c for c in df.columns if c != key]
    distinct = df.groupBy(key, *payload).agg(F.count(F.lit(1)).alias("_n"))
    return (distinct.groupBy(key).agg(F.count(F.lit(1)).alias("payloads"), F.sum("_n").alias("rows"))
            .where(F.col("payloads") > 1))


def tagged_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """Rows of several lists with the name of the list they came from."""
    out = None
    for name, part in parts.items():
        part = part.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def in_both(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Distinct rows present in both."""
    return left.join(right, on, "left_semi").distinct()


def set_overlap(left: DataFrame, right: DataFrame, key: str, name: str = "rows") -> DataFrame:
    """Number of distinct keys in both sets and in only one of them."""
    sides = left.select(key, F.lit(1).alias("_s")).unionByName(right.select(key, F.lit(2).alias("_s")))
    seen = sides.groupBy(key).agg(F.bit_or("_s").alias("_s"))
    part = F.when(F.col("_s") == 3, "common").when(F.col("_s") == 1, "left only").otherwise("right only")
    return seen.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias(name))
