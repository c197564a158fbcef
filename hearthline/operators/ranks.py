"""Exact ranks and quantiles without sorting a whole group in one task.

A window ordered by value puts every row of a group into one task, and four
quarters of household spend make four such groups. Here rows are first counted
per distinct value. Each group is then cut into value ranges of ``RANGE``
consecutive integers, so a window task never holds more than ``RANGE`` rows, and
a second, much smaller window adds up the ranges. Values must be integers:
cents, counts, or a ratio scaled to a fixed number of decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.operators.skew import salted_lookup
from hearthline.session import cut_lineage

RANGE = 65_536


def value_positions(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """One row per distinct value: ``n`` rows, ``n_before`` below it, ``n_total``."""
    counts = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("_range", F.floor(F.col(value) / F.lit(RANGE)))
    keys = [*groups, "_range"]
    by_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))
    earlier = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        counts.groupBy(*keys).agg(F.sum("n").alias("_n"))
        .withColumn("_ranges_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("n_total", F.sum("_n").over(by_group))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("_inside_before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(ranges, keys)
        .select(*groups, value, "n",
                (F.col("_ranges_before") + F.col("_inside_before")).alias("n_before"), "n_total")
    )


def percent_rank_lookup(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """SQL ``percent_rank`` of every distinct value, with its number of rows ``n``.

    Join it back with :func:`hearthline.operators.skew.salted_lookup`.
    """
    rank = F.when(F.col("n_total") > 1, F.col("n_before") / (F.col("n_total") - 1)).otherwise(0.0)
    return value_positions(df, groups, value).select(*groups, value, "n", rank.alias(name))


def quantile_cuts(df: DataFrame, groups: list[str], value: str,
                  probabilities: dict[str, float]) -> DataFrame:
    """Exact discrete quantiles, one row per group and one column per name.

    The cut for p is the smallest value whose cumulative count reaches p of the
    group. All groups are cut in the same pass.
    """
    positions = value_positions(df, groups, value)
    reached = F.col("n_before") + F.col("n")

    def cut(p: float) -> Column:
        parts = round(p * 10_000)
        return F.min(F.when(reached * 10_000 >= F.col("n_total") * parts, F.col(value)))

    return positions.groupBy(*groups).agg(*[cut(p).alias(k) for k, p in probabilities.items()])


def with_descending_rank(df: DataFrame, groups: list[str], value: str, name: str,
                         spread: str) -> DataFrame:
    """Add SQL ``rank`` of ``value``, highest first, without one task sorting a group."""
    rank = F.col("n_total") - F.col("n_before") - F.col("n") + 1
    lookup = value_positions(df, groups, value).select(*groups, value, "n", rank.alias(name))
    return salted_lookup(df, lookup, [*groups, value], spread=spread, weight="n")


def row_positions(df: DataFrame, groups: list[str], order: str, name: str) -> DataFrame:
    """Number the rows of each group from 1 in the order of a column without repeats.

    Rows are dealt by ranges of group and order, so a large group is numbered by
    many tasks; a window over the few rows of parts per group adds the parts up.
    """
    keys = [*groups, order]
    dealt = cut_lineage(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*groups, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*groups, "_part").orderBy(order))
    return (dealt.withColumn("_own", own).join(before, [*groups, "_part"])
            .select(*df.columns, (F.col("_before") + F.col("_own")).alias(name)))
