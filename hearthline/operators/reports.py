"""Summary statistics, labelled facts and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.timeline import ANCHOR_YEAR, fiscal_index
from hearthline.operators.ranks import quantile_cuts

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def describe(df: DataFrame, column: str, groups: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of an integer column."""
    groups = groups or []
    n = F.count(column)
    basic = df.groupBy(*groups).agg(
        n.alias("count"), F.round(F.sum(column) / n, 4).alias("mean"),
        F.round(F.stddev_samp(column), 2).alias("stddev"), F.min(column).alias("min"),
        F.max(column).alias("max"))
    cuts = quantile_cuts(df.where(F.col(column).isNotNull()), groups, column, QUARTILES)
    if groups:
        return basic.join(cuts, groups)
    row = cuts.first()
    return basic.withColumns({name: F.lit(row[name]) for name in QUARTILES})


def facts_with_labels(df: DataFrame, keys: list[str], labels: list[str], sums: dict[str, Column],
                      count: str) -> DataFrame:
    """Row count, sums, and one value of each descriptive column per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count), *[F.max(c).alias(c) for c in labels],
        *[F.sum(c).alias(name) for name, c in sums.items()])


def week_buckets(df: DataFrame, date: str, size: int) -> DataFrame:
    """Rows per fiscal week, and the weeks of each year numbered into buckets of ``size``.

    Rows are counted per week before the window, which then sees one year of weeks.
    """
    weeks = df.groupBy(fiscal_index(date).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    year = F.floor(F.col("_w") / 52).cast("int") + ANCHOR_YEAR
    order = Window.partitionBy("fiscal_year").orderBy("week_of_year")
    return (weeks.select(year.cast("string").alias("fiscal_year"),
                         F.pmod("_w", F.lit(52)).alias("week_of_year"), "n")
            .withColumn("bucket", F.ceil(F.row_number().over(order) / size).cast("int")))


def stable_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows chosen by the hash of their key: random, yet the same on every run."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
