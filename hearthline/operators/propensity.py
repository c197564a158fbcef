"""Propensity labels: how strongly a household belongs to an audience."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.operators.ranks import quantile_cuts
from hearthline.operators.skew import lookup_join


def hml(value: Column, low: Column, high: Column) -> Column:
    """L below the low cut, H above the high cut, M between."""
    return F.when(value < low, "L").when(value > high, "H").otherwise("M")


def drop_returns(tx: DataFrame) -> DataFrame:
    """Keep items that were bought and paid for."""
    return tx.where(~F.col("is_return") & (F.col("net_cents") > 0))


def label_by_quantiles(totals: DataFrame, groups: list[str], value: str,
                       low: float = 0.33, high: float = 0.66) -> DataFrame:
    """Label every household by where its total lies within its group."""
    cuts = quantile_cuts(totals, groups, value, {"_low": low, "_high": high})
    # One row of cuts per audience: as many rows as there are definitions.
    return (totals.join(F.broadcast(cuts), groups)
            .withColumn("propensity", hml(F.col(value), F.col("_low"), F.col("_high")))
            .drop("_low", "_high"))


def percentile_propensity(tx: DataFrame, upc_lists: DataFrame, low: float = 0.33,
                          high: float = 0.66) -> DataFrame:
    """Spend per segment and household with its H/M/L label, all segments at once."""
    items = drop_returns(tx).select("hh_id", "upc", "net_cents")
    spend = (lookup_join(items, upc_lists, ["upc"], "hh_id")
             .groupBy("segment", "hh_id").agg(F.sum("net_cents").alias("spend_cents")))
    return label_by_quantiles(spend, ["segment"], "spend_cents", low, high)


def volume_propensity(items: DataFrame, type_column: str, volume: str, all_label: str,
                      rollup_only: list[str] | None = None) -> DataFrame:
    """Volume labels per sub-type and for all types together.

    Types in ``rollup_only`` count towards the total only. Each item is summed
    once; the total is added up from the per-type sums.
    """
    per_type = items.where(F.col(volume).isNotNull()).groupBy(type_column, "hh_id").agg(
        F.sum(volume).alias("volume"))
    total = per_type.groupBy("hh_id").agg(F.sum("volume").alias("volume"))
    kept = per_type.where(~F.col(type_column).isin(rollup_only or []))
    both = kept.unionByName(total.withColumn(type_column, F.lit(all_label)))
    return label_by_quantiles(both, [type_column], "volume")


def buyers_audience(tx: DataFrame, upc_lists: DataFrame, start: dt.date | None = None) -> DataFrame:
    """Every household that bought from a segment's list is H."""
    if start is not None:
        tx = tx.where(F.col("trn_date") >= F.lit(start))
    return (lookup_join(tx.select("hh_id", "upc"), upc_lists, ["upc"], "hh_id")
            .select("segment", "hh_id").distinct()
            .withColumn("propensity", F.lit("H")))


def label_audience(dimension: DataFrame, active: DataFrame, label: str,
                   mapping: dict[str, str]) -> DataFrame:
    """Households per mapped label among active shoppers, all H.

    Fails while planning if an expected label is not present any more.
    """
    labelled = dimension.join(active, "hh_id", "left_semi")
    found = {r[0] for r in labelled.where(F.col(label).isin(list(mapping)))
             .select(label).distinct().collect()}
    missing = sorted(set(mapping) - found)
    if missing:
        raise ValueError("labels missing from the dimension: " + ", ".join(missing))
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return (labelled.withColumn("segment", F.create_map(*pairs)[F.col(label)])
            .where(F.col("segment").isNotNull())
            .select("segment", "hh_id", F.lit("H").alias("propensity")).distinct())


def select_propensities(sizes: DataFrame, minimum: int) -> DataFrame:
    """Ranks to deliver per audience: H, then M, then L until the minimum is met.

    ``sizes`` has one row per segment and propensity.
    """
    order = F.when(F.col("propensity") == "H", 1).when(F.col("propensity") == "M", 2).otherwise(3)
    earlier = Window.partitionBy("segment").orderBy("_order").rowsBetween(
        Window.unboundedPreceding, -1)
    return (sizes.withColumn("_order", order)
            .withColumn("households_before", F.coalesce(F.sum("households").over(earlier), F.lit(0)))
            .where(F.col("households_before") < minimum).drop("_order"))


def segment_counts(audience: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct households per label, the usual last check of a run."""
    return audience.groupBy(*keys).agg(F.count_distinct("hh_id").alias("households"))
