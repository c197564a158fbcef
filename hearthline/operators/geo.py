"""Audiences built from where households shop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.predicates import haversine_km
from hearthline.operators.ranks import quantile_cuts
from hearthline.operators.skew import lookup_join
from hearthline.session import cut_lineage


def store_visits(tx: DataFrame) -> DataFrame:
    """Baskets by household and store, one row each, written once for the steps below."""
    return cut_lineage(tx.select("hh_id", "basket_id", "store_id").distinct())


def preferred_store(visits: DataFrame) -> DataFrame:
    """Store with the most baskets per household; equal counts go to the lowest number."""
    counted = visits.groupBy("hh_id", "store_id").agg(F.count(F.lit(1)).alias("baskets"))
    best = F.max_by("store_id", F.struct("baskets", -F.col("store_id")))
    return counted.groupBy("hh_id").agg(best.alias("pref_store_id"),
                                       F.max("baskets").alias("pref_baskets"))


def significant_trips(visits: DataFrame, preferred: DataFrame, stores: DataFrame,
                      km: float = 250.0) -> DataFrame:
    """Trips to a store other than the preferred one, with distance and a far-away flag."""
    origin = stores.select(F.col("store_id").alias("pref_store_id"), F.col("lat").alias("pref_lat"),
                           F.col("lon").alias("pref_lon"))
    home = lookup_join(preferred.select("hh_id", "pref_store_id"), origin, ["pref_store_id"], "hh_id",
                       computed=False)
    where = stores.select("store_id", "lat", "lon")
    placed = lookup_join(visits, where, ["store_id"], "basket_id", computed=False).join(home, "hh_id")
    distance = haversine_km("pref_lat", "pref_lon", "lat", "lon")
    return (placed.where(F.col("store_id") != F.col("pref_store_id"))
            .withColumn("distance_km", distance)
            .withColumn("significant", (F.col("distance_km") >= km).cast("int"))
            .select("hh_id", "basket_id", "store_id", "distance_km", "significant"))


def distinct_far_stores(trips: DataFrame, cap_quantile: float | None = 0.95) -> DataFrame:
    """Far-away stores visited per household.

    Households above ``cap_quantile`` of that number are left out: they are more
    likely to be resellers or drivers than travellers.
    """
    per_household = (trips.groupBy("hh_id", "store_id").agg(F.max("significant").alias("far"))
                     .groupBy("hh_id").agg(F.sum("far").alias("far_stores")))
    if cap_quantile is None:
        return per_household
    per_household = cut_lineage(per_household)
    cap = quantile_cuts(per_household, [], "far_stores", {"cap": cap_quantile}).first()["cap"]
    return per_household.where(F.col("far_stores") <= F.lit(cap))


def travelers(trips: DataFrame, cap_quantile: float | None = 0.95) -> DataFrame:
    """M for one far-away store, H for two or more."""
    return (distinct_far_stores(trips, cap_quantile).where(F.col("far_stores") >= 1)
            .withColumn("segment", F.when(F.col("far_stores") >= 2, "H").otherwise("M")))


def roadies(trips: DataFrame, tagged: DataFrame, volumes: DataFrame,
            cap_quantile: float | None = 0.95, top: float = 0.9) -> DataFrame:
    """Travellers who bought the tagged item on a far trip, or heavy buyers of it.

    ``tagged`` holds the baskets with the item, ``volumes`` the volume per
    household. Both conditions together are H, one alone is M.
    """
    who = travelers(trips, cap_quantile).select("hh_id")
    on_trip = (trips.where(F.col("significant") == 1).select("hh_id", "basket_id")
               .join(tagged.select("basket_id").distinct(), "basket_id", "left_semi")
               .select("hh_id").distinct().join(who, "hh_id", "left_semi"))
    volumes = cut_lineage(volumes)
    cut = quantile_cuts(volumes, [], "volume", {"cut": top}).first()["cut"]
    heavy = volumes.where(F.col("volume") >= F.lit(cut)).select("hh_id").distinct()
    return (on_trip.unionByName(heavy).groupBy("hh_id").agg(F.count(F.lit(1)).alias("_n"))
            .select("hh_id", F.when(F.col("_n") == 2, "H").otherwise("M").alias("segment")))


def attribute_audiences(preferred: DataFrame, stores: DataFrame, column: str,
                        mapping: dict[str, str]) -> DataFrame:
    """Households by an attribute of their preferred store; unknown attributes drop out."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    homes = preferred.select("hh_id", F.col("pref_store_id").alias("store_id"))
    placed = lookup_join(homes, stores.select("store_id", column), ["store_id"], "hh_id", "left", computed=False)
    return (placed.withColumn("segment", F.create_map(*pairs)[F.col(column)])
            .where(F.col("segment").isNotNull())
            .select("segment", "hh_id", F.lit("H").alias("propensity")))


def share_of_households(df: DataFrame, column: str, count_column: str, prefix: str) -> DataFrame:
    """Distinct households per value, and their percentage of all distinct households."""
    counted = df.groupBy(column).agg(F.count_distinct(count_column).alias(f"{prefix}_count"))
    total = df.agg(F.count_distinct(count_column)).first()[0]
    percent = F.round(F.col(f"{prefix}_count") * 100 / F.lit(total), 4)
    return counted.withColumn(f"{prefix}_percent", percent)


def compare_sources(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Counts and shares of two household-to-label sources side by side."""
    a = share_of_households(left, column, "hh_id", "left")
    b = share_of_households(right, column, "hh_id", "right")
    both = a.join(b, column, "outer").fillna(0)
    return both.withColumn("percent_difference",
                           F.round(F.col("left_percent") - F.col("right_percent"), 4))


def source_mismatches(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Households per kind of disagreement between two sources."""
    a = left.select("hh_id", F.col(column).alias("_a"), F.lit(1).alias("_in_a"))
    b = right.select("hh_id", F.col(column).alias("_b"), F.lit(1).alias("_in_b"))
    kind = (F.when(F.col("_in_b").isNull(), "left only").when(F.col("_in_a").isNull(), "right only")
            .when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("different"))
    return a.join(b, "hh_id", "outer").groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("households"))
