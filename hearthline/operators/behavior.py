"""Household behaviour: weekly KPIs, vintages, life-cycle segments and scores.

Weeks are fiscal ``YYYYPPWW`` codes. Money is whole cents, penetration and
scores are whole 1/10000, so that thresholds compare exactly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.calendar import FISCAL, Calendar
from hearthline.functions.timeline import (
    fiscal_columns, fiscal_columns_of_index, fiscal_index, quarter_of_week, quarter_weight,
    timeline_day, timeline_quarter)
from hearthline.operators.ranks import percent_rank_lookup, value_positions
from hearthline.operators.skew import lookup_join, salted_lookup
from hearthline.session import cut_lineage
from hearthline.sources.tables import kpi_aggregate, sift

RANK_POINTS = {"H": 3, "M": 2, "L": 1}


def daily_kpis(tx: DataFrame, product_list: DataFrame | None = None) -> DataFrame:
    """Sales, visits and units per household, date and division."""
    keys = ["hh_id", "trn_date", "div_no"]
    return kpi_aggregate(tx.where(F.col("hh_id").isNotNull()), keys, product_list)


def weekly_kpis(tx: DataFrame, product_list: DataFrame | None = None,
                calendar: Calendar | DataFrame | None = None) -> DataFrame:
    """Sales, units and visits per household and fiscal week.

    The fiscal columns are computed from the date unless a calendar is given.
    """
    known = tx.where(F.col("hh_id").isNotNull())
    keys = ["hh_id", "fiscal_week", "fiscal_month", "fiscal_quarter", "fiscal_year"]
    if calendar is None:
        numbered = known.withColumn("_week", fiscal_index("trn_date"))
        kpis = kpi_aggregate(numbered, ["hh_id", "_week"], product_list).withColumns(
            fiscal_columns_of_index(F.col("_week")))
    else:
        calendar = calendar if isinstance(calendar, Calendar) else Calendar(calendar)
        kpis = kpi_aggregate(calendar.attach(known), keys, product_list)
    return kpis.select(*keys, F.col("sales_cents").alias("weekly_sales"),
                       F.col("units").alias("weekly_units"), F.col("visits").alias("weekly_visits"))


def household_weeks(tx: DataFrame, product_list: DataFrame, calendar: Calendar | None = None) -> DataFrame:
    """List KPIs, total units and first purchase per household and week, in one pass.

    Gives the same as :func:`weekly_kpis` with and without the list and
    :func:`daily_kpis`, for runs that need all of them and should read the items
    once. Weeks without a listed purchase have ``weekly_visits`` 0.
    """
    marks = product_list.select("upc", F.lit(True).alias("_listed")).distinct()
    known = tx.where(F.col("hh_id").isNotNull())
    if calendar is None:
        keys, known = ["_week"], known.withColumn("_week", fiscal_index("trn_date"))
    else:
        keys, known = FISCAL, calendar.attach(known)
    listed = F.col("_listed").isNotNull()
    per_basket = (lookup_join(known, marks, ["upc"], "basket_id", "left")
                  .groupBy("hh_id", *keys, "basket_id")
                  .agg(F.sum("units").alias("all_units"),
                       F.sum(F.when(listed, F.col("units"))).alias("units"),
                       F.sum(F.when(listed, F.col("net_cents"))).alias("sales"),
                       F.min(F.when(listed, F.struct("trn_date", "div_no"))).alias("first")))
    weeks = per_basket.groupBy("hh_id", *keys).agg(
        F.coalesce(F.sum("sales"), F.lit(0)).alias("weekly_sales"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("weekly_units"),
        F.count("units").alias("weekly_visits"), F.sum("all_units").alias("all_units"),
        F.min("first").alias("first_purchase"))
    if calendar is not None:
        return weeks
    return weeks.withColumns(fiscal_columns_of_index(F.col("_week"))).drop("_week")


def vintage_of_weeks(weeks: DataFrame, calendar: Calendar | None = None) -> DataFrame:
    """:func:`household_vintage` from the rows of :func:`household_weeks`."""
    first = weeks.where(F.col("weekly_visits") > 0).groupBy("hh_id").agg(
        F.min("first_purchase").alias("_f"))
    return _vintage(first, calendar)


def household_vintage(daily: DataFrame, calendar: Calendar | None = None) -> DataFrame:
    """First week with a visit, its calendar columns, and the division of that visit.

    Several divisions on the first day: the lowest one counts.
    """
    first = daily.where(F.col("visits") > 0).groupBy("hh_id").agg(
        F.min(F.struct("trn_date", "div_no")).alias("_f"))
    return _vintage(first, calendar)


def _vintage(first: DataFrame, calendar: Calendar | None = None) -> DataFrame:
    names = {"fiscal_week": "vintage_week", "fiscal_year": "vintage_year",
             "fiscal_month": "vintage_period", "fiscal_quarter": "vintage_quarter"}
    if calendar is None:
        fiscal = fiscal_columns("_f.trn_date")
    else:
        first = calendar.attach(first.withColumn("_day_one", F.col("_f.trn_date")), "_day_one")
        fiscal = {name: F.col(name) for name in FISCAL}
    return first.select("hh_id", *[fiscal[k].alias(v) for k, v in names.items()],
                        F.col("_f.div_no").alias("vintage_div"))


def new_households(vintage: DataFrame, start: str, end: str) -> DataFrame:
    """Households whose first week lies inside the window."""
    return (vintage.where(F.col("vintage_week").between(start, end)).select("hh_id").distinct()
            .withColumn("segment", F.lit("new")))


def lapsed_households(weekly: DataFrame, start: str, end: str) -> DataFrame:
    """Visits before the window and none inside it; later weeks are not looked at."""
    inside = F.col("fiscal_week") >= start
    return (weekly.where(F.col("fiscal_week") <= end).groupBy("hh_id")
            .agg(F.sum(F.when(inside, F.col("weekly_visits")).otherwise(0)).alias("active"),
                 F.sum(F.when(~inside, F.col("weekly_visits")).otherwise(0)).alias("earlier"))
            .where((F.col("earlier") > 0) & (F.col("active") == 0))
            .select("hh_id", F.lit("lapsed").alias("segment")))


def _quarter(start: str, weeks_per_quarter: int, calendar: Calendar | None) -> Column:
    if calendar is None:
        return quarter_of_week("fiscal_week", start, weeks_per_quarter)
    return calendar.quarter_of_week("fiscal_week", start, weeks_per_quarter)


def active_households(weekly: DataFrame, vintage: DataFrame, start: str, end: str,
                      weeks_per_quarter: int = 13, min_visits: int = 7,
                      min_quarters: int = 3, calendar: Calendar | None = None) -> DataFrame:
    """``HML`` or ``inconsistent`` for households active in the window but not new."""
    active = (
        weekly.where(F.col("fiscal_week").between(start, end) & (F.col("weekly_sales") > 0))
        .withColumn("quarter", _quarter(start, weeks_per_quarter, calendar))
        .groupBy("hh_id", "quarter").agg(F.sum("weekly_visits").alias("visits"))
        .groupBy("hh_id").agg(F.sum("visits").alias("visits"),
                              F.count(F.lit(1)).alias("quarters"))
        .where(F.col("visits") > 0))
    enough = (F.col("visits") >= min_visits) & (F.col("quarters") >= min_quarters)
    return (active.withColumn("segment", F.when(enough, "HML").otherwise("inconsistent"))
            .join(new_households(vintage, start, end).select("hh_id"), "hh_id", "left_anti"))


def penetration(list_units: DataFrame, all_units: DataFrame) -> DataFrame:
    """Share of a household's units that came from the list, per quarter, in 1/10000.

    ``list_units`` has hh_id, quarter, sales and units; ``all_units`` hh_id,
    quarter and enterprise_units.
    """
    share = F.round(F.round(F.col("units") / F.col("enterprise_units"), 4) * 10_000)
    return list_units.join(all_units, ["hh_id", "quarter"]).withColumn(
        "unit_penetration", share.cast("long"))


def quarterly(weekly: DataFrame, start: str, end: str, weeks_per_quarter: int = 13,
              calendar: Calendar | None = None) -> DataFrame:
    """Weekly KPIs of the window summed per household and quarter."""
    return (weekly.where(F.col("fiscal_week").between(start, end))
            .withColumn("quarter", _quarter(start, weeks_per_quarter, calendar))
            .groupBy("hh_id", "quarter")
            .agg(F.sum("weekly_sales").alias("sales"), F.sum("weekly_units").alias("units")))


def _rank(percentile: Column, thresholds: tuple[float, float]) -> Column:
    medium, high = thresholds
    return F.when(percentile >= high, "H").when(percentile >= medium, "M").otherwise("L")


def rank_pillars(pillars: DataFrame, spend: tuple[float, float] = (0.5, 0.9),
                 share: tuple[float, float] = (0.5, 0.9)) -> DataFrame:
    """Percentile and H/M/L rank of spend and of penetration within each quarter.

    A penetration of 1 is percentile 1 whatever the others do. The pillars are
    written once, because both rankings and the join read them.
    """
    ranked = pillars = cut_lineage(pillars)
    for value, name in (("sales", "spend_percentile"), ("unit_penetration", "_share_rank")):
        lookup = percent_rank_lookup(pillars, ["quarter"], value, name)
        ranked = salted_lookup(ranked, lookup, ["quarter", value], spread="hh_id", weight="n")
    whole = F.when(F.col("unit_penetration") == 10_000, 1.0).otherwise(F.col("_share_rank"))
    return (ranked.withColumn("penetration_percentile", whole).drop("_share_rank")
            .withColumns({"spend_rank": _rank(F.col("spend_percentile"), spend),
                          "penetration_rank": _rank(F.col("penetration_percentile"), share)}))


def _quarter_cuts(pillars: DataFrame, value: str, thresholds: tuple[float, float],
                  names: tuple[str, str]) -> DataFrame:
    """Smallest value per quarter whose percent rank reaches each threshold."""
    positions = value_positions(pillars, ["quarter"], value)

    def cut(threshold: float) -> Column:
        parts = round(threshold * 10_000)
        reached = F.col("n_before") * 10_000 >= (F.col("n_total") - 1) * parts
        alone = (F.col("n_total") > 1) & reached
        return F.min(F.when(alone, F.col(value)))

    return positions.groupBy("quarter").agg(*[cut(t).alias(n) for t, n in zip(thresholds, names)])


def rank_labels(pillars: DataFrame, spend: tuple[float, float] = (0.5, 0.9),
                share: tuple[float, float] = (0.5, 0.9)) -> DataFrame:
    """The ranks of :func:`rank_pillars` without the percentiles.

    A label only needs the four cut values of its quarter. They are found on the
    value counts, so no household row is sorted or joined by value. The pillars
    are written once, because both rankings and the join read them.
    """
    pillars = cut_lineage(pillars)
    cuts = _quarter_cuts(pillars, "sales", spend, ("_spend_m", "_spend_h")).join(
        _quarter_cuts(pillars, "unit_penetration", share, ("_share_m", "_share_h")), "quarter")

    def rank(value: str, medium: str, high: str) -> Column:
        return F.when(F.col(value) >= F.col(high), "H").when(
            F.col(value) >= F.col(medium), "M").otherwise("L")

    share_rank = F.when(F.col("unit_penetration") == 10_000, "H").otherwise(
        rank("unit_penetration", "_share_m", "_share_h"))
    # Four quarters, hence four rows of cuts.
    return (pillars.join(F.broadcast(cuts), "quarter")
            .withColumns({"spend_rank": rank("sales", "_spend_m", "_spend_h"),
                          "penetration_rank": share_rank})
            .drop("_spend_m", "_spend_h", "_share_m", "_share_h"))


def _points(rank: str) -> Column:
    value = F.when(F.col(rank) == "H", RANK_POINTS["H"]).when(F.col(rank) == "M", RANK_POINTS["M"])
    return value.otherwise(RANK_POINTS["L"])


def quarter_points(ranked: DataFrame, market: str | None = None) -> DataFrame:
    """3, 2 or 1 points per quarter from the two ranks.

    The pair of ranks is worth what its sum says: five or six gives 3 points,
    four gives 2, less gives 1. New markets are scored on spend alone.
    """
    total = _points("spend_rank") + _points("penetration_rank")
    points = F.when(total >= 5, 3).when(total == 4, 2).otherwise(1)
    if market is not None:
        points = F.when(F.col(market) == "new market", _points("spend_rank")).otherwise(points)
    return ranked.withColumn("quarter_points", points)


def weighted_segments(points: DataFrame) -> DataFrame:
    """Recency-weighted sum of quarter points: above 2 is H, above 1 M, else L."""
    weighted = F.sum(F.col("quarter_points") * quarter_weight("quarter"))
    score = F.col("weighted_points")
    return (points.groupBy("hh_id").agg(weighted.alias("weighted_points"))
            .withColumn("segment", F.when(score > 20_000, "H").when(score > 10_000, "M").otherwise("L")))


def household_segments(weekly: DataFrame, vintage: DataFrame, enterprise: DataFrame, start: str,
                       end: str, weeks_per_quarter: int = 13, min_visits: int = 7,
                       min_quarters: int = 3, markets: DataFrame | None = None,
                       calendar: Calendar | None = None) -> DataFrame:
    """One label per household: new, lapsed, inconsistent, H, M or L.

    Any end week can be restated: later weeks are not used. ``enterprise`` holds
    weekly KPIs over all products, ``markets`` an optional market label.
    """
    active = active_households(weekly, vintage, start, end, weeks_per_quarter,
                               min_visits, min_quarters, calendar)
    eligible = active.where(F.col("segment") == "HML").select("hh_id")
    listed = quarterly(sift(weekly, eligible, ["hh_id"], "include"), start, end,
                       weeks_per_quarter, calendar)
    everything = quarterly(enterprise, start, end, weeks_per_quarter, calendar).select(
        "hh_id", "quarter", F.col("units").alias("enterprise_units"))
    pillars = penetration(listed, everything)
    if markets is not None:
        pillars = pillars.join(markets, "hh_id", "left").fillna("existing", ["market"])
    points = quarter_points(rank_labels(pillars), None if markets is None else "market")
    scored = weighted_segments(points).select("hh_id", "segment")
    unsure = active.where(F.col("segment") == "inconsistent").select("hh_id", "segment")
    return (lapsed_households(weekly, start, end)
            .unionByName(new_households(vintage, start, end))
            .unionByName(unsure).unionByName(scored))


def lite_segments(tx: DataFrame, product_list: DataFrame, end: dt.date, days: int = 364,
                  min_visits: int = 7) -> DataFrame:
    """H/M/L from one window of transactions, for households active on the list.

    Active: enough visits over the window, and sales in each of the three most
    recent quarters. List and total units come from the same pass over the items.
    """
    day = timeline_day("trn_date", end, days)
    window = tx.where(F.col("hh_id").isNotNull() & day.between(1, days)).withColumn(
        "quarter", timeline_quarter("trn_date", end, days))
    listed = product_list.select("upc", F.lit(True).alias("_listed")).distinct()
    is_listed = F.coalesce(F.col("_listed"), F.lit(False))
    per_basket = (lookup_join(window, listed, ["upc"], "basket_id", "left")
                  .groupBy("hh_id", "quarter", "basket_id")
                  .agg(F.sum("units").alias("all_units"),
                       F.sum(F.when(is_listed, F.col("units"))).alias("units"),
                       F.sum(F.when(is_listed, F.col("net_cents"))).alias("sales")))
    per_quarter = (per_basket.groupBy("hh_id", "quarter")
                   .agg(F.sum("all_units").alias("enterprise_units"), F.sum("units").alias("units"),
                        F.sum("sales").alias("sales"), F.count("units").alias("visits"))
                   .where(F.col("visits") > 0))
    sold = F.col("sales") > 0
    active = (per_quarter.groupBy("hh_id")
              .agg(F.sum(F.when(sold, F.col("visits")).otherwise(0)).alias("_visits"),
                   F.sum(F.when(sold & (F.col("quarter") > 1), 1).otherwise(0)).alias("_recent"))
              .where((F.col("_visits") >= min_visits) & (F.col("_recent") == 3)).select("hh_id"))
    share = F.round(F.round(F.col("units") / F.col("enterprise_units"), 4) * 10_000).cast("long")
    pillars = sift(per_quarter, active, ["hh_id"], "include").withColumn("unit_penetration", share)
    return weighted_segments(quarter_points(rank_labels(pillars)))
