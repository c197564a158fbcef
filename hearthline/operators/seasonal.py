"""Weekly history of categories, holiday movers and seasonal outliers.

A row is one category and one week, so every series is as long as the calendar
and every week as wide as the category list; item rows are summed before any
window is applied.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.timeline import week_timeline
from hearthline.sources.tables import with_products

# Standard normal quantiles by coverage in percent.
NORMAL_QUANTILES = {90: 1.282, 91: 1.341, 92: 1.405, 93: 1.476, 94: 1.555,
                    95: 1.645, 96: 1.751, 97: 1.881, 98: 2.054, 99: 2.326}


def daily_spend(tx: DataFrame, products: DataFrame, category: str, start: dt.date) -> DataFrame:
    """Spend per category and date with the week columns."""
    spend = (with_products(tx, products, [category]).where(F.col(category).isNotNull())
             .groupBy(category, "trn_date").agg(F.sum("net_cents").alias("spend_cents")))
    return week_timeline(spend, "trn_date", start)


def share_history(daily: DataFrame, category: str, by: str = "week") -> DataFrame:
    """Spend, total spend, share of total and share rank per category and period."""
    spend = daily.groupBy(category, by).agg(F.sum("spend_cents").alias("spend_cents"))
    period = Window.partitionBy(by)
    return (spend.withColumn("total_cents", F.sum("spend_cents").over(period))
            .withColumn("share", F.col("spend_cents") / F.col("total_cents"))
            .withColumn("share_rank", F.rank().over(period.orderBy(F.desc("spend_cents")))))


def rolling_spend(history: DataFrame, category: str, weeks: tuple[int, ...] = (4, 13, 26, 52)) -> DataFrame:
    """Spend over the last n weeks, counted in weeks and not in rows."""
    series = Window.partitionBy(category).orderBy("week")
    return history.withColumns({
        f"spend_{n}w": F.sum("spend_cents").over(series.rangeBetween(-(n - 1), 0)) for n in weeks})


def holiday_movers(weekly: DataFrame, annual: DataFrame, weeks: DataFrame, holidays: DataFrame,
                   category: str, top: int = 500, places: int = 10) -> DataFrame:
    """Categories that climb in holiday weeks.

    Among the weekly top: those ranked at least ``places`` better than in their
    year, or absent from the year's top.
    """
    yearly = annual.where(F.col("share_rank") <= top).select(
        category, "year", F.col("share_rank").alias("annual_share_rank"))
    gain = F.col("annual_share_rank") - F.col("share_rank")
    return (weekly.where(F.col("share_rank") <= top)
            .join(weeks.select("week", "year").distinct(), "week")
            .join(yearly, [category, "year"], "left")
            .withColumn("share_rank_gain", gain)
            .join(holidays.select("week", "holiday").distinct(), "week")
            .where((F.col("share_rank_gain") >= places) | F.col("annual_share_rank").isNull())
            .select("week", "year", "holiday", category, "share_rank", "annual_share_rank",
                    "share_rank_gain"))


def history_export(weekly: DataFrame, weeks: DataFrame, holidays: DataFrame, category: str) -> DataFrame:
    """Readable weekly history: money in units, share in percent, holiday flag."""
    flags = holidays.select("week", "holiday_flag").distinct()
    return (weekly.join(weeks.select("week", "week_enddate", "year").distinct(), "week")
            .join(flags, "week", "left").fillna(0, ["holiday_flag"])
            .select("year", "week", "holiday_flag", "week_enddate", category, "share_rank",
                    F.round(F.col("spend_cents") / 100, 2).alias("dollars_spent"),
                    F.round(F.col("total_cents") / 100, 2).alias("total_dollars_spent"),
                    F.round(F.col("share") * 100, 2).alias("dollar_share")))


def seasonal_component(history: DataFrame, category: str, period: int = 13) -> DataFrame:
    """Additive seasonal component of each series.

    The trend is a centred mean over one period; the component is the mean of the
    detrended values at the same phase of the period. This is the classical
    decomposition, not a loess fit.
    """
    half = period // 2
    series = Window.partitionBy(category).orderBy("week")
    centred = series.rangeBetween(-half, half)
    detrended = F.col("spend_cents") - F.sum("spend_cents").over(centred) / F.count("week").over(centred)
    phased = history.withColumn("phase", F.pmod("week", F.lit(period))).withColumn(
        "_detrended", F.round(detrended).cast("long"))
    phase = Window.partitionBy(category, "phase")
    mean = F.sum("_detrended").over(phase) / F.count("week").over(phase)
    return phased.withColumn("seasonal", F.round(mean).cast("long")).drop("_detrended")


def seasonal_outliers(seasonal: DataFrame, category: str, z: float = NORMAL_QUANTILES[90]) -> DataFrame:
    """Weeks whose component exceeds mean + z standard deviations of its series.

    Components are whole cents, so the sums are exact; the square root is avoided
    by comparing squares.
    """
    series = Window.partitionBy(category)
    n = F.count("week").over(series).cast("double")
    total = F.sum("seasonal").over(series).cast("double")
    squares = F.sum(F.col("seasonal").cast("decimal(38,0)") * F.col("seasonal")).over(series).cast("double")
    above = F.col("seasonal") * n - total
    spread = n * squares - total * total
    return (seasonal.withColumns({"_above": above, "_spread": spread})
            .where((F.col("_above") > 0) & (F.col("_above") * F.col("_above") > z * z * F.col("_spread")))
            .drop("_above", "_spread"))


def recurring_holiday_items(outliers: DataFrame, weeks: DataFrame, holidays: DataFrame,
                            category: str, since: int, min_years: int = 2) -> DataFrame:
    """Categories that are outliers for the same holiday in several years."""
    dated = holidays.select("week", "holiday").distinct().join(
        weeks.select("week", "year").distinct(), "week").where(F.col("year") >= since)
    return (outliers.select(category, "week").join(dated, "week")
            .groupBy(category, "holiday").agg(F.count_distinct("year").alias("years"))
            .where(F.col("years") >= min_years))
