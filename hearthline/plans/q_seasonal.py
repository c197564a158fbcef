"""Seasonal queries: weekly history, holidays, outliers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hearthline.functions.timeline import holiday_weeks
from hearthline.operators import seasonal as S
from hearthline.operators.loess import loess_components
from hearthline.plans.bindings import BOUNDS, PRODUCTS, with_tx
from hearthline.plans.registry import query
from hearthline.session import cut_lineage
from hearthline.sources.tables import date_bounds, products, transactions

# Month and day of four holidays, kept every year of the data.
HOLIDAYS = {"valentines_day": (2, 14), "july_4th": (7, 4), "halloween": (10, 31), "christmas_eve": (12, 24)}

HISTORY = PRODUCTS + ",\n" + BOUNDS + """,
daily AS (
  SELECT sub_commodity, trn_date, CAST((trn_date - first_date) // 7 AS INTEGER) AS week,
         CAST(first_date + CAST((trn_date - first_date) // 7 AS INTEGER) * 7 + 6 AS DATE) AS week_enddate,
         CAST(SUM(net_cents) AS BIGINT) AS spend_cents
  FROM tx JOIN products USING (upc), bounds GROUP BY ALL),
weeks AS (SELECT DISTINCT week, week_enddate, CAST(year(week_enddate) AS INTEGER) AS year FROM daily),
spend AS (SELECT sub_commodity, week, CAST(SUM(spend_cents) AS BIGINT) AS spend_cents FROM daily GROUP BY 1, 2),
totals AS (SELECT week, CAST(SUM(spend_cents) AS BIGINT) AS total_cents FROM spend GROUP BY 1),
weekly AS (
  SELECT sub_commodity, week, spend_cents, total_cents, spend_cents / total_cents AS share,
         CAST(rank() OVER (PARTITION BY week ORDER BY spend_cents DESC) AS INTEGER) AS share_rank
  FROM spend JOIN totals USING (week)),
spend_y AS (SELECT sub_commodity, year, CAST(SUM(spend_cents) AS BIGINT) AS spend_cents
            FROM daily JOIN weeks USING (week) GROUP BY 1, 2),
totals_y AS (SELECT year, CAST(SUM(spend_cents) AS BIGINT) AS total_cents FROM spend_y GROUP BY 1),
annual AS (
  SELECT sub_commodity, year, spend_cents, total_cents, spend_cents / total_cents AS share,
         CAST(rank() OVER (PARTITION BY year ORDER BY spend_cents DESC) AS INTEGER) AS share_rank
  FROM spend_y JOIN totals_y USING (year)),
names(holiday, m, d) AS (VALUES ('valentines_day', 2, 14), ('july_4th', 7, 4), ('halloween', 10, 31), ('christmas_eve', 12, 24)),
holidays AS (
  SELECT holiday, make_date(y, m, d) - CAST(k AS INTEGER) AS date
  FROM names, (SELECT unnest(range(year(first_date), year(last_date) + 1)) AS y FROM bounds), (SELECT unnest(range(0, 4)) AS k)),
holiday_weeks AS (
  SELECT CAST((date - first_date) // 7 AS INTEGER) AS week, holiday, date FROM holidays, bounds WHERE date >= first_date)"""
SEASONAL = HISTORY + """,
trend AS (
  SELECT sub_commodity, week, CAST(ROUND(spend_cents - SUM(spend_cents) OVER c / COUNT(*) OVER c) AS BIGINT) AS detrended
  FROM weekly WINDOW c AS (PARTITION BY sub_commodity ORDER BY week RANGE BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
seasonal AS (
  SELECT sub_commodity, week, week % 13 AS phase,
         CAST(ROUND(SUM(detrended) OVER p / COUNT(*) OVER p) AS BIGINT) AS seasonal
  FROM trend WINDOW p AS (PARTITION BY sub_commodity, week % 13)),
moments AS (
  SELECT *, COUNT(*) OVER s AS n, CAST(SUM(seasonal) OVER s AS DOUBLE) AS total,
         CAST(SUM(CAST(seasonal AS HUGEINT) * seasonal) OVER s AS DOUBLE) AS squares
  FROM seasonal WINDOW s AS (PARTITION BY sub_commodity)),
outliers AS (
  SELECT sub_commodity, week, phase, seasonal FROM moments
  WHERE seasonal * n::DOUBLE - total > 0
    AND (seasonal * n::DOUBLE - total) * (seasonal * n::DOUBLE - total)
        > 1.282::DOUBLE * 1.282::DOUBLE * (n::DOUBLE * squares - total * total))"""


class Inputs:
    def __init__(self, spark, folder):
        self.first, self.last = date_bounds(spark, folder)
        # A row per category and day, read several times: the items are joined and summed once.
        self.daily = cut_lineage(S.daily_spend(transactions(spark, folder), products(spark, folder),
                                               "sub_commodity", self.first))
        self.weeks = self.daily.select("week", "week_enddate", "year").distinct()
        days = [(name, dt.date(year, *day)) for name, day in HOLIDAYS.items()
                for year in range(self.first.year, self.last.year + 1)]
        self.holidays = holiday_weeks(
            spark.createDataFrame(days, "holiday string, date date"), self.first)
        self.weekly = S.share_history(self.daily, "sub_commodity")

    @property
    def seasonal(self):
        return S.seasonal_component(self.weekly.select("sub_commodity", "week", "spend_cents"), "sub_commodity")


@query("h01_week_timeline", with_tx(HISTORY, body="""
SELECT CAST(trn_date AS VARCHAR) AS day, week, CAST(week_enddate AS VARCHAR) AS week_enddate,
       CAST(year(week_enddate) AS INTEGER) AS year, CAST(SUM(spend_cents) AS BIGINT) AS spend_cents FROM daily GROUP BY ALL"""))
def h01(spark, folder):
    return Inputs(spark, folder).daily.groupBy(
        F.col("trn_date").cast("string").alias("day"), "week",
        F.col("week_enddate").cast("string").alias("week_enddate"), "year").agg(F.sum("spend_cents").alias("spend_cents"))


@query("h02_holiday_weeks", with_tx(HISTORY, body="""
SELECT h.week, h.holiday, CAST(h.date AS VARCHAR) AS day, 1 AS holiday_flag, CAST(SUM(d.spend_cents) AS BIGINT) AS spend_cents
FROM holiday_weeks h JOIN daily d ON d.trn_date = h.date GROUP BY ALL"""))
def h02(spark, folder):
    data = Inputs(spark, folder)
    daily = data.daily.select(F.col("trn_date").alias("date"), "spend_cents")
    return (data.holidays.join(daily, "date")
            .groupBy("week", "holiday", F.col("date").cast("string").alias("day"), "holiday_flag")
            .agg(F.sum("spend_cents").alias("spend_cents")))


@query("h03_weekly_share", with_tx(HISTORY, body="SELECT * FROM weekly"))
def h03(spark, folder):
    return Inputs(spark, folder).weekly


@query("h04_annual_share", with_tx(HISTORY, body="SELECT * FROM annual"))
def h04(spark, folder):
    return S.share_history(Inputs(spark, folder).daily, "sub_commodity", "year")


@query("h05_holiday_movers", with_tx(HISTORY, body="""
SELECT DISTINCT w.week, k.year, h.holiday, w.sub_commodity, w.share_rank, a.share_rank AS annual_share_rank,
       a.share_rank - w.share_rank AS share_rank_gain
FROM weekly w JOIN weeks k USING (week)
LEFT JOIN (SELECT * FROM annual WHERE share_rank <= 100) a ON a.sub_commodity = w.sub_commodity AND a.year = k.year
JOIN (SELECT DISTINCT week, holiday FROM holiday_weeks) h ON h.week = w.week
WHERE w.share_rank <= 100 AND (a.share_rank - w.share_rank >= 10 OR a.share_rank IS NULL)"""))
def h05(spark, folder):
    data = Inputs(spark, folder)
    annual = S.share_history(data.daily, "sub_commodity", "year")
    return S.holiday_movers(data.weekly, annual, data.weeks, data.holidays, "sub_commodity", top=100)


@query("h06_history_export", with_tx(HISTORY, body="""
SELECT k.year, w.week, CASE WHEN h.week IS NULL THEN 0 ELSE 1 END AS holiday_flag,
       CAST(k.week_enddate AS VARCHAR) AS week_enddate, w.sub_commodity, w.share_rank,
       ROUND(w.spend_cents / 100, 2) AS dollars_spent, ROUND(w.total_cents / 100, 2) AS total_dollars_spent,
       ROUND(w.share * 100, 2) AS dollar_share
FROM weekly w JOIN weeks k USING (week) LEFT JOIN (SELECT DISTINCT week FROM holiday_weeks) h USING (week)"""))
def h06(spark, folder):
    data = Inputs(spark, folder)
    return S.history_export(data.weekly, data.weeks, data.holidays, "sub_commodity").withColumn(
        "week_enddate", F.col("week_enddate").cast("string"))


@query("h07_seasonal_component", with_tx(SEASONAL, body="SELECT * FROM seasonal"))
def h07(spark, folder):
    return Inputs(spark, folder).seasonal.select("sub_commodity", "week", "phase", "seasonal")


@query("h07_loess_components")
def h07_loess(spark, folder):
    """Seasonal and trend component of every series by local regression."""
    return loess_components(Inputs(spark, folder).weekly, "sub_commodity")


@query("h08_loess_outliers")
def h08_loess(spark, folder):
    """Weeks whose component by local regression stands out of its series."""
    found = loess_components(Inputs(spark, folder).weekly, "sub_commodity").where("seasonal is not null")
    return S.seasonal_outliers(found, "sub_commodity")


@query("h08_seasonal_outliers", with_tx(SEASONAL, body="SELECT * FROM outliers"))
def h08(spark, folder):
    return S.seasonal_outliers(Inputs(spark, folder).seasonal, "sub_commodity").select(
        "sub_commodity", "week", "phase", "seasonal")


@query("h09_recurring_holiday_items", with_tx(SEASONAL, body="""
SELECT o.sub_commodity, h.holiday, COUNT(DISTINCT k.year) AS years
FROM outliers o JOIN (SELECT DISTINCT week, holiday FROM holiday_weeks) h USING (week) JOIN weeks k USING (week)
WHERE k.year >= 1996 GROUP BY 1, 2 HAVING COUNT(DISTINCT k.year) >= 2"""))
def h09(spark, folder):
    data = Inputs(spark, folder)
    outliers = S.seasonal_outliers(data.seasonal, "sub_commodity")
    return S.recurring_holiday_items(outliers, data.weeks, data.holidays, "sub_commodity", 1996)


@query("h10_outliers_by_quantile", with_tx(SEASONAL, body=""",
levels(coverage, z) AS (VALUES (90, 1.282), (91, 1.341), (92, 1.405), (93, 1.476), (94, 1.555),
  (95, 1.645), (96, 1.751), (97, 1.881), (98, 2.054), (99, 2.326))
SELECT CAST(coverage AS INTEGER) AS coverage, COUNT(*) AS outlier_weeks FROM moments, levels
WHERE seasonal * n::DOUBLE - total > 0 AND (seasonal * n::DOUBLE - total) * (seasonal * n::DOUBLE - total)
      > z::DOUBLE * z::DOUBLE * (n::DOUBLE * squares - total * total) GROUP BY 1"""))
def h10(spark, folder):
    seasonal = Inputs(spark, folder).seasonal
    out = None
    for coverage, z in S.NORMAL_QUANTILES.items():
        part = S.seasonal_outliers(seasonal, "sub_commodity", z).agg(
            F.count(F.lit(1)).alias("outlier_weeks")).withColumn("coverage", F.lit(coverage))
        out = part if out is None else out.unionByName(part)
    return out


@query("w07_rolling_spend", with_tx(HISTORY, body="""
SELECT sub_commodity, week,
  CAST(SUM(spend_cents) OVER (PARTITION BY sub_commodity ORDER BY week RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS spend_4w,
  CAST(SUM(spend_cents) OVER (PARTITION BY sub_commodity ORDER BY week RANGE BETWEEN 12 PRECEDING AND CURRENT ROW) AS BIGINT) AS spend_13w,
  CAST(SUM(spend_cents) OVER (PARTITION BY sub_commodity ORDER BY week RANGE BETWEEN 25 PRECEDING AND CURRENT ROW) AS BIGINT) AS spend_26w,
  CAST(SUM(spend_cents) OVER (PARTITION BY sub_commodity ORDER BY week RANGE BETWEEN 51 PRECEDING AND CURRENT ROW) AS BIGINT) AS spend_52w
FROM spend"""))
def w07(spark, folder):
    history = Inputs(spark, folder).weekly.select("sub_commodity", "week", "spend_cents")
    return S.rolling_spend(history, "sub_commodity").drop("spend_cents")
