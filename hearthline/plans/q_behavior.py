"""Behaviour queries: weekly KPIs, vintages, life-cycle segments, scores, fiscal calendar."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from hearthline.functions import timeline as C
from hearthline.functions.calendar import nearest_sunday_calendar
from hearthline.functions.predicates import market_label
from hearthline.operators import behavior as B
from hearthline.operators.geo import preferred_store, store_visits
from hearthline.operators.propensity import drop_returns
from hearthline.plans.bindings import BOUNDS, PRODUCTS, with_tx
from hearthline.plans.registry import query
from hearthline.session import cut_lineage, scratch_path
from hearthline.sources.sinks import replace_partitions
from hearthline.sources.tables import (
    date_bounds, kpi_aggregate, products, read_partitions, read_table, transactions)
from hearthline.streaming.weekly import pending_periods, update_vintage

WEEKS = 208
PER_QUARTER = 52
VISITS = 3

CODE = ("format('{:04d}{:02d}{:02d}', 1995 + widx // 52, (widx % 52) // 4 + 1, widx % 4 + 1)")
DATED = PRODUCTS + ",\n" + BOUNDS + f""",
listed AS (SELECT upc FROM products WHERE department = 'PROMO'),
indexed AS (SELECT *, CAST((trn_date - DATE '1995-01-01') // 7 AS INTEGER) AS widx FROM tx
            WHERE NOT is_return AND net_cents > 0),
dated AS (SELECT *, {CODE} AS fiscal_week, format('{{:04d}}{{:02d}}', 1995 + widx // 52, (widx % 52) // 4 + 1) AS fiscal_month,
          format('{{:04d}}{{:02d}}', 1995 + widx // 52, (widx % 52) // 13 + 1) AS fiscal_quarter,
          CAST(1995 + widx // 52 AS VARCHAR) AS fiscal_year FROM indexed),
edge AS (SELECT CAST((last_date - DATE '1995-01-01') // 7 AS INTEGER) AS e,
                CAST((last_date - DATE '1995-01-01') // 7 AS INTEGER) - {WEEKS - 1} AS s FROM bounds)"""
WEEKLY = DATED + """,
weekly AS (
  SELECT hh_id, widx, fiscal_week, fiscal_month, fiscal_quarter, fiscal_year,
         CAST(SUM(net_cents) AS BIGINT) AS weekly_sales, CAST(SUM(units) AS BIGINT) AS weekly_units,
         COUNT(DISTINCT basket_id) AS weekly_visits
  FROM dated JOIN listed USING (upc) GROUP BY ALL),
everything AS (
  SELECT hh_id, widx, CAST(SUM(units) AS BIGINT) AS weekly_units FROM dated GROUP BY ALL)"""
VINTAGE = WEEKLY + """,
firsts AS (SELECT hh_id, MIN(trn_date) AS first_day FROM dated JOIN listed USING (upc) GROUP BY 1),
vintage AS (
  SELECT hh_id, MIN(widx) AS widx, MIN(fiscal_week) AS vintage_week, MIN(fiscal_year) AS vintage_year,
         MIN(fiscal_month) AS vintage_period, MIN(fiscal_quarter) AS vintage_quarter, MIN(div_no) AS vintage_div
  FROM dated JOIN listed USING (upc) JOIN firsts USING (hh_id) WHERE trn_date = first_day GROUP BY 1)"""
SEGMENTS = VINTAGE + f""",
fresh AS (SELECT DISTINCT hh_id, 'new' AS segment FROM vintage, edge WHERE widx BETWEEN s AND e),
lapsed AS (
  SELECT hh_id, 'lapsed' AS segment FROM weekly, edge WHERE widx <= e GROUP BY hh_id
  HAVING SUM(CASE WHEN widx < s THEN weekly_visits ELSE 0 END) > 0
     AND SUM(CASE WHEN widx >= s THEN weekly_visits ELSE 0 END) = 0),
acting AS (
  SELECT hh_id, CAST(SUM(weekly_visits) AS BIGINT) AS visits, COUNT(DISTINCT (widx - s) // {PER_QUARTER}) AS quarters
  FROM weekly, edge WHERE widx BETWEEN s AND e AND weekly_sales > 0 GROUP BY hh_id HAVING SUM(weekly_visits) > 0),
active AS (
  SELECT hh_id, visits, quarters, CASE WHEN visits >= {VISITS} AND quarters >= 3 THEN 'HML' ELSE 'inconsistent' END AS segment
  FROM acting WHERE hh_id NOT IN (SELECT hh_id FROM fresh))"""
PILLARS = SEGMENTS + f""",
listq AS (
  SELECT hh_id, CAST((widx - s) // {PER_QUARTER} + 1 AS INTEGER) AS quarter,
         CAST(SUM(weekly_sales) AS BIGINT) AS sales, CAST(SUM(weekly_units) AS BIGINT) AS units
  FROM weekly, edge WHERE widx BETWEEN s AND e AND hh_id IN (SELECT hh_id FROM active WHERE segment = 'HML') GROUP BY 1, 2),
allq AS (
  SELECT hh_id, CAST((widx - s) // {PER_QUARTER} + 1 AS INTEGER) AS quarter, CAST(SUM(weekly_units) AS BIGINT) AS enterprise_units
  FROM everything, edge WHERE widx BETWEEN s AND e GROUP BY 1, 2),
pillars AS (
  SELECT hh_id, quarter, sales, units, enterprise_units,
         CAST(ROUND(ROUND(units / enterprise_units, 4) * 10000) AS BIGINT) AS unit_penetration
  FROM listq JOIN allq USING (hh_id, quarter)),
percentiles AS (
  SELECT *, percent_rank() OVER (PARTITION BY quarter ORDER BY sales) AS spend_percentile,
         CASE WHEN unit_penetration = 10000 THEN 1.0::DOUBLE
              ELSE percent_rank() OVER (PARTITION BY quarter ORDER BY unit_penetration) END AS penetration_percentile
  FROM pillars),
ranked AS (
  SELECT *, CASE WHEN spend_percentile >= 0.9 THEN 'H' WHEN spend_percentile >= 0.5 THEN 'M' ELSE 'L' END AS spend_rank,
         CASE WHEN penetration_percentile >= 0.9 THEN 'H' WHEN penetration_percentile >= 0.5 THEN 'M' ELSE 'L' END AS penetration_rank
  FROM percentiles)"""
BASKETS = """,
baskets AS (SELECT hh_id, store_id, COUNT(DISTINCT basket_id) AS n FROM tx GROUP BY 1, 2),
pref AS (SELECT hh_id, arg_max(store_id, n * 1000000 - store_id) AS pref_store_id FROM baskets GROUP BY 1),
markets AS (
  SELECT hh_id, CASE WHEN s_nationkey BETWEEN 10 AND 12 THEN 'new market' ELSE 'existing' END AS market
  FROM pref JOIN supplier ON pref_store_id = s_suppkey)"""
POINTS = PILLARS + BASKETS + """,
points AS (
  SELECT hh_id, quarter, market, spend_rank, penetration_rank,
    CASE WHEN market = 'new market' THEN CASE spend_rank WHEN 'H' THEN 3 WHEN 'M' THEN 2 ELSE 1 END
         WHEN spend_rank || penetration_rank IN ('HH', 'MH', 'HM') THEN 3
         WHEN spend_rank || penetration_rank IN ('MM', 'LH', 'HL') THEN 2 ELSE 1 END AS quarter_points
  FROM ranked JOIN markets USING (hh_id))"""
SCORES = POINTS + """,
scores AS (
  SELECT hh_id, CAST(SUM(quarter_points * CASE quarter WHEN 1 THEN 2300 WHEN 2 THEN 2400 WHEN 3 THEN 2600 ELSE 2700 END) AS BIGINT) AS weighted_points
  FROM points GROUP BY 1),
scored AS (
  SELECT hh_id, weighted_points, CASE WHEN weighted_points > 20000 THEN 'H' WHEN weighted_points > 10000 THEN 'M' ELSE 'L' END AS segment FROM scores)"""

# A calendar whose years begin on the Sunday nearest to the first of February; some have 53 weeks.
LEAP_DATED = PRODUCTS + ",\n" + BOUNDS + f""",
listed AS (SELECT upc FROM products WHERE department = 'PROMO'),
opens AS (SELECT y, CASE WHEN dayofweek(d) <= 3 THEN d - CAST(dayofweek(d) AS INTEGER) ELSE d + 7 - CAST(dayofweek(d) AS INTEGER) END AS d0
          FROM (SELECT y, make_date(y, 2, 1) AS d FROM (SELECT CAST(range AS INTEGER) AS y FROM range(1990, 2010)))),
years AS (SELECT y, d0, LEAD(d0) OVER (ORDER BY y) AS d1 FROM opens),
placed AS (SELECT tx.*, y, CAST((trn_date - d0) // 7 AS INTEGER) AS w,
                  CAST((trn_date - DATE '1995-01-01') // 7 AS INTEGER) AS widx
           FROM tx JOIN years ON trn_date >= d0 AND trn_date < d1 WHERE NOT is_return AND net_cents > 0),
dated AS (SELECT * EXCLUDE (y, w), format('{{:04d}}{{:02d}}{{:02d}}', y, least(w // 4, 12) + 1, w - 4 * least(w // 4, 12) + 1) AS fiscal_week,
          format('{{:04d}}{{:02d}}', y, least(w // 4, 12) + 1) AS fiscal_month,
          format('{{:04d}}{{:02d}}', y, least(w // 13, 3) + 1) AS fiscal_quarter, CAST(y AS VARCHAR) AS fiscal_year FROM placed),
edge AS (SELECT CAST((last_date - DATE '1995-01-01') // 7 AS INTEGER) AS e,
                CAST((last_date - DATE '1995-01-01') // 7 AS INTEGER) - {WEEKS - 1} AS s FROM bounds)"""


def leap(sql: str) -> str:
    """The same SQL on the calendar with years of 53 weeks."""
    return sql.replace(DATED, LEAP_DATED)


class Inputs:
    """Weekly KPIs, vintages and window of the bound product list.

    ``stored`` gives the KPI and vintage datasets as the weekly job keeps them:
    written once and read by every later step.
    """

    def __init__(self, spark, folder, calendar=None):
        _, last = date_bounds(spark, folder)
        self.calendar = calendar
        self.end = calendar.week_of(last) if calendar else C.date_week(last)
        self.start = (calendar or C).weeks_ago(self.end, WEEKS - 1)
        self.tx = drop_returns(transactions(spark, folder, stores=True))
        self.plain = drop_returns(transactions(spark, folder))
        self.listed = products(spark, folder).where(F.col("department") == "PROMO").select("upc")

    @cached_property
    def weekly(self):
        return B.weekly_kpis(self.plain, self.listed, self.calendar)

    @cached_property
    def everything(self):
        return B.weekly_kpis(self.plain, calendar=self.calendar)

    @cached_property
    def vintage(self):
        return B.household_vintage(B.daily_kpis(self.tx, self.listed), self.calendar)

    def stored(self):
        weeks = cut_lineage(B.household_weeks(self.tx, self.listed, self.calendar))
        self.weekly = weeks.where(F.col("weekly_visits") > 0)
        self.everything = weeks.withColumn("weekly_units", F.col("all_units"))
        self.vintage = B.vintage_of_weeks(weeks, self.calendar)
        return self

    @property
    def active(self):
        return B.active_households(self.weekly, self.vintage, self.start, self.end, PER_QUARTER, VISITS,
                                   calendar=self.calendar)

    @property
    def pillars(self):
        eligible = self.active.where(F.col("segment") == "HML").select("hh_id")
        listed = B.quarterly(self.weekly.join(eligible, "hh_id", "left_semi"), self.start, self.end, PER_QUARTER,
                             self.calendar)
        everything = B.quarterly(self.everything, self.start, self.end, PER_QUARTER, self.calendar).select(
            "hh_id", "quarter", F.col("units").alias("enterprise_units"))
        return B.penetration(listed, everything)


def markets(spark, folder):
    """Market label of each household, from the division of its preferred store."""
    stores = read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("pref_store_id"), F.col("s_nationkey").alias("div"))
    division = F.when(F.col("div").between(10, 12), F.concat_ws("-", F.lit("NEW"), "div")).otherwise("OLD")
    return (preferred_store(store_visits(transactions(spark, folder))).join(stores, "pref_store_id")
            .withColumn("division", division)
            .select("hh_id", market_label("division", ["NEW"]).alias("market")))


@query("d10_weekly_kpis", with_tx(WEEKLY, body="SELECT * EXCLUDE (widx) FROM weekly"))
def d10(spark, folder):
    return Inputs(spark, folder).weekly


@query("d11_household_vintage", with_tx(VINTAGE, body="SELECT * EXCLUDE (widx) FROM vintage"))
def d11(spark, folder):
    return Inputs(spark, folder).vintage


@query("d12_incremental_vintage", with_tx(VINTAGE, body="""
SELECT 'vintage' AS dataset, vintage_week AS week, COUNT(*) AS households, CAST(SUM(vintage_div) AS BIGINT) AS checksum
FROM vintage GROUP BY 2
UNION ALL SELECT 'sales', fiscal_week, COUNT(*), CAST(SUM(weekly_sales) AS BIGINT)
FROM weekly GROUP BY 2"""))
def d12(spark, folder):
    """History in one go, then the last three weeks one by one, the last one twice."""
    data = Inputs(spark, folder)
    vintage_path, sales_path = scratch_path(spark, "vintage"), scratch_path(spark, "sales")
    daily = cut_lineage(B.daily_kpis(data.tx, data.listed).withColumn(
        "week", C.fiscal_columns("trn_date")["fiscal_week"]))
    before = C.weeks_ago(data.end, 2)
    replace_partitions(B.household_vintage(daily.where(F.col("week") < before)), vintage_path, ["vintage_week"])
    history = read_partitions(spark, vintage_path, "vintage_week").withColumn(
        "vintage_week", F.col("vintage_week").cast("string"))
    replace_partitions(data.weekly.where(F.col("fiscal_week") < before).join(history, "hh_id"), sales_path, ["fiscal_week"])
    recent = cut_lineage(data.weekly.where(F.col("fiscal_week") >= before))
    for week in (before, C.weeks_ago(data.end, 1), data.end, data.end):
        update_vintage(spark, daily.where(F.col("week") == week),
                       recent.where(F.col("fiscal_week") == week), week, vintage_path, sales_path)
    vintages = read_partitions(spark, vintage_path, "vintage_week").groupBy(
        F.col("vintage_week").cast("string").alias("week")).agg(
        F.count(F.lit(1)).alias("households"), F.sum("vintage_div").alias("checksum"))
    sales = read_partitions(spark, sales_path, "fiscal_week").groupBy(
        F.col("fiscal_week").cast("string").alias("week")).agg(
        F.count(F.lit(1)).alias("households"), F.sum("weekly_sales").alias("checksum"))
    return vintages.select(F.lit("vintage").alias("dataset"), "*").unionByName(
        sales.select(F.lit("sales").alias("dataset"), "*"))


@query("d13_quarter_map", with_tx(DATED, body="""
SELECT DISTINCT fiscal_week, CAST((widx - s) // 13 + 1 AS INTEGER) AS quarter
FROM dated, (SELECT e, e - 51 AS s FROM edge) WHERE widx BETWEEN s AND e"""))
def d13(spark, folder):
    data = Inputs(spark, folder)
    start = C.weeks_ago(data.end, 51)
    weeks = data.plain.select(C.fiscal_columns("trn_date")["fiscal_week"].alias("fiscal_week")).where(
        F.col("fiscal_week").between(start, data.end)).distinct()
    return weeks.withColumn("quarter", C.quarter_of_week("fiscal_week", start))


@query("d14_new_households", with_tx(SEGMENTS, body="SELECT * FROM fresh"))
def d14(spark, folder):
    data = Inputs(spark, folder)
    return B.new_households(data.vintage, data.start, data.end)


@query("d15_lapsed_households", with_tx(SEGMENTS, body="SELECT * FROM lapsed"))
def d15(spark, folder):
    data = Inputs(spark, folder)
    return B.lapsed_households(data.weekly, data.start, data.end)


@query("d16_active_households", with_tx(SEGMENTS, body="SELECT * FROM active"))
def d16(spark, folder):
    return Inputs(spark, folder).stored().active


@query("d17_unit_penetration", with_tx(PILLARS, body="SELECT * FROM pillars"))
def d17(spark, folder):
    return Inputs(spark, folder).stored().pillars


@query("d18_rank_pillars", with_tx(PILLARS, body="SELECT * FROM ranked"))
def d18(spark, folder):
    return B.rank_pillars(Inputs(spark, folder).stored().pillars)


@query("d19_quarter_points", with_tx(POINTS, body="SELECT * FROM points"))
def d19(spark, folder):
    ranked = B.rank_labels(Inputs(spark, folder).stored().pillars).join(markets(spark, folder), "hh_id", "left")
    return B.quarter_points(ranked.fillna("existing", ["market"]), "market").select(
        "hh_id", "quarter", "market", "spend_rank", "penetration_rank", "quarter_points")


@query("d20_weighted_segments", with_tx(SCORES, body="SELECT * FROM scored"))
def d20(spark, folder):
    ranked = B.rank_labels(Inputs(spark, folder).stored().pillars).join(markets(spark, folder), "hh_id", "left")
    return B.weighted_segments(B.quarter_points(ranked.fillna("existing", ["market"]), "market"))


LITE_DAYS = 1456


@query("d21_lite_segments", with_tx(DATED, body=f""",
timed AS (SELECT *, CAST(CEIL((trn_date - last_date + {LITE_DAYS}) / 364.0) AS INTEGER) AS quarter
          FROM indexed, bounds WHERE trn_date - last_date + {LITE_DAYS} BETWEEN 1 AND {LITE_DAYS}),
lst AS (SELECT hh_id, quarter, CAST(SUM(net_cents) AS BIGINT) AS sales, CAST(SUM(units) AS BIGINT) AS units,
               COUNT(DISTINCT basket_id) AS visits FROM timed JOIN listed USING (upc) GROUP BY 1, 2),
al AS (SELECT hh_id, quarter, CAST(SUM(units) AS BIGINT) AS enterprise_units FROM timed GROUP BY 1, 2),
act AS (SELECT hh_id FROM lst WHERE sales > 0 GROUP BY 1 HAVING SUM(visits) >= {VISITS}
        AND COUNT(CASE WHEN quarter > 1 THEN 1 END) = 3),
pil AS (SELECT hh_id, quarter, sales, ROUND(units / enterprise_units, 4) AS pen
        FROM lst JOIN al USING (hh_id, quarter) WHERE hh_id IN (SELECT hh_id FROM act)),
rk AS (SELECT *, percent_rank() OVER (PARTITION BY quarter ORDER BY sales) AS sp,
       CASE WHEN pen = 1 THEN 1 ELSE percent_rank() OVER (PARTITION BY quarter ORDER BY pen) END AS pp FROM pil),
lb AS (SELECT *, CASE WHEN sp >= 0.9 THEN 'H' WHEN sp >= 0.5 THEN 'M' ELSE 'L' END
       || CASE WHEN pp >= 0.9 THEN 'H' WHEN pp >= 0.5 THEN 'M' ELSE 'L' END AS pair FROM rk),
sc AS (SELECT hh_id, CAST(SUM(CASE WHEN pair IN ('HH', 'MH', 'HM') THEN 3 WHEN pair IN ('MM', 'LH', 'HL') THEN 2 ELSE 1 END
       * CASE quarter WHEN 1 THEN 2300 WHEN 2 THEN 2400 WHEN 3 THEN 2600 ELSE 2700 END) AS BIGINT) AS weighted_points FROM lb GROUP BY 1)
SELECT *, CASE WHEN weighted_points > 20000 THEN 'H' WHEN weighted_points > 10000 THEN 'M' ELSE 'L' END AS segment FROM sc"""))
def d21(spark, folder):
    _, last = date_bounds(spark, folder)
    data = Inputs(spark, folder)
    return B.lite_segments(data.plain, data.listed, last, LITE_DAYS, VISITS)


@query("d22_household_segments", with_tx(SCORES, body="""
SELECT * FROM lapsed UNION ALL SELECT * FROM fresh
UNION ALL SELECT hh_id, segment FROM active WHERE segment = 'inconsistent'
UNION ALL SELECT hh_id, segment FROM scored"""))
def d22(spark, folder):
    data = Inputs(spark, folder).stored()
    return B.household_segments(data.weekly, data.vintage, data.everything, data.start, data.end,
                                PER_QUARTER, VISITS, markets=markets(spark, folder))


def leap_inputs(spark, folder):
    return Inputs(spark, folder, nearest_sunday_calendar(spark, 1990, 2008))


@query("d10_weekly_kpis_leap", leap(with_tx(WEEKLY, body="SELECT * EXCLUDE (widx) FROM weekly")))
def d10_leap(spark, folder):
    return leap_inputs(spark, folder).weekly


@query("d11_household_vintage_leap", leap(with_tx(VINTAGE, body="SELECT * EXCLUDE (widx) FROM vintage")))
def d11_leap(spark, folder):
    return leap_inputs(spark, folder).vintage


@query("d13_quarter_map_leap", leap(with_tx(DATED, body=f"""
SELECT DISTINCT fiscal_week, CAST((widx - s) // {PER_QUARTER} + 1 AS INTEGER) AS quarter
FROM dated, edge WHERE widx BETWEEN s AND e""")))
def d13_leap(spark, folder):
    data = leap_inputs(spark, folder)
    weeks = data.calendar.attach(data.plain.select("trn_date").distinct()).select("fiscal_week").distinct()
    quarter = data.calendar.quarter_of_week("fiscal_week", data.start, PER_QUARTER)
    return weeks.where(F.col("fiscal_week").between(data.start, data.end)).withColumn("quarter", quarter)


@query("d16_active_households_leap", leap(with_tx(SEGMENTS, body="SELECT * FROM active")))
def d16_leap(spark, folder):
    return leap_inputs(spark, folder).stored().active


@query("d18_rank_pillars_leap", leap(with_tx(PILLARS, body="SELECT * FROM ranked")))
def d18_leap(spark, folder):
    return B.rank_pillars(leap_inputs(spark, folder).stored().pillars)


@query("d22_household_segments_leap", leap(with_tx(SCORES, body="""
SELECT * FROM lapsed UNION ALL SELECT * FROM fresh
UNION ALL SELECT hh_id, segment FROM active WHERE segment = 'inconsistent'
UNION ALL SELECT hh_id, segment FROM scored""")))
def d22_leap(spark, folder):
    data = leap_inputs(spark, folder).stored()
    return B.household_segments(data.weekly, data.vintage, data.everything, data.start, data.end,
                                PER_QUARTER, VISITS, markets=markets(spark, folder), calendar=data.calendar)


@query("f01_weeks_back", with_tx(BOUNDS, body="""
SELECT CAST(CEIL((last_date - trn_date) / 7.0) AS INTEGER) AS week, CAST(SUM(units) AS BIGINT) AS units
FROM tx, bounds GROUP BY 1"""))
def f01(spark, folder):
    _, end = date_bounds(spark, folder)
    return transactions(spark, folder).groupBy(C.weeks_back("trn_date", end).alias("week")).agg(
        F.sum("units").alias("units"))


@query("f02_timeline_position", with_tx(BOUNDS, body="""
SELECT day, CAST(CEIL(day / 7.0) AS INTEGER) AS week, CAST(CEIL(day / 91.0) AS INTEGER) AS quarter,
       CASE CEIL(day / 91.0) WHEN 1 THEN 2300 WHEN 2 THEN 2400 WHEN 3 THEN 2600 ELSE 2700 END AS weight,
       CAST(SUM(units) AS BIGINT) AS units
FROM (SELECT CAST(trn_date - last_date + 364 AS INTEGER) AS day, units FROM tx, bounds)
WHERE day BETWEEN 1 AND 364 GROUP BY ALL"""))
def f02(spark, folder):
    _, end = date_bounds(spark, folder)
    daily = transactions(spark, folder, C.ANCHOR, end).groupBy(
        C.timeline_day("trn_date", end).alias("day")).agg(F.sum("units").alias("units"))
    return daily.join(C.timeline(spark), "day")


@query("f03_lookback_window", with_tx(BOUNDS, body=""",
win AS (SELECT last_date - CAST(isodow(last_date) - 1 AS INTEGER) AS monday FROM bounds)
SELECT CAST(monday - 364 AS VARCHAR) AS window_start, CAST(monday - 1 AS VARCHAR) AS window_end,
       COUNT(DISTINCT hh_id) AS households FROM tx, win WHERE trn_date BETWEEN monday - 364 AND monday - 1 GROUP BY ALL"""))
def f03(spark, folder):
    _, last = date_bounds(spark, folder)
    start, end = C.lookback_window(last, 52)
    return transactions(spark, folder, start, end).agg(F.count_distinct("hh_id").alias("households")).select(
        F.lit(str(start)).alias("window_start"), F.lit(str(end)).alias("window_end"), "households")


@query("f06_fiscal_calendar", with_tx(DATED, body="""
SELECT CAST(trn_date AS VARCHAR) AS day, fiscal_week, fiscal_month, fiscal_quarter, fiscal_year,
       CAST(SUM(units) AS BIGINT) AS units FROM dated GROUP BY ALL"""))
def f06(spark, folder):
    first, last = date_bounds(spark, folder)
    calendar = C.fiscal_calendar(spark, first, last)
    daily = drop_returns(transactions(spark, folder)).groupBy("trn_date").agg(F.sum("units").alias("units"))
    return calendar.join(daily, "trn_date").withColumn("day", F.col("trn_date").cast("string")).drop("trn_date")


@query("s18_pending_periods", """
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN (
  SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def s18(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_orderdate", "o_orderpriority", "o_orderstatus"]).withColumn(
        "period", F.to_date("o_orderdate").cast("string"))
    receipts = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return pending_periods(orders, receipts, "period")


@query("s19_generated_timeline", with_tx(BOUNDS, body="""
SELECT CAST(CEIL(day / 91.0) AS INTEGER) AS quarter,
       CASE CEIL(day / 91.0) WHEN 1 THEN 2300 WHEN 2 THEN 2400 WHEN 3 THEN 2600 ELSE 2700 END AS weight,
       CAST(SUM(net_cents) AS BIGINT) AS sales_cents, COUNT(DISTINCT basket_id) AS visits, CAST(SUM(units) AS BIGINT) AS units
FROM (SELECT *, CAST(trn_date - last_date + 364 AS INTEGER) AS day FROM tx, bounds)
WHERE day BETWEEN 1 AND 364 GROUP BY ALL"""))
def s19(spark, folder):
    _, end = date_bounds(spark, folder)
    placed = transactions(spark, folder, C.ANCHOR, end).withColumn("day", C.timeline_day("trn_date", end)).join(
        C.timeline(spark), "day")
    return kpi_aggregate(placed, ["quarter", "weight"])
