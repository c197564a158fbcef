"""Audience queries: product lists, propensity, sizing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hearthline.operators import lists as L
from hearthline.operators import propensity as P
from hearthline.plans.bindings import (
    BOUNDS, LABELS, LISTS, PRODUCTS, segment_labels, segment_lists, with_tx, year_start)
from hearthline.plans.registry import query
from hearthline.sources.tables import date_bounds, products, read_table, transactions

SPECS = {
    "warm_bolts": {"filter": {"department": ["ECONOMY", "PROMO"]},
                   "must_contain": [["red", "hot"], ["bolt"]], "composes": "fasteners"},
    "plain_rods": {"filter": {"department": ["SMALL", "MEDIUM"]}, "must_contain": [[" rod"]],
                   "must_not_contain": [["old", "cold"]], "composes": "fasteners"},
    "gizmos": {"filter": {"department": ["LARGE"]}, "must_contain": [["gizmo"]]},
}
FIELDS = ["product_name"]

SPEC_LISTS = PRODUCTS + """,
spec AS (
  SELECT upc, 'warm_bolts' AS name FROM products WHERE department IN ('ECONOMY', 'PROMO')
    AND regexp_matches(product_name, 'red|hot') AND regexp_matches(product_name, 'bolt')
  UNION ALL SELECT upc, 'plain_rods' FROM products WHERE department IN ('SMALL', 'MEDIUM')
    AND regexp_matches(product_name, ' rod') AND NOT regexp_matches(product_name, 'old|cold')
  UNION ALL SELECT upc, 'gizmos' FROM products WHERE department IN ('LARGE')
    AND regexp_matches(product_name, 'gizmo')),
pattern_lists AS (
  SELECT upc, name AS segment FROM spec
  UNION SELECT upc, 'fasteners' FROM spec WHERE name IN ('warm_bolts', 'plain_rods'))"""


@query("d01_category_upc_lists", with_tx(LISTS, body="SELECT segment, upc FROM lists"))
def d01(spark, folder):
    return segment_lists(spark, folder)


@query("d02_segment_reach", with_tx(LISTS, body="""
SELECT segment, COUNT(DISTINCT hh_id) AS households FROM tx JOIN lists USING (upc), bounds
WHERE trn_date > last_date - 364 GROUP BY segment"""))
def d02(spark, folder):
    _, end = date_bounds(spark, folder)
    return L.segment_reach(transactions(spark, folder, year_start(end), end),
                           segment_lists(spark, folder))


@query("d03_percentile_propensity", with_tx(LABELS, body="SELECT * FROM audience"))
def d03(spark, folder):
    return segment_labels(spark, folder)


@query("d04_volume_propensity", with_tx(PRODUCTS, body=""",
items AS (
  SELECT hh_id, units, CASE WHEN size = 1 THEN 'THIRD PARTY' ELSE department || CASE WHEN size > 25 THEN ' BULK' ELSE ' UNIT' END END AS kind
  FROM tx JOIN products USING (upc) WHERE NOT is_return AND department IN ('PROMO', 'ECONOMY')),
totals AS (
  SELECT kind, hh_id, CAST(SUM(units) AS BIGINT) AS volume FROM items WHERE kind <> 'THIRD PARTY' GROUP BY 1, 2
  UNION ALL SELECT 'ALL', hh_id, CAST(SUM(units) AS BIGINT) FROM items GROUP BY 2),
cuts AS (SELECT kind, quantile_disc(volume, 0.33) AS low, quantile_disc(volume, 0.66) AS high FROM totals GROUP BY kind)
SELECT kind, hh_id, volume, CASE WHEN volume < low THEN 'L' WHEN volume > high THEN 'H' ELSE 'M' END AS propensity
FROM totals JOIN cuts USING (kind)"""))
def d04(spark, folder):
    kind = F.when(F.col("size") == 1, "THIRD PARTY").otherwise(
        F.concat("department", F.when(F.col("size") > 25, " BULK").otherwise(" UNIT")))
    items = (transactions(spark, folder).where(~F.col("is_return"))
             .join(products(spark, folder).where(F.col("department").isin("PROMO", "ECONOMY")), "upc")
             .select("hh_id", "units", kind.alias("kind")))
    return P.volume_propensity(items, "kind", "units", "ALL", ["THIRD PARTY"])


@query("d05_buyers_audience", with_tx(PRODUCTS, body=""", lists AS (
  SELECT department AS segment, upc FROM products WHERE department NOT IN ('SMALL'))
SELECT DISTINCT segment, hh_id, 'H' AS propensity FROM tx JOIN lists USING (upc)"""))
def d05(spark, folder):
    chosen = products(spark, folder).where(F.col("department") != "SMALL").select(
        F.col("department").alias("segment"), "upc")
    return P.buyers_audience(transactions(spark, folder), chosen)


@query("d06_sensitive_audience", with_tx(LISTS, body="""
SELECT DISTINCT segment, hh_id, 'H' AS propensity FROM tx JOIN lists USING (upc), bounds
WHERE trn_date > last_date - 182"""))
def d06(spark, folder):
    _, end = date_bounds(spark, folder)
    start = end - dt.timedelta(days=181)
    return P.buyers_audience(transactions(spark, folder, start, end), segment_lists(spark, folder), start)


@query("d07_regex_audiences", with_tx(SPEC_LISTS, body="""
SELECT DISTINCT segment, hh_id, 'H' AS propensity FROM tx JOIN pattern_lists USING (upc)"""))
def d07(spark, folder):
    chosen = L.regex_upc_lists(products(spark, folder), SPECS, FIELDS)
    return P.buyers_audience(transactions(spark, folder), chosen)


@query("d08_like_audience", with_tx(PRODUCTS, body=""", chosen AS (
  SELECT upc FROM products WHERE (product_name LIKE '%ring%' OR commodity LIKE '%ring%')
    AND department NOT IN ('PROMO', 'LARGE'))
SELECT 'rings' AS segment, COUNT(DISTINCT hh_id) AS households,
       (SELECT COUNT(*) FROM chosen) AS products FROM tx JOIN chosen USING (upc)"""))
def d08(spark, folder):
    chosen = L.like_upc_list(products(spark, folder), ["product_name", "commodity"], "%ring%",
                             {"department": ["PROMO", "LARGE"]}).withColumn("segment", F.lit("rings"))
    size = chosen.groupBy("segment").agg(F.count(F.lit(1)).alias("products"))
    return L.segment_reach(transactions(spark, folder), chosen).join(size, "segment")


GENERATIONS = {"AUTOMOBILE": "drivers", "BUILDING": "builders", "FURNITURE": "decorators",
               "MACHINERY": "makers"}


@query("d09_label_audience", with_tx(BOUNDS, body="""
SELECT DISTINCT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'drivers' WHEN 'BUILDING' THEN 'builders'
       WHEN 'FURNITURE' THEN 'decorators' ELSE 'makers' END AS segment, c_custkey AS hh_id, 'H' AS propensity
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')
AND c_custkey IN (SELECT hh_id FROM tx, bounds WHERE trn_date > last_date - 364)"""))
def d09(spark, folder):
    _, end = date_bounds(spark, folder)
    people = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("hh_id"), "c_mktsegment")
    active = transactions(spark, folder, year_start(end), end).select("hh_id")
    return P.label_audience(people, active, "c_mktsegment", GENERATIONS)


@query("d29_segment_counts", with_tx(LABELS, body="""
SELECT segment, propensity, COUNT(DISTINCT hh_id) AS households FROM audience GROUP BY 1, 2"""))
def d29(spark, folder):
    return P.segment_counts(segment_labels(spark, folder), ["segment", "propensity"])


@query("d30_select_propensities", with_tx(LABELS, body=""", sizes AS (
  SELECT segment, propensity, COUNT(*) AS households FROM audience GROUP BY 1, 2),
running AS (
  SELECT *, CAST(COALESCE(SUM(households) OVER (PARTITION BY segment ORDER BY CASE propensity
    WHEN 'H' THEN 1 WHEN 'M' THEN 2 ELSE 3 END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
    AS households_before FROM sizes)
SELECT segment, propensity, households, households_before FROM running WHERE households_before < 200"""))
def d30(spark, folder):
    sizes = P.segment_counts(segment_labels(spark, folder), ["segment", "propensity"])
    return P.select_propensities(sizes, 200)
