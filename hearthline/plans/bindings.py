"""How the operators are bound to the given tables, in Spark and in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from hearthline.operators.lists import category_upc_lists, definitions_frame
from hearthline.operators.propensity import percentile_propensity
from hearthline.sources.tables import date_bounds, products, transactions

# One row per scanned item.
TX = """tx AS (
  SELECT o_custkey AS hh_id, l_partkey AS upc, l_orderkey AS basket_id,
         CAST(o_orderdate AS DATE) AS trn_date, CAST(l_quantity AS BIGINT) AS units,
         CAST(ROUND(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) AS net_cents,
         l_returnflag = 'R' AS is_return, l_suppkey AS store_id, s_nationkey AS div_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS upc, p_type AS department, p_brand AS commodity,
         p_brand || '|' || CAST(p_size AS VARCHAR) AS sub_commodity,
         p_name AS product_name, p_size AS size,
         CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price_cents
  FROM part)"""

STORES = """stores AS (
  SELECT s_suppkey AS store_id, s_nationkey AS div_no,
         25 + (s_suppkey * 7919 % 2500) / 100.0::DOUBLE AS lat,
         -125 + (s_suppkey * 104729 % 5800) / 100.0::DOUBLE AS lon
  FROM supplier)"""

BOUNDS = """bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS first_date,
  CAST(max(o_orderdate) AS DATE) AS last_date FROM orders)"""


def with_tx(*ctes: str, body: str) -> str:
    """SQL text: the item view, further CTEs, then the final select."""
    return "WITH " + ",\n".join([TX, *ctes]) + ("" if body.startswith(",") else "\n") + body


# Category lists in the shape the operators take.
CATEGORY_DEFINITIONS = {
    "seg_a": {"commodities": ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"],
              "sub_commodities": [], "weeks": 52},
    "seg_b": {"commodities": [], "sub_commodities": ["Brand#7|10", "Brand#8|20", "Brand#9|30",
                                                     "Brand#10|40", "Brand#11|50"], "weeks": 208},
    "seg_c": {"commodities": ["Brand#11", "Brand#12"],
              "sub_commodities": ["Brand#13|5", "Brand#14|6"], "weeks": 208},
}

CATEGORY_SQL = "definitions(segment, level, value, weeks) AS (VALUES " + ", ".join(
    f"('{name}', '{level}', '{value}', {spec['weeks']})"
    for name, spec in CATEGORY_DEFINITIONS.items()
    for level, key in (("commodity", "commodities"), ("sub_commodity", "sub_commodities"))
    for value in spec[key]) + ")"

MEMBERS = """members AS (
  SELECT DISTINCT d.segment, p.upc, d.weeks FROM products p JOIN definitions d
  ON (d.level = 'commodity' AND d.value = p.commodity)
  OR (d.level = 'sub_commodity' AND d.value = p.sub_commodity))"""

# Product lists of the three category segments.
LISTS = ",\n".join([PRODUCTS, CATEGORY_SQL, BOUNDS, MEMBERS, """sold AS (
  SELECT DISTINCT upc, CAST(CEIL((last_date - trn_date) / 7.0) AS INT) AS week FROM tx, bounds),
lists AS (
  SELECT DISTINCT m.segment, m.upc FROM members m JOIN sold s ON m.upc = s.upc
  WHERE s.week <= m.weeks)"""])

# Spend labels on those lists over the last 52 weeks.
LABELS = LISTS + """,
spend AS (
  SELECT segment, hh_id, CAST(SUM(net_cents) AS BIGINT) AS spend_cents
  FROM tx JOIN lists USING (upc), bounds
  WHERE NOT is_return AND net_cents > 0 AND trn_date > last_date - 364 GROUP BY segment, hh_id),
cuts AS (
  SELECT segment, quantile_disc(spend_cents, 0.33) AS low, quantile_disc(spend_cents, 0.66) AS high
  FROM spend GROUP BY segment),
audience AS (
  SELECT segment, hh_id, spend_cents,
         CASE WHEN spend_cents < low THEN 'L' WHEN spend_cents > high THEN 'H' ELSE 'M' END AS propensity
  FROM spend JOIN cuts USING (segment))"""


def year_start(end: dt.date) -> dt.date:
    """First day of the 52 weeks that close on ``end``."""
    return end - dt.timedelta(days=363)


def segment_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Product lists of the category segments (``LISTS``)."""
    _, end = date_bounds(spark, folder)
    longest = max(spec["weeks"] for spec in CATEGORY_DEFINITIONS.values())
    tx = transactions(spark, folder, end - dt.timedelta(days=longest * 7), end)
    return category_upc_lists(tx, products(spark, folder),
                              definitions_frame(spark, CATEGORY_DEFINITIONS), end)


def segment_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Spend labels of the category segments (``LABELS``)."""
    _, end = date_bounds(spark, folder)
    year = transactions(spark, folder, year_start(end), end)
    return percentile_propensity(year, segment_lists(spark, folder))
