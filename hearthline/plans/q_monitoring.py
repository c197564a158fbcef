"""Monitoring queries: eligibility, hierarchy report, reconciliation, dimension versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hearthline.operators import monitoring as M
from hearthline.operators.lists import segment_reach
from hearthline.operators.propensity import segment_counts
from hearthline.plans.bindings import (
    LABELS, LISTS, PRODUCTS, segment_labels, segment_lists, with_tx, year_start)
from hearthline.plans.q_predicates import FLAG_SQL, OFFSITE, ONSITE, flags
from hearthline.plans.q_sources import REGISTRY_SQL, definitions
from hearthline.plans.registry import query
from hearthline.sources.tables import date_bounds, products, read_table, transactions


@query("d32_segment_eligibility", with_tx(LABELS, FLAG_SQL, body=REGISTRY_SQL + """,
names(audience, frontend_name, type) AS (VALUES ('seg_a', 'First Brands ', 'percentile'), ('seg_b', 'Pack Sizes', 'percentile'), ('seg_c', 'Mixed', 'sensitive'))
SELECT a.segment, strftime(b.last_date, '%Y%m%d') AS period, COUNT(*) AS total_households, MAX(n.frontend_name) AS frontend_name, MAX(n.type) AS type,
  CAST(SUM(CASE WHEN email_flag = 'Y' OR push_flag = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS onsite_households,
  CAST(SUM(CASE WHEN social_flag = 'Y' OR video_flag = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS offsite_households,
  CAST(SUM(CASE WHEN email_flag = 'Y' OR social_flag = 'Y' OR video_flag = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS overall_households
FROM audience a JOIN registry r ON r.audience = a.segment AND list_contains(r.propensities, a.propensity)
JOIN names n ON n.audience = a.segment LEFT JOIN flags f USING (hh_id), bounds b GROUP BY 1, 2"""))
def d32(spark, folder):
    _, end = date_bounds(spark, folder)
    audience = segment_labels(spark, folder).withColumn("period", F.lit(end.strftime("%Y%m%d")))
    return M.segment_eligibility(audience, flags(spark, folder), definitions(spark), ONSITE, OFFSITE,
                                 ["email_flag", "social_flag", "video_flag"])


@query("d33_hierarchy_report", with_tx(PRODUCTS, FLAG_SQL, body=""",
buyers AS (SELECT DISTINCT hh_id, department, commodity FROM tx JOIN products USING (upc)),
reach AS (
  SELECT department, commodity, COUNT(*) AS households,
    CAST(SUM(CASE WHEN email_flag = 'Y' OR push_flag = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS onsite_households,
    CAST(SUM(CASE WHEN social_flag = 'Y' OR video_flag = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS offsite_households
  FROM buyers LEFT JOIN flags USING (hh_id) GROUP BY 1, 2),
words AS (SELECT department, commodity, word, COUNT(*) AS n FROM (SELECT department, commodity, unnest(string_split(product_name, ' ')) AS word FROM products) GROUP BY 1, 2, 3),
tops AS (SELECT department, commodity, string_agg(word, ', ' ORDER BY rn) AS top_words FROM (
  SELECT *, row_number() OVER (PARTITION BY department, commodity ORDER BY n DESC, word) AS rn FROM words) WHERE rn <= 100 GROUP BY 1, 2),
samples AS (SELECT department, commodity, string_agg(product_name, ', ' ORDER BY rn) AS product_sample FROM (
  SELECT *, row_number() OVER (PARTITION BY department, commodity ORDER BY md5(CAST(upc AS VARCHAR)), upc) AS rn FROM products) WHERE rn <= 30 GROUP BY 1, 2)
SELECT * FROM reach JOIN tops USING (department, commodity) JOIN samples USING (department, commodity)"""))
def d33(spark, folder):
    return M.hierarchy_report(transactions(spark, folder), products(spark, folder), flags(spark, folder),
                              ["department", "commodity"], ONSITE, OFFSITE)


@query("d34_segment_describe", with_tx(LISTS, body=""",
t AS (SELECT segment, upc, 'product_name' AS source, product_name AS t FROM lists JOIN products USING (upc)
  UNION ALL SELECT segment, upc, 'department', department FROM lists JOIN products USING (upc)),
w AS (SELECT segment, source, word, COUNT(*) AS n FROM (SELECT segment, source, unnest(string_split(t, ' ')) AS word FROM t) GROUP BY 1, 2, 3),
tops AS (SELECT segment, source, string_agg(word, ', ' ORDER BY rn) AS top_words FROM (
  SELECT *, row_number() OVER (PARTITION BY segment, source ORDER BY n DESC, word) AS rn FROM w) WHERE rn <= 100 GROUP BY 1, 2),
s AS (SELECT segment, source, string_agg(t, ', ' ORDER BY rn) AS samples FROM (
  SELECT *, row_number() OVER (PARTITION BY segment, source ORDER BY md5(CAST(upc AS VARCHAR)), upc) AS rn FROM t) WHERE rn <= 30 GROUP BY 1, 2)
SELECT * FROM tops JOIN s USING (segment, source)"""))
def d34(spark, folder):
    return M.segment_describe(segment_lists(spark, folder), products(spark, folder), ["product_name", "department"])


@query("d35_reconcile", with_tx(LABELS, body=""",
sizes AS (SELECT segment, COUNT(DISTINCT hh_id) AS households FROM audience GROUP BY 1),
year AS (SELECT * FROM tx, bounds WHERE trn_date > last_date - 364),
per AS (SELECT upc, COUNT(*) AS n, COUNT(DISTINCT hh_id) AS h FROM year GROUP BY 1),
sums AS (SELECT segment, CAST(SUM(n) AS BIGINT) AS item_rows, CAST(SUM(h) AS BIGINT) AS summed_households FROM lists JOIN per USING (upc) GROUP BY 1),
once AS (SELECT segment, COUNT(DISTINCT hh_id) AS distinct_households FROM lists JOIN year USING (upc) GROUP BY 1)
SELECT segment, households, item_rows, summed_households, distinct_households, households - distinct_households AS difference
FROM sizes JOIN sums USING (segment) JOIN once USING (segment)"""))
def d35(spark, folder):
    """Labels and transactions of the same 52 weeks."""
    _, end = date_bounds(spark, folder)
    sizes = segment_counts(segment_labels(spark, folder), ["segment"])
    return M.reconcile(sizes, segment_lists(spark, folder), transactions(spark, folder, year_start(end), end))


@query("d35_list_reach", with_tx(LISTS, body="""
SELECT segment, COUNT(DISTINCT hh_id) AS households FROM tx JOIN lists USING (upc) GROUP BY 1"""))
def d35_reach(spark, folder):
    return segment_reach(transactions(spark, folder), segment_lists(spark, folder))


SPLIT = dt.date(1998, 1, 1)


@query("d36_cycle_household_counts", with_tx(body="""
SELECT category, COUNT(DISTINCT hh_id) AS households FROM (
  SELECT hh_id, CASE WHEN trn_date < DATE '1998-01-01' THEN p_brand ELSE p_type END AS category FROM tx JOIN part ON p_partkey = upc) GROUP BY 1"""))
def d36(spark, folder):
    """Before 1998 products are classified by brand, from then on by type."""
    part = read_table(spark, folder, "part")
    old = part.select(F.col("p_partkey").alias("upc"), F.col("p_brand").alias("category"),
                      F.lit(dt.date(1900, 1, 1)).alias("valid_from"), F.lit(SPLIT).alias("valid_to"))
    new = part.select(F.col("p_partkey").alias("upc"), F.col("p_type").alias("category"),
                      F.lit(SPLIT).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return M.cycle_household_counts(transactions(spark, folder), old.unionByName(new), "category")
