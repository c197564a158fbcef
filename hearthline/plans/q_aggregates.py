"""Aggregation, window, sort and sampling queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hearthline.operators import monitoring as M
from hearthline.operators import ranks as R
from hearthline.operators import reports as Q
from hearthline.operators import text as X
from hearthline.operators.clusters import cluster_profile
from hearthline.operators.geo import share_of_households
from hearthline.operators.skew import salted_lookup
from hearthline.plans.bindings import LISTS, PRODUCTS, segment_lists, with_tx
from hearthline.plans.registry import query
from hearthline.sources.tables import products, read_table, transactions, with_products

SALES = "CAST(SUM(net_cents) AS BIGINT) AS sales_cents"


def item_products(spark, folder):
    columns = ["department", "commodity", "size", "product_name"]
    return with_products(transactions(spark, folder), products(spark, folder), columns)


@query("a01_sum_count_avg", with_tx(PRODUCTS, body=f"""
SELECT department, commodity, {SALES}, COUNT(*) AS items, ROUND(CAST(SUM(units) AS BIGINT) / COUNT(*), 6) AS avg_units
FROM tx JOIN products USING (upc) GROUP BY 1, 2"""))
def a01(spark, folder):
    return item_products(spark, folder).groupBy("department", "commodity").agg(
        F.sum("net_cents").alias("sales_cents"), F.count(F.lit(1)).alias("items"),
        F.round(F.sum("units") / F.count(F.lit(1)), 6).alias("avg_units"))


@query("a02_count_distinct", with_tx(PRODUCTS, body="""
SELECT commodity, COUNT(DISTINCT hh_id) AS households FROM tx JOIN products USING (upc) GROUP BY 1"""))
def a02(spark, folder):
    return item_products(spark, folder).groupBy("commodity").agg(F.count_distinct("hh_id").alias("households"))


@query("a03_global_aggregate", with_tx(body=f"""
SELECT COUNT(*) AS items, {SALES}, CAST(MAX(trn_date) AS VARCHAR) AS last_day FROM tx"""))
def a03(spark, folder):
    return transactions(spark, folder).agg(
        F.count(F.lit(1)).alias("items"), F.sum("net_cents").alias("sales_cents"),
        F.max("trn_date").cast("string").alias("last_day"))


@query("a04_quantile_cuts", with_tx(PRODUCTS, body=""",
spend AS (SELECT department, hh_id, CAST(SUM(net_cents) AS BIGINT) AS c FROM tx JOIN products USING (upc) GROUP BY 1, 2)
SELECT department, quantile_disc(c, 0.33) AS p33, quantile_disc(c, 0.66) AS p66, quantile_disc(c, 0.95) AS p95
FROM spend GROUP BY 1"""))
def a04(spark, folder):
    spend = item_products(spark, folder).groupBy("department", "hh_id").agg(F.sum("net_cents").alias("c"))
    return R.quantile_cuts(spend, ["department"], "c", {"p33": 0.33, "p66": 0.66, "p95": 0.95})


@query("a05_first_by_order", with_tx(body="""
SELECT hh_id, arg_min(store_id, CAST(strftime(trn_date, '%Y%m%d') AS BIGINT) * 1000000 + store_id) AS first_store FROM tx GROUP BY 1"""))
def a05(spark, folder):
    return transactions(spark, folder).groupBy("hh_id").agg(
        F.min_by("store_id", F.struct("trn_date", "store_id")).alias("first_store"))


@query("a06_concat_list", with_tx(PRODUCTS, body="""
SELECT department, size, string_agg(DISTINCT commodity, ', ' ORDER BY commodity) AS commodities FROM products GROUP BY 1, 2"""))
def a06(spark, folder):
    return products(spark, folder).select("department", "size", "commodity").distinct().groupBy(
        "department", "size").agg(F.array_join(F.sort_array(F.collect_list("commodity")), ", ").alias("commodities"))


@query("a07_pivot_sum", with_tx(PRODUCTS, body="""
SELECT commodity, CAST(COALESCE(SUM(net_cents) FILTER (is_return), 0) AS BIGINT) AS returned,
       CAST(COALESCE(SUM(net_cents) FILTER (NOT is_return), 0) AS BIGINT) AS kept FROM tx JOIN products USING (upc) GROUP BY 1"""))
def a07(spark, folder):
    kind = F.when(F.col("is_return"), "returned").otherwise("kept")
    return item_products(spark, folder).withColumn("kind", kind).groupBy("commodity").pivot(
        "kind", ["returned", "kept"]).agg(F.sum("net_cents")).fillna(0)


@query("a08_share_of_distinct", """
SELECT c_mktsegment, COUNT(DISTINCT c_custkey) AS seg_count,
       ROUND(COUNT(DISTINCT c_custkey) * 100 / (SELECT COUNT(DISTINCT c_custkey) FROM customer), 4) AS seg_percent
FROM customer GROUP BY 1""")
def a08(spark, folder):
    return share_of_households(read_table(spark, folder, "customer"), "c_mktsegment", "c_custkey", "seg")


@query("a09_proportion_matching", """
SELECT lang, CAST(SUM(CASE WHEN contains(lower(text), 'license') THEN 1 ELSE 0 END) AS BIGINT) AS num_matches,
       COUNT(*) AS total_num,
       ROUND(CAST(SUM(CASE WHEN contains(lower(text), 'license') THEN 1 ELSE 0 END) AS BIGINT) / COUNT(*), 6) AS prop_match
FROM documents GROUP BY 1""")
def a09(spark, folder):
    docs = read_table(spark, folder, "documents").withColumn("flag", F.lower("text").contains("license"))
    return M.proportion_matching(docs, "lang", "flag")


@query("a10_summary_statistics", with_tx(body=""",
s AS (SELECT hh_id, CAST(SUM(net_cents) AS BIGINT) AS v FROM tx GROUP BY 1)
SELECT COUNT(*) AS count, ROUND(CAST(SUM(v) AS BIGINT) / COUNT(*), 4) AS mean, ROUND(stddev_samp(v), 2) AS stddev,
       MIN(v) AS min, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.5) AS median, quantile_disc(v, 0.75) AS q3, MAX(v) AS max FROM s"""))
def a10(spark, folder):
    spend = transactions(spark, folder).groupBy("hh_id").agg(F.sum("net_cents").alias("v"))
    return Q.describe(spend, "v")


@query("a11_cluster_profile", with_tx(PRODUCTS, body="""
SELECT size AS cluster, COUNT(*) AS num_upcs, COUNT(DISTINCT department) AS num_department,
  COUNT(DISTINCT commodity) AS num_commodity, COUNT(DISTINCT product_name) AS num_product_name,
  ROUND(COUNT(*) / COUNT(DISTINCT department), 6) AS upcs_per_department, ROUND(COUNT(*) / COUNT(DISTINCT commodity), 6) AS upcs_per_commodity,
  ROUND(COUNT(*) / COUNT(DISTINCT product_name), 6) AS upcs_per_product_name, ROUND(1 / COUNT(DISTINCT department), 6) AS department_upc_prop,
  ROUND(1 / COUNT(DISTINCT commodity), 6) AS commodity_upc_prop, ROUND(1 / COUNT(DISTINCT product_name), 6) AS product_name_upc_prop
FROM products GROUP BY 1"""))
def a11(spark, folder):
    return cluster_profile(products(spark, folder).withColumnRenamed("size", "cluster"), "cluster",
                           ["department", "commodity", "product_name"])


@query("a12_duplicate_report", """
WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY ALL),
k AS (SELECT l_orderkey, COUNT(*) AS payloads, SUM(n) AS n FROM r GROUP BY 1)
SELECT CAST(SUM(n) AS BIGINT) AS total_rows, CAST(SUM(payloads) AS BIGINT) AS distinct_rows, COUNT(*) AS distinct_keys,
       CAST(SUM(CASE WHEN payloads > 1 THEN 1 ELSE 0 END) AS BIGINT) AS conflicting_keys FROM k""")
def a12(spark, folder):
    return M.duplicate_report(
        read_table(spark, folder, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"]), "l_orderkey")


@query("a13_null_pattern", """
SELECT quality IS NULL AS quality_null, quality IS NULL OR quality = 0 AS good_null, COUNT(*) AS rows
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2""")
def a13(spark, folder):
    marks = read_table(spark, folder, "documents", ["doc_id"]).join(
        read_table(spark, folder, "labels"), "doc_id", "left").withColumn(
        "good", F.when(F.col("quality") > 0, F.col("quality")))
    return M.null_pattern(marks, ["quality", "good"])


@query("a14_histogram_bins", with_tx(body=""",
s AS (SELECT hh_id, SUM(units) AS v FROM tx GROUP BY 1)
SELECT CAST(CASE WHEN v < 0 THEN 0 WHEN v >= 2000 THEN 21 ELSE floor(v / 100) + 1 END AS INTEGER) AS bin, COUNT(*) AS rows FROM s GROUP BY 1"""))
def a14(spark, folder):
    units = transactions(spark, folder).groupBy("hh_id").agg(F.sum("units").alias("v"))
    return M.histogram_bins(units, "v", 0, 2000, 20)


@query("a15_segment_facts", with_tx(PRODUCTS, body="""
SELECT department, COUNT(*) AS items, MAX(product_name) AS product_name, MAX(commodity) AS commodity,
       CAST(SUM(CASE WHEN is_return THEN 1 ELSE 0 END) AS BIGINT) AS returns FROM tx JOIN products USING (upc) GROUP BY 1"""))
def a15(spark, folder):
    return Q.facts_with_labels(item_products(spark, folder), ["department"], ["product_name", "commodity"],
                               {"returns": F.col("is_return").cast("int")}, "items")


@query("a16_product_popularity", with_tx(body="""
SELECT upc, COUNT(*) AS item_rows, COUNT(hh_id) AS household_rows, COUNT(DISTINCT hh_id) AS households FROM tx GROUP BY 1"""))
def a16(spark, folder):
    return M.product_popularity(transactions(spark, folder))


@query("w01_percent_rank", with_tx(PRODUCTS, body=""",
s AS (SELECT department, hh_id, CAST(SUM(net_cents) AS BIGINT) AS sales_cents FROM tx JOIN products USING (upc) GROUP BY 1, 2)
SELECT *, percent_rank() OVER (PARTITION BY department ORDER BY sales_cents) AS percentile FROM s"""))
def w01(spark, folder):
    spend = item_products(spark, folder).groupBy("department", "hh_id").agg(F.sum("net_cents").alias("sales_cents"))
    lookup = R.percent_rank_lookup(spend, ["department"], "sales_cents", "percentile")
    return salted_lookup(spend, lookup, ["department", "sales_cents"], spread="hh_id", weight="n")


@query("w02_rank_by_group", with_tx(PRODUCTS, body=f"""
SELECT department, commodity, sales_cents, CAST(rank() OVER (PARTITION BY department ORDER BY sales_cents DESC) AS INTEGER) AS sales_rank
FROM (SELECT department, commodity, {SALES} FROM tx JOIN products USING (upc) GROUP BY 1, 2)"""))
def w02(spark, folder):
    sales = item_products(spark, folder).groupBy("department", "commodity").agg(F.sum("net_cents").alias("sales_cents"))
    return sales.withColumn("sales_rank", F.rank().over(
        Window.partitionBy("department").orderBy(F.desc("sales_cents"))))


@query("w03_global_rank", with_tx(body="""
SELECT upc, units, rank() OVER (ORDER BY units DESC) AS units_rank
FROM (SELECT upc, CAST(SUM(units) AS BIGINT) AS units FROM tx GROUP BY 1)"""))
def w03(spark, folder):
    units = transactions(spark, folder).groupBy("upc").agg(F.sum("units").alias("units"))
    return R.with_descending_rank(units, [], "units", "units_rank", "upc")


@query("w04_top_n_per_group", with_tx(PRODUCTS, body="""
SELECT department, commodity, items, CAST(position AS INTEGER) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY department ORDER BY items DESC, commodity) AS position
  FROM (SELECT department, commodity, COUNT(*) AS items FROM tx JOIN products USING (upc) GROUP BY 1, 2)) WHERE position <= 5"""))
def w04(spark, folder):
    items = item_products(spark, folder).groupBy("department", "commodity").agg(F.count(F.lit(1)).alias("items"))
    return X.top_n(items, ["department"], [F.desc("items"), F.asc("commodity")], 5)


@query("w05_calendar_buckets", with_tx(body="""
SELECT CAST(1995 + w // 52 AS VARCHAR) AS fiscal_year, w % 52 AS week_of_year, n,
       CAST(CEIL(row_number() OVER (PARTITION BY w // 52 ORDER BY w) / 13.0) AS INTEGER) AS bucket
FROM (SELECT CAST((trn_date - DATE '1995-01-01') // 7 AS INTEGER) AS w, COUNT(*) AS n FROM tx GROUP BY 1)"""))
def w05(spark, folder):
    return Q.week_buckets(transactions(spark, folder), "trn_date", 13)


@query("w06_partition_sum", with_tx(PRODUCTS, body=f"""
SELECT *, CAST(SUM(sales_cents) OVER (PARTITION BY commodity) AS BIGINT) AS commodity_cents
FROM (SELECT commodity, size, {SALES} FROM tx JOIN products USING (upc) GROUP BY 1, 2)"""))
def w06(spark, folder):
    sales = item_products(spark, folder).groupBy("commodity", "size").agg(F.sum("net_cents").alias("sales_cents"))
    return sales.withColumn("commodity_cents", F.sum("sales_cents").over(Window.partitionBy("commodity")))


@query("t01_multi_key_sort", with_tx(PRODUCTS, body=f"""
SELECT department, commodity, {SALES} FROM tx JOIN products USING (upc) GROUP BY 1, 2 ORDER BY department, sales_cents DESC"""))
def t01(spark, folder):
    sales = item_products(spark, folder).groupBy("department", "commodity").agg(F.sum("net_cents").alias("sales_cents"))
    return sales.orderBy(F.asc("department"), F.desc("sales_cents"))


@query("t02_limit", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' ORDER BY p_partkey LIMIT 50")
def t02(spark, folder):
    part = read_table(spark, folder, "part", ["p_partkey", "p_name"]).where(F.col("p_name").like("red%"))
    return part.orderBy("p_partkey").limit(50)


@query("t03_top_k_by_frequency", """
SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY 1 ORDER BY n DESC, word LIMIT 100""")
def t03(spark, folder):
    counted = X.word_counts(read_table(spark, folder, "documents"), [], "text")
    return counted.orderBy(F.desc("n"), "word").limit(100)


@query("t04_random_sample", """
SELECT p_partkey, p_name FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 200""")
def t04(spark, folder):
    return Q.stable_sample(read_table(spark, folder, "part", ["p_partkey", "p_name"]), "p_partkey", 200)


@query("t05_sample_per_group", """
SELECT p_type, p_partkey, CAST(position AS INTEGER) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) AS position FROM part)
WHERE position <= 30""")
def t05(spark, folder):
    return X.sample_per_group(read_table(spark, folder, "part", ["p_type", "p_partkey"]), ["p_type"], "p_partkey", 30)


@query("t06_top_products", with_tx(LISTS, body="""
SELECT segment, upc, item_rows, CAST(position AS INTEGER) AS position FROM (
  SELECT segment, upc, item_rows, row_number() OVER (PARTITION BY segment ORDER BY item_rows DESC, upc) AS position
  FROM lists JOIN (SELECT upc, COUNT(*) AS item_rows FROM tx GROUP BY 1) USING (upc)
  WHERE upc IN (SELECT upc FROM products WHERE price_cents >= 95000)) WHERE position <= 10"""))
def t06(spark, folder):
    valid = products(spark, folder).where(F.col("price_cents") >= 95_000).select("upc")
    return M.top_products(segment_lists(spark, folder), M.product_popularity(transactions(spark, folder)), valid)
