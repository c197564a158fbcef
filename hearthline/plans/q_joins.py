"""Join and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.operators import clusters as K
from hearthline.operators import joins as J
from hearthline.operators import text as X
from hearthline.operators.lists import regex_upc_lists
from hearthline.operators.propensity import buyers_audience
from hearthline.plans.bindings import PRODUCTS, with_tx
from hearthline.plans.q_audiences import FIELDS, SPEC_LISTS, SPECS
from hearthline.plans.registry import query
from hearthline.sources.tables import products, read_table, transactions

SALES = "CAST(SUM(net_cents) AS BIGINT) AS sales_cents"


@query("j01_inner_join", with_tx(PRODUCTS, body=f"""
SELECT department, {SALES} FROM tx JOIN products USING (upc) GROUP BY 1"""))
def j01(spark, folder):
    return transactions(spark, folder).join(products(spark, folder).select("upc", "department"), "upc").groupBy(
        "department").agg(F.sum("net_cents").alias("sales_cents"))


@query("j02_join_different_names", with_tx(body=f"""
SELECT s_name, {SALES} FROM tx JOIN supplier ON store_id = s_suppkey GROUP BY 1"""))
def j02(spark, folder):
    stores = read_table(spark, folder, "supplier", ["s_suppkey", "s_name"])
    per_store = transactions(spark, folder).groupBy("store_id").agg(F.sum("net_cents").alias("sales_cents"))
    return per_store.join(stores, per_store.store_id == stores.s_suppkey).select("s_name", "sales_cents")


@query("j03_multi_key_join", with_tx(body=""",
a AS (SELECT hh_id, store_id, SUM(units) AS units FROM tx WHERE is_return GROUP BY 1, 2),
b AS (SELECT hh_id, store_id, SUM(units) AS units FROM tx GROUP BY 1, 2)
SELECT hh_id, store_id, CAST(a.units AS BIGINT) AS returned, CAST(b.units AS BIGINT) AS units
FROM a JOIN b USING (hh_id, store_id)"""))
def j03(spark, folder):
    tx = transactions(spark, folder)
    returned = tx.where("is_return").groupBy("hh_id", "store_id").agg(F.sum("units").alias("returned"))
    everything = tx.groupBy("hh_id", "store_id").agg(F.sum("units").alias("units"))
    return returned.join(everything, ["hh_id", "store_id"])


@query("j04_left_join_default", with_tx(body=f"""
SELECT c_custkey AS hh_id, COALESCE(sales_cents, 0) AS sales_cents
FROM customer LEFT JOIN (SELECT hh_id, {SALES} FROM tx GROUP BY 1) ON hh_id = c_custkey"""))
def j04(spark, folder):
    people = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("hh_id"))
    sales = transactions(spark, folder).groupBy("hh_id").agg(F.sum("net_cents").alias("sales_cents"))
    return people.join(sales, "hh_id", "left").fillna(0, ["sales_cents"])


@query("j05_full_outer_join", with_tx(body="""
SELECT COALESCE(a.hh_id, b.hh_id) AS hh_id, COALESCE(a.n, 0) AS purchases, COALESCE(b.n, 0) AS events
FROM (SELECT hh_id, COUNT(*) AS n FROM tx GROUP BY 1) a
FULL JOIN (SELECT user_id AS hh_id, COUNT(*) AS n FROM events GROUP BY 1) b ON a.hh_id = b.hh_id"""))
def j05(spark, folder):
    bought = transactions(spark, folder).groupBy("hh_id").agg(F.count(F.lit(1)).alias("purchases"))
    seen = read_table(spark, folder, "events").groupBy(F.col("user_id").alias("hh_id")).agg(
        F.count(F.lit(1)).alias("events"))
    return bought.join(seen, "hh_id", "outer").fillna(0)


@query("j06_left_anti_join", with_tx(body="""
SELECT c_custkey AS hh_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"""))
def j06(spark, folder):
    people = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("hh_id"))
    seen = read_table(spark, folder, "events").select(F.col("user_id").alias("hh_id"))
    return people.join(seen, "hh_id", "left_anti")


@query("j07_left_semi_join", with_tx(PRODUCTS, body="""
SELECT DISTINCT hh_id FROM tx WHERE upc IN (SELECT upc FROM products WHERE product_name = 'red widget')"""))
def j07(spark, folder):
    listed = products(spark, folder).where(F.col("product_name") == "red widget").select("upc")
    return transactions(spark, folder).join(listed, "upc", "left_semi").select("hh_id").distinct()


@query("j08_share_of_own_total", with_tx(PRODUCTS, body=""",
s AS (SELECT department, commodity, CAST(SUM(net_cents) AS BIGINT) AS sales_cents FROM tx JOIN products USING (upc) GROUP BY 1, 2)
SELECT *, ROUND(sales_cents / CAST(SUM(sales_cents) OVER (PARTITION BY department) AS BIGINT), 6) AS share FROM s"""))
def j08(spark, folder):
    sales = transactions(spark, folder).join(products(spark, folder), "upc").groupBy(
        "department", "commodity").agg(F.sum("net_cents").alias("sales_cents"))
    return J.share_of_total(sales, ["department"], "sales_cents")


@query("j09_conflicting_payloads", """
SELECT p_name, COUNT(DISTINCT (p_brand, p_size)) AS payloads, COUNT(*) AS rows FROM part
GROUP BY 1 HAVING COUNT(DISTINCT (p_brand, p_size)) > 1""")
def j09(spark, folder):
    return J.conflicting_payloads(read_table(spark, folder, "part", ["p_name", "p_brand", "p_size"]), "p_name")


@query("j10_pairs_within_group", """
WITH p AS (SELECT p_size AS cluster, p_partkey AS id, p_type AS a, p_type || '/' || p_brand AS b FROM part)
SELECT x.cluster, CASE WHEN x.b = y.b THEN 1 WHEN x.a = y.a THEN 2 ELSE 3 END AS distance, COUNT(*) AS pairs
FROM p x JOIN p y ON x.cluster = y.cluster AND x.id < y.id GROUP BY 1, 2""")
def j10(spark, folder):
    rows = read_table(spark, folder, "part").select(F.col("p_size").alias("cluster"), "p_type", "p_brand")
    return K.pair_distances(rows, "cluster", ["p_type", "p_brand"])


@query("j13_chained_dimensions", with_tx(body=f"""
SELECT r_name, n_name, {SALES}, COUNT(DISTINCT store_id) AS stores
FROM tx LEFT JOIN nation ON n_nationkey = div_no LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2"""))
def j13(spark, folder):
    per_store = transactions(spark, folder, stores=True).groupBy("div_no", "store_id").agg(
        F.sum("net_cents").alias("sales_cents"))
    nation, region = read_table(spark, folder, "nation"), read_table(spark, folder, "region")
    return (per_store.join(nation, per_store.div_no == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .groupBy("r_name", "n_name")
            .agg(F.sum("sales_cents").alias("sales_cents"), F.count(F.lit(1)).alias("stores")))


def pattern_buyers(spark, folder, *names):
    chosen = regex_upc_lists(products(spark, folder), SPECS, FIELDS).where(F.col("segment").isin(list(names)))
    return buyers_audience(transactions(spark, folder), chosen)


BUYERS = SPEC_LISTS + """,
buyers AS (SELECT DISTINCT segment, hh_id FROM tx JOIN pattern_lists USING (upc))"""


@query("u01_union_accumulate", with_tx(BUYERS, body="""
SELECT 'brands' AS origin, p_partkey AS upc FROM part WHERE p_brand = 'Brand#1'
UNION ALL SELECT 'types', p_partkey FROM part WHERE p_type = 'PROMO'
UNION ALL SELECT 'names', p_partkey FROM part WHERE p_name = 'old bolt'"""))
def u01(spark, folder):
    part = read_table(spark, folder, "part").withColumnRenamed("p_partkey", "upc")
    return J.tagged_union({
        "brands": part.where(F.col("p_brand") == "Brand#1").select("upc"),
        "types": part.where(F.col("p_type") == "PROMO").select("upc"),
        "names": part.where(F.col("p_name") == "old bolt").select("upc")}, "origin")


@query("u02_union_by_name", with_tx(BUYERS, body="""
SELECT hh_id, 'bought' AS segment FROM buyers WHERE segment = 'gizmos'
UNION ALL SELECT c_custkey, 'owner' FROM customer WHERE c_mktsegment = 'MACHINERY'"""))
def u02(spark, folder):
    bought = pattern_buyers(spark, folder, "gizmos").select("hh_id", F.lit("bought").alias("segment"))
    owners = read_table(spark, folder, "customer").where(F.col("c_mktsegment") == "MACHINERY").select(
        F.lit("owner").alias("segment"), F.col("c_custkey").alias("hh_id"))
    return bought.unionByName(owners)


@query("u03_union_distinct", with_tx(BUYERS, body="""
SELECT DISTINCT hh_id FROM buyers WHERE segment IN ('warm_bolts', 'plain_rods')"""))
def u03(spark, folder):
    return pattern_buyers(spark, folder, "warm_bolts", "plain_rods").select("hh_id").distinct()


@query("u04_intersection", with_tx(BUYERS, body="""
SELECT hh_id FROM buyers WHERE segment = 'warm_bolts' INTERSECT SELECT hh_id FROM buyers WHERE segment = 'gizmos'"""))
def u04(spark, folder):
    return J.in_both(pattern_buyers(spark, folder, "warm_bolts").select("hh_id"),
                     pattern_buyers(spark, folder, "gizmos").select("hh_id"), ["hh_id"])


@query("u05_set_overlap", with_tx(BUYERS, body="""
SELECT CASE WHEN a AND b THEN 'common' WHEN a THEN 'left only' ELSE 'right only' END AS part, COUNT(*) AS households FROM (
  SELECT hh_id, bool_or(segment = 'warm_bolts') AS a, bool_or(segment = 'gizmos') AS b FROM buyers
  WHERE segment IN ('warm_bolts', 'gizmos') GROUP BY 1) GROUP BY 1"""))
def u05(spark, folder):
    return J.set_overlap(pattern_buyers(spark, folder, "warm_bolts"), pattern_buyers(spark, folder, "gizmos"),
                         "hh_id", "households")


NAMES = "n AS (SELECT DISTINCT p_name AS name FROM part)"
KEY = ("array_to_string(list_sort(string_split(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')), ' ')), ' ')")


@query("j12_similarity_join", f"""
WITH {NAMES}, k AS (SELECT name, {KEY.format('name')} AS key FROM n)
SELECT a.name AS word_a, b.name AS word_b,
  ROUND((greatest(length(a.key), length(b.key)) - levenshtein(a.key, b.key)) * 100 / greatest(length(a.key), length(b.key)), 4) AS similarity
FROM k a JOIN k b ON a.name < b.name
WHERE (greatest(length(a.key), length(b.key)) - levenshtein(a.key, b.key)) * 100 >= 75 * greatest(length(a.key), length(b.key))""")
def j12(spark, folder):
    return X.similar_pairs(read_table(spark, folder, "part"), "p_name", 75)
