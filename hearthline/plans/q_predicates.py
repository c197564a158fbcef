"""Projection, filter and scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.functions import predicates as P
from hearthline.operators import lists as L
from hearthline.operators import text as X
from hearthline.operators.monitoring import threshold_counts
from hearthline.operators.propensity import drop_returns
from hearthline.plans.bindings import PRODUCTS, STORES, with_tx
from hearthline.plans.registry import query
from hearthline.sources.hierarchy import dedupe, flatten_hierarchy, nest_hierarchy
from hearthline.sources.tables import products, read_table, spread, store_positions, transactions

ONLY_PRODUCTS = "WITH " + PRODUCTS


@query("p01_flatten_hierarchy", ONLY_PRODUCTS + """
SELECT upc, product_name, commodity, sub_commodity, department, 'STORE' AS sub_department, 'ALL' AS micro_department
FROM products""")
def p01(spark, folder):
    return flatten_hierarchy(nest_hierarchy(products(spark, folder)), "upc", {
        "product_name": "product_name", "commodity": "familyTree.commodity.name",
        "sub_commodity": "familyTree.subCommodity.name", "department": "familyTree.primaryDepartment.name",
        "sub_department": "familyTree.primaryDepartment.recapDepartment.name",
        "micro_department": "familyTree.primaryDepartment.recapDepartment.department.name"})


@query("p02_struct_fields", ONLY_PRODUCTS + """
SELECT upc, commodity AS commodity_name, sub_commodity AS sub_commodity_name, size, price_cents FROM products""")
def p02(spark, folder):
    nested = nest_hierarchy(products(spark, folder))
    tree = F.col("familyTree")
    return nested.select("upc", tree.getItem("commodity").getItem("name").alias("commodity_name"),
                         tree.getItem("subCommodity").getItem("name").alias("sub_commodity_name"), "facts.*")


@query("p03_in_any", ONLY_PRODUCTS + """
SELECT upc, commodity, sub_commodity FROM products
WHERE commodity IN ('Brand#1', 'Brand#2') OR sub_commodity IN ('Brand#3|7', 'Brand#4|9')""")
def p03(spark, folder):
    wanted = P.in_any({"commodity": ["Brand#1", "Brand#2"], "sub_commodity": ["Brand#3|7", "Brand#4|9"]})
    return products(spark, folder).where(wanted).select("upc", "commodity", "sub_commodity")


@query("p04_keyphrase_match", """
SELECT doc_id, lang FROM documents
WHERE contains(lower(text), 'license') OR contains(lower(text), 'copyright')
   OR contains(lower(source), 'license') OR contains(lower(source), 'copyright')""")
def p04(spark, folder):
    return read_table(spark, folder, "documents").where(
        P.keyphrase_match(["text", "source"], ["License", "copyright"])).select("doc_id", "lang")


@query("p05_regex_match", ONLY_PRODUCTS + """
SELECT upc, product_name FROM products WHERE department IN ('ECONOMY')
AND (regexp_matches(product_name, 'red|blue') OR regexp_matches(commodity, 'red|blue'))
AND (regexp_matches(product_name, 'bolt') OR regexp_matches(commodity, 'bolt'))
AND NOT (regexp_matches(product_name, 'old') OR regexp_matches(commodity, 'old'))""")
def p05(spark, folder):
    spec = {"filter": {"department": ["ECONOMY"]}, "must_contain": [["red", "blue"], ["bolt"]],
            "must_not_contain": [["old"]]}
    return products(spark, folder).where(P.regex_match(["product_name", "commodity"], spec)).select(
        "upc", "product_name")


@query("p06_like_filter", ONLY_PRODUCTS + """
SELECT upc FROM products WHERE (product_name LIKE '%gear%' OR department LIKE '%gear%')
AND commodity NOT IN ('Brand#1', 'Brand#2')""")
def p06(spark, folder):
    return L.like_upc_list(products(spark, folder), ["product_name", "department"], "%gear%",
                           {"commodity": ["Brand#1", "Brand#2"]})


@query("p07_exclude_categories", ONLY_PRODUCTS + """
SELECT upc, department FROM products WHERE department NOT IN ('PROMO') AND commodity NOT IN ('Brand#5')""")
def p07(spark, folder):
    kept = P.exclude_categories({"department": ["PROMO"], "commodity": ["Brand#5"]})
    return products(spark, folder).where(kept).select("upc", "department")



def restricted(spark, folder):
    """Categories that hold fewer than ten products stand for a restricted list."""
    return products(spark, folder).groupBy("commodity", "department").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") < 10).select("commodity", "department")


@query("p08_exclude_by_lookup", ONLY_PRODUCTS + """
SELECT upc, commodity, department FROM products WHERE (commodity, department) NOT IN (
  SELECT (commodity, department) FROM products GROUP BY commodity, department HAVING COUNT(*) < 10)""")
def p08(spark, folder):
    return L.exclude_by_lookup(products(spark, folder), restricted(spark, folder), ["commodity", "department"]
                               ).select("upc", "commodity", "department")


@query("p09_drop_returns", with_tx(body="""
SELECT store_id, COUNT(*) AS items, CAST(SUM(net_cents) AS BIGINT) AS sales_cents
FROM tx WHERE NOT is_return AND net_cents > 0 GROUP BY 1"""))
def p09(spark, folder):
    return drop_returns(transactions(spark, folder)).groupBy("store_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum("net_cents").alias("sales_cents"))


@query("p10_null_handling", """
SELECT d.doc_id, COALESCE(l.quality, -1) AS quality, COALESCE(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.lang IS NOT NULL""")
def p10(spark, folder):
    docs = read_table(spark, folder, "documents", ["doc_id", "lang"]).na.drop(subset=["lang"])
    return docs.join(read_table(spark, folder, "labels"), "doc_id", "left").fillna(
        {"quality": -1, "toxic": 0}).select("doc_id", "quality", "toxic")


@query("p11_relabel", ONLY_PRODUCTS + """
SELECT upc, CASE department WHEN 'PROMO' THEN 'THIRD PARTY' WHEN 'ECONOMY' THEN 'VALUE' ELSE department END AS label
FROM products""")
def p11(spark, folder):
    return products(spark, folder).select(
        "upc", P.relabel("department", {"PROMO": "THIRD PARTY", "ECONOMY": "VALUE"}).alias("label"))


@query("p12_store_key", "WITH " + STORES + """
SELECT store_id, CAST(div_no AS VARCHAR) || '_' || CAST(store_id AS VARCHAR) AS store_code FROM stores""")
def p12(spark, folder):
    return store_positions(spark, folder).select("store_id", P.store_key("div_no", "store_id").alias("store_code"))


@query("p13_market_label", """
SELECT c_custkey, CASE WHEN substr(c_mktsegment, 1, 3) IN ('AUT', 'MAC') AND length(c_mktsegment) > 3
       THEN 'new market' ELSE 'existing' END AS market FROM customer""")
def p13(spark, folder):
    return read_table(spark, folder, "customer").select(
        "c_custkey", P.market_label("c_mktsegment", ["AUT", "MAC"]).alias("market"))


FLAG_SQL = """flags AS (
  SELECT c_custkey AS hh_id, CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS email_flag,
         CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS push_flag,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Y' ELSE 'N' END AS social_flag,
         CASE WHEN c_nationkey < 5 THEN 'Y' END AS video_flag FROM customer)"""
ONSITE, OFFSITE = ["email_flag", "push_flag"], ["social_flag", "video_flag"]


def flags(spark, folder):
    """Eligibility flags of each household; the last one may be null."""
    yes = lambda c: F.when(c, "Y").otherwise("N")
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("hh_id"), yes(F.col("c_acctbal") > 0).alias("email_flag"),
        yes(F.col("c_acctbal") > 5000).alias("push_flag"),
        yes(F.col("c_mktsegment") == "AUTOMOBILE").alias("social_flag"),
        F.when(F.col("c_nationkey") < 5, "Y").alias("video_flag"))


@query("p14_any_flag", "WITH " + FLAG_SQL + """
SELECT hh_id, (email_flag = 'Y' OR push_flag = 'Y') AS onsite,
       (social_flag = 'Y' OR COALESCE(video_flag, 'N') = 'Y') AS offsite FROM flags""")
def p14(spark, folder):
    return flags(spark, folder).select(
        "hh_id", P.any_flag(ONSITE).alias("onsite"), P.any_flag(OFFSITE).alias("offsite"))


@query("p15_dedupe", with_tx(body="""
SELECT hh_id, store_id, basket_id, net_cents FROM (
  SELECT *, row_number() OVER (PARTITION BY hh_id, store_id ORDER BY net_cents DESC, basket_id) AS rn
  FROM (SELECT DISTINCT hh_id, store_id, basket_id, net_cents FROM tx)) WHERE rn = 1"""))
def p15(spark, folder):
    rows = transactions(spark, folder).select("hh_id", "store_id", "basket_id", "net_cents").distinct()
    return dedupe(rows, ["hh_id", "store_id"], [F.col("net_cents"), -F.col("basket_id")])


@query("p16_coalesce_text", """
SELECT doc_id, COALESCE(a, b) AS a, COALESCE(b, a) AS b FROM (
  SELECT doc_id, CASE WHEN quality = 1 THEN 'good' END AS a, CASE WHEN toxic = 1 THEN 'toxic' END AS b
  FROM documents LEFT JOIN labels USING (doc_id)) WHERE COALESCE(a, b) IS NOT NULL""")
def p16(spark, folder):
    marks = read_table(spark, folder, "documents", ["doc_id"]).join(
        read_table(spark, folder, "labels"), "doc_id", "left").select(
        "doc_id", F.when(F.col("quality") == 1, "good").alias("a"), F.when(F.col("toxic") == 1, "toxic").alias("b"))
    return X.coalesce_text(marks, "a", "b").where(F.col("a").isNotNull())


@query("p17_threshold_counts", with_tx(body=""",
spend AS (SELECT upc, SUM(net_cents) AS c FROM tx GROUP BY 1)
SELECT CAST(SUM(CASE WHEN c > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_over_0,
       CAST(SUM(CASE WHEN c > 10000000 THEN 1 ELSE 0 END) AS BIGINT) AS num_over_10000000,
       CAST(SUM(CASE WHEN c > 20000000 THEN 1 ELSE 0 END) AS BIGINT) AS num_over_20000000 FROM spend"""))
def p17(spark, folder):
    spend = transactions(spark, folder).groupBy("upc").agg(F.sum("net_cents").alias("c"))
    return threshold_counts(spend, "c", [0, 10_000_000, 20_000_000])


@query("p18_in_bounds", ONLY_PRODUCTS + """
SELECT commodity, COUNT(*) AS products, COUNT(DISTINCT size) AS sizes FROM products GROUP BY 1
HAVING COUNT(*) BETWEEN 70 AND 85 AND COUNT(DISTINCT size) BETWEEN 30 AND 45""")
def p18(spark, folder):
    grouped = products(spark, folder).groupBy("commodity").agg(
        F.count(F.lit(1)).alias("products"), F.count_distinct("size").alias("sizes"))
    return grouped.where(P.in_bounds({"products": (70, 85), "sizes": (30, 45)}))


@query("p19_square_and_radius", "WITH " + STORES + """
SELECT store_id, lat BETWEEN 30 AND 40 AND lon BETWEEN -110 AND -80 AS in_square,
       (lon - -95.0) * (lon - -95.0) + (lat - 37.5) * (lat - 37.5) <= 100 AS in_radius FROM stores""")
def p19(spark, folder):
    return store_positions(spark, folder).select(
        "store_id", P.in_square("lat", "lon", (30, 40), (-110, -80)).alias("in_square"),
        P.in_radius("lon", "lat", (-95.0, 37.5), 10.0).alias("in_radius"))


SPACE, DELETE = r"[/\\\-_|+]", r"[<>?!;:}{=&%$#@~^*()\[\]]"


@query("f05_normalize_text", f"""
WITH c AS (
  SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(source || ' (' || lang || ')', '{SPACE}', ' ', 'g'),
           '{DELETE}', '', 'g'), '\\s+', ' ', 'g')) AS name,
         trim(regexp_replace(regexp_replace(regexp_replace(text, '{SPACE}', ' ', 'g'),
           '{DELETE}', '', 'g'), '\\s+', ' ', 'g'), ' ') AS description FROM documents)
SELECT doc_id, name, lower(name) AS name_cleaned, md5(lower(description)) AS description_hash FROM c""")
def f05(spark, folder):
    docs = spread(read_table(spark, folder, "documents"), "doc_id").select(
        "doc_id", F.concat("source", F.lit(" ("), "lang", F.lit(")")).alias("name"), F.col("text").alias("description"))
    return X.normalize_text(docs, "name", "description").select(
        "doc_id", "name", "name_cleaned", F.md5("description_cleaned").alias("description_hash"))


@query("f07_trim_check_digit", """
SELECT p_partkey, substr(printf('%013d', p_partkey), 1, 12) AS code FROM part""")
def f07(spark, folder):
    return read_table(spark, folder, "part").select(
        "p_partkey", P.trim_check_digit(F.format_string("%013d", "p_partkey")).alias("code"))


@query("f08_product_sentence", """
WITH d AS (
  SELECT p_partkey, p_name, list_filter([CASE WHEN p_type = 'ECONOMY' THEN 'VEGAN' END, CASE WHEN p_size < 10 THEN 'KETO' END], lambda x: x IS NOT NULL) AS own,
    list_filter([CASE WHEN p_retailprice > 1000 THEN 'low-salt' END, CASE WHEN p_size < 20 THEN 'vegan' END], lambda x: x IS NOT NULL) AS feed FROM part),
s AS (
  SELECT p_partkey, p_name, CASE WHEN len(own) > 0 THEN lower(array_to_string(own, ' diet,') || ' diet') ELSE '' END AS o,
    replace(replace(array_to_string(feed, ' diet,'), '-', ' '), ' diet diet', ' diet') AS f FROM d),
b AS (SELECT p_partkey, p_name, string_split(CASE WHEN f = '' THEN o ELSE f || ',' || o END, ',') AS parts FROM s),
u AS (SELECT p_partkey, p_name, array_to_string(list_filter(parts, lambda x, i: list_position(parts, x) = i), ', ') AS diets FROM b)
SELECT p_partkey, replace(CASE WHEN diets = '' THEN p_name || '.' ELSE 'The ' || p_name || ' is a product classified for a ' || diets || '.' END, ',,', ',') AS sentence FROM u""")
def f08(spark, folder):
    listed = lambda *c: F.filter(F.array(*c), lambda x: x.isNotNull())
    diets = read_table(spark, folder, "part").select(
        "p_partkey", "p_name",
        listed(F.when(F.col("p_type") == "ECONOMY", "VEGAN"), F.when(F.col("p_size") < 10, "KETO")).alias("own"),
        listed(F.when(F.col("p_retailprice") > 1000, "low-salt"), F.when(F.col("p_size") < 20, "vegan")).alias("feed"))
    return X.product_sentence(diets, "p_partkey", "p_name", "own", "feed")
