"""Scan, snapshot, writer and export queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hearthline.functions import timeline as C
from hearthline.operators.propensity import drop_returns, segment_counts
from hearthline.plans.bindings import (
    BOUNDS, LABELS, LISTS, PRODUCTS, segment_labels, segment_lists, with_tx, year_start)
from hearthline.plans.registry import query
from hearthline.session import cut_lineage, scratch_path
from hearthline.sources import egress as E
from hearthline.sources import sinks as K
from hearthline.sources import tables as S


@query("s01_scan", "SELECT p_partkey, p_brand, p_type FROM part")
def s01(spark, folder):
    return S.read_table(spark, folder, "part", ["p_partkey", "p_brand", "p_type"])


@query("s02_transactions_window", with_tx(BOUNDS, body="""
SELECT CAST(trn_date AS VARCHAR) AS day, div_no, COUNT(*) AS items, CAST(SUM(net_cents) AS BIGINT) AS sales_cents
FROM tx, bounds WHERE trn_date > last_date - 364 GROUP BY ALL"""))
def s02(spark, folder):
    _, end = S.date_bounds(spark, folder)
    window = S.transactions(spark, folder, year_start(end), end, stores=True)
    return window.groupBy(F.col("trn_date").cast("string").alias("day"), "div_no").agg(
        F.count(F.lit(1)).alias("items"), F.sum("net_cents").alias("sales_cents"))


@query("s03_exclusions", with_tx(PRODUCTS, body="""
SELECT department, COUNT(DISTINCT hh_id) AS households, CAST(SUM(net_cents) AS BIGINT) AS sales_cents
FROM tx JOIN products USING (upc)
WHERE hh_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
  AND upc NOT IN (SELECT upc FROM products WHERE department = 'PROMO') GROUP BY 1"""))
def s03(spark, folder):
    barred = S.read_table(spark, folder, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("hh_id"))
    fuel = S.products(spark, folder).where(F.col("department") == "PROMO").select("upc")
    kept = S.exclude(S.transactions(spark, folder), barred, fuel)
    return kept.join(S.products(spark, folder).select("upc", "department"), "upc").groupBy("department").agg(
        F.count_distinct("hh_id").alias("households"), F.sum("net_cents").alias("sales_cents"))


KPI = "CAST(SUM(net_cents) AS BIGINT) AS sales_cents, COUNT(DISTINCT basket_id) AS visits, CAST(SUM(units) AS BIGINT) AS units"


@query("s04_kpi_aggregate", with_tx(PRODUCTS, body=f"""
SELECT hh_id, CAST(trn_date AS VARCHAR) AS day, div_no, {KPI}
FROM tx WHERE upc IN (SELECT upc FROM products WHERE department = 'PROMO') GROUP BY ALL"""))
def s04(spark, folder):
    listed = S.products(spark, folder).where(F.col("department") == "PROMO").select("upc")
    tx = S.transactions(spark, folder, stores=True).withColumn("day", F.col("trn_date").cast("string"))
    return S.kpi_aggregate(tx, ["hh_id", "day", "div_no"], listed)


@query("s04_kpi_rollup", with_tx(PRODUCTS, body=f"""
SELECT COALESCE(department, 'all') AS department, COALESCE(commodity, 'all') AS commodity, {KPI}
FROM tx JOIN products USING (upc) GROUP BY ROLLUP (department, commodity)"""))
def s04_rollup(spark, folder):
    tx = S.transactions(spark, folder).join(
        S.products(spark, folder).select("upc", "department", "commodity"), "upc")
    return S.kpi_aggregate(tx, ["department", "commodity"], mode="rollup").fillna(
        "all", ["department", "commodity"])


@query("s04_kpi_cube", with_tx(PRODUCTS, body=f"""
SELECT COALESCE(department, 'all') AS department, COALESCE(CAST(div_no AS VARCHAR), 'all') AS division, {KPI}
FROM tx JOIN products USING (upc) GROUP BY CUBE (department, div_no)"""))
def s04_cube(spark, folder):
    tx = S.transactions(spark, folder, stores=True).join(
        S.products(spark, folder).select("upc", "department"), "upc").withColumn(
        "division", F.col("div_no").cast("string"))
    return S.kpi_aggregate(tx, ["department", "division"], mode="cube").fillna("all", ["department", "division"])


@query("s05_sift", with_tx(PRODUCTS, body=f""",
listed AS (SELECT upc FROM products WHERE product_name LIKE 'red %')
SELECT 'include' AS method, {KPI} FROM tx WHERE upc IN (SELECT upc FROM listed)
UNION ALL SELECT 'exclude', {KPI} FROM tx WHERE upc NOT IN (SELECT upc FROM listed)"""))
def s05(spark, folder):
    listed = S.products(spark, folder).where(F.col("product_name").like("red %")).select("upc")
    tx = S.transactions(spark, folder)
    parts = [S.sift(tx, listed, ["upc"], method, "basket_id").withColumn("method", F.lit(method)) for method in ("include", "exclude")]
    return S.kpi_aggregate(parts[0].unionByName(parts[1]), ["method"])


def monthly_orders(spark, folder):
    return S.read_table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("cycle"), "o_custkey", "o_orderkey")


MONTHLY = "SELECT strftime(o_orderdate, '%Y%m') AS cycle, o_custkey, o_orderkey FROM orders"


@query("s06_latest_snapshot", f"""WITH m AS ({MONTHLY})
SELECT * FROM m WHERE cycle = (SELECT MAX(cycle) FROM m)""")
def s06(spark, folder):
    return S.latest_snapshot(monthly_orders(spark, folder), "cycle")


@query("s07_second_latest_snapshot", f"""WITH m AS ({MONTHLY})
SELECT * FROM m WHERE cycle = (SELECT MAX(cycle) FROM m WHERE cycle < (SELECT MAX(cycle) FROM m))""")
def s07(spark, folder):
    return S.latest_snapshot(monthly_orders(spark, folder), "cycle", n=2)


@query("s08_as_of_snapshot", f"""WITH m AS ({MONTHLY})
SELECT * FROM m WHERE cycle = (SELECT MAX(cycle) FROM m WHERE cycle <= '199806')""")
def s08(spark, folder):
    return S.as_of_snapshot(monthly_orders(spark, folder), "cycle", "199806")


@query("s08_as_of_rows", """
SELECT o_custkey, o_orderpriority, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30') WHERE rn = 1""")
def s08_rows(spark, folder):
    orders = S.read_table(spark, folder, "orders")
    return S.as_of_rows(orders, "o_custkey", ["o_orderdate", "o_orderkey"],
                        ["o_orderpriority", "o_orderstatus"], "o_orderdate",
                        F.to_timestamp(F.lit("1998-06-30")))


YEARLY_SQL = """,
yearly AS (
  SELECT CAST(1995 + CAST((trn_date - DATE '1995-01-01') // 7 AS INTEGER) // 52 AS INTEGER) AS fiscal_year, hh_id,
         CAST(SUM(net_cents) AS BIGINT) AS sales_cents, CAST(SUM(units) AS BIGINT) AS units
  FROM tx WHERE NOT is_return AND net_cents > 0 GROUP BY 1, 2)"""


def yearly(spark, folder):
    year = C.fiscal_columns("trn_date")["fiscal_year"].cast("int")
    return drop_returns(S.transactions(spark, folder)).groupBy(year.alias("fiscal_year"), "hh_id").agg(
        F.sum("net_cents").alias("sales_cents"), F.sum("units").alias("units"))


@query("s09_read_partitions", with_tx(body=YEARLY_SQL + """
SELECT 'range' AS kind, * FROM yearly WHERE fiscal_year BETWEEN 1996 AND 1998
UNION ALL SELECT 'list', * FROM yearly WHERE fiscal_year IN (1995, 1999)"""))
def s09(spark, folder):
    path = scratch_path(spark, "yearly")
    K.replace_partitions(yearly(spark, folder), path, ["fiscal_year"])
    span = S.read_partitions(spark, path, "fiscal_year", 1996, 1998).withColumn("kind", F.lit("range"))
    some = S.read_partitions(spark, path, "fiscal_year", values=[1995, 1999]).withColumn("kind", F.lit("list"))
    return span.unionByName(some)


@query("s10_schema_merge", with_tx(body=YEARLY_SQL + """
SELECT fiscal_year, COUNT(*) AS rows, CAST(SUM(sales_cents) AS BIGINT) AS sales_cents,
       CAST(COALESCE(SUM(CASE WHEN fiscal_year >= 1998 THEN units END), 0) AS BIGINT) AS units
FROM yearly GROUP BY 1"""))
def s10(spark, folder):
    path = scratch_path(spark, "evolving")
    data = yearly(spark, folder)
    K.replace_partitions(data.where(F.col("fiscal_year") < 1998).drop("units"), path, ["fiscal_year"])
    K.replace_partitions(data.where(F.col("fiscal_year") >= 1998), path, ["fiscal_year"])
    merged = S.read_partitions(spark, path, "fiscal_year", merge_schema=True)
    return merged.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sales_cents").alias("sales_cents"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"))


@query("s11_read_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def s11(spark, folder):
    path = scratch_path(spark, "part_csv")
    S.read_table(spark, folder, "part").write.option("header", True).option("sep", "|").csv(path)
    return S.read_csv(spark, path, "p_partkey long, p_name string, p_brand string, p_type string, "
                                   "p_size int, p_retailprice double")


@query("s12_write_dataset", with_tx(LABELS, body="""
SELECT segment, propensity, COUNT(*) AS households FROM audience GROUP BY 1, 2"""))
def s12(spark, folder):
    labels = segment_labels(spark, folder)
    path = K.write_dataset(labels, scratch_path(spark, "audiences"), "category_segments", "20010801")
    return spark.read.parquet(path).groupBy("segment", "propensity").agg(F.count(F.lit(1)).alias("households"))


@query("s13_write_run", with_tx(LABELS, body="""
SELECT modality, run_week, end_week, COUNT(*) AS households, CAST(SUM(spend_cents) AS BIGINT) AS spend_cents FROM (
  SELECT segment AS modality, '20010801' AS run_week, '20010704' AS end_week, spend_cents FROM audience WHERE propensity = 'H'
  UNION ALL SELECT segment, '20010802', '20010801', spend_cents FROM audience
  UNION ALL SELECT segment, '20010802', '20010801', spend_cents FROM audience WHERE segment = 'seg_a') GROUP BY ALL"""))
def s13(spark, folder):
    """Two run weeks per segment; one is written again with fewer rows, one appended to."""
    path, labels = scratch_path(spark, "runs"), cut_lineage(segment_labels(spark, folder).select(
        "segment", F.col("hh_id").alias("household"), "propensity", "spend_cents"))
    columns = ["household", "modality", "end_week", "run_week", "propensity", "spend_cents"]
    for name in ("seg_a", "seg_b", "seg_c"):
        rows = labels.where(F.col("segment") == name)
        K.write_run(rows, path, "overwrite", name, "20010704", "20010801", columns)
        K.write_run(rows, path, "overwrite", name, "20010801", "20010802", columns)
        K.write_run(rows.where(F.col("propensity") == "H"), path, "overwrite", name, "20010704", "20010801", columns)
    K.write_run(labels.where(F.col("segment") == "seg_a"), path, "append", "seg_a", "20010801", "20010802", columns)
    return (spark.read.parquet(path)
            .groupBy("modality", F.col("run_week").cast("string").alias("run_week"), "end_week")
            .agg(F.count(F.lit(1)).alias("households"), F.sum("spend_cents").alias("spend_cents")))


@query("s14_append_period", """
SELECT strftime(o_orderdate, '%Y') AS period, o_orderstatus, COUNT(*) AS orders FROM orders GROUP BY 1, 2""")
def s14(spark, folder):
    path = scratch_path(spark, "periods")
    facts = S.read_table(spark, folder, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy").alias("period"), "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    K.append_period(facts.where(F.col("period") < "1998"), path)
    K.append_period(facts.where(F.col("period") >= "1998"), path)
    return spark.read.parquet(path).withColumn("period", F.col("period").cast("string"))


@query("s15_export_csv", with_tx(LABELS, body="""
SELECT segment, propensity, COUNT(DISTINCT hh_id) AS households FROM audience GROUP BY 1, 2"""))
def s15(spark, folder):
    path = scratch_path(spark, "report")
    K.export_csv(segment_counts(segment_labels(spark, folder), ["segment", "propensity"]), path, "^")
    return S.read_csv(spark, path, "segment string, propensity string, households long", "^")


REGISTRY_SQL = """,
registry AS (
  SELECT 'seg_a' AS audience, ['H'] AS propensities UNION ALL SELECT 'seg_b', ['H', 'M']
  UNION ALL SELECT 'seg_c', ['H', 'M', 'L'] UNION ALL SELECT 'seg_d', ['H'])"""


def definitions(spark):
    """Registry of the category segments and one audience nobody belongs to."""
    rows = [("seg_a", "First Brands ", "percentile", "category", "Purchase", ["H"], ["Brand"]),
            ("seg_b", "Pack Sizes", "percentile", "category", "Purchase", ["H", "M"], ["Size"]),
            ("seg_c", "Mixed", "sensitive", "regex", "Purchase", ["H", "M", "L"], ["Brand", "Size"]),
            ("seg_d", "Nobody", "geospatial", None, "Geography", ["H"], [])]
    return spark.createDataFrame(
        rows, "audience string, frontend_name string, type string, list_type string, segment_type string, "
              "propensities array<string>, tags array<string>")


@query("s16_size_gate", with_tx(LABELS, body=REGISTRY_SQL + """
SELECT r.audience AS segment, COUNT(a.hh_id) AS households, COUNT(a.hh_id) >= 100 AS delivered
FROM registry r LEFT JOIN audience a ON a.segment = r.audience AND list_contains(r.propensities, a.propensity)
GROUP BY 1"""))
def s16(spark, folder):
    return E.size_gate(segment_labels(spark, folder), definitions(spark), 100)


@query("s16_egress", with_tx(LABELS, body=REGISTRY_SQL + """,
gate AS (
  SELECT r.audience, COUNT(a.hh_id) AS n FROM registry r LEFT JOIN audience a
  ON a.segment = r.audience AND list_contains(r.propensities, a.propensity) GROUP BY 1)
SELECT a.segment AS audience, a.propensity AS segment, COUNT(*) AS households
FROM audience a JOIN gate g ON g.audience = a.segment WHERE g.n >= 200 GROUP BY 1, 2"""))
def s16_egress(spark, folder):
    path = scratch_path(spark, "egress")
    E.egress(segment_labels(spark, folder), definitions(spark), path, "20010801", 200)
    written = spark.read.schema("hh_id long, segment string, audience string").parquet(f"{path}/run_date=20010801")
    return written.groupBy("audience", "segment").agg(
        F.count(F.lit(1)).alias("households"))


def brand_registry(spark, folder):
    """Registry with one audience per brand and department sold, built from the products."""
    kinds = S.products(spark, folder).select("commodity", "department").distinct()
    name = F.lower(F.regexp_replace(F.concat_ws("_", "commodity", "department"), "#", "_"))
    return kinds.select(
        name.alias("audience"), F.concat_ws(" ", "commodity", "department").alias("frontend_name"),
        F.when(F.col("department") == "PROMO", "fuel").otherwise("percentile").alias("type"),
        F.when(F.col("department") == "SMALL", F.lit(None).cast("string"))
        .when(F.col("department") == "LARGE", "embedding")
        .otherwise("category").alias("list_type"),
        F.lit("Purchase").alias("segment_type"), F.array(F.lit("H"), F.lit("M")).alias("propensities"),
        F.array("department").alias("tags"), F.concat(F.lit("Buyers of "), "commodity").alias("description"))


PLACES = {"percentile": "/audiences/spend/{audience}", "fuel": "/audiences/stations/{audience}"}
LIST_PLACES = {"category": "/products/{audience}", "embedding": "/products/by_vector"}


KINDS = """kinds AS (
  SELECT DISTINCT lower(replace(p_brand || '_' || p_type, '#', '_')) AS audience, p_brand || ' ' || p_type AS frontend_name,
         p_type AS department, p_brand AS commodity FROM part)"""
UUID = ("substr(sha256({0}), 1, 8) || '-' || substr(sha256({0}), 9, 4) || '-' || substr(sha256({0}), 13, 4)"
        " || '-' || substr(sha256({0}), 17, 4) || '-' || substr(sha256({0}), 21, 12)")


@query("d31_registry", f"""WITH {KINDS}
SELECT audience, CASE WHEN department = 'PROMO' THEN 'fuel' ELSE 'percentile' END AS type,
  CASE WHEN department = 'PROMO' THEN '/audiences/stations/' ELSE '/audiences/spend/' END || audience AS location,
  CASE WHEN department = 'SMALL' THEN 'none' WHEN department = 'LARGE' THEN '/products/by_vector'
       ELSE '/products/' || audience END AS list_location FROM kinds""")
def d31(spark, folder):
    return E.registry(brand_registry(spark, folder), PLACES, LIST_PLACES).select(
        "audience", "type", "location", F.coalesce("list_location", F.lit("none")).alias("list_location"))


@query("s17_audience_manifest", f"""WITH {KINDS}
SELECT audience,
  '{{"id":"' || {UUID.format('audience')} || '","groupName":"Purchase","name":"' || upper(audience) || '","label":"' || frontend_name
  || '","description":"Buyers of ' || commodity || '","filePath":"/audiences/'
  || CASE WHEN department = 'PROMO' THEN 'stations' ELSE 'spend' END || '/' || audience || '","columnName":"segment","fileType":"PARQUET","fileMask":"' || audience || '_","fileDate":"LATEST","mutuallyExclusive":false,'
  || '"availableValues":[{{"label":"High","value":"H"}},{{"label":"Medium","value":"M"}},{{"label":"Low","value":"L"}},'
  || '{{"label":"New","value":"new"}},{{"label":"Lapsed","value":"lapsed"}},{{"label":"Inconsistent","value":"inconsistent"}}],'
  || '"filterType":"IN_LIST"}}' AS segment_document,
  '{{"name":"' || frontend_name || '","tags":["' || department || '"],"cells":[{{"type":"PRE_DEFINED_SEGMENTATION","predefinedSegment":'
  || '{{"segmentationId":"' || {UUID.format('audience')} || '","selectedValues":["H","M"],"segmentationName":"' || upper(audience)
  || '"}},"order":0}}],"combineOperator":"AND","id":"' || {UUID.format("(audience || ':cell')")} || '"}}' AS campaign_document
FROM kinds""")
def s17(spark, folder):
    return E.audience_manifest(E.registry(brand_registry(spark, folder), PLACES, LIST_PLACES))


@query("s20_list_documents", with_tx(LISTS, body="""
SELECT segment, (n - 1) // 10000 AS part, CAST(COUNT(*) AS INTEGER) AS products,
  '{"name":"' || segment || '","purchasingPeriod":{"startDate":"' || CAST(MAX(last_date) AS VARCHAR) || '","endDate":"'
  || CAST(CAST(MAX(last_date) + 364 AS DATE) AS VARCHAR) || '"},"upcs":["' || string_agg(CAST(upc AS VARCHAR), '","' ORDER BY upc)
  || '"]}' AS document FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY upc) AS n FROM lists), bounds GROUP BY 1, 2"""))
def s20(spark, folder):
    _, last = S.date_bounds(spark, folder)
    return E.list_documents(segment_lists(spark, folder), str(last), str(last + dt.timedelta(days=364)))
