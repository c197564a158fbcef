"""Geography queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.functions.predicates import haversine_km
from hearthline.operators import geo as G
from hearthline.plans.bindings import PRODUCTS, STORES, with_tx
from hearthline.plans.registry import query
from hearthline.session import cut_lineage
from hearthline.sources.tables import products, read_table, store_positions, transactions

KM = 2500.0

HAVERSINE = ("6371.0 * 2 * atan2(sqrt(h), sqrt(1 - h))")
PREF = STORES + """,
baskets AS (SELECT hh_id, store_id, COUNT(DISTINCT basket_id) AS n FROM tx GROUP BY 1, 2),
pref AS (SELECT hh_id, arg_max(store_id, n * 1000000 - store_id) AS pref_store_id, MAX(n) AS pref_baskets
         FROM baskets GROUP BY 1)"""
TRIPS = PREF + f""",
placed AS (
  SELECT DISTINCT t.hh_id, t.basket_id, t.store_id, a.lat, a.lon, b.lat AS plat, b.lon AS plon
  FROM tx t JOIN pref p USING (hh_id) JOIN stores a ON a.store_id = t.store_id
  JOIN stores b ON b.store_id = p.pref_store_id WHERE t.store_id <> p.pref_store_id),
halves AS (
  SELECT *, pow(sin((radians(lat) - radians(plat)) / 2), 2)
    + cos(radians(plat)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(plon)) / 2), 2) AS h FROM placed),
trips AS (
  SELECT hh_id, basket_id, store_id, {HAVERSINE} AS distance_km,
         CASE WHEN {HAVERSINE} >= {KM} THEN 1 ELSE 0 END AS significant FROM halves)"""
FAR = TRIPS + """,
far AS (SELECT hh_id, COUNT(DISTINCT CASE WHEN significant = 1 THEN store_id END) AS far_stores FROM trips GROUP BY 1),
travelers AS (
  SELECT hh_id, far_stores, CASE WHEN far_stores >= 2 THEN 'H' ELSE 'M' END AS segment
  FROM far WHERE far_stores >= 1 AND far_stores <= (SELECT quantile_disc(far_stores, 0.95) FROM far))"""


def trips(spark, folder):
    visits = G.store_visits(transactions(spark, folder))
    return G.significant_trips(visits, G.preferred_store(visits), store_positions(spark, folder), KM)


@query("d23_significant_trips", with_tx(TRIPS, body="""
SELECT hh_id, basket_id, store_id, ROUND(distance_km, 6) AS distance_km, significant FROM trips"""))
def d23(spark, folder):
    return trips(spark, folder).withColumn("distance_km", F.round("distance_km", 6))


@query("d24_travelers", with_tx(FAR, body="SELECT * FROM travelers"))
def d24(spark, folder):
    return G.travelers(trips(spark, folder))


@query("d25_roadies", with_tx(FAR, PRODUCTS, body=""",
tagged AS (SELECT basket_id, hh_id, units FROM tx JOIN products USING (upc) WHERE department = 'PROMO'),
volumes AS (SELECT hh_id, SUM(units) AS volume FROM tagged GROUP BY 1),
one AS (SELECT DISTINCT hh_id FROM trips WHERE significant = 1 AND basket_id IN (SELECT basket_id FROM tagged)
        AND hh_id IN (SELECT hh_id FROM travelers)),
two AS (SELECT hh_id FROM volumes WHERE volume >= (SELECT quantile_disc(volume, 0.9) FROM volumes))
SELECT hh_id, CASE WHEN COUNT(*) = 2 THEN 'H' ELSE 'M' END AS segment
FROM (SELECT hh_id FROM one UNION ALL SELECT hh_id FROM two) GROUP BY 1"""))
def d25(spark, folder):
    tagged = transactions(spark, folder).join(
        products(spark, folder).where(F.col("department") == "PROMO").select("upc"), "upc", "left_semi")
    baskets = cut_lineage(tagged.groupBy("hh_id", "basket_id").agg(F.sum("units").alias("units")))
    volumes = baskets.groupBy("hh_id").agg(F.sum("units").alias("volume"))
    return G.roadies(cut_lineage(trips(spark, folder)), baskets, volumes)


AREAS = {"AFRICA": "metro", "AMERICA": "micro", "ASIA": "non_metro"}
AREA_SQL = PREF + """,
placed AS (
  SELECT hh_id, CASE r_name WHEN 'AFRICA' THEN 'metro' WHEN 'AMERICA' THEN 'micro' WHEN 'ASIA' THEN 'non_metro' END AS segment,
         r_name FROM pref JOIN supplier ON s_suppkey = pref_store_id JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""


def store_regions(spark, folder):
    return (read_table(spark, folder, "supplier").join(
        read_table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("store_id"), "r_name"))


@query("d26_attribute_audiences", with_tx(AREA_SQL, body="""
SELECT segment, hh_id, 'H' AS propensity FROM placed WHERE segment IS NOT NULL"""))
def d26(spark, folder):
    return G.attribute_audiences(G.preferred_store(G.store_visits(transactions(spark, folder))),
                                 store_regions(spark, folder), "r_name", AREAS)


def sources(spark, folder):
    """Region of a household by its preferred store and by its address."""
    shop = G.preferred_store(G.store_visits(transactions(spark, folder))).select(
        "hh_id", F.col("pref_store_id").alias("store_id")).join(store_regions(spark, folder), "store_id")
    home = (read_table(spark, folder, "customer").join(
        read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("hh_id"), "r_name"))
    return shop.select("hh_id", "r_name"), home


HOME = """,
home AS (SELECT c_custkey AS hh_id, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey)"""


@query("d27_compare_sources", with_tx(AREA_SQL + HOME, body=""",
a AS (SELECT r_name, COUNT(DISTINCT hh_id) AS left_count,
      ROUND(COUNT(DISTINCT hh_id) * 100 / (SELECT COUNT(DISTINCT hh_id) FROM placed), 4) AS left_percent FROM placed GROUP BY 1),
b AS (SELECT r_name, COUNT(DISTINCT hh_id) AS right_count,
      ROUND(COUNT(DISTINCT hh_id) * 100 / (SELECT COUNT(DISTINCT hh_id) FROM home), 4) AS right_percent FROM home GROUP BY 1)
SELECT r_name, COALESCE(left_count, 0) AS left_count, COALESCE(left_percent, 0) AS left_percent,
       COALESCE(right_count, 0) AS right_count, COALESCE(right_percent, 0) AS right_percent,
       ROUND(COALESCE(left_percent, 0) - COALESCE(right_percent, 0), 4) AS percent_difference
FROM a FULL JOIN b USING (r_name)"""))
def d27(spark, folder):
    return G.compare_sources(*sources(spark, folder), "r_name")


@query("d27_source_mismatches", with_tx(AREA_SQL + HOME, body="""
SELECT CASE WHEN b.hh_id IS NULL THEN 'left only' WHEN a.hh_id IS NULL THEN 'right only'
            WHEN a.r_name = b.r_name THEN 'same' ELSE 'different' END AS kind, COUNT(*) AS households
FROM placed a FULL JOIN home b ON a.hh_id = b.hh_id GROUP BY 1"""))
def d27_mismatches(spark, folder):
    return G.source_mismatches(*sources(spark, folder), "r_name")


@query("d28_preferred_store", with_tx(PREF, body="SELECT * FROM pref"))
def d28(spark, folder):
    return G.preferred_store(G.store_visits(transactions(spark, folder)))


@query("f04_haversine", with_tx(PREF, body="""
, legs AS (
  SELECT a.store_id, pow(sin((radians(a.lat) - radians(39.1)) / 2), 2)
    + cos(radians(39.1)) * cos(radians(a.lat)) * pow(sin((radians(a.lon) - radians(-84.5)) / 2), 2) AS h FROM stores a)
SELECT store_id, ROUND(6371.0 * 2 * atan2(sqrt(h), sqrt(1 - h)), 6) AS distance_km FROM legs"""))
def f04(spark, folder):
    distance = haversine_km(F.lit(39.1), F.lit(-84.5), "lat", "lon")
    return store_positions(spark, folder).select("store_id", F.round(distance, 6).alias("distance_km"))
