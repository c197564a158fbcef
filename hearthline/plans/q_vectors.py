"""Vector queries: search, neighbours, conflicts, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.operators import clusters as K
from hearthline.operators import vector_index as I
from hearthline.operators import vectors as V
from hearthline.plans.bindings import PRODUCTS, with_tx
from hearthline.plans.q_predicates import restricted
from hearthline.plans.registry import query
from hearthline.session import cut_lineage
from hearthline.sources.tables import products, read_table, transactions

# The first vector of each label stands for a query sentence.
FIRST = "q AS (SELECT label AS query, MIN(vec_id) AS reference, arg_min(embedding, vec_id) AS qv FROM embeddings GROUP BY 1)"
DOT = "ROUND(list_inner_product(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[])), 6)"
SCORES = f"""{FIRST},
scores AS (SELECT query, vec_id, {DOT.format('embedding', 'qv')} AS score FROM embeddings, q)"""


def vectors(spark, folder):
    return read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])


def queries(spark, folder):
    return V.first_per_group(vectors(spark, folder), "label", "vec_id", "embedding")


@query("v01_dot_product", f"""WITH {FIRST}
SELECT vec_id, {DOT.format('embedding', 'qv')} AS similarity FROM embeddings JOIN q ON label = query""")
def v01(spark, folder):
    reference = queries(spark, folder).select("label", F.col("embedding").alias("qv"))
    return vectors(spark, folder).join(reference, "label").select(
        "vec_id", F.round(V.dot("embedding", "qv"), 6).alias("similarity"))


@query("v02_embedding_search", f"""WITH {SCORES}
SELECT query, vec_id, score, rank() OVER (PARTITION BY query ORDER BY score DESC) AS score_rank FROM scores WHERE score >= 0.3""")
def v02(spark, folder):
    return V.embedding_search(vectors(spark, folder), "vec_id", "embedding", queries(spark, folder), "label", "embedding")


@query("j11_products_by_queries", f"""WITH {SCORES}
SELECT query, COUNT(*) AS products, COUNT(CASE WHEN score >= 0.3 THEN 1 END) AS matches, MAX(score) AS best, MIN(score) AS worst
FROM scores GROUP BY 1""")
def j11(spark, folder):
    return V.score_summary(vectors(spark, folder), "vec_id", "embedding", queries(spark, folder), "label", "embedding", 0.3)


@query("v03_embed_text", """
SELECT doc_id, CAST(256 AS INTEGER) AS dimensions, 1.0::DOUBLE AS length FROM documents""")
def v03(spark, folder):
    embedded = V.embed_text(read_table(spark, folder, "documents"), "doc_id", "text")
    return embedded.select("doc_id", F.size("vector").alias("dimensions"),
                           F.round(V.dot("vector", "vector"), 4).alias("length"))


@query("v03_word_buckets", """
WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(COALESCE(text, '')), '\\s+')) AS w FROM documents),
c AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 256 AS INTEGER) AS bucket, COUNT(*) AS n FROM w WHERE w <> '' GROUP BY 1, 2)
SELECT doc_id, bucket, ROUND(n / sqrt(SUM(n * n) OVER (PARTITION BY doc_id)), 4) AS weight FROM c""")
def v03_buckets(spark, folder):
    embedded = V.embed_text(read_table(spark, folder, "documents"), "doc_id", "text", V.word_buckets(256))
    places = embedded.select("doc_id", F.posexplode("vector").alias("bucket", "x")).where("x > 0")
    return places.select("doc_id", "bucket", F.round(F.col("x").cast("double"), 4).alias("weight"))


@query("v04_nearest", f"""WITH {SCORES}
SELECT query, vec_id, score, position FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS position FROM scores) WHERE position <= 10""")
def v04(spark, folder):
    return V.nearest(vectors(spark, folder), "vec_id", "embedding", queries(spark, folder), "label", "embedding", 10)


@query("v05_cross_top_k", f"""WITH {SCORES},
forward AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS position FROM scores) WHERE position <= 4),
back AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, query) AS position FROM scores
         WHERE vec_id IN (SELECT vec_id FROM forward))
SELECT 'item' AS direction, query AS item, vec_id, score, position FROM forward
UNION ALL SELECT 'household', query, vec_id, score, position FROM back WHERE position <= 4""")
def v05(spark, folder):
    items = queries(spark, folder).select(F.col("label").alias("item"), "embedding")
    return V.cross_top_k(vectors(spark, folder), "vec_id", items, "item", "embedding", 4)


EVERY = f"""WITH q AS (SELECT vec_id AS query, embedding AS qv FROM embeddings WHERE vec_id % 50 = 0),
scores AS (SELECT query, vec_id, {DOT.format('embedding', 'qv')} AS score FROM embeddings, q)
SELECT query, vec_id, score, position FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS position FROM scores) WHERE position <= 10"""


@query("v05_bounded_top_k", EVERY)
def v05_bounded(spark, folder):
    """Every fiftieth vector against all, through blocks and their bounds."""
    own = vectors(spark, folder)
    blocks = I.build_blocks(own, "vec_id", "embedding")
    return I.bounded_nearest(blocks, "vec_id", own.where("vec_id % 50 = 0"), "vec_id", "embedding", 10).rows


@query("v04_bucket_recall")
def v04_buckets(spark, folder):
    """Of the ten best of every fiftieth vector, how many share a bucket with it, and how many pairs of query and bucket met."""
    own = vectors(spark, folder)
    asked = own.where("vec_id % 50 = 0")
    # These vectors have hardly any near ones, so buckets are wide and many.
    found = I.bucket_nearest(own, "vec_id", "embedding", asked, "vec_id", "embedding", 10, tables=24, bits=4, flips=1)
    exact = V.nearest(own, "vec_id", "embedding", asked, "vec_id", "embedding", 10).select("query", "vec_id")
    hits = exact.join(found.rows.select("query", "vec_id", F.lit(1).alias("hit")), ["query", "vec_id"], "left")
    met = found.met.groupBy("query").agg(F.count(F.lit(1)).alias("cells"))
    return hits.groupBy("query").agg(F.count("hit").alias("found"), F.count(F.lit(1)).alias("wanted")).join(met, "query")


@query("v06_vector_conflicts", f"""
WITH d AS (SELECT label, embedding AS v, MIN(vec_id) AS k FROM embeddings GROUP BY 1, 2)
SELECT a.label, b.k AS vec_id, a.k AS reference, {DOT.format('a.v', 'b.v')} AS similarity
FROM d a JOIN d b ON a.label = b.label AND a.k < b.k WHERE {DOT.format('a.v', 'b.v')} < 0.1""")
def v06(spark, folder):
    return V.vector_conflicts(vectors(spark, folder), "label", "vec_id", "embedding", 0.1)


@query("v07_coverage", with_tx(body=""",
s AS (SELECT upc, SUM(net_cents) AS c FROM tx GROUP BY 1),
j AS (SELECT s.upc AS sold, v.vec_id AS known, COALESCE(c, 0) AS c FROM s FULL JOIN embeddings v ON vec_id = upc),
parts AS (
  SELECT 'sold' AS part, c FROM j WHERE sold IS NOT NULL
  UNION ALL SELECT 'sold_with_vector', c FROM j WHERE sold IS NOT NULL AND known IS NOT NULL
  UNION ALL SELECT 'sold_without_vector', c FROM j WHERE known IS NULL
  UNION ALL SELECT 'vector_only', c FROM j WHERE sold IS NULL)
SELECT part, COUNT(*) AS products, CAST(SUM(CASE WHEN c > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_over_0,
  CAST(SUM(CASE WHEN c > 10000000 THEN 1 ELSE 0 END) AS BIGINT) AS num_over_10000000 FROM parts GROUP BY 1"""))
def v07(spark, folder):
    spend = transactions(spark, folder).groupBy("upc").agg(F.sum("net_cents").alias("spend_cents"))
    keys = vectors(spark, folder).select(F.col("vec_id").alias("upc"))
    return V.coverage(spend, keys, "upc", [0, 10_000_000])


@query("v08_reduce_pca", f"""
SELECT vec_id, CAST(10 AS INTEGER) AS dimensions, TRUE AS kept_less,
  ROUND(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 4) AS energy FROM embeddings""")
def v08(spark, folder):
    """Ten components keep no more than a vector's length; all components together, orthogonal, keep it exactly."""
    plain = vectors(spark, folder)
    few = K.reduce_pca(plain, "embedding", 10).select("vec_id", F.col("embedding").alias("few"))
    every = K.reduce_pca(plain, "embedding", len(plain.first()["embedding"])).join(few, "vec_id")
    energy = V.dot("embedding", "embedding")
    return every.select("vec_id", F.size("few").alias("dimensions"),
                        (V.dot("few", "few") <= energy + 1e-9).alias("kept_less"), F.round(energy, 4).alias("energy"))


@query("v08_pca_variances")
def v08_variances(spark, folder):
    """What each of ten components keeps of the variance."""
    return K.pca_variances(vectors(spark, folder), "embedding", 10)


@query("v09_trustworthiness_of_pca")
def v09_pca(spark, folder):
    """Trustworthiness of the reduction itself, on all vectors."""
    own = vectors(spark, folder).select("vec_id", "embedding")
    return K.trustworthiness(own, cut_lineage(K.reduce_pca(own, "embedding", 10)), "vec_id", "embedding")


@query("v09_trustworthiness", """
WITH p AS (
  SELECT a.vec_id AS i, b.vec_id AS j,
    list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d0,
    list_distance(CAST(a.embedding[1:10] AS DOUBLE[]), CAST(b.embedding[1:10] AS DOUBLE[])) AS d1
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT row_number() OVER (PARTITION BY i ORDER BY d0, j) AS r0, row_number() OVER (PARTITION BY i ORDER BY d1, j) AS r1 FROM p),
n AS (SELECT COUNT(*) AS n FROM embeddings)
SELECT CAST(n AS INTEGER) AS points, ROUND(1 - SUM(greatest(r0 - 5, 0)) * 2.0::DOUBLE / (n * 5 * (2 * n - 16)), 6) AS trustworthiness
FROM r, n WHERE r1 <= 5 GROUP BY n""")
def v09(spark, folder):
    shorter = vectors(spark, folder).withColumn("embedding", F.slice("embedding", 1, 10))
    return K.trustworthiness(vectors(spark, folder), shorter, "vec_id", "embedding")


@query("v23_vector_universe", "WITH " + PRODUCTS + """
SELECT upc, CAST(len(embedding) AS INTEGER) AS dimensions, label FROM embeddings JOIN products ON vec_id = upc
WHERE department = 'PROMO' AND (commodity, department) NOT IN (
  SELECT (commodity, department) FROM products GROUP BY commodity, department HAVING COUNT(*) < 10)""")
def v23(spark, folder):
    stored = vectors(spark, folder).withColumnRenamed("vec_id", "upc")
    universe = V.vector_universe(stored, "upc", "embedding", products(spark, folder), "PROMO",
                                 restricted(spark, folder), ["commodity", "department"], version="label")
    return universe.join(stored.select("upc", "label"), "upc").select(
        "upc", F.size("embedding").alias("dimensions"), "label")
