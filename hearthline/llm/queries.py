"""One registered query for each operator of this subpackage, and SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import (ann, decontaminate, dialogues, gru, licenses, negatives, packing, personal,
                            personal_labels, quality, shuffle, simhash, spans, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Three grades from the label table: 0 poor, 1 good but toxic, 2 good."""
    labels = table(spark, folder, "labels")
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(
        F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2)).alias("grade"))


@query("op1_quality")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, probability of at least grade 1, and whether to keep each document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, ratings(spark, folder))
    found = quality.grade_documents(docs, model, cut=1.0)
    return found.select("doc_id", "expected_grade", "tail", (F.col("tail") >= 0.5).alias("keep"))


@query("op2_decontaminate")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds wording of a benchmark item, with the overlap."""
    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_sentence_spans")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text without repeated runs of sentences, and how many sentences went."""
    found = spans.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "text", "removed_sentences")


@query("op4_simhash")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and smallest linked doc_id of every document."""
    found = simhash.simhash_groups(table(spark, folder, "documents"))
    # The fingerprint's bytes stand lowest first.
    text = F.lower(F.concat(*[F.substring(F.hex("fp"), 15 - 2 * k, 2) for k in range(8)]))
    return found.select("doc_id", text.alias("fingerprint"), F.col("component").alias("component_id"))


@query("op5_shuffle")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in 16 shards of a random order."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    found = shuffle.shards(docs, size, 16)
    return found.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op6_licenses")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan(table(spark, folder, "documents"), ["doc_id"])


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Chained probabilities that each document is junk and that it is toxic."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    models = toxicity.train(docs, labels, ["junk", "toxic"])
    found = toxicity.judge(docs, models, ["p_junk", "p_toxic"])
    return found.select("doc_id", "p_junk", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


@query("op8_gru")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Log-likelihood of every document by word counts and by the recurrent model."""
    return gru.score_documents(table(spark, folder, "documents"))


@query("op9_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces, their sequence and their place in it."""
    pieces = packing.token_pieces(table(spark, folder, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


@query("op10_nearest")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)


@query("op12_personal")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: matches of the patterns, and all spans with those of the field."""
    labelled = spark.createDataFrame([(line,) for line in personal_labels.LINES], "line string")
    found = personal.find(table(spark, folder, "documents"), personal.train(labelled), ["doc_id"])

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *map(number, personal.KINDS), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


@query("op13_negatives", """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
         CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
   AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector; a seventh of the labels is shifted."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.mine(rows, rows.where("vec_id % 50 = 0"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows after the contract's damage; rows that it drops stay with ``alive`` false."""
    def or_blank(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    drawn = F.crc32(F.concat(or_blank("conv_id"), F.lit(":"), or_blank("turn"))) % 20
    held = rows.select("conv_id", "turn", or_blank("role").alias("role"), or_blank("text").alias("text"), drawn.alias("drawn"))
    text = F.when(F.col("drawn") == 1, F.lit("")).when(
        F.col("drawn") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("drawn") == 3, 2).otherwise(1)))
    return held.select("conv_id", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("drawn") != 0).alias("alive"), copies.alias("copy")).drop("copy")


@query("op11_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cost and least audit of every conversation after damage, and a digest of its repair."""
    rows = table(spark, folder, "conversations")
    found = dialogues.repair(damaged(rows).where("alive").drop("alive"))
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # Every conversation, those without a row left too; nulls group as one value.
    parts = (rows.select("conv_id").distinct()
             .unionByName(found.found.withColumnRenamed("conv", "conv_id"), allowMissingColumns=True)
             .unionByName(dialogues.digests(found).withColumnRenamed("conv", "conv_id"), allowMissingColumns=True))
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in sums],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("digest"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
