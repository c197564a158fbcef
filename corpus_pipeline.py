"""From raw documents to packed training sequences, stage by stage.

A stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import decontaminate, packing, quality, simhash, spans
from hearthline.llm.queries import ratings, table
from hearthline.session import cut_lineage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose grade is more likely than not at least 1; without ratings, all."""
    model = quality.train(docs, ratings(spark, sf_dir))
    graded = quality.grade_documents(docs, model, 1.0, names=("_expected", "_tail"))
    return graded.where("_tail is null or _tail >= 0.5").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints over three-word runs link at two bits or less."""
    return simhash.distinct_documents(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated runs of sentences; documents of which nothing is left go."""
    found = spans.remove_repeats(docs, removed="_removed")
    found = found.where((F.col("_removed") == 0) | F.col("text").rlike(r"[^\x00-\x20]"))
    length = F.when(F.col("_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return found.withColumn("n_chars", length).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no wording of a benchmark item."""
    # Documents may share an id or have none; id and text together name one.
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                      F.md5(F.coalesce("text", F.lit(""))))
    named = docs.select("text", key.alias("key"))
    found = decontaminate.overlaps(named, table(spark, sf_dir, "benchmark"), id_col="key").select("key").distinct()
    return docs.withColumn("_key", key).join(found.withColumnRenamed("key", "_key"), "_key", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every remaining document with its sequence and offset."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality classifier", good_documents), ("simhash near-dedup", near_copies),
          ("substring dedup", repeated_spans), ("benchmark decontamination", without_benchmark),
          ("best-fit packing", packed)]

#: No stage can be written in SQL as a whole; the tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
