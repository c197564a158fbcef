"""Search by dot product without comparing everything with everything.

Two ways to the best ``k`` vectors of each query:

* **Bounds, exact.** Vectors are grouped around centres, large groups cut into
  blocks; a block knows its mean and the largest distance from it. A query's score
  in a block is at most its score with the mean plus its length times that
  distance. Every query first meets the few blocks of the highest bounds; its k-th
  score so far then rules out all blocks whose bound is lower.
* **Buckets, approximate.** The signs of a vector's products with random directions
  name its bucket, in several tables. A query meets the vectors of its own bucket
  and of those that differ in its least certain signs. ``recall`` measures what is
  found against the exact result.

In both, what meets is a block of vectors and a page of queries of bounded size, in
one task with one matrix product; frequent buckets and large groups are cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hearthline.operators.vectors import matrix
from hearthline.session import cut_lineage, discard

#: Vectors of a block and queries of a page.
BLOCK, PAGE = 4_096, 2_000
#: Groups of vectors and the vectors that their centres are chosen from.
CENTRES, SAMPLE = 1_024, 20_000
#: Blocks that a query meets before its bound is known.
FIRST = 4
#: Scores are rounded to six decimals; bounds are widened by more than that.
SLACK = 2e-6
TABLES, BITS, FLIPS = 12, 10, 2
SEED = 7


def _named(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    return vectors.select(F.col(key).alias("name"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")


def _asked(queries: DataFrame, key: str, vector: str) -> DataFrame:
    return queries.select(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("w")).where("w is not null")


def _meet(rows: DataFrame, asked: DataFrame, pairs: DataFrame, key: str, k: int) -> DataFrame:
    """Scores of what may be among the best ``k``: ``query, key, score``.

    ``rows`` has ``name, v, cell`` with at most ``BLOCK`` rows a cell, ``pairs`` the
    ``query, cell`` that meet. Vectors move once per page of queries that meets them.
    """
    pages = max(1, -(-asked.count() // PAGE))
    # Pairs are many narrow rows that pack well on disk; by their files they look small enough to broadcast.
    paged = asked.join(pairs.hint("merge"), "query").withColumn("page", F.pmod(F.xxhash64("query"), F.lit(pages)).cast("int"))
    wanted = cut_lineage(paged.select("cell", "page").distinct())
    names = T.StructType([T.StructField("query", asked.schema["query"].dataType),
                          T.StructField(key, rows.schema["name"].dataType), T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(names)

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        if not own.num_rows or not met.num_rows:
            return schema.empty_table()
        own = own.sort_by("name")
        scores = np.round(matrix(own.column("v").combine_chunks()) @ matrix(met.column("w").combine_chunks()).T, 6) + 0.0
        best = np.argsort(-scores, axis=0, kind="stable")[:k]
        i, j = best.ravel(), np.tile(np.arange(best.shape[1]), len(best))
        return pa.table([met.column("query").take(pa.array(j)), own.column("name").take(pa.array(i)),
                         pa.array(scores[i, j])], schema=schema)

    return (rows.join(wanted, "cell").groupBy("cell", "page").cogroup(paged.groupBy("cell", "page"))
            .applyInArrow(run, names))


def _best(found: DataFrame, key: str, k: int) -> DataFrame:
    """The best ``k`` of each query, once each; equal scores go to the lower key."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), key)
    return (found.distinct().withColumn("position", F.row_number().over(order)).where(F.col("position") <= k))


# --- bounds ---------------------------------------------------------------------------------------


@dataclass
class Blocks:
    """``rows``: name, v, cell. ``bounds``: cell, mean, radius, one row a block."""

    rows: DataFrame
    bounds: DataFrame


def build_blocks(vectors: DataFrame, key: str, vector: str, block: int = BLOCK, centres: int = CENTRES) -> Blocks:
    """Groups vectors around centres, chosen from a sample of at most ``SAMPLE`` in hash order, and cuts large groups.

    Every vector is in a block; the sample only decides how tight blocks are. No
    more centres are taken than there are blocks' worth of vectors.
    """
    named = cut_lineage(_named(vectors, key, vector))
    total = named.count()
    wanted = max(1, min(centres, -(-2 * total // block)))
    drawn = named.orderBy(F.xxhash64("name"), "name").limit(min(SAMPLE, 20 * wanted)).select("v").collect()
    points = _spread(np.array([r["v"] for r in drawn], np.float64), wanted) if drawn else np.zeros((1, 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = matrix(batch.column("v"))
            group = ((points ** 2).sum(axis=1) - 2 * own @ points.T).argmin(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group)], [*batch.schema.names, "group"])

    grouped = named.mapInArrow(place, T.StructType([*named.schema.fields, T.StructField("group", T.IntegerType())]))
    grouped = cut_lineage(grouped)
    sizes = grouped.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    # As many rows as there are centres.
    celled = grouped.join(F.broadcast(sizes), "group").withColumn(
        "cell", F.concat_ws(":", "group", F.pmod(F.xxhash64("name"), F.col("parts"))))
    rows = cut_lineage(celled.select("name", "v", "cell"))
    discard(named, grouped)

    def bound(own: pa.Table) -> pa.Table:
        points = matrix(own.column("v").combine_chunks())
        mean = points.mean(axis=0)
        radius = float(np.sqrt(((points - mean) ** 2).sum(axis=1).max()))
        return pa.table({"cell": own.column("cell")[:1], "mean": pa.array([mean.tolist()]), "radius": [radius]})

    return Blocks(rows, cut_lineage(rows.groupBy("cell").applyInArrow(bound, "cell string, mean array<double>, radius double")))


def _spread(points: np.ndarray, wanted: int, rounds: int = 8) -> np.ndarray:
    """Centres by a few rounds of Lloyd's rule, begun with evenly taken points."""
    centres = points[np.linspace(0, len(points) - 1, min(wanted, len(points))).astype(int)].copy()
    for _ in range(rounds):
        nearest = ((centres ** 2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


def _bounded_pairs(blocks: Blocks, asked: DataFrame, first: int | None) -> DataFrame:
    """``query, cell`` by bounds: each page's ``first`` best cells with their bound, or all that reach the query's ``least``."""
    pages = max(1, -(-asked.count() // PAGE))
    parts = max(1, -(-blocks.bounds.count() // BLOCK))
    left = (blocks.bounds.withColumn("part", F.pmod(F.xxhash64("cell"), F.lit(parts)).cast("int"))
            .withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))))
    right = (asked.withColumn("page", F.pmod(F.xxhash64("query"), F.lit(pages)).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    names = T.StructType([T.StructField("query", asked.schema["query"].dataType), T.StructField("cell", T.StringType()),
                          T.StructField("bound", T.DoubleType())])
    schema = to_arrow_schema(names)

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        if not own.num_rows or not met.num_rows:
            return schema.empty_table()
        points = matrix(met.column("w").combine_chunks())
        bound = matrix(own.column("mean").combine_chunks()) @ points.T
        bound += np.outer(own.column("radius").to_numpy(), np.sqrt((points ** 2).sum(axis=1))) * (1 + 1e-9) + SLACK
        if first is None:
            i, j = np.nonzero(bound >= met.column("least").to_numpy()[None, :])
        else:
            best = np.argsort(-bound, axis=0, kind="stable")[:first]
            i, j = best.ravel(), np.tile(np.arange(best.shape[1]), len(best))
        return pa.table([met.column("query").take(pa.array(j)), own.column("cell").take(pa.array(i)),
                         pa.array(bound[i, j])], schema=schema)

    return left.groupBy("part", "page").cogroup(right.groupBy("part", "page")).applyInArrow(run, names)


@dataclass
class Found:
    """``rows``: query, key, score, position. ``met``: the query, cell pairs that were compared."""

    rows: DataFrame
    met: DataFrame


def bounded_nearest(blocks: Blocks, key: str, queries: DataFrame, query_key: str, query_vector: str, k: int,
                    first: int = FIRST) -> Found:
    """Exactly the ``k`` highest scoring keys of each query; ties go to the lower key.

    Queries have different keys. A null vector asks for nothing and is not found;
    with fewer than ``k`` vectors all are found.
    """
    asked = cut_lineage(_asked(queries, query_key, query_vector))
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "cell")
    begin = cut_lineage(_bounded_pairs(blocks, asked, first).withColumn("n", F.row_number().over(order))
                        .where(F.col("n") <= first).select("query", "cell"))
    early = cut_lineage(_best(_meet(blocks.rows, asked, begin, key, k), key, k))
    least = early.where(F.col("position") == k).select("query", F.col("score").alias("least"))
    # A query with fewer than k scores so far is ruled out nowhere.
    bounded = asked.join(least, "query", "left").fillna(float("-inf"), ["least"])
    later = cut_lineage(_bounded_pairs(blocks, bounded, None).select("query", "cell").join(begin, ["query", "cell"], "left_anti"))
    rows = early.drop("position").unionByName(_meet(blocks.rows, asked, later, key, k))
    return Found(_best(rows, key, k), begin.unionByName(later))


# --- buckets --------------------------------------------------------------------------------------


def directions(size: int, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Random directions, tables x bits x size."""
    return np.random.default_rng(seed).normal(size=(tables, bits, size))


def buckets(points: np.ndarray, planes: np.ndarray, flips: int = 0) -> np.ndarray:
    """Bucket numbers, points x tables x (1 + flips): the own one, then those with one of the least certain signs turned."""
    tables, bits, size = planes.shape
    products = (points @ planes.reshape(-1, size).T).reshape(len(points), tables, bits)
    weights = 1 << np.arange(bits, dtype=np.int64)
    own = ((products > 0) * weights).sum(axis=2)
    unsure = np.argsort(np.abs(products), axis=2, kind="stable")[:, :, :flips]
    return np.concatenate([own[:, :, None], own[:, :, None] ^ weights[unsure]], axis=2)


def _bucketed(rows: DataFrame, vector: str, planes: np.ndarray, flips: int) -> DataFrame:
    """Adds ``buckets``, an array of ``table:bucket`` as numbers."""
    tables, bits, _ = planes.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = buckets(matrix(batch.column(vector)), planes, flips) + (np.arange(tables) << bits)[None, :, None]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.reshape(batch.num_rows, -1).tolist(), pa.list_(pa.int64()))],
                                             [*batch.schema.names, "buckets"])

    return rows.mapInArrow(task, T.StructType([*rows.schema.fields, T.StructField("buckets", T.ArrayType(T.LongType()))]))


def bucket_nearest(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, query_vector: str,
                   k: int, tables: int = TABLES, bits: int = BITS, flips: int = FLIPS) -> Found:
    """The ``k`` highest scoring of the keys that share a bucket with each query; ties go to the lower key.

    All vectors have the queries' length. More tables and flips find more, more bits compare less; with no
    bits everything is compared. Buckets of more than ``BLOCK`` vectors are cut, and
    the query meets all parts.
    """
    asked = cut_lineage(_asked(queries, query_key, query_vector))
    named = _named(vectors, key, vector)
    some = named.select(F.size("v").alias("n")).first()
    planes = directions(some["n"] if some else 1, tables, bits)
    held = cut_lineage(_bucketed(named, "v", planes, 0)
                       .select("name", "v", F.explode("buckets").alias("bucket")))
    parts = held.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    sought = _bucketed(asked, "w", planes, flips).select("query", F.explode(F.array_distinct("buckets")).alias("bucket"))
    # Only buckets that a query looks into move.
    sized = cut_lineage(sought.hint("merge").join(parts, "bucket"))
    pairs = (sized.withColumn("n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("query", F.concat_ws(":", "bucket", "n").alias("cell")))
    used = sized.select("bucket", "parts").distinct()
    rows = held.join(used, "bucket").select("name", "v", F.concat_ws(":", "bucket", F.pmod(F.xxhash64("name"), F.col("parts"))).alias("cell"))
    pairs = cut_lineage(pairs)
    return Found(_best(_meet(rows, asked, pairs, key, k), key, k), pairs)


def recall(found: DataFrame, exact: DataFrame, key: str) -> float:
    """Share of the exact pairs of query and key that were found; 1 if there are none."""
    total = exact.count()
    return found.join(exact, ["query", key], "left_semi").count() / total if total else 1.0
