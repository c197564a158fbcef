"""Product vectors: scoring, search, nearest neighbours and coverage.

Scores are computed block by block: a bounded block of vectors meets a bounded page
of queries in one task, with one matrix product. Scores are rounded to six
decimals so that equal vectors tie exactly and ranks are the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hearthline.operators.ranks import with_descending_rank
from hearthline.session import cut_lineage

#: Rows and queries that meet in one group of work.
BLOCK, PAGE = 20_000, 2_000
#: Bytes of a page of queries that may go with a task.
PAGE_BYTES = 16 << 20
#: Pairs that one matrix product of a task compares.
SLICE = 1_000_000
#: Words whose bucket a worker keeps between batches.
KNOWN_WORDS = 200_000


def dot(a, b) -> Column:
    """Dot product of two array columns in double precision."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def matrix(column) -> np.ndarray:
    """Arrow list column as a two-dimensional array."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def facing(rows: DataFrame, asked: DataFrame, key: str, asked_key: str, block: int = BLOCK,
           page: int = PAGE) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns ``part`` and ``page``, so that every asked row meets every row.

    Rows are dealt into blocks and asked rows into pages; each block meets each page
    in one group of work of bounded size, whatever the number of either.
    """
    parts, pages = max(1, -(-rows.count() // block)), max(1, -(-asked.count() // page))
    return (rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
            .withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))),
            asked.withColumn("page", F.pmod(F.xxhash64(asked_key), F.lit(pages)).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))


def _meet(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, query_vector: str,
          page: int, run: Callable, names: T.StructType) -> DataFrame:
    """``run`` on tables of vectors (name, v) and queries (query, w), so that every query meets every vector.

    No more than a page of queries, which is looked at first, goes to the vectors as they lie, with the task;
    a page is at most ``PAGE`` rows and ``PAGE_BYTES``. More queries meet blocks of vectors page by page. Both
    give the same rows once what is kept of each part is ranked.
    """
    rows = vectors.select(F.col(key).alias("name"), F.col(vector).alias("v")).where("v is not null")
    asked = queries.select(F.col(query_key).alias("query"), F.col(query_vector).alias("w")).where("w is not null")
    few = asked.limit(page + 1).toArrow()
    if few.num_rows > page or few.nbytes > PAGE_BYTES:
        left, right = facing(rows, asked, "name", "query", page=page)
        return left.groupBy("part", "page").cogroup(right.groupBy("part", "page")).applyInArrow(run, names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from run(pa.Table.from_batches([batch]), few).to_batches()

    return rows.mapInArrow(task, names)


def _scores(rows: pa.Table, asked: pa.Table) -> np.ndarray:
    scores = matrix(rows.column("v").combine_chunks()) @ matrix(asked.column("w").combine_chunks()).T
    return np.round(scores, 6) + 0.0


def score(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str,
          query_vector: str, k: int | None = None, min_score: float | None = None,
          per_row: int | None = None, page: int = PAGE) -> DataFrame:
    """Scores of vectors against queries: query, key and score.

    ``min_score`` keeps only scores at or above it. ``k`` keeps what can still be
    among the best k vectors of a query, ``per_row`` what can still be among the
    best queries of a vector; rank the result to get exactly that many.
    """
    names = T.StructType([
        T.StructField("query", queries.schema[query_key].dataType),
        T.StructField(key, vectors.schema[key].dataType), T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(names)

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return schema.empty_table()
        # Equal scores go to the lower key and the lower query.
        rows, asked = rows.sort_by("name"), asked.sort_by("query")
        scores = _scores(rows, asked)
        wanted = np.ones_like(scores, dtype=bool) if min_score is None else scores >= min_score
        for axis, most in ((0, k), (1, per_row)):
            if most is not None:
                order = np.argsort(-scores, axis=axis, kind="stable")
                best = np.zeros_like(wanted)
                np.put_along_axis(best, order[:most] if axis == 0 else order[:, :most], True, axis=axis)
                wanted &= best
        i, j = np.nonzero(wanted)
        return pa.table([asked.column("query").take(pa.array(j)), rows.column("name").take(pa.array(i)),
                         pa.array(scores[i, j])], schema=schema)

    return _meet(vectors, key, vector, queries, query_key, query_vector, page, run, names)


def score_summary(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str,
                  query_vector: str, min_score: float, page: int = PAGE) -> DataFrame:
    """For each query: number of vectors, number at ``min_score`` or above, best and worst score.

    A group of work is summed up before it leaves its task; no pair does.
    """
    names = T.StructType([
        T.StructField("query", queries.schema[query_key].dataType), T.StructField("products", T.LongType()),
        T.StructField("matches", T.LongType()), T.StructField("best", T.DoubleType()),
        T.StructField("worst", T.DoubleType())])
    schema = to_arrow_schema(names)

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return schema.empty_table()
        scores = _scores(rows, asked)
        return pa.table([asked.column("query"), pa.array(np.full(asked.num_rows, rows.num_rows)),
                         pa.array((scores >= min_score).sum(axis=0)), pa.array(scores.max(axis=0)),
                         pa.array(scores.min(axis=0))], schema=schema)

    parts = _meet(vectors, key, vector, queries, query_key, query_vector, page, run, names)
    return parts.groupBy("query").agg(F.sum("products").alias("products"), F.sum("matches").alias("matches"),
                                      F.max("best").alias("best"), F.min("worst").alias("worst"))


def embedding_search(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str,
                     query_vector: str, min_score: float = 0.3) -> DataFrame:
    """Products scoring at least ``min_score`` for each query, ranked within the query.

    Ranks come from the counts of the different scores, so no task sorts all matches
    of a query.
    """
    found = score(vectors, key, vector, queries, query_key, query_vector, min_score=min_score)
    millionths = found.withColumn("_score", F.round(F.col("score") * 1_000_000).cast("long"))
    ranked = with_descending_rank(millionths, ["query"], "_score", "score_rank", spread=key)
    return ranked.select("query", key, "score", F.col("score_rank").cast("int").alias("score_rank"))


def nearest(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str,
            query_vector: str, k: int) -> DataFrame:
    """Exactly the ``k`` highest scoring keys per query; ties go to the lower key."""
    candidates = score(vectors, key, vector, queries, query_key, query_vector, k=k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), key)
    return candidates.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def cross_top_k(households: DataFrame, household_key: str, items: DataFrame, item_key: str,
                vector: str, k: int) -> DataFrame:
    """Best households per item, and the best items for each of those households.

    ``direction`` tells the two lists apart.
    """
    forward = nearest(households, household_key, vector, items, item_key, vector, k)
    chosen = households.join(forward.select(household_key).distinct(), household_key, "left_semi")
    back = score(chosen, household_key, vector, items, item_key, vector, per_row=k)
    order = Window.partitionBy(household_key).orderBy(F.desc("score"), "query")
    back = back.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
    columns = [F.col("query").alias(item_key), household_key, "score", "position"]
    return forward.select(F.lit("item").alias("direction"), *columns).unionByName(
        back.select(F.lit("household").alias("direction"), *columns))


def first_per_group(vectors: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """One representative vector per group: the one with the lowest key."""
    return vectors.groupBy(group).agg(F.min(key).alias(key), F.min_by(vector, key).alias(vector))


def vector_conflicts(df: DataFrame, group: str, key: str, vector: str, cutoff: float = 0.99,
                     block: int = 8_000) -> DataFrame:
    """Pairs of different vectors stored under one group key whose similarity is below ``cutoff``.

    Equal vectors of a group are one, named by its lowest key. The vectors of a group
    are dealt into blocks and a task compares two of them, so a group with very many
    vectors is split; only conflicting pairs leave the task, a slice of the block at a
    time. A vector moves once for each block of its group.
    """
    distinct = cut_lineage(df.where(F.col(vector).isNotNull()).groupBy(group, F.col(vector).alias("v"))
                           .agg(F.min(key).alias("k")))
    sizes = distinct.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = (distinct.join(sizes, group).withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}))
    types = T.StructType([T.StructField(group, df.schema[group].dataType), T.StructField(key, df.schema[key].dataType),
                          T.StructField("reference", df.schema[key].dataType), T.StructField("similarity", T.DoubleType())])
    arrow = to_arrow_schema(types)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        own, low, high = (rows.column(c).to_numpy() for c in ("own", "low", "high"))
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        vectors = matrix(rows.column("v").combine_chunks())
        names, theirs = rows.column("k").to_numpy(), vectors[right].T
        name = rows.column(group).combine_chunks()[:1]
        step = max(1, SLICE // max(1, len(right)))
        for at in range(0, len(left), step):
            mine = left[at:at + step]
            scores = np.round(vectors[mine] @ theirs, 6) + 0.0
            # The lower key of a pair is its reference; within one block a pair is met twice.
            wanted = scores < cutoff
            if low[0] == high[0]:
                wanted &= names[mine][:, None] < names[right][None, :]
            i, j = np.nonzero(wanted)
            a, b = names[mine[i]], names[right[j]]
            yield pa.RecordBatch.from_arrays(
                [name.take(pa.array(np.zeros(len(i), np.int64))), pa.array(np.maximum(a, b)),
                 pa.array(np.minimum(a, b)), pa.array(scores[i, j])], schema=arrow)

    return dealt.groupBy(group, "low", "high").applyInArrow(compare, types)


def coverage(spend: DataFrame, keys: DataFrame, key: str, thresholds: list[int]) -> DataFrame:
    """How many sold products have a vector, and at which spend.

    One row per part: sold products, sold with a vector, vectors never sold.
    ``spend`` has one row per product with ``spend_cents``.
    """
    sold = spend.select(key, "spend_cents", F.lit(1).alias("_sold"))
    known = keys.select(key).distinct().withColumn("_known", F.lit(1))
    both = sold.join(known, key, "outer").select(
        "spend_cents", F.explode(F.filter(F.array(
            F.when(F.col("_sold") == 1, "sold"),
            F.when((F.col("_sold") == 1) & (F.col("_known") == 1), "sold_with_vector"),
            F.when(F.col("_sold").isNull(), "vector_only"),
            F.when(F.col("_known").isNull(), "sold_without_vector"),
        ), lambda x: x.isNotNull())).alias("part"))
    over = [F.sum(F.when(F.col("spend_cents") > t, 1).otherwise(0)).alias(f"num_over_{t}")
            for t in thresholds]
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("products"), *over)


def vector_universe(vectors: DataFrame, key: str, vector: str, products: DataFrame, department: str,
                    restricted: DataFrame, on: list[str], version: str | None = None) -> DataFrame:
    """One vector per product of a department, without restricted categories.

    Several vectors under one key: the highest version counts.
    """
    wanted = products.where(F.col("department") == department).join(restricted, on, "left_anti")
    kept = vectors.join(wanted.select(key), key, "left_semi")
    order = F.col(version) if version else F.col(vector)
    return kept.groupBy(key).agg(F.max_by(vector, order).alias(vector))


def _unit(encoder: Callable) -> Callable:
    """Encoder whose vectors have unit length, or are zero where there is no direction."""
    def load():
        encode = encoder()

        def unit(texts: np.ndarray) -> np.ndarray:
            raw = np.asarray(encode(texts), np.float32).astype(np.float64)
            # Squares are added in order, as the sum over an array column does.
            length = np.sqrt(np.add.accumulate(raw * raw, axis=1)[:, -1:])
            return np.divide(raw, length, out=np.zeros_like(raw), where=length != 0).astype(np.float32)
        return unit
    return load


def embed_text(df: DataFrame, key: str, text: str, encoder: Callable | None = None,
               dimensions: int = 256, batch_size: int = 256) -> DataFrame:
    """Unit-length vector for each text.

    ``encoder`` is a factory: it is called once per worker and returns a function
    from an array of texts to a matrix. Without one, words are hashed into
    ``dimensions`` buckets and counted.
    """
    if encoder is not None:
        from pyspark.ml.functions import predict_batch_udf
        encode = predict_batch_udf(_unit(encoder), return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
        found = df.select(key, encode(F.col(text)).alias("vector"))
        return found.select(key, F.when((F.array_max("vector") != 0) | (F.array_min("vector") != 0), F.col("vector")).alias("vector"))
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array
    words = df.select(key, F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+").alias("_w"))
    counted = HashingTF(numFeatures=dimensions, inputCol="_w", outputCol="_c").transform(words)
    unit = Normalizer(inputCol="_c", outputCol="_u").transform(counted)
    return unit.select(key, vector_to_array("_u", "float32").alias("vector"))


def word_buckets(dimensions: int = 256) -> Callable:
    """Encoder for :func:`embed_text`: counts of words by the first 32 bits of their MD5.

    Other systems can compute the same buckets, so stored vectors can be checked there.
    """
    def load():
        import hashlib

        class Places(dict):
            def __missing__(self, word: bytes) -> int:
                place = self[word] = int(hashlib.md5(word).hexdigest()[:8], 16) % dimensions
                return place

        known = Places()

        def encode(texts: np.ndarray) -> np.ndarray:
            if len(known) > KNOWN_WORDS:
                known.clear()
            counts = np.zeros((len(texts), dimensions), np.float32)
            for row, text in zip(counts, texts):
                # Bytes are split at ASCII blanks only.
                found = [known[word] for word in (text or "").lower().encode().split()]
                row += np.bincount(np.array(found, np.int64), minlength=dimensions)
            return counts
        return encode
    return load
