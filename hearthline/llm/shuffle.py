"""Two-pass external shuffle into shards.

Pass one scatters records uniformly over buckets by a seeded hash; there are as
many buckets as it takes for each to fit in a task's memory. Pass two loads a
bucket, puts its records in a random order (Fisher-Yates, seeded by bucket) and
writes it. The written buckets one after the other are one random permutation
of the corpus, which is cut into shards whose sizes differ by one record at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthline.session import cut_lineage

BUCKET_BYTES = 64 << 20
#: Buckets are added up in groups of so many.
GROUP = 4_096


def fisher_yates(n: int, generator: np.random.Generator) -> np.ndarray:
    """A uniformly random order of 0 to n - 1."""
    order = np.arange(n)
    swaps = generator.integers(0, np.arange(n, 0, -1)) if n else order
    for i, step in enumerate(swaps.tolist()):
        j = i + step
        order[i], order[j] = order[j], order[i]
    return order


def _shuffled(seed: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        bucket = pa.Table.from_batches(parts).combine_chunks()
        # Records arrive in no fixed order; their own hash gives them one.
        bucket = bucket.take(pc.sort_indices(bucket, [("_hash", "ascending")]))
        number = bucket.column("_bucket")[0].as_py()
        order = fisher_yates(bucket.num_rows, np.random.default_rng([seed, number]))
        mixed = bucket.take(pa.array(order)).drop_columns(["_hash"])
        yield from mixed.append_column("_at", pa.array(np.arange(len(order)))).to_batches(max_chunksize=2_000)
    return task


def scatter(df: DataFrame, size: F.Column | str, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows as ``_doc, _bucket, _at``: the bucket of each and its place there, in stored form.

    ``size`` is a row's number of bytes. The hash that picks the bucket covers a
    number of the row beside its values, so that equal rows are scattered as well.
    """
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, -(-int(total) // bucket_bytes))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc"),
                     F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).alias("_hash"))
    dealt = (rows.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))
             .repartitionById(buckets, F.col("_bucket")))
    schema = dealt.select("_doc", "_bucket").schema.add("_at", "long")
    return cut_lineage(dealt.mapInArrow(_shuffled(seed), schema))


def shards(df: DataFrame, size: F.Column | str, count: int, seed: int = 42,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` with two more columns, ``shard`` and ``slot``, in a random order over all rows.

    Columns of these names that ``df`` has are replaced. Shards have equally many rows, or one more or less; slots of a shard have no gaps.
    The same table read in the same splits gives the same order. Null values, repeated
    rows and rows of any length are records like all others; an empty table gives no
    rows; a row larger than a bucket makes that bucket larger.
    """
    mixed = scatter(df, size, seed, bucket_bytes)
    counts = (mixed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("g", F.floor(F.col("_bucket") / GROUP)))
    groups = counts.groupBy("g").agg(F.sum("n").alias("m"))
    ahead = groups.select("g", (F.sum("m").over(W.orderBy("g")) - F.col("m")).alias("ahead"),
                          F.sum("m").over(W.partitionBy()).alias("total"))
    within = F.sum("n").over(W.partitionBy("g").orderBy("_bucket")) - F.col("n")
    starts = cut_lineage(counts.withColumn("within", within).join(ahead, "g")
                         .select("_bucket", (F.col("ahead") + F.col("within")).alias("start"), "total"))
    place = mixed.join(starts, "_bucket").withColumn("at", F.col("start") + F.col("_at"))
    shard = F.expr(f"(at * {count}L) div total")
    first = F.expr(f"(shard * total + {count - 1}L) div {count}L")
    return (place.withColumn("shard", shard).withColumn("slot", F.col("at") - first)
            .select(*[F.col(f"_doc.`{c}`").alias(c) for c in df.columns if c not in ("shard", "slot")],
                    F.col("shard").cast("int").alias("shard"), "slot"))


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order; large shards are several files, by ranges of slots."""
    (df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
