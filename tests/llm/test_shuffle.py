import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from hearthline.llm import queries, shuffle

SF = "/root/testdata/sf0.001"


def test_fisher_yates_is_uniform():
    generator = np.random.default_rng(1)
    seen = Counter(tuple(shuffle.fisher_yates(4, generator)) for _ in range(24_000))
    assert len(seen) == 24 and max(abs(n - 1_000) for n in seen.values()) < 150
    assert shuffle.fisher_yates(0, generator).size == 0


def _laws(rows, count):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[k] for k in range(count)) <= 1
    for k in range(count):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))


def test_awkward_rows_and_small_buckets(spark, texts_frame):
    rows = [(1, None), (2, ""), (None, "x"), (3, "same"), (4, "long " * 30_000)] + [(3, "same")] * 200
    docs = texts_frame(rows).withColumn("shard", F.lit("mine")).repartition(3)
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    out = shuffle.shards(docs, size, 7, bucket_bytes=200).collect()
    _laws(out, 7)
    assert Counter((r.doc_id, r.text) for r in out) == Counter(rows)
    assert shuffle.shards(docs.limit(0), size, 7).count() == 0
    few = shuffle.shards(texts_frame(rows[:2]), size, 7).collect()
    assert max(Counter(r.shard for r in few).values()) == 1 and all(r.slot == 0 for r in few)


def test_order_is_seeded_and_spread(spark):
    docs = spark.range(3_000)
    size = F.lit(10)

    def order(seed):
        rows = shuffle.shards(docs, size, 4, seed, bucket_bytes=5_000).collect()
        return [r.id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]

    assert order(1) == order(1) != order(2)
    assert abs(np.corrcoef(order(1), np.arange(3_000))[0, 1]) < 0.06


def test_write_shards(spark, tmp_path):
    out = shuffle.shards(spark.range(100), F.lit(1), 4)
    shuffle.write_shards(out, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.shard, r.slot, r.id) for r in back) == sorted((r.shard, r.slot, r.id) for r in out.collect())


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = queries.QUERIES["op5_shuffle"](spark, SF).collect()
    _laws(rows, 16)
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {
        (d.doc_id, len(d.text.encode()) + 1, zlib.crc32(d.text.encode())) for d in docs}
    assert len(rows) == len(docs) and all(r.law == "rows" and r.grown_shard is None for r in rows)
