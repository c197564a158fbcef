import numpy as np
import pytest

from hearthline.operators import vector_index as I
from hearthline.operators import vectors as V

SCHEMA = "name long, vec array<double>"


def clustered(rng, groups, each, size, spread=0.05):
    centres = rng.normal(size=(groups, size))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return np.concatenate([c + rng.normal(0, spread, (each, size)) for c in centres])


def frame(spark, points, first=0):
    return spark.createDataFrame([(i + first, p.tolist()) for i, p in enumerate(points)], SCHEMA)


def plain(points, asked, k):
    scores = np.round(points @ asked.T, 6)
    return {(j, int(i), n + 1) for j in range(len(asked)) for n, i in enumerate(sorted(range(len(points)), key=lambda i: (-scores[i, j], i))[:k])}


def rows_of(found):
    return {(r["query"], r["name"], r["position"]) for r in found.collect()}


@pytest.mark.parametrize("page", [2_000, 3])
def test_bounds_are_exact_and_skip_blocks(spark, monkeypatch, page):
    monkeypatch.setattr(I, "PAGE", page)
    rng = np.random.default_rng(1)
    points = np.concatenate([clustered(rng, 20, 40, 12), np.ones((30, 12))])
    asked = clustered(rng, 8, 1, 12)
    blocks = I.build_blocks(frame(spark, points), "name", "vec", block=40)
    found = I.bounded_nearest(blocks, "name", frame(spark, asked), "name", "vec", 5, first=1)
    assert rows_of(found.rows) == plain(points, asked, 5)
    every = blocks.bounds.count() * len(asked)
    assert found.met.distinct().count() == found.met.count() < every / 2
    assert sum(r["count"] for r in blocks.rows.groupBy("cell").count().collect()) == len(points)
    assert max(r["count"] for r in blocks.rows.groupBy("cell").count().collect()) <= 80


def test_bounds_on_vectors_without_groups(spark):
    """Nothing can be left out, and nothing is lost."""
    rng = np.random.default_rng(2)
    points, asked = rng.normal(size=(300, 30)), rng.normal(size=(6, 30))
    blocks = I.build_blocks(frame(spark, points), "name", "vec", block=50)
    found = I.bounded_nearest(blocks, "name", frame(spark, asked), "name", "vec", 7)
    assert rows_of(found.rows) == plain(points, asked, 7)


def test_few_and_no_vectors(spark):
    points, asked = np.eye(4)[:3], np.eye(4)[:2]
    some = frame(spark, points).unionByName(spark.createDataFrame([(9, None)], SCHEMA))
    blocks = I.build_blocks(some, "name", "vec")
    found = I.bounded_nearest(blocks, "name", frame(spark, asked).unionByName(spark.createDataFrame([(9, None)], SCHEMA)), "name", "vec", 10)
    assert rows_of(found.rows) == plain(points, asked, 10)
    none = I.build_blocks(frame(spark, points).limit(0), "name", "vec")
    assert I.bounded_nearest(none, "name", frame(spark, asked), "name", "vec", 3).rows.count() == 0
    assert I.bucket_nearest(some, "name", "vec", frame(spark, asked).limit(0), "name", "vec", 3).rows.count() == 0


def test_buckets_against_plain(spark, monkeypatch):
    """The same buckets in plain numpy, frequent ones cut."""
    monkeypatch.setattr(I, "BLOCK", 15)
    rng = np.random.default_rng(3)
    points, asked = rng.normal(size=(200, 6)), rng.normal(size=(9, 6))
    points[:60] = points[0]
    found = I.bucket_nearest(frame(spark, points), "name", "vec", frame(spark, asked), "name", "vec", 4, tables=3, bits=4, flips=1)
    planes = I.directions(6, 3, 4)
    signs = lambda v: [tuple(p @ v > 0) for p in planes]
    expected = set()
    for j, q in enumerate(asked):
        own = set()
        for t, plane in enumerate(planes):
            bits = plane @ q
            turned = (bits > 0).copy()
            turned[np.abs(bits).argmin()] ^= True
            own |= {(t, tuple(bits > 0)), (t, tuple(turned))}
        near = [i for i, p in enumerate(points) if own & set(enumerate(signs(p)))]
        best = sorted(near, key=lambda i: (-round(float(points[i] @ q), 6), i))[:4]
        expected |= {(j, i, n + 1) for n, i in enumerate(best)}
    assert rows_of(found.rows) == expected


def test_recall_of_buckets(spark):
    """Near copies among many others: over nine tenths are found in a fraction of the comparisons."""
    rng = np.random.default_rng(4)
    points = clustered(rng, 300, 10, 32, 0.04)
    asked = points[::100] + rng.normal(0, 0.02, (30, 32))
    vectors, queries = frame(spark, points), frame(spark, asked)
    exact = V.nearest(vectors, "name", "vec", queries, "name", "vec", 10).select("query", "name")
    found = I.bucket_nearest(vectors, "name", "vec", queries, "name", "vec", 10)
    assert I.recall(found.rows, exact, "name") >= 0.9
    sizes = np.zeros(I.TABLES << I.BITS, int)
    own = I.buckets(points, I.directions(32, I.TABLES, I.BITS))[:, :, 0] + (np.arange(I.TABLES) << I.BITS)
    np.add.at(sizes, own.ravel(), 1)
    met = sum(sizes[int(r.cell.split(":")[0])] for r in found.met.collect())
    assert met < len(points) * len(asked) / 2
    whole = I.bucket_nearest(vectors, "name", "vec", queries, "name", "vec", 10, tables=1, bits=0, flips=0)
    assert I.recall(whole.rows, exact, "name") == 1.0


def test_few_and_many_queries_give_the_same(spark):
    rng = np.random.default_rng(9)
    points, asked = np.round(rng.normal(size=(120, 4)), 1), np.round(rng.normal(size=(7, 4)), 1)
    vectors = frame(spark, points).unionByName(spark.createDataFrame([(500, None)], SCHEMA)).repartition(3)
    queries = frame(spark, asked).unionByName(spark.createDataFrame([(500, None)], SCHEMA))
    for page in (2_000, 7, 3):
        found = V.score(vectors, "name", "vec", queries, "name", "vec", k=5, page=page)
        best = {}
        for r in found.collect():
            best.setdefault(r["query"], []).append((-r["score"], r["name"]))
        assert {(q, n, i + 1) for q, own in best.items() for i, (_, n) in enumerate(sorted(own)[:5])} == plain(points, asked, 5)
        summed = {r["query"]: (r.products, r.matches) for r in V.score_summary(
            vectors, "name", "vec", queries, "name", "vec", 0.5, page=page).collect()}
        scores = np.round(points @ asked.T, 6)
        assert summed == {j: (120, int((scores[:, j] >= 0.5).sum())) for j in range(7)}
    assert V.score(vectors, "name", "vec", queries.limit(0), "name", "vec").count() == 0


def test_pairs_of_query_and_bucket_never_pass_the_driver(spark):
    """They pack so well that their files look small; they are many."""
    rng = np.random.default_rng(10)
    points = frame(spark, rng.normal(size=(50, 6)))
    found = I.bucket_nearest(points, "name", "vec", points.where("name % 5 = 0"), "name", "vec", 3, tables=3, bits=2, flips=1)
    plan = found.rows._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner, (query" in line and "strategy=merge" in line for line in plan.splitlines())
