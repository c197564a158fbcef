import numpy as np
import pytest

from hearthline.llm import ann, queries

SF = "/root/testdata/sf0.1"


def exact(rows, asked, k):
    """The k nearest of each query by brute force, with ties to the smaller id."""
    result = {}
    for name, v in asked:
        v = np.array(v, float)
        near = sorted((float(np.sqrt(((np.array(w, float) - v) ** 2).sum())), i) for i, w in rows
                      if i != name and len(w) == len(v))
        result[name] = near[:k]
    return result


def test_prune_keeps_diverse_edges():
    graph = ann.Graph(np.array([[0, 0], [1, 0], [1.1, 0], [0, 5], [-2, 0]]), 4)
    assert graph.prune(0, np.array([1, 2, 3, 4, 0, -1]), 1.2).tolist() == [1, 4, 3]


def test_graph_recall():
    rng = np.random.default_rng(3)
    points, asked = rng.normal(size=(2_000, 16)), rng.normal(size=(100, 16))
    graph = ann.Graph(points, 24)
    graph.build(48, 1.2)
    found, _ = graph.search(asked, 64)
    true = np.argsort(((asked[:, None] - points[None]) ** 2).sum(-1), axis=1)[:, :10]
    assert np.mean([len(set(f[:10]) & set(t)) / 10 for f, t in zip(found, true)]) > 0.95
    assert all(len(set(e[e >= 0])) == (e >= 0).sum() for e in graph.edges)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i), 1.0]) for i in range(1, 30)] + [(40 + i, [5.0, 1.0]) for i in range(30)]
    bad = [(100, None), (101, [0.0, 0.0]), (102, [1.0, None]), (103, [nan, 1.0]), (104, [inf, 1.0]), (105, []),
           (None, [1.0, 1.0])]
    other = [(200, [1.0, 2.0, 3.0]), (201, [1.0, 2.0, 4.0]), (5, [5.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 7) for i, v in rows + bad + other],
                                  "vec_id long, embedding array<double>, shard int")
    asked = frame.where("vec_id in (5, 20, 41, 100, 101, 104, 105, 200) or vec_id is null")
    found = ann.nearest(frame, asked, 10, shard_rows=25, page=3).collect()
    want = exact(rows + other[:2], [r for r in rows + other[:2] if r[0] in (5, 20, 41, 200)], 10)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got == want
    assert all(sorted(r.rank for r in found if r.query_id == q) == list(range(1, len(n) + 1)) for q, n in want.items())
    assert ann.nearest(frame.limit(0), asked, 10).count() == 0
    assert ann.nearest(frame, asked.limit(0), 10).count() == 0


@pytest.mark.parametrize("shard_rows", [400, 5_000])
def test_recall_over_shards(spark, shard_rows):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    asked = [r for r in rows if r[0] % 100 == 0]
    want = exact(rows, asked, 10)
    found = ann.nearest(table, table.where("vec_id % 100 = 0"), 10, shard_rows=shard_rows).collect()
    assert len(found) == 10 * len(asked)
    hits = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in found)
    assert hits / len(found) > 0.97
    exactly = {(q, i): d for q, near in want.items() for d, i in near}
    assert all(abs(r.score - exactly[r.query_id, r.vec_id]) < 1e-12 for r in found if (r.query_id, r.vec_id) in exactly)


def test_query(spark):
    rows = queries.QUERIES["op10_nearest"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 50 and {r["rank"] for r in rows} == set(range(1, 11))


@pytest.mark.parametrize("beam", [128, 12])
def test_more_ties_than_neighbours(spark, beam):
    """All vectors are equally far from each other: the smallest ids are the nearest."""
    rows = [(i, [1.0 if k == i else 0.0 for k in range(60)]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest(vectors, vectors.where("vec_id in (0, 5, 59)"), 10, beam=beam).collect()
    for q in (0, 5, 59):
        own = sorted((r.rank, r.vec_id) for r in found if r.query_id == q)
        assert [i for _, i in own] == [i for i in range(60) if i != q][:10]
        assert [n for n, _ in own] == list(range(1, 11))


def test_every_vector_is_reached():
    rng = np.random.default_rng(6)
    for vectors in (np.eye(100), rng.integers(0, 2, (400, 6)) + rng.normal(0, 1e-3, (400, 6)), rng.normal(0, 1, (600, 8))):
        graph = ann.Graph(vectors, 8)
        graph.build(16, 1.2)
        assert graph.reached().all()
