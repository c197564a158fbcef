"""Vector search and clustering against numpy, and invariants of the fits."""

import hashlib
import re
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.operators import clusters as K
from hearthline.operators import vectors as V
from hearthline.session import cut_lineage


def frame(spark, matrix, first=0):
    rows = [(first + i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, v array<float>")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0, 0], [6, 0, 0], [0, 7, 0]])
    data = np.concatenate([c + rng.normal(scale=0.5, size=(60, 3)) for c in centres]).astype(np.float32)
    return data, frame(spark, data).cache()


def test_nearest_over_several_pages(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(200, 8)).astype(np.float32)
    # A third of the vectors are copies, so scores tie.
    data[100:170] = data[5]
    vectors, queries = frame(spark, data), frame(spark, data[:25]).withColumnRenamed("id", "q")
    scores = np.round(data.astype(float) @ data[:25].astype(float).T, 6)
    found = V.score(vectors, "id", "v", queries, "q", "v", min_score=1.5, page=4)
    assert found.count() == int((scores >= 1.5).sum())
    got = {(r["query"], r["position"]): r["id"] for r in V.nearest(vectors, "id", "v", queries, "q", "v", 7).collect()}
    for q in range(25):
        want = sorted(range(200), key=lambda i: (-scores[i, q], i))[:7]
        assert [got[q, p] for p in range(1, 8)] == want


def test_best_queries_per_row(spark):
    rng = np.random.default_rng(2)
    data, items = rng.normal(size=(60, 4)), rng.normal(size=(9, 4))
    both = V.cross_top_k(frame(spark, data), "id", frame(spark, items).withColumnRenamed("id", "item"), "item", "v", 3)
    scores = np.round(data.astype(np.float32).astype(float) @ items.astype(np.float32).astype(float).T, 6)
    best = {(r["id"], r["position"]): r["item"] for r in both.where("direction = 'household'").collect()}
    chosen = {i for j in range(9) for i in sorted(range(60), key=lambda i: (-scores[i, j], i))[:3]}
    assert {i for i, _ in best} == chosen
    for i in chosen:
        assert [best[i, p] for p in (1, 2, 3)] == sorted(range(9), key=lambda j: (-scores[i, j], j))[:3]


def test_no_queries(spark):
    df = frame(spark, np.eye(3))
    assert V.score(df, "id", "v", df.where("id > 9").withColumnRenamed("id", "q"), "q", "v").count() == 0


def test_embedding_is_unit_length_and_takes_an_encoder(spark):
    df = spark.createDataFrame([(1, "red bolt red"), (2, "bolt red red"), (3, "")], "id long, t string")
    got = {r["id"]: np.array(r["vector"]) for r in V.embed_text(df, "id", "t").collect()}
    assert np.allclose(got[1], got[2]) and abs(np.linalg.norm(got[1]) - 1) < 1e-5

    def encoder():
        return lambda texts: np.array([[3.0, float(4 * len(t) / max(len(t), 1))] for t in texts])

    own = {r["id"]: r["vector"] for r in V.embed_text(df, "id", "t", encoder).collect()}
    assert own[1] == pytest.approx([0.6, 0.8])


def test_encoder_batches_are_normalized_as_rows(spark):
    """Unit length, zeros give null, blanks are ASCII ones, and the length is not computed once per element."""
    texts = ["red\u00a0bolt Red\tRED", None, "", " \x0b ", "\u0130 \u1e9e x\x1cy", "a b a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    found = V.embed_text(df, "id", "t", V.word_buckets(16))
    got = {r["id"]: r["vector"] for r in found.collect()}
    for i, text in enumerate(texts):
        words = [w for w in re.split(r"[ \t\n\r\f\v]+", (text or "").lower()) if w]
        want = np.zeros(16)
        for w in words:
            want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16] += 1
        assert got[i] is None if not words else np.array_equal(np.float32(got[i]), np.float32(want / np.sqrt((want ** 2).sum())))
    odd = V.embed_text(df, "id", "t", lambda: lambda t: np.array([[np.nan, 1.0] if x is None else [-2.0, 0.0] for x in t]))
    rows = {r["id"]: r["vector"] for r in odd.collect()}
    assert rows[0] == [-1.0, 0.0] and all(np.isnan(x) for x in rows[1])
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def brute_density(data, eps, min_pts):
    gaps = np.sqrt(((data[:, None] - data[None]) ** 2).sum(2))
    near = gaps <= eps
    core = near.sum(1) >= min_pts
    label = np.full(len(data), -1)
    for i in np.nonzero(core)[0]:
        if label[i] == -1:
            stack, label[i] = [i], i
            while stack:
                for j in np.nonzero(near[stack.pop()] & core)[0]:
                    if label[j] == -1:
                        label[j] = i
                        stack.append(j)
    for i in np.nonzero(~core)[0]:
        touching = np.nonzero(near[i] & core)[0]
        if len(touching):
            label[i] = label[touching.min()]
    return label


@pytest.mark.parametrize("eps,min_pts", [(0.6, 4), (1.0, 10)])
def test_density_clusters_equal_brute_force(spark, blobs, eps, min_pts):
    data, _ = blobs
    copies = np.concatenate([data, np.repeat(data[:1], 40, axis=0), [[50, 50, 50]]]).astype(np.float32)
    got = K.density_clusters(frame(spark, copies), "id", "v", eps, min_pts, pivots=5, block=30)
    labels = {r["id"]: r["cluster"] for r in got.collect()}
    assert len(labels) == len(copies)
    want = brute_density(copies.astype(float), eps, min_pts)
    assert [labels[i] for i in range(len(copies))] == list(want)


def test_density_stores_no_copies_for_blocks(spark, blobs, monkeypatch):
    """Small tiles and blocks give the same, and no stored table holds a vector once per block."""
    data, _ = blobs
    stored = []
    monkeypatch.setattr(K, "TILE", 7)
    monkeypatch.setattr(K, "cut_lineage", lambda df: stored.append(cut_lineage(df)) or stored[-1])
    got = K.density_clusters(frame(spark, data), "id", "v", 0.6, 4, pivots=1, block=20)
    labels = {r["id"]: r["cluster"] for r in got.collect()}
    assert [labels[i] for i in range(len(data))] == list(brute_density(data.astype(float), 0.6, 4))
    assert max(t.count() for t in stored if "vector" in t.columns) == len(data)


def test_pca_keeps_the_leading_variance(blobs):
    data, df = blobs
    reduced = np.array([r["v"] for r in K.reduce_pca(df, "v", 2).orderBy("id").collect()])
    centred = data - data.mean(0)
    values = np.linalg.svd(centred, compute_uv=False) ** 2
    variance = ((reduced - reduced.mean(0)) ** 2).sum(0)
    assert variance == pytest.approx(values[:2], rel=1e-3)


def test_elbow_stops_and_always_returns_a_model(blobs):
    _, df = blobs
    model, k, costs = K.kmeans_elbow(df, "v", stop=0.05)
    assert 3 <= k and costs[3] < costs[2] and abs(costs[k] - costs[k - 1]) <= 0.05 * abs(costs[2] - costs[3])
    assert K.assign(model, df, "v").select("cluster").distinct().count() == k
    assert K.silhouette(K.assign(model, df, "v"), "v", "cluster") > 0.3


def test_elbow_looks_at_fits_in_order(blobs, monkeypatch):
    """Fits run at the same time; later ones neither change the choice nor its costs."""
    _, df = blobs
    together, most, lock, plain = [], [], threading.Lock(), K.kmeans

    def watched(data, vector, k, seed):
        with lock:
            together.append(k)
            most.append(len(together))
        time.sleep(0.3 * (k == 2))
        found = plain(data, vector, k, seed)
        with lock:
            together.remove(k)
        return found

    monkeypatch.setattr(K, "kmeans", watched)
    model, k, costs = K.kmeans_elbow(df, "v", stop=0.05)
    assert max(most) > 1 and sorted(costs) == list(range(2, k + 1)) and len(model.clusterCenters()) == k
    assert costs == pytest.approx({n: plain(df, "v", n, 1)[1] for n in costs}, rel=0.5)
    assert all(abs(costs[n] - costs[n - 1]) > 0.05 * abs(costs[2] - costs[3]) for n in range(4, k))


def test_trustworthiness_of_the_same_space_is_one(blobs):
    _, df = blobs
    assert K.trustworthiness(df, df, "id", "v").first()["trustworthiness"] == 1.0
    flat = df.withColumn("v", F.slice("v", 3, 1))
    whole = K.trustworthiness(df, flat, "id", "v", block=37).first()
    assert whole["trustworthiness"] < 0.95 and whole["points"] == 180
    assert whole == K.trustworthiness(df, flat, "id", "v").first()
    assert K.trustworthiness(df, flat, "id", "v", df.where("id < 20"), block=50).first()["points"] == 20


def test_trustworthiness_with_equal_rows_against_plain(spark, monkeypatch):
    """Ties and copies, tiny slices: ranks as sorting all distances gives them."""
    monkeypatch.setattr(K, "SLICE", 90)
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(60, 4)), 1)
    x[20:30], y = x[3], np.round(x[:, :2], 0)
    plain = lambda m: spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(m)], "id long, v array<double>")
    total = 0
    for i in range(60):
        before, after = (((m - m[i]) ** 2).sum(axis=1) for m in (x, y))
        rank = {j: r for r, j in enumerate([j for j in np.lexsort((np.arange(60), before)) if j != i], 1)}
        total += sum(max(rank[j] - 5, 0) for j in [j for j in np.lexsort((np.arange(60), after)) if j != i][:5])
    for block in (13, 20_000):
        row = K.trustworthiness(plain(x), plain(y), "id", "v", block=block).first()
        assert row["trustworthiness"] == pytest.approx(1 - 2 * total / (60 * 5 * (120 - 16)), abs=1e-6)


def test_conflicts_in_slices(spark, monkeypatch):
    """Each vector moves once for each block of its group; slices of a block give every pair once."""
    monkeypatch.setattr(V, "SLICE", 16)
    rng = np.random.default_rng(8)
    data = rng.normal(size=(40, 3))
    df = spark.createDataFrame([(i % 2, i, p.tolist()) for i, p in enumerate(data)], "g long, id long, v array<double>")
    scores = np.round(data @ data.T, 6)
    want = {(i % 2, j, i, scores[i, j]) for i in range(40) for j in range(i + 1, 40) if i % 2 == j % 2 and scores[i, j] < 0.1}
    for block in (7, 8_000):
        rows = V.vector_conflicts(df, "g", "id", "v", 0.1, block).collect()
        assert len(rows) == len(want) and {(r["g"], r["id"], r["reference"]) for r in rows} == {w[:3] for w in want}


def test_conflicts_between_all_vectors_of_a_key(spark):
    df = spark.createDataFrame([(1, 1, [1.0, 0.0]), (1, 2, [0.7, 0.714]), (1, 3, [0.7, -0.714]), (1, 4, [0.7, -0.714]),
                                (2, 5, [0.0, 1.0]), (2, 6, None)], "g long, id long, v array<double>")
    for block in (1, 1_000):
        rows = V.vector_conflicts(df, "g", "id", "v", 0.5, block).collect()
        assert [(r["id"], r["reference"], r["similarity"]) for r in rows] == [(3, 2, -0.019796)]


def test_two_labels_of_a_product_fail(spark):
    products = spark.createDataFrame([(1,), (2,)], "upc long")
    labels = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "upc long, cluster int")
    texts = spark.createDataFrame([(1, "a")], "upc long, description string")
    with pytest.raises(Exception, match="more than one cluster for 1"):
        K.label_products(products, labels, "upc", texts).collect()
    assert K.label_products(products, labels.where("cluster = 5"), "upc", texts).count() == 2


def test_one_member_cluster_has_no_distance(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (2, "b", "y"), (2, "a", "z")], "c int, l1 string, l2 string")
    got = {r["c"]: (r["pairs"], r["mean_dist"]) for r in K.cluster_cohesion(df, "c", ["l1", "l2"]).collect()}
    assert 1 not in got or got[1][0] == 0
    assert got[2] == (3, round((3 + 2 + 3) / 3, 6))


def test_sweep_logs_every_combination(blobs):
    _, df = blobs
    spaces = [{"method": "identity"}, {"method": "pca", "n_components": 2}]
    ways = [{"method": "kmeans", "stop": 0.5}, {"min_pts": 4, "eps": 0.8, "method": "density"}]
    reductions, fits, stats = K.sweep(df, "id", "v", spaces, ways)
    assert {r["unique_id"] for r in reductions.collect()} == {K.run_key(s) for s in spaces}
    assert {r["unique_id"] for r in fits.collect()} == {K.run_key(s, w) for s in spaces for w in ways}
    assert K.run_key({"a": 1, "b": 2}) == K.run_key({"b": 2, "a": 1}) != K.run_key({"a": 1})
    rows = stats.collect()
    assert len(rows) == 4 and all(r["dr_silhouette"] is None or -1 <= r["dr_silhouette"] <= 1 for r in rows)
