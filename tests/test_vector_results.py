"""Results of fits against plain numpy."""

import json

import numpy as np
import pytest

from hearthline.operators import clusters as K
from hearthline.plans import load

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def test_pca_variances(spark, data):
    _, points = data
    values = np.sort(np.linalg.eigvalsh(np.cov(points.T)))[::-1]
    rows = sorted(load().QUERIES["v08_pca_variances"](spark, SMALL).collect(), key=lambda r: r.component)
    assert [r.component for r in rows] == list(range(1, 11))
    assert np.allclose([r.variance for r in rows], values[:10], rtol=1e-6)
    assert np.allclose([r.share for r in rows], values[:10] / values.sum(), rtol=1e-6)


def test_trustworthiness_of_pca(spark, data):
    names, points = data
    centred = points - points.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov(points.T))
    small = centred @ axes[:, ::-1][:, :10]
    n, k, total = len(points), 5, 0
    for i in range(n):
        before, after = (((x - x[i]) ** 2).sum(axis=1) for x in (points, small))
        order = [j for j in np.lexsort((names, before)) if j != i]
        rank = {j: r + 1 for r, j in enumerate(order)}
        total += sum(max(rank[j] - k, 0) for j in [j for j in np.lexsort((names, after)) if j != i][:k])
    row = load().QUERIES["v09_trustworthiness_of_pca"](spark, SMALL).first()
    assert row.points == n and abs(row.trustworthiness - (1 - 2 * total / (n * k * (2 * n - 3 * k - 1)))) < 2e-4


def test_kmeans_report(spark, data):
    _, points = data
    rows = load().QUERIES["v10_kmeans_report"](spark, SMALL).collect()
    k, cost, before = rows[0].k, rows[0].cost, rows[0].cost_before
    assert len(rows) == k and sum(r.size for r in rows) == len(points)
    assert np.isclose(sum(r.cluster_cost for r in rows), cost, rtol=1e-6)
    # The rule has ended the fit.
    assert abs(cost - before) <= 0.01 * rows[0].first_fall
    model, chosen, costs = K.kmeans_elbow(spark.createDataFrame([(p.tolist(),) for p in points], "embedding array<double>"), "embedding")
    gaps = ((points[:, None, :] - np.array(model.clusterCenters())[None]) ** 2).sum(axis=2)
    assert np.isclose(gaps.min(axis=1).sum(), costs[chosen], rtol=1e-6)
    assert 0 < cost < ((points - points.mean(axis=0)) ** 2).sum()


def test_sweep_scores(spark):
    """Two tight groups: all scores as formulas give them on the raw vectors."""
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(0, 0.1, (30, 6)), rng.normal(0, 0.1, (30, 6)) + 3, rng.normal(0, 0.1, (30, 6)) - 3])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    _, fits, scores = K.sweep(df, "vec_id", "embedding", [{"method": "pca", "n_components": 2}], [{"method": "density", "eps": 1.0, "min_pts": 3}])
    row, fit = scores.first(), fits.first()
    assert fit.num_clusters == 3 and json.loads(fit.hparam_dict)["eps"] == 1.0 and row.unique_id == fit.unique_id
    label = np.repeat([0, 1, 2], 30)
    means = np.array([points[label == c].mean(axis=0) for c in range(3)])
    within = sum(((points[label == c] - means[c]) ** 2).sum() for c in range(3))
    between = 30 * ((means - points.mean(axis=0)) ** 2).sum()
    assert np.isclose(row.base_ch, between / within * (90 - 3) / 2, rtol=1e-4)
    spread = [np.sqrt(((points[label == c] - means[c]) ** 2).sum(axis=1)).mean() for c in range(3)]
    ratio = [max((spread[a] + spread[b]) / np.linalg.norm(means[a] - means[b]) for b in range(3) if b != a) for a in range(3)]
    assert np.isclose(row.base_db, np.mean(ratio), rtol=1e-4)
    far = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    own = np.array([far[i][label == label[i]].sum() / 29 for i in range(90)])
    other = np.array([min(far[i][label == c].mean() for c in range(3) if c != label[i]) for i in range(90)])
    assert np.isclose(row.base_silhouette, ((other - own) / np.maximum(own, other)).mean(), rtol=1e-4)
