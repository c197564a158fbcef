import math
import random

import numpy as np
import pytest

from check import compare, database
from hearthline.llm import negatives, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, a long, rank string"


def plain(rows, every=1):
    """Anchors are rows whose id is divisible by ``every``; integers in Python."""
    held = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
            if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, v in held:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in held if j != i and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 50 * -ps <= 100 * -s[0] <= 95 * -ps][:3]
            out += [(i, p, k + 1, s[1], -ps, -s[0]) for k, s in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, every=1, **sizes):
    df = spark.createDataFrame([(i, v, label, 7, "x") for i, v, label in rows], SCHEMA)
    found = negatives.mine(df, df.where(f"vec_id % {every} = 0"), **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def test_query_against_sql(spark):
    result, _ = compare(spark, database(SF), "op13_negatives", SF)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("sizes", [{}, {"page": 7, "block": 20}])
def test_against_plain(spark, sizes):
    rng = random.Random(1)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(150):
        centre = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.1) for x in centre], rng.choice([0, 0, 0, 1, 2])))
    assert mined(spark, rows, 3, **sizes) == plain(rows, 3) != []


def test_ties_repeats_and_unusable_rows(spark):
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.8, 0.1], [0.7, 0.7]]
    rows = [(i, vectors[i % 4], i % 2) for i in range(24)] + [(3, vectors[3], 1), (4, [0.9, 0.2], 1), (4, [0.9, 0.3], 0)]
    bad = [(None, [1.0, 1.0], 0), (50, None, 0), (51, [1.0, 1.0], None), (52, [], 1), (53, [1.0, None], 1),
           (54, [float("nan"), 1.0], 1), (55, [float("inf"), 1.0], 0), (56, [0.0, 0.0], 0), (57, [1.0, 1.0, 1.0], 0)]
    assert mined(spark, rows + bad) == plain(rows + bad) != []
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0)]) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 0), (3, [0.5], 0)]) == []


def test_large_numbers_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-3e6, 3e6) for _ in range(4)], i % 3) for i in range(40)]
    assert mined(spark, rows) == plain(rows) != []
    assert len(mined(spark, [(i, [1e300, -1e300 * (i % 2)], i % 2) for i in range(6)])) >= 0


def test_tree_and_bounds():
    rng = np.random.default_rng(3)
    points = rng.integers(-50, 50, (60, 5))
    parent, length = negatives.spanning_tree(points)
    order = negatives.walk(parent)
    assert sorted(order) == list(range(60)) and list(parent).count(-1) == 1
    assert all(order.index(p) < order.index(c) for c, p in enumerate(parent) if p >= 0)
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert np.allclose(length[parent >= 0], [apart[c, p] for c, p in enumerate(parent) if p >= 0])
    left, total = set(range(1, 60)), 0.0
    while left:
        at = min(left, key=lambda c: min(apart[c, o] for o in range(60) if o not in left))
        total += min(apart[at, o] for o in range(60) if o not in left)
        left.remove(at)
    assert math.isclose(length.sum(), total)
    block = negatives.Block(np.arange(500), np.zeros(500), rng.integers(-50, 50, (500, 5)), points)
    exact = block.vectors @ points.T

    def wanted(at, low, high):
        assert ((low <= exact[:, at]) & (exact[:, at] <= high)).all()
        return np.flatnonzero(high >= 6_000)

    for at, rows, found in block.intervals(parent, length, wanted):
        assert set(np.flatnonzero(exact[:, at] >= 6_000)) <= set(rows) and (found == exact[rows, at]).all()


def test_near_anchors_save_scores():
    """Anchors close to each other: most candidates are never scored again."""
    rng = np.random.default_rng(4)
    points = np.rint(256 * (np.ones(16) / 4 + rng.normal(0, 0.002, (100, 16)))).astype(np.int64)
    rows = np.rint(256 * rng.normal(0, 0.25, (2_000, 16))).astype(np.int64)
    block = negatives.Block(np.arange(2_000), np.zeros(2_000), rows, points)
    parent, length = negatives.spanning_tree(points)
    for _ in block.intervals(parent, length, lambda at, low, high: np.flatnonzero(high >= 35_000)):
        pass
    assert block.scored < 100 * 2_000 / 4
