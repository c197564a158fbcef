import numpy as np
import pytest

from hearthline.operators import loess as L
from hearthline.operators import seasonal as S


def local(values, trust, x, q):
    """One point at a time: weights, weighted line, value at x. Points are numbered from 1."""
    n = len(values)
    if q >= n:
        left, right = 1, n
    else:
        left = max(1, min(int(x) - (q + 1) // 2 + 1, n - q + 1))
        right = left + q - 1
    h = max(x - left, right - x) + ((q - n) // 2 if q > n else 0)
    w = {}
    for j in range(left, right + 1):
        r = abs(j - x)
        if r <= 0.999 * h:
            w[j] = (1.0 if r <= 0.001 * h else (1 - (r / h) ** 3) ** 3) * (1.0 if trust is None else trust[j - 1])
    total = sum(w.values())
    if total <= 0:
        return None
    w = {j: v / total for j, v in w.items()}
    a = sum(v * j for j, v in w.items())
    c = sum(v * (j - a) ** 2 for j, v in w.items())
    if c ** 0.5 > 0.001 * (n - 1):
        w = {j: v * ((x - a) / c * (j - a) + 1) for j, v in w.items()}
    return sum(v * values[j - 1] for j, v in w.items())


def plain(y, period, seasonal, inner, outer):
    n, trust = len(y), None
    nt = int(np.ceil(1.5 * period / (1 - 1.5 / seasonal)))
    nt += nt % 2 == 0
    nl = period + 1 + ((period + 1) % 2 == 0)
    trend, season = np.zeros(n), np.zeros(n)
    mean = lambda v, k: np.array([v[i:i + k].mean() for i in range(len(v) - k + 1)])
    for turn in range(outer + 1):
        for _ in range(inner):
            rest, wide = y - trend, np.zeros(n + 2 * period)
            for p in range(period):
                own = rest[p::period]
                t = None if trust is None else trust[p::period]
                got = [local(own, t, x, seasonal) for x in range(len(own) + 2)]
                mid = [o if g is None else g for o, g in zip(own, got[1:-1])]
                wide[p::period] = [mid[0] if got[0] is None else got[0], *mid, mid[-1] if got[-1] is None else got[-1]]
            low = mean(mean(mean(wide, period), period), 3)
            low = np.array([local(low, None, x, nl) for x in range(1, n + 1)])
            season = wide[period:period + n] - low
            rest = y - season
            got = [local(rest, trust, x, nt) for x in range(1, n + 1)]
            trend = np.array([r if g is None else g for r, g in zip(rest, got)])
        if turn < outer:
            gap = np.abs(y - trend - season)
            limit = 6 * np.median(gap)
            trust = np.array([0.0 if g > 0.999 * limit else 1.0 if g <= 0.001 * limit else (1 - (g / limit) ** 2) ** 2 for g in gap])
    return season, trend


def series(rng, n, period=13):
    t = np.arange(n)
    y = 100 + 0.5 * t + 20 * np.sin(2 * np.pi * t / period) + rng.normal(0, 3, n)
    y[rng.integers(0, n, 3)] += 200
    return y


@pytest.mark.parametrize("n,period,window,inner,outer", [
    (80, 13, 3, 5, 0), (26, 13, 3, 5, 0), (61, 13, 7, 2, 3), (40, 4, 5, 2, 6), (30, 13, 35, 1, 2)])
def test_components_against_plain(n, period, window, inner, outer):
    rng = np.random.default_rng(n)
    rows = np.stack([series(rng, n, period) for _ in range(3)])
    cycle, trend = L.decompose(rows, period, window, inner, outer)
    for y, c, t in zip(rows, cycle, trend):
        season, slow = plain(y, period, window, inner, outer)
        assert np.allclose(c, season, atol=1e-6) and np.allclose(t, slow, atol=1e-6)


def test_known_seasonality_is_found():
    t = np.arange(130)
    season = np.tile(np.r_[np.full(12, -1.0), 12.0], 10)
    cycle, trend = L.decompose((50 + 0.3 * t + season)[None], 13, 3, 5, 0)
    assert np.allclose(cycle[0], season, atol=0.1) and np.allclose(trend[0], 50 + 0.3 * t, atol=0.1)


def test_robust_weights_ignore_a_spike():
    t = np.arange(104)
    clean = 50 + 10 * np.sin(2 * np.pi * t / 13)
    spiked = clean.copy()
    spiked[50] += 500
    plain_cycle, _ = L.decompose(spiked[None], 13, 3, 5, 0)
    robust_cycle, _ = L.decompose(spiked[None], 13, 3, 2, 15)
    want, _ = L.decompose(clean[None], 13, 3, 5, 0)
    assert np.abs(robust_cycle - want)[0, 60:].max() < 0.2 * np.abs(plain_cycle - want).max()


def test_frame(spark):
    rng = np.random.default_rng(3)
    rows = []
    for name, n in (("a", 60), ("b", 60), ("c", 45), ("short", 20)):
        rows += [(name, 2 * w, int(v)) for w, v in enumerate(series(rng, n) * 100)]
    rows += [("a", 0, 7), ("a", 2, None), (None, 1, 5)]
    df = spark.createDataFrame(rows, "sub string, week int, spend_cents long")
    found = {}
    for r in L.loess_components(df, "sub").collect():
        found.setdefault(r.sub, {})[r.week] = (r.seasonal, r.trend)
    for name in ("a", "b", "c"):
        own = {}
        for s, w, v in rows:
            if s == name:
                own[w] = own.get(w, 0) + (v or 0)
        weeks = sorted(own)
        season, slow = plain(np.array([own[w] for w in weeks], float), 13, 3, 5, 0)
        assert [found[name][w] for w in weeks] == [(round(s), round(t)) for s, t in zip(season, slow)]
    assert set(found["short"].values()) == {(None, None)} and found[None] == {1: (None, None)}
    assert L.loess_components(df.limit(0), "sub").count() == 0
    flagged = S.seasonal_outliers(L.loess_components(df, "sub").where("seasonal is not null"), "sub")
    assert 0 < flagged.count() < 60
    with pytest.raises(ValueError):
        L.loess_components(df, "sub", seasonal=4)
