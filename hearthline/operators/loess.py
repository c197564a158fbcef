"""Seasonal and trend components by repeated local regression.

A series is taken apart by smoothing the values of each phase of the period, removing
what is left of the trend from them by moving means and a local regression, and
smoothing the rest as trend; a few rounds of this settle. Rounds of robustness
weights may follow, which count values far from both components less.

Every smoothing is a local linear regression with tricube weights, computed from
weighted sums over a window. Kernels depend on positions only, so the sums of all
series of one length are a few matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Positions of a series; one task holds a batch of series.
LONGEST = 5_000


def window(x: float, n: int, q: int) -> tuple[int, int, float]:
    """First and last of the ``q`` points nearest to ``x`` among 1 to ``n``, and the reach of the weights."""
    if q >= n:
        first, last = 1, n
    else:
        first = max(1, min(int(x) - (q + 1) // 2 + 1, n - q + 1))
        last = first + q - 1
    reach = max(x - first, last - x)
    return first, last, reach + (q - n) // 2 if q > n else reach


def kernel(targets: np.ndarray, n: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Tricube weights of points 1 to ``n`` for each target, and the points' distances from it."""
    places = np.arange(1, n + 1)
    away = places[None, :] - targets[:, None]
    weights = np.zeros(away.shape)
    for row, gap, x in zip(weights, away, targets):
        first, last, reach = window(x, n, q)
        far = np.abs(gap[first - 1:last])
        if reach > 0:
            inner = np.where(far <= 0.001 * reach, 1.0, (1 - (far / reach) ** 3) ** 3)
            row[first - 1:last] = np.where(far <= 0.999 * reach, inner, 0.0)
        else:
            row[first - 1:last] = 1.0
    return weights, away


def smooth(values: np.ndarray, trust: np.ndarray | None, targets: np.ndarray, q: int) -> np.ndarray:
    """Local linear regression of each row of ``values`` at ``targets``; NaN where all weights are zero."""
    n = values.shape[1]
    weights, away = kernel(targets, n, q)
    trust = np.ones_like(values) if trust is None else trust
    total = trust @ weights.T
    with np.errstate(invalid="ignore", divide="ignore"):
        centre = trust @ (weights * away).T / total
        spread = trust @ (weights * away ** 2).T / total - centre ** 2
        mean = (trust * values) @ weights.T / total
        together = (trust * values) @ (weights * away).T / total - centre * mean
        line = np.sqrt(np.maximum(spread, 0)) > 0.001 * max(n - 1, 1)
        return np.where(line, mean - centre * together / np.where(line, spread, 1), mean)


def moving_mean(values: np.ndarray, width: int) -> np.ndarray:
    sums = np.cumsum(np.concatenate([np.zeros((len(values), 1)), values], axis=1), axis=1)
    return (sums[:, width:] - sums[:, :-width]) / width


def odd_from(x: float) -> int:
    """The smallest odd number that is not below ``x``."""
    n = int(np.ceil(x))
    return n + (n % 2 == 0)


def decompose(values: np.ndarray, period: int, seasonal: int, inner: int, outer: int) -> tuple[np.ndarray, np.ndarray]:
    """Seasonal and trend component of each row; rows have the same length of at least two periods."""
    m, n = values.shape
    trend_width = odd_from(1.5 * period / (1 - 1.5 / seasonal))
    low_width = odd_from(period + 1)
    trend, cycle, trust = np.zeros((m, n)), np.zeros((m, n)), None
    places = np.arange(1, n + 1, dtype=float)
    for k in range(outer + 1):
        for _ in range(inner):
            rest = values - trend
            wide = np.empty((m, n + 2 * period))
            for phase in range(period):
                own = rest[:, phase::period]
                size = own.shape[1]
                near = None if trust is None else trust[:, phase::period]
                found = smooth(own, near, np.arange(0, size + 2, dtype=float), seasonal)
                # Where all weights are zero the value stays, and the ends repeat their neighbour.
                inside = np.where(np.isnan(found[:, 1:-1]), own, found[:, 1:-1])
                ends = [np.where(np.isnan(found[:, e]), inside[:, i], found[:, e]) for e, i in ((0, 0), (-1, -1))]
                wide[:, phase::period] = np.concatenate([ends[0][:, None], inside, ends[1][:, None]], axis=1)
            low = moving_mean(moving_mean(moving_mean(wide, period), period), 3)
            low = smooth(low, None, places, low_width)
            cycle = wide[:, period:period + n] - low
            rest = values - cycle
            found = smooth(rest, trust, places, trend_width)
            trend = np.where(np.isnan(found), rest, found)
        if k < outer:
            gap = np.abs(values - trend - cycle)
            limit = 6 * np.median(gap, axis=1, keepdims=True)
            with np.errstate(invalid="ignore", divide="ignore"):
                inner_weight = np.where(gap <= 0.001 * limit, 1.0, (1 - (gap / limit) ** 2) ** 2)
            trust = np.where(gap <= 0.999 * limit, inner_weight, 0.0)
    return cycle, trend


def loess_components(history: DataFrame, category: str, value: str = "spend_cents", week: str = "week", period: int = 13,
                     seasonal: int = 3, robust: bool = False) -> DataFrame:
    """``category, week, seasonal, trend`` of every series, in whole units of ``value``.

    A series is its rows in order of the week, one value per week (values of a week are added
    up, nulls count as zero); missing weeks are not filled in. Series of less than two periods have null components. A series
    has at most ``LONGEST`` weeks, or the job ends in an error.
    """
    if seasonal < 3 or seasonal % 2 == 0 or period < 2:
        raise ValueError("the seasonal window is an odd number of at least 3, the period at least 2")
    inner, outer = (2, 15) if robust else (5, 0)
    weekly = history.groupBy(category, week).agg(F.sum(F.coalesce(F.col(value).cast("double"), F.lit(0.0))).alias("_y"))
    rows = weekly.groupBy(category).agg(F.sort_array(F.collect_list(F.struct(week, "_y"))).alias("_r")).select(
        category, F.col(f"_r.{week}").alias("weeks"), F.col("_r._y").alias("values"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.array(v) for v in batch.column("values").to_pylist()]
            lengths = np.array([len(v) for v in values], np.int64)
            if lengths.max(initial=0) > LONGEST:
                raise ValueError(f"a series of {lengths.max()} weeks; at most {LONGEST}")
            found: list[tuple] = [(None, None)] * len(values)
            for n in np.unique(lengths[lengths >= 2 * period]).tolist():
                own = np.flatnonzero(lengths == n)
                cycle, trend = decompose(np.stack([values[i] for i in own]), period, seasonal, inner, outer)
                for i, c, t in zip(own.tolist(), cycle, trend):
                    found[i] = c, t
            parts = [pa.array([None if f[k] is None else np.rint(f[k]).astype(np.int64) for f in found], pa.list_(pa.int64()))
                     for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(category), batch.column("weeks"), *parts],
                                             [category, "weeks", "cycle", "trend"])

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([rows.schema[category], rows.schema["weeks"], T.StructField("cycle", longs), T.StructField("trend", longs)])
    at = F.posexplode("weeks").alias("_i", week)
    return rows.mapInArrow(task, schema).select(category, "cycle", "trend", at).select(
        category, week, F.col("cycle")[F.col("_i")].alias("seasonal"), F.col("trend")[F.col("_i")].alias("trend"))
