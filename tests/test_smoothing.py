"""Exponential means, local regression and decomposition against plain loops."""

import math
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import loess, rolling
from tests.conftest import T0, column


# --- exponential mean ---

def ewm(y, alpha):
    out = [float(y[0])]
    for v in y[1:]:
        out.append(alpha * v + (1 - alpha) * out[-1])
    return out


@pytest.mark.parametrize("alpha", [1.0, 0.999999, 0.9, 0.5, 0.05, 0.003, 1e-6])
@pytest.mark.parametrize("chunk", [8, 64, 5000])
def test_exponential_mean_is_the_recursion(series, alpha, chunk):
    rng = np.random.default_rng(1)
    values = {"a": 1e6 + rng.normal(size=1500), "b": [5.0], "c": np.concatenate([[1e12], rng.normal(size=300)]), "d": rng.normal(size=40)}
    df, k = series(values, chunk=chunk)
    got = column(rolling.add_ewm(df, k, alpha, "e"), "e")
    for name, y in values.items():
        assert got[name] == pytest.approx(ewm(list(y), alpha), rel=1e-9, abs=1e-9)


def test_exponential_mean_collects_nothing(series):
    df, k = series({"a": range(100)}, chunk=16)
    plan = rolling.add_ewm(df, k, 0.01, "e")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan


def test_exponential_mean_keeps_null_ids_and_rejects_bad_weights(spark, series):
    _, k = series({"a": [1]})
    rows = [(None, T0 + timedelta(minutes=15 * i), float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")
    got = [r["e"] for r in sorted(rolling.add_ewm(df, k, 0.3, "e").collect(), key=lambda r: r["ds"])]
    assert got == pytest.approx(ewm(range(50), 0.3))
    for alpha in (0, -1, 1.5):
        with pytest.raises(ValueError):
            rolling.add_ewm(df, k, alpha, "e")


# --- local regression ---

def plain_point(t, v, at, window, weight=None):
    """The local line at one place; ``t`` are all places, null values do not count."""
    lo, hi = t[0], t[-1]
    half = (window - 1) // 2
    start = min(max(at - half, lo), max(hi - (window - 1), lo))
    stop = min(start + window - 1, hi)
    reach = max(at - start, stop - at) + max(window - (hi - lo + 1), 0) // 2
    sums = []
    for i, (x, y) in enumerate(zip(t, v)):
        if start <= x <= stop and y is not None and not math.isnan(y):
            s = abs(x - at) / reach if reach else 0
            w = 1.0 if s <= 0.001 else (1 - s**3) ** 3 if s <= 0.999 else 0.0
            sums.append((w * (1 if weight is None else weight[i]), x - at, y))
    w = np.array([s[0] for s in sums])
    if not w.sum():
        return math.nan
    x, y = np.array([s[1] for s in sums], float), np.array([s[2] for s in sums], float)
    mx, my = (w * x).sum() / w.sum(), (w * y).sum() / w.sum()
    c = (w * x * x).sum() / w.sum() - mx * mx
    if math.sqrt(max(c, 0)) <= (hi - lo) * 0.001:
        return my
    return my - mx * ((w * x * y).sum() / w.sum() - mx * my) / c


def plain_loess(t, v, window, jump=1, weight=None, ahead=0):
    points = {p: plain_point(t, v, p, window, weight)
              for p in range((t[0] - ahead) // jump * jump, -(-(t[-1] + ahead) // jump) * jump + 1, jump)}
    if ahead:
        return points
    out = []
    for x in t:
        p = x // jump * jump
        out.append(points[p] if x == p else points[p] + (points[p + jump] - points[p]) * ((x - p) / jump))
    return out


@pytest.mark.parametrize("window,jump", [(5, 1), (21, 1), (21, 7), (301, 30), (3, 1), (4, 2)])
def test_local_lines_match_a_loop(series, window, jump):
    rng = np.random.default_rng(window)
    values = {"a": list(rng.normal(size=160)), "b": [3.0, 4.0], "c": [1.0], "d": [None if i % 5 == 2 else float(i * i) for i in range(60)]}
    df, k = series(values, chunk=16)
    got = column(loess.loess(df, k, window, jump=jump), "smooth")
    first = int((T0 - T0.replace(1970, 1, 1)).total_seconds()) // 900
    for name, y in values.items():
        want = plain_loess([first + i for i in range(len(y))], y, window, jump)
        for g, w in zip(got[name], want):
            assert (g is None and math.isnan(w)) or g == pytest.approx(w, rel=1e-9, abs=1e-8), name


def test_a_line_stays_a_line_and_weights_count(series):
    df, k = series({"a": [2.0 * i + 1 for i in range(80)]}, chunk=16)
    assert column(loess.loess(df, k, 31, jump=5), "smooth")["a"] == pytest.approx([2.0 * i + 1 for i in range(80)])
    spiked = df.withColumn("y", F.when(F.col("y") == 81, 1e6).otherwise(F.col("y"))).withColumn("w", (F.col("y") < 1e5).cast("double"))
    assert column(loess.loess(spiked, k, 31, weight="w"), "smooth")["a"] == pytest.approx([2.0 * i + 1 for i in range(80)])


# --- decomposition ---

def mean_frame(v, before, after):
    return [None if i < before or i + after >= len(v) or any(x is None for x in v[i - before:i + after + 1])
            else sum(v[i - before:i + after + 1]) / (before + after + 1) for i in range(len(v))]


def plain_stl(t, y, period, seasonal, inner=2, robust=0):
    trend_window = loess.odd(1.5 * period / (1 - 1.5 / seasonal))
    jump = max(1, trend_window // 10)
    trend, weight, half = [0.0] * len(y), None, period // 2
    for outer in range(robust + 1):
        for _ in range(inner):
            cycle = {}
            for phase in range(period):
                at = [i for i, x in enumerate(t) if x % period == phase]
                points = plain_loess([t[i] // period for i in at], [y[i] - trend[i] for i in at], seasonal, 1,
                                     None if weight is None else [weight[i] for i in at], 1)
                cycle |= {c * period + phase: f for c, f in points.items()}
            slots = [s for s in range(t[0] - period, t[-1] + period + 1)]
            c = [cycle[s] for s in slots]
            level = mean_frame(mean_frame(mean_frame(c, half, period - 1 - half), period - 1 - half, half), 1, 1)
            inside = level[period:-period]
            low = plain_loess(t, inside, loess.odd(period), max(1, period // 10))
            season = [cycle[x] - w for x, w in zip(t, low)]
            trend = plain_loess(t, [a - b for a, b in zip(y, season)], trend_window, jump, weight)
        if outer < robust:
            size = np.abs([a - b - c for a, b, c in zip(y, season, trend)])
            u = size / (6 * np.median(size))
            weight = list(np.where(u <= 0.001, 1.0, np.where(u <= 0.999, (1 - u * u) ** 2, 0.0)))
    return season, trend


def plain_mstl(t, y, periods, windows, rounds=2, inner=2, robust=0):
    seasons = {p: [0.0] * len(y) for p in periods}
    for _ in range(rounds if len(periods) > 1 else 1):
        for p, w in zip(periods, windows):
            rest = [v - sum(seasons[q][i] for q in periods if q != p) for i, v in enumerate(y)]
            seasons[p], trend = plain_stl(t, rest, p, w, inner, robust)
    return seasons, trend


@pytest.fixture(scope="module")
def mixed():
    rng = np.random.default_rng(9)
    i = np.arange(200)
    return 0.02 * i + 3 * np.sin(2 * np.pi * i / 6) + 2 * np.cos(2 * np.pi * i / 21) + rng.normal(size=len(i)) * 0.3


@pytest.mark.parametrize("periods,windows,rounds,inner,robust", [([6], [7], 1, 1, 0), ([6, 21], [7, 11], 2, 1, 0), ([7], [7], 1, 1, 1)])
def test_decomposition_matches_a_plain_one(series, mixed, periods, windows, rounds, inner, robust):
    y = mixed.copy()
    y[50] += 40
    df, k = series({"a": y}, chunk=64)
    got = sorted(loess.loess_decompose(df, k, periods, windows, rounds, inner, robust).collect(), key=lambda r: r["ds"])
    first = int((T0 - T0.replace(1970, 1, 1)).total_seconds()) // 900
    seasons, trend = plain_mstl([first + j for j in range(len(y))], list(y), periods, windows, rounds, inner, robust)
    assert [r["trend"] for r in got] == pytest.approx(trend, abs=1e-7)
    for p in periods:
        assert [r[f"seasonal_{p}"] for r in got] == pytest.approx(seasons[p], abs=1e-7)
    for r in got:
        assert r["trend"] + sum(r[f"seasonal_{p}"] for p in periods) + r["remainder"] == pytest.approx(r["y"])


def test_seasons_are_found_and_forecast(series, mixed):
    df, k = series({"a": mixed, "short": mixed[:9]}, chunk=64)
    parts = loess.loess_decompose(df, k, [6, 21, 5000], rounds=1, inner=1)
    rows = sorted(parts.filter("unique_id = 'a'").collect(), key=lambda r: r["ds"])
    i = np.arange(200)
    assert np.abs(np.array([r["seasonal_6"] for r in rows]) - 3 * np.sin(2 * np.pi * i / 6))[20:-20].max() < 0.6
    assert {r["seasonal_5000"] for r in rows} == {0.0}
    short = parts.filter("unique_id = 'short'").collect()
    assert len(short) == 9 and {r["seasonal_6"] for r in short} == {0.0} and all(r["trend"] is not None for r in short)
    ahead = sorted(loess.loess_forecast(parts, k, [6, 21, 5000], 12).filter("unique_id = 'a'").collect(), key=lambda r: r["ds"])
    j = 200 + np.arange(12)
    truth = 0.02 * j + 3 * np.sin(2 * np.pi * j / 6) + 2 * np.cos(2 * np.pi * j / 21)
    assert np.abs([r["yhat"] - v for r, v in zip(ahead, truth)]).max() < 2
    assert all(r["yhat_low"] < r["yhat"] < r["yhat_high"] for r in ahead)
