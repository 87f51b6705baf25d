from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandspark.operators import fill, outliers, profile, quantiles, rolling
from demandspark.operators.impute import ImputeConfig, impute_series, model_impute
from demandspark.operators.spine import insert_missing
from tests.conftest import T0, column


def test_interpolate(series):
    df, k = series({"a": [None, 1, None, None, 4, None]})
    assert column(fill.interpolate(df, k))["a"] == [None, 1.0, 2.0, 3.0, 4.0, None]


def test_fill_both_and_all_null(series):
    df, k = series({"a": [None, None, 5, None, 7, None] + [None] * 9 + [1], "b": [None, None, None]})
    got = column(fill.fill_both(df, k))
    assert got["a"] == [5.0, 5.0, 5.0, 5.0, 7.0] + [7.0] * 10 + [1.0]
    assert got["b"] == [None] * 3


def test_centred_even_window_leans_back(series):
    df, k = series({"a": [1, 2, 3, 4, 5, 6]})
    got = column(rolling.rolling_trend(df, k, 4), "macro_trend")["a"]
    assert got == pytest.approx([1.5, 2.0, 2.5, 3.5, 4.5, 5.0])


@pytest.mark.parametrize("window", [9, 80])
def test_trailing_std_needs_a_full_window(series, window):
    rng = np.random.default_rng(0)
    y = rng.normal(size=200)
    values = [None if i == 150 else float(v) for i, v in enumerate(y)]
    df, k = series({"a": values}, chunk=64)
    got = np.array(column(rolling.rolling_volatility(df, k, window), "rolling_volatility")["a"], dtype=float)
    want = pd.Series([np.nan if v is None else v for v in values]).rolling(window).std().to_numpy()
    assert np.allclose(got, want, equal_nan=True)


def test_ewm_is_the_recursion(series):
    y = [float(v) for v in np.random.default_rng(1).normal(size=90)]
    df, k = series({"a": y}, chunk=16)
    want, e = [], y[0]
    for i, v in enumerate(y):
        e = v if i == 0 else 0.5 * v + 0.5 * e
        want.append(e)
    assert column(rolling.add_ewm(df, k, 0.5, "e"), "e")["a"] == pytest.approx(want, abs=1e-12)


def test_fences(series):
    df, k = series({"a": [1, 2, 3, 4, 5, 6, 7, 8, 9, 100], "b": [None, None]})
    got = column(outliers.null_outliers(df, k))
    assert got["a"] == [float(i) for i in range(1, 10)] + [None]
    assert got["b"] == [None, None]


def test_value_on_the_fence_is_kept(series):
    # quartiles 2 and 4: the fence is -1..7
    df, k = series({"a": [1, 2, 3, 4, 7]})
    assert column(outliers.null_outliers(df, k))["a"][-1] == 7.0


def order_statistic(values, q, mode):
    v = np.sort(np.array(values, dtype=float))
    n = len(v)
    if mode == "nearest":
        return v[int(np.floor((n - 1) * q + 0.5))]
    if mode == "disc":
        return v[max(int(np.ceil(n * q)) - 1, 0)]
    return float(np.quantile(v, q))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300))
def test_quantiles_match_sorting(spark, values):
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("a", None)], "g string, v double")
    for mode in ("nearest", "disc", "linear"):
        got = {r["q"]: r["value"] for r in quantiles.exact_quantiles(df, ["g"], "v", [0.0, 0.25, 0.9, 1.0], mode).collect()}
        assert got == pytest.approx({q: order_statistic(values, q, mode) for q in got}) and len(got) == 4


def test_quantiles_with_a_heavy_value(spark):
    """A third of the rows hold one value, the rest are skewed."""
    rng = np.random.default_rng(2)
    v = np.concatenate([np.full(4000, 1.0), np.exp(rng.normal(size=8000) * 3)])
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "v": v}))
    got = {r["q"]: r["value"] for r in quantiles.exact_quantiles(df, ["g"], "v", [0.1, 0.4, 0.5, 0.99], "linear").collect()}
    assert got == pytest.approx({q: float(np.quantile(v, q)) for q in got})


def test_cumulative_counts(spark):
    ref = spark.createDataFrame([("a", float(x)) for x in (1, 2, 2, 3)], "g string, v double")
    pts = spark.createDataFrame([("a", float(x)) for x in (0, 2, 2.5, 9)], "g string, v double")
    rows = sorted(quantiles.cumulative_counts(ref, pts, ["g"], "v").collect(), key=lambda r: r["v"])
    assert [(r["v"], r["at_or_below"], r["below"], r["n_reference"]) for r in rows] == [
        (0.0, 0, 0, 4), (2.0, 3, 1, 4), (2.5, 3, 3, 4), (9.0, 4, 4, 4)]


def test_box_summary(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (1, 2, 3, 4, 100)], "h int, v double")
    row = profile.box_summary(df, ["h"], "v").first()
    assert (row["q1"], row["med"], row["q3"], row["whisker_high"], row["outliers"]) == (2.0, 3.0, 4.0, 4.0, 1)


def test_flags(series):
    df, k = series({"a": [1, None, 3]})
    flagged = fill.mark_flag(df.withColumn("is_imputed", F.when(F.col("y").isNull(), True)), k, [T0])
    assert column(flagged, "is_imputed")["a"] == [True, True, False]
    bad = df.select("unique_id", "ds").filter(F.col("ds") == F.lit(T0).cast("timestamp_ntz"))
    assert column(fill.null_at_table(df, k, bad))["a"] == column(fill.null_at(df, k, [T0]))["a"] == [None, None, 3.0]


def test_seasonal_median_keeps_known_values(series):
    y = [float(10 + i % 96) for i in range(96 * 21)]
    holes = {500, 501, 1200}
    df, k = series({"a": {i: v for i, v in enumerate(y) if i not in holes}}, chunk=512)
    rows = sorted(fill.seasonal_median_impute(df, k).collect(), key=lambda r: r["ds"])
    assert all(r["y_filled"] == r["y"] for r in rows if not r["is_imputed"])
    assert {i for i, r in enumerate(rows) if r["is_imputed"]} == holes
    assert max(abs(rows[i]["y_filled"] - y[i]) for i in holes) < 5


def test_model_impute(series):
    y = [50 + 20 * np.sin(2 * np.pi * i / 96) for i in range(96 * 12)]
    values = {i: (None if i % 53 == 7 else v) for i, v in enumerate(y)}
    values[300] = 9999.0
    df, k = series({"a": values}, chunk=512)
    got = impute_series(insert_missing(df, k), k, ImputeConfig(trees=8, learning_rate=0.3))
    rows = sorted(got.collect(), key=lambda r: r["ds"])
    assert len(rows) == len(y) and all(r["y"] is not None for r in rows)
    filled = {i for i, r in enumerate(rows) if r["is_imputed"]}
    assert filled == {i for i in values if i % 53 == 7} | {300}
    assert all(r["y"] == values[i] for i, r in enumerate(rows) if i not in filled)
    assert np.mean([abs(rows[i]["y"] - y[i]) for i in filled]) < 6


def test_model_impute_without_anything_to_do(series):
    df, k = series({"a": [1, 2, 3]})
    cfg = ImputeConfig(features=("y2",))
    full = df.withColumn("y2", F.col("y"))
    assert column(model_impute(full, k, cfg), "is_imputed")["a"] == [False] * 3
    empty = full.withColumn("y", F.lit(None).cast("double"))
    assert column(model_impute(empty, k, cfg), "y")["a"] == [None] * 3


def test_repair_makes_a_grid(series):
    df, k = series({"a": {0: None, 1: 2, 4: 5, 6: None}})
    rows = sorted(fill.repair(df, k).collect(), key=lambda r: r["ds"])
    assert [r["y"] for r in rows] == [2.0, 2.0, 2.0, 5.0]
    assert rows[0]["ds"] == T0 + timedelta(minutes=15)
