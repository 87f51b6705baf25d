import math
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import chunks, decompose, drift, metrics, naive, select, split, stats, trees
from demandspark.operators.lags import add_lags
from tests.conftest import T0, column


def test_split_is_disjoint_and_complete(series):
    df, k = series({"a": range(20), "b": range(3)})
    train, test = split.train_part(df, k, 5), split.test_part(df, k, 5)
    assert column(train) == {"a": [float(i) for i in range(15)]}
    assert column(test) == {"a": [float(i) for i in range(15, 20)], "b": [0.0, 1.0, 2.0]}


def test_seasonal_naive_has_no_error_on_a_pure_pattern(series):
    pattern = [3, 1, 4, 1]
    df, k = series({"a": pattern * 2 + pattern * 2 + pattern[:2]})
    train, test = split.train_part(df, k, 10), split.test_part(df, k, 10)
    row = naive.train_and_score(train, test, k, 4, 10).first()
    assert (row["mae"], row["rmse"], row["mape"], row["n"]) == (0.0, 0.0, 0.0, 10)


def test_seasonal_naive_without_a_season_is_null(series):
    df, k = series({"a": [1, 2]})
    got = column(naive.seasonal_naive(df, k, 4, 4), "yhat")["a"]
    assert got == [None, None, 1.0, 2.0]


def test_mape_skips_zero_actuals(spark, series):
    _, k = series({"a": [1]})
    rows = [("a", T0, 0.0, 1.0), ("a", T0, 2.0, 1.0), ("a", T0, None, 1.0)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double, yhat double")
    row = metrics.forecast_errors(df, k, ["unique_id"]).first()
    assert (row["mape"], row["mape_skipped"], row["n"], row["mae"]) == (0.5, 1, 2, 1.0)


def test_folds_match_a_loop(series):
    df, k = series({"a": range(60), "b": range(17)}, chunk=7)
    got = sorted((r["unique_id"], r["fold"], r["fold_step"], r["y"]) for r in split.rolling_folds(df, k, 10, 8, 4).collect())
    want = sorted((n, o, j + 1, float(o + j)) for n, size in (("a", 60), ("b", 17))
                  for o in range(10, size - 8, 4) for j in range(8))
    assert got == want


def test_prefix_fences_match_a_loop(series):
    rng = np.random.default_rng(4)
    y = [float(v) for v in rng.normal(size=120)]
    df, k = series({"a": y}, chunk=32)
    got = {r["fold"]: (r["lower_bound"], r["upper_bound"]) for r in naive.prefix_fences(df, k, [20, 50, 96]).collect()}
    for n, bounds in got.items():
        v = sorted(y[:n])
        q1, q3 = v[math.floor((n - 1) * 0.25 + 0.5)], v[math.floor((n - 1) * 0.75 + 0.5)]
        assert bounds == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    assert set(got) == {20, 50, 96}


def test_prefix_fences_of_all_origins(series):
    """Series of different lengths, repeated and missing values, origins up to each one's end."""
    rng = np.random.default_rng(5)
    values = {"a": [None if rng.random() < 0.1 else round(float(v), 1) for v in rng.normal(size=330)],
              "b": [float(v) for v in rng.normal(size=61)], "c": [2.0] * 90, "d": [None] * 40, "e": [1.0] * 12}
    df, k = series(values, chunk=32)
    got = {(r["unique_id"], r["fold"]): (r["lower_bound"], r["upper_bound"]) for r in naive.prefix_fences(
        df, k, initial=20, horizon=8, step=4).collect()}
    want = {}
    for name, y in values.items():
        for o in range(20, len(y) - 8, 4):
            v = sorted(x for x in y[:o] if x is not None)
            if v:
                q1, q3 = (v[math.floor((len(v) - 1) * q + 0.5)] for q in (0.25, 0.75))
                want[name, o] = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert got == want


def test_fenced_backtest_reaches_the_end_of_long_series(series):
    """All origins, past row 2,880 too; those of a list are a part of them."""
    y = [float(i % 96) + (500.0 if i % 97 == 0 else 0.0) for i in range(3000)]
    df, k = series({"a": y}, chunk=512)
    rows = [tuple(r) for r in naive.backtest_with_fences(df, k).collect()]
    fold = {r[2] for r in rows}
    assert fold == set(range(96, 2992, 4)) and len(rows) == 8 * len(fold)
    assert any(r[5] is None for r in rows) and any(r[5] is not None for r in rows)
    some = [tuple(r) for r in naive.backtest_with_fences(df, k, [96, 192, 2880]).collect()]
    assert sorted(some, key=repr) == sorted((r for r in rows if r[2] in (96, 192, 2880)), key=repr)


def test_blend_falls_back_to_the_member_present(spark, series):
    _, k = series({"a": [1]})
    rows = [("a", T0, "m1", 1.0), ("a", T0, "m2", 3.0), ("a", T0 + timedelta(minutes=15), "m1", 5.0)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, model string, yhat double")
    assert column(metrics.blend(df, k, ["m1", "m2"], "both"), "yhat")["a"] == [2.0, 5.0]


def test_selection(spark):
    rows = [("mape", 0, 0.1), ("rmse", 0, 4.0), ("candidate.z_mape", 0, 0.4), ("z_rmse", 0, 1.0),
            ("a_mape", 0, 9.0), ("a_mape", 1, 0.4), ("a_rmse", 0, 1.0), ("half_mape", 0, 0.0)]
    named = select.named_metrics(spark.createDataFrame(rows, "name string, step int, value double"))
    scores = select.model_scores(named, spark.createDataFrame([(2.0,), (6.0,)], "y double"), "y")
    got = {r["model"]: r["score"] for r in scores.collect()}
    assert got == pytest.approx({"Baseline_Seasonal_Naive": math.sqrt(0.1), "z": math.sqrt(0.1), "a": math.sqrt(0.1)})
    assert select.best_model(scores).first()["model"] == "Baseline_Seasonal_Naive"
    assert select.best_model(scores.filter("model != 'Baseline_Seasonal_Naive'")).first()["model"] == "a"
    record = select.selection_record(scores).first()
    assert record["model_type"] == "baseline" and len(record["all_compared_models"]) == 3


def test_drift_same_and_shifted(series):
    ref, k = series({"a": range(96 * 2)}, chunk=50)
    same, _ = series({"a": range(96 * 2)})
    other, _ = series({"a": [1000 + i for i in range(96)]})
    new = drift.number_chunks(other, k)
    assert drift.ks_by_chunk(ref, new, k).first()["statistic"] == 1.0
    assert drift.js_by_chunk(ref, new, k).first()["statistic"] == pytest.approx(1.0)
    one = drift.number_chunks(same, k, 192)
    assert drift.ks_by_chunk(ref, one, k).first()["statistic"] == 0.0
    assert drift.js_by_chunk(ref, one, k).first()["statistic"] == pytest.approx(0.0)


def test_drift_report_matches_numpy(series):
    rng = np.random.default_rng(6)
    r, v = rng.normal(size=96 * 8), np.concatenate([rng.normal(size=96), rng.normal(size=96) + 8])
    ref, k = series({"a": r}, chunk=200)
    new, _ = series({"a": v})

    def ks(part):
        at = np.concatenate([r, part])
        return max(abs(np.mean(r <= x) - np.mean(part <= x)) for x in at)

    own = [ks(c) for c in np.split(r, 8)]
    low, high = max(np.mean(own) - 3 * np.std(own), 0), np.mean(own) + 3 * np.std(own)
    rows = {(x["method"], x["part"]): x for x in drift.drift_report(ref, new, k).collect()}
    for part, chunk in enumerate(np.split(v, 2)):
        row = rows[("kolmogorov_smirnov", part)]
        assert (row["statistic"], row["lower_limit"], row["upper_limit"]) == pytest.approx((ks(chunk), low, high))
        assert row["alert"] == (ks(chunk) > high or ks(chunk) < low)
    assert rows[("kolmogorov_smirnov", 1)]["alert"] and rows[("jensen_shannon", 1)]["alert"]


def test_p_values():
    # critical values of the constant-only test: 1 %, 5 %, 10 %
    for tau, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert stats.unit_root_p_value(tau) == pytest.approx(p, abs=0.002)
    assert stats.unit_root_p_value(5.0) == 1.0 and stats.unit_root_p_value(-30.0) == 0.0


def test_unit_root_tests_tell_noise_from_a_walk(series):
    rng = np.random.default_rng(7)
    noise = rng.normal(size=600)
    df, k = series({"noise": noise, "walk": np.cumsum(rng.normal(size=600))}, chunk=100)
    for found in (stats.dickey_fuller(df, k, 6), stats.phillips_perron(df, k, 12)):
        got = {r["unique_id"]: r["is_stationary"] for r in found.collect()}
        assert got == {"noise": True, "walk": False}


def test_dickey_fuller_statistic_is_the_regression(series):
    rng = np.random.default_rng(8)
    y = np.cumsum(rng.normal(size=200)) * 0.5 + rng.normal(size=200)
    df, k = series({"a": y}, chunk=37)
    row = stats.dickey_fuller(df, k, 0).first()
    d, x = np.diff(y), np.column_stack([np.ones(199), y[:-1]])
    beta, rss = np.linalg.lstsq(x, d, rcond=None)[:2]
    se = math.sqrt(rss[0] / (199 - 2) * np.linalg.inv(x.T @ x)[1, 1])
    assert row["statistic"] == pytest.approx(beta[1] / se) and row["n"] == 199


def test_boxcox_of_lognormal_is_near_zero(series):
    df, k = series({"a": np.exp(np.random.default_rng(9).normal(size=3000))})
    assert abs(stats.boxcox_lambda(df, k).first()["best_lambda"]) < 0.06


def test_decomposition_of_a_known_sum(series):
    n, p = 400, 8
    season = np.array([3, 1, -2, 0, 4, -1, -3, -2.0])
    df, k = series({"a": 0.1 * np.arange(n) + season[np.arange(n) % p]}, chunk=64)
    rows = sorted(decompose.seasonal_decompose(df, k, [p]).collect(), key=lambda r: r["ds"])
    inner = rows[50:-50]
    assert max(abs(r["remainder"]) for r in inner) < 0.3
    assert all(abs(r["trend"] + r["seasonal_8"] + r["remainder"] - r["y"]) < 1e-9 for r in rows)


@pytest.fixture(scope="module")
def daily_pattern():
    rng = np.random.default_rng(11)
    i = np.arange(96 * 16)
    return 100 + 30 * np.sin(2 * np.pi * i / 96) + 5 * np.cos(2 * np.pi * i / 672) + rng.normal(size=len(i))


@pytest.mark.parametrize("variant", trees.VARIANTS)
def test_variants_beat_the_mean(series, daily_pattern, variant):
    df, k = series({"a": daily_pattern, "b": daily_pattern[:700]}, chunk=700)
    train, test = split.train_part(df, k, 96), split.test_part(df, k, 96)
    prepared, future = trees.prepare_training(train, k), trees.prepare_test(test, k)
    params = trees.TreeParams(trees=8, learning_rate=0.3, depth=4)
    model = trees.fit_variant(prepared, k, variant, params)
    got = column(trees.evaluate([model], future, prepared, k), "yhat")
    assert len(got["a"]) == 96 and np.mean(np.abs(np.array(got["a"]) - daily_pattern[-96:])) < 8
    if variant != "stable":  # too short a history for the lags
        assert got["b"] == [None] * 96


def plain_block_forecast(model, y, exog, horizon):
    """Slot by slot in one series: lags of a season or more are known, the others stay as at the block's start."""
    from pyspark.ml.linalg import Vectors

    y, made = list(y), []
    for h in range(horizon):
        n = len(y)
        if h % 96 == 0:
            z = np.array(y[96:]) - np.array(y[:-96])
            mean = z[0]
            for v in z[1:]:
                mean = 0.5 * v + 0.5 * mean
            start = {"lag_1": z[-1], "lag1_mean4": z[-4:].mean(), "lag1_ewm": mean}
        z = np.array(y[96:]) - np.array(y[:-96])
        at = len(z) - 96  # one season back, as the list has grown by the predicted slots
        row = {**start, "lag_96": z[at], "lag_97": z[at - 1], "lag_672": z[len(z) - 672], "lag96_mean4": z[at - 3:at + 1].mean(),
               "lag96_std8": z[at - 7:at + 1].std(ddof=1), "block_step": h % 96 + 1, **exog[h]}
        x = Vectors.dense([float(row[f]) for f in model.features])
        step = np.mean([m.predict(x) for m in model.members.values()])
        made.append(step + y[n - 96])
        y.append(made[-1])
    return made


@pytest.mark.parametrize("variant,horizon", [("anchored", 230), ("ensemble", 100)])
def test_blocks_equal_a_loop_over_slots(series, daily_pattern, variant, horizon):
    df, k = series({"a": daily_pattern, "b": 3 * daily_pattern[200:]}, chunk=700)
    whole = trees.prepare_training(df, k)
    history, future = split.train_part(whole, k, horizon), split.test_part(whole, k, horizon)
    model = trees.fit_variant(history, k, variant, trees.TreeParams(trees=5, learning_rate=0.3, depth=3))
    got = column(model.predict(future, history), "yhat")
    scale = {r["unique_id"]: r for r in model.scale.collect()}
    known = [f for f in model.features if f not in trees.BLOCK_FEATURES]
    for name in ("a", "b"):
        level, spread = scale[name]["_level"], scale[name]["_spread"]
        past = (np.array(column(history)[name]) - level) / spread
        rows = sorted(future.filter(F.col("unique_id") == name).collect(), key=lambda r: r["ds"])
        exog = [{f: float(r[f]) for f in known} for r in rows]
        want = np.array(plain_block_forecast(model, past, exog, horizon)) * spread + level
        assert got[name] == pytest.approx(list(want), rel=1e-9)


def test_block_forecast_has_no_python_in_its_plan(series, daily_pattern):
    df, k = series({"a": daily_pattern}, chunk=700)
    history = trees.prepare_training(df, k)
    model = trees.fit_variant(history, k, "anchored", trees.TreeParams(trees=2, depth=2))
    known = trees.stage(trees.scaled(history, model.scale, k).select(*k.key, "y").withColumn("_k", F.lit(-1).cast("bigint")))
    plan = trees._state(known, k)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_training_sees_what_a_forecast_sees(series, daily_pattern):
    """The last block of the training frame has the features that a forecast of it would use."""
    df, k = series({"a": daily_pattern}, chunk=700)
    rows = sorted(trees.block_frame(trees.prepare_training(df, k), k).collect(), key=lambda r: r["ds"])[-96:]
    z = np.array(daily_pattern[96:]) - np.array(daily_pattern[:-96])
    assert [r["block_step"] for r in rows] == list(range(1, 97))
    assert [r["lag_1"] for r in rows] == pytest.approx([z[-97]] * 96)
    assert [r["lag1_mean4"] for r in rows] == pytest.approx([z[-100:-96].mean()] * 96)
    assert [r["lag_96"] for r in rows] == pytest.approx(list(z[-192:-96]))


def test_series_keep_their_own_level(series):
    wave = 1 + 0.1 * np.sin(2 * np.pi * np.arange(96 * 6) / 96)
    df, k = series({"low": 10 * wave, "high": 1000 * wave}, chunk=700)
    prepared = trees.prepare_training(split.train_part(df, k, 96), k)
    model = trees.fit_variant(prepared, k, "stable", trees.TreeParams(trees=8, learning_rate=0.3, depth=4))
    got = column(model.predict_ahead(prepared, 96), "yhat")
    assert np.abs(np.array(got["low"]) - 10 * wave[-96:]).mean() < 0.3
    assert np.abs(np.array(got["high"]) - 1000 * wave[-96:]).mean() < 30


def test_a_future_that_starts_late_keeps_its_phase_and_a_model_can_be_loaded(spark, series, daily_pattern):
    from demandspark.sources.tables import shared_dir

    df, k = series({"a": daily_pattern}, chunk=700)
    whole = trees.prepare_training(df, k)
    history, future = split.train_part(whole, k, 120), split.test_part(whole, k, 96)
    model = trees.fit_variant(history, k, "anchored", trees.TreeParams(trees=4, learning_rate=0.3, depth=3))
    got = column(model.predict(future, history), "yhat")["a"]
    assert len(got) == 96 and np.mean(np.abs(np.array(got) - daily_pattern[-96:])) < 15
    path = shared_dir(spark, "model")
    model.save(path)
    again = trees.Forecaster.load(spark, path)
    assert column(again.predict(future, history), "yhat")["a"] == pytest.approx(got)


def test_all_candidates_in_one_table(series, daily_pattern):
    df, k = series({"a": daily_pattern, "b": 50 + daily_pattern[300:]}, chunk=700)
    train, test = split.train_part(df, k, 96), split.test_part(df, k, 96)
    prepared, future = trees.prepare_training(train, k), trees.prepare_test(test, k)
    models = trees.fit_variants(prepared, k, ["stable", "anchored"], trees.TreeParams(trees=4, learning_rate=0.3, depth=3))
    found = trees.candidate_predictions(models, future, prepared, k)
    values = {}
    for r in found.collect():
        values.setdefault((r["unique_id"], r["ds"]), {})[r["model"]] = r["yhat"]
    assert len(values) == 192
    for v in values.values():
        assert set(v) == {"stable", "anchored", "blend", select.BASELINE_NAME}
        assert v["blend"] == pytest.approx((v["stable"] + v["anchored"]) / 2)
    table = {r["model"]: r for r in select.compare_models(found, test, k).collect()}
    assert [r["is_best"] for r in table.values()].count(True) == 1
    best = min(table.values(), key=lambda r: (r["score"], r["model"]))
    assert best["is_best"] and best["score"] == pytest.approx(math.sqrt(best["mape"] * best["nrmse"]))
    for r in select.compare_models(found, test, k, ["unique_id"]).collect():
        y = np.array(column(test)[r["unique_id"]])
        yhat = np.array([values[key][r["model"]] for key in sorted(values) if key[0] == r["unique_id"]])
        assert r["mae"] == pytest.approx(np.abs(y - yhat).mean()) and r["nrmse"] == pytest.approx(math.sqrt(((y - yhat) ** 2).mean()) / y.mean())


def test_search_is_seeded_and_within_range(series, daily_pattern):
    draws = trees.draw_params(5, seed=1)
    assert draws == trees.draw_params(5, seed=1) != trees.draw_params(5, seed=2)
    assert all(400 <= p.trees <= 2000 and 0.005 <= p.learning_rate <= 0.08 for p in draws)
    df, k = series({"a": daily_pattern[:500]}, chunk=700)
    ranges = {**trees.SEARCH_RANGES, "trees": (2, 4, "int"), "depth": (2, 3, "int")}
    best, score = trees.search(trees.prepare_training(df, k), k, "stable", 2, 48, ranges=ranges)
    assert best in trees.draw_params(2, ranges=ranges) and 0 < score < 1


def test_training_rows_are_spread_by_their_number(spark, series, monkeypatch):
    """A fit over many rows that came in one task runs on several; few rows stay as they are."""
    rows = spark.range(0, 100, 1, 1).select((F.col("id") * 1.0).alias("x"))
    assert chunks.spread(rows, 100) is rows
    monkeypatch.setattr(chunks, "ROWS_EACH", 30)
    wide = chunks.spread(rows, 100)
    assert wide.rdd.getNumPartitions() == 4 and sorted(r["x"] for r in wide.collect()) == list(range(100))
    seen, fit = [], trees.GBTRegressor.fit
    monkeypatch.setattr(trees.GBTRegressor, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    df, k = series({"a": [float(i % 96) for i in range(200)]})
    trees.fit_variant(trees.prepare_training(df, k), k, "stable", trees.TreeParams(trees=1, depth=2))
    assert seen[0] >= 200 // 30


def test_few_training_rows_are_on_few_tasks_and_without_their_lineage(spark, series, monkeypatch):
    """Jobs of a fit have neither as many tasks as the session shuffles to, nor the windows behind the rows."""
    rows = spark.range(0, 100, 1, 16).select((F.col("id") * 1.0).alias("x"))
    few = chunks.spread(rows, 100)
    assert few.rdd.getNumPartitions() == 1 and sorted(r["x"] for r in few.collect()) == list(range(100))
    seen, fit = [], trees.GBTRegressor.fit
    monkeypatch.setattr(trees.GBTRegressor, "fit", lambda self, df: seen.append(df) or fit(self, df))
    df, k = series({"a": [float(i % 7) for i in range(1100)], "b": [float(i % 5) for i in range(1100)]}, chunk=256)
    trees.fit_variant(trees.prepare_training(df, k), k, "anchored", trees.TreeParams(trees=1, depth=2))
    lineage = seen[0].rdd.toDebugString().decode()
    assert seen[0].rdd.getNumPartitions() == 1 and "ReliableCheckpointRDD" in lineage and "ShuffledRowRDD" not in lineage
