"""A series without a name is a series: every operator gives it what it gives the same series under a name."""

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators import decompose, drift, fill, loess, metrics, naive, outliers, quantiles, rolling, select, split, stats, trees
from demandspark.operators.spine import future_frame
from tests.conftest import T0

K = SeriesKeys(step=900, chunk=64)
SCHEMA = "unique_id string, ds timestamp_ntz, y double"


@pytest.fixture(scope="module")
def twins(spark):
    rng = np.random.default_rng(2)
    y = [float(v) for v in 50 + 10 * np.sin(np.arange(400) / 4) + rng.normal(size=400)]
    y[30], y[77] = 999.0, -999.0
    rows = [(name, T0 + timedelta(minutes=15 * i), v) for name in (None, "a") for i, v in enumerate(y)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


OPERATORS = {
    "seasonal_naive": lambda d: naive.seasonal_naive(split.train_part(d, K, 20), K, 8, 20),
    "train_and_score": lambda d: naive.train_and_score(split.train_part(d, K, 20), split.test_part(d, K, 20), K, 8, 20),
    "left_align": lambda d: metrics.align(d.selectExpr("unique_id", "ds", "'m' AS model", "y + 1 AS yhat"), d, K, "left"),
    "exact_quantiles": lambda d: quantiles.exact_quantiles(d, K.ids, "y", [0.1, 0.5]),
    "cumulative_counts": lambda d: quantiles.cumulative_counts(d, d, K.ids, "y"),
    "null_outliers": lambda d: outliers.null_outliers(d, K),
    "known_future": lambda d: trees.known_future(d, d.withColumn("ds", F.col("ds") + F.expr("INTERVAL 5 HOURS")), K, 10, ["y"]),
    "decompose": lambda d: decompose.seasonal_decompose(d, K, [8]),
    "decompose_forecast": lambda d: decompose.decomposition_forecast(decompose.seasonal_decompose(d, K, [8]), K, [8], 10),
    "loess": lambda d: loess.loess(d, K, 21, jump=5),
    "null_at_table": lambda d: fill.null_at_table(d, K, d.filter("y > 900")),
    "phillips_perron": lambda d: stats.phillips_perron(d, K, 5),
    "dickey_fuller": lambda d: stats.dickey_fuller(d, K, 3),
    "ewm": lambda d: rolling.add_ewm(d, K, 0.1, "e"),
    "drift": lambda d: drift.drift_report(split.train_part(d, K, 96), split.test_part(d, K, 96), K, 32),
    "fenced": lambda d: naive.backtest_with_fences(d, K, [40, 80], season=8),
    "scores": lambda d: select.compare_models(d.selectExpr("unique_id", "ds", "'m' AS model", "y + 1 AS yhat"), d, K, ["unique_id"]),
    "future": lambda d: future_frame(d, K, 3),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_series_without_a_name(twins, name):
    rows = OPERATORS[name](twins).collect()
    found = {None: [], "a": []}
    for r in rows:
        values = r.asDict()
        found[values.pop("unique_id")].append(tuple(round(v, 6) if isinstance(v, float) else v for v in values.values()))
    assert found[None] and sorted(found[None], key=repr) == sorted(found["a"], key=repr)


def test_planted_values_go_in_both(twins):
    out = outliers.null_outliers(twins, K)
    assert {r["n"] for r in out.filter("y is null").groupBy("unique_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {2}
