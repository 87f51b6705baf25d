"""Forecast errors, blending, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import null_safe_join


def to_long(predictions: DataFrame, keys: SeriesKeys, models: Sequence[str]) -> DataFrame:
    """One column per model to rows ``(ids, time, model, yhat)``."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("yhat")) for m in models])
    return predictions.select(*keys.key, F.inline(pairs))


def blend(predictions: DataFrame, keys: SeriesKeys, members: Sequence[str], name: str) -> DataFrame:
    """Mean of the member models that are present, as one more model."""
    chosen = predictions.filter(F.col("model").isin(list(members)))
    return chosen.groupBy(*keys.key).agg(F.avg("yhat").alias("yhat")).select(
        *keys.key, F.lit(name).alias("model"), "yhat")


def align(predictions: DataFrame, actuals: DataFrame, keys: SeriesKeys, how: str = "inner") -> DataFrame:
    """Predictions with the actual value at the same series and time."""
    return null_safe_join(predictions, actuals.select(*keys.key, keys.target), keys.key, how)


def forecast_errors(aligned: DataFrame, keys: SeriesKeys, by: Sequence[str] = ()) -> DataFrame:
    """``mae, rmse, mape`` per group; rows with a null on either side are skipped.

    ``mape`` is a fraction; rows with actual 0 do not enter it and are counted in
    ``mape_skipped``.
    """
    y, e = F.col(keys.target), F.col(keys.target) - F.col("yhat")
    pairs = aligned.filter(y.isNotNull() & F.col("yhat").isNotNull())
    return pairs.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.try_divide(F.abs(e), F.abs(y))).alias("mape"),
        F.count_if(y == 0).alias("mape_skipped"),
        F.count(F.lit(1)).alias("n"),
    )


def metric_rows(errors: DataFrame, by: Sequence[str], names: Sequence[str] = ("mae", "rmse", "mape")) -> DataFrame:
    """Errors in long form: ``(by, metric, value)``."""
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return errors.select(*by, F.inline(pairs))


def history_rows(metrics: DataFrame, prefix: str, step: int = 0) -> DataFrame:
    """Rows of the metrics history table: ``prefix, model, metric, step, value``."""
    return metrics.select(
        F.lit(prefix).alias("prefix"), "model", "metric", F.lit(step).alias("step"), "value")


def worst_folds(fold_errors: DataFrame, n: int = 5, by: Sequence[str] = ("fold",)) -> DataFrame:
    """The n folds with the highest mape."""
    return fold_errors.orderBy(F.col("mape").desc_nulls_last(), *by).limit(n)


def fold_metric_means(metrics: DataFrame) -> DataFrame:
    """Mean of each metric per fold over the series."""
    return metrics.groupBy("fold", "metric").agg(F.avg("value").alias("value"))
