"""Classical decomposition into trend, several seasons and remainder.

Trend: centred rolling mean over the longest period. Seasons, shortest first:
mean by phase of what is left, centred over the phases. This is not a LOESS
decomposition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import null_safe_join, series_join, stage
from demandspark.operators.quantiles import quantile_columns
from demandspark.operators.rolling import rolling_trend
from demandspark.operators.spine import future_frame


def _phase(keys: SeriesKeys, period: int):
    return F.pmod(keys.slot(), F.lit(period))


def _season_table(left: DataFrame, keys: SeriesKeys, period: int) -> DataFrame:
    """At most ``period`` rows per series: phase and its centred mean."""
    means = left.groupBy(*keys.ids, _phase(keys, period).alias("_phase")).agg(F.avg("_left").alias("_raw"))
    level = means.groupBy(*keys.ids).agg(F.avg("_raw").alias("_level"))
    return series_join(means, level, keys.ids).select(
        *keys.ids, "_phase", (F.col("_raw") - F.col("_level")).alias("_season"))


def seasonal_decompose(df: DataFrame, keys: SeriesKeys, periods: Sequence[int]) -> DataFrame:
    """Adds ``trend``, ``seasonal_<p>`` per period and ``remainder``; null targets stay null."""
    periods = sorted(periods)
    out = rolling_trend(df.select(*keys.key, keys.target), keys, periods[-1], out="trend")
    out = out.withColumn("_left", F.col(keys.target) - F.col("trend"))
    for p in periods:
        out = stage(out)  # read for the season table and for the rows
        table = _season_table(out, keys, p).withColumnRenamed("_season", f"seasonal_{p}")
        out = series_join(out.withColumn("_phase", _phase(keys, p)), table, [*keys.ids, "_phase"], "left").drop("_phase")
        out = out.withColumn("_left", F.col("_left") - F.col(f"seasonal_{p}"))
    return out.withColumnRenamed("_left", "remainder")


def decomposition_forecast(parts: DataFrame, keys: SeriesKeys, periods: Sequence[int], horizon: int,
                           level: float = 0.9) -> DataFrame:
    """Last trend value plus the seasons of each future slot, with a remainder band."""
    tail = (1 - level) / 2
    parts = stage(parts)
    last = parts.groupBy(*keys.ids).agg(
        F.max_by("trend", F.when(F.col("trend").isNotNull(), F.col(keys.time))).alias("_trend"))
    band = quantile_columns(parts, keys.ids, "remainder", {"_lo": tail, "_hi": 1 - tail}, "linear")
    out = series_join(future_frame(parts, keys, horizon), last, keys.ids)
    out = series_join(out, band, keys.ids, "left").withColumn("yhat", F.col("_trend"))
    for p in sorted(periods):
        seasons = parts.groupBy(*keys.ids, _phase(keys, p).alias("_phase")).agg(
            F.first(f"seasonal_{p}", ignorenulls=True).alias("_season"))
        out = null_safe_join(out.withColumn("_phase", _phase(keys, p)), seasons, [*keys.ids, "_phase"], "left")
        out = out.withColumn("yhat", F.col("yhat") + F.coalesce(F.col("_season"), F.lit(0.0))).drop("_phase", "_season")
    return out.select(*keys.key, "horizon_step", "yhat", (F.col("yhat") + F.col("_lo")).alias("yhat_low"),
                      (F.col("yhat") + F.col("_hi")).alias("yhat_high"))
