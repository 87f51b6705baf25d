"""Interquartile fences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import series_join
from demandspark.operators.quantiles import quantile_columns


def iqr_bounds(df: DataFrame, ids: Sequence[str], value: str, multiplier: float = 1.5,
               mode: str = "nearest") -> DataFrame:
    """Per key ``q1, q3, lower_bound, upper_bound``; keys without values are absent."""
    q = quantile_columns(df, ids, value, {"q1": 0.25, "q3": 0.75}, mode)
    width = F.col("q3") - F.col("q1")
    return q.select(
        *ids, "q1", "q3",
        (F.col("q1") - F.lit(multiplier) * width).alias("lower_bound"),
        (F.col("q3") + F.lit(multiplier) * width).alias("upper_bound"),
    )


def null_outliers(df: DataFrame, keys: SeriesKeys, multiplier: float = 1.5, mode: str = "nearest",
                  limits: DataFrame | None = None, flag: str | None = None) -> DataFrame:
    """Set targets strictly outside their series' fence to null.

    A series with no value has no fence and is left alone. ``limits`` may come
    from other rows, such as the training part only.
    """
    y = F.col(keys.target)
    limits = iqr_bounds(df, keys.ids, keys.target, multiplier, mode) if limits is None else limits
    joined = series_join(df, limits.select(*keys.ids, "lower_bound", "upper_bound"), keys.ids, "left")
    outside = F.coalesce((y < F.col("lower_bound")) | (y > F.col("upper_bound")), F.lit(False))
    cols = [F.when(~outside, y).alias(c) if c == keys.target else F.col(c) for c in df.columns]
    return joined.select(*cols, *([outside.alias(flag)] if flag else []))
