"""Filling of null values along the grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import carry, drop_helpers, null_safe_join, series_join, stage, with_chunk
from demandspark.operators.rolling import rolling_trend
from demandspark.operators.spine import insert_missing


def _filled(df: DataFrame, cols: Sequence[str], prefix: str) -> list:
    return [F.col(f"{prefix}{c}").alias(c) if c in cols else F.col(c) for c in df.columns]


def forward_fill(df: DataFrame, keys: SeriesKeys, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls by the last value before them."""
    cols = list(cols or [keys.target])
    return carry(with_chunk(df, keys), keys, cols).select(*_filled(df, cols, "_before_"))


def backward_fill(df: DataFrame, keys: SeriesKeys, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls by the next value after them."""
    cols = list(cols or [keys.target])
    return carry(with_chunk(df, keys), keys, cols, before=False, after=True).select(*_filled(df, cols, "_after_"))


def fill_both(df: DataFrame, keys: SeriesKeys, cols: Sequence[str] | None = None) -> DataFrame:
    """Forward fill, then backward fill for what is left at the start.

    After a forward fill only rows before the first value are null, and they all
    take that first value, which the same chunk summary holds.
    """
    cols = list(cols or [keys.target])
    return carry(with_chunk(df, keys), keys, cols, first=True).select(*[
        F.coalesce(F.col(f"_before_{c}"), F.col(f"_first_{c}")).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def interpolate(df: DataFrame, keys: SeriesKeys, out: str | None = None) -> DataFrame:
    """Linear interpolation by grid position; nulls at either end stay null."""
    y = keys.target
    out = out or y
    rows = with_chunk(df, keys).withColumn(
        "_pt", F.when(F.col(y).isNotNull(), F.struct(F.col("_slot").alias("s"), F.col(y).alias("v"))))
    rows = carry(rows, keys, ["_pt"], after=True)
    a, b = F.col("_before__pt"), F.col("_after__pt")
    share = (F.col("_slot") - a["s"]) / (b["s"] - a["s"])
    line = F.when(F.col(y).isNotNull(), F.col(y)).when(
        a.isNotNull() & b.isNotNull(), a["v"] + (b["v"] - a["v"]) * share)
    if out in df.columns:
        return rows.select(*[line.alias(c) if c == out else F.col(c) for c in df.columns])
    return rows.select(*df.columns, line.alias(out))


def repair(df: DataFrame, keys: SeriesKeys, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop null targets, put the series on its grid, fill forward and backward.

    What is left is read several times and staged.
    """
    known = stage(df.na.drop(subset=[keys.target]))
    return fill_both(insert_missing(known, keys), keys, cols)


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.fill(0.0, list(cols))


def seasonal_median_impute(df: DataFrame, keys: SeriesKeys, trend_window: int = 672,
                           out: str = "y_filled") -> DataFrame:
    """Fill nulls with trend plus the usual deviation at that weekday and time.

    Trend: centred rolling mean of the interpolated series. Deviation: median of
    value minus trend over all rows with the same weekday and time of day; such a
    group has one row per week of history, so an exact median is safe. Also adds
    ``is_imputed``. For exploration only: it looks ahead.
    The trend is read twice and therefore staged.
    """
    y = keys.target
    grid = insert_missing(df, keys).withColumn("is_imputed", F.col(y).isNull())
    bridged = interpolate(grid, keys, out="_bridge")
    trend = stage(rolling_trend(bridged, keys, trend_window, out="_trend", value="_bridge"))
    tod = F.hour(keys.time) * 3600 + F.minute(keys.time) * 60 + F.second(keys.time)
    phased = trend.withColumn("_dow", F.weekday(keys.time) + 1).withColumn("_tod", tod)
    swing = phased.groupBy(*keys.ids, "_dow", "_tod").agg(
        F.median(F.col(y) - F.col("_trend")).alias("_swing"))
    joined = series_join(phased, swing, [*keys.ids, "_dow", "_tod"], "left")
    filled = F.coalesce(F.col(y), F.col("_trend") + F.col("_swing"))
    return drop_helpers(joined.withColumn(out, filled))


def null_at(df: DataFrame, keys: SeriesKeys, times: Sequence) -> DataFrame:
    """Set the target to null at known bad timestamps (a short, configured list)."""
    bad = F.col(keys.time).isin([F.lit(t).cast("timestamp_ntz") for t in times])
    return df.withColumn(keys.target, F.when(~bad, F.col(keys.target))) if times else df


def null_at_table(df: DataFrame, keys: SeriesKeys, bad: DataFrame) -> DataFrame:
    """Same for a table of bad ``(ids, time)`` keys of any size."""
    marks = bad.select(*keys.key).distinct().withColumn("_bad", F.lit(True))
    joined = null_safe_join(df, marks, keys.key, "left")
    fixed = F.when(F.col("_bad").isNull(), F.col(keys.target)).alias(keys.target)
    return joined.select(*[fixed if c == keys.target else F.col(c) for c in df.columns])


def outlier_interpolate(df: DataFrame, keys: SeriesKeys, times: Sequence) -> DataFrame:
    """Known bad values to null, then interpolated."""
    return interpolate(null_at(df, keys, times), keys)


def mark_flag(df: DataFrame, keys: SeriesKeys, times: Sequence, flag: str = "is_imputed") -> DataFrame:
    """True at the listed timestamps, else the previous flag, else false."""
    listed = F.col(keys.time).isin([F.lit(t).cast("timestamp_ntz") for t in times]) if times else F.lit(False)
    before = F.coalesce(F.col(flag), F.lit(False)) if flag in df.columns else F.lit(False)
    return df.withColumn(flag, F.when(listed, F.lit(True)).otherwise(before))
