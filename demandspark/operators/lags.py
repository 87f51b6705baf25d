"""Shifts along the grid and what is built from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys, epoch_seconds, shift_time
from demandspark.operators.chunks import (
    chunk_window, neighbour, running_sum, series_join, with_chunk, with_halo,
)


def add_lags(df: DataFrame, keys: SeriesKeys, lags: Mapping[str, int],
             value: str | None = None) -> DataFrame:
    """Add ``{name: k}`` columns holding the value ``k`` slots earlier.

    Any distance, one shuffle: each row is also sent, with its value only, to the
    timestamps where it is needed, and rows meet there by ``(ids, time)``. Keys
    are as fine as rows, so nothing can pile up. Rows that repeat ``(ids, time)``
    all stay; the largest of their values is the one that others see.
    """
    value = value or keys.target
    rest = [c for c in df.columns if c not in keys.key]
    distances = sorted(set(lags.values()))
    if any(k <= 0 for k in distances):
        raise ValueError("lags must be positive")
    sent = df.withColumn("_k", F.explode(F.array(F.lit(0), *[F.lit(k) for k in distances])))
    base = F.col("_k") == 0
    sent = sent.select(
        *keys.ids,
        F.when(base, F.col(keys.time))
        .otherwise(shift_time(F.col(keys.time), F.col("_k") * F.lit(keys.step))).alias(keys.time),
        "_k",
        F.col(value).alias("_v"),
        *[F.when(base, F.col(c)).alias(c) for c in rest],
    )
    here = Window.partitionBy(*keys.key)
    met = sent.select("*", *[F.max(F.when(F.col("_k") == k, F.col("_v"))).over(here).alias(name) for name, k in lags.items()])
    return met.filter("_k = 0").select(*df.columns, *lags)


def shift_columns(df: DataFrame, keys: SeriesKeys, shifts: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Add ``{name: (column, k)}``: several columns shifted by k rows.

    One shuffle and one sort for all of them, by windows with a halo, in chunks of at
    least the longest shift. Row based, so the series must be on its grid
    (:func:`~demandspark.operators.spine.insert_missing`).
    """
    reach = max(k for _, k in shifts.values())
    if reach > keys.chunk:
        keys = keys.with_(chunk=4 * reach)
    rows = with_halo(df, keys, before=reach)
    w = chunk_window(keys)
    out = rows.select(*df.columns, "_own", *[F.lag(c, k).over(w).alias(n) for n, (c, k) in shifts.items()])
    return out.filter("_own").drop("_own")


def add_near_lags(df: DataFrame, keys: SeriesKeys, lags: Mapping[str, int],
                  value: str | None = None) -> DataFrame:
    """The columns of :func:`add_lags` for many small distances on a grid series."""
    return shift_columns(df, keys, {n: (value or keys.target, k) for n, k in lags.items()})


def time_since_previous(df: DataFrame, keys: SeriesKeys, out: str = "seconds_since_previous") -> DataFrame:
    """Seconds to the preceding row of the series (rows need not be regular)."""
    seen = neighbour(with_chunk(df, keys), keys, [keys.time])
    gap = epoch_seconds(F.col(keys.time)) - epoch_seconds(F.col(f"_prev_{keys.time}"))
    return seen.select(*df.columns, gap.alias(out))


def seasonal_difference(df: DataFrame, keys: SeriesKeys, season: int, out: str = "seasonal_residual",
                        drop_incomplete: bool = False) -> DataFrame:
    """Value minus the value one season earlier."""
    lagged = add_lags(df, keys, {"_season_ago": season})
    result = lagged.select(*df.columns, (F.col(keys.target) - F.col("_season_ago")).alias(out))
    return result.na.drop("any") if drop_incomplete else result


def undo_seasonal_difference(differenced: DataFrame, history: DataFrame, keys: SeriesKeys, season: int,
                             diff: str = "seasonal_residual", out: str = "restored") -> DataFrame:
    """Rebuild levels from differences that continue ``history``.

    The level at step h is the history value one season before the first
    season of differences, plus all differences in the same phase up to h. With
    the phase as part of the series key that is a plain running sum.
    """
    phase = keys.with_(ids=(*keys.ids, "_phase"))
    start = history.groupBy(*keys.ids).agg(F.max(keys.time).alias("_last"))
    slots = with_chunk(differenced, keys).withColumn("_phase", F.pmod(F.col("_slot"), F.lit(season)))
    summed = running_sum(slots, phase, diff, "_gain")
    # the last season of the history, one value per phase
    tail = series_join(history.select(*keys.key, keys.target), start, keys.ids)
    near = epoch_seconds(F.col("_last")) - epoch_seconds(F.col(keys.time)) < season * keys.step
    tail = tail.filter(near).select(
        *keys.ids, F.pmod(keys.slot(), F.lit(season)).alias("_phase"), F.col(keys.target).alias("_level")
    )
    joined = series_join(summed, tail, [*keys.ids, "_phase"])
    return joined.select(*differenced.columns, (F.col("_level") + F.col("_gain")).alias(out))
