"""Time-ordered splits and rolling-origin folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys, shift_time
from demandspark.operators.chunks import row_position, series_join, with_chunk
from demandspark.operators.spine import bounds


def _with_cutoff(df: DataFrame, keys: SeriesKeys, n_test: int) -> DataFrame:
    limits = bounds(df, keys).select(
        *keys.ids, shift_time(F.col("last_ts"), -(n_test - 1) * keys.step).alias("_cutoff"))
    return series_join(df, limits, keys.ids)


def test_part(df: DataFrame, keys: SeriesKeys, n_test: int) -> DataFrame:
    """The last ``n_test`` slots of each series (all of a shorter one)."""
    return _with_cutoff(df, keys, n_test).filter(F.col(keys.time) >= F.col("_cutoff")).select(*df.columns)


def train_part(df: DataFrame, keys: SeriesKeys, n_test: int) -> DataFrame:
    """What is before the last ``n_test`` slots of each series."""
    return _with_cutoff(df, keys, n_test).filter(F.col(keys.time) < F.col("_cutoff")).select(*df.columns)


def split_by_horizon(df: DataFrame, keys: SeriesKeys, horizon: int = 96,
                     test_days: int = 14) -> tuple[DataFrame, DataFrame]:
    """Train and test, the latter being ``horizon * test_days`` slots."""
    n = horizon * test_days
    return train_part(df, keys, n), test_part(df, keys, n)


def rolling_folds(df: DataFrame, keys: SeriesKeys, initial: int = 96, horizon: int = 8,
                  step: int = 4) -> DataFrame:
    """Test rows of all rolling-origin folds: ``fold``, ``fold_step`` and the row.

    Origins are the row numbers initial, initial+step, ... below n - horizon.
    A row belongs to at most ceil(horizon/step) folds, which follow from its row
    number, so nothing is joined; the training prefix is never copied.
    """
    numbered = row_position(with_chunk(df, keys), keys)
    sizes = df.groupBy(*keys.ids).agg(F.count(F.lit(1)).alias("_rows"))
    r = F.col("row_no")
    lo = F.greatest(F.lit(0), F.ceil((r - horizon + 1 - initial) / F.lit(step))).cast("bigint")
    hi = F.floor((r - initial) / F.lit(step)).cast("bigint")
    picked = numbered.filter(r >= initial).withColumn(
        "_i", F.explode(F.when(hi >= lo, F.sequence(lo, hi))))
    picked = picked.withColumn("fold", F.lit(initial) + F.col("_i") * F.lit(step))
    joined = series_join(picked, sizes, keys.ids)
    return joined.filter(F.col("fold") < F.col("_rows") - horizon).select(
        *df.columns, "fold", (r - F.col("fold") + 1).alias("fold_step"))
