"""Regular time axis: spine, missing slots, completeness, gap blocks, future frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys, epoch_seconds, shift_time
from demandspark.operators.chunks import chunk_window, null_safe_join, with_chunk


def bounds(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """First and last timestamp and row count per series (map-side combined)."""
    t = F.col(keys.time)
    return df.groupBy(*keys.ids).agg(
        F.min(t).alias("first_ts"), F.max(t).alias("last_ts"), F.count(F.lit(1)).alias("n_rows")
    )


def time_spine(limits: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Every slot from ``first_ts`` to ``last_ts``, both included, per series.

    Slots are made in two steps: first one small row per chunk, spread over the
    cluster, then the slots inside each chunk. A long series is thus never
    expanded by one task.
    """
    n = limits.sparkSession.sparkContext.defaultParallelism
    size = F.lit(keys.chunk)
    span = epoch_seconds(F.col("last_ts")) - epoch_seconds(F.col("first_ts"))
    pieces = (
        limits.filter(F.col("first_ts").isNotNull())
        .select(*keys.ids, "first_ts", F.floor(span / F.lit(keys.step)).cast("bigint").alias("_n"))
        .withColumn("_piece", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.floor(F.col("_n") / size).cast("bigint"))))
        .repartition(n, *keys.ids, "_piece")
    )
    lo = F.col("_piece") * size
    hi = F.least(F.col("_n"), lo + size - 1)
    return pieces.select(*keys.ids, "first_ts", F.explode(F.sequence(lo, hi)).alias("_k")).select(
        *keys.ids, shift_time(F.col("first_ts"), F.col("_k") * F.lit(keys.step)).alias(keys.time)
    )


def insert_missing(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Put the table on its regular grid; inserted rows are null (keys unique per series)."""
    rest = [c for c in df.columns if c not in keys.key]
    spine = time_spine(bounds(df, keys), keys)
    return null_safe_join(spine, df, keys.key, "left").select(*keys.key, *rest)


def missing_slots(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Grid slots for which there is no row."""
    return null_safe_join(time_spine(bounds(df, keys), keys), df.select(*keys.key), keys.key, "left_anti")


def completeness(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Expected, present and missing slot counts per series, without a join."""
    t = F.col(keys.time)
    stats = df.groupBy(*keys.ids).agg(
        F.min(t).alias("first_ts"), F.max(t).alias("last_ts"), F.countDistinct(t).alias("present")
    )
    span = epoch_seconds(F.col("last_ts")) - epoch_seconds(F.col("first_ts"))
    expected = F.floor(span / F.lit(keys.step)).cast("bigint") + 1
    return stats.select(
        *keys.ids, "first_ts", "last_ts", expected.alias("expected"), "present",
        (expected - F.col("present")).alias("missing"),
        (expected == F.col("present")).alias("is_complete"),
    )


def gap_blocks(df: DataFrame, keys: SeriesKeys, null_values: bool = False) -> DataFrame:
    """Runs of missing slots: start, end and number of points.

    With ``null_values`` a slot also counts as missing when its target is null,
    including runs at either end of the series. Only present rows are read: a
    gap shows as the distance to the next present row, either inside a chunk or
    between the edge rows of two chunks.
    """
    t = F.col(keys.time)
    present = df.select(*keys.key)
    if null_values:
        ends = bounds(df, keys)
        guard = ends.select(*keys.ids, F.explode(F.array(
            shift_time(F.col("first_ts"), -keys.step), shift_time(F.col("last_ts"), keys.step)
        )).alias(keys.time))
        present = df.filter(F.col(keys.target).isNotNull()).select(*keys.key).unionByName(guard)
    rows = with_chunk(present, keys)
    inside = rows.select(*keys.ids, t.alias("_from"), F.lead(t).over(chunk_window(keys)).alias("_to"))
    edges = rows.groupBy(*keys.ids, "_chunk").agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    # one row per chunk: the only window over a whole series
    series = Window.partitionBy(*keys.ids).orderBy("_chunk")
    between = edges.select(
        *keys.ids, F.col("_hi").alias("_from"), F.lead("_lo").over(series).alias("_to")
    )
    steps = (
        (epoch_seconds(F.col("_to")) - epoch_seconds(F.col("_from"))) / F.lit(keys.step)
    ).cast("bigint")
    return (
        inside.unionByName(between)
        .filter(F.col("_to").isNotNull() & (steps > 1))
        .select(
            *keys.ids,
            shift_time(F.col("_from"), keys.step).alias("missing_start"),
            shift_time(F.col("_to"), -keys.step).alias("missing_end"),
            (steps - 1).alias("missing_points"),
        )
    )


def future_frame(df: DataFrame, keys: SeriesKeys, horizon: int) -> DataFrame:
    """The next ``horizon`` slots after the last row of each series.

    ``horizon_step`` numbers them from 1.
    """
    return bounds(df, keys).select(
        *keys.ids, "last_ts", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_step")
    ).select(
        *keys.ids,
        shift_time(F.col("last_ts"), F.col("horizon_step") * F.lit(keys.step)).alias(keys.time),
        "horizon_step",
    )
