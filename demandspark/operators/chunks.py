"""Ordered work on pieces of a series.

A window partitioned by the series id alone would put a whole series into one
task. Every operator here cuts the time axis into chunks of ``keys.chunk`` slots
and uses one of two exact schemes:

* *halo*: rows near a border are copied into the neighbour chunk, so a frame of
  limited width sees all its rows (:func:`with_halo`);
* *carry*: what an unbounded frame needs from earlier chunks is one row per
  chunk, computed by an aggregate and handed on (:func:`carry`, :func:`neighbour`,
  :func:`running_sum`).

The one window over a whole series id runs on that one-row-per-chunk summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.sources.tables import cut_lineage, ensure_checkpoint_dir

SALTS = 16
# Rows of a training matrix that one task holds.
ROWS_EACH = 32_768


def null_safe_join(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where null equals null; the columns ``on`` are those of ``df``."""
    on = list(on)
    right = other.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in other.columns])
    same = reduce(and_, [df[c].eqNullSafe(right[f"_r_{c}"]) for c in on])
    return df.join(right, same, how).drop(*[f"_r_{c}" for c in on])


def salted_join(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner",
                spread: Sequence[str] | None = None, salts: int = SALTS) -> DataFrame:
    """Join rows to a table with one row per key when single keys may be huge.

    The table is repeated ``salts`` times and the rows of one key are spread over
    the copies by a hash of ``spread`` (default: all columns), so no key is bound
    to one task.
    """
    left = df.withColumn("_salt", F.pmod(F.xxhash64(*(spread or df.columns)), F.lit(salts)).cast("int"))
    right = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return null_safe_join(left, right, [*on, "_salt"], how).drop("_salt")


def series_join(df: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to a summary with a few rows per series (bounds, means, fences).

    Adaptive execution sees the size of the summary once it is made: it broadcasts a
    small one and splits the rows of a series over several tasks otherwise. Nothing
    runs while the plan is built.
    """
    return null_safe_join(df, summary, on, how)


def with_chunk(df: DataFrame, keys: SeriesKeys, slot: Column | None = None) -> DataFrame:
    """Add ``_slot`` and ``_chunk``."""
    out = df.withColumn("_slot", keys.slot() if slot is None else slot)
    return out.withColumn("_chunk", F.expr(f"floor(_slot / {keys.chunk})"))


def with_halo(df: DataFrame, keys: SeriesKeys, before: int, after: int = 0) -> DataFrame:
    """Add ``_slot``, ``_chunk`` and ``_own``, copying rows that frames reach.

    A frame looks ``before`` slots back and ``after`` slots ahead, so a row at
    slot s serves the slots s-after .. s+before. Filter on ``_own`` at the end.
    """
    size = keys.chunk
    reach = f"sequence(floor((_slot - {after}) / {size}), floor((_slot + {before}) / {size}))"
    copies = df.withColumn("_slot", keys.slot()).withColumn("_chunk", F.explode(F.expr(reach)))
    return copies.withColumn("_own", F.expr(f"floor(_slot / {size}) = _chunk"))


def chunk_window(keys: SeriesKeys, descending: bool = False):
    """The window specification shared by all chunk-wise operators.

    Rows of one slot are in order of time.
    """
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in ("_slot", keys.time)]
    return Window.partitionBy(*keys.ids, "_chunk").orderBy(*order)


def _place(keys: SeriesKeys) -> Column:
    return F.struct("_slot", keys.time)


def _series_window(keys: SeriesKeys, descending: bool = False):
    order = F.col("_chunk").desc() if descending else F.col("_chunk").asc()
    return Window.partitionBy(*keys.ids).orderBy(order)


def _join_chunks(df: DataFrame, edges: DataFrame, keys: SeriesKeys) -> DataFrame:
    return null_safe_join(df, edges, [*keys.ids, "_chunk"], "left")


def carry(df: DataFrame, keys: SeriesKeys, cols: Sequence[str], before: bool = True,
          after: bool = False, first: bool = False) -> DataFrame:
    """Add nearest non-null values of each column, along the series.

    ``before`` adds ``_before_<c>``, the last value at or before the row;
    ``after`` adds ``_after_<c>``, the next at or after it; ``first`` adds
    ``_first_<c>``, the first value of the series, but only where nothing is
    before the row's chunk. ``df`` must hold ``_slot`` and ``_chunk``
    (:func:`with_chunk`). One summary and one join serve all of them.
    """
    def at(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), _place(keys))

    ends = []
    for c in cols:
        if before:
            ends.append(F.max_by(F.col(c), at(c)).alias(f"_hi_{c}"))
        if after or first:
            ends.append(F.min_by(F.col(c), at(c)).alias(f"_lo_{c}"))
    edges = df.groupBy(*keys.ids, "_chunk").agg(*ends)
    rows = Window.unboundedPreceding
    ahead = _series_window(keys).rowsBetween(rows, -1)
    back = _series_window(keys, descending=True).rowsBetween(rows, -1)
    through = _series_window(keys, descending=True).rowsBetween(rows, 0)
    picked = []
    for c in cols:
        if before:
            picked.append(F.last(f"_hi_{c}", ignorenulls=True).over(ahead).alias(f"_eb_{c}"))
        if after:
            picked.append(F.last(f"_lo_{c}", ignorenulls=True).over(back).alias(f"_ea_{c}"))
        if first:
            picked.append(F.last(f"_lo_{c}", ignorenulls=True).over(through).alias(f"_first_{c}"))
    joined = _join_chunks(df, edges.select(*keys.ids, "_chunk", *picked), keys)
    down = chunk_window(keys).rowsBetween(rows, 0)
    up = chunk_window(keys, descending=True).rowsBetween(rows, 0)
    out = []
    for c in cols:
        if before:
            out.append(F.coalesce(F.last(c, ignorenulls=True).over(down), F.col(f"_eb_{c}")).alias(f"_before_{c}"))
        if after:
            out.append(F.coalesce(F.last(c, ignorenulls=True).over(up), F.col(f"_ea_{c}")).alias(f"_after_{c}"))
        if first:
            out.append(F.col(f"_first_{c}"))
    return joined.select(*df.columns, *out)


def neighbour(df: DataFrame, keys: SeriesKeys, cols: Sequence[str], forward: bool = False,
              prefix: str = "_prev_") -> DataFrame:
    """For each column add its value in the previous (``forward``: next) row.

    Rows may be irregular, also several to a slot. ``df`` must hold ``_slot`` and
    ``_chunk``.
    """
    pick = F.min_by if forward else F.max_by
    edges = df.groupBy(*keys.ids, "_chunk").agg(
        *[pick(F.col(c), _place(keys)).alias(f"_edge_{c}") for c in cols]
    )
    over = _series_window(keys, descending=forward)
    edges = edges.select(
        *keys.ids, "_chunk", *[F.lag(f"_edge_{c}").over(over).alias(f"_edge_{c}") for c in cols]
    )
    inside = chunk_window(keys, descending=forward)
    first = F.row_number().over(inside) == 1
    return _join_chunks(df, edges, keys).select(
        *df.columns,
        *[F.when(first, F.col(f"_edge_{c}")).otherwise(F.lag(c).over(inside)).alias(f"{prefix}{c}")
          for c in cols],
    )


def running_sum(df: DataFrame, keys: SeriesKeys, col: str, out: str) -> DataFrame:
    """Inclusive running sum of ``col`` (nulls count as 0) along each series."""
    edges = df.groupBy(*keys.ids, "_chunk").agg(F.sum(col).alias("_part"))
    over = _series_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*keys.ids, "_chunk", F.sum("_part").over(over).alias("_before"))
    inside = chunk_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    total = F.coalesce(F.col("_before"), zero) + F.coalesce(F.sum(col).over(inside), zero)
    return _join_chunks(df, edges, keys).select(*df.columns, total.alias(out))


def row_position(df: DataFrame, keys: SeriesKeys, out: str = "row_no") -> DataFrame:
    """Zero-based position of each row in its series, in time order."""
    counted = running_sum(df.withColumn("_one", F.lit(1).cast("bigint")), keys, "_one", out)
    return counted.withColumn(out, F.col(out) - 1).drop("_one")


def stage(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the checkpoint folder and go on from there.

    Used where a composite reads a costly table several times. Runs a job. The
    copy is a table in the shared folder: losing executors does not bring the lineage
    back. A table that was just staged is returned as it is.
    """
    if getattr(df, "_is_staged", False):
        return df
    out = cut_lineage(df)
    out._is_staged = True
    return out


def spread(df: DataFrame, rows: int) -> DataFrame:
    """A matrix of so many rows on as many tasks as a fit needs that reads it in thousands of jobs.

    Adaptive execution puts compact rows into few tasks, whatever is made of them later, and
    a shuffle leaves a few rows on as many tasks as the session names. A matrix on enough
    tasks, but at most twice as many, is returned as it is.
    """
    parts = max(1, -(-rows // ROWS_EACH))
    return df if parts <= df.rdd.getNumPartitions() <= 2 * parts else df.repartition(parts)


def fit_matrix(df: DataFrame, rows: int) -> DataFrame:
    """:func:`spread` and written to the checkpoint folder, without the lineage of its rows.

    Every task of every job of a fit is sent that lineage and unpacks it; behind windows and
    joins this takes longer than the work. Runs a job; partitions and their order stay.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return spread(df, rows).checkpoint()


def drop_helpers(df: DataFrame) -> DataFrame:
    """Remove the underscore columns the helpers above add."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])
