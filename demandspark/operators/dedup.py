"""Duplicate handling: keep first, keep last, report, order checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import neighbour, with_chunk


def keep_one(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or last by ``order``, which must be a total order.

    An aggregate, not a window: copies of one key are already reduced before the
    shuffle, so a heavily repeated key is harmless.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in key]
    pick = F.min_by if keep == "first" else F.max_by
    best = df.groupBy(*key).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*key, "_row.*").select(*df.columns)


def keep_first(df: DataFrame, keys: SeriesKeys, order: Sequence[str]) -> DataFrame:
    return keep_one(df, keys.key, order, "first")


def keep_last(df: DataFrame, keys: SeriesKeys, order: Sequence[str]) -> DataFrame:
    return keep_one(df, keys.key, order, "last")


def full_duplicates(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with the number of copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def order_violations(df: DataFrame, keys: SeriesKeys, sequence: str) -> DataFrame:
    """Per series: rows whose time is before that of the row preceding by ``sequence``.

    ``sequence`` is a unique whole number per row, such as an arrival counter.
    """
    rows = with_chunk(df.select(*keys.ids, keys.time, sequence), keys, F.col(sequence).cast("bigint"))
    seen = neighbour(rows, keys, [keys.time])
    back = F.col(keys.time) < F.col(f"_prev_{keys.time}")
    return seen.groupBy(*keys.ids).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(back).alias("violations"),
        (F.count_if(back) == 0).alias("is_sorted"),
    )
