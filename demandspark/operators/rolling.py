"""Rolling statistics over a fixed number of grid rows.

All need a series on its grid. The rows of a chunk are cut into blocks as long as
the frame, so a frame is the end of one block and the start of the next. Count,
mean and squared deviations run forward and backward inside each block; a frame
merges two of them. Nothing is subtracted, so a NaN or a large value stays in the
frames that hold it, and the cost per row does not depend on the width.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import chunk_window, null_safe_join, running_sum, series_join, with_chunk, with_halo


@dataclass(frozen=True)
class Rolling:
    """One output column: ``stat`` (mean or std) of rows i-before .. i+after.

    Null when the frame holds fewer than ``min_samples`` non-null values; std is
    the sample deviation and also needs two values.
    """

    out: str
    stat: str
    before: int
    after: int = 0
    min_samples: int = 1

    def __post_init__(self) -> None:
        if self.stat not in ("mean", "std"):
            raise ValueError("stat must be 'mean' or 'std'")

    @property
    def width(self) -> int:
        return self.before + self.after + 1


def trailing(out: str, stat: str, window: int, min_samples: int | None = None) -> Rolling:
    """Frame of the ``window`` rows ending at the row; all must be present by default."""
    return Rolling(out, stat, window - 1, 0, window if min_samples is None else min_samples)


def centred(out: str, stat: str, window: int, min_samples: int = 1) -> Rolling:
    """Frame around the row; an even window reaches one row further back."""
    return Rolling(out, stat, window // 2, (window - 1) // 2, min_samples)


def _state(value: Column, w) -> Column:
    """Count, mean and sum of squared deviations of the non-null values in a frame."""
    n = F.count(value).over(w)
    return F.struct(n.alias("n"), F.avg(value).over(w).alias("m"), (F.var_pop(value).over(w) * n).alias("q"))


def _merged(a: Column, b: Column) -> Column:
    """State of two disjoint frames together."""
    n = a["n"] + b["n"]
    shift = b["m"] - a["m"]
    both = F.struct(n.alias("n"), (a["m"] + shift * b["n"] / n).alias("m"),
                    (a["q"] + b["q"] + shift * shift * a["n"] * b["n"] / n).alias("q"))
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)


def add_rolling(df: DataFrame, keys: SeriesKeys, specs: list[Rolling], value: str | None = None) -> DataFrame:
    """Add one column per specification, all from one shuffle."""
    value = value or keys.target
    reach_back = max(s.before for s in specs)
    reach_on = max(s.after for s in specs)
    if reach_back + reach_on > keys.chunk:
        keys = keys.with_(chunk=4 * (reach_back + reach_on))
    rows = with_halo(df, keys, before=reach_back, after=reach_on)
    w = chunk_window(keys)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_row", F.row_number().over(w)).withColumn("_rows", F.count(F.lit(1)).over(whole))
    for width in sorted({s.width for s in specs}):
        rows = rows.withColumn("_block", F.expr(f"(_row - 1) div {width}"))
        block = Window.partitionBy(*keys.ids, "_chunk", "_block")
        for name, order in (("start", F.col("_row").asc()), ("end", F.col("_row").desc())):
            run = block.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
            rows = rows.withColumn(f"_{name}{width}", _state(F.col(value), run))
    outs = []
    for s in specs:
        first, last = F.greatest(F.col("_row") - s.before, F.lit(1)), F.least(F.col("_row") + s.after, F.col("_rows"))
        tail = F.coalesce(F.lag(f"_end{s.width}", s.before).over(w), F.first(f"_end{s.width}").over(whole))
        head = F.coalesce(F.lead(f"_start{s.width}", s.after).over(w), F.last(f"_start{s.width}").over(whole))
        of = lambda row, width=s.width: F.floor((row - 1) / width)
        starts = (first == 1) | (F.pmod(first - 1, F.lit(s.width)) == 0)
        outs.append(F.when(of(first) != of(last), _merged(tail, head)).when(starts, head).otherwise(tail).alias(f"_of_{s.out}"))
    rows = rows.select(*df.columns, "_own", *outs).filter("_own")
    found = []
    for s in specs:
        state = F.col(f"_of_{s.out}")
        if s.stat == "mean":
            found.append(F.when(state["n"] >= max(s.min_samples, 1), state["m"]).alias(s.out))
        else:
            found.append(F.when(state["n"] >= max(s.min_samples, 2), F.sqrt(state["q"] / (state["n"] - 1))).alias(s.out))
    return rows.select(*df.columns, *found)


def rolling_trend(df: DataFrame, keys: SeriesKeys, window: int = 672, out: str = "macro_trend",
                  value: str | None = None) -> DataFrame:
    """Centred rolling mean with at least one sample."""
    return add_rolling(df, keys, [centred(out, "mean", window)], value)


def rolling_volatility(df: DataFrame, keys: SeriesKeys, window: int = 672,
                       out: str = "rolling_volatility", value: str | None = None) -> DataFrame:
    """Trailing sample deviation; null until ``window`` values are present."""
    return add_rolling(df, keys, [trailing(out, "std", window)], value)


# Exponential weights are summed over runs of slots inside which they stay within 2**SAFE_BITS.
SAFE_BITS = 200


def _weight_span(rest: float, chunk: int) -> int:
    """Slots to a run: a part of a chunk, or whole chunks."""
    span = int(min(SAFE_BITS * math.log(2) / -math.log(rest), float(1 << 40)))
    return max(1, span) if span <= chunk else span - span % chunk


def add_ewm(df: DataFrame, keys: SeriesKeys, alpha: float, out: str, value: str | None = None) -> DataFrame:
    """Exponentially weighted mean started at the first value of the series.

    ``e_0 = y_0``, ``e_t = alpha*y_t + (1-alpha)*e_{t-1}``, for any ``alpha`` in (0, 1] and
    any length. Time is cut into runs of slots. A run maps the mean before it to the one
    at its end by ``e -> a*e + b``; with equal runs ``a`` is one number, so what reaches a
    run is a sum over the few runs before it whose weight is not beyond double precision.
    Rows of a run get a running sum of their weighted values. Needs a series on its grid
    without nulls; a null value gives null.
    """
    value = value or keys.target
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    if alpha == 1:
        return df.withColumn(out, F.col(value).cast("double"))
    rest = 1 - alpha
    span = _weight_span(rest, keys.chunk)
    back = 1 + math.ceil(1100 * math.log(2) / (-math.log(rest) * span))  # runs until nothing is left of a weight
    power = lambda n: F.pow(F.lit(rest), n)
    rows = with_chunk(df, keys).withColumn("_run", F.floor(F.col("_slot") / F.lit(span)))
    rows = rows.withColumn("_at", F.col("_slot") - F.col("_run") * F.lit(span))
    rows = rows.withColumn("_v", F.col(value).cast("double") * F.lit(alpha))
    rows = rows.withColumn("_w", F.col("_v") * power(-F.col("_at")))
    run = keys.with_(ids=(*keys.ids, "_run"))
    ends = rows.groupBy(*run.ids).agg(F.sum(F.col("_v") * power(F.lit(span - 1) - F.col("_at"))).alias("_end"))
    sent = ends.withColumn("_m", F.explode(F.sequence(F.lit(1), F.lit(back)))).select(
        *keys.ids, (F.col("_run") + F.col("_m")).alias("_run"), "_m", "_end")
    came = F.lit(0.0)
    for m in range(back, 0, -1):  # smallest parts first
        part = F.max(F.when(F.col("_m") == m, F.col("_end")))
        came = came + F.coalesce(part, F.lit(0.0)) * F.lit(rest ** (span * (m - 1)))
    came = sent.groupBy(*run.ids).agg(came.alias("_came"))
    first = df.filter(F.col(value).isNotNull()).groupBy(*keys.ids).agg(
        F.min(keys.slot()).alias("_first"), F.min_by(F.col(value).cast("double"), F.col(keys.time)).alias("_y0"))
    if span <= keys.chunk:
        over = Window.partitionBy(*run.ids).orderBy("_slot", keys.time).rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_sum", F.sum("_w").over(over))
    else:
        rows = running_sum(rows, run, "_w", "_sum")
    rows = series_join(null_safe_join(rows, came, run.ids, "left"), first, keys.ids, "left")
    mean = (F.col("_sum") * power(F.col("_at")) + F.coalesce("_came", F.lit(0.0)) * power(F.col("_at") + 1)
            + F.lit(rest) * F.col("_y0") * power(F.col("_slot") - F.col("_first")))
    return rows.select(*df.columns, F.when(F.col(value).isNotNull(), mean).alias(out))
