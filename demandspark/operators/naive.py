"""Seasonal naive forecast and its backtest, as joins on shifted time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys, shift_time
from demandspark.operators.chunks import null_safe_join, row_position, series_join, stage, with_chunk
from demandspark.operators.lags import add_lags
from demandspark.operators.metrics import align, forecast_errors
from demandspark.operators.quantiles import bucket_of, cut_points
from demandspark.operators.spine import future_frame
from demandspark.operators.split import rolling_folds

MODEL = "seasonal_naive"
DIGIT_BITS = 4


def seasonal_naive(train: DataFrame, keys: SeriesKeys, season: int, horizon: int) -> DataFrame:
    """Repeat the last season of each series: ``(ids, time, model, yhat)``.

    Step h takes the value ``ceil(h/season)*season`` slots before it. Null where
    the training part has no such row.
    """
    frame = future_frame(train, keys, horizon)
    back = F.ceil(F.col("horizon_step") / F.lit(season)).cast("bigint") * F.lit(-season * keys.step)
    frame = frame.withColumn("_source", shift_time(F.col(keys.time), back))
    source = train.select(*keys.ids, F.col(keys.time).alias("_source"), F.col(keys.target).alias("yhat"))
    return null_safe_join(frame, source, [*keys.ids, "_source"], "left").select(
        *keys.key, F.lit(MODEL).alias("model"), F.col("yhat").cast("double"))


def train_and_score(train: DataFrame, test: DataFrame, keys: SeriesKeys, season: int, horizon: int) -> DataFrame:
    """Errors of the seasonal naive forecast on the test part, per series and model."""
    predicted = seasonal_naive(train, keys, season, horizon)
    return forecast_errors(align(predicted, test, keys), keys, [*keys.ids, "model"])


def backtest(df: DataFrame, keys: SeriesKeys, season: int = 96, initial: int = 96, horizon: int = 8,
             step: int = 4) -> DataFrame:
    """Predictions of every rolling-origin fold in one job, with actuals.

    Needs ``horizon <= season`` and a grid series: the source row of a test row is
    then exactly one season before it for every fold, so the training prefixes
    need not exist.
    """
    if horizon > season:
        raise ValueError("horizon must not exceed the season")
    lagged = add_lags(df.select(*keys.key, keys.target), keys, {"yhat": season})
    folds = rolling_folds(lagged, keys, initial, horizon, step)
    return folds.select(*keys.key, "fold", "fold_step", keys.target, F.col("yhat").cast("double"),
                        F.lit(MODEL).alias("model"))


def _rank_codes(data: DataFrame, ids: list[str]) -> DataFrame:
    """``(ids, _v, _code)``: place of each distinct value among those of its key, from 0."""
    counts = data.groupBy(*ids, "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = series_join(counts, cut_points(counts, ids), ids).select(
        *ids, "_v", bucket_of(F.col("_v"), F.col("_cuts")).alias("_b"))
    parts = placed.groupBy(*ids, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(
        Window.partitionBy(*ids).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")
    placed = null_safe_join(placed, parts.select(*ids, "_b", before.alias("_before")), [*ids, "_b"])
    inside = F.row_number().over(Window.partitionBy(*ids, "_b").orderBy("_v"))
    return placed.select(*ids, "_v", (F.col("_before") + inside - 1).cast("bigint").alias("_code"))


def _narrow(values: DataFrame, wanted: DataFrame, ids: list[str], shift: int, chunk: int) -> DataFrame:
    """Take the ranks that are looked for one digit of the code further.

    ``values`` has ``_code``, ``_fold`` (the first prefix with the value) and ``_n``;
    ``wanted`` has ``_path`` (the digits found), ``_fold``, ``q`` and ``_rank`` among the
    values below that path (null before the first digit, when it follows from their number).
    Counts per digit run along the prefixes, chunk by chunk.
    """
    digits = range(1 << DIGIT_BITS)
    one = values.select(*ids, F.shiftright("_code", shift + DIGIT_BITS).alias("_path"), "_fold", F.lit(0).alias("_asks"), "_n",
                        F.shiftright("_code", shift).bitwiseAND(F.lit(len(digits) - 1)).alias("_digit"),
                        F.lit(None).cast("double").alias("q"), F.lit(None).cast("bigint").alias("_rank"))
    two = wanted.select(*ids, "_path", "_fold", F.lit(1).alias("_asks"), F.lit(0).cast("bigint").alias("_n"),
                        F.lit(0).cast("bigint").alias("_digit"), "q", "_rank")
    both = one.unionByName(two).withColumn("_chunk", F.floor(F.col("_fold") / chunk))
    counted = [F.when(F.col("_digit") == d, F.col("_n")).otherwise(0) for d in digits]
    node = [*ids, "_path"]
    ahead = Window.partitionBy(*node).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    edges = both.groupBy(*node, "_chunk").agg(*[F.sum(c).alias(f"_e{d}") for d, c in enumerate(counted)])
    edges = edges.select(*node, "_chunk", *[F.sum(f"_e{d}").over(ahead).alias(f"_e{d}") for d in digits])
    w = Window.partitionBy(*node, "_chunk").orderBy("_fold", "_asks")
    rows = null_safe_join(both, edges, [*node, "_chunk"])
    rows = rows.select(*node, "_fold", "_asks", "q", "_rank", *[
        (F.coalesce(F.col(f"_e{d}"), F.lit(0)) + F.sum(c).over(w)).alias(f"_c{d}") for d, c in enumerate(counted)])
    upto, total = [], F.lit(0)
    for d in digits:
        total = total + F.col(f"_c{d}")
        upto.append(total)
    rows = rows.filter("_asks = 1").select(*node, "_fold", "q", "_rank", F.array(*upto).alias("_upto"))
    n = F.element_at("_upto", -1)
    rows = rows.filter(n > 0).withColumn("_rank", F.coalesce("_rank", F.floor((n - 1) * F.col("q") + 0.5).cast("bigint")))
    below = F.filter("_upto", lambda x: x <= F.col("_rank"))
    return rows.select(
        *ids, (F.col("_path") * len(digits) + F.size(below)).alias("_path"), "_fold", "q",
        (F.col("_rank") - F.coalesce(F.array_max(below), F.lit(0))).alias("_rank"))


def prefix_fences(df: DataFrame, keys: SeriesKeys, origins: Sequence[int] | None = None, multiplier: float = 1.5,
                  initial: int = 96, horizon: int = 8, step: int = 4) -> DataFrame:
    """Fence of each expanding prefix: ``(ids, fold, lower_bound, upper_bound)``.

    Without ``origins`` they are those of :func:`rolling_folds`, from each series'
    length. Values become codes in their order. The quartiles of all prefixes are found
    digit by digit of the code, by counts that run along the prefixes, so each row and
    each fold is handled once per digit: (rows + folds) times the logarithm of the
    distinct values.
    """
    ids = list(keys.ids)
    numbered = row_position(with_chunk(df.select(*keys.key, keys.target), keys), keys)
    numbered = stage(numbered.select(*ids, F.col(keys.target).alias("_v"), "row_no"))
    r = F.col("row_no")
    if origins is None:
        first = F.lit(initial) + F.greatest(F.lit(0), F.floor((r - initial) / F.lit(step)) + 1) * F.lit(step)
        sizes = numbered.groupBy(*ids).agg(F.count(F.lit(1)).alias("_rows"))
        at = numbered.filter((r >= initial) & (F.pmod(r - initial, F.lit(step)) == 0))
        folds = series_join(at, sizes, ids).filter(r < F.col("_rows") - horizon).select(*ids, r.alias("_fold"))
    else:
        listed = F.array(*[F.lit(int(o)).cast("bigint") for o in sorted(set(origins))])
        first = F.get(F.filter(listed, lambda o: o > r), F.lit(0))
        folds = numbered.select(*ids).distinct().withColumn("_fold", F.explode(listed))
    data = numbered.filter("_v is not null").withColumn("_fold", first.cast("bigint")).filter("_fold is not null")
    codes = stage(_rank_codes(data, ids))
    values = data.groupBy(*ids, "_v", "_fold").agg(F.count(F.lit(1)).alias("_n"))
    values = stage(null_safe_join(values, codes, [*ids, "_v"]).select(*ids, "_code", "_fold", "_n"))
    top = codes.agg(F.max("_code")).first()[0] or 0
    found = folds.select(*ids, F.lit(0).cast("bigint").alias("_path"), F.col("_fold").cast("bigint").alias("_fold"),
                         F.explode(F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.lit(None).cast("bigint").alias("_rank"))
    for level in reversed(range(max(1, -(-int(top).bit_length() // DIGIT_BITS)))):
        found = stage(_narrow(values, found, ids, level * DIGIT_BITS, keys.chunk))
    found = null_safe_join(found.withColumnRenamed("_path", "_code"), codes, [*ids, "_code"])
    q = found.groupBy(*ids, F.col("_fold").alias("fold")).agg(
        *[F.max(F.when(F.col("q") == at, F.col("_v"))).alias(n) for n, at in (("q1", 0.25), ("q3", 0.75))])
    width = F.col("q3") - F.col("q1")
    return q.select(*ids, "fold", (F.col("q1") - F.lit(multiplier) * width).alias("lower_bound"),
                    (F.col("q3") + F.lit(multiplier) * width).alias("upper_bound"))


def backtest_with_fences(df: DataFrame, keys: SeriesKeys, origins: Sequence[int] | None = None, season: int = 96,
                         horizon: int = 8, multiplier: float = 1.5, initial: int = 96, step: int = 4) -> DataFrame:
    """Like :func:`backtest`, nulling source values that lie outside the fence of
    their own training prefix. ``origins`` limits the folds to those given; without it
    all of :func:`backtest` are made."""
    lagged = add_lags(df.select(*keys.key, keys.target), keys, {"yhat": season})
    if origins is None:
        rows = rolling_folds(lagged, keys, initial, horizon, step)
    else:
        numbered = row_position(with_chunk(lagged, keys), keys)
        r = F.col("row_no")
        mine = F.filter(F.array(*[F.lit(int(o)).cast("bigint") for o in origins]),
                        lambda o: (o <= r) & (r < o + horizon))
        rows = numbered.select(*keys.key, keys.target, "yhat", r, F.explode(mine).alias("fold")).withColumn(
            "fold_step", r - F.col("fold") + 1)
    fences = prefix_fences(df, keys, origins, multiplier, initial, horizon, step)
    joined = null_safe_join(rows, fences, [*keys.ids, "fold"], "left")
    out = F.coalesce((F.col("yhat") < F.col("lower_bound")) | (F.col("yhat") > F.col("upper_bound")), F.lit(False))
    return joined.select(*keys.key, "fold", "fold_step", keys.target,
                         F.when(~out, F.col("yhat")).alias("yhat"), F.lit(MODEL).alias("model"))
