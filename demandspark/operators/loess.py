"""Local regression along a series, and decomposition by it into trend, several seasons and remainder.

A local line at a point needs five weighted sums over the rows near it. Each row is sent
to the few points it reaches and the sums are added up per point, so there is no window
and the work is rows times points in reach, wherever a series lies. Points stand
``jump`` slots apart; what is between two of them lies on the line that joins them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys, from_epoch_seconds
from demandspark.operators.chunks import null_safe_join, series_join, stage
from demandspark.operators.quantiles import quantile_columns
from demandspark.operators.rolling import Rolling, add_rolling
from demandspark.operators.spine import future_frame


def odd(n: float) -> int:
    """The least odd whole number that is not below ``n``."""
    whole = int(-(-n // 1))
    return whole + 1 - whole % 2


def _line_at_points(rows: DataFrame, ids: Sequence[str], window: int, jump: int, weight: str | None,
                    ahead: int) -> DataFrame:
    """``(ids, _point, _fit)``: the local line at each multiple of ``jump``.

    ``rows`` has _t (place on the grid) and _v. A point sees the ``window`` places nearest to
    it that the series has, which near an end lie on one side, weighted by the cubes of
    their distances. Points stand on both sides of every place up to ``ahead`` beyond an end.
    """
    ids = list(ids)
    ends = rows.groupBy(*ids).agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
    placed = series_join(rows.filter(F.col("_v").isNotNull()), ends, ids)
    t, half = F.col("_t"), (window - 1) // 2
    first = F.floor((F.greatest(t - (window - 1 + ahead), F.col("_lo") - ahead)) / F.lit(jump))
    last = F.ceil((F.least(t + (window - 1 + ahead), F.col("_hi") + ahead)) / F.lit(jump))
    sent = placed.withColumn("_point", F.explode(F.transform(F.sequence(first, last), lambda k: k * jump)))
    # the nearest ``window`` places start here; a shorter series is seen whole
    start = F.least(F.greatest(F.col("_point") - half, F.col("_lo")), F.greatest(F.col("_hi") - (window - 1), F.col("_lo")))
    stop = F.least(start + (window - 1), F.col("_hi"))
    short = F.greatest(F.lit(window) - (F.col("_hi") - F.col("_lo") + 1), F.lit(0)) / F.lit(2.0)
    reach = F.greatest(F.col("_point") - start, stop - F.col("_point")) + F.floor(short)
    x = (t - F.col("_point")).cast("double")
    share = F.try_divide(F.abs(x), reach)
    tricube = F.pow(1 - F.pow(share, 3), 3)
    w = F.when(share <= 0.001, F.lit(1.0)).when(share <= 0.999, tricube)
    sent = sent.filter((t >= start) & (t <= stop)).withColumn("_w", F.coalesce(w, F.when(reach == 0, F.lit(1.0)), F.lit(0.0)))
    if weight:
        sent = sent.withColumn("_w", F.col("_w") * F.col(weight))
    w, v = F.col("_w"), F.col("_v")
    sums = sent.filter("_w > 0").select(*ids, "_point", w, (w * x).alias("_wx"), (w * x * x).alias("_wxx"),
                                        (w * v).alias("_wv"), (w * x * v).alias("_wxv"), "_lo", "_hi")
    sums = sums.groupBy(*ids, "_point").agg(
        *[F.sum(c).alias(c) for c in ("_w", "_wx", "_wxx", "_wv", "_wxv")], F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    mean_x, mean_v = F.col("_wx") / F.col("_w"), F.col("_wv") / F.col("_w")
    spread = F.col("_wxx") / F.col("_w") - mean_x * mean_x
    # a line only where the places are spread out, else their mean
    wide = F.sqrt(F.greatest(spread, F.lit(0.0))) > (F.col("_hi") - F.col("_lo")) * 0.001
    slope = F.when(wide, (F.col("_wxv") / F.col("_w") - mean_x * mean_v) / spread).otherwise(0.0)
    return sums.select(*ids, "_point", (mean_v - slope * mean_x).alias("_fit"))


def _join_line(rows: DataFrame, points: DataFrame, ids: Sequence[str], jump: int, out: str) -> DataFrame:
    """The value on the line between the points before and after each row."""
    before = F.floor(F.col("_t") / F.lit(jump)) * jump
    left = points.withColumnRenamed("_fit", "_fit0")
    rows = null_safe_join(rows.withColumn("_point", before), left, [*ids, "_point"], "left")
    if jump == 1:
        return rows.withColumnRenamed("_fit0", out).drop("_point")
    right = points.select(*ids, (F.col("_point") - jump).alias("_point"), F.col("_fit").alias("_fit1"))
    rows = null_safe_join(rows, right, [*ids, "_point"], "left")
    share = (F.col("_t") - F.col("_point")) / F.lit(float(jump))
    on_line = F.col("_fit0") + (F.col("_fit1") - F.col("_fit0")) * share
    return rows.withColumn(out, F.when(share == 0, F.col("_fit0")).otherwise(on_line)).drop("_point", "_fit0", "_fit1")


def loess(df: DataFrame, keys: SeriesKeys, window: int, out: str = "smooth", value: str | None = None,
          jump: int = 1, weight: str | None = None) -> DataFrame:
    """Add the local line over the ``window`` nearest slots, weighted by distance (and ``weight``).

    Null values do not count and get a smooth value too. With ``jump`` above 1 lines are
    fitted at every so many slots and joined.
    """
    if window < 2 or jump < 1:
        raise ValueError("window must be at least 2 and jump at least 1")
    rows = df.withColumn("_t", keys.slot()).withColumn("_v", F.col(value or keys.target).cast("double"))
    found = _line_at_points(rows, keys.ids, window, jump, weight, 0)
    return _join_line(rows, found, keys.ids, jump, out).select(*df.columns, out)


def _season_of(left: DataFrame, keys: SeriesKeys, period: int, seasonal: int, weight: str | None) -> DataFrame:
    """Rows of ``left`` (ids, time, _left, ...) with ``_season``: smooth phases less their own level.

    Every phase is a series of cycles and is smoothed over ``seasonal`` of them, one cycle
    beyond each end too. What a moving average over the period leaves of that is no season.
    """
    ids = list(keys.ids)
    slot = keys.slot()
    phases = left.select(*ids, F.pmod(slot, F.lit(period)).alias("_phase"), F.floor(slot / F.lit(period)).alias("_t"),
                         F.col("_left").alias("_v"), *([weight] if weight else []))
    by_phase = [*ids, "_phase"]
    points = _line_at_points(phases, by_phase, seasonal, 1, weight, 1)
    ends = left.groupBy(*ids).agg(F.min(slot).alias("_lo"), F.max(slot).alias("_hi"))
    cycle = points.select(*ids, (F.col("_point") * period + F.col("_phase")).alias("_slot"), F.col("_fit").alias("_c"))
    cycle = series_join(cycle, ends, ids).filter(
        (F.col("_slot") >= F.col("_lo") - period) & (F.col("_slot") <= F.col("_hi") + period))
    # three means in a row, of which the whole frames count; the even ones lean to opposite sides
    around = SeriesKeys(ids=keys.ids, time="_when", target="_c", step=1, chunk=keys.chunk)
    level = cycle.select(*ids, from_epoch_seconds(F.col("_slot")).alias("_when"), F.col("_slot").alias("_place"), "_c", "_lo", "_hi")
    half = period // 2
    frames = [("_c", half, period - 1 - half), ("_m1", period - 1 - half, half), ("_m2", 1, 1)]
    for i, (value, before, after) in enumerate(frames, 1):
        level = add_rolling(level, around, [Rolling(f"_m{i}", "mean", before, after, before + after + 1)], value)
    level = level.withColumnRenamed("_place", "_slot")
    level = stage(level.select(*ids, F.col("_slot").alias("_t"), F.col("_m3").alias("_v"), "_c", "_lo", "_hi"))
    inside = level.filter((F.col("_t") >= F.col("_lo")) & (F.col("_t") <= F.col("_hi")))
    low_points = _line_at_points(inside.select(*ids, "_t", "_v"), ids, odd(period), max(1, period // 10), None, 0)
    low = _join_line(inside, low_points, ids, max(1, period // 10), "_low")
    season = low.select(*ids, F.col("_t").alias("_slot"), (F.col("_c") - F.col("_low")).alias("_season"))
    return null_safe_join(left.withColumn("_slot", slot), season, [*ids, "_slot"], "left").drop("_slot")


def robust_weights(df: DataFrame, keys: SeriesKeys, remainder: str, out: str = "_rho") -> DataFrame:
    """Weights that fall to 0 where the remainder is six times its median size or more."""
    size = df.withColumn("_size", F.abs(F.col(remainder)))
    middle = quantile_columns(size, keys.ids, "_size", {"_median": 0.5}, "linear")
    rows = series_join(size, middle, keys.ids, "left")
    share = F.try_divide(F.col("_size"), 6 * F.col("_median"))
    w = F.when(share <= 0.001, F.lit(1.0)).when(share <= 0.999, F.pow(1 - share * share, 2)).when(share.isNull(), F.lit(1.0))
    return rows.select(*df.columns, F.coalesce(w, F.lit(0.0)).alias(out))


def stl(df: DataFrame, keys: SeriesKeys, period: int, seasonal: int, value: str, inner: int = 2, robust: int = 0,
        trend: int | None = None) -> DataFrame:
    """Adds ``_season`` and ``_trend`` of one period by alternating smoothing of phases and of the rest.

    ``inner`` passes, repeated ``robust`` more times with weights by the size of the
    remainder. A series shorter than two periods has a null season and the trend alone.
    """
    trend = trend or odd(1.5 * period / (1 - 1.5 / seasonal))
    jump = max(1, trend // 10)
    rows, weight = stage(df.withColumn("_trend", F.lit(0.0))), None
    for outer in range(robust + 1):
        kept = [*df.columns, *([weight] if weight else [])]
        for _ in range(inner):
            left = rows.select(*kept, (F.col(value) - F.col("_trend")).alias("_left"))
            rest = stage(_season_of(left, keys, period, seasonal, weight).withColumn("_t", keys.slot())
                         .withColumn("_v", F.col(value) - F.coalesce("_season", F.lit(0.0))))
            points = _line_at_points(rest, keys.ids, trend, jump, weight, 0)
            rows = stage(_join_line(rest, points, keys.ids, jump, "_trend").select(*kept, "_season", "_trend"))
        if outer < robust:
            weight = "_rho"
            sized = rows.drop("_rho").withColumn("_r", F.col(value) - F.coalesce("_season", F.lit(0.0)) - F.col("_trend"))
            rows = stage(robust_weights(sized, keys, "_r").drop("_r"))
    return rows.drop("_rho")


def loess_decompose(df: DataFrame, keys: SeriesKeys, periods: Sequence[int], windows: Sequence[int] | None = None,
                    rounds: int = 2, inner: int = 2, robust: int = 0) -> DataFrame:
    """Adds ``trend``, ``seasonal_<p>`` per period and ``remainder``; they sum to the target.

    Seasons are found in turn, shortest first, each from what the others leave, ``rounds``
    times over. The i-th period is smoothed over 11, 15, 19, ... cycles unless ``windows`` says
    otherwise. A period of which the series has not two whole ones has no season: its
    column is 0. Needs a series on its grid without nulls.
    """
    pairs = sorted(zip(periods, windows or [11 + 4 * i for i in range(len(periods))]))
    ids, y = list(keys.ids), keys.target
    rows = df.select(*keys.key, F.col(y).cast("double").alias(y))
    names = [f"seasonal_{p}" for p, _ in pairs]
    rows = stage(rows.select("*", *[F.lit(0.0).alias(n) for n in names], F.lit(0.0).alias("trend")))
    span = rows.groupBy(*ids).agg((F.max(keys.slot()) - F.min(keys.slot()) + 1).alias("_span"))
    span = stage(span)
    longest = span.agg(F.max("_span")).first()[0] or 0
    usable = [(p, w) for p, w in pairs if longest >= 2 * p]
    for _ in range(rounds if len(usable) > 1 else 1):
        for p, w in usable:
            others = F.lit(0.0)
            for n in names:
                if n != f"seasonal_{p}":
                    others = others + F.col(n)
            seen = stl(rows.withColumn("_y", F.col(y) - others).drop("trend"), keys, p, w, "_y", inner, robust)
            long_enough = series_join(seen, span, ids).withColumn("_fits", F.col("_span") >= 2 * p)
            season = F.when(F.col("_fits"), F.coalesce("_season", F.lit(0.0))).otherwise(0.0)
            rows = stage(long_enough.select(*keys.key, y, *[season.alias(n) if n == f"seasonal_{p}" else F.col(n) for n in names],
                                            F.col("_trend").alias("trend")))
    if not usable:
        rows = loess(rows.drop("trend"), keys, odd(1.5 * pairs[0][0]), "trend", jump=max(1, pairs[0][0] // 10))
    rest = F.col(y) - F.col("trend")
    for n in names:
        rest = rest - F.col(n)
    return rows.select(*keys.key, y, "trend", *names, rest.alias("remainder"))


def loess_forecast(parts: DataFrame, keys: SeriesKeys, periods: Sequence[int], horizon: int, level: float = 0.9) -> DataFrame:
    """Last trend value plus each season as one period earlier, with a band from the remainder's quantiles."""
    parts = stage(parts)
    ids, tail = list(keys.ids), (1 - level) / 2
    last = parts.groupBy(*ids).agg(F.max_by("trend", F.col(keys.time)).alias("_trend"), F.max(keys.slot()).alias("_end"))
    band = quantile_columns(parts, ids, "remainder", {"_lo": tail, "_hi": 1 - tail}, "linear")
    out = series_join(future_frame(parts, keys, horizon), last, ids)
    out = series_join(out, band, ids, "left").withColumn("yhat", F.col("_trend"))
    recent = series_join(parts, last.select(*ids, "_end"), ids).withColumn("_at", keys.slot())
    for p in periods:
        # the season repeats its last whole period
        cycle = recent.filter(F.col("_at") > F.col("_end") - p).select(*ids, F.pmod("_at", F.lit(p)).alias("_phase"), F.col(f"seasonal_{p}").alias("_s"))
        out = null_safe_join(out.withColumn("_phase", F.pmod(keys.slot(), F.lit(p))), cycle, [*ids, "_phase"], "left")
        out = out.withColumn("yhat", F.col("yhat") + F.coalesce("_s", F.lit(0.0))).drop("_phase", "_s")
    return out.select(*keys.key, "horizon_step", "yhat", (F.col("yhat") + F.col("_lo")).alias("yhat_low"),
                      (F.col("yhat") + F.col("_hi")).alias("yhat_high"))
