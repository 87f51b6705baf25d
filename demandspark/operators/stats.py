"""Unit-root tests and Box-Cox, from sums that Spark computes in one or two passes."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import chunk_window, null_safe_join, series_join, with_halo
from demandspark.sources.tables import cut_lineage

# MacKinnon (1994) response surface for the t statistic with a
# constant: limits of validity, then coefficients by rising power.
TAU_MIN, TAU_STAR, TAU_MAX = -18.83, -1.61, 2.74
TAU_SMALL_P = (2.1659, 1.4412, 0.038269)
TAU_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def unit_root_p_value(tau: float) -> float:
    """Approximate p-value of a unit-root t statistic (constant, no trend)."""
    if math.isnan(tau):
        return math.nan
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    coefficients = TAU_SMALL_P if tau <= TAU_STAR else TAU_LARGE_P
    z = sum(c * tau ** i for i, c in enumerate(coefficients))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _id_fields(df: DataFrame, keys: SeriesKeys) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keys.ids)


def _gram(columns: Sequence[str]) -> list:
    """Sums of all products, upper triangle row by row, as one array column."""
    return [F.expr(f"sum({a} * {b})") for i, a in enumerate(columns) for b in columns[i:]]


def _square(flat: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = flat
    return out + np.triu(out, 1).T


def dickey_fuller(df: DataFrame, keys: SeriesKeys, max_lag: int | None = None,
                  alpha: float = 0.05) -> DataFrame:
    """Augmented Dickey-Fuller test with constant; lag order by least AIC.

    ``(ids, statistic, p_value, lag, n, is_stationary)`` for a grid series
    without gaps. One pass sums the products of the regressors; each series is
    then one row of (max_lag+3)^2/2 numbers, solved in a task. All orders are
    compared on the rows that have ``max_lag`` differences before them. By default
    ``max_lag`` grows with the fourth root of the length of the longest series.
    """
    y = keys.target
    if max_lag is None:
        longest = df.groupBy(*keys.ids).agg(F.count(y).alias("n")).agg(F.max("n")).first()[0] or 0
        max_lag = max(1, min(math.ceil(12 * (longest / 100) ** 0.25), longest // 2 - 2))
    w = chunk_window(keys)
    rows = with_halo(df.select(*keys.key, y), keys, before=max_lag + 2)
    rows = rows.select(*keys.key, "_slot", "_chunk", "_own", y, F.lag(y).over(w).alias("_level"))
    rows = rows.withColumn("_d", F.col(y) - F.col("_level"))
    cols = ["_c", "_level", *[f"_d{k}" for k in range(1, max_lag + 1)], "_d"]
    lagged = rows.select(
        *keys.ids, "_own", "_level", "_d", F.lit(1.0).alias("_c"),
        *[F.lag("_d", k).over(w).alias(f"_d{k}") for k in range(1, max_lag + 1)],
    ).filter("_own").na.drop(subset=cols)
    sums = lagged.groupBy(*keys.ids).agg(F.array(*_gram(cols)).alias("g"), F.count(F.lit(1)).alias("n"))
    ids = list(keys.ids)

    def solve(batches):
        for pdf in batches:
            found = []
            for flat, n in zip(pdf["g"], pdf["n"]):
                full = _square(np.asarray(flat, dtype=float), max_lag + 3)
                best = None
                for p in range(max_lag + 1):
                    at = list(range(p + 2))
                    if n <= len(at) + 1:
                        continue
                    xx, xy = full[np.ix_(at, at)], full[at, -1]
                    beta = np.linalg.lstsq(xx, xy, rcond=None)[0]
                    rss = max(full[-1, -1] - beta @ xy, 0.0)
                    if rss <= 0:
                        continue
                    aic = n * math.log(rss / n) + 2 * len(at)
                    var = rss / (n - len(at)) * np.linalg.pinv(xx)[1, 1]
                    if var > 0 and (best is None or aic < best[0]):
                        best = (aic, beta[1] / math.sqrt(var), p)
                found.append((best[1], best[2]) if best else (math.nan, -1))
            stat = np.array([f[0] for f in found], dtype=float)
            p_value = np.array([unit_root_p_value(s) for s in stat], dtype=float)
            yield pdf[ids].assign(statistic=stat, p_value=p_value, lag=[f[1] for f in found], n=pdf["n"],
                                  is_stationary=p_value < alpha)

    return sums.mapInPandas(solve, _id_fields(df, keys)
                            + ", statistic double, p_value double, lag int, n bigint, is_stationary boolean")


def phillips_perron(df: DataFrame, keys: SeriesKeys, lags: int = 96, alpha: float = 0.05) -> DataFrame:
    """Phillips-Perron tau test with constant; Bartlett weights over ``lags``.

    First pass: sums of the regression of a value on the one before. Second
    pass: autocovariances of its residuals, by windows over chunks with a halo.
    The correction is then plain column arithmetic.
    """
    y = keys.target
    pairs = with_halo(df.select(*keys.key, y), keys, before=1)
    pairs = pairs.select(*keys.key, "_own", y, F.lag(y).over(chunk_window(keys)).alias("_x")).filter("_own")
    pairs = pairs.drop("_own").na.drop(subset=[y, "_x"])
    x, v = F.col("_x"), F.col(y)
    fit = pairs.groupBy(*keys.ids).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(x).alias("_mx"), F.avg(v).alias("_my"),
        F.var_pop(x).alias("_vx"), F.covar_pop(x, v).alias("_cxy"))
    fit = fit.withColumn("_rho", F.try_divide(F.col("_cxy"), F.col("_vx")))
    res = series_join(pairs, fit.select(*keys.ids, "_mx", "_my", "_rho"), keys.ids)
    res = res.select(*keys.key, (v - F.col("_my") - F.col("_rho") * (x - F.col("_mx"))).alias("_u"))
    rows = with_halo(res, keys, before=lags)
    over = f"over (partition by {', '.join(f'`{c}`' for c in keys.ids)}, _chunk order by _slot)"
    # Bartlett weights: twice the autocovariance at each lag, falling to zero
    weighted = " + ".join(
        f"{2 * (1 - k / (lags + 1))!r}D * coalesce(lag(_u, {k}) {over}, 0D)" for k in range(1, lags + 1))
    terms = rows.selectExpr(*keys.ids, "_own", "_u * _u as _g0", f"_u * ({weighted}) as _gk")
    cov = terms.filter("_own").groupBy(*keys.ids).agg(F.sum("_g0").alias("_g0"), F.sum("_gk").alias("_gk"))
    n = F.col("_n")
    both = null_safe_join(fit, cov, keys.ids)
    gamma0 = F.col("_g0") / n
    lam2 = (F.col("_g0") + F.col("_gk")) / n
    s2 = F.col("_g0") / (n - 2)
    sigma = F.sqrt(s2 / (n * F.col("_vx")))
    tau = F.sqrt(gamma0 / lam2) * (F.col("_rho") - 1) / sigma - F.lit(0.5) * (lam2 - gamma0) / F.sqrt(lam2) * (
        n * sigma / F.sqrt(s2))
    stat = both.select(*keys.ids, tau.alias("statistic"), n.alias("n"))
    ids = list(keys.ids)

    def p_values(batches):
        for pdf in batches:
            p = np.array([unit_root_p_value(float(s)) if s is not None else math.nan for s in pdf["statistic"]])
            yield pdf[[*ids, "statistic", "n"]].assign(p_value=p, is_stationary=p < alpha)

    return stat.mapInPandas(p_values, _id_fields(df, keys)
                            + ", statistic double, n bigint, p_value double, is_stationary boolean")


def boxcox(value, lam):
    """Box-Cox transform of a positive column."""
    return F.when(F.abs(lam) < 1e-12, F.log(value)).otherwise((F.pow(value, lam) - 1) / lam)


def _transform_variance(value, lam):
    """Variance of the transform; the constant part is left out so as not to drown small powers."""
    near_zero = F.abs(lam) < 1e-12
    powered = F.var_pop(F.when(near_zero, F.log(value)).otherwise(F.pow(value, lam)))
    return powered / F.max(F.when(near_zero, F.lit(1.0)).otherwise(lam * lam))


def boxcox_likelihood(df: DataFrame, keys: SeriesKeys, lambdas: Sequence[float]) -> DataFrame:
    """Profile log likelihood ``(ids, lambda, log_likelihood)`` on a grid.

    The grid multiplies rows inside the task only: sums are combined before
    anything is shuffled. Values must be positive; others are left out.
    """
    v = F.col(keys.target)
    rows = df.filter(v > 0).select(*keys.ids, v.alias("_v"), F.explode(
        F.array(*[F.lit(float(x)) for x in lambdas])).alias("lambda"))
    got = rows.groupBy(*keys.ids, "lambda").agg(
        _transform_variance(F.col("_v"), F.col("lambda")).alias("_var"),
        F.sum(F.log("_v")).alias("_logs"), F.count(F.lit(1)).alias("_n"))
    likelihood = (F.col("lambda") - 1) * F.col("_logs") - F.col("_n") / 2 * F.log("_var")
    return got.filter("_var > 0").select(*keys.ids, "lambda", likelihood.alias("log_likelihood"))


def boxcox_lambda(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Best lambda per series: a grid by 0.1 from -2 to 2, then by 0.01 around the best.

    The grid grows by 2 on a side for as long as a series has its best there. Values
    that are not positive take no part.
    """
    lo, hi = -20, 20
    while True:
        grid = [round(0.1 * i, 10) for i in range(lo, hi + 1)]
        coarse = cut_lineage(boxcox_likelihood(df, keys, grid).groupBy(*keys.ids).agg(
            F.max_by("lambda", F.struct("log_likelihood", -F.col("lambda"))).alias("_l0")))
        least, most = coarse.agg(F.min("_l0"), F.max("_l0")).first()
        if least is None or (least > grid[0] and most < grid[-1]):
            break
        lo, hi = lo - 20 * (least == grid[0]), hi + 20 * (most == grid[-1])
    v = F.col(keys.target)
    near = series_join(df.filter(v > 0).select(*keys.key, keys.target), coarse, keys.ids)
    near = near.select(*keys.ids, v.alias("_v"), F.explode(F.transform(
        F.sequence(F.lit(-10), F.lit(10)), lambda i: F.round(F.col("_l0") + i * F.lit(0.01), 10))).alias("lambda"))
    got = near.groupBy(*keys.ids, "lambda").agg(
        _transform_variance(F.col("_v"), F.col("lambda")).alias("_var"),
        F.sum(F.log("_v")).alias("_logs"), F.count(F.lit(1)).alias("_n")).filter("_var > 0")
    likelihood = (F.col("lambda") - 1) * F.col("_logs") - F.col("_n") / 2 * F.log("_var")
    return got.groupBy(*keys.ids).agg(
        F.max_by("lambda", F.struct(likelihood, -F.col("lambda"))).alias("best_lambda"),
        F.max(likelihood).alias("log_likelihood"))


def boxcox_transform(df: DataFrame, keys: SeriesKeys, out: str = "y_boxcox") -> DataFrame:
    """Adds the transform with the fitted lambda and ``y_log`` = log(1 + y)."""
    best = boxcox_lambda(df, keys).select(*keys.ids, F.col("best_lambda").alias("_l"))
    joined = series_join(df, best, keys.ids, "left")
    v = F.col(keys.target)
    return joined.select(*df.columns, F.log1p(v).alias("y_log"),
                         F.when(v > 0, boxcox(v, F.col("_l"))).alias(out))


# Functions sent to tasks carry this module's code along, so that executors need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
