"""Descriptive aggregates: null counts, means by calendar part, box plots, ACF, size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import series_join, with_halo
from demandspark.operators.quantiles import quantile_columns


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: name, nulls, rows. One pass over the table."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns])
    return one.select(F.inline(pairs), F.col("_rows").alias("n_rows"))


def mean_by(df: DataFrame, keys: SeriesKeys, part: Column, name: str, out: str = "mean_value") -> DataFrame:
    """Mean target per series and calendar part."""
    return df.groupBy(*keys.ids, part.alias(name)).agg(F.avg(keys.target).alias(out))


def month_mean(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    return mean_by(df, keys, F.trunc(keys.time, "month").cast("timestamp_ntz"), "month_start")


def day_mean(df: DataFrame, keys: SeriesKeys, start: str, end: str) -> DataFrame:
    """Daily means in the half-open range [start, end); the range reaches the scan."""
    t = F.col(keys.time)
    part = df.filter((t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz")))
    return mean_by(part, keys, F.to_date(t).cast("timestamp_ntz"), "day_start")


def weekday_mean(df: DataFrame, keys: SeriesKeys, year: int | None = None) -> DataFrame:
    """Mean per weekday, Monday = 1; a year is turned into a time range so that it prunes."""
    t = F.col(keys.time)
    if year is not None:
        df = df.filter((t >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
                       & (t < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
    return mean_by(df, keys, F.weekday(t) + 1, "weekday")


def box_summary(df: DataFrame, by: Sequence[str], value: str, multiplier: float = 1.5) -> DataFrame:
    """Five-number summary per group, whisker ends and number of outliers."""
    by = list(by)
    q = quantile_columns(df, by, value, {"q1": 0.25, "med": 0.5, "q3": 0.75}, "linear")
    width = F.lit(multiplier) * (F.col("q3") - F.col("q1"))
    q = q.withColumns({"_lo": F.col("q1") - width, "_hi": F.col("q3") + width})
    v = F.col(value)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    rows = df.select(*by, value).filter(v.isNotNull())
    return series_join(rows, q, by).groupBy(*by).agg(
        F.min(v).alias("min_value"), F.first("q1").alias("q1"), F.first("med").alias("med"),
        F.first("q3").alias("q3"), F.max(v).alias("max_value"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"), F.count(v).alias("n"),
    )


def autocorrelation(df: DataFrame, keys: SeriesKeys, lags: int = 50) -> DataFrame:
    """Rows ``(ids, lag, acf)`` for lag 0..lags of a grid series without gaps.

    One pass: the lagged values come from windows over chunks with a halo of
    ``lags`` rows and are summed at once, so only a few numbers per chunk leave a
    task. Deviations are taken from the series mean.
    """
    mean = df.groupBy(*keys.ids).agg(F.avg(keys.target).alias("_mean"))
    data = series_join(df.select(*keys.key, keys.target), mean, keys.ids)
    data = data.select(*keys.key, (F.col(keys.target) - F.col("_mean")).alias("_d"))
    rows = with_halo(data, keys, before=lags)
    over = f"over (partition by {', '.join(f'`{c}`' for c in keys.ids)}, _chunk order by _slot)"
    products = rows.selectExpr(*keys.ids, "_own", "_d * _d as _p0",
                               *[f"_d * lag(_d, {k}) {over} as _p{k}" for k in range(1, lags + 1)])
    sums = products.filter("_own").groupBy(*keys.ids).agg(
        *[F.expr(f"sum(_p{k}) as _p{k}") for k in range(lags + 1)])
    pairs = ", ".join(f"struct({k} as lag, try_divide(_p{k}, _p0) as acf)" for k in range(lags + 1))
    return sums.select(*keys.ids, F.expr(f"inline(array({pairs}))"))


def partial_autocorrelation(acf: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Durbin-Levinson recursion on the few rows per series of :func:`autocorrelation`."""
    import numpy as np

    ids = list(keys.ids)

    def solve(pdf):
        pdf = pdf.sort_values("lag")
        r = pdf["acf"].to_numpy(dtype=float)
        out = np.full(len(r), np.nan)
        out[0] = 1.0
        phi = np.zeros(0)
        for k in range(1, len(r)):
            top = r[k] - phi @ r[k - 1:0:-1] if k > 1 else r[1]
            bottom = 1.0 - phi @ r[1:k] if k > 1 else 1.0
            last = top / bottom if bottom else np.nan
            phi = np.append(phi - last * phi[::-1], last)
            out[k] = last
        return pdf.assign(pacf=out)[[*ids, "lag", "pacf"]]

    fields = [f for f in acf.schema.fields if f.name in ids]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + ["lag int", "pacf double"])
    return acf.groupBy(*ids).applyInPandas(solve, schema)


def table_size(df: DataFrame, path_col: str = "_metadata") -> DataFrame:
    """Rows, files and bytes of a file-backed table."""
    files = df.select(F.col(f"{path_col}.file_path").alias("p"), F.col(f"{path_col}.file_size").alias("b"))
    per_file = files.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("b"))
    return per_file.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.sum("b").alias("n_bytes"))
