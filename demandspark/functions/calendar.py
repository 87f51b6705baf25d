"""Calendar, cyclic and Fourier features of a timestamp."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.fill import null_at
from demandspark.operators.lags import add_lags

# Month numbers of the season with high variance.
HIGH_VOLATILITY_MONTHS = (11, 12, 1, 2, 3)
# Fixed values: (feature, column, period) of the cyclic encoding.
CYCLIC = (("hour", "decimal_hour", 24.0), ("weekday", "weekday_int", 7.0), ("dayofyear", "dayofyear_int", 365.0))
# Fixed values: (prefix, column, period, harmonics) of the Fourier terms.
FOURIER = (("d", "decimal_hour", 24.0, 5), ("y", "dayofyear_int", 365.25, 4))
FOURIER_PREFIXES = ("d_sin", "d_cos", "y_sin", "y_cos")
# Distances in 15-minute rows; a year is 52 whole weeks.
HISTORY_LAGS = {"y_yesterday": 96, "y_last_week": 672, "y_last_year": 34944}


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Parts of a timestamp; weekdays run from Monday = 1 to Sunday = 7."""
    return {
        "decimal_hour": F.hour(ts) + F.minute(ts) / F.lit(60.0),
        "weekday_int": F.weekday(ts) + 1,
        "dayofyear_int": F.dayofyear(ts),
        "month_int": F.month(ts),
        "dayofmonth_int": F.dayofmonth(ts),
    }


def cyclic_terms() -> dict[str, Column]:
    out = {}
    for name, col, period in CYCLIC:
        angle = F.col(col) * F.lit(2 * math.pi / period)
        out[f"sin_{name}"], out[f"cos_{name}"] = F.sin(angle), F.cos(angle)
    return out


def fourier_terms() -> dict[str, Column]:
    out = {}
    for prefix, col, period, harmonics in FOURIER:
        for k in range(1, harmonics + 1):
            angle = F.col(col) * F.lit(2 * math.pi * k / period)
            out[f"{prefix}_sin_k{k}"], out[f"{prefix}_cos_k{k}"] = F.sin(angle), F.cos(angle)
    return out


def is_high_volatility(ts: Column) -> Column:
    return F.month(ts).isin(*HIGH_VOLATILITY_MONTHS)


def add_calendar(df: DataFrame, keys: SeriesKeys, candidate: bool = False) -> DataFrame:
    """Baseline calendar and cyclic columns; ``candidate`` adds month, day, season flag and Fourier terms."""
    parts = calendar_parts(F.col(keys.time))
    if not candidate:
        parts = {k: parts[k] for k in ("decimal_hour", "weekday_int", "dayofyear_int")}
    out = df.withColumns(parts).withColumns(cyclic_terms())
    if candidate:
        out = out.withColumns({"is_high_volatility_season": is_high_volatility(F.col(keys.time))})
        out = out.withColumns(fourier_terms())
    return out


def time_of_day(ts: Column) -> Column:
    """Seconds since midnight."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def by_prefix(df: DataFrame, prefixes: Sequence[str] = FOURIER_PREFIXES) -> list[str]:
    """Names of the columns that start with one of the prefixes."""
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def baseline_features(df: DataFrame, keys: SeriesKeys, bad_times: Sequence[datetime] = (),
                      lags: dict[str, int] = HISTORY_LAGS) -> DataFrame:
    """Known bad values to null, calendar columns, then lags of what is left."""
    return add_lags(add_calendar(null_at(df, keys, bad_times), keys), keys, lags)


def candidate_features(train: DataFrame, test: DataFrame, keys: SeriesKeys,
                       bad_times: Sequence[datetime] = ()) -> tuple[DataFrame, DataFrame]:
    """Candidate columns on both parts; bad values are nulled in the training part only."""
    return (
        null_at(add_calendar(train, keys, candidate=True), keys, bad_times),
        add_calendar(test, keys, candidate=True),
    )


def no_gaps(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Null and NaN features to 0, and booleans to numbers, as models want them."""
    types = dict(df.dtypes)
    return df.withColumns({
        f: F.coalesce(F.col(f).cast("double") if types[f] == "boolean"
                      else F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
        for f in features
    })


def exogenous_names() -> list[str]:
    """Exogenous columns of the candidate models besides the Fourier terms."""
    return [
        "decimal_hour", "weekday_int", "dayofyear_int", "month_int", "dayofmonth_int",
        "sin_hour", "cos_hour", "sin_weekday", "cos_weekday", "sin_dayofyear", "cos_dayofyear",
        "is_high_volatility_season",
    ]
