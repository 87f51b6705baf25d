import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators import chunks, dedup, lags, rolling, spine
from tests.conftest import T0, column, slots


def gap_rows(df, keys, **kw):
    rows = sorted(spine.gap_blocks(df, keys, **kw).collect(), key=lambda r: (r["unique_id"], r["missing_start"]))
    return list(zip(slots(rows, "missing_start"), slots(rows, "missing_end"), [r["missing_points"] for r in rows]))


def test_gap_blocks(series):
    df, k = series({"a": {i: 1 for i in (0, 1, 4, 5, 9)}})
    assert gap_rows(df, k) == [(2, 3, 2), (6, 8, 3)]


def test_no_gap_one_row_and_empty(series):
    df, k = series({"a": [1, 2, 3], "b": [1]})
    assert gap_rows(df, k) == []
    assert gap_rows(df.filter("false"), k) == []
    assert spine.insert_missing(df.filter("false"), k).count() == 0


def test_gap_blocks_of_nulls_reach_both_ends(series):
    df, k = series({"a": [None, None, 3, None, 5, None]})
    assert gap_rows(df, k, null_values=True) == [(0, 1, 2), (3, 3, 1), (5, 5, 1)]


def test_insert_missing_is_regular_and_keeps_rows(series):
    have = {i: i * 10 for i in (0, 3, 4, 11)}
    df, k = series({"a": have, "b": {5: 1, 6: None}})
    got = column(spine.insert_missing(df, k))
    assert got["a"] == [have.get(i) for i in range(12)]
    assert got["b"] == [1.0, None]


def test_present_plus_missing_is_expected(series):
    df, k = series({"a": {i: 1 for i in random.Random(1).sample(range(50), 20)}})
    row = spine.completeness(df, k).first()
    blocks = sum(n for _, _, n in gap_rows(df, k))
    assert row["present"] + blocks == row["expected"]
    assert spine.missing_slots(df, k).count() == blocks == row["missing"]


def test_keep_first_and_last(spark):
    rows = [("a", T0, 2, 20.0), ("a", T0, 1, 10.0), ("a", T0, 3, None)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, src int, y double")
    assert dedup.keep_one(df, ["unique_id", "ds"], ["src"]).first()["y"] == 10.0
    assert dedup.keep_one(df, ["unique_id", "ds"], ["src"], "last").first()["src"] == 3


def test_order_violations(spark, series):
    _, k = series({"a": [1]}, chunk=2)
    rows = [("a", i, T0.replace(hour=h)) for i, h in enumerate([0, 1, 3, 2, 2, 5])]
    df = spark.createDataFrame(rows, "unique_id string, n long, ds timestamp_ntz")
    row = dedup.order_violations(df, k, "n").first()
    assert (row["violations"], row["is_sorted"]) == (1, False)


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_chunk_length_does_not_matter(spark, series, partitions):
    """Every ordered operator gives the same for tiny chunks and for one chunk."""
    from demandspark.operators import fill, profile, rolling

    rng = random.Random(3)
    values = {n: [rng.choice([None, rng.random() * 100]) if i % 37 < 30 else None for i in range(150)] for n in "ab"}
    full = {n: [rng.random() * 100 for _ in range(150)] for n in "ab"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        results = []
        for chunk in (7, 100000):
            df, k = series(values, chunk=chunk)
            whole, _ = series(full, chunk=chunk)
            one = {
                "ffill": column(fill.forward_fill(df, k)), "bfill": column(fill.backward_fill(df, k)),
                "both": column(fill.fill_both(df, k)), "line": column(fill.interpolate(df, k)),
                "gaps": gap_rows(df, k, null_values=True),
                "trend": column(rolling.rolling_trend(df, k, 5), "macro_trend"),
                "std": column(rolling.rolling_volatility(whole, k, 6), "rolling_volatility"),
                "wide": column(rolling.rolling_trend(df, k, 80), "macro_trend"),
                "wide_std": column(rolling.rolling_volatility(whole, k, 90), "rolling_volatility"),
                "no": column(chunks.row_position(chunks.with_chunk(df, k), k), "row_no"),
                "prev": column(lags.time_since_previous(df.filter("y is not null"), k), "seconds_since_previous"),
                "acf": sorted((r[0], r[1], r[2]) for r in profile.autocorrelation(whole, k, 6).collect()),
                "lag": column(lags.add_lags(df, k, {"l": 9}), "l"),
                "ewm": column(rolling.add_ewm(whole, k, 0.5, "e"), "e"),
            }
            results.append(one)
        for name in results[0]:
            assert flat(results[0][name]) == pytest.approx(flat(results[1][name]), nan_ok=True), name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def flat(x):
    if isinstance(x, dict):
        return [float("nan") if v is None else v for k in sorted(x) for v in x[k]]
    return [v for t in x for v in t if not isinstance(v, str)]


def test_near_lags_equal_time_lags_on_a_grid(series):
    df, k = series({"a": list(range(20)), "b": [None, 1, 2] * 5}, chunk=8)
    a = column(lags.add_lags(df, k, {"l1": 1, "l7": 7}), "l7")
    b = column(lags.add_near_lags(df, k, {"l1": 1, "l7": 7}), "l7")
    assert a == b and a["a"][:8] == [None] * 7 + [0.0]


def test_lag_by_time_differs_from_row_shift_before_the_spine(series):
    df, k = series({"a": {0: 1, 1: 2, 3: 4}})
    assert column(lags.add_lags(df, k, {"l": 1}), "l")["a"] == [None, 1.0, None]
    assert column(lags.add_near_lags(df, k, {"l": 1}), "l")["a"] == [None, 1.0, 2.0]


def test_lags_keep_other_columns(series):
    df, k = series({"a": [1, 2, None]})
    df = df.withColumn("tag", F.lit("x")).withColumn("ok", F.col("y").isNull())
    rows = lags.add_lags(df, k, {"l": 1}).orderBy("ds").collect()
    assert [(r["tag"], r["ok"], r["l"]) for r in rows] == [("x", False, None), ("x", False, 1.0), ("x", True, 2.0)]


def test_undo_seasonal_difference(series):
    rng = random.Random(5)
    df, k = series({n: [rng.random() for _ in range(40)] for n in "ab"}, chunk=6)
    cut = F.col("ds") < F.lit(T0).cast("timestamp_ntz") + F.expr("interval 300 minutes")
    diffs = lags.seasonal_difference(df, k, 8).filter(~cut)
    back = column(lags.undo_seasonal_difference(diffs.drop("y"), df.filter(cut), k, 8), "restored")
    want = column(df.filter(~cut))
    for n in "ab":
        assert back[n] == pytest.approx(want[n])


def test_many_series_do_without_a_broadcast(spark, series):
    """With no room for a broadcast the result is the same."""
    from demandspark.operators import outliers, split

    df, k = series({n: [1, 2, 3, 4, 90 + i] for i, n in enumerate("abcdef")})
    wide = column(outliers.null_outliers(split.train_part(df, k, 0), k, 0.1))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        assert column(outliers.null_outliers(split.train_part(df, k, 0), k, 0.1)) == wide and wide["a"][-1] is None
    finally:
        spark.conf.set(limit, before)


@pytest.mark.parametrize("width", [3, 64, 65, 200])
def test_a_nan_stays_in_its_frames(series, width):
    """Narrow and wide frames alike: only frames that hold the NaN are NaN, and constant stretches have no spread."""
    values = [1e6 * (i % 7) for i in range(150)] + [float("nan")] + [5.0] * 450
    df, k = series({"a": values}, chunk=256)
    specs = [rolling.trailing("m", "mean", width), rolling.trailing("s", "std", width), rolling.centred("c", "mean", width)]
    rows = sorted(rolling.add_rolling(df, k, specs).collect(), key=lambda r: r["ds"])
    for i, r in enumerate(rows):
        frame = values[max(0, i - width + 1):i + 1]
        if len(frame) < width:
            assert r["m"] is None and r["s"] is None
        elif any(math.isnan(v) for v in frame):
            assert math.isnan(r["m"]) and math.isnan(r["s"])
        else:
            assert r["m"] == pytest.approx(sum(frame) / width) and (set(frame) != {5.0} or r["s"] == 0.0)
        around = values[max(0, i - width // 2):i + (width - 1) // 2 + 1]
        want = sum(around) / len(around)
        assert math.isnan(want) == math.isnan(r["c"]) and (math.isnan(want) or r["c"] == pytest.approx(want))


def test_rows_inside_one_slot_keep_their_order(spark):
    t = [datetime(2024, 1, 1, 0, m) for m in (10, 1, 5, 40)]
    df = spark.createDataFrame([("a", x, 1.0) for x in t], "unique_id string, ds timestamp_ntz, y double")
    k = SeriesKeys(step=900, chunk=4)
    got = sorted((r["ds"].minute, r["seconds_since_previous"]) for r in lags.time_since_previous(df, k).collect())
    assert got == [(1, None), (5, 240), (10, 300), (40, 1800)]
    gaps = spine.gap_blocks(df, k).collect()
    assert [(g["missing_start"].minute, g["missing_points"]) for g in gaps] == [(25, 1)]


def test_repeated_rows_all_keep_their_lags(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 15)
    rows = [("a", t0, 1.0, "p"), ("a", t0, 2.0, "q"), ("a", t1, 3.0, "r"), ("a", t1, 3.0, "r")]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double, note string")
    got = lags.add_lags(df, SeriesKeys(step=900), {"l": 1}).collect()
    assert sorted((r["y"], r["note"], r["l"]) for r in got if r["l"]) == [(3.0, "r", 2.0)] * 2 and len(got) == 4


def test_null_series_ids_are_a_series(spark):
    from demandspark.operators import split

    rows = [(None, datetime(2024, 1, 1, 0, m), float(m)) for m in (0, 15, 45)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")
    k = SeriesKeys(step=900)
    grid = spine.insert_missing(df, k)
    assert sorted((r["ds"].minute, r["y"]) for r in grid.collect()) == [(0, 0.0), (15, 15.0), (30, None), (45, 45.0)]
    assert split.test_part(df, k, 1).count() == 1 and split.train_part(df, k, 1).count() == 2
