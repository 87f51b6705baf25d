"""Registered queries: one per operator, over the given tables.

Doubles are rounded to six places at the end, as in the SQL they are checked with.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import (
    EVENTS, ORDERS, base, daily_orders, dashboard_pages, filled, floor_time, listing_pages, order_sheets,
    regular, table, tidy,
)
from demandspark.functions import calendar as cal
from demandspark.functions import scalar
from demandspark.operators import contracts as con
from demandspark.operators import decompose, dedup, drift, fill, lags, loess, metrics, naive, outliers, profile
from demandspark.operators import quantiles, rolling, select, spine, split, stats, trees
from demandspark.operators.chunks import row_position, running_sum, stage, with_chunk
from demandspark.operators.impute import ImputeConfig, impute_series, imputed_count
from demandspark.plans import runs
from demandspark.plans.config import RunConfig
from demandspark.sources import grid, pages, tables
from demandspark.streaming import jobs

K = EVENTS
BAD_TIMES = (datetime(2024, 1, 10, 12, 0), datetime(2024, 1, 20, 6, 15))
SEASON, WEEK, HORIZON, TEST_DAYS = 96, 672, 96, 14
PERIODS = [SEASON, WEEK, 20160]
N_TEST = HORIZON * TEST_DAYS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded (and -0.0 as 0.0); other columns unchanged.

    A mean of two-digit values often ends in exactly 5 after the last digit; it is
    moved off that edge, so that the last bit of a sum does not decide.
    """
    return df.select(*[tidy(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def parts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return split.split_by_horizon(filled(s, d), K, HORIZON, TEST_DAYS)


def predictions(train: DataFrame) -> DataFrame:
    """Daily and weekly seasonal naive forecasts and their blend, in long form."""
    day = naive.seasonal_naive(train, K, SEASON, N_TEST).withColumn("model", F.lit("naive_day"))
    week = naive.seasonal_naive(train, K, WEEK, N_TEST).withColumn("model", F.lit("naive_week"))
    both = day.unionByName(week)
    return both.unionByName(metrics.blend(both, K, ["naive_day", "naive_week"], "naive_blend"))


# ---- time axis -------------------------------------------------------------


@query
def spine_quarter_hour(s, d):
    return regular(s, d)


@query
def missing_slots(s, d):
    return spine.missing_slots(base(s, d), K)


@query
def gap_blocks(s, d):
    return spine.gap_blocks(base(s, d), K)


@query
def gap_blocks_null_values(s, d):
    """Slots with a value above 100 count as missing here, so runs can touch both ends."""
    high = regular(s, d).withColumn("y", F.when(F.col("y") <= 20, F.col("y")))
    return spine.gap_blocks(high, K, null_values=True)


@query
def completeness(s, d):
    return spine.completeness(base(s, d), K)


@query
def time_since_previous(s, d):
    return lags.time_since_previous(base(s, d), K)


@query
def order_violations(s, d):
    """Are events in time order when read by id, per type?"""
    return dedup.order_violations(table(s, d, "events"), K, "event_id")


@query
def gap_block_ids(s, d):
    """Running number of the gap before each present slot (flag and running sum)."""
    gaps = lags.time_since_previous(base(s, d), K)
    flagged = gaps.withColumn("new_block", (F.coalesce("seconds_since_previous", F.lit(0)) > 900).cast("bigint"))
    return running_sum(with_chunk(flagged, K), K, "new_block", "block_id").select("event_type", "ts", "block_id")


@query
def row_positions(s, d):
    return row_position(with_chunk(base(s, d), K), K).select("event_type", "ts", "row_no")


@query
def future_frame(s, d):
    return spine.future_frame(base(s, d), K, HORIZON)


# ---- duplicates ------------------------------------------------------------


def _by_minute(s, d):
    e = table(s, d, "events")
    return e.select("event_type", floor_time(F.col("ts"), 3600).alias("ts"), "event_id", "user_id", "value")


@query
def dedup_first(s, d):
    return dedup.keep_first(_by_minute(s, d), K, ["event_id"])


@query
def dedup_last(s, d):
    return dedup.keep_last(_by_minute(s, d), K, ["event_id"])


@query
def full_duplicates(s, d):
    return dedup.full_duplicates(table(s, d, "lineitem").select("l_partkey", "l_quantity", "l_returnflag", "l_tax"))


# ---- features --------------------------------------------------------------


@query
def calendar_features(s, d):
    out = cal.add_calendar(base(s, d), K)
    t = F.col("ts")
    return rounded(out.select(
        "*", F.month(t).alias("month_int"), F.dayofmonth(t).alias("dayofmonth_int"), F.year(t).alias("year_int"),
        F.date_format(t, "EEEE").alias("day_name"), cal.time_of_day(t).alias("second_of_day"),
        cal.is_high_volatility(t).alias("is_high_volatility_season")))


@query
def fourier_features(s, d):
    out = cal.add_calendar(base(s, d), K, candidate=True)
    return rounded(out.select("event_type", "ts", *cal.by_prefix(out)))


@query
def season_flag(s, d):
    """High-variance season as 0/1 and log of the value, on the daily series."""
    return rounded(daily_orders(s, d).select(
        "o_orderstatus", "ts", cal.is_high_volatility(F.col("ts")).cast("tinyint").alias("is_high_variance_season"),
        F.log1p("y").alias("y_log")))


@query
def lag_features(s, d):
    return rounded(lags.add_lags(regular(s, d), K, cal.HISTORY_LAGS))


@query
def lag_year_daily(s, d):
    return rounded(lags.add_lags(spine.insert_missing(daily_orders(s, d), ORDERS), ORDERS,
                                 {"y_last_week": 7, "y_last_year": 364}))


@query
def lag_pairs(s, d):
    return rounded(lags.add_near_lags(regular(s, d), K, {"lag_1": 1, "lag_2": 2, "lag_97": 97}))


@query
def baseline_features(s, d):
    return rounded(cal.baseline_features(regular(s, d), K, BAD_TIMES))


@query
def known_bad_to_null(s, d):
    return fill.null_at(base(s, d), K, BAD_TIMES)


@query
def flag_update(s, d):
    flagged = regular(s, d).withColumn("is_imputed", F.when(F.col("y").isNull(), True))
    return fill.mark_flag(flagged, K, BAD_TIMES)


@query
def rolling_trend(s, d):
    return rounded(rolling.rolling_trend(regular(s, d), K, WEEK))


@query
def rolling_volatility(s, d):
    return rounded(rolling.rolling_volatility(filled(s, d), K, WEEK))


@query
def lag_transforms(s, d):
    out = trees.lag_frame(filled(s, d), K)
    return rounded(out.select("event_type", "ts", F.col("_z").alias("z"), *trees.LAG_FEATURES))


@query
def seasonal_difference(s, d):
    return rounded(lags.seasonal_difference(regular(s, d), K, SEASON, drop_incomplete=True))


@query
def difference_restored(s, d):
    """Differences of the test part, added up again from the training part."""
    whole = filled(s, d)
    train, _ = split.split_by_horizon(whole, K, HORIZON, TEST_DAYS)
    later = split.test_part(lags.seasonal_difference(whole, K, SEASON), K, N_TEST).drop("y")
    return rounded(lags.undo_seasonal_difference(later, train, K, SEASON).select("event_type", "ts", "restored"), 4)


# ---- filling ---------------------------------------------------------------


@query
def forward_fill(s, d):
    return fill.forward_fill(regular(s, d), K)


@query
def backward_fill(s, d):
    return fill.backward_fill(regular(s, d), K)


@query
def repair_fill(s, d):
    """Outliers nulled, then dropped, regular grid, filled both ways."""
    return fill.repair(outliers.null_outliers(base(s, d), K), K)


@query
def interpolate(s, d):
    return rounded(fill.interpolate(regular(s, d), K))


@query
def outlier_interpolate(s, d):
    return rounded(fill.outlier_interpolate(filled(s, d), K, BAD_TIMES))


@query
def seasonal_median_impute(s, d):
    return rounded(fill.seasonal_median_impute(base(s, d), K, WEEK))


@query
def zero_fill(s, d):
    return fill.zero_fill(regular(s, d), ["y"])


@query
def drop_incomplete_rows(s, d):
    return lags.add_lags(regular(s, d), K, {"y_yesterday": 96}).na.drop("any")


# ---- quantiles and fences --------------------------------------------------


@query
def iqr_fence(s, d):
    """Fences of the line prices by return flag and the number of rows outside."""
    rows = table(s, d, "lineitem").select("l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber")
    k = K.with_(ids=("l_returnflag",), time="l_orderkey", target="l_extendedprice")
    limits = stage(outliers.iqr_bounds(rows, k.ids, k.target, 0.5))  # read twice
    marked = outliers.null_outliers(rows, k, limits=limits, flag="outside")
    counts = marked.groupBy("l_returnflag").agg(
        F.count_if("outside").alias("n_outside"), F.count("l_extendedprice").alias("n_inside"))
    return rounded(limits.join(counts, "l_returnflag"))


@query
def quantiles_three_ways(s, d):
    rows = table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    out = None
    for mode in ("nearest", "disc", "linear"):
        q = quantiles.exact_quantiles(rows, ["l_returnflag", "l_linestatus"], "l_extendedprice",
                                      [0.05, 0.25, 0.5, 0.75, 0.95], mode).withColumn("mode", F.lit(mode))
        out = q if out is None else out.unionByName(q)
    return rounded(out)


@query
def quantiles_approximate(s, d):
    """Whether the sketch's values have their rank, up to the stated error."""
    rows, ids, v = table(s, d, "lineitem"), ["l_returnflag"], "l_extendedprice"
    found = stage(quantiles.approx_quantiles(rows, ids, v, [0.25, 0.75]))
    ranks = quantiles.cumulative_counts(rows, found.withColumnRenamed("value", v), ids, v)
    n, rank = F.col("n_reference"), F.col("q") * F.col("n_reference")
    error = n / quantiles.ACCURACY + 1
    ok = (F.col("below") <= rank + error) & (F.col("at_or_below") >= rank - error)
    return found.withColumnRenamed("value", v).join(ranks, [*ids, v]).select(*ids, "q", ok.alias("within"))


@query
def null_outliers(s, d):
    return outliers.null_outliers(base(s, d), K, flag="is_outlier")


# ---- splits and folds ------------------------------------------------------


@query
def train_split(s, d):
    return split.train_part(regular(s, d), K, N_TEST)


@query
def test_split(s, d):
    return split.test_part(regular(s, d), K, N_TEST)


@query
def tuning_split(s, d):
    """Sizes of the parts when the last day is held out."""
    r = regular(s, d)
    held = split.test_part(r, K, HORIZON).withColumn("part", F.lit("held"))
    rest = split.train_part(r, K, HORIZON).withColumn("part", F.lit("fit"))
    return held.unionByName(rest).groupBy("event_type", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query
def cv_folds(s, d):
    return split.rolling_folds(regular(s, d), K)


@query
def fold_names(s, d):
    return split.rolling_folds(regular(s, d), K).select("fold").distinct()


# ---- forecasts and scores --------------------------------------------------


@query
def seasonal_naive(s, d):
    return naive.seasonal_naive(split.train_part(regular(s, d), K, N_TEST), K, SEASON, N_TEST)


@query
def naive_metrics(s, d):
    train, test = split.split_by_horizon(regular(s, d), K, HORIZON, TEST_DAYS)
    return rounded(naive.train_and_score(train, test, K, SEASON, N_TEST))


@query
def left_joined_predictions(s, d):
    """Every prediction with the actual value where there is one."""
    train, _ = split.split_by_horizon(regular(s, d), K, HORIZON, TEST_DAYS)
    predicted = naive.seasonal_naive(train, K, SEASON, N_TEST)
    return metrics.align(predicted, base(s, d), K, "left")


@query
def backtest_predictions(s, d):
    return naive.backtest(regular(s, d), K)


@query
def backtest_metrics(s, d):
    errors = metrics.forecast_errors(naive.backtest(regular(s, d), K), K, ["event_type", "fold"])
    return rounded(errors)


@query
def fold_metric_means(s, d):
    errors = metrics.forecast_errors(naive.backtest(filled(s, d), K), K, ["event_type", "fold"])
    return rounded(metrics.fold_metric_means(metrics.metric_rows(errors, ["event_type", "fold"])))


@query
def worst_folds(s, d):
    errors = metrics.forecast_errors(naive.backtest(filled(s, d), K), K, ["event_type", "fold"])
    return rounded(metrics.worst_folds(errors.select("event_type", "fold", "mape"), 5, ["event_type", "fold"]))


@query
def backtest_fenced(s, d):
    """All rolling origins, each with the fence of its own training prefix."""
    return naive.backtest_with_fences(regular(s, d), K)


@query
def blend(s, d):
    return rounded(predictions(parts(s, d)[0]))


@query
def prediction_metrics(s, d):
    train, test = parts(s, d)
    errors = metrics.forecast_errors(metrics.align(predictions(train), test, K), K, ["event_type", "model"])
    return rounded(metrics.metric_rows(errors, ["event_type", "model"]))


def _score_inputs(s, d):
    train, test = parts(s, d)
    errors = metrics.forecast_errors(metrics.align(predictions(train), test, K), K, ["model"])
    return metrics.metric_rows(errors, ["model"]), test


@query
def model_scores(s, d):
    rows, test = _score_inputs(s, d)
    return rounded(select.model_scores(rows, test, "y"))


@query
def best_model(s, d):
    rows, test = _score_inputs(s, d)
    return rounded(select.best_model(select.model_scores(rows, test, "y")))


@query
def named_metrics(s, d):
    """Metric names in both spellings, with an older value per name, to model and metric."""
    rows, _ = _score_inputs(s, d)
    name = F.when(F.col("model") == "naive_day", F.col("metric")).when(
        F.col("model") == "naive_week", F.concat(F.lit("candidate."), "model", F.lit("_"), "metric")
    ).otherwise(F.concat("model", F.lit("_"), "metric"))
    new = rows.select(name.alias("name"), F.lit(1).alias("step"), "value")
    old = rows.select(name.alias("name"), F.lit(0).alias("step"), (-F.col("value")).alias("value"))
    return rounded(select.named_metrics(new.unionByName(old)))


@query
def selection_record(s, d):
    rows, test = _score_inputs(s, d)
    record = select.selection_record(select.model_scores(rows, test, "y"))
    return record.select("best_model_name", "model_type", "selection_metric", tidy(F.col("score")).alias("score"),
                         F.size("all_compared_models").alias("n_models"))


@query
def known_future(s, d):
    """Next day of each series with what the day before says, gaps filled."""
    r = regular(s, d)
    known = r.select("event_type", F.col("ts") + F.expr("interval 1 day"), F.col("y")).toDF("event_type", "ts", "y")
    return trees.known_future(r, known, K, HORIZON, ["y"])


# ---- profiles --------------------------------------------------------------


@query
def null_profile(s, d):
    return profile.null_counts(lags.add_lags(regular(s, d), K, cal.HISTORY_LAGS))


@query
def month_mean(s, d):
    return rounded(profile.month_mean(daily_orders(s, d), ORDERS))


@query
def day_mean(s, d):
    return rounded(profile.day_mean(base(s, d), K, "2024-01-05", "2024-01-25"))


@query
def weekday_mean(s, d):
    return rounded(profile.weekday_mean(daily_orders(s, d), ORDERS, 1998))


@query
def hour_box(s, d):
    rows = table(s, d, "events").select(F.hour("ts").alias("hour"), "value")
    return rounded(profile.box_summary(rows, ["hour"], "value"))


@query
def weekday_box(s, d):
    rows = table(s, d, "orders").select((F.weekday("o_orderdate") + 1).alias("weekday"), "o_totalprice")
    return rounded(profile.box_summary(rows, ["weekday"], "o_totalprice"))


@query
def head_rows(s, d):
    return table(s, d, "events").orderBy("ts", "event_id").limit(100)


@query
def tail_rows(s, d):
    return table(s, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(5)


@query
def table_size(s, d):
    return profile.table_size(table(s, d, "lineitem")).select("n_rows", "n_files")


@query
def acf(s, d):
    return rounded(profile.autocorrelation(filled(s, d), K, 50))


@query
def pacf(s, d):
    return rounded(profile.partial_autocorrelation(profile.autocorrelation(filled(s, d), K, 50), K))


# ---- drift -----------------------------------------------------------------


@query
def drift_ks(s, d):
    train, test = split.split_by_horizon(base(s, d), K, HORIZON, TEST_DAYS)
    return rounded(drift.ks_by_chunk(train, drift.number_chunks(test, K), K))


@query
def drift_js(s, d):
    train, test = split.split_by_horizon(base(s, d), K, HORIZON, TEST_DAYS)
    return rounded(drift.js_by_chunk(train, drift.number_chunks(test, K), K))


@query
def drift_alerts(s, d):
    train, test = split.split_by_horizon(base(s, d), K, HORIZON, TEST_DAYS)
    return rounded(drift.drift_report(train, test, K))


@query
def drift_seasonal_residual(s, d):
    """Both statistics, limits and alerts on the difference to the day before, rows with a null dropped."""
    k = K.with_(target="seasonal_residual")
    p = [lags.seasonal_difference(x, K, SEASON, drop_incomplete=True) for x in parts(s, d)]
    return rounded(drift.drift_report(*[rounded(x) for x in p], k))


# ---- transforms, decomposition, tests --------------------------------------


@query
def boxcox_grid(s, d):
    grid_values = [round(-2 + 0.25 * i, 2) for i in range(17)]
    return rounded(stats.boxcox_likelihood(daily_orders(s, d), ORDERS, grid_values), 3)


@query
def boxcox_best(s, d):
    return rounded(stats.boxcox_lambda(daily_orders(s, d), ORDERS).select("o_orderstatus", "best_lambda"))


@query
def boxcox_transform(s, d):
    out = stats.boxcox_transform(daily_orders(s, d), ORDERS)
    return rounded(out.withColumn("y_boxcox", tidy(F.col("y_boxcox"), 3)))


@query
def decomposition(s, d):
    return rounded(decompose.seasonal_decompose(filled(s, d), K, PERIODS))


@query
def decomposition_forecast(s, d):
    out = decompose.seasonal_decompose(filled(s, d), K, PERIODS)
    return rounded(decompose.decomposition_forecast(out, K, PERIODS, HORIZON))


@query
def loess_smooth(s, d):
    """A local line at every slot, over a day."""
    return rounded(loess.loess(filled(s, d), K, 97).select("event_type", "ts", "smooth"))


@query
def loess_joined(s, d):
    """Local lines over a week at every 67th slot, joined."""
    return rounded(loess.loess(filled(s, d), K, 673, jump=67).select("event_type", "ts", "smooth"))


def _loess_parts(s, d):
    return loess.loess_decompose(filled(s, d), K, PERIODS)


@query
def loess_decomposition(s, d):
    """Daily and weekly season, trend and remainder; the third period needs longer series."""
    return rounded(_loess_parts(s, d))


@query
def loess_forecast(s, d):
    """The day after the end with a band from the remainder."""
    return rounded(loess.loess_forecast(_loess_parts(s, d), K, PERIODS, HORIZON))


@query
def adf(s, d):
    return rounded(stats.dickey_fuller(filled(s, d), K))


@query
def phillips_perron(s, d):
    return rounded(stats.phillips_perron(filled(s, d), K).drop("p_value"))


@query
def ewm_half(s, d):
    """Exponential mean whose weights are gone after some hundred rows."""
    return rounded(rolling.add_ewm(filled(s, d), K, 0.5, "mean").select("event_type", "ts", "mean"))


@query
def ewm_slow(s, d):
    """Exponential mean that reaches over many chunks."""
    return rounded(rolling.add_ewm(filled(s, d), K.with_(chunk=256), 0.001, "mean").select("event_type", "ts", "mean"))


# ---- models (rows only) ----------------------------------------------------

SMALL_RANGES = {**trees.SEARCH_RANGES, "trees": (3, 6, "int"), "depth": (2, 4, "int")}
_FITTED: dict[tuple[str, str], dict] = {}


def fitted_models(s, d, variants=trees.VARIANTS):
    """Variants at the library's settings, each fitted once per session and folder; test part and training rows."""
    found = _FITTED.setdefault((s.sparkContext.applicationId, d), {})
    if not found:
        train, test = split.split_by_horizon(base(s, d), K, HORIZON, 1)
        found["train"], found["test"] = stage(trees.prepare_training(train, K)), stage(trees.prepare_test(test, K))
    found |= {m.variant: m for m in trees.fit_variants(found["train"], K, [v for v in variants if v not in found])}
    return [found[v] for v in variants], found["test"], found["train"]


@query
def tree_impute(s, d):
    return rounded(impute_series(regular(s, d), K, ImputeConfig(), BAD_TIMES)).select(
        "event_type", "ts", "y", "is_imputed")


def _tree_forecast(s, d, variant):
    models, test, prepared = fitted_models(s, d, [variant])
    return rounded(trees.evaluate(models, test, prepared, K))


@query
def tree_forecast_stable(s, d):
    return _tree_forecast(s, d, "stable")


@query
def tree_forecast_anchored(s, d):
    return _tree_forecast(s, d, "anchored")


@query
def tree_forecast_ensemble(s, d):
    return _tree_forecast(s, d, "ensemble")


@query
def candidate_evaluation(s, d):
    """Every candidate, their blend and the baseline with errors, scores and the winner."""
    models, test, prepared = fitted_models(s, d)
    return rounded(select.compare_models(trees.candidate_predictions(models, test, prepared, K), test, K))


@query
def candidate_choice(s, d):
    """The winner of each series."""
    models, test, prepared = fitted_models(s, d)
    found = select.compare_models(trees.candidate_predictions(models, test, prepared, K), test, K, ["event_type"])
    return rounded(found.where("is_best").select("event_type", "model", "score"))


@query
def series_scores(s, d):
    """Scores and choice of each series among plain forecasts."""
    train, test = parts(s, d)
    return rounded(select.compare_models(predictions(train), test, K, ["event_type"]))


@query
def tree_search(s, d):
    """Two trials of the search; the winner scored on the day after the hold-out."""
    train, test = split.split_by_horizon(base(s, d), K, HORIZON, 1)
    prepared = trees.prepare_training(train, K)
    params, _ = trees.search(prepared, K, "stable", trials=2, horizon=HORIZON, ranges=SMALL_RANGES)
    model = trees.fit_variant(prepared, K, "stable", params)
    scored = trees.evaluate([model], trees.prepare_test(test, K), prepared, K)
    return rounded(metrics.forecast_errors(scored, K, ["event_type", "model"]))


# ---- text sources ----------------------------------------------------------


@query
def html_links(s, d):
    return pages.repeated_rows(table(s, d, "pages").select("page_id", "html"), "html",
                               r'<li><a href="[^"]*">[^<]*</a></li>',
                               {"href": (r'href="([^"]*)"', 1), "label": (r">([^<>]*)</a>", 1)})


@query
def absolute_links(s, d):
    found = html_links(s, d)
    base_url = "http://site.example"
    return found.select("page_id", "pos", scalar.absolute_url(F.col("href"), base_url).alias("from_root"),
                        scalar.absolute_url(F.ltrim(F.col("href"), F.lit("/")), base_url).alias("relative"))


@query
def page_records(s, d):
    p = table(s, d, "pages")
    return p.select(
        "page_id", F.regexp_extract("html", r'<html lang="([^"]*)"', 1).alias("lang"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
        pages.plain_text(F.regexp_extract("html", r"(?s)<footer>(.*?)</footer>", 1)).alias("footer"),
        F.size(F.regexp_extract_all("html", F.lit(r"<p>"), F.lit(0))).alias("n_paragraphs"))


@query
def json_props(s, d):
    element = T.StructType([T.StructField("k", T.LongType())])
    e = table(s, d, "events").select("event_id", F.concat(F.lit("["), "props", F.lit(',{"k":'), F.col("user_id").cast("string"),
                                                          F.lit("}]")).alias("txt"))
    return pages.json_rows(e, "txt", element)


@query
def json_first_prop(s, d):
    element = T.StructType([T.StructField("k", T.LongType())])
    e = table(s, d, "events")
    txt = F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    return e.select("event_id", pages.json_first(txt, element)["k"].alias("k"))


@query
def text_grid(s, d):
    """Every document as a header-less sheet: lines are rows, commas separate cells."""
    files = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("partition_key"), F.col("text").alias("value"))
    g = grid.explode_sheets(files)
    return g.select("partition_key", "row_idx", F.size("cells").alias("n_cells"),
                    F.get("cells", F.lit(0)).alias("first_cell"), con.cell(2).alias("third_cell"))


@query
def file_listing(s, d):
    return pages.table_listing(listing_pages(s, d), "html")


@query
def listing_keys(s, d):
    return pages.with_keys(pages.table_listing(listing_pages(s, d), "html"), "https://base.example")


@query
def listing_backfill(s, d):
    found = pages.with_keys(pages.table_listing(listing_pages(s, d), "html"), "https://base.example")
    return pages.listing_window(found, "backfill", 1997, datetime(1999, 6, 1)).groupBy("ym").agg(
        F.count(F.lit(1)).alias("n"), F.count("file_key").alias("n_files"))


@query
def listing_live(s, d):
    found = pages.with_keys(pages.table_listing(listing_pages(s, d), "html"), "https://base.example")
    return pages.listing_window(found, "live", 1997, datetime(1999, 6, 1)).select("o_orderkey", "file_key", "ym")


@query
def month_folders(s, d):
    found = pages.month_folders(listing_pages(s, d).select("o_orderkey", "html"), "html", range(1990, 2010))
    counted = found.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    return pages.calendar_order(counted).withColumn("month_no", scalar.month_number(F.col("month")).cast("bigint"))


@query
def dashboard_samples(s, d):
    return pages.dashboard_samples(dashboard_pages(s, d), "html", "ts")


@query
def safe_parse(s, d):
    o = table(s, d, "orders")
    price = F.format_number("o_totalprice", 2)
    key = F.concat(F.lit(" "), F.format_number("o_custkey", 0), F.lit(" "))
    return o.select(
        "o_orderkey", scalar.safe_float(price).alias("price"), scalar.safe_int(price).alias("price_int"),
        scalar.safe_int(key).alias("cust"), scalar.safe_float(F.col("o_orderpriority")).alias("priority_float"),
        scalar.safe_int(F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))).alias("status_int"))


@query
def period_parse(s, d):
    """Start of each sheet period, also where the date cannot be read."""
    c = con.SheetContract()
    g = order_sheets(s, d).filter(F.col("row_idx") >= c.first_data_row)
    key = F.col("partition_key")
    return g.select("partition_key", "row_idx", scalar.period_start(con.cell(1)).alias("start_text"),
                    scalar.date_from_key(key).alias("key_date"),
                    scalar.period_timestamp(scalar.date_from_key(key), con.cell(1), strict=False).alias("stamp"))


# ---- contracts -------------------------------------------------------------


@query
def grid_contract(s, d):
    return con.check_sheets(order_sheets(s, d))


@query
def grid_quarantine(s, d):
    return con.quarantine(con.check_sheets(order_sheets(s, d)))


@query
def grid_counters(s, d):
    return con.counters(con.check_sheets(order_sheets(s, d)))


@query
def grid_valid_rows(s, d):
    g = order_sheets(s, d)
    kept = con.valid_grid(g, con.check_sheets(g))
    return kept.groupBy("partition_key").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def grid_primary(s, d):
    g = order_sheets(s, d)
    return con.to_primary(g, con.check_sheets(g))


@query
def primary_violations(s, d):
    g = order_sheets(s, d)
    return con.primary_violations(con.to_primary(g, con.check_sheets(g)))


@query
def grid_series(s, d):
    g = order_sheets(s, d)
    return con.to_series(con.to_primary(g, con.check_sheets(g)), K.with_(ids=(), time="timestamp"))


# ---- streaming -------------------------------------------------------------


def _scratch(s: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return tables.shared_dir(s, "query")


def _event_stream(s: SparkSession, d: str) -> DataFrame:
    schema = table(s, d, "events").schema
    rows = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_tumbling_means(s, d):
    """Means per event type and quarter of an hour, also of windows still open at the end."""
    out = _scratch(s)
    rows = jobs.tumbling_means(_event_stream(s, d), ["event_type"], "ts", ["value"])
    jobs.upsert_to(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    got = jobs.latest(s.read.parquet(f"{out}/rows"), ["event_type", "window_start", "window_end"])
    return rounded(got.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                              F.col("window_end").cast("timestamp_ntz").alias("window_end"), "value", "n"))


@query
def stream_drop_repeats(s, d):
    """One row per event type and hour, whichever came first."""
    out = _scratch(s)
    hourly = _event_stream(s, d).select("event_type", F.date_trunc("hour", "ts").alias("ts"))
    rows = jobs.drop_repeats(hourly, ["event_type", "ts"], "ts", "2 hours")
    jobs.append_to(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return s.read.parquet(f"{out}/rows").select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


# ---- written and read back -------------------------------------------------


@query
def whole_table_rewrite(s, d):
    """A table replaced by a smaller one."""
    path, orders = _scratch(s), table(s, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    tables.write_table(orders.drop("o_orderstatus"), path)
    small = orders.where("o_orderstatus = 'F'").drop("o_orderstatus")
    tables.write_table(small, path)
    return tables.read_table(s, path, small.schema)


@query
def keyed_rewrite(s, d):
    """One key of a keyed table replaced, two keys read."""
    path = _scratch(s)
    orders = table(s, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderpriority")
    tables.write_keyed(orders, path, "o_orderpriority")
    changed = orders.where("o_orderpriority = '1-URGENT'").withColumn("price", -F.col("price"))
    tables.write_keyed(changed, path, "o_orderpriority")
    return tables.read_keyed(s, path, orders.schema).where("o_orderpriority in ('1-URGENT', '2-HIGH')")


@query
def csv_appends(s, d):
    """Rows appended in two steps; every file has the header."""
    path, orders = _scratch(s), table(s, d, "orders").select("o_orderkey", "o_orderpriority", "o_custkey", "o_orderstatus")
    for part in (orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")):
        tables.append_csv(part.drop("o_orderstatus"), path)
    return s.read.schema(orders.drop("o_orderstatus").schema).option("header", True).csv(path)


@query
def metrics_history(s, d):
    """Two runs of metrics, of which the second counts."""
    path, orders = _scratch(s), table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("model"))
    for f in (F.min, F.max):
        tables.append_metrics(s.createDataFrame([], tables.METRICS), path)
        step = tables.next_step(tables.read_table(s, path, tables.METRICS))
        tables.append_metrics(orders.agg(f("o_totalprice").alias("value")).select(
            F.lit("candidate").alias("prefix"), "model", F.lit("rmse").alias("metric"), F.lit(step).alias("step"), "value"), path)
    return tables.latest_metrics(tables.read_table(s, path, tables.METRICS))


@query
def json_record(s, d):
    """The record of a selection, written as a document and parsed again."""
    path, orders = _scratch(s), table(s, d, "orders")
    found = orders.groupBy(F.col("o_orderpriority").alias("model")).agg(
        (F.avg("o_totalprice") / 1e6).alias("mape"), F.stddev_pop("o_totalprice").alias("rmse"))
    long = found.select("model", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("mape", "rmse")])))
    record = select.selection_record(select.model_scores(long, orders, "o_totalprice"))
    tables.write_document(record, path)
    read = s.read.schema(record.schema).json(path)
    return rounded(read.select("best_model_name", "model_type", "score", F.size("all_compared_models").cast("bigint").alias("n_models")))


@query
def features_without_gaps(s, d):
    """History columns with 0 for null."""
    names = ["y", *cal.HISTORY_LAGS]
    rows = lags.add_lags(regular(s, d), K, cal.HISTORY_LAGS)
    return cal.no_gaps(rows, names).select("event_type", "ts", *names)


@query
def rolling_with_nan(s, d):
    """A NaN is seen by the frames that hold it and by no other."""
    nan = F.when(F.col("ts") == F.lit("2024-01-10 12:00:00").cast("timestamp_ntz"), F.lit(float("nan"))).otherwise(F.col("y"))
    rows = filled(s, d).withColumn("y", nan)
    found = rolling.add_rolling(rows, K, [rolling.trailing("wide", "mean", 200)])
    return rounded(found.where("wide is not null").select("event_type", "ts", "wide"))


@query
def time_since_previous_raw(s, d):
    """Events as they come, many to a slot."""
    rows = table(s, d, "events").groupBy("event_type", "ts").agg(F.min("event_id").alias("event_id"))
    return lags.time_since_previous(rows, K).select("event_type", "event_id", "seconds_since_previous")


# ---- runs over files -------------------------------------------------------

SHEET_PATHS = r"year=([^/]+)/month=([^/]+)/sheet=([^/]+)/"


def month_sheet_lines(s: SparkSession, d: str) -> DataFrame:
    """Orders as one sheet per month, line by line; those of July have a wrong title."""
    c, o = con.SheetContract(), table(s, d, "orders")
    day = F.col("o_orderdate")
    month = F.element_at(F.array(*[F.lit(m) for m in scalar.MONTHS]), F.month(day))
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    name = F.concat(F.lit("F_01-"), two(F.month(day)), F.lit("-"), F.year(day).cast("string"))
    o = o.select(F.year(day).alias("year"), month.alias("month"), name.alias("sheet"), "o_orderkey", "o_custkey", "o_totalprice")
    clock = lambda n: F.concat(two(F.floor(n / 4)), F.lit(":"), two(F.pmod(n, F.lit(4)) * 15))
    slot = F.pmod("o_orderkey", F.lit(96))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    rows = o.select("year", "month", "sheet", F.col("o_orderkey").alias("at"), F.concat_ws(
        ",", F.lit(""), F.concat(clock(slot), F.lit(" - "), clock(F.pmod(slot + 1, F.lit(96)))), F.lit(""), F.col("o_custkey").cast("string"), price).alias("line"))
    title = F.when(F.col("month") == "Jul", F.lit("Other")).otherwise(F.lit(c.title))
    head = [title, F.lit(""), F.lit("Date,,,,"), F.lit(f",,,{c.forecast_heading},{c.actual_heading}"), F.lit(f",{c.period_heading},,,")]
    heads = o.select("year", "month", "sheet").distinct().select(
        "year", "month", "sheet", F.posexplode(F.array(*head)).alias("at", "line"))
    return rows.unionByName(heads.withColumn("at", F.col("at").cast("bigint") - len(head)))


def write_sheets(lines: DataFrame, path: str) -> None:
    """One file per sheet; sheets that do not occur stay as they are."""
    keys = ["year", "month", "sheet"]
    (lines.repartition(*keys).sortWithinPartitions(*keys, "at").select(*keys, "line").write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).text(path))


@query
def incremental_ingest(s, d):
    """Sheets taken in, one of them changed, taken in again: rows per sheet and what the second run read."""
    path, lines = _scratch(s), stage(month_sheet_lines(s, d))
    cfg = RunConfig(root=f"{path}/out", sheets=f"{path}/in", key_pattern=SHEET_PATHS)
    write_sheets(lines, cfg.sheets)
    first = runs.ingest(s, cfg)
    changed = lines.where("sheet = 'F_01-03-1995'").withColumn(
        "line", F.when(F.col("at") >= 0, F.regexp_replace("line", r",([0-9.]+)$", ",-$1")).otherwise(F.col("line")))
    write_sheets(changed, cfg.sheets)
    second = runs.ingest(s, cfg)
    found = runs.read_primary(s, cfg).groupBy("source_key").agg(
        F.count(F.lit(1)).alias("n_rows"), tidy(F.sum(cfg.contract.actual_name), 2).alias("total"))
    return found.select("*", F.lit(first["sheets_read"]).cast("bigint").alias("first_read"),
                        F.lit(second["sheets_read"]).cast("bigint").alias("second_read"),
                        F.lit(second["raw_partitions_invalid"]).cast("bigint").alias("refused"))


PART_ROWS = 500_000  # rows that one task sorts


@query
def large_sheets(s, d):
    """Line items as one large sheet per return flag, written in sorted parts, with exact row numbers from their blocks."""
    path = _scratch(s)
    lines = table(s, d, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", F.concat_ws(",", "l_orderkey", "l_linenumber", "l_quantity").alias("line"))
    order = ["l_returnflag", "l_orderkey", "l_linenumber", "line"]
    parts = max(1, -(-lines.count() // PART_ROWS))
    (lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
          .select("l_returnflag", "line").write.partitionBy("l_returnflag").text(path))
    g = grid.read_large_sheets(s, path, pattern=r"l_returnflag=([^/]+)/", in_parts=True)
    return g.select("partition_key", "row_idx", F.get("cells", F.lit(0)).cast("bigint").alias("l_orderkey"),
                    F.get("cells", F.lit(1)).cast("bigint").alias("l_linenumber"), F.size("cells").cast("bigint").alias("n_cells"))


class _Rows:
    """A stand-in for a model: saving it writes its forecasts, or fails."""

    def __init__(self, rows: DataFrame, fails: bool = False) -> None:
        self.rows, self.fails = rows, fails

    def save(self, path: str) -> None:
        tables.write_table(self.rows, path)
        if self.fails:
            raise OSError("the store went away")


@query
def promotion(s, d):
    """A weak model promoted, then the best one, then a promotion that fails; rows of the version in use."""
    path = _scratch(s)
    train, test = parts(s, d)
    found = stage(predictions(train))
    errors = stage(metrics.metric_rows(metrics.forecast_errors(metrics.align(found, test, K), K, ["model"]), ["model"]))
    scores = stage(select.model_scores(errors, test, "y"))
    models = {r["model"]: _Rows(found.where(F.col("model") == r["model"])) for r in scores.collect()}
    worst = scores.orderBy(F.col("score").desc(), F.col("model").desc()).first()["model"]
    select.promote(scores, {worst: models[worst]}, path)
    best = select.promote(scores, models, path)
    try:
        select.promote(scores, {best: _Rows(found, fails=True)}, path)
    except OSError:
        pass
    now = select.promoted(s, path)
    record = s.read.json(f"{now['folder']}/model-metadata").select("best_model_name", "score").first()
    rows = tables.read_table(s, f"{now['folder']}/model", found.schema)
    return rounded(rows.select("event_type", "ts", "model", "yhat", F.lit(now["sequence"]).alias("version"),
                               F.lit(record["best_model_name"]).alias("recorded"), F.lit(record["score"]).alias("score")))


@query
def stream_keep_least(s, d):
    """The event of least id per type and quarter of an hour, though later ids arrive first."""
    out, e = _scratch(s), table(s, d, "events").select("event_type", floor_time(F.col("ts"), 900).alias("ts"), "event_id", "value")
    middle = e.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for name, part in (("a", F.col("event_id") > middle), ("b", F.col("event_id") <= middle)):
        e.where(part).coalesce(1).write.parquet(f"{out}/in/{name}")
    rows = s.readStream.schema(e.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    best = jobs.keep_least(rows, ["event_type", "ts"], "ts", ["event_id"], "1000 days")
    jobs.upsert_to(best, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    got = jobs.latest(s.read.parquet(f"{out}/rows"), ["event_type", "ts"])
    return got.select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "value")


@query
def null_at_keys(s, d):
    """Values of the slots that a table names set to null, a series without a name included."""
    rows = base(s, d).withColumn("event_type", F.when(F.col("event_type") != "click", F.col("event_type")))
    bad = rows.where((F.hour("ts") == 3) & (F.minute("ts") == 0)).select("event_type", "ts")
    return fill.null_at_table(rows, K, bad)


@query
def imputed_counts(s, d):
    """Rows that a fill added, per series."""
    rows = regular(s, d).withColumn("is_imputed", F.col("y").isNull())
    return imputed_count(rows, K)


@query
def quoted_cells(s, d):
    """Cells that hold commas and doubled quotes."""
    q = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', said ""'), F.col("o_orderstatus"), F.lit('"""'))
    files = table(s, d, "orders").groupBy("o_custkey").agg(F.concat_ws("\n", F.sort_array(F.collect_list(
        F.concat_ws(",", F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), q)))).alias("value"))
    g = grid.explode_sheets(files.select(F.col("o_custkey").cast("string").alias("partition_key"), "value"), width=2)
    return g.select("partition_key", "row_idx", F.get("cells", F.lit(0)).alias("order_text"), F.get("cells", F.lit(1)).alias("note"))
