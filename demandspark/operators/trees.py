"""Boosted-tree forecasters on calendar and lag features.

Three variants. ``stable`` learns the level from calendar columns with absolute
loss and predicts all future rows at once. ``anchored`` learns the difference to
the same slot one season earlier, from lags and rolling statistics of that
difference. Time is cut into blocks of one season: lags of a season or more are known
when a block starts, and what follows the last value (lag 1 and its means) is taken at
the block's start, in training too. So a whole block of all series is scored at once,
feeds the next one, and a horizon takes one pass per block. ``ensemble`` averages an
absolute-loss tree model and a Huber linear model on those features.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.calendar import add_calendar, by_prefix, exogenous_names, no_gaps
from demandspark.keys import SeriesKeys, epoch_seconds, shift_time
from demandspark.operators.chunks import fit_matrix, null_safe_join, series_join, stage
from demandspark.operators.dedup import keep_last
from demandspark.operators.fill import fill_both
from demandspark.operators.lags import seasonal_difference, shift_columns
from demandspark.operators.metrics import align, blend, forecast_errors
from demandspark.operators.naive import seasonal_naive
from demandspark.operators.quantiles import quantile_columns
from demandspark.operators.rolling import add_ewm, add_rolling, trailing
from demandspark.operators.select import BASELINE_NAME
from demandspark.operators.spine import bounds, future_frame, insert_missing, time_spine
from demandspark.operators.split import test_part, train_part

SEASON = 96
LAGS = (1, 96, 97, 672)  # fixed values: rows back, of the seasonal difference
LAG_FEATURES = tuple(f"lag_{k}" for k in LAGS) + ("lag1_mean4", "lag1_ewm", "lag96_mean4", "lag96_std8")
EWM_ALPHA = 0.5
SHIFTS = {f"lag_{k}": ("_z", k) for k in LAGS} | {
    "lag1_mean4": ("_m4", 1), "lag1_ewm": ("_e", 1), "lag96_mean4": ("_m4", 96), "lag96_std8": ("_s8", 96)}
START_FEATURES = ("lag_1", "lag1_mean4", "lag1_ewm")  # taken at the start of a block
BLOCK_FEATURES = (*LAG_FEATURES, "block_step")
TAIL = max(LAGS) + 2 * SEASON + 64  # history slots that a block can see; beyond 53 no weight of the mean is left
VARIANTS = ("stable", "anchored", "ensemble")


@dataclass(frozen=True)
class TreeParams:
    trees: int = 400
    learning_rate: float = 0.05
    depth: int = 6
    min_rows: int = 20
    row_share: float = 0.8
    feature_share: float = 0.8
    seed: int = 42


# Search ranges as (low, high, kind); 'log' draws evenly in the logarithm.
SEARCH_RANGES = {
    "trees": (400, 2000, "int"),
    "learning_rate": (0.005, 0.08, "log"),
    "depth": (5, 12, "int"),
    "min_rows": (20, 150, "int"),
    "row_share": (0.5, 0.95, "float"),
    "feature_share": (0.3, 0.95, "float"),
}


def prepare_training(train: DataFrame, keys: SeriesKeys, order: Sequence[str] | None = None) -> DataFrame:
    """Last row per timestamp, known targets only, on the grid and filled.

    Calendar columns of inserted rows are computed, not copied from a neighbour.
    """
    rows = train.select(*keys.key, keys.target, *(order or []))
    unique = keep_last(rows, keys, order or [keys.target]).select(*keys.key, keys.target)
    grid = insert_missing(unique.na.drop(subset=[keys.target]), keys)
    return add_calendar(stage(fill_both(grid, keys)), keys, candidate=True)


def prepare_test(test: DataFrame, keys: SeriesKeys, order: Sequence[str] | None = None) -> DataFrame:
    """The same repair for the part that is predicted; null targets are filled too."""
    rows = test.select(*keys.key, keys.target, *(order or []))
    unique = keep_last(rows, keys, order or [keys.target]).select(*keys.key, keys.target)
    return add_calendar(stage(fill_both(insert_missing(unique, keys), keys)), keys, candidate=True)


def exogenous(df: DataFrame) -> list[str]:
    """Calendar and Fourier columns present in the table."""
    return [c for c in exogenous_names() if c in df.columns] + by_prefix(df)


def _state(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Rows that have ``_z`` (difference to one season earlier), with its rolling statistics."""
    rows = shift_columns(df, keys, {"_season_ago": (keys.target, SEASON)})
    rows = rows.withColumn("_z", F.col(keys.target) - F.col("_season_ago")).drop("_season_ago")
    known = rows.filter(F.col("_z").isNotNull())
    known = add_rolling(known, keys, [trailing("_m4", "mean", 4), trailing("_s8", "std", 8)], value="_z")
    return add_ewm(known, keys, EWM_ALPHA, "_e", value="_z")


def lag_frame(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Adds ``_z`` (difference to one season earlier) and its lag features."""
    return shift_columns(_state(df, keys), keys, SHIFTS).drop("_m4", "_s8", "_e")


def _from_block_start(rows: DataFrame, keys: SeriesKeys) -> DataFrame:
    """``START_FEATURES`` as at the first slot of each ``_block`` (one row per block and series)."""
    starts = rows.filter("block_step = 1").select(*keys.ids, "_block", *[F.col(c).alias(f"_s_{c}") for c in START_FEATURES])
    joined = null_safe_join(rows, starts, [*keys.ids, "_block"], "left")
    return joined.select(*[F.col(f"_s_{c}").alias(c) if c in START_FEATURES else F.col(c) for c in rows.columns])


def block_frame(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    """:func:`lag_frame` as a block forecast sees it: blocks of a season that end with the series.

    Adds ``block_step`` (1 for the first slot of a block); a first block that is not whole
    has no start and gets nulls.
    """
    last = df.groupBy(*keys.ids).agg(F.max(keys.slot()).alias("_last"))
    rows = series_join(lag_frame(df, keys), last, keys.ids).withColumn("_ago", F.col("_last") - keys.slot())
    rows = rows.withColumn("_block", F.floor(F.col("_ago") / SEASON))
    rows = rows.withColumn("block_step", F.lit(SEASON) - F.pmod("_ago", F.lit(SEASON)).cast("int")).drop("_ago", "_last")
    return _from_block_start(rows, keys).drop("_block")


@dataclass
class Forecaster:
    """A fitted variant. ``predict`` gives rows ``(ids, time, model, yhat)``."""

    name: str
    variant: str
    keys: SeriesKeys
    features: list[str]
    members: dict[str, object] = field(default_factory=dict)
    scale: DataFrame | None = None  # one row per series: level and spread of its training target

    def predict(self, future: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """Predict the rows of ``future``, which has the exogenous columns.

        The lagged variants also need the ``history`` that future continues.
        """
        keys = self.keys
        if self.variant == "stable":
            model = self.members[self.name]
            found = model.transform(_assemble(future, keys, self.features, [])).select(
                *keys.key, F.lit(self.name).alias("model"), F.col("prediction").alias("yhat"))
        elif history is None:
            raise ValueError(f"variant {self.variant} needs the history")
        else:
            found = self._by_blocks(future, scaled(history, self.scale, keys))
        back = series_join(found, self.scale, keys.ids)
        return back.select(*keys.key, "model", (F.col("yhat") * F.col("_spread") + F.col("_level")).alias("yhat"))

    def _by_blocks(self, future: DataFrame, history: DataFrame) -> DataFrame:
        """One pass over all series per block; what a block gives is written and read by the next."""
        keys, y = self.keys, self.keys.target
        exog = [f for f in self.features if f not in BLOCK_FEATURES]
        ends = history.groupBy(*keys.ids).agg(F.max(keys.time).alias("_end"))
        start = series_join(history.select(*keys.key, F.col(y).cast("double").alias(y)), ends, keys.ids)
        after = (epoch_seconds(F.col(keys.time)) - epoch_seconds(F.col("_end"))) / F.lit(keys.step) - 1
        known = stage(start.withColumn("_k", F.floor(after)).filter(F.col("_k") >= -TAIL).drop("_end"))
        # from the slot after the history on, so that lags count slots also if the future starts later
        reach = series_join(ends.select(*keys.ids, shift_time(F.col("_end"), keys.step).alias("first_ts")),
                            bounds(future, keys).select(*keys.ids, "last_ts"), keys.ids)
        reach = reach.where("first_ts <= last_ts")
        slots = series_join(time_spine(reach, keys), reach.select(*keys.ids, "first_ts"), keys.ids)
        slots = slots.withColumn("_k", F.floor((epoch_seconds(F.col(keys.time)) - epoch_seconds(F.col("first_ts"))) / keys.step))
        slots = add_calendar(slots.drop("first_ts"), keys, candidate=True)
        given = future.select(*keys.key, F.lit(True).alias("_wanted"), *[F.col(c).alias(f"_g_{c}") for c in exog])
        ahead = null_safe_join(slots, given, keys.key, "left")
        ahead = stage(ahead.select(
            *keys.key, "_k", "_wanted", F.floor(F.col("_k") / SEASON).alias("_block"),
            (F.pmod("_k", F.lit(SEASON)) + 1).cast("int").alias("block_step"),
            *[(F.coalesce(f"_g_{c}", c) if c in slots.columns else F.col(f"_g_{c}")).alias(c) for c in exog]))
        blocks = (ahead.agg(F.max("_block")).first()[0] or 0) + 1
        found = None
        for b in range(blocks):
            done = stage(self._block(known, ahead.filter(F.col("_block") == b), exog))
            found = done if found is None else found.unionByName(done)
            if b + 1 < blocks:
                known = known.unionByName(done.select(*known.columns)).filter(F.col("_k") >= (b + 1) * SEASON - TAIL)
        return found.filter("_wanted").select(*keys.key, F.lit(self.name).alias("model"), F.col(y).alias("yhat"))

    def _block(self, known: DataFrame, ahead: DataFrame, exog: Sequence[str]) -> DataFrame:
        """Predicted targets of one block: mean of the members plus the value one season earlier."""
        keys, y = self.keys, self.keys.target
        past = _state(known, keys).withColumn("_future", F.lit(False))
        rows = ahead.withColumn("_future", F.lit(True)).unionByName(past, allowMissingColumns=True)
        rows = shift_columns(rows, keys, SHIFTS | {"_season_ago": (y, SEASON)}).filter("_future")
        rows = _from_block_start(rows, keys)
        needed = [f for f in LAG_FEATURES if f in self.features]
        whole = F.lit(True)
        for c in [*needed, "_season_ago"]:
            whole = whole & F.col(c).isNotNull()
        kept = ["_k", "_wanted", "_season_ago", "_whole"]
        scored = _assemble(rows.withColumn("_whole", whole), keys, self.features, kept)
        members = []
        for i, model in enumerate(self.members.values()):
            scored = model.transform(scored).withColumnRenamed("prediction", f"_p{i}")
            members.append(F.col(f"_p{i}"))
        mean = sum(members[1:], members[0]) / len(members)
        return scored.select(*keys.key, "_k", "_wanted", F.when(F.col("_whole"), mean + F.col("_season_ago")).alias(y))

    def save(self, path: str) -> None:
        """Write the fitted members, the scale and what else :meth:`load` needs below ``path``."""
        for member, model in self.members.items():
            model.write().overwrite().save(f"{path}/members/{member}")
        spark = self.scale.sparkSession
        self.scale.write.mode("overwrite").parquet(f"{path}/scale")
        about = {"name": self.name, "variant": self.variant, "features": self.features, "keys": asdict(self.keys),
                 "members": {n: type(m).__name__ for n, m in self.members.items()}}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forecaster":
        """The forecaster that :meth:`save` wrote."""
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        kinds = {"GBTRegressionModel": GBTRegressionModel, "LinearRegressionModel": LinearRegressionModel}
        members = {n: kinds[kind].load(f"{path}/members/{n}") for n, kind in about["members"].items()}
        keys = SeriesKeys(**about["keys"])
        return Forecaster(about["name"], about["variant"], keys, about["features"], members, spark.read.parquet(f"{path}/scale"))

    def predict_ahead(self, history: DataFrame, horizon: int) -> DataFrame:
        """Predict the ``horizon`` slots after the history, calendar columns computed."""
        frame = future_frame(history, self.keys, horizon).select(*self.keys.key)
        return self.predict(add_calendar(frame, self.keys, candidate=True), history)


def series_scale(prepared: DataFrame, keys: SeriesKeys, season: int | None = None) -> DataFrame:
    """Median and distance of the quartiles of each series' target (1 where that is 0).

    With ``season`` the quartiles are those of the difference to one season earlier: trees
    for absolute loss go in steps of the learning rate, so what they learn must be of
    about unit size.
    """
    wanted = {"_q1": 0.25, "_level": 0.5, "_q3": 0.75}
    q = quantile_columns(prepared, keys.ids, keys.target, wanted, "linear")
    if season:
        change = seasonal_difference(prepared.select(*keys.key, keys.target), keys, season, "_change")
        edges = quantile_columns(change, keys.ids, "_change", {"_q1": 0.25, "_q3": 0.75}, "linear")
        q = series_join(q.select(*keys.ids, "_level"), edges, keys.ids, "left")
    spread = F.col("_q3") - F.col("_q1")
    return q.select(*keys.ids, F.col("_level").cast("double").alias("_level"),
                    F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("_spread"))


def scaled(df: DataFrame, scale: DataFrame, keys: SeriesKeys) -> DataFrame:
    """The table with its target relative to the series' level, in units of its spread."""
    y = ((F.col(keys.target) - F.col("_level")) / F.col("_spread")).alias(keys.target)
    return series_join(df, scale, keys.ids).select(*[y if c == keys.target else F.col(c) for c in df.columns])


def _assemble(df: DataFrame, keys: SeriesKeys, features: Sequence[str], others: Sequence[str]) -> DataFrame:
    clean = no_gaps(df.select(*keys.key, *others, *features), features)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(clean)


def _tree_model(params: TreeParams) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol="label", lossType="absolute", maxIter=params.trees,
        stepSize=params.learning_rate, maxDepth=params.depth, minInstancesPerNode=params.min_rows,
        subsamplingRate=params.row_share, featureSubsetStrategy=str(params.feature_share), seed=params.seed)


def fit_variant(prepared: DataFrame, keys: SeriesKeys, variant: str, params: TreeParams = TreeParams(),
                name: str | None = None) -> Forecaster:
    """Fit one variant on :func:`prepare_training` rows.

    One model serves all series: it learns each relative to its own level and spread.
    """
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}")
    name = name or variant
    exog = exogenous(prepared)
    scale = stage(series_scale(prepared, keys, None if variant == "stable" else SEASON))
    prepared = scaled(prepared, scale, keys)
    if variant == "stable":
        features, rows, label = exog, prepared, keys.target
    else:
        features = [*exog, *BLOCK_FEATURES]
        rows = block_frame(prepared, keys).na.drop(subset=["_z", *LAG_FEATURES])
        label = "_z"
    found = _assemble(rows, keys, features, [label]).select(
        "features", F.col(label).cast("double").alias("label")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = found.count()
        if not rows:
            raise ValueError(f"no complete training row for variant {variant!r}")
        training = fit_matrix(found, rows)
    finally:
        found.unpersist()
    members: dict[str, object] = {}
    if variant == "ensemble":
        members["huber"] = LinearRegression(
            featuresCol="features", labelCol="label", loss="huber", maxIter=100).fit(training)
        members["mae"] = _tree_model(replace(params, seed=123)).fit(training)
    else:
        members[name] = _tree_model(params).fit(training)
    return Forecaster(name, variant, keys, features, members, scale)


def fit_variants(prepared: DataFrame, keys: SeriesKeys, variants: Sequence[str] = VARIANTS, params: TreeParams = TreeParams(),
                 parallelism: int = 4) -> list[Forecaster]:
    """All variants, their fits submitted from a few driver threads (a fit is a row of short jobs)."""
    prepared = stage(prepared)
    pool = ThreadPool(max(1, min(parallelism, len(variants))))
    try:
        return pool.map(inheritable_thread_target(prepared.sparkSession)(
            lambda v: fit_variant(prepared, keys, v, params)), list(variants))
    finally:
        pool.close()


def draw_params(trials: int, seed: int = 42, ranges: dict = SEARCH_RANGES) -> list[TreeParams]:
    """Seeded random draws from the search ranges."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        values = {}
        for name, (low, high, kind) in ranges.items():
            if kind == "int":
                values[name] = rng.randint(low, high)
            elif kind == "log":
                values[name] = low * (high / low) ** rng.random()
            else:
                values[name] = rng.uniform(low, high)
        drawn.append(TreeParams(seed=seed, **values))
    return drawn


def search(prepared: DataFrame, keys: SeriesKeys, variant: str, trials: int = 40, horizon: int = 96,
           seed: int = 42, ranges: dict = SEARCH_RANGES, parallelism: int = 4) -> tuple[TreeParams, float]:
    """Random search for the least mape on the last ``horizon`` slots.

    The fits are Spark jobs submitted from a few driver threads; the driver gets
    one number per trial.
    """
    fit_rows = train_part(prepared, keys, horizon)
    held = test_part(prepared, keys, horizon)
    draws = draw_params(trials, seed, ranges)

    def trial(params: TreeParams) -> float:
        predicted = fit_variant(fit_rows, keys, variant, params).predict(held, fit_rows)
        found = forecast_errors(align(predicted, held, keys), keys, ["model"]).first()
        return float("inf") if found is None or found["mape"] is None else found["mape"]

    pool = ThreadPool(min(parallelism, trials))
    try:
        scores = pool.map(inheritable_thread_target(prepared.sparkSession)(trial), draws)
    finally:
        pool.close()
    best = min(range(trials), key=lambda i: (scores[i], i))
    return draws[best], scores[best]


def evaluate(models: Sequence[Forecaster], test: DataFrame, history: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Predictions of all models on repaired test rows, as one table, with actuals."""
    parts = [m.predict(test, history) for m in models]
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    return align(table, test, keys)


def candidate_predictions(models: Sequence[Forecaster], test: DataFrame, history: DataFrame, keys: SeriesKeys,
                          season: int = SEASON, blended: str = "blend", baseline: str = BASELINE_NAME) -> DataFrame:
    """Every model, the mean of all of them and the seasonal naive baseline: ``(ids, time, model, yhat)``."""
    found = stage(evaluate(models, test, history, keys).select(*keys.key, "model", "yhat"))
    both = blend(found, keys, [m.name for m in models], blended)
    reach = bounds(history, keys).select(*keys.ids, shift_time(F.col("last_ts"), keys.step).alias("first_ts"))
    slots = series_join(reach, bounds(test, keys).select(*keys.ids, "last_ts"), keys.ids)
    horizon = slots.agg(F.max((epoch_seconds(F.col("last_ts")) - epoch_seconds(F.col("first_ts"))) / keys.step)).first()[0]
    naive = seasonal_naive(history, keys, season, int(horizon or 0) + 1).withColumn("model", F.lit(baseline))
    return found.unionByName(both).unionByName(null_safe_join(naive, test.select(*keys.key), keys.key, "left_semi"))


def known_future(history: DataFrame, known: DataFrame, keys: SeriesKeys, horizon: int,
                 cols: Sequence[str]) -> DataFrame:
    """The next ``horizon`` slots with what is known of them; gaps are filled
    forward, then backward, then with 0."""
    frame = future_frame(history, keys, horizon).select(*keys.key)
    joined = null_safe_join(frame, known.select(*keys.key, *cols), keys.key, "left")
    return fill_both(joined, keys, cols).na.fill(0.0, list(cols))

