"""Choice of the best model from metric rows, and its promotion."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import null_safe_join, series_join, stage
from demandspark.operators.metrics import align, forecast_errors, metric_rows
from demandspark.sources.tables import write_document

# The baseline's name and the description of the score.
BASELINE_NAME = "Baseline_Seasonal_Naive"
_SUFFIX = r"(mae|rmse|mape)$"


def named_metrics(rows: DataFrame) -> DataFrame:
    """``(name, step, value)`` to ``(model, metric, value)``; the last step wins,
    of equal steps the larger value.

    Names are ``mape``, ``baseline.mape``, ``<model>_mape`` or
    ``candidate.<model>_mape``; one without a model is the baseline.
    """
    clean = F.element_at(F.split("name", r"\."), -1)
    model = F.regexp_replace(clean, "_?" + _SUFFIX, "")
    tagged = rows.select(
        F.when(model == "", F.lit(BASELINE_NAME)).otherwise(model).alias("model"),
        F.regexp_extract(clean, _SUFFIX, 1).alias("metric"), "step", "value")
    return tagged.filter("metric != ''").groupBy("model", "metric").agg(F.max_by("value", F.struct("step", "value")).alias("value"))


def model_scores(metrics: DataFrame, actuals: DataFrame, target: str, ids: Sequence[str] = ()) -> DataFrame:
    """``model, mape, rmse, nrmse, score``; score is sqrt(mape * rmse / mean(actual)).

    Models lacking mape or rmse are left out. With ``ids``, columns of both tables, each
    series has scores of its own, relative to the mean of its actuals.
    """
    ids = list(ids)
    wide = metrics.groupBy(*ids, "model").agg(
        F.max(F.when(F.col("metric") == "mape", F.col("value"))).alias("mape"),
        F.max(F.when(F.col("metric") == "rmse", F.col("value"))).alias("rmse"),
    ).na.drop(subset=["mape", "rmse"])
    if ids:
        wide = series_join(wide, actuals.groupBy(*ids).agg(F.avg(target).alias("_mean")), ids)
    mean = F.col("_mean") if ids else actuals.agg(F.avg(target)).scalar()
    scored = wide.withColumn("nrmse", F.try_divide(F.col("rmse"), mean))
    return scored.select(*ids, "model", "mape", "rmse", "nrmse", F.sqrt(F.col("mape") * F.col("nrmse")).alias("score"))


def best_model(scores: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest score (with ``ids``: of each series); equal scores go to the smaller name."""
    ranked = scores.filter(F.col("score").isNotNull())
    rest = [c for c in scores.columns if c not in ids]
    best = ranked.groupBy(*ids).agg(F.min_by(F.struct(*rest), F.struct("score", "model")).alias("_best"))
    return best.filter("_best is not null").select(*ids, "_best.*")


def compare_models(predictions: DataFrame, actuals: DataFrame, keys: SeriesKeys, ids: Sequence[str] = ()) -> DataFrame:
    """All models of ``predictions`` in one table: errors, scores and ``is_best``.

    With ``ids`` errors, scores and the choice are of each series. Models are compared on
    the rows that have both a prediction and an actual value.
    """
    ids = list(ids)
    errors = stage(forecast_errors(align(predictions, actuals, keys), keys, [*ids, "model"]))
    scores = model_scores(metric_rows(errors, [*ids, "model"]), actuals, keys.target, ids)
    best = best_model(scores, ids).select(*ids, F.col("model").alias("_best"))
    chosen = series_join(scores, best, ids) if ids else scores.withColumn("_best", best.select("_best").scalar())
    measured = errors.select(*ids, "model", "mae", "mape_skipped", "n")
    return null_safe_join(chosen, measured, [*ids, "model"]).select(
        *ids, "model", "mae", "rmse", "mape", "nrmse", "score", "mape_skipped", "n",
        F.coalesce(F.col("model") == F.col("_best"), F.lit(False)).alias("is_best"))


def selection_record(scores: DataFrame, kinds: dict[str, str] | None = None, promoted_at: str | None = None) -> DataFrame:
    """One row for the JSON record: the winner and what it was compared with, by model name.

    Scores have one row per model, so the map is as short as the set of models.
    """
    best = best_model(scores)
    figures = F.struct("mape", "rmse", "nrmse")
    entries = F.sort_array(F.collect_list(F.struct("model", F.struct("score", figures.alias("metrics")))))
    everything = scores.agg(F.map_from_entries(entries).alias("all_compared_models"))
    kind = F.lit("candidate")
    for name, value in (kinds or {BASELINE_NAME: "baseline"}).items():
        kind = F.when(F.col("model") == name, F.lit(value)).otherwise(kind)
    return best.select(
        F.col("model").alias("best_model_name"), kind.alias("model_type"),
        F.lit("Geometric Mean of MAPE and NRMSE").alias("selection_metric"), "score", figures.alias("metrics"),
        F.lit(promoted_at).cast("string").alias("promotion_timestamp"), everything.scalar().alias("all_compared_models"))


POINTER = "sequence bigint, version string, model string, promoted_at string"


def promoted(spark: SparkSession, path: str) -> Row | None:
    """The pointer to the version in use, with ``folder`` (model and record below it); None before the first.

    Pointers are only ever added, so a reader sees the old one or the new one.
    """
    try:
        pointers = spark.read.schema(POINTER).json(f"{path}/pointers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = pointers.agg(F.max(F.struct("sequence", "promoted_at", "version", "model")).alias("p")).filter("p is not null")
    return newest.select("p.*", F.concat(F.lit(f"{path}/versions/"), F.col("p.version")).alias("folder")).first()


def promote(scores: DataFrame, models: dict[str, object], path: str, at: str | None = None) -> str:
    """Save the winning model and its record as a new version under ``path``; returns the name.

    ``models`` maps a name to an object with ``save(path)``. Models without an entry do not
    compete. The version is written whole in a folder of its own, then one pointer to it is
    added: a failure anywhere before that leaves the version in use as it was, and model
    and record always belong together.
    """
    spark = scores.sparkSession
    usable = scores.filter(F.col("model").isin(list(models)))
    winner = best_model(usable).first()
    if winner is None:
        raise ValueError("no model with complete metrics to choose from")
    at = at or datetime.now(timezone.utc).isoformat()
    before = promoted(spark, path)
    sequence = 1 if before is None else before["sequence"] + 1
    version = f"{sequence:08d}-{uuid.uuid4().hex[:8]}"
    models[winner["model"]].save(f"{path}/versions/{version}/model")
    write_document(selection_record(usable, promoted_at=at), f"{path}/versions/{version}/model-metadata")
    pointer = spark.createDataFrame([(sequence, version, winner["model"], at)], POINTER)
    pointer.coalesce(1).write.mode("append").json(f"{path}/pointers")
    return winner["model"]
