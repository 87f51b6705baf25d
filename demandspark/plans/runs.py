"""The two composed runs. Stages hand over through written tables, so each starts
from files, whatever happens to executors in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.operators import contracts as C
from demandspark.operators.chunks import null_safe_join, series_join, stage
from demandspark.operators.drift import drift_report
from demandspark.operators.impute import impute_series
from demandspark.operators.metrics import align, forecast_errors, history_rows, metric_rows
from demandspark.operators.naive import seasonal_naive
from demandspark.operators.profile import month_mean, weekday_mean
from demandspark.operators.select import BASELINE_NAME, model_scores, promote
from demandspark.operators.spine import insert_missing
from demandspark.operators.split import split_by_horizon
from demandspark.operators.trees import evaluate, fit_variant, prepare_test, prepare_training, search
from demandspark.plans.config import RunConfig
from demandspark.sources.grid import list_sheets, read_sheets
from demandspark.sources.tables import (
    METRICS, append_metrics, latest_metrics, next_step, read_if_there, read_table, write_keyed, write_table)


MANIFEST = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("modified", T.TimestampType()), T.StructField("partition_key", T.StringType())])
CHECKS = T.StructType([
    T.StructField("is_valid", T.BooleanType()), T.StructField("reason", T.StringType()),
    T.StructField("data_rows", T.LongType()), T.StructField("bad_rows", T.LongType()),
    T.StructField("date_cell", T.StringType()), T.StructField("sheet_date", T.TimestampNTZType()),
    T.StructField("partition_key", T.StringType())])
REMOVED = "removed"


def sheet_checks(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """One row per sheet that is there: valid or not, and why."""
    return read_if_there(spark, cfg.path("checks"), CHECKS).filter(F.coalesce(F.col("reason") != REMOVED, F.lit(True)))


def read_primary(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Rows of the sheets that are there and passed; what an earlier state of a sheet left does not count."""
    fields = [*cfg.contract.primary_schema().fields, T.StructField("source_key", T.StringType())]
    rows = read_if_there(spark, cfg.path("primary"), T.StructType(fields))
    good = sheet_checks(spark, cfg).filter("reason is null").select(F.col("partition_key").alias("source_key"))
    return series_join(rows, good, ["source_key"], "left_semi")


def ingest(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    """Take in the sheets that are new, changed or gone since the last run.

    The listing (path, size, time of change) is compared with the manifest of the last run.
    Only sheets that differ are read and checked, and only their parts of the tables are
    replaced: first rows, then checks, the manifest last. After a failure in between the
    same sheets count as changed again, and writing them twice changes nothing. The driver
    holds the changed paths, which is less than the listing that any read of them makes.
    """
    listing = stage(list_sheets(spark, cfg.sheets, cfg.key_pattern))
    manifest = read_if_there(spark, cfg.path("manifest"), MANIFEST)
    changed = null_safe_join(listing, manifest, ["partition_key", "path", "size", "modified"], "left_anti")
    gone = null_safe_join(manifest.filter("path is not null"), listing.select("partition_key"), ["partition_key"], "left_anti")
    changed, gone = stage(changed), stage(gone)
    paths = [r["path"] for r in changed.select("path").collect()]
    if paths:
        grid = stage(read_sheets(spark, paths, pattern=cfg.key_pattern))
        checks = stage(C.check_sheets(grid, cfg.contract))
        write_keyed(C.to_primary(grid, checks, cfg.contract), cfg.path("primary"), "source_key")
        write_keyed(checks.select(*CHECKS.names), cfg.path("checks"), "partition_key")
        write_keyed(changed.select(*MANIFEST.names), cfg.path("manifest"), "partition_key")
    if not gone.isEmpty():
        blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in (*CHECKS, *MANIFEST) if f.name != "partition_key"}
        blank |= {"is_valid": F.lit(False).alias("is_valid"), "reason": F.lit(REMOVED).alias("reason")}
        for schema, name in ((CHECKS, "checks"), (MANIFEST, "manifest")):
            rows = gone.select(*[blank.get(c, F.col("partition_key")) for c in schema.names])
            write_keyed(rows, cfg.path(name), "partition_key")
    C.require_primary(read_primary(spark, cfg).drop("source_key"), cfg.contract)
    return C.counters(sheet_checks(spark, cfg)).first().asDict() | {"sheets_read": len(paths)}


def process(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    """Primary table to repaired series, train and test parts."""
    primary = read_primary(spark, cfg)
    series = C.to_series(primary, cfg.keys, cfg.contract).withColumn("unique_id", F.lit(cfg.series_id))
    write_table(impute_series(insert_missing(series, cfg.keys), cfg.keys, cfg.impute, cfg.bad_times),
                cfg.path("preprocessed"))
    repaired = read_table(spark, cfg.path("preprocessed"))
    train, test = split_by_horizon(repaired, cfg.keys, cfg.horizon, cfg.test_days)
    write_table(train, cfg.path("train"))
    write_table(test, cfg.path("test"))
    seen = repaired.agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_imputed").alias("imputed")).first()
    return seen.asDict()


def daily(spark: SparkSession, cfg: RunConfig) -> dict[str, dict[str, int]]:
    return {"ingest": ingest(spark, cfg), "process": process(spark, cfg)}


class _Naive:
    """Saves what a seasonal naive model consists of: its last season."""

    def __init__(self, train: DataFrame, cfg: RunConfig) -> None:
        self.train, self.cfg = train, cfg

    def save(self, path: str) -> None:
        write_table(seasonal_naive(self.train, self.cfg.keys, self.cfg.season, self.cfg.season), path)


def weekly(spark: SparkSession, cfg: RunConfig) -> dict[str, object]:
    """Daily run, then baseline, candidates, selection and the analysis tables."""
    counts: dict[str, object] = daily(spark, cfg)
    keys = cfg.keys
    train, test = read_table(spark, cfg.path("train")), read_table(spark, cfg.path("test"))
    n_test = cfg.horizon * cfg.test_days
    append_metrics(spark.createDataFrame([], METRICS), cfg.path("metrics"))  # so that a first run has a history
    run = next_step(read_table(spark, cfg.path("metrics"), METRICS)) if cfg.run is None else cfg.run

    naive = seasonal_naive(train, keys, cfg.season, n_test).withColumn("model", F.lit(BASELINE_NAME))
    errors = forecast_errors(align(naive, test, keys), keys, ["model"])
    append_metrics(history_rows(metric_rows(errors, ["model"]), "baseline", run), cfg.path("metrics"))

    write_table(prepare_training(train, keys), cfg.path("candidate_train"))
    write_table(prepare_test(test, keys), cfg.path("candidate_test"))
    c_train, c_test = read_table(spark, cfg.path("candidate_train")), read_table(spark, cfg.path("candidate_test"))
    models = []
    for variant in cfg.variants:
        params, _ = search(c_train, keys, variant, cfg.trials, cfg.horizon, ranges=cfg.search_ranges)
        models.append(fit_variant(c_train, keys, variant, params))
    if models:
        write_table(evaluate(models, c_test, c_train, keys), cfg.path("predictions"))
        errors = forecast_errors(read_table(spark, cfg.path("predictions")), keys, ["model"])
        append_metrics(history_rows(metric_rows(errors, ["model"]), "candidate", run), cfg.path("metrics"))

    metrics = latest_metrics(read_table(spark, cfg.path("metrics"), METRICS))
    scores = model_scores(metrics, test, keys.target)
    counts["best_model"] = promote(
        scores, {BASELINE_NAME: _Naive(train, cfg), **{m.name: m for m in models}}, cfg.path("best"))

    write_table(drift_report(train, test, keys, cfg.drift_rows), cfg.path("analysis/drift"))
    write_table(month_mean(train, keys), cfg.path("analysis/month_mean"))
    write_table(weekday_mean(train, keys), cfg.path("analysis/weekday_mean"))
    return counts
