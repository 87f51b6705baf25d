"""Model imputation of null targets with boosted trees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.calendar import baseline_features, no_gaps
from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import fit_matrix, stage
from demandspark.operators.outliers import null_outliers

# Features of the imputation model.
IMPUTE_FEATURES = (
    "sin_hour", "cos_hour", "sin_weekday", "cos_weekday", "sin_dayofyear", "cos_dayofyear",
    "y_yesterday", "y_last_week", "y_last_year",
)


@dataclass(frozen=True)
class ImputeConfig:
    features: tuple[str, ...] = IMPUTE_FEATURES
    outlier_multiplier: float = 1.5
    quantile_mode: str = "nearest"
    trees: int = 150
    learning_rate: float = 0.05
    depth: int = 5
    seed: int = 42


def _vectors(df: DataFrame, keys: SeriesKeys, features: Sequence[str]) -> DataFrame:
    """Feature vector beside the untouched columns; gaps in features count as 0."""
    clean = no_gaps(df.select(*keys.key, keys.target, *features), features)
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    return assembler.transform(clean)


def model_impute(df: DataFrame, keys: SeriesKeys, config: ImputeConfig = ImputeConfig(),
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Fill null targets by a model fitted on the known rows; adds ``is_imputed``.

    Runs Spark jobs: the fit. ``fit_on`` restricts the rows that are learned
    from (default: all of ``df``). With nothing to fill or nothing to learn from,
    the table comes back with the flag false.
    """
    y = keys.target
    known_here, unknown = df.filter(F.col(y).isNotNull()), df.filter(F.col(y).isNull())
    known = known_here if fit_on is None else fit_on.filter(F.col(y).isNotNull())
    training = _vectors(known, keys, config.features).select(
        "_features", F.col(y).alias("label")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if unknown.isEmpty() or not (rows := training.count()):
            return df.withColumn("is_imputed", F.lit(False))
        model = GBTRegressor(
            featuresCol="_features", labelCol="label", predictionCol="_yhat", maxIter=config.trees,
            stepSize=config.learning_rate, maxDepth=config.depth, seed=config.seed,
        ).fit(fit_matrix(training, rows))
    finally:
        training.unpersist()
    gaps = no_gaps(unknown.withColumns({f"_f_{f}": F.col(f) for f in config.features}),
                   [f"_f_{f}" for f in config.features])
    assembler = VectorAssembler(inputCols=[f"_f_{f}" for f in config.features], outputCol="_features")
    filled = model.transform(assembler.transform(gaps)).select(
        *[F.col("_yhat").alias(c) if c == y else F.col(c) for c in df.columns], F.lit(True).alias("is_imputed"))
    return known_here.withColumn("is_imputed", F.lit(False)).unionByName(filled)


def impute_series(df: DataFrame, keys: SeriesKeys, config: ImputeConfig = ImputeConfig(),
                  bad_times: Sequence = (), fit_before=None) -> DataFrame:
    """Features, fence, model: the whole repair of a grid series.

    Lags are taken after known bad values are nulled and before the fence. With
    ``fit_before`` the model learns only from rows earlier than this time.
    """
    featured = stage(baseline_features(df, keys, bad_times))
    fenced = null_outliers(featured, keys, config.outlier_multiplier, config.quantile_mode)
    fenced = stage(fenced)
    return model_impute(fenced, keys, config, None if fit_before is None else fenced.where(F.col(keys.time) < F.lit(fit_before)))


def imputed_count(df: DataFrame, keys: SeriesKeys) -> DataFrame:
    return df.groupBy(*keys.ids).agg(F.count_if("is_imputed").alias("imputed_values_count"))
