"""Estimator families and the log-target wrapper."""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping
from typing import Any

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from evenkeel.contract import Contract
from evenkeel.operators.features import FeatureState, fit_features

logger = logging.getLogger(__name__)

# Accepted family names.
FAMILIES = {
    "gradient_boosting": "gradient_boosting",
    "GradientBoostingRegressor": "gradient_boosting",
    "hist_gradient_boosting": "hist_gradient_boosting",
    "HistGradientBoostingRegressor": "hist_gradient_boosting",
    "random_forest": "random_forest",
    "RandomForestRegressor": "random_forest",
    "ridge": "ridge",
    "Ridge": "ridge",
}

# Configured name -> Spark parameter, per family.
PARAMETERS = {
    "ridge": {"alpha": "alpha"},
    "random_forest": {
        "n_estimators": "numTrees",
        "max_depth": "maxDepth",
        "min_samples_leaf": "minInstancesPerNode",
        "max_bins": "maxBins",
        "bootstrap": "bootstrap",
    },
    "gradient_boosting": {
        "n_estimators": "maxIter",
        "learning_rate": "stepSize",
        "max_depth": "maxDepth",
        "min_samples_leaf": "minInstancesPerNode",
        "subsample": "subsamplingRate",
    },
    "hist_gradient_boosting": {
        "max_iter": "maxIter",
        "learning_rate": "stepSize",
        "min_samples_leaf": "minInstancesPerNode",
        "max_depth": "maxDepth",
        "max_bins": "maxBins",
    },
}

DEFAULTS = {
    "ridge": {"alpha": 1.0},
    "random_forest": {"numTrees": 100, "featureSubsetStrategy": "all", "maxDepth": 30},
    "gradient_boosting": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3},
    "hist_gradient_boosting": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "maxBins": 255, "minInstancesPerNode": 20},
}

# Fits of trees keep their rows in memory, about this many bytes a row and 4 more a feature; a task gets so many of them.
ROW_BYTES = 240
TASK_BYTES = 64_000_000


def family_of(name: str) -> str:
    if name not in FAMILIES:
        raise ValueError(f"Unsupported model_type '{name}'. Known: {sorted(FAMILIES)}")
    return FAMILIES[name]


def resolve_parameters(name: str, hyperparameters: Mapping[str, Any] | None) -> dict[str, Any]:
    """Spark parameters; what the family does not take is dropped and logged."""
    family = family_of(name)
    known = PARAMETERS[family]
    ignored = sorted(set(hyperparameters or {}) - set(known))
    if ignored:
        logger.warning("%s ignores hyperparameters %s", family, ignored)
    given = {known[k]: v for k, v in (hyperparameters or {}).items() if k in known and v is not None}
    return DEFAULTS[family] | given


def make_estimator(name: str, hyperparameters: Mapping[str, Any] | None, seed: int, label_std: float, rows: int) -> Estimator:
    """Unfitted Spark estimator reading ``features`` and ``__label``.

    Spark's linear regression divides the penalty by the row count and multiplies it
    by the label's deviation; undoing both gives the ridge objective with ``alpha``.
    The normal equations solve it in closed form and are asked for by name: left to choose,
    Spark turns to an iterative fit beyond 4,096 features; here those are an error of the fit.
    """
    family, params = family_of(name), resolve_parameters(name, hyperparameters)
    columns = {"featuresCol": "features", "labelCol": "__label", "predictionCol": "__raw"}
    if family == "ridge":
        penalty = params["alpha"] * (label_std or 1.0) / rows
        return LinearRegression(**columns, regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal")
    if family == "random_forest":
        return RandomForestRegressor(**columns, seed=seed, **params)
    return GBTRegressor(**columns, seed=seed, **params)


def spread(ready: DataFrame, rows: int, features: int) -> DataFrame:
    """``ready`` in as many parts as keep each below ``TASK_BYTES``, however many rows a stored file's split has."""
    parts = math.ceil(rows * (ROW_BYTES + 4 * features) / TASK_BYTES)
    return ready.repartition(max(parts, ready.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else ready


def fit_pipeline(
    train: DataFrame,
    contract: Contract,
    model_type: str,
    hyperparameters: Mapping[str, Any] | None = None,
    target_transform: str = "log1p",
    seed: int = 42,
) -> tuple[PipelineModel, FeatureState]:
    """Fit features and estimator; the pipeline ends with ``prediction`` on the target's scale."""
    state = fit_features(train, contract)
    label = F.col(contract.target).cast("double")
    label = F.log1p(label) if target_transform == "log1p" else label
    feature_stages = state.stages(train)
    ready = PipelineModel(feature_stages).transform(train.withColumn("__label", label)).select("features", "__label")
    rows, std = ready.agg(F.count("__label"), F.stddev_pop("__label")).first()
    if family_of(model_type) != "ridge":
        ready = spread(ready, rows, len(contract.numeric) + sum(state.sizes.values()))
    model = make_estimator(model_type, hyperparameters, seed, std, rows).fit(ready)
    inverse = "expm1(__raw)" if target_transform == "log1p" else "__raw"
    finish = SQLTransformer(statement=f"SELECT * EXCEPT (__raw, features), {inverse} AS prediction FROM __THIS__")
    return PipelineModel([*feature_stages, model, finish]), state


def inner_model(pipeline: PipelineModel):
    """The fitted regressor within a pipeline from ``fit_pipeline``."""
    return pipeline.stages[-2]


def feature_importance(pipeline: PipelineModel, names: list[str], top: int = 10) -> DataFrame:
    """Top features, largest importance first; a linear model has none and is an error."""
    model = inner_model(pipeline)
    if not hasattr(model, "featureImportances"):
        raise ValueError(f"{type(model).__name__} weighs no features")
    # One number per feature, from the fitted model rather than from rows.
    pairs = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray(), strict=True)]
    frame = SparkSession.active().createDataFrame(pairs, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature").limit(top)
