"""Extracted table -> cleaned, split, fitted, evaluated."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, functions as F

from evenkeel.contract import LISTINGS, Contract, require_columns
from evenkeel.operators.clean import cast_numeric, dedupe_full_row, exclude_categories, outlier_filter
from evenkeel.operators.estimators import fit_pipeline, inner_model
from evenkeel.operators.evaluate import IntervalSpec, calibrate_intervals, evaluate_predictions, interval_coverage, split_sizes
from evenkeel.operators.features import FeatureState
from evenkeel.operators.intervals import segmented_interval
from evenkeel.operators.ranking import hash_number, split_by_number, split_in_three
from evenkeel.session import materialize
from evenkeel.sources.artifacts import save_model
from evenkeel.sources.tables import scan_not_null


@dataclass(frozen=True)
class TrainConfig:
    """Settings of a run. Defaults are the listing table's fixed business limits."""

    contract: Contract = LISTINGS
    area: str = "living_area"
    handle_outliers: bool = True
    min_target: float = 100000.0
    max_target: float = 5000000.0
    min_area: float = 500.0
    exclude: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"property_type": ("MOBILE",)})
    target_transform: str = "log1p"
    test_size: float = 0.2
    calibration_size: float = 0.0  # share of rows for the interval alone; with none it is calibrated on the test rows
    random_state: int = 42
    split_key: tuple[str, ...] = ()
    model_type: str = "hist_gradient_boosting"
    hyperparameters: Mapping[str, Any] = field(default_factory=dict)
    model_name: str = "listing_price"
    normalizer: str = "actual"  # or "prediction", whose intervals cover as often as they say


@dataclass(frozen=True)
class TrainResult:
    pipeline: PipelineModel
    features: FeatureState
    metrics: dict[str, Any]
    interval: IntervalSpec
    metadata: dict[str, Any]
    config: TrainConfig

    def save(self, spark, path: str) -> str:
        return save_model(spark, self.pipeline, self.metadata, asdict(self.config), path)


def prepare_training(df: DataFrame, cfg: TrainConfig, removed: Observation | None = None) -> DataFrame:
    """Contract columns plus ``is_test``, and ``is_calibration`` if there is such a share, cleaned and written once.

    The split key is hashed on the way out, so the passes that find the cut read one
    number per row and the key columns are not stored. Without a key the whole
    deduplicated row is the key. The result is a projection of the written table.
    ``removed`` receives the number of rows that the range filter drops.
    """
    c = cfg.contract
    require_columns(df, c.training_columns, "training columns")
    rows = dedupe_full_row(scan_not_null(df, c.target))
    rows = rows.withColumn("__n", hash_number(cfg.random_state, list(cfg.split_key) or rows.columns))
    for column, values in cfg.exclude.items():
        rows = exclude_categories(rows, column, values)
    rows = cast_numeric(rows, c.numeric)
    rows = outlier_filter(
        rows, c.target, cfg.area, cfg.min_target, cfg.max_target, cfg.min_area, enabled=cfg.handle_outliers, removed=removed
    )
    cleaned = materialize(rows.select(*c.training_columns, "__n"), "cleaned")
    if not cfg.calibration_size:
        return split_by_number(cleaned, "__n", cfg.test_size, stored=True).drop("__n")
    split = split_in_three(cleaned, "__n", cfg.test_size, cfg.calibration_size, stored=True)
    named = split.withColumn("is_test", F.col("part") == "test").withColumn("is_calibration", F.col("part") == "calibration")
    return named.drop("__n", "part")


def build_metadata(
    cfg: TrainConfig, pipeline: PipelineModel, state: FeatureState, metrics: dict, interval: IntervalSpec, sizes: dict
) -> dict[str, Any]:
    return {
        "model_type": type(inner_model(pipeline)).__name__,
        "model_key": cfg.model_type,
        "target_transform": cfg.target_transform,
        "hyperparameters": dict(cfg.hyperparameters),
        "test_metrics": metrics["test"],
        "val_metrics": metrics["validation"],
        "feature_names": state.feature_names(),
        "numeric_features": list(cfg.contract.numeric),
        "categorical_features": list(cfg.contract.categorical),
        "feature_defaults": dict(cfg.contract.defaults),
        "feature_aliases": dict(cfg.contract.aliases),
        "prediction_interval": asdict(interval),
        **sizes,
    }


def train_run(df: DataFrame, cfg: TrainConfig = TrainConfig()) -> TrainResult:
    """One training run. Fitting sees training rows only; nothing is promoted here.

    With a ``calibration_size`` the interval is calibrated on rows of its own, and the coverage that is
    reported is that of test rows which neither the model nor the interval saw.
    """
    removed = Observation()
    split = prepare_training(df, cfg, removed)
    sizes = split_sizes(split).first().asDict()
    filtered = cfg.handle_outliers and cfg.area in df.columns
    sizes["removed_rows"] = removed.get["removed"] if filtered else 0
    own = F.col("is_calibration") if cfg.calibration_size else F.lit(False)
    split = split.withColumn("__own", own)
    sizes["calibration_rows"] = split.where("__own").count() if cfg.calibration_size else sizes["test_size"]
    sizes["train_size"] -= sizes["calibration_rows"] if cfg.calibration_size else 0
    train = split.where("NOT is_test AND NOT __own").drop("__own")
    pipeline, state = fit_pipeline(
        train, cfg.contract, cfg.model_type, cfg.hyperparameters, cfg.target_transform, cfg.random_state
    )
    target = F.col(cfg.contract.target).cast("double").alias("actual")
    held = materialize(pipeline.transform(split.where("is_test OR __own")).select("is_test", target, "prediction"), "scored")
    scored = held.where("is_test")
    metrics, interval = evaluate_predictions(scored, "actual", "prediction", cfg.normalizer)
    if cfg.calibration_size:
        interval = calibrate_intervals(held.where("NOT is_test"), "actual", "prediction", normalizer=cfg.normalizer)
    sizes["interval_coverage"] = interval_coverage(segmented_interval(scored, interval), "actual").first()["coverage"]
    metadata = build_metadata(cfg, pipeline, state, metrics, interval, sizes)
    metrics["promote_to_production"] = False
    return TrainResult(pipeline, state, metrics, interval, metadata, cfg)
