"""Loaded model -> scored rows. One projection over the input, plus a checked lookup."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from evenkeel.contract import DISTRICT_CENTRES, Contract, require_columns
from evenkeel.operators.enrich import dim_backfill
from evenkeel.functions.numeric import nan_to_null
from evenkeel.operators.estimators import feature_importance, inner_model
from evenkeel.operators.evaluate import IntervalSpec
from evenkeel.operators.intervals import predict_with_interval
from evenkeel.operators.validate import Rule, alias_rename, optional_defaults, split_valid, validate_rows
from evenkeel.session import stored
from evenkeel.sources.artifacts import load_model
from evenkeel.sources.tables import read_csv, write_csv


OUTPUTS = ("prediction", "lower_bound", "upper_bound")


@dataclass(frozen=True)
class Backfill:
    """A dimension whose columns fill gaps: {column: dimension column} by a shared key."""

    dim: DataFrame
    key: str
    fills: Mapping[str, str]


def district_backfill(spark: SparkSession) -> Backfill:
    dim = spark.createDataFrame(list(DISTRICT_CENTRES), "vegas_district string, dim_lat double, dim_lon double")
    return Backfill(dim, "vegas_district", {"latitude": "dim_lat", "longitude": "dim_lon"})


def interval_from(metadata: Mapping[str, Any]) -> IntervalSpec | None:
    stored = metadata.get("prediction_interval") or {}
    known = {f.name for f in fields(IntervalSpec)}
    return IntervalSpec(**{k: v for k, v in stored.items() if k in known and v is not None}) if stored else None


@dataclass(frozen=True)
class Scorer:
    """A loaded model and the contract it was trained on."""

    pipeline: PipelineModel
    metadata: Mapping[str, Any]
    contract: Contract
    backfill: Backfill | None = None
    model_name: str = ""
    loaded_from: str = ""
    stage: str = "Production"

    @classmethod
    def load(cls, spark: SparkSession, path: str, backfill: Backfill | None = None, model_name: str = "") -> Scorer:
        pipeline, metadata = load_model(spark, path)
        contract = Contract(
            numeric=tuple(metadata.get("numeric_features", ())),
            categorical=tuple(metadata.get("categorical_features", ())),
            target="",
            defaults=metadata.get("feature_defaults", {}),
            aliases=metadata.get("feature_aliases", {}),
        )
        return cls(pipeline, metadata, contract, backfill, model_name, path)

    def normalize(self, df: DataFrame) -> DataFrame:
        """Contract names, backfilled columns, defaults."""
        df = alias_rename(df, self.contract.aliases)
        if self.backfill is not None:
            df = dim_backfill(df, self.backfill.dim, self.backfill.key, self.backfill.fills)
        return optional_defaults(df, self.contract.defaults)

    def predict(self, df: DataFrame) -> DataFrame:
        """Input columns as given, then prediction, lower_bound, upper_bound.

        Columns of these names in the input, from an earlier scoring, are replaced.
        """
        given = df.drop(*OUTPUTS)
        return self._scored(self.normalize(self._keeping(given)), ())

    @staticmethod
    def _keeping(df: DataFrame) -> DataFrame:
        """The input as given in one column, beside copies that normalisation may change."""
        return df.withColumn("__given", F.struct(*[F.col(f"`{c}`") for c in df.columns]))

    def _scored(self, ready: DataFrame, more: Sequence[str]) -> DataFrame:
        """Predictions of a normalised table that holds ``__given``."""
        require_columns(ready, self.contract.features, "required features")
        log_target = self.metadata.get("target_transform") == "log1p"
        # Only what the model reads goes in, so no column can clash with its own.
        inputs = ready.select("__given", *self.contract.features)
        scored = predict_with_interval(self.pipeline, interval_from(self.metadata), inputs, log_target)
        return scored.select("__given.*", *OUTPUTS, *more)

    def predict_single(self, spark: SparkSession, features: Mapping[str, Any]) -> float:
        """One record, through the same operator as a table."""
        return self.predict(spark.createDataFrame([dict(features)])).first()["prediction"]

    def predict_batch(self, df: DataFrame, rules: Sequence[Rule], located: Sequence[Rule] = ()) -> tuple[DataFrame, DataFrame]:
        """(scored valid rows, quarantined rows with errors), both with the input's columns as given.

        The input is normalised once; rules see names, backfills and defaults as the model does.
        ``located`` rules are for callers that demand what the backfill fills.
        """
        return self.split(self.checked(df, [*rules, *located]))

    def checked(self, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        """The normalised input with ``errors`` and ``valid``; ``split`` takes it on."""
        return validate_rows(self.normalize(self._keeping(df.drop(*OUTPUTS))), rules)

    def split(self, checked: DataFrame) -> tuple[DataFrame, DataFrame]:
        good, bad = split_valid(checked)
        scored = self._scored(good, ()).withColumn("model_version", F.lit(self.stage.lower()))
        return scored, bad.select("__given.*", "errors")

    def info(self, spark: SparkSession) -> DataFrame:
        """One row: what the model is, how it scored, which features it reads."""
        m = self.metadata
        raw = list(self.contract.features)
        names = list(m.get("feature_names", []))
        row = (
            self.model_name,
            self.loaded_from,
            self.stage,
            m.get("model_type"),
            json.dumps(m.get("hyperparameters"), sort_keys=True),
            json.dumps({"test": m.get("test_metrics"), "validation": m.get("val_metrics")}, sort_keys=True),
            json.dumps(m.get("prediction_interval"), sort_keys=True),
            raw,
            names,
            len(raw),
            len(names),
            m.get("train_size"),
            m.get("val_size"),
            m.get("test_size"),
        )
        return spark.createDataFrame(
            [row],
            "model_name string, loaded_from string, stage string, model_type string, hyperparameters string, "
            "metrics string, prediction_interval string, features array<string>, "
            "transformed_features array<string>, feature_count int, transformed_count int, "
            "train_size bigint, val_size bigint, test_size bigint",
        )


@dataclass(frozen=True)
class BatchResult:
    """What became of a batch: its rows on both sides, their number, and what weighs most in the model (None if it can't say)."""

    scored: DataFrame
    quarantined: DataFrame
    processed: int
    quarantined_rows: int
    top_features: list[Row] | None

    @property
    def rejected_share(self) -> float:
        return self.quarantined_rows / self.processed if self.processed else 0.0


def score_records(scorer: Scorer, df: DataFrame, rules: Sequence[Rule], target: str, top: int = 5) -> BatchResult:
    """Validate and score a batch into ``target/scored`` and ``target/quarantined``.

    The rows of either side are counted as they are written, and the batch is validated once.
    """
    spark, seen = df.sparkSession, Observation()
    checked = scorer.checked(df, rules).observe(
        seen, F.count("*").alias("processed"), F.count_if(~F.col("valid")).alias("quarantined")
    )
    with stored(checked, "checked") as kept:
        good, bad = scorer.split(kept)
        for side, rows in (("scored", good), ("quarantined", bad)):
            rows.write.parquet(f"{target}/{side}")
    weights = None
    if hasattr(inner_model(scorer.pipeline), "featureImportances"):
        weights = feature_importance(scorer.pipeline, list(scorer.metadata.get("feature_names", ())), top).collect()
    sides = [spark.read.schema(rows.schema).parquet(f"{target}/{side}") for side, rows in (("scored", good), ("quarantined", bad))]
    return BatchResult(*sides, seen.get["processed"], seen.get["quarantined"], weights)


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """``describe_contract`` with what a table holds of each feature: its rows, missing ones, lowest and highest value as text.

    One pass over the table. NaN and NULL are missing.
    """
    require_columns(df, contract.features, "features")
    numeric = set(contract.numeric)
    present = {c: nan_to_null(F.col(c).cast("double")) if c in numeric else F.col(c).cast("string") for c in contract.features}
    found = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count("*").alias("rows"),
            (F.count("*") - F.count(x)).alias("missing"),
            F.min(x).cast("string").alias("low"),
            F.max(x).cast("string").alias("high"),
        )
        for c, x in present.items()
    ]
    held = df.agg(F.array(*found).alias("found")).select(F.inline("found"))
    return describe_contract(df.sparkSession, contract).join(held, "feature")


def describe_contract(spark: SparkSession, contract: Contract) -> DataFrame:
    """One row per raw feature: kind, whether required, default, label, allowed values."""
    rows = [
        (
            i,
            c,
            "numeric" if c in contract.numeric else "categorical",
            c in contract.required,
            None if c not in contract.defaults else str(contract.defaults[c]),
            contract.labels.get(c),
            list(contract.domains.get(c, ())) or None,
        )
        for i, c in enumerate(contract.features)
    ]
    return spark.createDataFrame(
        rows,
        "position int, feature string, kind string, required boolean, default string, label string, options array<string>",
    )


def score_file(scorer: Scorer, spark: SparkSession, source: str, target: str, schema: StructType | str | None = None) -> None:
    """CSV in, the same columns plus prediction and bounds as CSV out."""
    write_csv(scorer.predict(read_csv(spark, source, schema)), target, mode="overwrite")
