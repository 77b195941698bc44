"""Registry tables and the drift -> train -> gate -> publish chain."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from evenkeel.operators.clean import latest_per_key
from evenkeel.operators.registry import (
    METRIC,
    PRODUCTION,
    absent_targets,
    champion_metric,
    promote_transition,
    promotion_gate,
    resolve_version,
)
from evenkeel.plans.monitoring import run_drift_check
from evenkeel.plans.training import TrainConfig, train_run
from evenkeel.sources.artifacts import publish_model
from evenkeel.sources.commits import claim, names, newest, numbered, read, replace

logger = logging.getLogger(__name__)

RUNS = "run_id string, model string, test_r2 double, path string, created bigint"
VERSIONS = "model string, version string, stage string, run_id string, seq bigint"


@dataclass(frozen=True)
class Registry:
    """``runs`` and a log of stage changes per model, files of JSON rows under one base path.

    A run is a file named by its id, so recording it again replaces it. A change of a model's
    versions is the next entry of its log; making an entry fails if another writer made one of
    that number meanwhile, and the change is then worked out anew from the log as it is. So
    any number of writers may register and promote at once. An entry also carries the highest version
    so far: a new version needs no look at the older entries. The current stage of a version
    is its newest log row.
    """

    spark: SparkSession
    base: str

    def _table(self, name: str, schema: str) -> DataFrame:
        if not names(self.spark, f"{self.base}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{self.base}/{name}")

    def runs(self) -> DataFrame:
        return self._table("runs", RUNS)

    def log(self) -> DataFrame:
        return self._table("version_log", VERSIONS)

    def versions(self) -> DataFrame:
        return latest_per_key(self.log(), ["model", "version"], "seq", []).drop("seq")

    def _log(self, model: str) -> str:
        return f"{self.base}/version_log/{quote(model, safe='')}"

    def _head(self, model: str) -> tuple[int, int]:
        """Number of the newest entry of a model's log, and the highest version up to it."""
        seq = newest(self.spark, self._log(model))
        if seq is None:
            return 0, 0
        return seq, read(self.spark, f"{self._log(model)}/{numbered(seq)}")[0]["highest"]

    def _commit(self, model: str, seq: int, highest: int, rows: list[tuple[str, str, str]]) -> bool:
        """Enter (version, stage, run_id) changes under ``seq``; False if another writer was first."""
        entry = [
            {"model": model, "version": version, "stage": stage, "run_id": run_id, "seq": seq, "highest": highest}
            for version, stage, run_id in rows
        ]
        return claim(self.spark, f"{self._log(model)}/{numbered(seq)}", entry)

    def _run_file(self, run_id: str) -> str:
        return f"{quote(run_id, safe='')}.json"

    def add_run(self, run_id: str, model: str, test_r2: float | None, path: str) -> None:
        others = [n for n in names(self.spark, f"{self.base}/runs") if n != self._run_file(run_id)]
        row = {"run_id": run_id, "model": model, "test_r2": test_r2, "path": path, "created": len(others) + 1}
        replace(self.spark, f"{self.base}/runs/{self._run_file(run_id)}", [row])

    def register(self, run_id: str, model: str) -> str:
        """A new version for a run; its number."""
        recorded = self._run_file(run_id) in names(self.spark, f"{self.base}/runs")
        if not recorded or read(self.spark, f"{self.base}/runs/{self._run_file(run_id)}")[0]["model"] != model:
            raise ValueError(f"run '{run_id}' of model '{model}' is not recorded")
        while True:
            seq, highest = self._head(model)
            version = str(highest + 1)
            if self._commit(model, seq + 1, highest + 1, [(version, "None", run_id)]):
                return version

    def promote(self, model: str, version: str, stage: str = PRODUCTION) -> str:
        """Move a version to a stage, archiving the previous Production holder; only changes are logged.

        A version that isn't there is an error, and nothing is archived.
        """
        target = self.spark.createDataFrame([(model, str(version), stage)], "model string, version string, stage string")
        while True:
            seq, highest = self._head(model)
            log = self.log().where((F.col("model") == model) & (F.col("seq") <= seq))
            current = latest_per_key(log, ["model", "version"], "seq", []).drop("seq")
            if not absent_targets(current, target).isEmpty():
                raise ValueError(f"model {model!r} has no version {version} to promote")
            after = promote_transition(current, target)
            before = current.select("model", "version", F.col("stage").alias("__old"))
            changed = after.join(before, ["model", "version"]).where(F.col("stage") != F.col("__old"))
            # The version and those that held Production.
            rows = [(r["version"], r["stage"], r["run_id"]) for r in changed.collect()]
            if not rows or self._commit(model, seq + 1, highest, rows):
                return str(version)

    def champion(self, model: str, metric: str = METRIC) -> float | None:
        versions = self.versions().where(F.col("model") == model)
        row = champion_metric(versions, self.runs(), metric).first()
        return row["production_metric"] if row else None

    def evaluate_and_promote(self, model: str, run_id: str, metric: float, threshold: float = 0.02, stage: str = PRODUCTION) -> dict[str, Any]:
        """Gate one run; register and promote it if it passes."""
        versions = self.versions().where(F.col("model") == model)
        candidate = self.spark.createDataFrame([(model, run_id, float(metric))], "model string, run_id string, test_r2 double")
        row = promotion_gate(candidate, champion_metric(versions, self.runs()), threshold=threshold).first()
        outcome = {"passed": row["passed"], "production_metric": row["production_metric"], "version": None}
        if row["passed"]:
            outcome["version"] = self.promote(model, self.register(run_id, model), stage)
        return outcome | {"registered": row["passed"], "promoted": row["passed"]}

    def promote_run(self, model: str, run_id: str, metric: float | None = None, stage: str = PRODUCTION) -> dict[str, Any]:
        """Gate a run by the given metric or its recorded one.

        With neither: promoted where the model has no Production version, otherwise an error.
        """
        if metric is None:
            row = self.runs().where(F.col("run_id") == run_id).select(METRIC).first()
            metric = row[METRIC] if row else None
        if metric is not None:
            return self.evaluate_and_promote(model, run_id, metric, stage=stage)
        held = self.versions().where((F.col("model") == model) & (F.col("stage") == PRODUCTION))
        if held.limit(1).count():
            raise ValueError(f"run '{run_id}' has no {METRIC} to compare with the Production version of '{model}'")
        version = self.promote(model, self.register(run_id, model), stage)
        return {"passed": True, "registered": True, "promoted": True, "version": version, "production_metric": None}

    def publish(self, model: str, target: str) -> dict[str, Any]:
        """Copy the newest Production version's folder to a stable path."""
        versions = self.versions().where(F.col("model") == model)
        version = resolve_version(versions, model, stage=PRODUCTION)
        run_id = versions.where(F.col("version") == version).first()["run_id"]
        source = self.runs().where(F.col("run_id") == run_id).first()["path"]
        return publish_model(self.spark, source, target, model, version, run_id)


def run_lifecycle(
    df: DataFrame, cfg: TrainConfig, registry: Registry, snapshot_path: str, publish_path: str, date: str | None, threshold: float = 0.01
) -> DataFrame:
    """One row: what the drift check, training, gate and publishing did.

    A failing drift check means no retraining; each later step runs only if the one before allows it.
    """
    spark = df.sparkSession
    row = {"drift_level": None, "psi": None, "retrained": False, "test_r2": None, "promoted": False, "version": None, "published": False, "reason": None}
    try:
        drift = run_drift_check(df, snapshot_path, cfg.contract.target, date, threshold).first()
        row |= {"drift_level": drift["drift_level"], "psi": drift["psi"], "reason": drift["reason"]}
        retrain = drift["should_retrain"]
    except Exception as e:  # noqa: BLE001 - any failed check must leave the current model alone
        logger.warning("drift check failed, retraining skipped: %s", e)
        row["reason"], retrain = f"Drift check failed: {e}", False
    if retrain:
        result = train_run(df, cfg)
        run_id = uuid.uuid4().hex
        path = result.save(spark, f"{registry.base}/models/{run_id}")
        r2 = result.metrics["test"]["r2"]
        registry.add_run(run_id, cfg.model_name, r2, path)
        gate = registry.evaluate_and_promote(cfg.model_name, run_id, r2)
        row |= {"retrained": True, "test_r2": r2, "promoted": gate["promoted"], "version": gate["version"]}
        if gate["promoted"]:
            registry.publish(cfg.model_name, publish_path)
            row["published"] = True
    return spark.createDataFrame(
        [tuple(row.values())],
        "drift_level string, psi double, retrained boolean, test_r2 double, promoted boolean, version string, published boolean, reason string",
    )
