"""Model folders on any path Spark can write: ``pipeline``, ``metadata``, ``config``.

A published model is such a folder under a number of its own, ``published=N``, of which the newest
complete one counts: whoever loads the path gets the old model until the new one is whole.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from datetime import datetime, timezone
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from evenkeel.sources.folders import complete, newest_complete, next_number

logger = logging.getLogger(__name__)

PUBLISHED = "published"


def _write_json(spark: SparkSession, path: str, payload: Mapping[str, Any]) -> None:
    line = json.dumps(payload, indent=2, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str) -> dict[str, Any] | None:
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return json.loads(row["value"]) if row else None


def save_model(
    spark: SparkSession, pipeline: PipelineModel, metadata: Mapping[str, Any], config: Mapping[str, Any] | None, path: str
) -> str:
    """Overwrite the folder; metadata last, so a folder with metadata is complete."""
    pipeline.write().overwrite().save(f"{path}/pipeline")
    if config is not None:
        _write_json(spark, f"{path}/config", config)
    _write_json(spark, f"{path}/metadata", metadata)
    return path


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, Any]]:
    """A missing pipeline is an error; missing metadata is an empty dict and a warning.

    Of a path that was published to, the newest complete model is loaded.
    """
    number = newest_complete(spark, path, PUBLISHED)
    path = path if number is None else f"{path}/{PUBLISHED}={number}"
    try:
        pipeline = PipelineModel.load(f"{path}/pipeline")
    except (Py4JJavaError, AnalysisException) as e:
        raise FileNotFoundError(f"no model pipeline at {path}") from e
    metadata = _read_json(spark, f"{path}/metadata")
    if metadata is None:
        logger.warning("no metadata at %s: using none", path)
    return pipeline, metadata or {}


def publish_model(
    spark: SparkSession, source: str, target: str, model: str, version: str, run_id: str, stage: str = "Production"
) -> dict[str, Any]:
    """Copy a version's folder to a stable path and add where it came from to its metadata.

    A version without a configuration is published without one. Dying half-way leaves the model
    before it in force.
    """
    pipeline, metadata = load_model(spark, source)
    # Fixed format: lineage fields of a published model.
    lineage = {
        "registry_model_name": model,
        "registry_version": str(version),
        "run_id": run_id,
        "promotion_stage": stage,
        "promotion_timestamp": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "artifact_delivery": "local_production_snapshot",
    }
    place = f"{target}/{PUBLISHED}={next_number(spark, target, PUBLISHED)}"
    save_model(spark, pipeline, metadata | lineage, _read_json(spark, f"{source}/config"), place)
    complete(spark, place)
    return metadata | lineage
