"""Model governance as queries over ``runs`` and ``model_versions``, many models at once.

``model_versions``: model, version (text holding a number), stage, run_id.
``runs``: run_id, model and one column per metric. No join here is broadcast by
hint: either table may be large, so the planner decides by size and splits skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.operators.ranking import numbered_within

# Stage names, gate threshold and metric.
PRODUCTION = "Production"
ARCHIVED = "Archived"
IMPROVEMENT = 0.02
METRIC = "test_r2"


def version_number(version: str = "version") -> Column:
    """Versions compare as numbers: "10" is newer than "9"."""
    return F.col(version).cast("bigint")


def list_versions(versions: DataFrame, model: str | None = None) -> DataFrame:
    if model is not None:
        versions = versions.where(F.col("model") == model)
    return versions.orderBy("model", version_number())


def latest_version(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Newest version per model, within one stage if given.

    The highest number per model is a hash aggregate over two columns; the rows that hold it are
    found by joining it back.
    """
    if stage is not None:
        versions = versions.where(F.col("stage") == stage)
    numbered = versions.withColumn("__number", version_number())
    newest = numbered.groupBy(F.col("model").alias("__model")).agg(F.max("__number").alias("__newest"))
    same = (F.col("model") == F.col("__model")) & (F.col("__number") == F.col("__newest"))
    return numbered.join(newest, same).select("model", "version", "stage", "run_id")


def resolve_version(versions: DataFrame, model: str, version: str | None = None, stage: str | None = None) -> str:
    """``version`` if one is given, otherwise the newest one (of ``stage``, where that is given)."""
    if version:
        return str(version)
    newest = latest_version(versions.where(F.col("model") == model), stage).select("version").head()
    if newest is None:
        where = "in any stage" if stage is None else f"in stage {stage}"
        raise ValueError(f"model {model!r} has no version {where}")
    return newest.version


def single_value(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """One row per key: repeats that agree collapse, repeats that contradict each other fail the job."""
    c = F.col(value).cast("double")
    clash = F.raise_error(F.concat(F.lit(f"{key} has several values of {value}: "), F.col(key).cast("string"))).cast("double")
    folded = rows.groupBy(key).agg(F.min(c).alias("__low"), F.max(c).alias("__high"))
    return folded.select(key, F.when(F.col("__low").eqNullSafe(F.col("__high")), F.col("__low")).otherwise(clash).alias(name))


def champion_metric(versions: DataFrame, runs: DataFrame, metric: str = METRIC) -> DataFrame:
    """model, version, run_id, production_metric of each model's newest Production version.

    A run recorded twice with one metric counts once; with two it is an error.
    """
    champions = latest_version(versions, PRODUCTION).drop("stage")
    metrics = single_value(runs, "run_id", metric, "production_metric")
    return champions.join(metrics, "run_id", "left").select("model", "version", "run_id", "production_metric")


def gate_passes(candidate: Column, champion: Column, threshold: float = IMPROVEMENT) -> Column:
    """Without a champion passes; otherwise the gain must be strictly above the threshold.

    NaN is no metric: a candidate with it never passes, and a champion with it is never beaten.
    """
    comparable = ~F.isnan(candidate) & ~F.isnan(champion)
    better = F.coalesce(comparable & (candidate - champion > F.lit(float(threshold))), F.lit(False))
    return F.coalesce(~F.isnan(candidate), F.lit(True)) & (champion.isNull() | better)


def promotion_gate(
    candidates: DataFrame, champions: DataFrame, metric: str = METRIC, threshold: float = IMPROVEMENT
) -> DataFrame:
    """Candidates (model, run_id, metric) with production_metric and ``passed``."""
    side = single_value(champions, "model", "production_metric", "production_metric")
    joined = candidates.join(side, "model", "left")
    return joined.withColumn("passed", gate_passes(F.col(metric), F.col("production_metric"), threshold))


def register_versions(versions: DataFrame, candidates: DataFrame, order: str, stage: str = "None") -> DataFrame:
    """New version rows for candidate runs: numbers continue from each model's highest.

    Candidates without a model are numbered among themselves, after versions without one.
    """
    highest = versions.groupBy(F.col("model").alias("__model")).agg(F.max(version_number()).alias("__highest"))
    numbered = numbered_within(candidates, "model", order, ["run_id"], "__next")
    joined = numbered.join(highest, F.col("model").eqNullSafe(F.col("__model")), "left")
    number = F.coalesce(F.col("__highest"), F.lit(0)) + F.col("__next")
    return joined.select("model", number.cast("string").alias("version"), F.lit(stage).alias("stage"), "run_id")


def absent_targets(versions: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets (model, version, stage) that name no version."""
    return targets.join(versions.select("model", "version"), ["model", "version"], "left_anti")


def promote_transition(versions: DataFrame, targets: DataFrame) -> DataFrame:
    """All versions with their stage after moving each target (model, version, stage).

    A version that reaches Production archives its model's other Production versions. A target
    that names no version moves and archives nothing (``absent_targets`` has it). Repeated targets
    count once; two stages for one version, or two versions of a model to Production, fail the job.
    """
    one = F.min("stage") == F.max("stage")
    clash = F.raise_error(F.concat(F.lit("contradicting targets for model "), F.col("model"))).cast("string")
    moves = targets.groupBy("model", "version").agg(F.when(one, F.min("stage")).otherwise(clash).alias("__to"))
    moved = versions.join(moves, ["model", "version"], "left")
    promoted = moved.where(F.col("__to") == PRODUCTION).groupBy("model")
    newcomer = F.when(F.min("version") == F.max("version"), F.min("version")).otherwise(clash)
    holders = promoted.agg(newcomer.alias("__holder"))
    stage = (
        F.when(F.col("__to").isNotNull(), F.col("__to"))
        .when(F.col("__holder").isNotNull() & (F.col("stage") == PRODUCTION), ARCHIVED)
        .otherwise(F.col("stage"))
    )
    return moved.join(holders, "model", "left").withColumn("stage", stage).select(*versions.columns)


def promote_infer_metric(
    candidates: DataFrame,
    versions: DataFrame,
    runs: DataFrame,
    metric: str = METRIC,
    threshold: float = IMPROVEMENT,
) -> DataFrame:
    """Gate candidates (model, run_id) by the metric found with their run.

    Without a metric: promoted where the model has no Production version, ``error``
    where it has one. Errors stay in the result as rows.
    """
    found = single_value(runs, "run_id", metric, "candidate_metric")
    champions = champion_metric(versions, runs, metric).select(
        "model", F.col("version").alias("champion_version"), "production_metric"
    )
    joined = candidates.join(found, "run_id", "left").join(champions, "model", "left")
    unknown = F.col("candidate_metric").isNull()
    outcome = (
        F.when(unknown & F.col("champion_version").isNotNull(), "error")
        .when(unknown, "promoted")
        .when(gate_passes(F.col("candidate_metric"), F.col("production_metric"), threshold), "promoted")
        .otherwise("rejected")
    )
    return joined.withColumn("outcome", outcome).select(
        "model", "run_id", "candidate_metric", "production_metric", "outcome"
    )
