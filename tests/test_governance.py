from concurrent.futures import ThreadPoolExecutor

import pytest

from evenkeel.operators.registry import (
    champion_metric,
    latest_version,
    promote_transition,
    promotion_gate,
    register_versions,
    resolve_version,
)
from evenkeel.plans.lifecycle import Registry, run_lifecycle
from evenkeel.plans.training import TrainConfig
from evenkeel.session import scratch_path
from evenkeel.sources.artifacts import load_model

VERSIONS = "model string, version string, stage string, run_id string"


@pytest.fixture
def registry(spark):
    return Registry(spark, scratch_path(spark, "registry"))


def test_newest_version_is_numeric_and_by_stage(spark):
    rows = [("m", "1", "Staging", "a"), ("m", "2", "Production", "b"), ("m", "9", "Production", "c"), ("m", "10", "Production", "d"), ("m", "11", "None", "e")]
    versions = spark.createDataFrame(rows, VERSIONS)
    assert resolve_version(versions, "m", stage="Production") == "10"
    assert resolve_version(versions, "m") == "11"
    assert resolve_version(versions, "m", version="3") == "3"
    with pytest.raises(ValueError, match="has no version"):
        resolve_version(versions, "other")
    assert latest_version(versions, "Staging").first()["version"] == "1"


@pytest.mark.parametrize(
    "candidate, champion, passed", [(0.9, None, True), (0.9, 0.91, False), (0.75, 0.5, False), (0.76, 0.5, True), (None, 0.5, False), (None, None, True),
     (float("nan"), 0.5, False), (float("nan"), None, False), (0.9, float("nan"), False)]
)
def test_gate_is_strict(spark, candidate, champion, passed):
    left = spark.createDataFrame([("m", "r", candidate)], "model string, run_id string, test_r2 double")
    right = spark.createDataFrame([("m", champion)], "model string, production_metric double")
    assert promotion_gate(left, right, threshold=0.25).first()["passed"] is passed


def test_two_writers_get_distinct_versions(spark, registry):
    runs = [f"r{i}" for i in range(20)]
    for run in runs:
        registry.add_run(run, "m", 0.5, "")
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda run: registry.register(run, "m"), runs))
    assert sorted(map(int, made)) == list(range(1, 21))
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda v: registry.promote("m", v), ("3", "7")))
    stages = [r["stage"] for r in registry.versions().collect()]
    assert (len(stages), stages.count("Production"), stages.count("Archived")) == (20, 1, 1)


def test_publishing_that_dies_leaves_the_old_model(spark, monkeypatch):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    from evenkeel.sources import artifacts

    made = {}
    for k in (1, 2):
        made[k] = scratch_path(spark, "candidate")
        stage = SQLTransformer(statement=f"SELECT *, {k} AS v FROM __THIS__")
        artifacts.save_model(spark, PipelineModel([stage]), {"k": k}, None, made[k])
    target = scratch_path(spark, "live")
    artifacts.publish_model(spark, made[1], target, "m", "1", "a")
    with monkeypatch.context() as patch:
        patch.setattr(artifacts, "_write_json", lambda *_: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError):
            artifacts.publish_model(spark, made[2], target, "m", "2", "b")
    pipeline, metadata = load_model(spark, target)
    assert metadata["registry_version"] == "1" and pipeline.transform(spark.range(1)).first()["v"] == 1
    artifacts.publish_model(spark, made[2], target, "m", "2", "b")
    assert load_model(spark, target)[1]["registry_version"] == "2"
    with pytest.raises(FileNotFoundError):
        artifacts.publish_model(spark, scratch_path(spark, "nothing"), target, "m", "3", "c")
    assert load_model(spark, target)[1]["registry_version"] == "2"


def test_candidates_without_a_model_are_kept(spark):
    versions = spark.createDataFrame([("m", "4", "None", "a"), (None, "2", "None", "b")], VERSIONS)
    runs = spark.createDataFrame([(None, "y", 2), (None, "x", 1), ("m", "z", 3)], "model string, run_id string, created bigint")
    out = {r["run_id"]: (r["model"], r["version"]) for r in register_versions(versions, runs, "created").collect()}
    assert out == {"x": (None, "3"), "y": (None, "4"), "z": ("m", "5")}


def test_versions_continue(spark):
    versions = spark.createDataFrame([("m", "9", "None", "a"), ("m", "10", "None", "b")], VERSIONS)
    runs = spark.createDataFrame([("m", "y", 2), ("m", "x", 1), ("n", "z", 3)], "model string, run_id string, created bigint")
    out = {r["run_id"]: r["version"] for r in register_versions(versions, runs, "created").collect()}
    assert out == {"x": "11", "y": "12", "z": "1"}


def test_promotion_archives_the_previous_holder(registry):
    for i, r2 in enumerate((0.5, 0.6, 0.61)):
        registry.add_run(f"r{i}", "m", r2, "")
    assert registry.promote_run("m", "r0")["version"] == "1"
    assert registry.promote_run("m", "r1")["version"] == "2"
    held = registry.promote_run("m", "r2")
    assert (held["promoted"], held["version"], held["production_metric"]) == (False, None, 0.6)
    stages = {r["version"]: r["stage"] for r in registry.versions().collect()}
    assert stages == {"1": "Archived", "2": "Production"}
    registry.promote("m", "1", "Staging")
    stages = {r["version"]: r["stage"] for r in registry.versions().collect()}
    assert stages == {"1": "Staging", "2": "Production"}


def test_promoting_an_absent_version_leaves_the_champion(registry):
    registry.add_run("r0", "m", 0.5, "")
    registry.promote_run("m", "r0")
    with pytest.raises(ValueError, match="no version 99"):
        registry.promote("m", "99")
    assert {r["version"]: r["stage"] for r in registry.versions().collect()} == {"1": "Production"}
    assert registry.champion("m") == 0.5


def test_a_run_recorded_again_is_one_run(registry):
    registry.add_run("r0", "m", 0.5, "")
    registry.add_run("r0", "m", 0.5, "")
    registry.add_run("a/b c", "m", 0.7, "")
    assert sorted((r["run_id"], r["created"]) for r in registry.runs().collect()) == [("a/b c", 2), ("r0", 1)]


@pytest.mark.parametrize("targets", [[("m", "1", "Production"), ("m", "2", "Production")], [("m", "1", "Staging"), ("m", "1", "Archived")]])
def test_contradicting_targets_fail(spark, targets):
    versions = spark.createDataFrame([("m", "1", "None", "a"), ("m", "2", "None", "b")], VERSIONS)
    side = spark.createDataFrame(targets, "model string, version string, stage string")
    with pytest.raises(Exception, match="contradicting targets"):
        promote_transition(versions, side).collect()


def test_contradicting_runs_fail(spark):
    versions = spark.createDataFrame([("m", "1", "Production", "a")], VERSIONS)
    runs = spark.createDataFrame([("a", 0.5), ("a", 0.6)], "run_id string, test_r2 double")
    with pytest.raises(Exception, match="several values"):
        champion_metric(versions, runs).collect()


def test_newest_version_plan_has_no_sort_aggregate(spark):
    plan = latest_version(spark.createDataFrame([("m", "1", "None", "a")], VERSIONS))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_run_without_metric(registry):
    registry.add_run("first", "m", None, "")
    registry.add_run("second", "m", None, "")
    assert registry.promote_run("m", "first")["promoted"]
    with pytest.raises(ValueError, match="no test_r2"):
        registry.promote_run("m", "second")
    with pytest.raises(ValueError, match="not recorded"):
        registry.register("ghost", "m")


def test_lifecycle_from_first_run_to_publishing(spark, extract, registry):
    cfg = TrainConfig(model_type="ridge", handle_outliers=False, split_key=("property_id",))
    snapshot, target = scratch_path(spark, "reference"), scratch_path(spark, "production")
    run = lambda df: run_lifecycle(df, cfg, registry, snapshot, target, "snapshot_date").first()
    assert run(extract)["drift_level"] == "no_reference"
    assert run(extract)["retrained"] is False
    moved = extract.withColumn("price", extract["price"] * 2)
    done = run(moved)
    assert (done["retrained"], done["promoted"], done["published"], done["version"]) == (True, True, True, "1")
    metadata = load_model(spark, target)[1]
    assert (metadata["registry_version"], metadata["promotion_stage"]) == ("1", "Production")
    assert metadata["registry_model_name"] == cfg.model_name and metadata["promotion_timestamp"].endswith("Z")
    again = run(extract)
    assert (again["retrained"], again["promoted"], again["published"]) == (True, False, False)
    broken = run(moved.drop("price").withColumnRenamed("city", "price"))
    assert broken["retrained"] is False and broken["reason"].startswith("Drift check failed")
