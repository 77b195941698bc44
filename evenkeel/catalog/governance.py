"""Runs, versions, champions, gates and stage changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalog.registry import derived, derived_sql, query, rounded
from evenkeel.operators.registry import (
    absent_targets,
    champion_metric,
    latest_version,
    list_versions,
    promote_infer_metric,
    promote_transition,
    promotion_gate,
    register_versions,
)

# Every customer is a model, every order one of its versions.
VERSIONS = (
    "CAST(o_custkey AS STRING) AS model",
    "CAST(o_orderkey AS STRING) AS version",
    "CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'Archived' END AS stage",
    "concat('run-', CAST(o_orderkey AS STRING)) AS run_id",
)
# Some runs have no metric, some NaN, and some are recorded twice.
RUNS = (
    "concat('run-', CAST(o_orderkey AS STRING)) AS run_id",
    "CAST(o_custkey AS STRING) AS model",
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderkey % 13 = 5 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice / 500000 END AS test_r2",
)
CANDIDATES = (
    "CAST(c_custkey AS STRING) AS model",
    "concat('cand-', CAST(c_custkey AS STRING)) AS run_id",
    "CASE WHEN c_custkey % 10 = 3 THEN CAST('NaN' AS DOUBLE) ELSE (c_acctbal + 1000) / 11000 END AS test_r2",
)


def shown(metric: str) -> str:
    """A metric as a query shows it: -1 stands for NaN, which engines compare in different ways."""
    return f"CASE WHEN isnan({metric}) THEN CAST(-1 AS DOUBLE) ELSE {metric} END"


def gate_sql(candidate: str, champion: str) -> str:
    return f"""(coalesce(NOT isnan({candidate}), true) AND ({champion} IS NULL OR
        coalesce(NOT isnan({candidate}) AND NOT isnan({champion}) AND {candidate} - {champion} > 0.02, false)))"""


# Some runs name no model.
NEW_RUNS = (
    "CASE WHEN event_id % 11 = 4 THEN NULL ELSE CAST(user_id AS STRING) END AS model",
    "concat('ev-', CAST(event_id AS STRING)) AS run_id",
    "event_id AS created",
)
VERSIONS_SQL, RUNS_SQL = derived_sql("orders", VERSIONS), derived_sql("orders", RUNS)
CANDIDATES_SQL, NEW_RUNS_SQL = derived_sql("customer", CANDIDATES), derived_sql("events", NEW_RUNS)


def newest_sql(where: str = "true") -> str:
    return f"""(SELECT model, version, stage, run_id FROM (SELECT *, row_number() OVER (PARTITION BY model
        ORDER BY CAST(version AS BIGINT) DESC) AS k FROM {VERSIONS_SQL} WHERE {where}) WHERE k = 1)"""


CHAMPION_SQL = f"""(SELECT v.model, v.version, v.run_id, r.test_r2 AS production_metric
    FROM {newest_sql("stage = 'Production'")} v LEFT JOIN {RUNS_SQL} r USING (run_id))"""


def versions(spark, sf):
    return derived(spark, sf, "orders", VERSIONS)


def runs(spark, sf):
    recorded = derived(spark, sf, "orders", RUNS)
    return recorded.unionAll(recorded.where("run_id LIKE '%7'"))


@query("latest_version", f"SELECT * FROM {newest_sql()}")
def _(spark, sf):
    return latest_version(versions(spark, sf))


@query("list_versions", f"SELECT * FROM {VERSIONS_SQL} ORDER BY model, CAST(version AS BIGINT)")
def _(spark, sf):
    return list_versions(versions(spark, sf))


@query("champion_metric", f"SELECT model, version, run_id, {shown('production_metric')} AS production_metric FROM {CHAMPION_SQL}")
def _(spark, sf):
    champions = champion_metric(versions(spark, sf), runs(spark, sf))
    return champions.withColumn("production_metric", F.expr(shown("production_metric")))


@query(
    "promotion_gate",
    f"""SELECT c.model, c.run_id, round({shown("c.test_r2")}, 9) AS test_r2, {shown("h.production_metric")} AS production_metric,
        {gate_sql("c.test_r2", "h.production_metric")} AS passed
        FROM {CANDIDATES_SQL} c LEFT JOIN {CHAMPION_SQL} h USING (model)""",
)
def _(spark, sf):
    champions = champion_metric(versions(spark, sf), runs(spark, sf))
    gate = promotion_gate(derived(spark, sf, "customer", CANDIDATES), champions.unionAll(champions))
    metrics = {"test_r2": rounded(F.expr(shown("test_r2")), 9), "production_metric": F.expr(shown("production_metric"))}
    return gate.withColumns(metrics)


@query(
    "register_version",
    f"""SELECT n.model, CAST(coalesce(h.v, 0) + row_number() OVER (PARTITION BY n.model ORDER BY created) AS VARCHAR) AS version,
        'None' AS stage, n.run_id FROM {NEW_RUNS_SQL} n LEFT JOIN
        (SELECT model, max(CAST(version AS BIGINT)) AS v FROM {VERSIONS_SQL} GROUP BY model) h USING (model)""",
)
def _(spark, sf):
    return register_versions(versions(spark, sf), derived(spark, sf, "events", NEW_RUNS), "created")


# Each model's newest version is to move; every third model names a version that isn't there, every fifth twice.
MOVE = "CASE WHEN stage = 'Archived' THEN 'Staging' ELSE 'Production' END"
MOVED_VERSION = "CASE WHEN CAST(model AS BIGINT) % 3 = 0 THEN '-1' ELSE version END"


@query(
    "promote_transition",
    f"""WITH t AS (SELECT model, version AS tv, {MOVE} AS ts FROM {newest_sql()} WHERE CAST(model AS BIGINT) % 3 <> 0)
        SELECT v.model, v.version, CASE WHEN v.version = tv THEN ts WHEN ts = 'Production' AND v.stage = 'Production' THEN 'Archived'
          ELSE v.stage END AS stage, v.run_id FROM {VERSIONS_SQL} v LEFT JOIN t USING (model)""",
)
def _(spark, sf):
    targets = latest_version(versions(spark, sf)).selectExpr("model", f"{MOVED_VERSION} AS version", f"{MOVE} AS stage")
    repeated = targets.unionAll(targets.where("CAST(model AS BIGINT) % 5 = 0"))
    return promote_transition(versions(spark, sf), repeated)


@query(
    "absent_targets",
    f"SELECT model, '-1' AS version, {MOVE} AS stage FROM {newest_sql()} WHERE CAST(model AS BIGINT) % 3 = 0",
)
def _(spark, sf):
    targets = latest_version(versions(spark, sf)).selectExpr("model", f"{MOVED_VERSION} AS version", f"{MOVE} AS stage")
    return absent_targets(versions(spark, sf), targets)


@query(
    "promote_infer_metric",
    f"""SELECT c.model, c.run_id, {shown("r.test_r2")} AS candidate_metric, {shown("h.production_metric")} AS production_metric,
        CASE WHEN r.test_r2 IS NULL AND h.version IS NOT NULL THEN 'error' WHEN r.test_r2 IS NULL THEN 'promoted'
          WHEN {gate_sql("r.test_r2", "h.production_metric")} THEN 'promoted' ELSE 'rejected' END AS outcome
        FROM (SELECT model, run_id FROM {VERSIONS_SQL}) c LEFT JOIN (SELECT run_id, test_r2 FROM {RUNS_SQL}) r USING (run_id)
        LEFT JOIN {CHAMPION_SQL} h ON h.model = c.model""",
)
def _(spark, sf):
    candidates = versions(spark, sf).select("model", "run_id")
    judged = promote_infer_metric(candidates, versions(spark, sf), runs(spark, sf))
    return judged.withColumns({c: F.expr(shown(c)) for c in ("candidate_metric", "production_metric")})
