"""Features, models, evaluation, intervals and scoring."""

from __future__ import annotations

from functools import cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from evenkeel.catalog.registry import PREDICTED, derived, derived_sql, query, rounded, table
from evenkeel.catalog.tables import rules_sql
from evenkeel.contract import Contract
from evenkeel.operators.estimators import feature_importance, fit_pipeline
from evenkeel.operators.evaluate import (
    IntervalSpec,
    calibrate_intervals,
    interval_coverage,
    regression_metrics,
    rel_error_quantile,
    segment_mae,
    split_sizes,
)
from evenkeel.operators.features import (
    categories,
    fit_features,
    impute_median,
    category_positions,
    category_table,
    impute_mode,
    nonzero_counts,
    one_hot_columns,
    standardize,
    transform_features,
)
from evenkeel.operators.intervals import flat_interval, forest_interval, interval_report, segment_width, segmented_interval
from evenkeel.operators.ranking import hash_number, split_exact, split_in_three
from evenkeel.operators.validate import Rule
from evenkeel.plans.lifecycle import Registry, run_lifecycle
from evenkeel.plans.scoring import Scorer, contract_report, score_file, score_records
from evenkeel.plans.training import TrainConfig, TrainResult, prepare_training, train_run
from evenkeel.session import scratch_path
from evenkeel.sources.artifacts import load_model
from evenkeel.sources.tables import read_csv, write_csv
from evenkeel.streaming.scoring import quarantined_rows, scored_rows, start_scoring

# ---- evaluation and intervals over a stand-in prediction -------------------------------

PREDICTED_SQL = derived_sql("orders", PREDICTED)
METRIC_SQL = """round(1 - avg((actual - prediction) * (actual - prediction)) / var_pop(actual), 6) AS r2,
    round(sqrt(avg((actual - prediction) * (actual - prediction))), 4) AS rmse, round(avg(abs(actual - prediction)), 4) AS mae,
    round(avg((actual - prediction) * (actual - prediction)), 0) AS mse"""


def tidy_metrics(df: DataFrame) -> DataFrame:
    return df.select(
        rounded("r2").alias("r2"), rounded("rmse", 4).alias("rmse"), rounded("mae", 4).alias("mae"), rounded("mse", 0).alias("mse")
    )


# Predictions of which some are missing, as NULL or as NaN.
GAPPY_PREDICTED = (
    *PREDICTED[:-1],
    "CASE WHEN o_orderkey % 11 = 1 THEN NULL WHEN o_orderkey % 13 = 2 THEN CAST('NaN' AS DOUBLE) ELSE "
    + PREDICTED[-1].removesuffix(" AS prediction")
    + " END AS prediction",
)


@query(
    "regression_metrics",
    f"SELECT {METRIC_SQL} FROM {derived_sql('orders', GAPPY_PREDICTED)} WHERE prediction IS NOT NULL AND NOT isnan(prediction)",
)
def _(spark, sf):
    return tidy_metrics(regression_metrics(derived(spark, sf, "orders", GAPPY_PREDICTED), "actual", "prediction"))


@query(
    "segment_mae",
    f"""WITH p AS {PREDICTED_SQL}, q AS (SELECT quantile_cont(actual, 0.25) AS cut FROM p)
        SELECT round(avg(abs(actual - prediction)), 4) AS cheap_segment_mae, round(max(cut), 4) AS cheap_segment_cutoff_p25
        FROM p, q WHERE actual <= cut""",
)
def _(spark, sf):
    out = segment_mae(derived(spark, sf, "orders", PREDICTED), "actual", "prediction")
    return out.select(*[rounded(c, 4).alias(c) for c in out.columns])


def calibration_sql(source: str, normalizer: str = "actual") -> str:
    """CTEs: level/error rows, edges e1..e4, segment of each row, width per segment."""
    error = "abs(actual - level) / greatest(abs(actual), 1.0)"
    if normalizer == "prediction":
        error = "CASE WHEN level > 0 THEN abs(actual - level) / level ELSE abs(actual) END"
    return f"""lv AS (SELECT *, greatest(prediction, 0.0) AS level FROM {source}),
      er AS (SELECT *, {error} AS error FROM lv),
      ed AS (SELECT quantile_cont(level, 0.2) AS e1, quantile_cont(level, 0.4) AS e2,
                    quantile_cont(level, 0.6) AS e3, quantile_cont(level, 0.8) AS e4 FROM lv),
      sg AS (SELECT er.*, CAST(level >= e1 AS INT) + CAST(level >= e2 AS INT) + CAST(level >= e3 AS INT)
                          + CAST(level >= e4 AS INT) AS segment FROM er, ed),
      rk AS (SELECT segment, error, row_number() OVER (PARTITION BY segment ORDER BY error) - 1 AS k,
                    count(*) OVER (PARTITION BY segment) AS n,
                    row_number() OVER (ORDER BY error) - 1 AS gk, count(*) OVER () AS gn FROM sg),
      gl AS (SELECT error AS width, gn AS size FROM rk WHERE gk = ceil(CAST(0.95 AS DOUBLE) * (gn - 1))),
      sw AS (SELECT s.segment, CASE WHEN coalesce(r.n, 0) >= 10 THEN r.error ELSE (SELECT width FROM gl) END AS width
             FROM (SELECT unnest(range(5)) AS segment) s
             LEFT JOIN (SELECT * FROM rk WHERE k = ceil(CAST(0.95 AS DOUBLE) * (n - 1))) r ON r.segment = s.segment)"""


CALIBRATED = f"WITH {calibration_sql(PREDICTED_SQL)}"


@query("rel_error_quantile", CALIBRATED + " SELECT size AS rows, round(width, 9) AS width FROM gl")
def _(spark, sf):
    size, width = rel_error_quantile(derived(spark, sf, "orders", PREDICTED), "actual", "prediction")
    return spark.createDataFrame([(size, round(width, 9))], "rows bigint, width double")


@query(
    "interval_calibration",
    CALIBRATED
    + """ SELECT 'width' AS field, segment AS position, round(width, 6) AS value FROM sw
          UNION ALL SELECT 'edge', 0, round(e1, 6) FROM ed UNION ALL SELECT 'edge', 1, round(e2, 6) FROM ed
          UNION ALL SELECT 'edge', 2, round(e3, 6) FROM ed UNION ALL SELECT 'edge', 3, round(e4, 6) FROM ed
          UNION ALL SELECT 'global', 0, round(width, 6) FROM gl
          UNION ALL SELECT 'size', 0, CAST(size AS DOUBLE) FROM gl""",
)
def _(spark, sf):
    spec = calibrate_intervals(derived(spark, sf, "orders", PREDICTED), "actual", "prediction")
    rows = [
        *[("width", i, v) for i, v in enumerate(spec.relative_error_quantiles_by_segment)],
        *[("edge", i, v) for i, v in enumerate(spec.segment_edges)],
        ("global", 0, spec.relative_error_quantiles["global"]),
        ("size", 0, float(spec.calibration_size)),
    ]
    df = spark.createDataFrame(rows, "field string, position bigint, value double")
    return df.withColumn("value", rounded("value"))


BOUNDED = """ , bd AS (SELECT sg.*, sw.width, greatest(0.0, level * (1 - width)) AS lower_bound,
    level * (1 + width) AS upper_bound FROM sg JOIN sw USING (segment))"""


def bounded(spark, sf, normalizer: str = "actual") -> DataFrame:
    df = derived(spark, sf, "orders", PREDICTED)
    return segmented_interval(df, calibrate_intervals(df, "actual", "prediction", normalizer=normalizer))


@query(
    "segment_lookup",
    CALIBRATED + BOUNDED + " SELECT o_orderkey, round(width, 9) AS width FROM bd",
)
def _(spark, sf):
    df = derived(spark, sf, "orders", PREDICTED)
    spec = calibrate_intervals(df, "actual", "prediction")
    level = df.withColumn("level", F.greatest("prediction", F.lit(0.0)))
    return level.select("o_orderkey", rounded(segment_width(F.col("level"), spec), 9).alias("width"))


@query(
    "interval_apply",
    CALIBRATED
    + BOUNDED
    + " SELECT o_orderkey, round(prediction, 6) AS prediction, round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM bd",
)
def _(spark, sf):
    names = ("prediction", "lower_bound", "upper_bound")
    return bounded(spark, sf).select("o_orderkey", *[rounded(c).alias(c) for c in names])


COVERAGE = " SELECT round(avg(CAST(actual BETWEEN lower_bound AND upper_bound AS DOUBLE)), 6) AS coverage, count(*) AS rows FROM bd"


@query("interval_coverage", CALIBRATED + BOUNDED + COVERAGE)
def _(spark, sf):
    return interval_coverage(bounded(spark, sf), "actual").withColumn("coverage", rounded("coverage"))


@query(
    "interval_coverage_by_prediction",
    f"WITH {calibration_sql(PREDICTED_SQL, 'prediction')}" + BOUNDED + COVERAGE,
)
def _(spark, sf):
    return interval_coverage(bounded(spark, sf, "prediction"), "actual").withColumn("coverage", rounded("coverage"))


@query(
    "interval_legacy",
    f"""WITH p AS (SELECT *, greatest(prediction, 0.0) AS level FROM {PREDICTED_SQL}),
        w AS (SELECT *, CASE WHEN level < 100000 THEN 0.5 WHEN level < 250000 THEN 0.3 ELSE 0.2 END::DOUBLE AS width FROM p)
        SELECT o_orderkey, round(greatest(0.0, level * (1 - width)), 6) AS lower_bound,
               round(level * (1 + width), 6) AS upper_bound FROM w""",
)
def _(spark, sf):
    spec = IntervalSpec(
        segment_edges=[100000.0, 250000.0], relative_error_quantiles={"global": 0.3, "low": 0.5, "high": 0.2}
    )
    out = segmented_interval(derived(spark, sf, "orders", PREDICTED), spec)
    return out.select("o_orderkey", *[rounded(c).alias(c) for c in ("lower_bound", "upper_bound")])


@query(
    "interval_flat",
    f"SELECT o_orderkey, prediction, prediction AS lower_bound, prediction AS upper_bound FROM {PREDICTED_SQL}",
)
def _(spark, sf):
    return flat_interval(derived(spark, sf, "orders", PREDICTED)).drop("actual")


@query(
    "interval_report",
    CALIBRATED
    + BOUNDED
    + """ , m AS (SELECT *, (upper_bound - lower_bound) / 2 AS margin FROM bd)
        SELECT o_orderkey, round(margin, 6) AS margin,
          CASE WHEN prediction < 0 AND prediction >= -0.5 THEN '$-0'
               ELSE '$' || format('{:,d}', CAST(round_even(prediction, 0) AS BIGINT)) END AS prediction_text,
          '$' || format('{:,d}', CAST(round_even(upper_bound, 0) AS BIGINT)) AS upper_text,
          round(margin / prediction * 100, 6) + 0.0 AS share FROM m""",
)
def _(spark, sf):
    out = interval_report(bounded(spark, sf))
    return out.select(
        "o_orderkey",
        rounded("margin").alias("margin"),
        "prediction_text",
        "upper_text",
        rounded(F.col("margin") / F.col("prediction") * 100).alias("share"),
    )


# ---- splits and features ----------------------------------------------------------------

SPLIT_SQL = """SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS is_test
    FROM orders"""


@query("split_exact", SPLIT_SQL)
def _(spark, sf):
    return split_exact(table(spark, sf, "orders").select("o_orderkey"), 0.2, 42, ["o_orderkey"])


THREE_SQL = """SELECT *, CASE WHEN k <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test'
      WHEN k <= ceil(CAST(0.2 AS DOUBLE) * n) + ceil(CAST(0.15 AS DOUBLE) * n) THEN 'calibration' ELSE 'train' END AS part
    FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) AS k, count(*) OVER () AS n FROM {source})"""


def in_three(df):
    return split_in_three(df.withColumn("__n", hash_number(42, ["o_orderkey"])), "__n", 0.2, 0.15).drop("__n")


@query("split_three", f"SELECT o_orderkey, part FROM ({THREE_SQL.format(source='orders')})")
def _(spark, sf):
    return in_three(table(spark, sf, "orders").select("o_orderkey"))


@query(
    "coverage_unseen",
    f"""WITH three AS ({THREE_SQL.format(source=PREDICTED_SQL)}), {calibration_sql("(SELECT * FROM three WHERE part = 'calibration')")},
        t AS (SELECT *, greatest(prediction, 0.0) AS lvl FROM three WHERE part = 'test'),
        b AS (SELECT t.*, CAST(lvl >= e1 AS INT) + CAST(lvl >= e2 AS INT) + CAST(lvl >= e3 AS INT) + CAST(lvl >= e4 AS INT) AS segment FROM t, ed)
        SELECT round(avg(CAST(actual BETWEEN greatest(0.0, lvl * (1 - width)) AND lvl * (1 + width) AS DOUBLE)), 9) AS coverage,
          count(*) AS rows, (SELECT count(*) FROM three WHERE part = 'calibration') AS calibration_rows FROM b JOIN sw USING (segment)""",
)
def _(spark, sf):
    three = in_three(derived(spark, sf, "orders", PREDICTED))
    spec = calibrate_intervals(three.where("part = 'calibration'"), "actual", "prediction")
    covered = interval_coverage(segmented_interval(three.where("part = 'test'"), spec), "actual")
    return covered.withColumn("coverage", rounded("coverage", 9)).withColumn("calibration_rows", F.lit(spec.calibration_size).cast("bigint"))


@query(
    "split_coarse_key",
    """WITH f AS (SELECT l_returnflag, count(*) AS n, md5('42:' || l_returnflag) AS h FROM lineitem GROUP BY l_returnflag),
      c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        ceil(CAST(0.2 AS DOUBLE) * sum(n) OVER ()) AS wanted FROM f)
      SELECT l_returnflag, CAST(least(greatest(wanted - before, 0), n) AS BIGINT) AS test_rows, n AS rows FROM c""",
)
def _(spark, sf):
    split = split_exact(table(spark, sf, "lineitem"), 0.2, 42, ["l_returnflag"])
    return split.groupBy("l_returnflag").agg(F.count_if("is_test").alias("test_rows"), F.count("*").alias("rows"))


@query(
    "category_index",
    """SELECT o_orderkey, dense_rank() OVER (ORDER BY k) - 1 AS k_position
        FROM (SELECT o_orderkey, 'order ' || CAST(o_orderkey AS VARCHAR) AS k FROM orders)""",
)
def _(spark, sf):
    df = derived(spark, sf, "orders", ("o_orderkey", "concat('order ', CAST(o_orderkey AS STRING)) AS k"))
    return category_positions(df, "k", category_table(df, "k")).select("o_orderkey", "k_position")


@query(
    "impute_mode_keys",
    """WITH g AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'c' || CAST(o_custkey AS VARCHAR) END AS k FROM orders),
        m AS (SELECT k FROM g WHERE k IS NOT NULL GROUP BY k ORDER BY count(*) DESC, k LIMIT 1)
        SELECT o_orderkey, coalesce(k, (SELECT k FROM m)) AS k FROM g""",
)
def _(spark, sf):
    keyed = ("o_orderkey", "CASE WHEN o_orderstatus <> 'P' THEN concat('c', CAST(o_custkey AS STRING)) END AS k")
    return impute_mode(derived(spark, sf, "orders", keyed), ["k"])


@query(
    "split_sizes",
    f"""SELECT count(*) FILTER (NOT is_test) AS train_size, CAST(0 AS BIGINT) AS val_size,
        count(*) FILTER (is_test) AS test_size FROM ({SPLIT_SQL})""",
)
def _(spark, sf):
    return split_sizes(split_exact(table(spark, sf, "orders").select("o_orderkey"), 0.2, 42, ["o_orderkey"]))


# Line items with gaps in a number and in a category.
GAPPY = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS price",
    "CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END AS quantity",
    "CASE WHEN l_quantity < 5 THEN NULL ELSE l_returnflag END AS flag",
)
GAPPY_SQL = derived_sql("lineitem", GAPPY)
LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
LINE_KEY_SQL = ", ".join(LINE_KEY)


@query(
    "impute_median",
    f"""WITH g AS {GAPPY_SQL}, m AS (SELECT quantile_cont(price, 0.5) AS mp, quantile_cont(quantity, 0.5) AS mq FROM g)
        SELECT {LINE_KEY_SQL}, round(coalesce(price, mp), 6) AS price, coalesce(quantity, mq) AS quantity, flag FROM g, m""",
)
def _(spark, sf):
    return impute_median(derived(spark, sf, "lineitem", GAPPY), ["price", "quantity"]).withColumn("price", rounded("price"))


MODE_SQL = "(SELECT flag FROM g WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)"


@query("impute_mode", f"WITH g AS {GAPPY_SQL} SELECT {LINE_KEY_SQL}, coalesce(flag, {MODE_SQL}) AS flag FROM g")
def _(spark, sf):
    return impute_mode(derived(spark, sf, "lineitem", GAPPY), ["flag"]).select(*LINE_KEY, "flag")


@query(
    "standardize",
    f"""WITH g AS {GAPPY_SQL}, s AS (SELECT avg(price) AS m, stddev_pop(price) AS d FROM g)
        SELECT {LINE_KEY_SQL}, round((price - m) / d, 6) AS price, CAST(0 AS DOUBLE) AS constant FROM g, s""",
)
def _(spark, sf):
    df = derived(spark, sf, "lineitem", GAPPY).withColumn("constant", F.lit(7.0))
    return standardize(df, ["price", "constant"]).select(*LINE_KEY, rounded("price").alias("price"), "constant")


@query(
    "one_hot",
    f"""SELECT {LINE_KEY_SQL}, CAST(coalesce(flag = 'A', false) AS DOUBLE) AS "flag_A",
        CAST(coalesce(flag = 'N', false) AS DOUBLE) AS "flag_N", CAST(coalesce(flag = 'R', false) AS DOUBLE) AS "flag_R" FROM {GAPPY_SQL}""",
)
def _(spark, sf):
    df = derived(spark, sf, "lineitem", GAPPY)
    hot = one_hot_columns(df, "flag", categories(df, ["flag"])["flag"].values)
    return hot.select(*LINE_KEY, "flag_A", "flag_N", "flag_R")


GAPPY_CONTRACT = Contract(numeric=("price", "quantity"), categorical=("flag",), target="l_linenumber")


@query(
    "feature_fit_transform",
    f"""WITH g AS {GAPPY_SQL}, m AS (SELECT quantile_cont(price, 0.5) AS mp, quantile_cont(quantity, 0.5) AS mq FROM g),
        i AS (SELECT {LINE_KEY_SQL}, coalesce(price, mp) AS p, coalesce(quantity, mq) AS q, coalesce(flag, {MODE_SQL}) AS f FROM g, m),
        s AS (SELECT avg(p) AS pm, stddev_pop(p) AS ps, avg(q) AS qm, stddev_pop(q) AS qs FROM i)
        SELECT {LINE_KEY_SQL}, round((p - pm) / ps, 6) AS f0, round((q - qm) / qs, 6) AS f1,
          CAST(f = 'A' AS DOUBLE) AS f2, CAST(f = 'N' AS DOUBLE) AS f3, CAST(f = 'R' AS DOUBLE) AS f4 FROM i, s""",
)
def _(spark, sf):
    df = derived(spark, sf, "lineitem", GAPPY)
    out = transform_features(df, fit_features(df, GAPPY_CONTRACT)).withColumn("v", vector_to_array("features"))
    return out.select(*LINE_KEY, *[rounded(F.col("v")[i]).alias(f"f{i}") for i in range(5)])


@query(
    "feature_hot_keys",
    f"""WITH k AS (SELECT 'order ' || CAST(l_orderkey AS VARCHAR) AS k FROM {GAPPY_SQL} WHERE quantity IS NOT NULL),
        c AS (SELECT k, row_number() OVER (ORDER BY k) AS position FROM (SELECT DISTINCT k FROM k))
        SELECT position, 'k_' || k AS name, count(*) AS rows FROM k JOIN c USING (k) GROUP BY position, k""",
)
def _(spark, sf):
    # A category per order: its labels stay in a table, and rows meet them by a join.
    rows = derived(spark, sf, "lineitem", GAPPY).where("quantity IS NOT NULL")
    df = rows.withColumn("k", F.concat(F.lit("order "), F.col("l_orderkey").cast("string")))
    state = fit_features(df, Contract(numeric=("quantity",), categorical=("k",), target="l_linenumber"))
    counts = nonzero_counts(state.transform(df))
    named = state.feature_table().where("position > 0").join(counts, "position", "left")
    return named.select("position", "name", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))


@query(
    "feature_names",
    """SELECT CAST(row_number() OVER (ORDER BY kind, v) - 1 AS INTEGER) AS position, name FROM (
        SELECT 0 AS kind, '' AS v, 'p_size' AS name UNION ALL
        SELECT DISTINCT 1, p_type, 'p_type_' || p_type FROM part UNION ALL
        SELECT DISTINCT 2, p_brand, 'p_brand_' || p_brand FROM part)""",
)
def _(spark, sf):
    contract = Contract(numeric=("p_size",), categorical=("p_type", "p_brand"), target="p_retailprice")
    names = fit_features(table(spark, sf, "part"), contract).feature_names()
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


# ---- training and scoring ----------------------------------------------------------------

# A label the features explain in part, a feature with gaps, and every training filter in use.
LINES = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity AS quantity",
    "CASE WHEN l_tax = 0 THEN NULL ELSE l_discount END AS discount",
    "l_returnflag AS flag",
    "l_linestatus AS status",
    "CASE WHEN l_linestatus = 'F' AND l_tax = 0 THEN NULL ELSE 1000 * l_quantity * (1 - l_discount) + 50 * l_linenumber END AS label",
    "l_shipdate AS shipped",
)
LINES_SQL = derived_sql("lineitem", LINES)

LINEAR = Contract(
    numeric=("quantity", "discount"), categorical=(), target="label", defaults={"discount": 0.04}, aliases={"amount": "quantity"}
)


def config(contract: Contract = LINEAR, **changes) -> TrainConfig:
    settings = {
        "contract": contract,
        "area": "quantity",
        "min_target": 1000.0,
        "max_target": 45000.0,
        "min_area": 2.0,
        "exclude": {"flag": ("R",)},
        "split_key": LINE_KEY,
        "model_type": "ridge",
        "hyperparameters": {"alpha": 10.0},
        "model_name": "line_value",
    }
    return TrainConfig(**(settings | changes))


KEPT_SQL = f"""(SELECT DISTINCT * FROM {LINES_SQL} WHERE label IS NOT NULL AND flag <> 'R'
    AND label >= 1000 AND label <= 45000 AND quantity >= 2)"""


def ridge_sql(log_target: bool = True, alpha: float = 10.0, source: str = KEPT_SQL) -> str:
    """CTEs of a two-feature ridge fit in closed form: split, medians, moments, weights ``w``, test rows ``te``."""
    label = "ln(1 + label)" if log_target else "label"
    inverse = "exp({0}) - 1" if log_target else "{0}"
    predicted = inverse.format("b0 + b1 * (quantity - qm) / qs + b2 * (coalesce(discount, md) - dm) / ds")
    return f"""kept AS {source},
      sp AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || l_orderkey || ':' || l_partkey || ':' || l_suppkey || ':' || l_linenumber))
                    <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS is_test FROM kept),
      tr AS (SELECT *, {label} AS y FROM sp WHERE NOT is_test),
      md AS (SELECT quantile_cont(discount, 0.5) AS md FROM tr),
      mo AS (SELECT md, avg(quantity) AS qm, stddev_pop(quantity) AS qs, avg(coalesce(discount, md)) AS dm,
                    stddev_pop(coalesce(discount, md)) AS ds, avg(y) AS ym FROM tr, md GROUP BY md),
      z AS (SELECT (quantity - qm) / qs AS z1, (coalesce(discount, md) - dm) / ds AS z2, y - ym AS yc FROM tr, mo),
      sm AS (SELECT sum(z1 * z1) + {alpha} AS a11, sum(z1 * z2) AS a12, sum(z2 * z2) + {alpha} AS a22,
                    sum(z1 * yc) AS c1, sum(z2 * yc) AS c2 FROM z),
      w AS (SELECT mo.*, ym AS b0, (a22 * c1 - a12 * c2) / (a11 * a22 - a12 * a12) AS b1,
                   (a11 * c2 - a12 * c1) / (a11 * a22 - a12 * a12) AS b2 FROM sm, mo),
      te AS (SELECT sp.*, label AS actual, {predicted} AS prediction FROM sp, w WHERE is_test)"""


TEST_SQL = "(SELECT actual, prediction FROM te)"
PREDICTED_LINE = "exp(b0 + b1 * (quantity - qm) / qs + b2 * (coalesce(discount, {gap}) - dm) / ds) - 1"


def lines(spark, sf) -> DataFrame:
    return derived(spark, sf, "lineitem", LINES)


@cache
def trained(spark, sf: str) -> tuple[TrainResult, str]:
    """One trained and saved model per table folder: scoring queries start from a stored model."""
    result = train_run(lines(spark, sf), config())
    return result, result.save(spark, scratch_path(spark, "model"))


@query(
    "fit_ridge",
    f"WITH {ridge_sql(log_target=False)}"
    + """ SELECT 'intercept' AS term, round(b0, 4) AS weight FROM w UNION ALL
          SELECT 'quantity', round(b1, 4) FROM w UNION ALL SELECT 'discount', round(b2, 4) FROM w""",
)
def _(spark, sf):
    result = train_run(lines(spark, sf), config(target_transform="none"))
    model = result.pipeline.stages[-2]
    rows = [("intercept", model.intercept), *zip(("quantity", "discount"), (float(v) for v in model.coefficients))]
    return spark.createDataFrame(rows, "term string, weight double").withColumn("weight", rounded("weight", 4))


def split_lines(spark, sf) -> DataFrame:
    return prepare_training(lines(spark, sf), config())


def stump_sql(name: str, target: str) -> str:
    """CTE ``name``(f, v, below, above): the best one-split tree for ``target`` over the rows of ``tr``.

    Candidate splits are all values of both features; the split with the greatest variance gain is
    that with the greatest sum of squared leaf sums over leaf sizes.
    """
    return f"""{name}_x AS (SELECT 'quantity' AS f, quantity AS v, {target} AS y FROM tr
        UNION ALL SELECT 'discount', coalesce(discount, md), {target} FROM tr, md),
      {name}_g AS (SELECT f, v, count(*) AS n, sum(y) AS s FROM {name}_x GROUP BY f, v),
      {name}_c AS (SELECT f, v, CAST(sum(n) OVER w AS DOUBLE) AS nl, sum(s) OVER w AS sl, CAST(sum(n) OVER (PARTITION BY f) AS DOUBLE) AS n,
        sum(s) OVER (PARTITION BY f) AS s FROM {name}_g WINDOW w AS (PARTITION BY f ORDER BY v)),
      {name} AS (SELECT f, v, sl / nl AS below, (s - sl) / (n - nl) AS above FROM {name}_c WHERE nl < n
        ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)"""


def leaf_sql(name: str, median: str = "(SELECT md FROM md)") -> str:
    """A row's leaf value in the stump ``name``."""
    return f"""(SELECT CASE WHEN (CASE f WHEN 'quantity' THEN quantity ELSE coalesce(discount, {median}) END) <= v
        THEN below ELSE above END FROM {name})"""


def tree_rows_sql() -> str:
    """CTEs ``tr`` (training rows, y the logged label), ``md`` and ``sp`` without the linear fit."""
    return ridge_sql().split("mo AS")[0].rstrip().rstrip(",")


STUMP = {"n_estimators": 1, "max_depth": 1, "max_bins": 64, "bootstrap": False}
ONE_TREE = f"{tree_rows_sql()}, {stump_sql('tree', 'y')}"


@cache
def forest(spark, sf):
    """A forest of one tree with one split, without row sampling: what SQL can follow."""
    return fit_pipeline(split_lines(spark, sf).where("NOT is_test"), LINEAR, "random_forest", STUMP)


@query(
    "fit_rf",
    f"""WITH {ONE_TREE}, te AS (SELECT label AS actual, exp({leaf_sql("tree")}) - 1 AS prediction FROM sp WHERE is_test)
        SELECT {METRIC_SQL} FROM te""",
)
def _(spark, sf):
    pipeline, _ = forest(spark, sf)
    test = split_lines(spark, sf).where("is_test")
    return tidy_metrics(regression_metrics(pipeline.transform(test), "label", "prediction"))


# Squared loss: the second tree fits twice what the first leaves, and counts with the learning rate.
BOOSTED = {"max_iter": 2, "learning_rate": 0.3, "max_depth": 1, "min_samples_leaf": 1, "max_bins": 64}


@query(
    "fit_gbt",
    f"""WITH {ONE_TREE}, {stump_sql("second", f"2 * (y - {leaf_sql('tree')})")},
        te AS (SELECT label AS actual, exp({leaf_sql("tree")} + 0.3 * {leaf_sql("second")}) - 1 AS prediction FROM sp WHERE is_test)
        SELECT {METRIC_SQL} FROM te""",
)
def _(spark, sf):
    split = split_lines(spark, sf)
    pipeline, _ = fit_pipeline(split.where("NOT is_test"), LINEAR, "hist_gradient_boosting", BOOSTED)
    return tidy_metrics(regression_metrics(pipeline.transform(split.where("is_test")), "label", "prediction"))


@query(
    "importance_topn",
    f"""WITH {ONE_TREE} SELECT c.f AS feature, CASE WHEN c.f = tree.f THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
        FROM (VALUES ('quantity'), ('discount')) AS c(f), tree""",
)
def _(spark, sf):
    pipeline, state = forest(spark, sf)
    return feature_importance(pipeline, state.feature_names(), top=5)


@query(
    "interval_forest",
    f"""WITH {ONE_TREE}, te AS (SELECT label, exp({leaf_sql("tree")}) - 1 AS p FROM sp WHERE is_test)
        SELECT round(label, 4) AS label, round(p, 3) AS prediction, round(p, 3) AS lower_bound, round(p, 3) AS upper_bound FROM te""",
)
def _(spark, sf):
    pipeline, _ = forest(spark, sf)
    scored = forest_interval(pipeline, split_lines(spark, sf).where("is_test"))
    return scored.select(rounded("label", 4).alias("label"), *[rounded(c, 3).alias(c) for c in ("prediction", "lower_bound", "upper_bound")])


# Larger fits over numeric and categorical columns, which SQL can't follow.
MIXED = Contract(numeric=LINEAR.numeric, categorical=("status",), target="label", defaults=LINEAR.defaults)
GROWN = {
    "random_forest": {"n_estimators": 20, "max_depth": 6, "max_bins": 64},
    "hist_gradient_boosting": {"max_iter": 10, "learning_rate": 0.3, "max_depth": 3, "max_bins": 64},
}


@cache
def grown(spark, sf, family):
    split = prepare_training(lines(spark, sf), config(MIXED))
    return fit_pipeline(split.where("NOT is_test"), MIXED, family, GROWN[family]), split.where("is_test")


@query("fit_rf_grown")
def _(spark, sf):
    (pipeline, _), test = grown(spark, sf, "random_forest")
    return tidy_metrics(regression_metrics(pipeline.transform(test), "label", "prediction"))


@query("fit_gbt_grown")
def _(spark, sf):
    (pipeline, _), test = grown(spark, sf, "hist_gradient_boosting")
    return tidy_metrics(regression_metrics(pipeline.transform(test), "label", "prediction"))


@query("interval_forest_grown")
def _(spark, sf):
    (pipeline, _), test = grown(spark, sf, "random_forest")
    scored = forest_interval(pipeline, test)
    return scored.select(rounded("label", 4).alias("label"), *[rounded(c, 3).alias(c) for c in ("prediction", "lower_bound", "upper_bound")])


@query(
    "target_transform",
    f"WITH {ridge_sql()} SELECT round(label, 4) AS label, round(prediction, 3) AS prediction FROM te",
)
def _(spark, sf):
    split = prepare_training(lines(spark, sf), config())
    pipeline, _ = fit_pipeline(split.where("NOT is_test"), LINEAR, "ridge", {"alpha": 10.0})
    scored = pipeline.transform(split.where("is_test"))
    return scored.select(rounded("label", 4).alias("label"), rounded("prediction", 3).alias("prediction"))


@query(
    "train_run",
    f"""WITH {ridge_sql()}, cut AS (SELECT quantile_cont(actual, 0.25) AS c FROM te), {calibration_sql(TEST_SQL)}
        SELECT (SELECT count(*) FROM sp WHERE NOT is_test) AS train_size, (SELECT count(*) FROM te) AS test_size,
          {METRIC_SQL}, (SELECT round(avg(abs(actual - prediction)), 4) FROM te, cut WHERE actual <= c) AS cheap_segment_mae,
          (SELECT round(c, 4) FROM cut) AS cheap_segment_cutoff_p25, (SELECT round(width, 6) FROM gl) AS global_width,
          false AS promote_to_production FROM te""",
)
def _(spark, sf):
    result = train_run(lines(spark, sf), config())
    m = result.metrics["test"]
    row = (
        result.metadata["train_size"],
        result.metadata["test_size"],
        *[m[k] for k in ("r2", "rmse", "mae", "mse", "cheap_segment_mae", "cheap_segment_cutoff_p25")],
        result.interval.relative_error_quantiles["global"],
        result.metrics["promote_to_production"],
    )
    df = spark.createDataFrame(
        [row],
        "train_size bigint, test_size bigint, r2 double, rmse double, mae double, mse double, cheap_segment_mae double, "
        "cheap_segment_cutoff_p25 double, global_width double, promote_to_production boolean",
    )
    digits = {"r2": 6, "rmse": 4, "mae": 4, "mse": 0, "cheap_segment_mae": 4, "cheap_segment_cutoff_p25": 4, "global_width": 6}
    return df.withColumns({c: rounded(c, d) for c, d in digits.items()})


def scored_sql(source: str, gap: str = "0.04") -> str:
    """All rows of ``source`` scored and bounded by the model of ``ridge_sql``."""
    return f"""WITH {ridge_sql()}, {calibration_sql(TEST_SQL)},
      all_rows AS (SELECT *, {PREDICTED_LINE.format(gap=gap)} AS prediction FROM {source}, w),
      leveled AS (SELECT *, greatest(prediction, 0.0) AS lvl FROM all_rows),
      placed AS (SELECT leveled.*, CAST(lvl >= e1 AS INT) + CAST(lvl >= e2 AS INT) + CAST(lvl >= e3 AS INT)
                   + CAST(lvl >= e4 AS INT) AS segment FROM leveled, ed)
      SELECT {LINE_KEY_SQL}, round(prediction, 3) AS prediction, round(greatest(0.0, lvl * (1 - width)), 3) AS lower_bound,
        round(lvl * (1 + width), 3) AS upper_bound FROM placed JOIN sw USING (segment)"""


def tidy_scores(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*LINE_KEY, *[rounded(c, 3).alias(c) for c in ("prediction", "lower_bound", "upper_bound")], *more)


@query("batch_score", scored_sql(LINES_SQL))
def _(spark, sf):
    return tidy_scores(Scorer.load(spark, trained(spark, sf)[1]).predict(lines(spark, sf)))


@query("model_roundtrip", scored_sql(LINES_SQL, gap="md"))
def _(spark, sf):
    pipeline, metadata = load_model(spark, trained(spark, sf)[1])
    spec = IntervalSpec(**metadata["prediction_interval"])
    return tidy_scores(segmented_interval(pipeline.transform(lines(spark, sf)), spec))


# Rows of an uploaded file: old names, missing texts, and a note with quotes, a line break and a space at its end.
FILE_ROWS = (
    *LINE_KEY,
    "l_quantity AS amount",
    "CASE WHEN l_tax = 0 THEN 'NA' ELSE CAST(l_discount AS STRING) END AS discount",
    "concat('\"', l_orderkey, '\", line\\n', l_linenumber, ' ') AS note",
)


@query(
    "score_file",
    f"""SELECT *, '"' || l_orderkey || '", line' || chr(10) || l_linenumber || ' ' AS note FROM ({scored_sql(LINES_SQL)})""",
)
def _(spark, sf):
    rows = derived(spark, sf, "lineitem", FILE_ROWS)
    source, target = scratch_path(spark, "upload"), scratch_path(spark, "scored")
    write_csv(rows, source)
    score_file(Scorer.load(spark, trained(spark, sf)[1]), spark, source, target)
    bounds = "prediction DOUBLE, lower_bound DOUBLE, upper_bound DOUBLE"
    scored = read_csv(spark, target, StructType([*rows.schema, *StructType.fromDDL(bounds)]))
    return tidy_scores(scored, "note")


FILLED_SQL = f"(SELECT * REPLACE (coalesce(discount, 0.04) AS discount) FROM {LINES_SQL})"
BATCH_RULES = (Rule("quantity", low=3, high=48, required=True), Rule("discount", low=0, high=0.08))


@query(
    "score_batch",
    f"""WITH good AS ({scored_sql(f"(SELECT * FROM {LINES_SQL} WHERE quantity >= 3 AND quantity <= 48 AND coalesce(discount, 0.04) <= 0.08)")}),
        bad AS ({rules_sql(BATCH_RULES, FILLED_SQL, LINE_KEY)})
        SELECT *, '' AS errors FROM good UNION ALL SELECT {", ".join(LINE_KEY)}, NULL, NULL, NULL, errors FROM bad WHERE NOT valid""",
)
def _(spark, sf):
    good, bad = Scorer.load(spark, trained(spark, sf)[1]).predict_batch(lines(spark, sf), BATCH_RULES)
    bounds = [F.lit(None).cast("double").alias(c) for c in ("prediction", "lower_bound", "upper_bound")]
    quarantined = bad.select(*LINE_KEY, *bounds, F.concat_ws("; ", "errors").alias("errors"))
    return tidy_scores(good).withColumn("errors", F.lit("")).unionByName(quarantined)


@query(
    "batch_report",
    f"""WITH {ONE_TREE}, r AS (SELECT quantity >= 3 AND quantity <= 48 AND coalesce(discount, 0.04) <= 0.08 AS valid FROM {LINES_SQL}),
        top AS (SELECT CASE WHEN f = 'quantity' THEN 'quantity=1.0,discount=0.0' ELSE 'discount=1.0,quantity=0.0' END AS top_features FROM tree)
        SELECT count(*) AS processed, count(*) FILTER (valid) AS scored, count(*) FILTER (NOT valid) AS quarantined, top_features
        FROM r, top GROUP BY top_features""",
)
def _(spark, sf):
    pipeline, state = forest(spark, sf)
    scorer = Scorer(pipeline, {"target_transform": "log1p", "feature_names": state.feature_names()}, LINEAR)
    result = score_records(scorer, lines(spark, sf), BATCH_RULES, scratch_path(spark, "batch"))
    top = ",".join(f"{r['feature']}={r['importance']}" for r in result.top_features)
    return result.scored.agg(F.count("prediction").alias("scored")).select(
        F.lit(result.processed).cast("bigint").alias("processed"),
        "scored",
        F.lit(result.quarantined_rows).cast("bigint").alias("quarantined"),
        F.lit(top).alias("top_features"),
    )


@query(
    "contract_info",
    f"""SELECT CAST(0 AS INTEGER) AS position, 'quantity' AS feature, 'numeric' AS kind, true AS required, NULL AS "default",
          count(*) AS rows, count(*) FILTER (quantity IS NULL) AS missing, CAST(min(quantity) AS VARCHAR) AS low, CAST(max(quantity) AS VARCHAR) AS high FROM {LINES_SQL}
        UNION ALL SELECT 1, 'discount', 'numeric', false, '0.04', count(*), count(*) FILTER (discount IS NULL), CAST(min(discount) AS VARCHAR), CAST(max(discount) AS VARCHAR) FROM {LINES_SQL}
        UNION ALL SELECT 2, 'flag', 'categorical', true, NULL, count(*), count(*) FILTER (flag IS NULL), min(flag), max(flag) FROM {LINES_SQL}""",
)
def _(spark, sf):
    contract = Contract(numeric=LINEAR.numeric, categorical=("flag",), target="label", defaults=LINEAR.defaults)
    return contract_report(lines(spark, sf), contract).select(
        "position", "feature", "kind", "required", "default", "rows", "missing", "low", "high"
    )


STREAMED = "(SELECT *, l_quantity AS quantity, l_discount AS discount FROM lineitem)"


@query(
    "stream_score",
    f"""WITH good AS ({scored_sql(STREAMED.replace(")", " WHERE l_quantity >= 3 AND l_quantity <= 48 AND l_discount <= 0.08)"))}),
        bad AS ({rules_sql(BATCH_RULES, STREAMED, LINE_KEY)})
        SELECT *, '' AS errors FROM good UNION ALL SELECT {", ".join(LINE_KEY)}, NULL, NULL, NULL, errors FROM bad WHERE NOT valid""",
)
def _(spark, sf):
    schema = table(spark, sf, "lineitem").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    ready = stream.withColumnsRenamed({"l_quantity": "amount", "l_discount": "discount"})
    target, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    scorer = Scorer.load(spark, trained(spark, sf)[1])
    start_scoring(ready, scorer, target, checkpoint, BATCH_RULES).awaitTermination()
    scored, quarantined = scored_rows(spark, target), quarantined_rows(spark, target)
    good = tidy_scores(scored).withColumn("errors", F.lit(""))
    bounds = [F.lit(None).cast("double").alias(c) for c in ("prediction", "lower_bound", "upper_bound")]
    return good.unionByName(quarantined.select(*LINE_KEY, *bounds, F.concat_ws("; ", "errors").alias("errors")))


@query(
    "model_info",
    f"""WITH {ridge_sql()} SELECT 'LinearRegressionModel' AS model_type, 'Production' AS stage, 'quantity,discount' AS features,
        'quantity,discount' AS transformed_features, count(*) FILTER (NOT is_test) AS train_size, CAST(0 AS BIGINT) AS val_size,
        count(*) FILTER (is_test) AS test_size FROM sp""",
)
def _(spark, sf):
    info = Scorer.load(spark, trained(spark, sf)[1], model_name="line_value").info(spark)
    return info.select(
        "model_type",
        "stage",
        F.array_join("features", ",").alias("features"),
        F.array_join("transformed_features", ",").alias("transformed_features"),
        "train_size",
        "val_size",
        "test_size",
    )


@query(
    "publish_production",
    f"""WITH {ridge_sql()} SELECT 'line_value' AS registry_model_name, '1' AS registry_version, 'run-a' AS run_id,
        'Production' AS promotion_stage, 'local_production_snapshot' AS artifact_delivery,
        (SELECT count(*) FROM te) AS test_size, (SELECT round(avg(prediction), 4) FROM te) AS mean_prediction""",
)
def _(spark, sf):
    result, path = trained(spark, sf)
    registry = Registry(spark, scratch_path(spark, "registry"))
    registry.add_run("run-a", "line_value", result.metrics["test"]["r2"], path)
    registry.promote_run("line_value", "run-a")
    target = scratch_path(spark, "production")
    registry.publish("line_value", target)
    pipeline, m = load_model(spark, target)
    test = prepare_training(lines(spark, sf), config()).where("is_test")
    names = ("registry_model_name", "registry_version", "run_id", "promotion_stage", "artifact_delivery")
    return (
        pipeline.transform(test)
        .agg(F.count("*").alias("test_size"), rounded(F.avg("prediction"), 4).alias("mean_prediction"))
        .withColumns({n: F.lit(m[n]) for n in names})
    )


# The second run's table: every row of the first, with labels moved so that drift fires and the cleaning keeps rows.
MOVED = "CASE WHEN label IS NULL THEN NULL ELSE label * 1.5 + 500 END"
MOVED_SQL = f"(SELECT * REPLACE ({MOVED} AS label) FROM {LINES_SQL})"


@query(
    "lifecycle_run",
    f"""WITH {ridge_sql(source=KEPT_SQL.replace(LINES_SQL, MOVED_SQL))}
        SELECT 'high' AS drift_level, true AS retrained, true AS promoted, '1' AS version, true AS published,
          round(1 - avg((actual - prediction) * (actual - prediction)) / var_pop(actual), 6) AS test_r2 FROM te""",
)
def _(spark, sf):
    df = lines(spark, sf)
    snapshot, base, target = (scratch_path(spark, n) for n in ("reference", "registry", "production"))
    registry = Registry(spark, base)
    first = run_lifecycle(df, config(), registry, snapshot, target, "shipped").first()
    if first["drift_level"] != "no_reference" or first["retrained"]:
        raise AssertionError(f"first run must only store the reference: {first}")
    out = run_lifecycle(df.withColumn("label", F.expr(MOVED)), config(), registry, snapshot, target, "shipped")
    return out.select(
        "drift_level", "retrained", "promoted", "version", "published", rounded("test_r2").alias("test_r2")
    )
