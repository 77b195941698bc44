import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from evenkeel.contract import LISTINGS, Contract
from evenkeel.operators.estimators import feature_importance, fit_pipeline, inner_model, resolve_parameters
from evenkeel.operators.evaluate import IntervalSpec, calibrate_intervals, interval_coverage, regression_metrics
from evenkeel.operators.features import categories, fit_features, impute_mode, medians, moments, one_hot_columns, standardize, transform_features
from evenkeel.operators.intervals import forest_interval, predict_with_interval, segmented_interval
from evenkeel.operators.ranking import split_in_three
from evenkeel.operators.validate import REQUEST_RULES
from evenkeel.plans.scoring import Scorer, describe_contract, district_backfill, score_file, score_records
from evenkeel.plans.training import TrainConfig, prepare_training, train_run
from evenkeel.session import scratch_path
from evenkeel.sources.artifacts import load_model
from evenkeel.sources.tables import read_csv, write_csv
from evenkeel.streaming.scoring import batch_counts, quarantined_rows, scored_rows, start_scoring

SPEC = IntervalSpec(
    segment_edges=[376396.84762496233, 451704.94425660407, 563068.8811042374, 765686.6680534559],
    relative_error_quantiles_by_segment=[0.24518378008285518, 0.3511801512715619, 0.2500635958018682, 0.312822831332614, 0.5556286263780003],
    relative_error_quantiles={"global": 0.42545754415059117},
)


@pytest.fixture(scope="module")
def trained(spark, extract):
    result = train_run(extract, TrainConfig(model_type="ridge", handle_outliers=False))
    return result, result.save(spark, scratch_path(spark, "model"))


def column(df, name="x"):
    return [r[name] for r in df.collect()]


def test_median_mode_and_moments(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "b"), (10.0, "a"), (None, None), (float("nan"), None)], "n double, c string")
    assert medians(df, ["n"]) == {"n": 2.5}
    assert categories(df, ["c"])["c"].mode == "a"
    assert impute_mode(df, ["c"]).where("c = 'a'").count() == 4
    assert moments(df, ["n"])[0] == (4.0, pytest.approx(3.5355339059))
    with pytest.raises(ValueError, match="no present values"):
        medians(df.where("n > 100"), ["n"])


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert column(standardize(df, ["x"])) == [0.0, 0.0]


def test_one_hot_unknown_and_missing_are_zero(spark):
    df = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    rows = [tuple(r)[1:] for r in one_hot_columns(df, "c", ["b", "a", "c"]).collect()]
    assert rows == [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]


def test_features_fit_on_train_transform_elsewhere(spark, listings):
    state = fit_features(listings, LISTINGS)
    assert state.feature_names()[:6] == list(LISTINGS.numeric)
    assert state.feature_names()[6:9] == ["property_type_CONDO", "property_type_SINGLE_FAMILY", "property_type_TOWNHOUSE"]
    odd = listings.limit(1).withColumns({"property_type": F.lit("BOAT"), "vegas_district": F.lit(None).cast("string"), "extra": F.lit(1)})
    out = transform_features(odd, state).select(vector_to_array("features").alias("v")).first()["v"]
    assert out[6:9] == [0.0, 0.0, 0.0]
    assert sum(out[9:]) == 1.0  # a missing category takes the mode
    with pytest.raises(ValueError, match="living_area"):
        transform_features(odd.drop("living_area"), state)
    with pytest.raises(RuntimeError):
        transform_features(odd, None)


def test_quotes_in_a_category_survive(spark):
    c = Contract(numeric=("x",), categorical=("k",), target="y")
    df = spark.createDataFrame([(1.0, "it's", 1.0), (2.0, 'a"b\\', 2.0), (3.0, "it's", 3.0)], "x double, k string, y double")
    out = transform_features(df.withColumn("k", F.lit(None).cast("string")), fit_features(df, c))
    assert out.select(vector_to_array("features").alias("v")).first()["v"][1:] == [0.0, 1.0]


def test_split_sizes_of_the_extract(extract):
    split = prepare_training(extract.unionAll(extract.limit(1)), TrainConfig(split_key=("property_id",)))
    assert split.columns == [*LISTINGS.training_columns, "is_test"]
    assert (split.where("is_test").count(), split.count()) == (11, 55)


def test_ridge_matches_the_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)) * [1, 5] + [2, -3]
    y = x @ [1.5, -2] + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, y double")
    pipeline, _ = fit_pipeline(df, Contract(("a", "b"), (), "y"), "ridge", {"alpha": 3.0, "bogus": 1}, target_transform="none")
    z = (x - x.mean(0)) / x.std(0)
    expected = np.linalg.solve(z.T @ z + 3.0 * np.eye(2), z.T @ (y - y.mean()))
    np.testing.assert_allclose(inner_model(pipeline).coefficients.toArray(), expected, rtol=1e-9)


def test_unknown_family_and_ignored_parameters():
    with pytest.raises(ValueError, match="Unsupported|Unknown"):
        resolve_parameters("svm", {})
    assert "bogus" not in resolve_parameters("hist_gradient_boosting", {"bogus": 1, "max_iter": 7})
    assert resolve_parameters("HistGradientBoostingRegressor", {"max_iter": 7})["maxIter"] == 7


def test_train_save_load_score(spark, extract, trained):
    result, path = trained
    assert set(result.metrics["test"]) == {"r2", "rmse", "mae", "mse", "cheap_segment_mae", "cheap_segment_cutoff_p25"}
    assert result.metrics["promote_to_production"] is False
    pipeline, metadata = load_model(spark, path)
    assert metadata["feature_names"] == result.features.feature_names()
    assert (metadata["train_size"], metadata["val_size"], metadata["test_size"]) == (44, 0, 11)
    before, after = (column(p.transform(extract.orderBy("property_id")), "prediction") for p in (result.pipeline, pipeline))
    assert before == after and all(map(math.isfinite, after))


def test_a_run_reports_what_it_removed_and_what_its_intervals_cover(spark, extract):
    limits = extract.selectExpr("percentile(price, 0.2) AS low", "percentile(price, 0.9) AS high").first()
    cfg = TrainConfig(model_type="ridge", min_target=limits["low"], max_target=limits["high"], min_area=0.0, normalizer="prediction")
    result = train_run(extract, cfg)
    inside = extract.where(F.col("price").between(limits["low"], limits["high"]) & (F.col("property_type") != "MOBILE")).count()
    assert result.metadata["removed_rows"] == 55 - inside
    assert result.metadata["interval_coverage"] >= 0.95


def test_loading_rules(spark, trained):
    with pytest.raises(FileNotFoundError):
        load_model(spark, scratch_path(spark, "nothing"))
    bare = scratch_path(spark, "bare")
    trained[0].pipeline.save(f"{bare}/pipeline")
    assert load_model(spark, bare)[1] == {}


def test_scoring_a_legacy_record(spark, trained):
    scorer = Scorer.load(spark, trained[1], district_backfill(spark), "listing_price")
    record = {"bedrooms": 3, "bathrooms": 2.0, "livingarea": 1500.0, "propertytype": "CONDO", "vegas_district": "Summerlin"}
    assert math.isfinite(scorer.predict_single(spark, record))
    out = scorer.predict(spark.createDataFrame([record]))
    assert set(out.columns) == {*record, "prediction", "lower_bound", "upper_bound"}
    with pytest.raises(ValueError, match="bathrooms"):
        scorer.predict(spark.createDataFrame([record]).drop("bathrooms"))
    info = scorer.info(spark).first()
    assert info["features"] == list(LISTINGS.features)
    assert info["transformed_count"] == len(info["transformed_features"])


def test_batch_quarantines_and_file_keeps_its_columns(spark, extract, trained):
    scorer = Scorer.load(spark, trained[1], district_backfill(spark))
    rows = extract.withColumn("bedrooms", F.when(F.col("property_id") == 503, -1).otherwise(F.col("bedrooms")))
    good, bad = scorer.predict_batch(rows, REQUEST_RULES)
    assert (good.count(), bad.count()) == (59, 1)
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    write_csv(extract, source)
    score_file(scorer, spark, source, target, extract.schema)
    done = read_csv(spark, target)
    assert done.columns == [*extract.columns, "prediction", "lower_bound", "upper_bound"]
    assert done.count() == 60


def test_stream_scores_like_batch(spark, extract, trained):
    scorer = Scorer.load(spark, trained[1], district_backfill(spark))
    source, target = scratch_path(spark, "feed"), scratch_path(spark, "stream-out")
    extract.repartition(3).write.parquet(source)
    start_scoring(spark.readStream.schema(extract.schema).parquet(source), scorer, target, scratch_path(spark, "cp")).awaitTermination()
    scored = scored_rows(spark, target).drop("model_version")
    assert scored.exceptAll(scorer.predict(extract)).count() == 0 and scored.count() == extract.count()


def test_stream_keeps_rows_that_fail(spark, extract, trained):
    scorer = Scorer.load(spark, trained[1], district_backfill(spark))
    source, target = scratch_path(spark, "feed"), scratch_path(spark, "stream-out")
    rows = extract.withColumn("bedrooms", F.when(F.col("property_id") % 5 == 0, 99).otherwise(F.col("bedrooms")))
    rows.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_scoring(stream, scorer, target, scratch_path(spark, "cp"), REQUEST_RULES).awaitTermination()
    good, bad = scored_rows(spark, target), quarantined_rows(spark, target)
    assert bad.count() == rows.where("bedrooms = 99").count() > 0
    assert good.count() + bad.count() == rows.count()
    assert {tuple(r["errors"]) for r in bad.collect()} == {("bedrooms: Must be <= 20",)}
    counted = {r["counter"]: r["n"] for r in batch_counts(spark, target).groupBy("counter").agg(F.sum("n").alias("n")).collect()}
    assert (counted.pop("rows"), counted.pop("quarantined")) == (rows.count(), bad.count())
    assert counted.pop("bedrooms: Must be <= 20") == bad.count() and set(counted.values()) == {0}
    # A stream with a new checkpoint adds its rows to what is there.
    start_scoring(stream, scorer, target, scratch_path(spark, "cp"), REQUEST_RULES).awaitTermination()
    assert scored_rows(spark, target).count() + quarantined_rows(spark, target).count() == 2 * rows.count()


def test_batch_result_counts_both_sides(spark, extract, trained):
    scorer = Scorer.load(spark, trained[1], district_backfill(spark))
    rows = extract.withColumn("bedrooms", F.when(F.col("property_id") % 5 == 0, 99).otherwise(F.col("bedrooms")))
    result = score_records(scorer, rows, REQUEST_RULES, scratch_path(spark, "batch"))
    assert (result.processed, result.quarantined_rows) == (rows.count(), rows.where("bedrooms = 99").count())
    assert result.scored.count() + result.quarantined.count() == result.processed and result.top_features is None


@pytest.mark.parametrize("shares", [(0.2, 0.1), (0.3, 0.0), (0.0, 0.25), (0.5, 0.5)])
def test_three_parts_have_exact_sizes(spark, shares):
    for rows in (spark.range(997).select("id", (F.col("id") * 7919 % 1009).cast("double").alias("n")),
                 spark.range(997).select("id", F.lit(1.0).alias("n")), spark.range(0).select("id", F.lit(1.0).alias("n"))):
        size = rows.count()
        got = {r["part"]: r["count"] for r in split_in_three(rows, "n", *shares).groupBy("part").count().collect()}
        test = math.ceil(shares[0] * size)
        calibration = min(size - test, math.ceil(shares[1] * size))
        want = {"test": test, "calibration": calibration, "train": size - test - calibration}
        assert got == {k: n for k, n in want.items() if n}


def test_interval_calibrated_on_rows_of_its_own(spark, extract):
    cfg = TrainConfig(model_type="ridge", handle_outliers=False, calibration_size=0.3)
    result = train_run(extract, cfg)
    m = result.metadata
    size = m["train_size"] + m["calibration_rows"] + m["test_size"]
    assert size == prepare_training(extract, cfg).count()
    assert (m["calibration_rows"], m["test_size"]) == (math.ceil(0.3 * size), math.ceil(0.2 * size))
    assert result.interval.calibration_size == m["calibration_rows"] and 0 <= m["interval_coverage"] <= 1


def test_a_category_per_row_stays_in_a_table(spark):
    df = spark.range(500).select(F.col("id").cast("double").alias("x"), F.concat(F.lit("k"), "id").alias("k"), F.lit(1.0).alias("y"))
    state = fit_features(df, Contract(numeric=("x",), categorical=("k",), target="y"))
    out = transform_features(df.unionAll(spark.createDataFrame([(1.0, "new", 1.0)], df.schema)), state)
    assert "labels" not in state.__dict__  # no label reached the driver
    ordered = sorted(f"k{i}" for i in range(500))
    for r in out.collect():
        v = r["features"]
        assert v.size == 501
        hot = [i for i in v.toArray().nonzero()[0] if i > 0]
        assert hot == ([1 + ordered.index(r["k"])] if r["k"] != "new" else [])
    assert [r["name"] for r in state.feature_table().orderBy("position").collect()] == state.feature_names()


def test_a_scored_table_can_be_scored_again(spark, extract, trained):
    scorer = Scorer.load(spark, trained[1], district_backfill(spark))
    once = scorer.predict(extract.withColumn("features", F.lit("clash")))
    again = scorer.predict(once)
    assert again.columns == once.columns and again.exceptAll(once).count() == 0
    plan = scorer.predict_batch(extract, REQUEST_RULES)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_splitting_on_a_key_that_all_rows_share(spark):
    from evenkeel.operators.ranking import split_exact

    df = spark.range(1000).select((F.col("id") % 50).alias("v"), F.lit("same").alias("k")).repartition(7)
    split = split_exact(df, 0.2, 42, ["k"])
    assert (split.where("is_test").count(), split.count()) == (200, 1000)
    copies = split_exact(df.select(F.lit(1).alias("v"), "k"), 0.2011, 42, ["k"])
    assert (copies.where("is_test").count(), copies.count()) == (202, 1000)


def test_metrics_are_over_the_same_rows(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None), (4.0, 3.0), (9.0, float("nan"))], "y double, p double")
    row = regression_metrics(df, "y", "p").first()
    assert (row["mse"], row["mae"], row["r2"]) == (0.625, 0.75, pytest.approx(1 - 0.625 / 2.25))


def test_scoring_plan_has_no_shuffle_and_no_python(spark, trained, extract, sf):
    source = scratch_path(spark, "plan")
    extract.write.parquet(source)
    plan = Scorer.load(spark, trained[1]).predict(spark.read.parquet(source))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scans_receive_filters_and_only_needed_columns(spark, sf):
    from evenkeel.operators.clean import outlier_filter
    from evenkeel.sources.tables import scan_positive

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = plan(outlier_filter(items, "l_extendedprice", "l_quantity", 1000.0, 2000.0, 5.0).select("l_orderkey"))
    assert "GreaterThanOrEqual(l_extendedprice,1000.0)" in text and "l_shipdate" not in text
    assert "GreaterThan(c_acctbal,0.0)" in plan(scan_positive(spark.read.parquet(f"{sf}/customer.parquet"), "c_acctbal"))


@pytest.mark.parametrize(
    "raw, lower, upper",
    [
        (-5.0, 0.0, 0.0),
        (300000.0, 226444.86597514348, 373555.13402485655),
        (376396.84762496233, 244213.74573788902, 508579.9495120356),
        (500000.0, 374968.2020990659, 625031.7979009341),
        (700000.0, 481024.01806717017, 918975.9819328298),
        (1000000.0, 444371.37362199975, 1555628.6263780002),
    ],
)
def test_segmented_bounds(spark, raw, lower, upper):
    row = segmented_interval(spark.createDataFrame([(raw,)], "prediction double"), SPEC).first()
    assert (row["lower_bound"], row["upper_bound"]) == pytest.approx((lower, upper), rel=1e-13)


def test_legacy_bands_and_unsupported(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (25.0,)], "prediction double")
    spec = IntervalSpec(segment_edges=[10.0, 20.0], relative_error_quantiles={"global": 0.5, "low": 0.1})
    assert column(segmented_interval(df, spec), "upper_bound") == pytest.approx([5.5, 22.5, 37.5])
    assert segmented_interval(df, replace(spec, segment_edges=[10.0])) is None
    assert segmented_interval(df, replace(spec, method="other")) is None


def test_calibration_matches_numpy(spark):
    rng = np.random.default_rng(5)
    y = rng.lognormal(3, 1, 400)
    p = y * rng.normal(1, 0.3, 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    spec = calibrate_intervals(df, "y", "p")
    level = np.maximum(p, 0)
    err = np.abs(y - level) / np.maximum(np.abs(y), 1)
    edges = np.quantile(level, [0.2, 0.4, 0.6, 0.8])
    np.testing.assert_allclose(spec.segment_edges, edges, rtol=1e-12)
    seg = np.searchsorted(edges, level, side="right")
    expected = [np.quantile(err[seg == i], 0.95, method="higher") for i in range(5)]
    assert spec.relative_error_quantiles_by_segment == pytest.approx(expected, rel=1e-12)
    assert spec.relative_error_quantiles["global"] == pytest.approx(np.quantile(err, 0.95, method="higher"))


def test_small_segments_take_the_global_width(spark):
    df = spark.createDataFrame([(float(i), float(i + i % 3)) for i in range(1, 20)], "y double, p double")
    spec = calibrate_intervals(df, "y", "p")
    assert set(spec.relative_error_quantiles_by_segment) == {spec.relative_error_quantiles["global"]}


def test_prediction_normaliser_covers(spark):
    rng = np.random.default_rng(6)
    y = rng.lognormal(3, 1, 500)
    df = spark.createDataFrame([(float(a), float(a * rng.normal(0.6, 0.2))) for a in y], "y double, prediction double")
    spec = calibrate_intervals(df, "y", "prediction", normalizer="prediction")
    bounded = segmented_interval(df.where("prediction > 0"), spec)
    assert interval_coverage(bounded, "y").first()["coverage"] >= 0.95
    assert bounded.where("lower_bound > prediction OR upper_bound < prediction OR lower_bound < 0").count() == 0


def test_metrics_of_a_constant_target(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert regression_metrics(df, "y", "p").first()["r2"] == 1.0
    assert regression_metrics(df.withColumn("p", F.lit(2.0)), "y", "p").first()["r2"] == 0.0


def test_forest_bounds_and_importance(spark, extract):
    cfg = TrainConfig(handle_outliers=False)
    train = prepare_training(extract, cfg)
    pipeline, state = fit_pipeline(train, LISTINGS, "random_forest", {"n_estimators": 11, "max_depth": 4})
    out = forest_interval(pipeline, train)
    assert out.where("lower_bound > upper_bound").count() == 0
    trees = []
    ready = PipelineModel(pipeline.stages[:-2]).transform(train)
    for tree in inner_model(pipeline).trees:
        trees.append([math.expm1(r["prediction"]) for r in tree.setPredictionCol("prediction").transform(ready).collect()])
    expected = np.percentile(np.array(trees), [2.5, 97.5], axis=0)
    got = np.array([(r["lower_bound"], r["upper_bound"]) for r in out.collect()]).T
    np.testing.assert_allclose(got, expected, rtol=1e-9)
    top = feature_importance(pipeline, state.feature_names(), 3).collect()
    assert len(top) == 3 and top[0]["importance"] >= top[2]["importance"]
    assert predict_with_interval(pipeline, None, train).columns == out.columns


def test_boosting_learns_more_than_a_mean(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_quantity AS q", "l_discount AS d", "l_returnflag AS f", "1000 * l_quantity * (1 - l_discount) AS y")
    pipeline, _ = fit_pipeline(df, Contract(("q", "d"), ("f",), "y"), "hist_gradient_boosting", {"max_iter": 10, "learning_rate": 0.3, "max_depth": 3})
    assert regression_metrics(pipeline.transform(df), "y", "prediction").first()["r2"] > 0.9


def test_flat_bounds_and_no_importance_for_linear(trained, extract):
    result, _ = trained
    row = predict_with_interval(result.pipeline, None, extract).first()
    assert row["lower_bound"] == row["prediction"] == row["upper_bound"]
    with pytest.raises(ValueError, match="weighs no features"):
        feature_importance(result.pipeline, result.features.feature_names())


def test_contract_description(spark):
    rows = {r["feature"]: r for r in describe_contract(spark, LISTINGS).collect()}
    assert rows["normalized_lot_area_value"]["required"] is False
    assert rows["normalized_lot_area_value"]["default"] == "5000.0"
    assert rows["property_type"]["options"] == ["SINGLE_FAMILY", "TOWNHOUSE", "CONDO"]
