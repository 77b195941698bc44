from evenkeel.contract import Contract
from evenkeel.operators import features
from evenkeel.operators.features import fit_features


def test_wide_features_carry_no_metadata_and_equal_the_narrow_form(spark, monkeypatch):
    rows = [("a", 1.0), ("b", None), (None, 3.0), ("c", float("nan")), ("a", 5.0), ("b", 2.0)]
    train = spark.createDataFrame(rows, "k string, x double")
    contract = Contract(numeric=("x",), categorical=("k",), target="x")
    df = train.unionByName(spark.createDataFrame([("unseen", 2.0)], train.schema))
    described = fit_features(train, contract).transform(df)
    expected = sorted(repr((r["k"], r["features"].toArray().tolist())) for r in described.select("k", "features").collect())
    monkeypatch.setattr(features, "DESCRIBED", 0)
    wide = fit_features(train, contract).transform(df)
    assert wide.columns == described.columns and not wide.schema["features"].metadata
    assert sorted(repr((r["k"], r["features"].toArray().tolist())) for r in wide.select("k", "features").collect()) == expected
    counted = {r["position"]: r["rows"] for r in features.nonzero_counts(wide).collect()}
    assert counted == {r["position"]: r["rows"] for r in features.nonzero_counts(described).collect()}
    assert (counted[1], counted[2], counted[3]) == (3, 2, 1)  # the missing category took the mode, "a"


def test_a_feature_per_row_is_not_described_on_the_driver(spark):
    df = spark.range(12_000).selectExpr("concat('k', id) AS k", "CAST(id AS DOUBLE) AS x")
    state = fit_features(df, Contract(numeric=("x",), categorical=("k",), target="x"))
    out = state.transform(df)
    assert not out.schema["features"].metadata
    counted = features.nonzero_counts(out).where("position > 0").selectExpr("count(*)", "sum(rows)", "max(position)").first()
    assert tuple(counted) == (12_000, 12_000, 12_000)
