import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import Observation, functions as F

from evenkeel.contract import LISTINGS
from evenkeel.operators.maintained import LatestTable
from evenkeel.session import scratch_path
from evenkeel.operators.clean import (
    cast_numeric,
    clean,
    dedupe_full_row,
    exclude_categories,
    latest_per_key,
    outlier_filter,
    present_only,
    select_contract,
)
from evenkeel.operators.enrich import dim_backfill
from evenkeel.operators.validate import (
    FORM_RULES,
    REQUEST_RULES,
    Rule,
    alias_rename,
    located_rules,
    optional_defaults,
    split_valid,
    validate_rows,
)
from evenkeel.plans.scoring import district_backfill

NAN = float("nan")


def test_clean_applies_the_business_rules(extract):
    doubled = extract.unionAll(extract.limit(1))
    out = clean(doubled, LISTINGS, {"property_type": ("MOBILE",)})
    assert out.count() == 55
    assert not set(LISTINGS.drop) & set(out.columns)
    assert out.where("property_type = 'MOBILE'").count() == 0
    assert {dict(out.dtypes)[c] for c in LISTINGS.numeric} == {"double"}


def test_missing_and_wrong_types_are_row_errors(spark):
    rules = (Rule("bedrooms", low=0, high=20, required=True, whole=True), Rule("area", above=0, required=True))
    rows = [("3", 10.0), ("many", 10.0), ("NaN", 10.0), (" ", 10.0), (None, 10.0), ("2.5", NAN), ("40", -1.0)]
    df = spark.createDataFrame(rows, "bedrooms string, area double")
    got = [r["errors"] for r in validate_rows(df, rules).collect()]
    assert got == [
        [], ["bedrooms: Must be a number"], ["bedrooms: missing"], ["bedrooms: missing"], ["bedrooms: missing"],
        ["bedrooms: Must be a whole number", "area: missing"], ["bedrooms: Must be <= 20", "area: Must be > 0"],
    ]


def test_a_nan_does_not_beat_an_alias(spark):
    df = spark.createDataFrame([(NAN, 2.0), (None, 3.0), (1.0, 4.0)], "area double, old double")
    assert [r["area"] for r in alias_rename(df, {"old": "area"}).collect()] == [2.0, 3.0, 1.0]


def test_wide_dimensions_are_not_broadcast(spark, monkeypatch):
    from evenkeel.operators import enrich

    monkeypatch.setattr(enrich, "BROADCAST_BYTES", 1000)
    dim = spark.range(50).select("id", F.repeat(F.lit("x"), 100).alias("wide"))
    plan = enrich.lookup_join(spark.range(10), dim, "id")
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in enrich.lookup_join(spark.range(10), dim.drop("wide"), "id")._jdf.queryExecution().analyzed().toString()


def test_select_contract_order_and_error(extract):
    out = clean(extract, LISTINGS)
    assert select_contract(out, LISTINGS).columns == list(LISTINGS.training_columns)
    with pytest.raises(ValueError, match="living_area"):
        select_contract(out.drop("living_area"), LISTINGS)


def test_contract_lists_are_disjoint():
    assert not set(LISTINGS.drop) & set(LISTINGS.training_columns)
    assert LISTINGS.target not in LISTINGS.features


def test_dedupe_treats_nan_and_null_alike(spark):
    df = spark.createDataFrame([(1, NAN), (1, None), (2, 1.0)], "a int, b double")
    assert dedupe_full_row(df).count() == 2


def test_excluding_keeps_missing_categories(spark):
    df = spark.createDataFrame([("MOBILE",), (None,), ("X",)], "t string")
    assert exclude_categories(df, "t", ["MOBILE"]).count() == 2
    assert exclude_categories(df, "absent", ["MOBILE"]).count() == 3


def test_cast_fails_on_text(spark):
    with pytest.raises(NumberFormatException):
        cast_numeric(spark.createDataFrame([("x",)], "a string"), ["a"]).collect()


def test_outlier_bounds(spark):
    rows = [(100.0, 500.0), (99.9, 500.0), (200.0, 499.0), (200.0, 600.0), (None, 600.0), (150.0, NAN), (NAN, 600.0), (150.0, None)]
    df = spark.createDataFrame(rows, "t double, a double")
    removed = Observation()
    out = outlier_filter(df, "t", "a", 100.0, 200.0, 500.0, removed=removed)
    assert sorted(r["t"] for r in out.collect()) == [100.0, 200.0]
    assert removed.get["removed"] == 6
    assert outlier_filter(df, "t", "a", 100.0, 200.0, 500.0, enabled=False).count() == 8
    assert outlier_filter(df.drop("a"), "t", "a", 100.0, 200.0, 500.0).count() == 8
    with pytest.raises(ValueError, match="no column 't'"):
        outlier_filter(df.drop("t"), "t", "a", 100.0, 200.0, 500.0)


def test_present_only(spark):
    assert present_only(spark.createDataFrame([(1.0,), (NAN,), (None,)], "a double"), "a").count() == 1


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 5), (1, "2024-02-01", 6), (1, "2024-02-01", 7), (2, None, 8)], "k int, d string, v int")
    assert sorted(tuple(r) for r in latest_per_key(df, "k", "d", ["v"]).collect()) == [(1, "2024-02-01", 7), (2, None, 8)]


REQUEST = "bedrooms double, bathrooms double, living_area double, latitude double, longitude double, property_type string"


def errors(spark, rules, *row):
    return validate_rows(spark.createDataFrame([row], REQUEST), rules).first()["errors"]


def test_request_rules(spark):
    assert errors(spark, REQUEST_RULES, 3.0, 2.0, 1500.0, None, None, "CONDO") == []
    assert errors(spark, REQUEST_RULES, -1.0, 2.0, 1500.0, 36.0, -115.0, "CONDO") == ["bedrooms: Must be >= 0"]
    assert len(errors(spark, REQUEST_RULES, 2.5, 21.0, 0.0, 91.0, -181.0, None)) == 6
    assert errors(spark, FORM_RULES, 3.0, 2.0, 99.0, 40.0, -115.0, "") == [
        "living_area: Must be >= 100.0",
        "latitude: Must be <= 36.5",
        "property_type: missing",
    ]


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(3.0, 2.0, 1500.0, 36.0, -115.0, "A"), (-1.0, 2.0, 1500.0, None, -115.0, "B")], REQUEST)
    good, bad = split_valid(validate_rows(df, (*REQUEST_RULES, *located_rules())))
    assert good.count() == 1
    assert bad.first()["errors"] == ["bedrooms: Must be >= 0", "latitude: missing"]


def test_alias_rename(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "livingarea double, living_area double")
    out = alias_rename(df, LISTINGS.aliases)
    assert out.columns == ["living_area"]
    assert sorted(r[0] for r in out.collect()) == [1.0, 3.0]


def test_aliases_lead_to_contract_features():
    assert set(LISTINGS.aliases.values()) <= set(LISTINGS.features)


def test_optional_defaults(spark):
    df = spark.createDataFrame([(1.0,), (None,), (NAN,)], "a double")
    out = optional_defaults(df, {"a": 5.0, "b": 7.0})
    assert sorted(tuple(r) for r in out.collect()) == [(1.0, 7.0), (5.0, 7.0), (5.0, 7.0)]


def test_district_backfill(spark):
    df = spark.createDataFrame([("Anthem", None, -1.0), ("Nowhere", None, None), (None, 1.0, NAN)], "vegas_district string, latitude double, longitude double")
    b = district_backfill(spark)
    out = {r["vegas_district"]: r for r in dim_backfill(df, b.dim, b.key, b.fills).collect()}
    assert (out["Anthem"]["latitude"], out["Anthem"]["longitude"]) == (35.9853, -1.0)
    assert out["Nowhere"]["latitude"] is None
    assert out[None]["longitude"] is None
    added = dim_backfill(df.select("vegas_district"), b.dim, b.key, b.fills).where("vegas_district = 'Anthem'").first()
    assert added["longitude"] == -115.1017


def test_backfill_beyond_the_broadcast_bound_gives_the_same(spark, monkeypatch):
    b = district_backfill(spark)
    df = b.dim.select("vegas_district", F.lit(None).cast("double").alias("latitude"))
    small = dim_backfill(df, b.dim, b.key, {"latitude": "dim_lat"})
    monkeypatch.setattr("evenkeel.operators.enrich.BROADCAST_ROWS", 3)
    large = dim_backfill(df, b.dim, b.key, {"latitude": "dim_lat"})
    assert small.exceptAll(large).count() == 0
    with pytest.raises(ValueError, match="not unique"):
        dim_backfill(df, b.dim.unionAll(b.dim), b.key, {"latitude": "dim_lat"})


@pytest.mark.parametrize("order", ([0, 1, 2], [2, 0, 1], [1, 1, 2, 0]))
def test_maintained_table_equals_recomputation(spark, order):
    rows = [(k, f"2024-01-{1 + (k * 7 + i * 11) % 28:02d}", i) for k in range(40) for i in range(6)] + [(None, "2024-01-05", 1), (None, None, 2)]
    df = spark.createDataFrame(rows, "k int, d string, v int")
    kept = LatestTable(spark, scratch_path(spark, "latest"), df.schema, ("k",), "d", ("v",), buckets=8)
    assert kept.rows().count() == 0
    for third in order:
        kept.merge(df.where(F.col("v") % 3 == third))
    want = sorted(map(str, latest_per_key(df, "k", "d", ["v"]).collect()))
    assert sorted(map(str, kept.rows().collect())) == want
    before = kept._state()[1]
    touched = kept.merge(spark.createDataFrame([(3, "2025-01-01", 9)], df.schema))
    after = kept._state()[1]
    assert len(touched) == 1 and [b for b in after if after[b] != before[b]] == [str(touched[0])]
    with pytest.raises(ValueError):
        LatestTable(spark, kept.path, df.schema, ("k",), "d", ("v",), buckets=9).rows()


def test_two_merges_at_once_lose_nothing(spark):
    from concurrent.futures import ThreadPoolExecutor

    df = spark.range(60).select((F.col("id") % 20).cast("int").alias("k"), F.col("id").cast("string").alias("d"), F.col("id").cast("int").alias("v"))
    kept = LatestTable(spark, scratch_path(spark, "latest"), df.schema, ("k",), "v", (), buckets=4)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda part: kept.merge(df.where(F.col("v") % 3 == part)), range(3)))
    assert sorted((r["k"], r["v"]) for r in kept.rows().collect()) == [(k, 40 + k) for k in range(20)]
