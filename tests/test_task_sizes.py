from pyspark.sql import DataFrame

from evenkeel.contract import Contract
from evenkeel.operators import estimators
from evenkeel.operators.estimators import fit_pipeline, spread
from evenkeel.operators.validate import Rule
from evenkeel.plans.scoring import Scorer, score_records
from evenkeel.session import scratch_root
from evenkeel.streaming.scoring import quarantined_rows, scored_rows, start_scoring

CONTRACT = Contract(numeric=("a", "b"), categorical=(), target="y")


def sample(spark, parts=1):
    return spark.range(0, 4_000, 1, parts).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST(id % 17 * 10 + id % 5 AS DOUBLE) AS y")


def test_tree_fits_deal_rows_by_their_size(spark, monkeypatch):
    df = sample(spark)
    assert spread(df, 4_000, 2).rdd.getNumPartitions() == 1  # small tables stay as they are
    settings = {"max_iter": 2, "max_depth": 3, "min_samples_leaf": 1}
    whole = fit_pipeline(df, CONTRACT, "hist_gradient_boosting", settings)[0].transform(df).select("prediction").distinct()
    expected = sorted(round(r[0], 6) for r in whole.collect())
    monkeypatch.setattr(estimators, "TASK_BYTES", 10_000)
    assert spread(df, 4_000, 2).rdd.getNumPartitions() == 100
    dealt = fit_pipeline(df, CONTRACT, "hist_gradient_boosting", settings)[0].transform(df).select("prediction").distinct()
    assert sorted(round(r[0], 6) for r in dealt.collect()) == expected


def test_scoring_keeps_no_split_in_memory_and_no_copy_behind(spark, monkeypatch, tmp_path):
    df = sample(spark)
    scorer = Scorer(fit_pipeline(df, CONTRACT, "ridge", None, "none")[0], {}, CONTRACT)
    monkeypatch.setattr(DataFrame, "persist", lambda self, *level: (_ for _ in ()).throw(AssertionError("cached")))
    labels = []
    monkeypatch.setattr("evenkeel.session.scratch_path", lambda s, label: labels.append(f"{scratch_root(s)}/{label}-{tmp_path.name}") or labels[-1])
    result = score_records(scorer, df, [Rule("b", low=1)], str(tmp_path / "batch"))
    assert (result.processed, result.quarantined_rows, result.scored.count(), result.quarantined.count()) == (4_000, 800, 3_200, 800)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    start_scoring(stream, scorer, str(tmp_path / "out"), str(tmp_path / "checkpoint"), [Rule("b", low=1)]).awaitTermination()
    assert scored_rows(spark, str(tmp_path / "out")).count() == 3_200 and quarantined_rows(spark, str(tmp_path / "out")).count() == 800
    jvm = spark._jvm.org.apache.hadoop.fs
    assert len(labels) == 2
    for path in labels:
        assert not jvm.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jvm.Path(path))
