"""Measures against a plain loop, and verdicts on hosts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.quality_rules import HostRules, document_measures, host_verdicts, judge_documents

TEXTS = [
    None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "x x x x x", "a b c d a b c e a b c",
    "Ünï çödé\x0bwörds\x0c#tag $5 | <b> & 100% *\n\nsame line\nsame line\n same line\n\n \n same line",
    "long tail " * 30_000, " lead and trail ", "a\r\nb\r\nb\r\n",
]


def plain(text):
    text = text or ""

    def split(s):
        for c in "\t\n\x0b\x0c\r":
            s = s.replace(c, " ")
        return [w for w in s.split(" ") if w]

    words = split(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if split(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_plain_version(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").withColumn("lines", F.lit("extra"))
    got = {r["id"]: tuple(r)[2:] for r in document_measures(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_hosts_are_shrunk_towards_the_corpus(spark):
    # A large bad host, a tiny bad one, and good ones.
    rows = [("bad", i % 20 != 0) for i in range(400)] + [("tiny", True)] * 2 + [(f"good{i % 8}", i % 25 == 0) for i in range(1600)]
    rows += [(None, True)] * 50
    df = spark.createDataFrame(rows, "host string, base_failed boolean")
    got = {r["host"]: r for r in host_verdicts(df, "host").collect()}
    assert set(got) == {h for h, _ in rows if h}
    overall = sum(f for h, f in rows if h) / sum(1 for h, _ in rows if h)
    assert 0.9 < got["bad"]["host_rate"] < 0.95 and got["bad"]["host_failed"]
    assert overall < got["tiny"]["host_rate"] < 1
    assert not any(got[f"good{i}"]["host_failed"] for i in range(8))
    alike = host_verdicts(spark.createDataFrame([("a", True), ("a", False)] * 50 + [("b", True), ("b", False)] * 50, df.schema), "host")
    assert {r["host_rate"] for r in alike.collect()} == {0.5}
    assert host_verdicts(df.limit(0), "host").count() == 0
    assert {r["host_rate"] for r in host_verdicts(df.where("base_failed"), "host").collect()} == {1.0}


def test_a_host_takes_its_documents_down(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "junk " * 80, "bad") for i in range(90)] + [(200, good, "bad"), (201, good, "fine"), (201, good, "fine"), (202, good, None), (None, "", None)]
    rows += [(300 + i, good + f" {i}", "fine") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("kept_before", F.lit(1))
    out = judge_documents(df)
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in out.collect()}
    assert got[0] == (True, False) and got[200] == (False, False) and got[201] == got[202] == (False, True) and got[None] == (True, False)
    assert out.count() == len(rows) and "kept_before" in out.columns
    assert judge_documents(df.limit(0)).count() == 0
    assert judge_documents(df, rules=HostRules(max_host_rate=1.0)).where("doc_id = 200").first()["kept"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ("n_words", "host_failed", "_words", "base_failed", "kept"))
def test_clashing_names_are_refused(spark, name):
    with pytest.raises(ValueError, match="exist already"):
        judge_documents(spark.createDataFrame([(1, "a", "s", 2)], f"doc_id bigint, text string, source string, {name} int"))


def test_other_names(spark):
    df = spark.createDataFrame([(1, "a b c", "s", 2)], "doc_id bigint, _words string, host string, text int")
    row = judge_documents(df, host="host", text="_words").first()
    assert (row["n_words"], row["text"], row["base_failed"]) == (3, 2, True)
