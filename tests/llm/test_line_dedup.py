"""Dropped lines against a plain version, runs against sets."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.line_dedup import LineRuns, drop_repeated_lines
from evenkeel.llm.queries import ORACLES, QUERIES

BLANKS = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_result(rows, least_chars=20, least_documents=3):
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    holders = defaultdict(set)
    for number, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(number)
    out = []
    for number, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            held = holders.get(key(line), ())
            keeper = max((n for n in held if n is not None), default=None)
            if len(held) < least_documents or number == keeper:
                kept.append(line)
        out.append((str(number), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def made_rows(n, seed):
    rng = random.Random(seed)
    lines = [f"shared line number {k:04d} of many" for k in range(12)] + ["short", "", "ÄÖÜ" * 7, "É" * 19, "É" * 20, "漢" * 20]
    dress = lambda x: rng.choice(["", " ", "\t\r"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", " \x0b"])
    rows = []
    for _ in range(n):
        text = "\n".join(dress(rng.choice(lines)) for _ in range(rng.randrange(6))) + f"\nown line of text {rng.random()}"
        rows.append((rng.randrange(n // 2), text))
    return rows + [(None, lines[0]), (None, lines[1] + "\n" + lines[1]), (5, None), (6, ""), (6, ""), (n, "\n\n"), (n + 1, "x" * 300000)]


@pytest.mark.parametrize("batches, fan", ((1, 2), (4, 3), (9, 2)))
def test_equals_plain_version(spark, batches, fan):
    rows = made_rows(120, batches)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"hash": F.lit(1), "batch": F.lit("b")})
    got = drop_repeated_lines(df.repartition(3), batches=batches, fan=fan).collect()
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == plain_result(rows)
    assert all((r["hash"], r["batch"]) == (1, "b") for r in got)


def test_other_limits(spark):
    rows = made_rows(60, 3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = drop_repeated_lines(df, least_chars=5, least_documents=2).collect()
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == plain_result(rows, 5, 2)


def test_rare_lines_are_joined(spark, monkeypatch):
    """With nothing common enough to be broadcast the result is the same."""
    monkeypatch.setattr("evenkeel.llm.line_dedup.HEAVY", 2)
    rows = made_rows(60, 8)
    got = drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == plain_result(rows)


def test_runs_equal_a_set(spark):
    rng, runs, seen = random.Random(1), LineRuns(fan=2), set()
    for k in range(7):
        batch = {rng.randrange(60) for _ in range(15)}
        fresh = runs.add(spark.createDataFrame([(x, k) for x in batch], "hash int, keeper int"))
        assert {r["hash"] for r in fresh.collect()} == batch - seen
        seen |= batch
        assert all(len(level) < 2 for level in runs.levels)
    held = [r["hash"] for r in runs.seen().collect()]
    assert sorted(held) == sorted(seen)
    assert len(runs.levels) == 3  # 7 batches of two runs to a level


def test_empty_table_and_names(spark):
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    with pytest.raises(ValueError):
        drop_repeated_lines(spark.createDataFrame([(1, "a", 1)], "doc_id bigint, text string, n_lines int"))
    with pytest.raises(ValueError):
        LineRuns(fan=1)


def test_query_equals_sql(spark, sf):
    from compare import connect, difference

    assert difference(QUERIES["op12_line_dedup"](spark, sf), connect(sf), ORACLES["op12_line_dedup"]) is None
