"""The manifest against a plain recursive tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.merkle import build_manifest, fold, hexed, leaf_digest, proof_digest
from evenkeel.llm.queries import ORACLES, QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(digests, fanout):
    """The root, and per leaf its (before, after) per level."""
    proofs, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for leaf, at in enumerate(places):
            run = at // fanout * fanout
            proofs[leaf].append(("".join(digests[run:at]), "".join(digests[at + 1 : run + fanout])))
        digests = [h(*digests[i : i + fanout]) for i in range(0, len(digests), fanout)]
        places = [at // fanout for at in places]
    return (digests[0] if digests else None), proofs


def plain_manifest(rows, fanout):
    leaves = [(source, doc_id, h(field(doc_id), field(source), field(text))) for doc_id, source, text in rows]
    low = lambda x: (x is not None, x if x is not None else 0)
    order = sorted({s for s, _, _ in leaves}, key=lambda s: (s is not None, (s or "").encode()))
    out, subroots = [], []
    for source in order:
        own = sorted((x for x in leaves if x[0] == source), key=lambda x: (low(x[1]), x[2]))
        subroot, proofs = plain_tree([x[2] for x in own], fanout)
        subroots.append(subroot)
        out.append((own, subroot, proofs))
    root, above = plain_tree(subroots, fanout)
    return sorted(
        (str(d), str(s), leaf, subroot, root, h(*[x for step in [*proof, *upper] for x in step]))
        for (own, subroot, proofs), upper in zip(out, above)
        for (s, d, leaf), proof in zip(own, proofs)
    )


def made_rows():
    rows = [(i, f"s{i % 5 if i % 3 else 0}", f"text {i}\n") for i in range(90)]
    rows += [(7, "s0", "other"), (7, "s0", "other"), (None, "s0", None), (None, None, ""), (3, None, "é漢"), (200, "Z", "x" * 100000)]
    return rows + [(300, "", "empty name"), (301, "é", None)]


@pytest.mark.parametrize("fanout", (2, 3, 5))
def test_equals_plain_tree(spark, fanout):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("digest", F.lit("x"))
    df = df.withColumn("pos", F.lit(1)).repartition(4)
    leaf = leaf_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    got = build_manifest(df, leaf, fanout=fanout, carry={"copy": leaf})
    found = got.select(
        "doc_id", "source", *[hexed(F.col(c)) for c in ("leaf", "subroot", "root")], hexed(proof_digest(F.col("steps"))),
        hexed(fold(F.col("copy"), F.col("steps"))),
    ).collect()
    want = plain_manifest(rows, fanout)
    assert sorted((str(r[0]), str(r[1]), *r[2:6]) for r in found) == want
    assert all(r[6] == r[4] for r in found)


def test_changed_leaf_does_not_fold_to_root(spark):
    df = spark.createDataFrame([(i, "a", "t") for i in range(10)], "doc_id bigint, source string, text string")
    got = build_manifest(df, leaf_digest(F.col("doc_id")))
    other = fold(leaf_digest(F.lit("other")), F.col("steps"))
    assert got.where(other == F.col("root")).count() == 0


@pytest.mark.parametrize("rows", ([], [(1, "a", "t")], [(None, None, None)]))
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = build_manifest(df, leaf_digest(F.col("doc_id"), F.col("source"), F.col("text"))).collect()
    assert len(got) == len(rows)
    assert all(r["leaf"] == r["subroot"] == r["root"] and r["steps"] == [] for r in got)


def test_names(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id bigint, source string")
    with pytest.raises(ValueError):
        build_manifest(df, leaf_digest(F.col("doc_id")), carry={"root": F.lit(1)})
    with pytest.raises(ValueError):
        build_manifest(df, leaf_digest(F.col("doc_id")), fanout=1)


def test_query_equals_sql(spark, sf):
    from compare import connect, difference

    assert difference(QUERIES["op11_merkle_manifest"](spark, sf), connect(sf), ORACLES["op11_merkle_manifest"]) is None
