"""Kneser-Ney models against a plain version, accuracy on held-out texts, and odd inputs."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.language_id import Models, code_lengths, discounts, folded_letters, gram_table, identify
from evenkeel.llm.queries import QUERIES

WORDS = {"aa": ["abra", "cad", "abba", "dab", "abra"], "bb": ["bob", "cob", "boc", "ézé"]}


def grams(word, n=4):
    s = [0] * (n - 1) + [ord(c) for c in word] + [0]
    return [tuple(s[i - n + 1 : i + 1]) for i in range(n - 1, len(s))]


def packed(gram):
    return sum(c << (16 * i) for i, c in enumerate(reversed(gram)))


class Plain:
    """Recursive interpolated Kneser-Ney over dictionaries."""

    def __init__(self, words, alphabet):
        self.alphabet = alphabet
        raw = Counter(g for w in words for g in grams(w))
        self.counts = {4: raw}
        self.known = {}
        for m in (3, 2, 1):
            sums, left = Counter(), defaultdict(set)
            for g, n in raw.items():
                sums[g[1:]] += n
                left[g[1:]].add(g[0])
            self.counts[m] = {g: sums[g] if m > 1 and g[0] == 0 else len(left[g]) for g in sums}
            raw = sums

        self.follow = {m: defaultdict(dict) for m in self.counts}
        for m, table in self.counts.items():
            for g, n in table.items():
                self.follow[m][g[:-1]][g] = n
        self.d = {m: plain_discount(list(table.values())) for m, table in self.counts.items()}

    def p(self, gram):
        m = len(gram)
        if m == 0:
            return 1 / (self.alphabet + 1)
        own = self.follow[m].get(gram[:-1])
        if not own:
            return self.p(gram[1:])
        d = self.d[m]
        return max(own.get(gram, 0) - d, 0) / sum(own.values()) + d * len(own) / sum(own.values()) * self.p(gram[1:])

    def bits(self, gram):
        if gram not in self.known:
            self.known[gram] = -math.log2(self.p(gram))
        return self.known[gram]


def plain_discount(counts):
    once, twice = sum(n == 1 for n in counts), sum(n == 2 for n in counts)
    return min(max(once / (once + 2 * twice), 0.1), 0.9) if once and twice else 0.75


def plain_models(words):
    alphabet = {c for own in words.values() for w in own for c in w} | {0}
    return {name: Plain(own, len(alphabet)) for name, own in words.items()}, alphabet


def test_code_lengths_equal_plain_version(spark):
    rows = [(j, packed(g), n) for j, name in enumerate(sorted(WORDS)) for g, n in Counter(x for w in WORDS[name] for x in grams(w)).items()]
    counts = spark.createDataFrame(rows, "lang int, key bigint, n bigint")
    tests = list(dict.fromkeys(g for w in ("abra", "bobcad", "zeta", "abc", "ézé", "dda") for g in grams(w)))
    used = spark.createDataFrame([(packed(g), 1) for g in tests], "key bigint, n bigint")
    got = {r["key"]: r["bits"] for r in code_lengths(used, counts, 2).collect()}
    models, alphabet = plain_models(WORDS)
    for j, name in enumerate(sorted(WORDS)):
        for g in tests:
            assert got[packed(g)][j] == pytest.approx(-math.log2(models[name].p(g)), rel=1e-9)
        # From any context the probabilities of all symbols, seen or not, make one.
        for context in ((0, 0, 0), (0, ord("a"), ord("b")), (ord("z"),) * 3):
            assert sum(models[name].p((*context, c)) for c in (0, *(ord(a) for a in alphabet if a), 999)) == pytest.approx(1)


def words_of(text):
    table = folded_letters()
    return [w for w in "".join(chr(table[ord(c)]) if table[ord(c)] else " " for c in text or "").split(" ") if w]


def test_judged_texts_equal_plain_version(spark, sf):
    """All n-grams of the table's texts count, however few are sent to executors."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    train = lambda i: i % 4 != 2
    words = defaultdict(list)
    for r in rows:
        if train(r["doc_id"]):
            words[r["lang"]] += words_of(r["text"])
    models, _ = plain_models(words)
    assert all(plain_discount(list(m.counts[4].values())) not in (0.75, 0.1, 0.9) for m in models.values())
    learnt = F.when(F.col("doc_id") % 4 != 2, F.col("lang"))
    ready = docs.repartition(3)
    got = {r["doc_id"]: r for r in Models(ready, "text", learnt, None).judge(ready, False).collect()}
    few = {r["doc_id"]: r for r in Models(ready, "text", learnt, 2).judge(ready, False).collect()}
    assert len(got) == len(few) == len(rows)
    for r in rows:
        one, other = got[r["doc_id"]], few[r["doc_id"]]
        assert (one["lang_pred"], one["_symbols"]) == (other["lang_pred"], other["_symbols"])
        assert one["_entropy"] == pytest.approx(other["_entropy"], rel=1e-9)
    for name in models:
        for r in sorted((r for r in rows if r["lang"] == name and r["text"]), key=lambda r: len(r["text"]))[:12]:
            gs = [g for w in words_of(r["text"]) for g in grams(w)]
            if not gs:
                continue
            each = {k: sum(m.bits(g) for g in gs) / len(gs) for k, m in models.items()}
            best = min(sorted(each), key=each.get)
            assert got[r["doc_id"]]["lang_pred"] == best
            assert got[r["doc_id"]]["_entropy"] == pytest.approx(each[best], rel=1e-9)


def test_discounts_come_from_the_counts_of_counts(spark):
    rows = [(0, 10 + i, 1) for i in range(5)] + [(0, 20 + i, 2) for i in range(3)] + [(1, 5, 1)]
    grams_4 = gram_table(spark.createDataFrame(rows, "lang int, key bigint, n bigint"))
    got = {r["lang"]: r["d"] for r in discounts(grams_4).where("order = 4").collect()}
    assert got[0] == pytest.approx(5 / 11) and got[1] == 0.75


def test_cases(spark):
    rows = [(1, "der und die und das", "de", True), (2, "the and of the and", "en", True), (3, None, "en", True), (4, "12 %% !", "de", True)]
    rows += [(5, "", None, False), (6, "the of", None, False), (7, "und die", "en", False), (7, "und die", "en", False), (8, "x", "zz", None)]
    rows += [(9, "the and " * 200_000, "qq", False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, train boolean").withColumn("source", F.lit(1))
    out = identify(df, F.col("train"), keep_text=True).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in out}
    assert {k: v[0] for k, v in got.items() if k != 8} == {1: "de", 2: "en", 3: "und", 4: "und", 5: "und", 6: "en", 7: "de", 9: "en"}
    assert all(got[k][1] for k in (3, 4, 5)) and got[8][0] in ("de", "en")
    assert len(out) == len(rows) and {r["text"] for r in out} == {r[1] for r in rows}
    assert all(0 <= r["score"] <= 1 and (r["score"] == 0) == (r["lang_pred"] == "und") for r in out)
    assert {r["lang_pred"] for r in identify(df, F.lit(False)).collect()} == {"und"}
    assert identify(df.limit(0), F.col("train")).count() == 0


def test_foreign_letters_are_rejected(spark):
    rows = [(i, " ".join(["the", "and", "of", "with", "that"][(i * k) % 5] for k in range(1, 60)), "en", True) for i in range(40)]
    rows += [(100, "qzxj wvkq " * 50, None, False), (101, "слово дело тело " * 30, None, False), (102, "that with the and", None, False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, train boolean")
    got = {r["doc_id"]: r["rejected"] for r in identify(df, F.col("train")).collect()}
    assert got[100] and got[101] and not got[102] and not any(got[i] for i in range(40))


@pytest.mark.parametrize("name", ("lang_pred", "_entropy", "_symbols", "_learnt"))
def test_clashing_names(spark, name):
    df = spark.createDataFrame([("a", "en", 1)], f"text string, lang string, {name} int")
    with pytest.raises(ValueError):
        identify(df, F.lit(True))


def test_query_is_right_on_held_out_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = QUERIES["op5_language_id"](spark, sf).where("held_out").join(docs, "doc_id").where("n > 40")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right > 0.98
