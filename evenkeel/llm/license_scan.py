"""Licences of texts from their sentences: known sentences become identifiers, their runs match rules.

A text is cut into sentences, each normalised to its lower-case letters and digits with single
spaces between. Lines end sentences too, but a known sentence that stands over several lines, in
comment markers or with marks inside it, is one sentence: from left to right, the longest known sentence that
begins at a line and ends at a line. A sentence that is known gets its identifier; a rule is a licence with the
identifiers of its sentences in order. A rule matches where its identifiers follow each other among
the text's known sentences with no more than ``max_gap`` unknown ones between two. At a sentence
the longest rule wins, of equally long ones the one that is listed first, and a match takes its sentences from later ones.

All is native column work inside each row; nothing is shuffled. The known sentences are one regular
expression, a tree of their words, so a line is compared with all of them at once; sentences and rules are literals of the
plan. Every known sentence has one of a few telltale words, so texts without any are done at once.

Defined cases: a null or empty text has no sentence and no match; repeated rows are scanned each;
very long texts are read whole; other columns of the input pass through, and a clash with the names
of the results is an error; an empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.llm.license_rules import COMMON_LICENSES, LicenseRules

MATCHES = "array<struct<license:string,first:int,last:int>>"
KNOWN = "array<struct<at:int,id:int>>"
SENTENCE_END = r"[.!?;]+[ \t\r\n]+|[.!?;]+$|[\r\n]+"
NOT_WORDS = r"[^\p{L}\p{N}]+"
MARK = "\u0001"  # no letter or digit, so in no normalised line


def word_tree(sentences: list[str]) -> str:
    """A regular expression for sentences whose words stand on one line or several; the longest that fits is tried first."""
    tree: dict = {}
    for sentence in sentences:
        node = tree
        for word in sentence.split(" "):
            node = node.setdefault(word, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        more = [word + pattern(below) for word, below in sorted(node.items()) if word]
        if not more:
            return ""
        joined = more[0] if len(more) == 1 else f"(?:{'|'.join(more)})"
        return f"(?:[ \\n]{joined})?" if "" in node else f"[ \\n]{joined}"

    return f"(?:{'|'.join(word + pattern(below) for word, below in sorted(tree.items()))})"


def known_sentences(text: Column, rules: LicenseRules) -> Column:
    """The known sentences of a text in order: their place among all sentences and their identifier."""
    numbers = F.from_json(F.lit(json.dumps({s: i for i, s in rules.sentences})), "map<string,int>")
    lines = F.transform(F.split(F.lower(text), SENTENCE_END), lambda s: F.trim(F.regexp_replace(s, NOT_WORDS, " ")))
    joined = F.concat(F.lit("\n"), F.array_join(F.filter(lines, lambda s: s != ""), "\n"), F.lit("\n"))
    tree = word_tree([s for _, s in rules.sentences])
    marked = F.regexp_replace(joined, rf"(?<=\n){tree}(?=\n)", f"{MARK}$0{MARK}")
    # Known sentences alternate with what stands between them: whole lines.
    parts = F.split(marked, MARK)
    between = lambda part: F.size(F.filter(F.split(part, "\n"), lambda s: s != ""))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.array().cast(KNOWN).alias("kept"))

    def step(acc: Column, part: Column) -> Column:
        entry = F.struct(acc["at"].alias("at"), F.try_element_at(numbers, F.translate(part, "\n", " ")).alias("id"))
        is_known = acc["n"] % 2 == 1
        return F.struct(
            (acc["n"] + 1).alias("n"),
            (acc["at"] + F.when(is_known, 1).otherwise(between(part))).alias("at"),
            F.when(is_known, F.concat(acc["kept"], F.array(entry))).otherwise(acc["kept"]).alias("kept"),
        )

    return F.aggregate(parts, start, step, lambda acc: acc["kept"])


def rule_matches(known: str, rules: LicenseRules) -> Column:
    """Matches in the array column ``known``, leftmost first, the longest at each sentence, none overlapping."""
    by_first: list[list[dict]] = [[] for _ in rules.sentences]
    for license_name, ids in sorted(rules.rules, key=lambda r: -len(r[1])):
        by_first[ids[0]].append({"license": license_name, "ids": list(ids)})
    table = F.from_json(F.lit(json.dumps(by_first)), "array<array<struct<license:string,ids:array<int>>>>")

    def fits(rule: Column, k: Column) -> Column:
        def one(j: Column) -> Column:
            here, before = F.get(F.col(known), k + j), F.get(F.col(known), k + j - 1)
            near = (j == 0) | (here["at"] - before["at"] <= rules.max_gap + 1)
            return F.coalesce((here["id"] == F.get(rule["ids"], j)) & near, F.lit(False))

        return F.forall(F.sequence(F.lit(0), F.size(rule["ids"]) - 1), one)

    def at(entry: Column, k: Column) -> Column:
        rule = F.get(F.filter(F.get(table, entry["id"]), lambda r: fits(r, k)), F.lit(0))
        end = k + F.size(rule["ids"])
        match = F.struct(
            rule["license"].alias("license"),
            entry["at"].alias("first"),
            F.get(F.col(known), end - 1)["at"].alias("last"),
            k.alias("begin"),
            end.alias("end"),
        )
        return F.when(rule.isNotNull(), match)

    every = F.filter(F.transform(known, at), lambda m: m.isNotNull())
    start = F.struct(F.lit(0).alias("free"), F.array().cast(MATCHES).alias("kept"))
    plain = lambda m: F.struct(m["license"].alias("license"), m["first"].alias("first"), m["last"].alias("last"))
    return F.aggregate(
        every,
        start,
        lambda acc, m: F.when(
            m["begin"] >= acc["free"],
            F.struct(m["end"].alias("free"), F.concat(acc["kept"], F.array(plain(m))).alias("kept")),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )


def scan_licenses(docs: DataFrame, rules: LicenseRules = COMMON_LICENSES, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``matches``: licence, first and last sentence of each match."""
    others = [c for c in docs.columns if c != text]
    clash = {"matches", "_known"} & set(others)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    telling = F.coalesce(F.lower(F.col(text)).rlike("|".join(rules.telltales)), F.lit(False))
    none = F.array().cast(KNOWN)
    known = docs.select(*others, F.when(telling, known_sentences(F.col(text), rules)).otherwise(none).alias("_known"))
    some = F.size("_known") > 0
    return known.select(*others, F.when(some, rule_matches("_known", rules)).otherwise(F.array().cast(MATCHES)).alias("matches"))
