"""Quality rules per document, and verdicts on hosts from the documents' failures.

A document fails by itself if it is short or mostly repeats itself. The failures are counted per
host; each host's failure rate is shrunk towards the corpus rate by a beta prior whose strength
is estimated from the hosts themselves, and a host whose shrunk rate is too high takes its
remaining documents down with it.

Everything is native column work. Texts are never shuffled: the measures of a document are a few
numbers, written once, and what crosses the network is those and one row per host and task. The verdicts of
hosts are joined back by a plain equi-join, so the planner broadcasts them only after it has
measured them and splits a host that holds a large share of the rows.

Defined cases: a null text has no words, hence fails; a null host has no verdict of its own and
its documents stand or fall by themselves; repeated rows count as often as they occur; an empty
table gives an empty result; other columns of the input pass through, and a clash with the names
of the results or of the columns used on the way is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from evenkeel.session import materialize
from evenkeel.llm.words import pieces, word_count, word_list

SYMBOLS = "[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class HostRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.7


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
HELPERS = ("_pieces", "_lines", "_words", "_hashes", "_windows", "_starts", "_host")
VERDICTS = ("base_failed", "host_failed", "kept")


def refuse_names(docs: DataFrame, names: tuple[str, ...], text: str) -> None:
    clash = set(names) & (set(docs.columns) - {text})
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")


def document_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated windows are found by sorting a 64-bit hash of each three-word window with its
    place inside the row, so the work per text is n log n and no row leaves its task.
    """
    refuse_names(docs, MEASURES + HELPERS, text)
    raw = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(raw, "\n"), lambda x: x.rlike(HAS_WORD))
    others = [c for c in docs.columns if c != text]
    cut = docs.select(
        *others,
        pieces(F.col(text)).alias("_pieces"),
        lines.alias("_lines"),
        (F.length(raw) - F.length(F.regexp_replace(raw, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    listed = cut.select(
        *others,
        "n_symbols",
        word_count(F.col("_pieces")).alias("n_words"),
        word_list(F.col("_pieces")).alias("_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    # The last two entries lack words behind them and are cut off.
    hashes = F.transform(
        "_words",
        lambda word, i: F.xxhash64(word, F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)),
    )
    hashed = listed.select(
        *others,
        "n_symbols",
        "n_words",
        "n_dup_lines",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.slice(hashes, 1, F.greatest(F.col("n_words") - 2, F.lit(0)).cast("int")).alias("_hashes"),
    )
    # Most texts repeat no window: they are done once their hashes are seen to be distinct.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    sorted_windows = hashed.select(
        *others,
        "n_symbols",
        "n_words",
        "n_dup_lines",
        "word_chars",
        F.when(repeats, F.sort_array(placed)).otherwise(F.array().cast("array<struct<h:bigint,at:int>>")).alias("_windows"),
    )

    def same_as(step: int, k: Column, h: Column) -> Column:
        return F.coalesce(F.get(F.col("_windows"), k + step)["h"] == h, F.lit(False))

    repeated = F.filter("_windows", lambda w, k: same_as(-1, k, w["h"]) | same_as(1, k, w["h"]))
    starts = sorted_windows.select(
        *others,
        "n_symbols",
        "n_words",
        "n_dup_lines",
        "word_chars",
        F.sort_array(F.transform(repeated, lambda w: w["at"])).alias("_starts"),
    )
    gained = F.transform("_starts", lambda p, k: F.coalesce(F.least(F.get(F.col("_starts"), k + 1) - p, F.lit(3)), F.lit(3)))
    covered = F.aggregate(gained, F.lit(0).cast("long"), lambda a, x: a + x)
    return starts.select(*others, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))


def prior(whole: Row) -> tuple[float, float]:
    """The failure rate of all rows, and the hosts' intraclass correlation by the method of moments."""
    rows, p = whole["rows"], whole["failures"] / whole["rows"]
    if not 0 < p < 1:
        return p, 0.0
    excess = (whole["explained"] - rows * p * p) / (p * (1 - p)) - (whole["hosts"] - 1)
    room = rows - whole["squares"] / rows - (whole["hosts"] - 1)
    return p, min(max(excess / room, 0.0), 1.0) if room > 0 else 0.0


def host_verdicts(judged: DataFrame, host: str, rules: HostRules = HostRules()) -> DataFrame:
    """One row per host: rows, failures, the shrunk failure rate, and whether the host fails.

    With p the failure rate of all rows, the spread of the hosts' rates beyond sampling noise
    gives an intraclass correlation rho; (1 - rho) / rho is the number of rows the beta prior is
    worth. Without spread every host gets p.
    """
    counts = (
        judged.where(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count(F.lit(1)).alias("host_rows"), F.sum(F.col("base_failed").cast("long")).alias("host_failures"))
    )
    n, f = F.col("host_rows").cast("double"), F.col("host_failures").cast("double")
    whole = counts.agg(
        F.sum(n).alias("rows"),
        F.sum(f).alias("failures"),
        F.sum(n * n).alias("squares"),
        F.sum(f * f / n).alias("explained"),
        F.count(F.lit(1)).alias("hosts"),
    ).first()  # five numbers, whatever the number of hosts
    p, rho = prior(whole) if whole["hosts"] else (0.0, 0.0)
    shrunk = (rho * f + p * (1 - rho)) / (rho * n + (1 - rho))
    return counts.withColumn("host_rate", shrunk).withColumn("host_failed", F.col("host_rate") > rules.max_host_rate)


def judge_documents(docs: DataFrame, host: str = "source", rules: HostRules = HostRules(), text: str = "text") -> DataFrame:
    """The columns of ``docs`` but its text, the measures, ``base_failed``, ``host_failed`` and ``kept``."""
    refuse_names(docs, MEASURES + HELPERS + VERDICTS, text)
    short = F.col("n_words") < rules.min_words
    looping = 100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    judged = materialize(document_measures(docs, text).withColumn("base_failed", short | looping), "quality-rules")
    verdicts = host_verdicts(judged, host, rules).select(F.col(host).alias("_host"), "host_failed")
    return (
        judged.join(verdicts, F.col(host) == F.col("_host"), "left")
        .drop("_host")
        .withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
        .withColumn("kept", ~(F.col("base_failed") | F.col("host_failed")))
    )
