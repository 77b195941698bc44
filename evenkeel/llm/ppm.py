"""Scores of texts by prediction by partial matching, trained on a corpus.

The model is a trie of byte contexts, held order by order in tables of packed n-grams. A
symbol's probability comes from the longest context in which it was seen; each longer context
adds an escape (method C: as many escapes as the context has different symbols), and symbols of
the context that was escaped from are excluded below it. Below the order without context all
symbols left are equally likely. Because a symbol seen behind a context is seen behind its
suffix, what exclusion leaves of a context depends on the escaped context alone. A symbol's score
hence depends on its n-gram of the longest order alone, and each n-gram is scored once.

Counting covers every text, and every counted n-gram stays in the model: each task counts packed
n-grams of the longest order, in training texts and in all, Spark sums them, and shorter orders are
sums of longer ones. Spark then scores the n-grams order by order; a context has at most 257
symbols and an n-gram at most 257 longer ones, so no group is large. Only the scores of common
n-grams are sent to the tasks: those that hold at least one in ``NGRAMS * capacity`` of the symbols
to score, so there are at most that many. All others are joined to their scores in Spark; which
way a score comes makes no difference to it.

Beside it stands a word model: log10 of (c + 1) / (N + V + 1) over the words and one end of each
text. Words that hold at least one in ``capacity`` of all tokens are few by the same argument and
are counted in the scoring pass; the tokens of all others are joined to the counts in Spark.

Defined cases: a null text is an empty one and has its end only; without training texts every
symbol has probability 1/257 and every word count is 0; repeated rows are scored and counted each;
a text of any length is read whole, in runs; extra columns of the input pass through, and a clash
with the names of the results is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.llm.textbytes import LOWER, Run, Tally, find, runs, word_hashes, word_spans
from evenkeel.session import materialize

ORDER = 4
SYMBOLS = 257
PAD, END = 0xFF, 0xFE  # neither occurs in UTF-8
NGRAM, WORD = 0, 1
NGRAMS = 4  # common n-grams are so many times ``capacity`` at most


def framed(run: Run, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of every symbol of the run, ends included, and the piece of each.

    The newest byte is the lowest; ``order`` bytes before it follow, padding before a text's start.
    """
    sizes = run.ends - run.starts
    ended = run.last.astype(np.int64)
    framed_at = np.append(0, np.cumsum(sizes + order + ended))
    sequence = np.full(framed_at[-1], PAD, np.uint8)
    target = np.repeat(framed_at[:-1] + order - run.bounds, sizes)
    sequence[target + np.arange(target.size)] = LOWER[run.region]
    sequence[framed_at[1:][run.last] - 1] = END
    for i in np.flatnonzero(~run.first):
        before = LOWER[run.data[max(run.starts[i] - order, 0) : run.starts[i]]]
        sequence[framed_at[i] + order - before.size : framed_at[i] + order] = before
    keys = sequence.astype(np.uint64)
    for back in range(1, order + 1):
        keys[back:] |= sequence[:-back].astype(np.uint64) << np.uint64(8 * back)
    scored = np.ones(sequence.size, bool)
    for lead in range(order):
        scored[framed_at[:-1] + lead] = False
    return keys[scored], np.repeat(np.arange(sizes.size), sizes + ended)


def count_batches(batches: Iterable[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Counts of this task's n-grams and words: ``n`` in training texts, ``used`` in all."""

    def table(kind: int, counted, learnt: bool = True) -> Iterator[pa.RecordBatch]:
        keys, counts = counted or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for at in range(0, keys.size, 1 << 16):
            part = keys[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(part.size, kind, np.int32)),
                    pa.array(part.view(np.int64)),
                    pa.array(counts[at : at + (1 << 16)].astype(np.int64) * learnt),
                    pa.array(counts[at : at + (1 << 16)].astype(np.int64)),
                ],
                ["kind", "key", "n", "used"],
            )

    ngrams, others, words = Tally(), Tally(), Tally()
    for batch in batches:
        train = batch.column("train").to_numpy(zero_copy_only=False)
        for run in runs(batch.column("text")):
            learnt = train[run.rows]
            keys, piece = framed(run, order)
            yield from table(NGRAM, ngrams.add(keys[learnt[piece]]))
            yield from table(NGRAM, others.add(keys[~learnt[piece]]), False)
            region = LOWER[run.region]
            starts, ends, piece = word_spans(run)
            yield from table(WORD, words.add(word_hashes(region, starts, ends)[learnt[piece]]))
    yield from table(NGRAM, ngrams.take())
    yield from table(NGRAM, others.take(), False)
    yield from table(WORD, words.take())


def masked(key: Column, symbols: int) -> Column:
    """The newest ``symbols`` bytes of a packed n-gram."""
    return key if symbols >= 8 else key.bitwiseAND(F.lit((1 << (8 * symbols)) - 1).cast("long"))


def scored_ngrams(ngrams: DataFrame, order: int) -> DataFrame:
    """key, used and fresh: log10 of the probability of each n-gram's newest symbol behind the others.

    ``ngrams`` has every n-gram of the longest order once, with its count ``n`` in training texts, which
    may be 0. Order by order upwards, ``escaped`` is the score below a known context in which the symbol
    was not seen, the escapes into lower orders and the exclusion of that context's symbols included.
    """
    levels = [ngrams]
    for m in range(order - 1, -1, -1):
        shorter = levels[0].groupBy(masked(F.col("key"), m + 1).alias("key")).agg(F.sum("n").alias("n"))
        levels.insert(0, materialize(shorter, f"ppm-order-{m}"))

    seen = F.col("n") > 0
    in_context = Window.partitionBy(F.shiftrightunsigned("key", 8))

    def with_context(level: DataFrame, *more: Column) -> DataFrame:
        return level.select(
            "*",
            F.sum("n").over(in_context).alias("total"),
            F.sum(seen.cast("long")).over(in_context).alias("kinds"),
            *more,
        )

    def with_scores(level: DataFrame, escaped: Column, unknown: Column) -> DataFrame:
        whole = F.log10(F.col("total") + F.col("kinds"))
        fresh = (
            F.when(seen, F.log10("n") - whole)
            .when(F.col("total") > 0, F.log10("kinds") - whole + F.col("escaped"))
            .otherwise(unknown)
        )
        return level.withColumn("escaped", escaped).withColumn("fresh", fresh)

    unseen = -F.log10(F.greatest(F.lit(SYMBOLS) - F.col("kinds"), F.lit(1)))
    scored = with_scores(with_context(levels[0]), unseen, unseen)
    for m in range(1, order + 1):
        names = ("n", "total", "kinds", "escaped", "fresh")
        below = scored.select(F.col("key").alias("below"), *[F.col(c).alias(f"{c}_below") for c in names])
        joined = levels[m].withColumn("below", masked(F.col("key"), m)).join(below, "below")
        excluded = F.sum(F.when(seen, F.col("n_below")).otherwise(0)).over(in_context).alias("excluded")
        rest_kinds = F.col("kinds_below") - F.col("kinds")
        left = F.col("total_below") - F.col("excluded") + rest_kinds
        # Where nothing is left of the shorter context, it takes no escape.
        escaped = F.when(F.col("n_below") > 0, F.log10("n_below") - F.log10(left)).otherwise(
            F.when(left > 0, F.log10(rest_kinds) - F.log10(left)).otherwise(0.0) + F.col("escaped_below")
        )
        level = with_scores(with_context(joined, excluded), escaped, F.col("fresh_below"))
        if m < order:
            scored = materialize(level.select("key", *names), f"ppm-scored-{m}")
    return materialize(level.select("key", "used", "fresh"), "ppm-scored")


SCORED = (
    ("row", pa.int64()),
    ("n_words", pa.int64()),
    ("known_words", pa.int64()),
    ("log_counts", pa.float64()),
    ("score", pa.float64()),
    ("rare", pa.list_(pa.int64())),
    ("rare_ngrams", pa.list_(pa.int64())),
)


def listed(hashes: list[np.ndarray], rows: list[np.ndarray], n: int) -> pa.ListArray:
    """For each of ``n`` rows the list of its hashes; rows ascend."""
    values = np.concatenate(hashes).view(np.int64) if hashes else np.zeros(0, np.int64)
    of = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    offsets = np.append(0, np.cumsum(np.bincount(of, minlength=n)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def score_batches(
    batches: Iterable[pa.RecordBatch],
    ngrams: np.ndarray,
    ngram_logs: np.ndarray,
    order: int,
    common: np.ndarray,
    common_logs: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Each row's score and words over common n-grams and words; ``rare`` and ``rare_ngrams`` list the others."""
    task, done = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
    for batch in batches:
        n = batch.num_rows
        score, logs = np.zeros(n), np.zeros(n)
        words, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rare_hashes, rare_rows, rare_keys, rare_key_rows = [], [], [], []
        for run in runs(batch.column("text")):
            keys, piece = framed(run, order)
            at = find(ngrams, keys)
            hit = at >= 0
            score[run.rows] += np.bincount(piece[hit], ngram_logs[at[hit]], run.rows.size)
            rare_keys.append(keys[~hit])
            rare_key_rows.append(run.rows[piece[~hit]])
            starts, ends, piece = word_spans(run)
            hashes = word_hashes(LOWER[run.region], starts, ends)
            at = find(common, hashes)
            hit = at >= 0
            words[run.rows] += np.bincount(piece, minlength=run.rows.size)
            known[run.rows] += np.bincount(piece[hit], minlength=run.rows.size)
            logs[run.rows] += np.bincount(piece[hit], common_logs[at[hit]], run.rows.size)
            rare_hashes.append(hashes[~hit])
            rare_rows.append(run.rows[piece[~hit]])
        columns = [
            pa.array((task << 40) + done + np.arange(n)),
            pa.array(words),
            pa.array(known),
            pa.array(logs),
            pa.array(score),
            listed(rare_hashes, rare_rows, n),
            listed(rare_keys, rare_key_rows, n),
        ]
        done += n
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + columns, kept + [name for name, _ in SCORED])


def score_texts(docs: DataFrame, training: Column, text: str = "text", order: int = ORDER, capacity: int = 1 << 19) -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens, base_score and score.

    ``training`` says which rows are learnt from; null counts as no.
    """
    names = {"n_tokens", "n_known", "train_tokens", "base_score", "score", "text", *(n for n, _ in SCORED)}
    clash = names & (set(docs.columns) - {text})
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    if not 1 <= order <= 7:
        raise ValueError("order must be 1 to 7: n-grams are packed in 64 bits")
    raw = docs.select(F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    counted = raw.mapInArrow(lambda batches: count_batches(batches, order), "kind int, key bigint, n bigint, used bigint")
    summed = counted.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("used").alias("used"))
    counts = materialize(summed, "ppm-counts")
    ngrams = counts.where(F.col("kind") == NGRAM).select("key", "n", "used")
    vocabulary = counts.where(F.col("kind") == WORD)

    totals = (F.sum("n").alias("n"), F.sum("used").alias("used"), F.count("*").alias("v"))
    sizes = {r["kind"]: r for r in counts.groupBy("kind").agg(*totals).collect()}
    symbols = sizes[NGRAM]["used"] if NGRAM in sizes else 0
    texts = (
        ngrams.where(F.col("key").bitwiseAND(F.lit(0xFF)) == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    )  # each training text has one end
    words, kinds = (sizes[WORD]["n"], sizes[WORD]["v"]) if WORD in sizes else (0, 0)
    train_tokens, vocabulary_size = words + texts, kinds + int(texts > 0)

    scored = scored_ngrams(ngrams, order)
    often = F.col("used") >= F.lit(symbols / (NGRAMS * capacity))
    common = scored.where(often).select("key", "fresh").toArrow()  # at most ``NGRAMS * capacity`` rows
    grams, gram_logs = common.column("key").to_numpy().view(np.uint64), common.column("fresh").to_numpy()
    by_key = np.argsort(grams)
    grams, gram_logs = grams[by_key], gram_logs[by_key]

    is_common = F.col("n") >= F.lit(words / capacity)
    common = vocabulary.where(is_common).select("key", "n").toArrow()  # at most ``capacity`` rows
    hashes, logs = common.column("key").to_numpy().view(np.uint64), np.log10(common.column("n").to_numpy() + 1.0)
    by_hash = np.argsort(hashes)
    hashes, logs = hashes[by_hash], logs[by_hash]
    shared = docs.sparkSession.sparkContext.broadcast((grams, gram_logs, hashes, logs))

    others = [c for c in docs.columns if c != text]
    kept_schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text]
    schema = ", ".join(
        [*kept_schema, "row bigint, n_words bigint, known_words bigint, log_counts double, score double"]
        + ["rare array<bigint>, rare_ngrams array<bigint>"]
    )

    def scored_batches(batches):
        ngram_keys, ngram_values, keys, values = shared.value
        return score_batches(batches, ngram_keys, ngram_values, order, keys, values)

    rows = materialize(docs.select(*others, F.col(text).alias("text")).mapInArrow(scored_batches, schema), "ppm-scores")
    rare = rows.select("row", F.explode("rare").alias("key"))
    found = (
        rare.join(vocabulary.where(~is_common).select("key", "n"), "key")
        .groupBy("row")
        .agg(F.sum(F.log10(F.col("n") + 1.0)).alias("_rare_logs"), F.count(F.lit(1)).alias("_rare_known"))
    )
    # Every n-gram of a text was counted, so each finds its score.
    rare_ngrams = rows.select("row", F.explode("rare_ngrams").alias("key"))
    rest = (
        rare_ngrams.join(scored.where(~often).select("key", "fresh"), "key")
        .groupBy("row")
        .agg(F.sum("fresh").alias("_rare_score"))
    )
    ends = float(np.log10(texts + 1.0))
    return (
        rows.drop("rare", "rare_ngrams")
        .join(found, "row", "left")
        .join(rest, "row", "left")
        .select(
            *others,
            (F.col("n_words") + 1).alias("n_tokens"),
            (F.col("known_words") + F.coalesce("_rare_known", F.lit(0)) + int(texts > 0)).cast("long").alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            (
                F.col("log_counts")
                + F.coalesce("_rare_logs", F.lit(0.0))
                + F.lit(ends)
                - (F.col("n_words") + 1) * F.lit(float(np.log10(train_tokens + vocabulary_size + 1.0)))
            ).alias("base_score"),
            (F.col("score") + F.coalesce("_rare_score", F.lit(0.0))).alias("score"),
        )
    )
