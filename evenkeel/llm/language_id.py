"""Language of texts by interpolated Kneser-Ney models over the letters of words, one per language.

A text is its letters in lower case; everything else only ends words. The symbols of a word are
its letters and one end, each seen behind up to three letters of the same word or its beginning.
Each language's model interpolates absolute discounting over four orders; below the longest order
an n-gram counts the different letters before it, save where its context holds a word's beginning,
which nothing precedes.

Every n-gram counts, at every size. Tasks count packed n-grams (four folded letters of 16 bits
each), Spark sums them per language, and the lower orders, the counts of counts that give the
discounts, the sums per context and the probabilities are joins and aggregates over those tables,
which hold an n-gram for the languages that have it. From them each n-gram of the texts to be judged gets its code length in
every language. The most common of these n-grams, as many as fit ``TABLE_BYTES``, are sent to all
executors as one sorted array of hashes beside their code lengths, so one search serves all
languages; texts with other n-grams get their code lengths by a join. Where the cut lies changes no
result. With 200 languages the array holds 20,000 n-grams, with four 800,000.

The language with the lowest cross-entropy per symbol wins. Whether that entropy is one that texts
of the language have is judged against its spread as a function of length over all training texts
that are recognised; a text is rejected beyond the distance that only ``FALSE_REJECTS`` of these
texts reach, and never within ``LEAST_LIMIT`` deviations, as few texts say little about so rare ones. Of 10,000
documents in four languages the farthest is 10.3 deviations away; texts in six other languages are 30 to 106, 200
of random letters 26 to 73.

Defined cases: a null text or one without a letter is ``und`` with score 0 and rejected; without
training texts so is every text; ties go to the language that sorts first; repeated rows are
learnt and judged each; texts of any length are read whole, in runs; extra columns pass through,
and a clash with the names of the results or of the columns used on the way is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.llm.textbytes import RUN_BYTES, Run, Tally, find, runs
from evenkeel.session import materialize

ORDER = 4
UNKNOWN = "und"
MAX_LANGUAGES = 1000
FALSE_REJECTS = 1e-4  # share of recognised training texts
LEAST_LIMIT = 14.0  # standard deviations above a language's usual cross-entropy
TABLE_BYTES = 32 << 20
EVIDENCE = 100  # symbols at most that the confidence rests on


@lru_cache(maxsize=1)
def folded_letters() -> np.ndarray:
    """By code point: 0 if it isn't a letter, else its lower case folded to 16 bits."""
    table = np.zeros(0x110001, np.uint16)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            point = ord(low) if len(low) == 1 else c
            table[c] = (point ^ (point >> 16) * 0x9E37) & 0xFFFF or 1
    return table


def symbols(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of the run's letters and word ends, the newest symbol lowest, and their piece."""
    region = run.region
    leads = np.append(0, np.cumsum((region & 0xC0) != 0x80))
    points = np.frombuffer(region.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    ends = leads[run.ends - run.starts[0]]
    if points.size != leads[-1]:  # bytes that aren't UTF-8: piece by piece
        parts = [run.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(run.starts, run.ends)]
        points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(p) for p in parts])
    letters = np.insert(folded_letters()[points], ends, 0)
    piece = np.repeat(np.arange(ends.size), np.diff(np.append(0, ends)) + 1)
    keep = letters != 0
    keep[1:] |= letters[:-1] != 0
    letters, piece = letters[keep].astype(np.uint64), piece[keep]
    keys, inside = letters.copy(), np.ones(letters.size, bool)
    for back in range(1, ORDER):
        before = np.zeros_like(letters)
        before[back:] = letters[:-back]
        before[~inside] = 0
        inside &= before != 0
        keys |= before << np.uint64(16 * back)
    return keys, piece


def count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of packed n-grams per language of the training rows; other rows have none."""
    tallies: dict[str | None, Tally] = {}

    def table(language: str | None, counted) -> Iterator[pa.RecordBatch]:
        keys, counts = counted or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for at in range(0, keys.size, 1 << 16):
            part = keys[at : at + (1 << 16)]
            arrays = [pa.array([language] * part.size, pa.string()), pa.array(part.view(np.int64)), pa.array(counts[at : at + (1 << 16)])]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "key", "n"])

    for batch in batches:
        languages = np.array([*batch.column("lang").to_pylist(), None], object)[:-1]
        for run in runs(batch.column("text")):
            keys, piece = symbols(run)
            of_piece = languages[run.rows]
            for language in dict.fromkeys(of_piece):
                tally = tallies.setdefault(language, Tally(1 << 19))
                own = np.array([x == language for x in of_piece])
                yield from table(language, tally.add(keys[own[piece]]))
    for language, tally in tallies.items():
        yield from table(language, tally.take())


def suffix(key: str, order: int) -> Column:
    """The newest ``order`` symbols of a packed n-gram."""
    return F.col(key).bitwiseAND(F.lit((1 << (16 * order)) - 1)) if order < ORDER else F.col(key)


def context(key: str) -> Column:
    return F.shiftrightunsigned(key, 16)


def gram_table(counts: DataFrame) -> DataFrame:
    """(order, lang, key, own) from (lang, key, n) of the longest order; ``own`` is what Kneser-Ney counts of an n-gram."""
    level = counts.select("lang", "key", F.col("n").cast("double").alias("own"), F.col("n").alias("sums"))
    tables = [level.select(F.lit(ORDER).alias("order"), "lang", "key", "own")]
    for order in range(ORDER - 1, 0, -1):
        level = level.select("lang", suffix("key", order).alias("key"), "sums").groupBy("lang", "key")
        level = level.agg(F.count("*").alias("types"), F.sum("sums").alias("sums"))
        starts_word = (F.shiftrightunsigned("key", 16 * (order - 1)) == 0) & F.lit(order > 1)
        level = level.withColumn("own", F.when(starts_word, F.col("sums")).otherwise(F.col("types")).cast("double"))
        tables.append(level.select(F.lit(order).alias("order"), "lang", "key", "own"))
    return reduce(DataFrame.unionByName, tables)


def discounts(grams: DataFrame) -> DataFrame:
    """(order, lang, d): n1 / (n1 + 2 n2) from the counts of counts, within 0.1 and 0.9; 0.75 where one of them is zero."""
    once, twice = F.count_if(F.col("own") == 1), F.count_if(F.col("own") == 2)
    estimate = F.least(F.greatest(F.try_divide(F.col("once"), F.col("once") + 2 * F.col("twice")), F.lit(0.1)), F.lit(0.9))
    counted = grams.groupBy("order", "lang").agg(once.alias("once"), twice.alias("twice"))
    known = (F.col("once") > 0) & (F.col("twice") > 0)
    return counted.select("order", "lang", F.when(known, estimate).otherwise(F.lit(0.75)).alias("d"))


def shares_and_weights(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per n-gram the discounted shares, per context the weights of the next lower order, each as (lang, value) of
    the languages that hold it: (order, key, shares) and (order, context, weights)."""
    cut = F.broadcast(discounts(grams))  # a row per order and language
    placed = grams.withColumn("context", context("key")).join(cut, ["order", "lang"])
    totals = placed.groupBy("order", "lang", "context").agg(
        F.sum("own").alias("total"), (F.first("d") * F.count("*") / F.sum("own")).alias("weight")
    )
    share = (F.greatest(F.col("own") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("share")
    shares = placed.join(totals, ["order", "lang", "context"]).select("order", "key", "lang", share)
    listed = lambda value, name: F.map_from_entries(F.collect_list(F.struct("lang", value))).alias(name)
    return (
        shares.groupBy("order", "key").agg(listed("share", "shares")),
        totals.groupBy("order", "context").agg(listed("weight", "weights")),
    )


def code_lengths(used: DataFrame, counts: DataFrame, languages: int) -> DataFrame:
    """``used`` (key, n) with ``bits``, the code length of an n-gram's newest symbol per language.

    ``counts`` holds (lang, key, n) of the training texts, languages numbered from 0.
    """
    grams = materialize(gram_table(counts), "language-grams")
    alphabet = grams.where("order = 1").select("key").distinct().count()
    shares, weights = (materialize(t, "language-model") for t in shares_and_weights(grams))
    below = None
    for order in range(1, ORDER + 1):
        keys = used if order == ORDER else used.select(suffix("key", order).alias("key")).distinct()
        level = keys.withColumn("context", context("key")).withColumn("lower", suffix("key", order - 1))
        level = level.join(shares.where(F.col("order") == order).drop("order"), "key", "left")
        level = level.join(weights.where(F.col("order") == order).drop("order"), "context", "left")
        if below is None:
            level = level.withColumn("below", F.array_repeat(F.lit(1.0 / (alphabet + 1)), languages))
        else:
            level = level.join(below, "lower")
        p = F.transform(
            F.sequence(F.lit(0), F.lit(languages - 1)),
            lambda j: F.coalesce(F.try_element_at("shares", j), F.lit(0.0))
            + F.coalesce(F.try_element_at("weights", j), F.lit(1.0)) * F.get("below", j),
        )
        level = level.withColumn("p", p)
        below = level.select(F.col("key").alias("lower"), F.col("p").alias("below"))
    return level.select("key", "n", F.transform("p", lambda x: -F.log2(x)).alias("bits"))


def score_batches(
    batches: Iterable[pa.RecordBatch], keys: np.ndarray, bits: np.ndarray, keep_text: bool
) -> Iterator[pa.RecordBatch]:
    """Each row's code length per language over the n-grams of ``keys``, and the number of its symbols."""
    languages = bits.shape[1]
    size = min(max(1 << 14, RUN_BYTES // max(languages, 1)), RUN_BYTES)
    for batch in batches:
        n = batch.num_rows
        sums, counts = np.zeros((n, languages)), np.zeros(n, np.int64)
        for run in runs(batch.column("text"), size):
            found, piece = symbols(run)
            counts[run.rows] += np.bincount(piece, minlength=run.rows.size)
            at = find(keys, found)
            hit = at >= 0
            at, piece = at[hit], piece[hit]
            if at.size:
                some, heads = np.unique(piece, return_index=True)
                sums[run.rows[some]] += np.add.reduceat(bits[at], heads, axis=0)
        kept = [c for c in batch.schema.names if keep_text or c != "text"]
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * languages)
        columns = [pa.ListArray.from_arrays(offsets, pa.array(sums.ravel())), pa.array(counts)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + columns, [*kept, "_bits", "_symbols"])


def rare_batches(batches: Iterable[pa.RecordBatch], keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(digest, key, n): how often each row has the n-grams that aren't in ``keys``."""
    for batch in batches:
        tallies: dict[int, list[np.ndarray]] = {}
        for run in runs(batch.column("text")):
            found, piece = symbols(run)
            rare = find(keys, found) < 0
            found, piece = found[rare], piece[rare]
            for k in np.unique(piece):
                tallies.setdefault(int(run.rows[k]), []).append(found[piece == k])
        for row, parts in tallies.items():
            rare, n = np.unique(np.concatenate(parts), return_counts=True)
            digest = pa.array([batch.column("digest")[row].as_py()] * rare.size, pa.string())
            yield pa.RecordBatch.from_arrays([digest, pa.array(rare.view(np.int64)), pa.array(n)], ["digest", "key", "n"])


def least_count(lengths: DataFrame, capacity: int) -> int:
    """The count from which on no more than ``capacity`` n-grams are as common. A row per different count is ordered."""
    counted = lengths.groupBy("n").agg(F.count("*").alias("keys"))
    as_common = F.sum("keys").over(Window.orderBy(F.desc("n")))
    fits = counted.withColumn("as_common", as_common).where(F.col("as_common") <= capacity)
    found = fits.agg(F.min("n")).first()[0]
    return (1 << 62) if found is None else found


class Models:
    """The code lengths of all n-grams of a table of texts: the common ones as arrays, the others as a table."""

    def __init__(self, docs: DataFrame, text: str, language: Column, capacity: int | None) -> None:
        pairs = docs.select(language.alias("lang"), F.col(text).alias("text"))
        counted = pairs.mapInArrow(count_batches, "lang string, key bigint, n bigint")
        counts = materialize(counted.groupBy("lang", "key").agg(F.sum("n").alias("n")), "language-counts")
        learnt = counts.where("lang IS NOT NULL")
        found = learnt.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages are too many for one broadcast")
        self.languages, self.text, self.others = sorted(r["lang"] for r in found), text, None
        self.keys, bits = np.zeros(0, np.uint64), np.zeros((0, len(self.languages)))
        if self.languages:
            numbers = docs.sparkSession.createDataFrame(list(enumerate(self.languages)), "id int, lang string")
            learnt = learnt.join(F.broadcast(numbers), "lang").select(F.col("id").alias("lang"), "key", "n")
            used = counts.groupBy("key").agg(F.sum("n").alias("n"))
            lengths = materialize(code_lengths(used, learnt, len(self.languages)), "language-bits")
            capacity = capacity or max(1, TABLE_BYTES // (8 + 8 * len(self.languages)))
            often = F.col("n") >= F.lit(least_count(lengths, capacity))
            common = lengths.where(often).select("key", "bits").toArrow()  # no more than ``capacity`` rows
            keys = common.column("key").to_numpy().view(np.uint64)
            order = np.argsort(keys)
            lists = common.column("bits").combine_chunks()
            bits = lists.flatten().to_numpy(zero_copy_only=False).reshape(keys.size, len(self.languages))[order]
            self.keys = keys[order]
            others = lengths.where(~often).select("key", "bits")
            if not others.isEmpty():
                self.others = self._rare_sums(docs, others)
        self.shared = docs.sparkSession.sparkContext.broadcast((self.keys, bits))

    def _rare_sums(self, docs: DataFrame, others: DataFrame) -> DataFrame:
        """(digest, rare): per different text the code lengths of its other n-grams."""
        shared = docs.sparkSession.sparkContext.broadcast(self.keys)
        texts = docs.select(F.md5(self.text).alias("digest"), F.col(self.text).alias("text"))
        rare = texts.mapInArrow(lambda batches: rare_batches(batches, shared.value), "digest string, key bigint, n bigint")
        once = rare.groupBy("digest", "key").agg(F.max("n").alias("n"))  # equal texts have equal counts
        sums = [F.sum(F.col("n") * F.get("bits", F.lit(j))) for j in range(len(self.languages))]
        found = once.join(others, "key").groupBy("digest").agg(F.array(*sums).alias("_rare"))
        return materialize(found.withColumnRenamed("digest", "_digest"), "language-rare")

    def judge(self, docs: DataFrame, keep_text: bool) -> DataFrame:
        """``docs`` (its text named so) with lang_pred, _entropy, _symbols and _confidence."""
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if keep_text or f.name != "text"]
        names, shared = [f.name for f in docs.schema.fields if keep_text or f.name != "text"], self.shared
        if self.others is not None:
            docs = docs.withColumn("_digest", F.md5("text"))
            fields.append("_digest string")
        schema = ", ".join([*fields, "_bits array<double>, _symbols bigint"])
        scored = docs.mapInArrow(lambda batches: score_batches(batches, *shared.value, keep_text), schema)
        if self.others is not None:
            scored = scored.join(self.others, "_digest", "left")
            both = F.zip_with("_bits", "_rare", lambda x, y: x + y)
            scored = scored.withColumn("_bits", F.when(F.col("_rare").isNull(), F.col("_bits")).otherwise(both))
        each = F.transform("_bits", lambda b: b / F.greatest(F.col("_symbols"), F.lit(1)))
        weight = float(np.log(2)) * F.least(F.col("_symbols"), F.lit(EVIDENCE))
        known = (F.col("_symbols") > 0) & F.lit(bool(self.languages))
        best = F.get(F.array(*[F.lit(x) for x in self.languages]), F.array_position("_each", F.col("_entropy")).cast("int") - 1)
        odds = F.aggregate("_each", F.lit(0.0), lambda total, e: total + F.exp(-weight * (e - F.col("_entropy"))))
        scored = scored.withColumn("_each", each).withColumn("_entropy", F.array_min("_each"))
        return scored.select(
            *names,
            F.when(known, best).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
            "_entropy",
            "_symbols",
            F.when(known, 1.0 / odds).otherwise(F.lit(0.0)).alias("_confidence"),
        )


def usual_entropies(judged: DataFrame, truth: str) -> dict[str, tuple[float, float, float]]:
    """Per language the mean cross-entropy and its variance as a + b / symbols, by least squares."""
    e, w = F.col("_entropy"), 1.0 / F.col("_symbols")
    right = judged.where((F.col("lang_pred") == F.col(truth)) & (F.col("_symbols") > 0))
    sums = {"n": F.lit(1.0), "e": e, "ee": e * e, "w": w, "ww": w * w, "ew": e * w, "eew": e * e * w}
    out = {}
    for r in right.groupBy("lang_pred").agg(*[F.sum(x).alias(k) for k, x in sums.items()]).collect():
        mean = r["e"] / r["n"]
        squares = r["ee"] - 2 * mean * r["e"] + mean * mean * r["n"]
        squares_w = r["eew"] - 2 * mean * r["ew"] + mean * mean * r["w"]
        spread = r["n"] * r["ww"] - r["w"] ** 2
        slope = (r["n"] * squares_w - r["w"] * squares) / spread if spread > 1e-9 * r["n"] * r["ww"] else 0.0
        out[r["lang_pred"]] = (mean, max((squares - slope * r["w"]) / r["n"], 0.01), max(slope, 2.0))
    return out


def surprise(usual: dict[str, tuple[float, float, float]]) -> Column:
    """By how many deviations a text's cross-entropy is above its language's usual one."""
    out = F.lit(0.0)
    for name, (mean, fixed, per_symbol) in usual.items():
        z = (F.col("_entropy") - mean) / F.sqrt(F.lit(fixed) + F.lit(per_symbol) / F.col("_symbols"))
        out = F.when(F.col("lang_pred") == name, z).otherwise(out)
    return out


def identify(
    docs: DataFrame,
    training: Column,
    text: str = "text",
    language: str = "lang",
    capacity: int | None = None,
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected; without the text unless ``keep_text``.

    ``training`` says which rows with a language are learnt from; null counts as no. ``capacity`` is
    the number of n-grams that are sent to executors, by default as many as fit ``TABLE_BYTES``.
    Executors need this package (``shipping.ship_package`` sends it).
    """
    own = {"lang_pred", "score", "rejected", "_bits", "_symbols", "_entropy", "_confidence", "_surprise", "_digest", "_rare", "_each", "_learnt"}
    clash = (own | {"text"}) & (set(docs.columns) - {text})
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    learnt = F.when(F.coalesce(training, F.lit(False)), F.col(language))
    models = Models(docs, text, learnt, capacity)
    marked = docs.withColumn("_learnt", learnt).withColumnRenamed(text, "text")
    judged = materialize(models.judge(marked, False), "language-judged")
    usual = usual_entropies(judged.where("_learnt IS NOT NULL"), "_learnt")
    recognised = judged.where(F.col("_learnt") == F.col("lang_pred")).select(surprise(usual).alias("z"))
    reached = recognised.agg(F.percentile_approx("z", 1.0 - FALSE_REJECTS, 100_000)).first()[0]
    limit = max(LEAST_LIMIT, reached or 0.0)
    found = models.judge(marked, True) if keep_text else judged
    z, confidence = F.col("_surprise"), F.col("_confidence")
    found = found.withColumn("_surprise", surprise(usual))
    found = found.withColumn("score", confidence / (1 + F.exp(F.least(z - limit, F.lit(500.0)))))
    found = found.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (z > limit))
    others = [c for c in docs.columns if c != text]
    return found.select(*others, *([F.col("text").alias(text)] if keep_text else []), "lang_pred", "score", "rejected")
