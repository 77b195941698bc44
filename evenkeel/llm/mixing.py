"""Mixing sources to target weights: token blocks drawn per output shard.

Each source's words, in a reproducible shuffled order of its documents, are one stream cut into
blocks of ``block_words``. The mix is a list of slots in shards, of which a source has as many as hold its target.
A shard's counts are multinomial draws under the condition that all shards together
meet these totals: the slots of all sources, side by side, are dealt out by one keyed permutation, so
that a shard is a draw without replacement from all of them and its counts spread as such draws do, while a source
gets its target whatever the size of the table. The permuted number of a slot tells both its source, by
the source's range of numbers, and which of the source's slots it is; slot k takes block ``permute(k mod n)`` of
the source's n blocks, by another keyed permutation of the indexes for each pass over the stream.
Slots and blocks are joined by index.

All is native column work. Texts are reduced to their sizes before anything moves. A source that
holds a third of all rows is cut into chunks for its prefix sums, and its blocks are as many keys.
Ranges of numbers are found by cells, as many rows as cells and sources together. Only the table of sources,
one row each and no more than ``MAX_SOURCES``, is ordered in one task.

Defined cases: a null source is a source, ordered last; a null text has size 0; documents without
words take no room, are in no block and have ``taken`` 0; repeated rows are documents each; long
documents span blocks; equal seeds give equal mixes; an empty table gives an empty result; columns other than
those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.llm.ordering import shuffled, sum_before
from evenkeel.llm.words import pieces, unit_draw, word_count
from evenkeel.session import materialize

ROUNDS = 3
SHORT_WALK, LONG_WALK = 6, 64
TASK_SLOTS, MAX_TASKS = 1 << 15, 10_000
MAX_SOURCES = 5_000_000
CELLS = 4096
FACTOR_BITS = 22  # index bits (40 at most) and these stay within a long


@dataclass(frozen=True)
class MixRule:
    weights: tuple[int, ...] = (1, 2, 3)
    max_repeats: int = 3
    block_words: int = 128
    shard_slots: int = 1 << 14
    seed: int = 17


def source_targets(sized: DataFrame, rule: MixRule) -> DataFrame:
    """Per source (``_key``): source_size, target.

    Weights repeat along the sources in order of code points, null last. A level of words per
    weight fills every source up to its limit; the limits reached before it are found by ordering
    the sources by the level at which they are reached.
    """
    sums = sized.groupBy("_key").agg(F.sum("size").alias("source_size"), F.first(F.col("source").isNull()).alias("_null"))
    sums = materialize(sums, "mix-sources")
    if (found := sums.count()) > MAX_SOURCES:
        raise ValueError(f"{found} sources are too many to be ordered in one task")
    place = F.row_number().over(Window.orderBy("_null", "_key")) - 1
    weights = F.array(*[F.lit(float(w)) for w in rule.weights])
    weighted = sums.select(
        "_key",
        "source_size",
        F.element_at(weights, (place % len(rule.weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(rule.max_repeats)).alias("limit"),
    ).withColumn("full_at", F.col("limit") / F.col("weight"))
    by_level = Window.orderBy("full_at", "_key").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    words_left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(by_level), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))
    level = (words_left / weight_left).alias("level")
    levels = weighted.select("*", level).withColumn("open", F.when(F.col("level") <= F.col("full_at"), F.col("level")))
    reached = F.coalesce(F.max("open").over(everything), F.col("full_at"))
    return levels.select("_key", "source_size", F.least(F.col("limit"), F.col("weight") * reached).alias("target"))


def sized_documents(docs: DataFrame, text: str, source: str, doc_id: str) -> DataFrame:
    """doc_id, source, size and a key for the source that is never null."""
    key = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), key.alias("_key"), word_count(pieces(F.col(text))).alias("size")
    )


def slot_ranges(targets: DataFrame, rule: MixRule) -> DataFrame:
    """Per source with slots: its number of blocks, and the numbers ``low`` to ``high`` (excluded) of its slots."""
    blocks = F.ceil(F.col("source_size") / rule.block_words).cast("long")
    wanted = F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")
    slots = F.least(wanted, F.col("blocks") * rule.max_repeats)  # as many blocks as hold the target
    counted = targets.where("source_size > 0").withColumn("blocks", blocks).withColumn("slots", slots).where("slots > 0")
    upto = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    ends = counted.select("_key", "blocks", "slots", F.sum("slots").over(upto).alias("high"))
    return ends.select("_key", "blocks", (F.col("high") - F.col("slots")).alias("low"), "high")


def permuted(slots: DataFrame) -> DataFrame:
    """``slots`` with ``block``: a bijection of ``index`` on [0, ``blocks``), keyed by ``rounds``.

    Each round adds a key, multiplies by an odd number and folds the upper half of the bits into
    the lower; that permutes the numbers of as many bits as ``blocks`` has. A number beyond
    ``blocks`` is permuted on until it falls within, which keeps the whole a bijection. More than
    half of all numbers fall within at every step, so few take the second, long walk.
    """
    bits = F.length(F.bin(F.col("blocks") - 1))
    sized = slots.withColumns(
        {
            "_mask": F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1,
            "_half": F.floor((bits + 1) / 2).cast("int"),
        }
    )
    mask, size = F.col("_mask"), F.col("blocks")

    def folded(y: Column) -> Column:
        return y.bitwiseXOR(F.call_function("shiftright", y, F.col("_half")))

    def once(x: Column) -> Column:
        return F.aggregate(
            "rounds", x, lambda v, r: folded((v.bitwiseXOR(r["key"].bitwiseAND(mask)) * r["factor"]).bitwiseAND(mask))
        )

    def walked(x: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), x, lambda v, _: F.when(v < size, v).otherwise(once(v)))

    near = sized.withColumn("_near", walked(once(F.col("index")), SHORT_WALK))
    far = near.withColumn("_far", F.when(F.col("_near") < size, F.col("_near")).otherwise(walked(F.col("_near"), LONG_WALK)))
    lost = F.raise_error(F.lit("a permuted index did not fall within its source")).cast("long")
    return far.withColumn("block", F.when(F.col("_far") < size, F.col("_far")).otherwise(lost)).drop("_mask", "_half", "_near", "_far")


def mix_slots(ranges: DataFrame, rule: MixRule, slots: int) -> DataFrame:
    """One row per slot: shard, place in the shard, the source's key, the pass over it and the index of its block."""
    tasks = max(1, min(-(-slots // TASK_SLOTS), MAX_TASKS))
    made = ranges.sparkSession.range(0, slots, 1, tasks).select(
        F.floor(F.col("id") / rule.shard_slots).cast("int").alias("shard"),
        (F.col("id") % rule.shard_slots).alias("place"),
        F.col("id").alias("index"),
        F.lit(slots).cast("long").alias("blocks"),
        F.lit("").alias("_key"),
        F.lit(-1).alias("pass"),
    )
    dealt = permuted(made.withColumn("rounds", rounds(rule))).select("shard", "place", F.col("block").alias("number"))
    width = max(1, -(-slots // CELLS))
    cells = F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell")
    within = (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    owned = dealt.withColumn("cell", F.floor(F.col("number") / width)).join(ranges.select("*", cells), "cell").where(within)
    slot = F.col("number") - F.col("low")
    numbered = owned.select(
        "_key",
        "blocks",
        "shard",
        "place",
        (slot % F.col("blocks")).alias("index"),
        F.floor(slot / F.col("blocks")).cast("int").alias("pass"),
    )
    return permuted(numbered.withColumn("rounds", rounds(rule))).select("_key", "shard", "place", "pass", "block")


def rounds(rule: MixRule) -> Column:
    """Keys and odd factors of the permutation of a source in one pass over it; of all slots with no source and pass -1."""
    low = F.lit((1 << FACTOR_BITS) - 1).cast("long")
    hashes = [F.xxhash64(F.lit(rule.seed), "_key", "pass", F.lit(r)) for r in range(2 * ROUNDS)]
    return F.array(
        *[
            F.struct(key.alias("key"), factor.bitwiseAND(low).bitwiseOR(F.lit(1).cast("long")).alias("factor"))
            for key, factor in zip(hashes[:ROUNDS], hashes[ROUNDS:])
        ]
    )


def placed_documents(sized: DataFrame, rule: MixRule) -> DataFrame:
    """The documents with words, each with its ``start`` in its source's stream."""
    ordered = shuffled(sized.where("size > 0"), [F.col("doc_id"), F.lit(rule.seed)], sized.count())
    return sum_before(ordered, "_key", "size", ["doc_id", "size"]).withColumnRenamed("_before", "start")


def document_spans(placed: DataFrame, rule: MixRule) -> DataFrame:
    """Which words of which document make up each block: _key, block, doc_id, start, from, to."""
    last = F.col("start") + F.col("size") - 1
    block = F.explode(F.sequence(F.floor(F.col("start") / rule.block_words), F.floor(last / rule.block_words))).alias("block")
    first = F.col("block") * rule.block_words
    return placed.select("_key", "doc_id", "size", "start", block).select(
        "_key",
        "block",
        "doc_id",
        "start",
        (F.greatest(F.col("start"), first) - F.col("start")).alias("from"),
        (F.least(F.col("start") + F.col("size"), first + rule.block_words) - F.col("start")).alias("to"),
    )


@dataclass(frozen=True)
class Mix:
    """Sizes of all documents, targets of all sources, and the mix as slots and spans of blocks."""

    sized: DataFrame
    targets: DataFrame
    placed: DataFrame
    slots: DataFrame
    spans: DataFrame

    def blocks(self) -> DataFrame:
        """The mix itself: shard, place, and the words [from, to) of each document there, in order of ``start``."""
        return self.slots.hint("merge").join(self.spans, ["_key", "block"]).select("shard", "place", "doc_id", "start", "from", "to")

    def taken(self) -> DataFrame:
        """Per document doc_id, size, source_size, target, and ``taken``: its words in the mix, repeats counted.

        Both joins are sort-merge joins by hint: their sides grow with the corpus, and rows that
        an array gives rise to are more than the planner expects.
        """
        times = self.slots.groupBy("_key", "block").agg(F.count(F.lit(1)).alias("times"))
        words = F.sum(F.col("times") * (F.col("to") - F.col("from"))).alias("taken")
        # A document is a run of its source's stream: its start tells it from every other.
        drawn = self.spans.join(times.hint("merge"), ["_key", "block"]).groupBy("_key", "start").agg(words)
        present = self.placed.join(drawn.hint("merge"), ["_key", "start"], "left").drop("start")
        absent = self.sized.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
        every = present.withColumn("taken", F.coalesce("taken", F.lit(0))).unionByName(absent)
        return every.join(self.targets, "_key").select("doc_id", "source", "size", "source_size", "target", "taken")


def mix_sources(
    docs: DataFrame, rule: MixRule = MixRule(), text: str = "text", source: str = "source", doc_id: str = "doc_id"
) -> Mix:
    sized = materialize(sized_documents(docs, text, source, doc_id), "mix-sizes")
    targets = materialize(source_targets(sized, rule), "mix-targets")
    placed = materialize(placed_documents(sized, rule), "mix-places")
    ranges = materialize(slot_ranges(targets, rule), "mix-ranges")
    slots = mix_slots(ranges, rule, ranges.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0])
    return Mix(sized, targets, placed, slots, document_spans(placed, rule))


def repeat_documents(
    docs: DataFrame, rule: MixRule = MixRule(), doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """Whole documents as often as the mix takes their words: ``docs`` with rows repeated or left out.

    A document of which the mix takes t words of n comes t div n times, and once more with the
    probability of the rest, drawn from its id. Documents without words leave.
    """
    taken = mix_sources(docs, rule, text, source, doc_id).taken().where("taken > 0")
    # Rows alike in id, source and size share what they were given.
    alike = taken.groupBy("doc_id", "source", "size").agg(
        (F.sum("taken") / F.count(F.lit(1)) / F.col("size")).alias("_share")
    )
    given = docs.withColumn("_given", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select(
        "_given", F.col(doc_id).alias("_own"), F.col(source).alias("_from"), word_count(pieces(F.col(text))).alias("_words")
    )
    right = alike.toDF("_doc_id", "_source", "_size", "_share")
    same = F.col("_own").eqNullSafe(F.col("_doc_id")) & F.col("_from").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size"))
    matched = given.join(right.hint("merge"), same)
    whole = F.floor(F.col("_share"))
    extra = unit_draw(F.lit(rule.seed), F.coalesce(F.col("_own").cast("string"), F.lit("-"))) < F.col("_share") - whole
    times = (whole + extra.cast("long")).cast("int")
    return matched.withColumn("_time", F.explode(F.array_repeat(F.lit(0), times))).select("_given.*")
