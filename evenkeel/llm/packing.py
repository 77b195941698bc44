"""Packing by length: buckets with the least padding, and batches of a token budget inside each.

A text is measured in words. One longer than the longest bucket is cut into pieces of that length
and a rest, so nothing is truncated. The histogram of piece lengths over all rows, at most
``max_length`` numbers, decides the bucket bounds by dynamic programming: among all ways to cut the
lengths into ``buckets`` ranges, each padded to its longest, the one with the least padding in all.
A bucket of bound b puts ``token_budget`` div b pieces in a batch. Pieces are numbered along a
reproducible shuffled order within their bucket, by sums over chunks, so a bucket that holds most
rows is spread over tasks; only the last batch of a bucket may be unfilled.

Defined cases: a null text has no words; a document without words is one piece of length 0, in no
bucket and no batch; repeated rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from evenkeel.llm.ordering import shuffled, sum_before
from evenkeel.llm.words import pieces, word_count
from evenkeel.session import materialize


@dataclass(frozen=True)
class PackRule:
    max_length: int = 2048
    buckets: int = 12
    token_budget: int = 16_384
    seed: int = 29


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The upper bounds of at most ``buckets`` ranges that pad the least; ``lengths`` ascend."""
    n = len(lengths)
    if not n:
        return []
    rows = np.append(0, np.cumsum(counts)).astype(float)
    words = np.append(0, np.cumsum(counts * lengths)).astype(float)
    # padding[i, j]: of a bucket that starts behind the i shortest lengths and ends with the j-th.
    padding = lengths[None, :] * (rows[None, 1:] - rows[:-1, None]) - (words[None, 1:] - words[:-1, None])
    padding[np.tril_indices(n, -1)] = np.inf
    best, cuts = padding[0], []
    for _ in range(min(buckets, n) - 1):
        # One bucket more: what precedes it ends with the i shortest lengths.
        options = np.append(np.inf, best[:-1])[:, None] + padding
        cut = options.argmin(axis=0)
        better = options[cut, np.arange(n)]
        cuts.append(np.where(better < best, cut, -1))
        best = np.minimum(better, best)
    bounds, end = [], n - 1
    for cut in reversed(cuts):
        if cut[end] > 0:
            bounds.append(int(lengths[end]))
            end = int(cut[end]) - 1
    return [*reversed(bounds)] if end < 0 else [int(lengths[end]), *reversed(bounds)]


def text_pieces(docs: DataFrame, rule: PackRule, text: str = "text") -> DataFrame:
    """doc_id, piece, start and length in words."""
    sized = docs.select("doc_id", word_count(pieces(F.col(text))).alias("words"))
    last = F.greatest(F.floor((F.col("words") - 1) / rule.max_length), F.lit(0))
    cut = sized.select("doc_id", "words", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * rule.max_length
    length = F.least(F.col("words") - start, F.lit(rule.max_length).cast("long"))
    return cut.select("doc_id", "piece", start.alias("start"), length.alias("length"))


def pack(docs: DataFrame, rule: PackRule = PackRule(), text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, bucket (its bound), batch (its number in the bucket), place in the batch, padding."""
    cut = materialize(text_pieces(docs, rule, text), "pack-pieces")
    histogram = cut.groupBy("length").count().collect()  # at most max_length + 1 rows
    total = sum(r["count"] for r in histogram)
    filled = sorted((r["length"], r["count"]) for r in histogram if r["length"] > 0)
    bounds = best_bounds(np.array([x for x, _ in filled]), np.array([n for _, n in filled]), rule.buckets)
    bucket = F.lit(None).cast("long")
    for bound in reversed(bounds):
        bucket = F.when(F.col("length") <= bound, F.lit(bound).cast("long")).otherwise(bucket)
    bucketed = cut.withColumn("bucket", F.when(F.col("length") > 0, bucket)).withColumn("_one", F.lit(1).cast("long"))
    ordered = shuffled(bucketed.where("bucket IS NOT NULL"), [F.col("doc_id"), F.col("piece"), F.lit(rule.seed)], total)
    numbered = sum_before(ordered, "bucket", "_one", ["doc_id", "piece", "length"])
    capacity = F.greatest(F.floor(F.lit(rule.token_budget) / F.col("bucket")), F.lit(1))
    columns = ("doc_id", "piece", "start", "length", "bucket")
    packed = numbered.select(
        *columns,
        F.floor(F.col("_before") / capacity).alias("batch"),
        (F.col("_before") % capacity).alias("place"),
        (F.col("bucket") - F.col("length")).alias("padding"),
    )
    nowhere = [F.lit(None).cast("long").alias(c) for c in ("batch", "place", "padding")]
    return packed.unionByName(bucketed.where("bucket IS NULL").select(*columns, *nowhere))
