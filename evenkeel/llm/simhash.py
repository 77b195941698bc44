"""Near-duplicate texts by SimHash, with candidates pruned by the pigeonring principle.

A fingerprint has 64 bits over hashed three-word shingles. Fingerprints link at ``DISTANCE`` or
fewer differing bits. Lay the eight bytes of two fingerprints on a ring: if all differ in at most
3 bits, some byte starts a chain in which the first l bytes differ in at most floor(3 l / 8) bits
for every l. So the first two bytes agree and the next three differ in at most one bit; of those
24 bits one half of twelve agrees. That gives sixteen keys of 28 agreeing bits per fingerprint
(eight starts, two halves), and no linked pair shares none of them. Pairs that share a key go
through the rest of the chain's budgets before their full distance is counted.

Equal texts, and texts with equal fingerprints, are one fingerprint before any pair is looked at.
Keys held by one fingerprint are dropped. Fingerprints of a key are compared in arrays inside a
task, and what leaves the task is a spanning forest of their links, never all pairs. A key with
more fingerprints than ``BLOCK`` is dealt out over pairs of blocks. Components of the forest are
found in Spark by rounds of pointing every fingerprint to the smallest it is linked with; each
round is written to the shared folder.

Defined cases: a null or wordless text has fingerprint zero and links like any other; a null
doc_id counts for nothing in the smallest id of a component (null if there is no other); repeated
rows get the same component; very long texts are read whole, in blocks of shingles; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from evenkeel.session import materialize

SEED, SHINGLE, BITS, DISTANCE = 42, 3, 64, 3
STARTS, BLOCK = 8, 4096
LOWERCASE = bytes(b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256))
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str | None) -> bytes:
    """Eight bytes, the highest first."""
    words = (text or "").encode().translate(LOWERCASE).split()  # bytes split at space and 0x09 to 0x0D
    if not words:
        return bytes(8)
    n = max(len(words) - SHINGLE + 1, 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = words[at : min(at + SHINGLES_AT_ONCE, n) + SHINGLE - 1]
        shingles = map(b" ".join, zip(part, part[1:], part[2:])) if len(part) >= SHINGLE else [b" ".join(part)]
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    raw = b"".join([fingerprint(t) for t in texts])
    return pd.Series(np.frombuffer(raw, ">u8").astype(np.uint64).view(np.int64))


def hexed(fingerprint_column: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint_column), 16, "0"))


def ring_keys(fp: str) -> Column:
    """The sixteen keys: start and half in the lowest bits, then 28 bits that must agree."""
    keys = []
    for start in range(STARTS):
        turn = 8 * start
        # The ring turned left, so that the chain's first byte is the highest.
        turned = F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn)) if turn else F.col(fp)
        pair = F.shiftrightunsigned(turned, 48)
        for half in range(2):
            twelve = F.shiftrightunsigned(turned, 36 - 12 * half).bitwiseAND(F.lit(0xFFF))
            keys.append(F.shiftleft(pair, 16).bitwiseOR(F.shiftleft(twelve, 4)).bitwiseOR(F.lit(2 * start + half)))
    return F.array(*keys)


def linked(x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which pairs keep within the budget of every length of the chain from ``start``, hence link."""
    turn = start.astype(np.uint64) * np.uint64(8)
    differ = x ^ y
    differ = np.where(turn > 0, (differ << turn) | (differ >> (np.uint64(64) - np.maximum(turn, np.uint64(1)))), differ)
    alive = np.arange(x.size)
    for length in range(3, STARTS + 1):
        head = differ[alive] >> np.uint64(64 - 8 * length)
        alive = alive[np.bitwise_count(head) <= DISTANCE * length // STARTS]
    out = np.zeros(x.size, bool)
    out[alive] = True
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the links ``a``-``b`` reach."""
    root = np.arange(n)
    while a.size:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root = shorter
    return root


def compare_groups(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group; a link to the root of each fingerprint's part of its group goes out.

    Only the group that may go on in the next batch is held back.
    """
    names = ["key", "block", "fp"]

    def links(held: list[np.ndarray]) -> pa.RecordBatch:
        key, block, fp = held
        values = fp.view(np.uint64)
        heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (block[1:] != block[:-1]))) if key.size else np.zeros(0, int)
        sizes = np.diff(np.append(heads, key.size))
        room = np.repeat(heads + sizes, sizes) - np.arange(key.size) - 1  # members behind each in its group
        start = (key & 15) // 2
        root, base, step = np.arange(key.size), np.flatnonzero(room > 0), 1
        found_a, found_b, pending = [], [], 0
        while base.size:
            hit = base[linked(values[base], values[base + step], start[base])]
            found_a.append(hit)
            found_b.append(hit + step)
            pending += hit.size
            step += 1
            base = base[room[base] >= step]
            if pending > 1 << 20 or not base.size:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                joined = np.flatnonzero(root != np.arange(key.size))
                root = forest(key.size, np.concatenate([a, joined]), np.concatenate([b, root[joined]]))
                found_a, found_b, pending = [], [], 0
        tied = np.flatnonzero(root != np.arange(key.size))
        return pa.RecordBatch.from_arrays([pa.array(fp[tied]), pa.array(fp[root[tied]])], ["a", "b"])

    rest = [np.zeros(0, np.int64)] * 3
    for frame in frames:
        columns = [np.concatenate([r, frame.column(c).to_numpy()]) for r, c in zip(rest, names)]
        key, block, _ = columns
        last = (key != key[-1]) | (block != block[-1]) if key.size else np.zeros(0, bool)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            yield links([c[:cut] for c in columns])
        rest = [c[cut:] for c in columns]
    yield links(rest)


def near_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are those of all links."""
    keyed = fps.select("fp", F.explode(ring_keys("fp")).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    # Each fingerprint meets every block of its key once: the pair of blocks is the group.
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (
        keyed.join(shared, "key")
        .withColumn("blocks", n_blocks)
        .withColumn("mine", mine)
        .select("key", "fp", "mine", "blocks", met)
        .select(
            "key", "fp", (F.least("mine", "other").cast("long") * F.col("blocks") + F.greatest("mine", "other")).alias("block")
        )
    )
    grouped = dealt.repartition("key", "block").sortWithinPartitions("key", "block", "fp")
    found = grouped.select("key", "block", "fp").mapInArrow(compare_groups, "a bigint, b bigint")
    return found.distinct()


def smallest_reachable(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of the links the smallest node that it reaches.

    Each round links every node's greater neighbours, then its smaller ones, to the smallest of
    them; a hub's links shrink at every round, and sums over groups are combined before they move.
    """
    edges = materialize(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u != v").distinct(), "links")
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        edges = materialize(small.select("e.u", "e.v").where("u != v").distinct(), "links")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, ``fp`` (64 bits), ``component`` (a fingerprint, one per component), ``component_id``."""
    marked = materialize(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), "simhash")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    roots = smallest_reachable(near_links(classes.select("fp")))
    linked_classes = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("component")
    )
    ids = linked_classes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    members = linked_classes.select("fp", "component").join(ids, "component")
    return marked.join(members, "fp").select("doc_id", "fp", "component", "component_id")


def keep_one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, unchanged: that of its smallest id (null last).

    Rows alike in id and fingerprint are one row's repeats; which of them stays is free.
    """
    found = materialize(near_duplicates(docs, doc_id, text), "simhash-found")
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("best"))
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    chosen = materialize(
        best.join(ids, F.col("best.doc_id").eqNullSafe(F.col("doc_id"))).select(
            F.col("best.doc_id").alias("_id"), F.col("best.fp").alias("_fp"), ((F.col("rows") == 1) & ~F.col("best.none")).alias("alone")
        ),
        "simhash-chosen",
    )
    # An id that one row has tells that row; only the texts of other ids are looked at again.
    single = docs.join(chosen.where("alone").select("_id"), F.col(doc_id) == F.col("_id"), "left_semi")
    shared = docs.join(chosen.where("NOT alone").select("_id", "_fp"), F.col(doc_id).eqNullSafe(F.col("_id")))
    repeated = shared.where(fingerprints(F.col(text)) == F.col("_fp")).dropDuplicates(["_id", "_fp"])
    return single.unionByName(repeated.select(*docs.columns))
