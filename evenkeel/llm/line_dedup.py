"""Line deduplication against levelled sorted runs of line hashes.

``LineRuns`` remembers which lines were seen. It is a list of levels; a level holds runs, tables of
line hashes sorted within their files, and no hash is in two runs. A new batch of hashes is
merge-anti-joined with the runs, and what is left becomes a run of its own on the lowest level. When
a level has ``fan`` runs, they are compacted into one run of the next level, so there are never more
than ``fan`` - 1 runs to a level and every hash is rewritten once per level.

``drop_repeated_lines`` drops a line where it stands in ``least_documents`` documents or more, but
for the document with the largest number. Its batches are ranges of document numbers from the
largest down, so the batch that brings a hash first knows the largest number; the batches' own
counts add up to the number of documents.

A line's key is the line without spaces and control characters 0x09 to 0x0D at its ends, A-Z in
lower case. Keys are hashed to 128 bits. Only hashes and numbers are counted and joined; texts are
shuffled once, to meet the hashes of the lines they lose. Hashes found in more than one in ``HEAVY``
of all (hash, document) pairs, hence fewer than ``HEAVY``, are broadcast; any other is joined.

Defined cases: a null or empty text is one empty line; texts are split whole; rows of equal number,
and those without a number, are one document, whose lines stay in all of its rows; documents
without a number come after all others, so they keep a line only if no numbered one holds it; an
empty table gives an empty result; other columns pass through, and a clash with the names of the
results is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.session import materialize, scratch_path

BLANKS = " \t\n\x0b\x0c\r"
BATCHES = 4
FAN = 3
HEAVY = 1 << 16
PIECE = 1 << 16
RESULTS = ("n_lines", "n_dropped", "kept_text")


def line_key(line: str) -> bytes:
    """The key in UTF-8; lower-casing bytes changes A-Z alone."""
    return line.strip(BLANKS).encode().lower()


def key_hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def long_enough(key: bytes, least_chars: int) -> bool:
    """Whether the key has so many code points; bytes are decoded only where their number leaves it open."""
    return len(key) >= least_chars and (len(key) >= 4 * least_chars or len(key.decode()) >= least_chars)


def text_hashes(text: str, least_chars: int) -> set[bytes]:
    """Hashes of the different long keys of a text."""
    keys = {line_key(line) for line in text.split("\n")}
    return {key_hash(k) for k in keys if long_enough(k, least_chars)}


def hash_batches(batches: Iterable[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    """(hash, number, version) per different long line of each row, passed on about ``PIECE`` at a time."""
    for batch in batches:
        hashes, rows = [], []
        for row, text in enumerate(batch.column("text")):
            found = text_hashes(text.as_py() or "", least_chars)
            hashes.extend(found)
            rows.extend([row] * len(found))
            if len(hashes) >= PIECE:
                yield from pair_batch(batch, hashes, rows)
                hashes, rows = [], []
        yield from pair_batch(batch, hashes, rows)


def pair_batch(batch: pa.RecordBatch, hashes: list[bytes], rows: list[int]) -> Iterator[pa.RecordBatch]:
    if hashes:
        of = batch.select(["number", "version"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), *of.columns], ["hash", "number", "version"])


class LineRuns:
    """Hashes seen so far with what came with them, as sorted runs on levels."""

    def __init__(self, fan: int = FAN) -> None:
        if fan < 2:
            raise ValueError("a level needs room for two runs at least")
        self.fan = fan
        self.levels: list[list[DataFrame]] = []

    def seen(self) -> DataFrame | None:
        """All runs as one table, in which no hash is twice; None before the first batch."""
        runs = [run for level in self.levels for run in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def add(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch``, one per hash, whose hash is in no run; they become a run."""
        seen = self.seen()
        fresh = batch if seen is None else batch.join(seen.select("hash").hint("merge"), "hash", "left_anti")
        run = self.sorted_run(fresh, 0)
        self.put(run, 0)
        return run

    def sorted_run(self, rows: DataFrame, level: int) -> DataFrame:
        return materialize(rows.repartition("hash").sortWithinPartitions("hash"), f"line-run-{level}")

    def put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self.put(self.sorted_run(merged, level + 1), level + 1)


def number_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Document numbers that cut the rows into about equal ranges, ascending."""
    shares = [k / batches for k in range(1, batches)]
    found = docs.agg(F.percentile_approx("number", shares, 10_000)).first()[0] if shares else None
    return sorted(set(found or []))


def frequent_lines(pairs: DataFrame, bounds: list[int], least_documents: int, fan: int = FAN) -> DataFrame:
    """hash, n documents and ``keeper``, the largest of their numbers, where ``n`` is large enough.

    ``pairs`` holds (hash, number, version, batch), batch 0 with the largest numbers; pairs may be repeated.
    """
    runs, sightings = LineRuns(fan), []
    for batch in range(len(bounds) + 1):
        # Copies of a document's row first, then a count that a hash's rows are summed for where they are.
        once = pairs.where(F.col("batch") == batch).groupBy("hash", "number").agg(F.lit(1).alias("one"))
        own = once.groupBy("hash").agg(F.count("*").alias("n"), F.max("number").alias("keeper"))
        own = materialize(own, f"line-batch-{batch}")
        runs.add(own.select("hash", "keeper"))
        sightings.append(own.select("hash", "n"))
    total = reduce(DataFrame.unionByName, sightings).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least_documents)
    return total.join(runs.seen(), "hash")


def lost_pairs(pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """The pairs whose document loses the line. Fewer than ``HEAVY`` hashes are in more than a ``HEAVY``-th of all pairs."""
    n_pairs = pairs.count()
    heavy = F.col("n") * F.lit(HEAVY) > F.lit(n_pairs)
    lost = ~F.col("number").eqNullSafe(F.col("keeper"))
    common = F.broadcast(frequent.where(heavy).select("hash", "keeper"))
    others = frequent.where(~heavy).select("hash", "keeper")
    rare = pairs.join(common.select("hash"), "hash", "left_anti").join(others, "hash")
    return pairs.join(common, "hash").unionByName(rare).where(lost).select("number", "version", "hash")


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    number: str = "doc_id",
    least_chars: int = 20,
    least_documents: int = 3,
    batches: int = BATCHES,
    fan: int = FAN,
) -> DataFrame:
    """``docs`` without its text, with n_lines (before dropping), n_dropped and ``kept_text``."""
    own = {*RESULTS, "_number", "_version", "_text", "_lost", "_cut", "number_", "version_"}
    clash = own & (set(docs.columns) - {text})
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    if batches < 1 or least_documents < 2 or least_chars < 1:
        raise ValueError("a batch, two documents and a code point are the least")
    others = [c for c in docs.columns if c != text]
    # Rows of one number share their verdicts; the version only keeps the lists of hashes as short as a text.
    identity = F.col(number).cast("long").alias("_number"), F.xxhash64(text).alias("_version")
    keyed = docs.select(*others, *identity, F.col(text).alias("_text"))
    lines = keyed.select(*[F.col(f"_{c}").alias(c) for c in ("number", "version", "text")])
    bounds = number_bounds(lines, batches)
    above = [F.coalesce(F.col("number") < F.lit(b), F.lit(True)).cast("int") for b in bounds]
    batch = reduce(Column.__add__, above, F.lit(0))  # rows without a number: the last one
    schema = "hash binary, number bigint, version bigint"
    hashes = lines.mapInArrow(lambda part: hash_batches(part, least_chars), schema)
    path = scratch_path(docs.sparkSession, "line-pairs")
    hashes.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    pairs = docs.sparkSession.read.schema(f"{schema}, batch int").parquet(path)
    frequent = materialize(frequent_lines(pairs, bounds, least_documents, fan), "line-frequent")
    lost = lost_pairs(pairs, frequent).groupBy("number", "version").agg(F.collect_set("hash").alias("_lost"))

    @F.pandas_udf("struct<n_lines:bigint,n_dropped:bigint,kept_text:string>")
    def cut(texts: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        rows = []
        for value, drop in zip(texts, hashes):
            lines = (value or "").split("\n")
            kept = lines
            if drop is not None:
                drop = set(drop)
                kept = [x for x in lines if not (long_enough(k := line_key(x), least_chars) and key_hash(k) in drop)]
            rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
        return pd.DataFrame(rows, columns=list(RESULTS))

    same = F.col("_number").eqNullSafe(F.col("number_")) & (F.col("_version") == F.col("version_"))
    lost = lost.withColumnsRenamed({"number": "number_", "version": "version_"})
    met = keyed.join(lost, same, "left").select(*others, "_text", "_lost")
    return met.withColumn("_cut", cut("_text", "_lost")).select(*others, *[F.col(f"_cut.{c}").alias(c) for c in RESULTS])
