"""Windowed drift monitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from evenkeel.operators.drift import DriftSnapshot, drift_level, logged_price, stored_psi
from evenkeel.operators.histogram import with_bin
from evenkeel.sources.commits import claim, newest, numbered, read
from evenkeel.streaming.ledger import Ledger

COUNTS = "start timestamp, bin int, n bigint"


def start_window_counts(
    stream: DataFrame,
    time: str,
    value: str,
    snapshot: DriftSnapshot,
    target: str,
    checkpoint: str,
    window: str = "1 day",
    once: bool = True,
) -> StreamingQuery:
    """Keep (window, bin) counts of a stream under ``target``.

    Each micro-batch adds what it counts and enters it in the target's ledger: there is no state
    that could expire, so no row is too late to count, a replayed batch counts once, and a stream
    that starts anew with another checkpoint adds to what is there. Values are clipped to the stored
    edges; those at or below -1, whose logarithm isn't defined, are in the first bin. A row without
    a value or a time adds nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, target)
        stream_id = ledger.stream_id(checkpoint)
        if ledger.holds(stream_id, batch_id):
            return
        timed = batch.withColumn("__ts", F.col(time).cast("timestamp"))
        binned = with_bin(timed, logged_price(F.col(value)), snapshot.price_log_bin_edges, clipped=True)
        counts = (
            binned.where("bin IS NOT NULL AND __ts IS NOT NULL")
            .groupBy(F.window("__ts", window).alias("w"), "bin")
            .agg(F.count("*").alias("n"))
        )
        folder = ledger.fresh_folder("added")
        counts.select(F.col("w.start").alias("start"), "bin", "n").write.parquet(folder)
        ledger.commit(stream_id, batch_id, {"added": folder})

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _compaction(spark: SparkSession, target: str) -> tuple[int, str | None, dict[str, int]]:
    """Number and folder of the newest compacted table, and the last batch per stream that is in it."""
    number = newest(spark, f"{target}/compactions")
    if number is None:
        return -1, None, {}
    (row,) = read(spark, f"{target}/compactions/{numbered(number)}")
    return number, row["folder"], row["upto"]


def window_counts(spark: SparkSession, target: str) -> DataFrame:
    """(start, bin, n) over all batches: the newest compacted table and what was added since."""
    _, base, upto = _compaction(spark, target)
    parts = [Ledger(spark, target).rows("added", COUNTS, upto)]
    if base is not None:
        parts.append(spark.read.schema(COUNTS).parquet(base))
    rows = spark.createDataFrame([], COUNTS)
    for part in parts:
        if part is not None:
            rows = rows.unionByName(part)
    return rows.groupBy("start", "bin").agg(F.sum("n").alias("n"))


def compact_window_counts(spark: SparkSession, target: str) -> dict[str, int]:
    """Sum all entered batches into one table, beside the old one; the last batch in it per stream.

    Runs beside streams and other compactions: batches are summed by their ledger entries, in the
    order of a stream's numbers, and a table counts once its own entry is made, so dying half-way
    changes nothing. Folders that a compaction holds can be expired afterwards.
    """
    number, base, upto = _compaction(spark, target)
    ledger = Ledger(spark, target)
    added = ledger.entries(upto)
    if not added:
        return upto
    last = dict(upto)
    for entry in added:
        last[entry.stream] = max(last.get(entry.stream, -1), entry.batch)
    rows = spark.read.schema(COUNTS).parquet(*[e.folders["added"] for e in added], *([base] if base else []))
    folder = ledger.fresh_folder("compacted")
    rows.groupBy("start", "bin").agg(F.sum("n").alias("n")).write.parquet(folder)
    if claim(spark, f"{target}/compactions/{numbered(number + 1)}", [{"folder": folder, "upto": last}]):
        return last
    return _compaction(spark, target)[2]


def window_drift(spark: SparkSession, target: str, snapshot: DriftSnapshot) -> DataFrame:
    """Index and level per window."""
    return psi_by_window(window_counts(spark, target), snapshot)


def psi_by_window(counts: DataFrame, snapshot: DriftSnapshot) -> DataFrame:
    nb = len(snapshot.price_log_ref_pct)
    per_bin = [F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)) for i in range(1, nb + 1)]
    scored = counts.groupBy("start").agg(
        F.sum("n").alias("rows"), stored_psi(per_bin, snapshot.price_log_ref_pct).alias("psi")
    )
    return scored.withColumn("drift_level", drift_level(F.col("psi")))
