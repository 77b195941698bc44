"""Continuous scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from evenkeel.operators.validate import Rule, rule_messages
from evenkeel.plans.scoring import Scorer
from evenkeel.session import stored
from evenkeel.streaming.ledger import Ledger


def start_scoring(
    stream: DataFrame, scorer: Scorer, target: str, checkpoint: str, rules: Sequence[Rule] = (), once: bool = True
) -> StreamingQuery:
    """Normalise, validate and score a stream into ``target``; ``scored_rows`` and ``quarantined_rows`` read it.

    Every row is in one of the two; quarantined rows carry their errors. A batch is read, backfilled and
    validated once and stored while both sides are written, then entered in the target's ledger with the number
    of its rows and of each rule's failures, observed in the same pass. A replayed batch counts once, a stream with a
    new checkpoint adds. ``once`` drains what is there and stops.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, target)
        stream_id = ledger.stream_id(checkpoint)
        if ledger.holds(stream_id, batch_id):
            return
        seen = Observation()
        checked = scorer.checked(batch, rules)
        messages = rule_messages(checked, rules)
        failures = [F.count_if(F.array_contains("errors", m)).alias(f"failure_{i}") for i, m in enumerate(messages)]
        checked = checked.observe(seen, F.count("*").alias("rows"), F.count_if(~F.col("valid")).alias("quarantined"), *failures)
        with stored(checked, "checked") as kept:
            good, bad = scorer.split(kept)
            folders = {"scored": ledger.fresh_folder("scored")}
            good.write.parquet(folders["scored"])
            if rules:
                folders["quarantined"] = ledger.fresh_folder("quarantined")
                bad.write.parquet(folders["quarantined"])
        found = seen.get
        named = {m: found[f"failure_{i}"] for i, m in enumerate(messages)}
        ledger.commit(stream_id, batch_id, folders, {"rows": found["rows"], "quarantined": found["quarantined"], **named})

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def scored_rows(spark: SparkSession, target: str) -> DataFrame | None:
    """Scored rows of all batches; None before the first one."""
    return Ledger(spark, target).rows("scored")


def quarantined_rows(spark: SparkSession, target: str) -> DataFrame | None:
    return Ledger(spark, target).rows("quarantined")


def batch_counts(spark: SparkSession, target: str) -> DataFrame:
    """(stream, batch, counter, n): rows, quarantined rows, and failures per rule of each batch."""
    rows = [(e.stream, e.batch, name, n) for e in Ledger(spark, target).entries() for name, n in e.counts.items()]
    return spark.createDataFrame(rows, "stream string, batch bigint, counter string, n bigint")
