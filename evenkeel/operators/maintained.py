"""A latest-row-per-key table that takes in one extract after another.

Rows lie in ``buckets`` folders by a hash of the key, sorted by it. Merging an extract rewrites the buckets
that it has keys for and no other: the extract's newest row per key meets the bucket's rows, late rows
lose to newer ones that are there already, and the order of extracts doesn't matter. Each
version of the table is a list of bucket folders, entered as the next commit of its log; two
merges at once are one after the other, as the second finds its number taken and starts again from
the table that is then there. Readers see a whole version; a merge that dies leaves folders that no version names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from evenkeel.operators.clean import latest_per_key
from evenkeel.sources.commits import claim, newest, numbered, read


@dataclass(frozen=True)
class LatestTable:
    """``date`` and then ``tiebreak`` tell which of a key's rows is newest; rows alike in these are copies."""

    spark: SparkSession
    path: str
    schema: StructType
    key: tuple[str, ...]
    date: str
    tiebreak: tuple[str, ...] = ()
    buckets: int = 64

    def _state(self) -> tuple[int, dict[str, str]]:
        """Number of the newest version (-1 before the first) and the folder of each bucket that has rows."""
        number = newest(self.spark, f"{self.path}/versions")
        if number is None:
            return -1, {}
        (row,) = read(self.spark, f"{self.path}/versions/{numbered(number)}")
        if row["buckets"] != self.buckets:
            raise ValueError(f"the table at {self.path} has {row['buckets']} buckets")
        return number, row["folders"]

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def rows(self) -> DataFrame:
        """The newest row of every key."""
        return self._rows(list(self._state()[1].values()))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, list(self.key), self.date, list(self.tiebreak))

    def merge(self, extract: DataFrame) -> list[int]:
        """Take in an extract; the buckets that were written anew."""
        columns = [f.name for f in self.schema.fields]
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        fresh = self._newest(extract.select(*columns)).withColumn("__bucket", self._bucket())
        fresh.write.parquet(staged)
        fresh = self.spark.read.schema(fresh.schema).parquet(staged)
        touched = sorted(r["__bucket"] for r in fresh.select("__bucket").distinct().collect())  # ``buckets`` at most
        while touched:
            number, folders = self._state()
            held = self._rows([folders[str(b)] for b in touched if str(b) in folders])
            merged = self._newest(held.unionByName(fresh.drop("__bucket"))).withColumn("__bucket", self._bucket())
            place = f"{self.path}/rows/{uuid.uuid4().hex}"
            dealt = merged.repartition("__bucket").sortWithinPartitions("__bucket", *self.key)
            dealt.write.partitionBy("__bucket").parquet(place)
            now = folders | {str(b): f"{place}/__bucket={b}" for b in touched}
            entry = {"buckets": self.buckets, "folders": now}
            if claim(self.spark, f"{self.path}/versions/{numbered(number + 1)}", [entry]):
                break
        return touched
