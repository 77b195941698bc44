"""Which micro-batches a target holds: one ledger entry per stream and batch.

A batch writes folders of fresh names and then enters them in the ledger, under the id that its
stream's checkpoint carries and its own number, in one atomic step. A batch that dies before leaves
nothing that is read; one that is replayed after its entry finds it and writes nothing, as the rows
are there; a stream with a new checkpoint has another id, so it adds to the target and never
replaces what another stream wrote. Entries may hold counts of their batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from evenkeel.sources.commits import claim, names, numbered, read


@dataclass(frozen=True)
class Entry:
    stream: str
    batch: int
    folders: Mapping[str, str]
    counts: Mapping[str, int]


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    target: str

    def stream_id(self, checkpoint: str) -> str:
        """The id that Spark gives a stream with its checkpoint."""
        return read(self.spark, f"{checkpoint}/metadata")[0]["id"]

    def fresh_folder(self, kind: str) -> str:
        return f"{self.target}/{kind}/{uuid.uuid4().hex}"

    def _entry(self, stream: str, batch: int) -> str:
        return f"{self.target}/ledger/{stream}/{numbered(batch)}"

    def holds(self, stream: str, batch: int) -> bool:
        return numbered(batch) in names(self.spark, f"{self.target}/ledger/{stream}")

    def commit(self, stream: str, batch: int, folders: Mapping[str, str], counts: Mapping[str, int] | None = None) -> bool:
        """Enter a batch's folders; False if the batch was entered before, whose folders then stay the ones that count."""
        row = {"stream": stream, "batch": batch, "folders": dict(folders), "counts": dict(counts or {})}
        return claim(self.spark, self._entry(stream, batch), [row])

    def entries(self, beyond: Mapping[str, int] | None = None) -> list[Entry]:
        """Entries with a number above the one that ``beyond`` has for their stream."""
        found = []
        for stream in names(self.spark, f"{self.target}/ledger"):
            last = (beyond or {}).get(stream, -1)
            for name in names(self.spark, f"{self.target}/ledger/{stream}"):
                if int(name.removesuffix(".json")) > last:
                    found += [Entry(**row) for row in read(self.spark, f"{self.target}/ledger/{stream}/{name}")]
        return found

    def rows(self, kind: str, schema: Any = None, beyond: Mapping[str, int] | None = None) -> DataFrame | None:
        """What batches wrote as ``kind``; None if no batch did."""
        folders = [e.folders[kind] for e in self.entries(beyond) if kind in e.folders]
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*folders) if folders else None
