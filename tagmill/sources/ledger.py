"""Committed datasets: what a night has finished, from which inputs, and what the nights before it have.

A dataset counts from the moment its ledger entry stands, which is written last; half-written folders have none. An entry is
a row of JSON in a folder of its own, so Spark's commit makes it visible at once.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_stamp
from ..schemas import LONG, TEXT, struct

ENTRY = struct(
    dataset=TEXT, as_of=TEXT, path=TEXT, rows=LONG, files=LONG, schema=TEXT, inputs=T.MapType(TEXT, TEXT)
)


class Ledger:
    """The entries below ``output`` as one night sees them. Reading them costs one row per dataset and night."""

    def __init__(self, spark: SparkSession, output: str, as_of: dt.date):
        self.spark, self.folder, self.stamp = spark, f"{output.rstrip('/')}/ledger", date_stamp(as_of)
        # The first entry of all opens the folder; it names no dataset.
        self._write({"dataset": "", "as_of": self.stamp, "inputs": {}})
        entries = self._entries().where(F.col("as_of") == self.stamp).collect()
        self.done = {e["dataset"]: e for e in entries}

    def _entries(self) -> DataFrame:
        rows = self.spark.read.schema(ENTRY).option("recursiveFileLookup", "true").json(self.folder)
        return rows.where("dataset <> ''")

    def _write(self, entry: Mapping) -> None:
        row = tuple(entry.get(f.name) for f in ENTRY.fields)
        name = entry["dataset"] or "opened"
        rows = self.spark.createDataFrame([row], ENTRY).coalesce(1)
        rows.write.mode("overwrite").json(f"{self.folder}/{name}/as_of={entry['as_of']}")

    def before(self, dataset: str) -> Row | None:
        """The newest entry of a dataset of an earlier night."""
        earlier = self._entries().where((F.col("dataset") == dataset) & (F.col("as_of") < self.stamp))
        return earlier.orderBy(F.desc("as_of")).first()

    def commit(self, dataset: str, inputs: Mapping[str, str], **what) -> None:
        """Write the entry of a dataset: its path, rows, files and schema (JSON), as far as they are given."""
        entry = dict.fromkeys(ENTRY.names) | {"dataset": dataset, "as_of": self.stamp, "inputs": dict(inputs), **what}
        self._write(entry)
        self.done[dataset] = Row(**entry)

    def publish(
        self, dataset: str, inputs: Mapping[str, str | None], make: Callable[[], DataFrame],
        write: Callable[[DataFrame], tuple[str, int | None]], read: Callable[[str, T.StructType], DataFrame],
    ) -> DataFrame:
        """The dataset of this night: read if it is committed from these inputs, else made, written and committed."""
        given = {k: v for k, v in inputs.items() if v is not None}
        entry = self.done.get(dataset)
        if entry is None or dict(entry["inputs"] or {}) != given:
            df = make()
            path, rows = write(df)
            files = len(read(path, df.schema).inputFiles())
            self.commit(dataset, given, path=path, rows=rows, files=files, schema=df.schema.json())
            entry = self.done[dataset]
        return read(entry["path"], T.StructType.fromJson(json.loads(entry["schema"])))
