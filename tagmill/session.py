"""Session helpers: where intermediate tables go and how row counts are observed."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_folder(spark: SparkSession, label: str = "job") -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``.

    Iterative jobs write their small vectors there between rounds, so lineage stays short
    and a lost executor costs one round at most. Only a local master without the setting
    falls back to a temporary folder; on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_folder(spark)
    return f"{base.rstrip('/')}/tagmill-{label}-{uuid.uuid4().hex}"


@cache
def _temporary_folder() -> str:
    return tempfile.mkdtemp(prefix="tagmill-")


def _local_folder(spark: SparkSession) -> str:
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _temporary_folder()


def written(df: DataFrame, path: str, observation: Observation | None = None, *metrics) -> DataFrame:
    """Write ``df`` to ``path`` as Parquet and read it back: a table with no lineage.

    Metrics are observed in the same pass. They sit on top of the final stage, whose tasks
    count once each, so a retried task does not count twice. What the exchanges of the pass wrote goes when it is stored.
    """
    observed = df if observation is None else df.observe(observation, *metrics)
    with exchanges_removed(df.sparkSession):
        observed.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def exchanges_removed(spark: SparkSession) -> Iterator[None]:
    """Files of exchanges are removed when the query that made them ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` in as many buckets of ``key``, a table that is grouped and joined by it without an exchange."""
    spark, name = df.sparkSession, _table_name(path)
    with exchanges_removed(spark):
        df.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def bucketed_gone(spark: SparkSession, path: str) -> None:
    """Forget the table of ``path``; its files stay with the others of the job."""
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")


def _table_name(path: str) -> str:
    return re.sub(r"\W", "_", "_".join(path.rsplit("/", 2)[1:])).lower()


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row count that is filled by whatever action later runs over ``df``."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


class Progress:
    """Watches an iteration that has no round limit of its own: it may take long, but must come nearer."""

    PATIENCE = 1_000  # rounds without a new best before an iteration counts as stuck

    def __init__(self, name: str):
        self.name, self.best, self.rounds, self.since = name, float("inf"), 0, 0

    def unsettled(self, change: float, limit: int | None = None) -> None:
        self.rounds += 1
        self.since = 0 if change < self.best else self.since + 1
        self.best = min(self.best, change)
        if (limit is not None and self.rounds >= limit) or self.since > self.PATIENCE:
            raise RuntimeError(
                f"{self.name} has not settled after {self.rounds} rounds; last change {change:.3g}"
            )


# Layout only: results do not depend on it.
ROWS_PER_PARTITION = 200_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a table that is kept over many rounds: enough for its rows and for every core,
    at most ``spark.sql.shuffle.partitions``."""
    most = shuffle_partitions(spark)
    least = min(most, spark.sparkContext.defaultParallelism)
    return max(least, min(most, -(-rows // ROWS_PER_PARTITION)))


def rows_written(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """``written``, with the number of rows."""
    seen = Observation()
    stored = written(df, path, seen, F.count(F.lit(1)).alias("rows"))
    return stored, seen.get["rows"]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
