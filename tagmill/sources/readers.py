"""Scans of landed files and choice of dated snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonlines(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON lines with a given schema; fields outside of it are never materialised."""
    return spark.read.schema(schema).json(path)


def read_tsv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Headerless tab-separated text; quotes inside a quoted field are doubled."""
    return spark.read.schema(schema).csv(
        path, sep="\t", header=False, quote='"', escape='"', multiLine=False
    )


def read_csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Comma-separated text with a header line."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"')


def read_lines_with_key(
    spark: SparkSession, path, fields: Sequence[str], separator: str = "_"
) -> DataFrame:
    """Raw lines beside a key built from JSON fields: ``line, key``. Lines pass through unchanged."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return lines.select("line", line_key(F.col("line"), fields, separator).alias("key"))


def line_key(line, fields: Sequence[str], separator: str = "_") -> Column:
    """Key of a raw JSON line: the given fields joined. The line is parsed once, for these only."""
    parsed = F.from_json(line, T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    return joined_key([parsed[name] for name in fields], separator)


def joined_key(parts: Sequence[Column], separator: str = "_") -> Column:
    """Parts joined to one key; null if a part is null, so that (1, null) and (null, 1) stay apart from any key."""
    texts = [part.cast("string") for part in parts]
    return F.concat(*[x for text in texts for x in (F.lit(separator), text)][1:])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, mtime`` of the files in a folder; file contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select("path", F.col("modificationTime").alias("mtime"))


def latest_snapshot(files: DataFrame, prefix: str, n: int = 1) -> DataFrame:
    """The n-th newest snapshot whose name starts with ``prefix``; empty with fewer than n.

    A snapshot is a file, or a dated folder (``<name>/as_of=<date>/...``) with all its files: its path is the folder
    and its name what stands before the date; the date decides what is newer, and then the time.
    """
    dated = F.regexp_extract("path", r"^(.*/as_of=[0-9_]+)/[^/]+$", 1)
    whole = F.when(dated != "", dated).otherwise(F.col("path"))
    stamp = F.regexp_extract(whole, r"/as_of=([0-9_]+)$", 1)
    name = F.substring_index(F.regexp_replace(whole, r"/as_of=[0-9_]+$", ""), "/", -1)
    snapshots = files.withColumns({"_whole": whole, "_stamp": stamp, "_name": name})
    snapshots = snapshots.groupBy("_whole", "_stamp", "_name").agg(F.max("mtime").alias("mtime"))
    return (
        snapshots.where(F.startswith("_name", F.lit(prefix)))
        .orderBy(F.desc("_stamp"), F.desc("mtime"), F.desc("_whole"))
        .select(F.col("_whole").alias("path"), "mtime")
        .offset(n - 1)
        .limit(1)
    )


def latest_by(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``ts`` per key (over all rows without keys)."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(ts, *[c for c in rest if c != ts]))
    return df.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*")


def ids_between(df: DataFrame, column: str, id_min: int = 1, id_max: int | None = None) -> DataFrame:
    """Rows whose id lies in ``[id_min, id_max)``."""
    within = F.col(column) >= id_min
    return df.where(within if id_max is None else within & (F.col(column) < id_max))
