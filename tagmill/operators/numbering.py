"""Dense numbers for keys: a dictionary made by Spark, so that iterations carry longs and names are joined at the end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import rows_written, written


def numbered(df: DataFrame, keys: Sequence[str], to: str, path: str) -> tuple[DataFrame, int]:
    """(``keys``, ``to``) for the distinct ``keys`` of ``df``, numbered from 0 without gaps, and how many there are.

    Keys stay in the partitions that made them distinct; each counts its own, and a prefix sum over the partitions' sizes
    moves the counts. The table is stored in ``path`` before it is numbered, so a number is never given anew, and after it, so
    joins with it are planned by its size.
    """
    # The upper bits of the increasing number are the partition, the lower 33 count its rows.
    raw = df.select(*keys).distinct().withColumn("_raw", F.monotonically_increasing_id())
    raw, size = rows_written(raw, f"{path}/keys")
    part, place = F.shiftright("_raw", 33), F.col("_raw").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = raw.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    parts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = raw.withColumns({"_part": part, "_place": place}).join(F.broadcast(parts), "_part")
    return written(joined.select(*keys, (F.col("_before") + F.col("_place")).alias(to)), f"{path}/numbers"), size
