"""Update and delete feeds from two snapshots of the same table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def removed_keys(prev: DataFrame, cur: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keys of the previous snapshot that the current one no longer has, each once.

    Both sides are reduced to distinct keys before they meet, so copies of one key are dropped on
    the map side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    before, now = prev.select(*keys).distinct(), cur.select(*keys).distinct()
    return before.join(now, keys, "left_anti")


def snapshot_diff(
    prev: DataFrame, cur: DataFrame, key: Sequence[str] | str
) -> tuple[DataFrame, DataFrame]:
    """``(upserts, deletes)``: the current rows unchanged, and the keys that disappeared."""
    return cur, removed_keys(prev, cur, key)
