"""Texts that share most of their word shingles: candidates by bands of MinHash values, each confirmed exactly.

A fingerprint of 64 bits is no index for a similarity of 0.8: such texts differ in 6 to 14 bits, segments small
enough for that select almost nothing, and comparing all fingerprints is quadratic. Four equal minima select
well, and so many bands are taken that a pair at the very threshold is missed once in 100,000 times. No pair links
without its shared shingles being counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.session import scratch_folder, written

from .graphs import Forest, components, spread_cells
from .simhash import one_of_each, shingle_hashes

SIMILAR_WORDS = 5
SIMILARITY = 0.8
BAND_VALUES = 4
MISSED = 1e-5  # of the pairs at the threshold; fewer above it
TILE_ROWS = 4_096  # layout only
_CHUNK = 1_024


def band_count(similarity: float) -> int:
    """Bands that let at most ``MISSED`` of the pairs at the threshold pass unseen."""
    met = similarity**BAND_VALUES
    return 1 if met >= 1 else math.ceil(math.log(MISSED) / math.log1p(-met))


def shingle_set(text: str, words: int = SIMILAR_WORDS) -> np.ndarray:
    """The distinct shingle hashes, sorted; words and short texts as in ``text_fingerprint``."""
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def set_number(found: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(found.astype("<u8").tobytes(), 7)


def band_keys(found: np.ndarray, bands: int) -> list[int]:
    """One number per band of the smallest values of a set; no shingles, no bands."""
    from xxhash import xxh64_intdigest

    if not len(found):
        return []
    rng = np.random.default_rng(5)
    number = bands * BAND_VALUES
    turn = rng.integers(0, 1 << 63, number, np.uint64)[:, None]
    spread = (rng.integers(0, 1 << 63, number, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
    least = np.full(number, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(found), _CHUNK):
        mixed = (found[a : a + _CHUNK] ^ turn) * spread
        np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=1), out=least)
    rows = least.astype("<u8").reshape(bands, BAND_VALUES)
    return [xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)]


def _sketches(words: int, bands: int):
    @F.pandas_udf("set long, bands array<long>")
    def sketches(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t or "", words) for t in texts]
        numbers = np.array([set_number(s) for s in sets], np.uint64).view(np.int64)
        keys = [np.array(band_keys(s, bands), np.uint64).view(np.int64) for s in sets]
        return pd.DataFrame({"set": numbers, "bands": keys})

    return sketches


def _shingles(words: int):
    @F.pandas_udf("set long, shingles binary")
    def shingles(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t or "", words) for t in texts]
        numbers = np.array([set_number(s) for s in sets], np.uint64).view(np.int64)
        return pd.DataFrame({"set": numbers, "shingles": [s.astype("<u8").tobytes() for s in sets]})

    return shingles


def similar_pairs(sets: list[np.ndarray], tiles: np.ndarray | None, similarity: float) -> np.ndarray:
    """The root of every set after all pairs (of different ``tiles`` if given) with that Jaccard similarity are joined.

    Pairs in one tree already are not compared again: their link changes nothing.
    """
    forest, sizes = Forest(len(sets)), np.array([len(s) for s in sets])
    for i in range(len(sets) - 1):
        later = np.arange(i + 1, len(sets))
        small, large = np.minimum(sizes[later], sizes[i]), np.maximum(sizes[later], sizes[i])
        later = later[(small >= similarity * large) & (forest.root[later] != forest.root[i])]
        if tiles is not None:
            later = later[tiles[later] != tiles[i]]
        if not len(later):
            continue
        own, met = sets[i], np.concatenate([sets[j] for j in later])
        at = np.minimum(np.searchsorted(own, met), len(own) - 1)
        starts = np.r_[0, np.cumsum(sizes[later])[:-1]]
        shared = np.add.reduceat((own[at] == met).astype(np.int64), starts)
        good = later[shared >= similarity * (sizes[i] + sizes[later] - shared) - 1e-9]
        forest.join(np.full(len(good), i), good)
    return forest.root


def _match(similarity: float):
    """Links of the sorted cells of a partition, as edges to the first member of each tree."""

    def linked(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        if cell.num_rows < 2:
            return
        sets = [np.frombuffer(b, "<u8") for b in cell["shingles"].to_pylist()]
        across = cell["low"][0].as_py() != cell["high"][0].as_py()
        root = similar_pairs(sets, cell["tile"].to_numpy() if across else None, similarity)
        joined, numbers = np.flatnonzero(root != np.arange(len(root))), cell["set"].to_numpy()
        if len(joined):
            yield pa.RecordBatch.from_arrays([pa.array(numbers[joined]), pa.array(numbers[root[joined]])], ["a", "b"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            names = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("key", "low", "high")], axis=1)
            ends = [*(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
            begin = 0
            for end in ends if len(names) else ():
                name = tuple(names[begin].tolist())
                if held and name != last:
                    yield from linked(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(begin, end - begin))
                last, begin = name, end
        if held:
            yield from linked(pa.Table.from_batches(held))

    return match


def similar_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs`` with a key: ``key`` and component_id, the smallest key reachable by links.

    Rows link when the Jaccard similarity of their distinct shingles is at least ``similarity``; texts without words
    are equal. Equal sets are one node whatever number of rows has them. Rows without a key take no part.
    """
    spark = docs.sparkSession
    folder, parts = scratch_folder(spark, "similar"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
    sketched = keyed.select("id", _sketches(words, band_count(similarity))("text").alias("s")).select("id", "s.*")
    rows = written(sketched, f"{folder}/rows")
    nodes = written(rows.groupBy("set").agg(F.min("id").alias("first"), F.first("bands").alias("bands")), f"{folder}/nodes")

    # Bands with the same members say the same; one of them is enough.
    banded = nodes.select(F.explode("bands").alias("key"), "set")
    members = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("set").cast("decimal(20)")).alias("sum"))
    once = members.where("n > 1").groupBy("n", "sum").agg(F.min("key").alias("key")).select("key")
    cells = written(spread_cells(banded.join(once, "key"), ["key"], "set", TILE_ROWS), f"{folder}/cells")

    wanted = cells.select("set").distinct().join(nodes.select("set", "first"), "set")
    texts = keyed.join(wanted.select(F.col("first").alias("id")).distinct(), "id", "left_semi")
    sets = texts.select(_shingles(words)("text").alias("s")).select("s.*").dropDuplicates(["set"])
    sets = written(sets, f"{folder}/sets")
    dealt = cells.join(sets, "set").repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high", "set")
    dealt = dealt.select("key", "low", "high", "tile", "set", "shingles")
    groups = components(dealt.mapInArrow(_match(similarity), "a long, b long"))
    groups = written(groups.select(F.col("node").alias("set"), F.col("component").alias("group")), f"{folder}/groups")

    smallest = nodes.join(groups, "set").groupBy("group").agg(F.min("first").alias("smallest"))
    linked = groups.join(smallest, "group").select("set", "smallest")
    named = nodes.join(linked, "set", "left").select("set", F.coalesce("smallest", "first").alias("component_id"))
    return rows.join(named, "set").select(F.col("id").alias(key), "component_id")


def drop_similar(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs`` without near duplicates, as ``drop_near_duplicates`` but by ``similar_components``."""
    return one_of_each(docs, similar_components(docs, key, text, words, similarity), key)
