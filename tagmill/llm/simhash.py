"""Near-duplicate texts by SimHash fingerprints, with candidates from the pigeonring principle.

Two fingerprints with at most 4 differing bits are cut into 5 segments on a ring. Somewhere on the ring a chain
starts whose first l segments differ in at most l * 4 / 5 bits, for every l: none in the first, at most 1 in two, 2 in
three, 3 in four. The index asks for the first two at once: equal first segment, and, as a single
differing bit spares one half of the next, equal first or second half of that. Chains and at last all bits are
checked pair by pair inside a task; only a spanning forest of the links leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagmill.session import scratch_folder, written

from .graphs import Forest, components, spread_cells

DIFFERING_BITS = 4
SHINGLE_WORDS = 4
TILE_ROWS = 4_096  # layout only
_SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit and bits of each
_HALF = 6


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 hashes (seed 42) of all shingles in order.

    ASCII letters are lower-cased; words are runs without ASCII white space; repeats count. Fewer words than a
    shingle are one shingle, none give no hash.
    """
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    number = max(1, len(found) - words + 1)
    ends = ends[min(words, len(found)) - 1 :]
    return [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[:number].tolist(), ends.tolist())]


def text_fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is set in over half of the hashes of ``shingle_hashes``; no words give zero."""
    hashes = shingle_hashes(text, words)
    number = len(hashes)
    counts = np.zeros(64, np.int64)
    for a in range(0, number, 65_536):
        part = np.array(hashes[a : a + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > number, bitorder="little").view("<u8")[0])


def fingerprint(text: Column | str, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint column, a signed long; null texts are empty."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = [text_fingerprint(t or "", words) for t in texts]
        return pd.Series(np.array(found, np.uint64).view(np.int64))

    return of(text)


def chain_keys(fp: str) -> Column:
    """The ten index keys of a fingerprint: five starts of a chain, two halves of the second segment."""
    keys = []
    for i, (at, bits) in enumerate(_SEGMENTS):
        first = F.shiftrightunsigned(fp, at).bitwiseAND((1 << bits) - 1)
        at, bits = _SEGMENTS[(i + 1) % 5]
        second = F.shiftrightunsigned(fp, at).bitwiseAND((1 << bits) - 1)
        for half, part in enumerate((second.bitwiseAND((1 << _HALF) - 1), F.shiftrightunsigned(second, _HALF))):
            slot = F.lit((2 * i + half) << 32).cast("long")
            keys.append(slot.bitwiseOR(F.shiftleft(first, 8)).bitwiseOR(part))
    return F.array(*keys)


def _chain_masks() -> np.ndarray:
    """By start and length: the bits of the first 1 to 5 segments of the chain."""
    masks = [sum(((1 << _SEGMENTS[(i + k) % 5][1]) - 1) << _SEGMENTS[(i + k) % 5][0] for k in range(n)) for i in range(5) for n in range(1, 6)]
    return np.array(masks, np.uint64).reshape(5, 5)


def chain_links(start: np.ndarray, differing: np.ndarray, limit: int = DIFFERING_BITS) -> np.ndarray:
    """Which pairs pass every chain budget and the check of all bits; each check sees what the last has left."""
    masks, left = _chain_masks(), np.arange(len(start))
    for length in range(2, 6):
        bits = np.bitwise_count(differing[left] & masks[start[left], length - 1])
        left = left[bits <= length * limit // 5]
    return left


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the sorted cells of a partition, as edges to the first member of each tree."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < 4 * TILE_ROWS:
            continue
        table = pa.Table.from_batches(held)
        cell = _cell_numbers(table)
        done = int(np.searchsorted(cell, cell[-1]))
        yield from _links(table.slice(0, done), cell[:done])
        held = table.slice(done).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield from _links(table, _cell_numbers(table))


def _cell_numbers(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for name in ("key", "low", "high"):
        values = table[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def _links(table: pa.Table, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
    n = table.num_rows
    if n < 2:
        return
    fp = table["fp"].to_numpy().view(np.uint64)
    tile, start = table["tile"].to_numpy(), table["key"].to_numpy() >> 33
    across = table["low"].to_numpy() != table["high"].to_numpy()
    forest, at, step = Forest(n), np.arange(n), 0
    while True:
        step += 1
        at = at[at + step < n]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            break
        pair = at[~across[at] | (tile[at] != tile[at + step])]
        good = pair[chain_links(start[pair], fp[pair] ^ fp[pair + step])]
        forest.join(good, good + step)
    joined = np.flatnonzero(forest.root != np.arange(n))
    if len(joined):
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[joined].view(np.int64)), pa.array(fp[forest.root[joined]].view(np.int64))], ["a", "b"]
        )


def fingerprint_groups(fingerprints: DataFrame) -> DataFrame:
    """(fp, group) for the distinct ``fp`` that link with another; group is the smallest such fp reachable."""
    keyed = fingerprints.select("fp").distinct().select(F.explode(chain_keys("fp")).alias("key"), "fp")
    cells = spread_cells(keyed, ["key"], "fp", TILE_ROWS)
    parts = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    edges = dealt.select("key", "low", "high", "tile", "fp").mapInArrow(_match, "a long, b long")
    return components(edges).select(F.col("node").alias("fp"), F.col("component").alias("group"))


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``key``, fp, fingerprint (16 hex digits), component_id.

    Rows link when their fingerprints differ in at most 4 bits; component_id is the smallest ``key`` reachable, the
    row's own included; null keys never are. Null, empty and wordless texts share fingerprint zero. Equal
    fingerprints are one node whatever number of rows has them, so copies cost nothing here.
    """
    folder = scratch_folder(docs.sparkSession, "simhash")
    rows = written(docs.select(F.col(key), fingerprint(text, words).alias("fp")), f"{folder}/fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min(key).alias("first")), f"{folder}/nodes")
    groups = written(fingerprint_groups(nodes), f"{folder}/groups")
    smallest = nodes.join(groups, "fp").groupBy("group").agg(F.min("first").alias("smallest"))
    linked = groups.join(smallest, "group").select("fp", "smallest")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("component_id"))
    out = rows.join(named, "fp").select(key, "fp", "component_id")
    return out.select(key, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest key stays.

    Rows that share that key are one document: one of them stays. Rows without a key are never dropped.
    """
    return one_of_each(docs, simhash_components(docs, key, text, words), key)


def one_of_each(docs: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of its component in ``groups`` (``key``, component_id).

    Of rows that share such a key the one with the smallest hash of all columns stays.
    """
    kept = groups.where(F.col(key) == F.col("component_id")).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    met = docs.alias("d").join(kept.alias("k"), F.col(f"d.{key}") == F.col("k.key"))
    stay = met.select(F.struct("d.*").alias("row"), F.col("k.n").alias("n"))
    once = stay.where("n = 1").select("row.*")
    order = W.partitionBy(F.col("row")[key]).orderBy(F.xxhash64("row"))
    repeated = stay.where("n > 1").withColumn("place", F.row_number().over(order)).where("place = 1").select("row.*")
    return once.unionByName(repeated).unionByName(docs.where(F.col(key).isNull()))
