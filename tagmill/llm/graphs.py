"""Groups that meet in cells of bounded size, and connected components by repeated starring."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tagmill.session import scratch_folder, written


def spread_cells(rows: DataFrame, keys: list[str], by: str, size: int, folder: str | None = None) -> DataFrame:
    """Adds ``tile``, ``low`` and ``high``: groups of ``keys`` with over ``size`` rows are cut into tiles, and every
    two tiles meet in the cell (low, high), each tile also with itself. Small groups are one cell.

    Rows of a large group are repeated once per tile, so no task ever holds more than two tiles and no pair is
    missed. Which groups are large is counted first; their list is joined, not broadcast by force. With a ``folder`` the
    list is stored there, so that Spark knows its size before it plans the join.
    """
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size)
    large = large.select(*keys, F.ceil(F.col("_n") / size).cast("int").alias("_tiles"))
    large = written(large, folder) if folder else large
    tiles = F.coalesce("_tiles", F.lit(1))
    spread = rows.join(large, keys, "left").withColumn("tile", F.pmod(F.xxhash64(by), tiles).cast("int"))
    other = F.explode(F.sequence(F.lit(0), tiles - 1))
    spread = spread.withColumn("_other", other).drop("_tiles")
    low, high = F.least("tile", "_other"), F.greatest("tile", "_other")
    return spread.withColumns({"low": low, "high": high}).drop("_other")


def whole_cells(batches: Iterator[pa.RecordBatch], names: list[str], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells, at least ``rows`` rows each but the last, and the number of each row's cell.

    A cell is the rows that agree in the numbers ``names``; the partition is sorted by them. At most one cell
    more than asked for is held.
    """

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for name in names:
            values = table[name].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.cumsum(new)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        cell = numbered(table)
        done = int(np.searchsorted(cell, cell[-1]))
        if done:
            yield table.slice(0, done), cell[:done]
        held = table.slice(done).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, numbered(table)


class Forest:
    """Joins members of one batch; ``root`` is the first member of each one's tree so far."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                higher = self.root[self.root]
                if (higher == self.root).all():
                    break
                self.root = higher


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), where component is the smallest node reachable.

    Each round lets every node hand its larger neighbours, then its smaller ones, to the smallest it knows; the
    rounds grow with the logarithm of the longest chain. Edges are written between rounds, so lineage stays
    short. The driver sees counts only.
    """
    folder = scratch_folder(edges.sparkSession, "components")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    seen, turn, before = _sums(), 0, None
    edges = written(edges, f"{folder}/start", seen, *_marks())
    while before != (now := tuple(seen.get.values())) and now[0]:
        before, seen, turn = now, _sums(), turn + 1
        edges = written(_small_star(_large_star(edges)), f"{folder}/turn_{turn}", seen, *_marks())
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(roots)


def _sums() -> Observation:
    return Observation()


def _marks():
    mark = F.xxhash64("a", "b")
    return F.count(F.lit(1)).alias("n"), F.sum(mark.bitwiseAND(0xFFFFFFFF)).alias("x"), F.sum(F.shiftrightunsigned(mark, 32)).alias("y")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = both.join(least, "a").where("b > a")
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node ``a`` to the smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
