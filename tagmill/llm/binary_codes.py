"""Near-duplicate vectors by binary codes of a random rotation.

A unit vector o is rotated and replaced by the signs of its coordinates, a unit vector ō. Stored with the
code is its correction factor c = <o, ō>. For any unit vector q, <q, ō> / c estimates <q, o> without bias over the rotation,
and as the part of o that ō misses is at most sqrt(1 - c²) long, a pair with <q, o> >= t has an estimate of at least
t - sqrt((1 - c²)(1 - t²)) / c. Pairs below that bound are settled by their codes; the others are computed again in
double precision. The bound holds for every rotation, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.session import scratch_folder, written

from .graphs import Forest, components, spread_cells

TILE_ROWS = 2_048  # layout only
_SEED = 42
_SLACK = 1e-5  # for single precision in the estimates
_STRIP = 256


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    return np.linalg.qr(np.random.default_rng(_SEED).standard_normal((size, size)))[0]


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated rows, and their correction factors."""
    rotated = units @ rotation(units.shape[1])
    return np.packbits(rotated >= 0, axis=1), np.abs(rotated).sum(axis=1) / np.sqrt(units.shape[1])


def with_codes(rows: DataFrame) -> DataFrame:
    """Adds ``code`` and ``factor`` to (label, size, node, copies, vector)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                codes, factors = encode(unit_vectors(_matrix(part.column("vector"))))
                columns = [*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factors)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "code", "factor"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(add, f"{kinds}, code binary, factor double")


def _matrix(lists) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _strips(units, codes, factors, tile, across: bool, threshold: float):
    """Linked pairs (i < j) of one cell, strip by strip: estimates first, then double precision."""
    n, size = units.shape
    signs = np.unpackbits(codes, axis=1)[:, :size].astype(np.float32) * 2 - 1
    signs /= np.float32(np.sqrt(size))
    rotated = (units @ rotation(size)).astype(np.float32)
    missed = np.sqrt(np.maximum(0, 1 - factors**2) * max(0.0, 1 - threshold**2))
    bound = (threshold * factors - missed - _SLACK).astype(np.float32)
    for a in range(0, n, _STRIP):
        estimate = signs[a : a + _STRIP] @ rotated[a:].T
        i, j = np.nonzero(estimate >= bound[a : a + _STRIP, None])
        i, j = i + a, j + a
        keep = (i < j) & (not across or tile[i] != tile[j])
        i, j = i[keep], j[keep]
        exact = np.concatenate(
            [np.einsum("ij,ij->i", units[i[k : k + 65_536]], units[j[k : k + 65_536]]) for k in range(0, len(i), 65_536)]
            or [np.empty(0)]
        )
        linked = exact >= threshold
        yield i[linked], j[linked]


def _cell_task(threshold: float):
    def compare(cell: pa.Table) -> pa.Table:
        nodes, copies = cell["node"].to_numpy(), cell["copies"].to_numpy()
        codes = np.frombuffer(b"".join(cell["code"].to_pylist()), np.uint8).reshape(len(nodes), -1)
        across = cell["low"][0].as_py() != cell["high"][0].as_py()
        forest, partners = Forest(len(nodes)), np.zeros(len(nodes), np.int64)
        units = unit_vectors(_matrix(cell["vector"]))
        for i, j in _strips(units, codes, cell["factor"].to_numpy(), cell["tile"].to_numpy(), across, threshold):
            np.add.at(partners, i, copies[j])
            np.add.at(partners, j, copies[i])
            forest.join(i, j)
        met = np.flatnonzero(partners)
        return pa.table(
            {"node": nodes[met], "partners": partners[met], "root": nodes[forest.root[met]]},
            schema=pa.schema([("node", pa.int64()), ("partners", pa.int64()), ("root", pa.int64())]),
        )

    return compare


def near_vectors(
    vectors: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per vector: ``key``, n_links, component_id, kept.

    Vectors of one label and size link at a cosine of ``threshold`` (over 0) or more, in double precision. Rows whose
    vector is null, empty, zero or holds null or non-finite numbers, or whose label or key is null, link with nothing; they are their
    own component. Equal vectors are one node with its number of copies, which count as links; keys are
    expected to be unique, and rows that share one are one node. Only counts and spanning forests leave a task.
    """
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole &= F.exists(vector, lambda x: x != 0)
    rows = vectors.select(
        F.col(key).alias("id"),
        F.when(F.coalesce(whole, F.lit(False)) & F.col(key).isNotNull(), F.col(label)).alias("label"),
        F.transform(vector, lambda x: x.cast("double")).alias("vector"),
    )
    apart = rows.where("label is null").select("id")
    rows = rows.where("label is not null")
    nodes = rows.groupBy("label", "vector").agg(
        F.min("id").cast("long").alias("node"), F.count(F.lit(1)).alias("copies")
    )
    shaped = nodes.select("label", F.size("vector").alias("size"), "node", "copies", "vector")
    cells = spread_cells(with_codes(shaped), ["label", "size"], "node", TILE_ROWS)
    found = cells.groupBy("label", "size", "low", "high").applyInArrow(
        _cell_task(threshold), "node long, partners long, root long"
    )
    found = written(found, f"{scratch_folder(vectors.sparkSession, 'vectors')}/links")
    named = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("partners").alias("partners"))
    linked = nodes.join(counts, "node", "left").join(named, "node", "left").select(
        F.col("label"),
        "vector",
        (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    kind = vectors.schema[key].dataType
    out = rows.join(linked, ["label", "vector"]).select("id", "n_links", F.col("component_id").cast(kind).alias("component_id"))
    alone = apart.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(key), "n_links", "component_id", kept.alias("kept"))
