"""Tag confidence: mutual reinforcement between users and (subject, tag) pairs.

User scores are the main eigenvector of E Eᵀ, where E counts how often a user gave a tag to a subject. Plain rounds reach
it slowly where groups of users hardly meet, so it is found by a three-term recurrence: each round applies E Eᵀ to the
residual only, and the next scores are the best mix of scores, residual and last step (the locally optimal
conjugate gradient method of Knyazev, 2001). All inner products are observed while a round is written, one reduction.

Edges are bundled once: a block holds all edges of its subjects, a part all scores of its users, and lists say which users a
block asks a part for. A round sends those scores, applies both E and Eᵀ inside the block, and sends sums back in the same
order, so what moves is one number each way per user and block, without keys. Hubs too large for a block are cut by user;
their sums over all cuts are read by the driver first.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import normalize_tag, strip_nul
from ..session import Progress, rows_written, scratch_folder, shuffle_partitions, written
from .subjects import known_only

# Fixed value: rounds stop when the scores of the users move less than this. Here it bounds the residual of the
# eigenvector by its length, and so the step of a plain round in sum-one scores as well.
TOLERANCE = 1e-6
# Edges of a block, and edges whose users make a part, about; layout only.
BLOCK_EDGES = 1_000_000
PART_EDGES = 4_000_000
_VECTORS = ("x", "bx", "p", "bp", "r", "br")
_PRODUCTS = ("xx", "rr", "pp", "xr", "xp", "rp")
_SENT = "part int, block int, data binary"


def raw_tags(records: DataFrame, archive: DataFrame | None = None) -> DataFrame:
    """One row per user, subject and tag as given, without NUL: ``user_id, subject_id, tags``."""
    if archive is not None:
        records = known_only(records, archive, "subject_id", "id")
    return (
        records.select("user_id", "subject_id", F.explode("tags").alias("tags"))
        .where(F.col("tags").isNotNull())
        .withColumn("tags", strip_nul("tags"))
    )


def tag_rows(
    records: DataFrame, archive: DataFrame | None = None, mapping: Mapping[str, str] | None = None
) -> DataFrame:
    """``raw_tags`` with ``tags_normalized``."""
    return raw_tags(records, archive).withColumn("tags_normalized", normalize_tag("tags", mapping))


def tag_edges(
    rows: DataFrame, user: str = "user_id", subject: str = "subject_id", tag: str = "tags_normalized"
) -> DataFrame:
    """Weighted edges: how often a user gave a normalised tag to a subject. Null keys are dropped."""
    return (
        rows.dropna(subset=[user, subject, tag])
        .groupBy(user, subject, tag)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _large(edges: DataFrame, key: str, rows: int, blocks: int) -> list:
    """Keys with more than ``1/blocks`` of the rows, fewer than ``blocks`` by counting, and the blocks they would fill."""
    n = F.col("_n") * blocks
    counts = edges.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(n > rows)
    return counts.select(key, F.ceil(n / rows).cast("int").alias("_slots")).collect()


def _dealt(edges: DataFrame, rows: int, blocks: int) -> tuple[DataFrame, dict[int, int]]:
    """Edges (name, subject, tag, n) with their ``block``, and the blocks of cut hubs, each with the first of its hub.

    Subjects stay together; the hubs of a large subject are dealt one by one, and a large hub by its users.
    """
    hub, user = F.struct("subject", "tag"), F.xxhash64("name")
    edges = edges.withColumn("_subject", F.struct("subject"))  # a struct is never null, so null keys meet in joins
    whole = F.pmod(F.xxhash64("subject"), F.lit(blocks))
    large = _large(edges, "_subject", rows, blocks) if rows else []
    if not large:
        return edges.select("name", "subject", "tag", "n", whole.cast("int").alias("block")), {}
    names = edges.sparkSession.createDataFrame(large, T.StructType([edges.schema["_subject"], T.StructField("_slots", T.IntegerType())]))
    edges = edges.join(F.broadcast(names), "_subject", "left").withColumn("_hub", hub)
    block = F.when(F.col("_slots").isNull(), whole).otherwise(F.pmod(F.xxhash64("subject", "tag"), F.lit(blocks)))
    cut, first, at = {}, [], blocks
    for key, slots in _large(edges.where(F.col("_slots").isNotNull()), "_hub", rows, blocks):
        first.append((key, at, slots))
        cut |= dict.fromkeys(range(at, at + slots), at)
        at += slots
    if first:
        shape = T.StructType([edges.schema["_hub"], T.StructField("_first", T.IntegerType()), T.StructField("_cuts", T.IntegerType())])
        edges = edges.join(F.broadcast(edges.sparkSession.createDataFrame(first, shape)), "_hub", "left")
        block = F.when(F.col("_first").isNull(), block).otherwise(F.col("_first") + F.pmod(user, F.col("_cuts")))
    return edges.select("name", "subject", "tag", "n", block.cast("int").alias("block")), cut


def _encoded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    found = pa.chunked_array([column.combine_chunks()]).dictionary_encode("encode").chunk(0)
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _lists(values: pa.Array, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _bundled(schema: pa.Schema, whole: bool):
    """The edges of a block in order of hub, with users as places in the block; then, for each part, the users asked for."""

    def bundle(edges: pa.Table) -> pa.Table:
        user, names = _encoded(edges["name"])
        part = np.zeros(len(names), np.int64)
        part[user] = edges["part"].to_numpy()
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        subject, subjects = _encoded(edges["subject"])
        tag, tags = _encoded(edges["tag"])
        keys, hub = np.unique(subject * len(tags) + tag, return_inverse=True)
        by_hub = np.argsort(hub, kind="stable")
        starts = np.searchsorted(hub[by_hub], np.arange(len(keys)))
        n = edges["n"].fill_null(0).to_numpy()[by_hub]
        if whole and n.min() >= 0:
            n = n.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if n.max() <= np.iinfo(t).max))
        parts, firsts = np.unique(part[order], return_index=True)
        rows, nothing = len(parts) + 1, [b""] * len(parts)
        ends = np.full(rows + 1, len(keys))
        ends[0] = 0
        columns = {
            "block": pa.array([edges["block"][0].as_py()] * rows),
            "part": pa.array([-1, *parts.tolist()]),
            "users": _lists(names.take(pa.array(order)), np.array([0, *firsts, len(order)])),
            "subjects": _lists(subjects.take(pa.array(keys // len(tags))), ends),
            "tags": _lists(tags.take(pa.array(keys % len(tags))), ends),
            "starts": pa.array([starts.astype(np.int64).tobytes(), *nothing]),
            "places": pa.array([place[user[by_hub]].tobytes(), *nothing]),
            "counts": pa.array([n.tobytes(), *nothing]),
        }
        return pa.table(columns).cast(schema)

    return bundle


def _asked(schema: pa.Schema):
    """For each block, which scores of a part it asks for; then the part's users and their first vectors."""

    def ask(lists: pa.Table) -> pa.Table:
        lists = lists.sort_by("block")
        bounds = np.cumsum([0, *lists["users"].combine_chunks().value_lengths().to_pylist()])
        at, names = _encoded(pa.chunked_array([lists["users"].combine_chunks().flatten()]))
        at = at.astype(np.int32)
        data = [at[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]
        first = np.zeros((len(_VECTORS), len(names)))
        first[_VECTORS.index("r")] = 1.0
        columns = {
            "part": pa.array([lists["part"][0].as_py()] * (len(data) + 1)),
            "block": pa.array([*lists["block"].to_pylist(), -1]),
            "data": pa.array([*data, first.tobytes()]),
            "users": _lists(names, np.array([0] * (len(data) + 1) + [len(names)])),
        }
        return pa.table(columns).cast(schema)

    return ask


def _send(vector):
    """To every block the scores that it asks a part for; ``vector`` makes them from what the part stored."""

    def send(asks: pa.Table, stored: pa.Table) -> pa.Table:
        scores = vector(np.frombuffer(stored["data"][0].as_py()))
        data = [scores[np.frombuffer(at, np.int32)].tobytes() for at in asks["data"].to_pylist()]
        return pa.table({"part": asks["part"], "block": asks["block"], "data": pa.array(data, pa.binary())})

    return send


def _block(bundle: pa.Table, sent: pa.Table, whole: bool):
    """A block's scores by place, its starts, places and counts, and how many scores each part sent."""
    scores = [np.frombuffer(d) for d in sent["data"].to_pylist()]
    starts, places = np.frombuffer(bundle["starts"][0].as_py(), np.int64), np.frombuffer(bundle["places"][0].as_py(), np.int32)
    raw = bundle["counts"][0].as_py()
    kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64 if whole else np.float64}
    return np.concatenate(scores), starts, places, np.frombuffer(raw, kinds[len(raw) // len(places)]), [len(s) for s in scores]


def _meet(whole: bool, sums: dict[int, float]):
    """What the users of a block receive: the sums of their hubs. Those of cut hubs are given."""

    def meet(bundle: pa.Table, sent: pa.Table) -> pa.Table:
        sent, block = sent.sort_by("part"), bundle["block"][0].as_py()
        x, starts, places, n, sizes = _block(bundle, sent, whole)
        hubs = np.array([sums[block]]) if block in sums else np.add.reduceat(n * x[places], starts)
        back = n * np.repeat(hubs, np.diff(starts, append=len(places)))
        back = np.bincount(places, weights=back, minlength=len(x))
        data = [b.tobytes() for b in np.split(back, np.cumsum(sizes)[:-1])]
        return pa.table({"part": sent["part"], "block": sent["block"], "data": pa.array(data, pa.binary())})

    return meet


def _cut_sum(whole: bool, cut: dict[int, int]):
    def total(bundle: pa.Table, sent: pa.Table) -> pa.Table:
        x, _, places, n, _ = _block(bundle, sent.sort_by("part"), whole)
        return pa.table({"first": pa.array([cut[bundle["block"][0].as_py()]], pa.int32()), "sum": pa.array([float((n * x[places]).sum())])})

    return total


def _named_sums(whole: bool, schema: pa.Schema):
    """(subject, tag, confidence, tagnorm_cnt) of a block's hubs."""

    def named(bundle: pa.Table, sent: pa.Table) -> pa.Table:
        x, starts, places, n, _ = _block(bundle, sent.sort_by("part"), whole)
        columns = {c: bundle[f"{c}s"].combine_chunks().flatten() for c in ("subject", "tag")}
        columns["confidence"] = pa.array(np.add.reduceat(n * x[places], starts))
        columns["tagnorm_cnt"] = pa.array(np.add.reduceat(n.astype(np.int64 if whole else np.float64), starts))
        return pa.table(columns).cast(schema)

    return named


def _gather(mixed):
    """What a part stores after a round: its vectors and their inner products."""

    def gather(asks: pa.Table, back: pa.Table) -> pa.Table:
        back = back.sort_by("block")  # the part's own vectors come first, as block -1
        own, *received = back["data"].to_pylist()
        v = dict(zip(_VECTORS, mixed(np.frombuffer(own))))
        v["br"] = np.zeros(len(v["x"]))
        for at, data in zip(asks.sort_by("block")["data"].to_pylist(), received):
            v["br"][np.frombuffer(at, np.int32)] += np.frombuffer(data)
        row = {"part": pa.array([asks["part"][0].as_py()], pa.int32())}
        row["data"] = pa.array([np.concatenate([v[name] for name in _VECTORS]).tobytes()], pa.binary())
        sums = {a + b: v[a] @ v[b] for a, b in _PRODUCTS} | {f"b{a}{b}": v[a] @ v[f"b{b}"] for a, b in _PRODUCTS}
        sums["total"] = np.maximum(v["x"], 0.0).sum()
        return pa.table(row | {name: pa.array([float(value)]) for name, value in sums.items()})

    return gather


def _scored(schema: pa.Schema):
    def scored(users: pa.Table, scores: pa.Table) -> pa.Table:
        score = np.frombuffer(scores["data"][0].as_py())
        return pa.table([users["users"].combine_chunks().flatten(), pa.array(score)], names=schema.names).cast(schema)

    return scored


class _Bundles:
    """Edges bundled by block, lists of what blocks ask parts for, and users by part; ``whole``: counts are integers."""

    def __init__(self, edges: DataFrame, user: str, hub: list[str], folder: str):
        spark, names = edges.sparkSession, {"name": user, "subject": hub[0], "tag": hub[1]}
        self.types = {to: edges.schema[c].dataType for to, c in names.items()}
        self.whole, self.deal = isinstance(edges.schema["n"].dataType, T.IntegralType), shuffle_partitions(spark)
        n = F.col("n").cast("long" if self.whole else "double").alias("n")
        edges, rows = rows_written(edges.select(*[F.col(c).alias(to) for to, c in names.items()], n), f"{folder}/edges")
        cores = spark.sparkContext.defaultParallelism
        parts, blocks = max(cores, rows // PART_EDGES), max(2 * cores, rows // BLOCK_EDGES)
        edges, self.cut = _dealt(edges, rows, blocks)
        edges = edges.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int"))
        lists = [T.StructField(f"{c}s", T.ArrayType(self.types[c])) for c in ("subject", "tag")]
        users = T.StructField("users", T.ArrayType(self.types["name"]))
        place = [T.StructField(c, T.IntegerType()) for c in ("block", "part")]
        binary = [T.StructField(c, T.BinaryType()) for c in ("starts", "places", "counts")]
        shape = T.StructType([*place, users, *lists, *binary])
        bundles = edges.groupBy("block").applyInArrow(_bundled(to_arrow_schema(shape), self.whole), shape)
        bundles = written(bundles, f"{folder}/bundles")
        shape = T.StructType([place[1], place[0], T.StructField("data", T.BinaryType()), users])
        asked = bundles.where("part >= 0").select("part", "block", "users")
        asked = written(asked.groupBy("part").applyInArrow(_asked(to_arrow_schema(shape)), shape), f"{folder}/asks")
        self.named, self.users = bundles.where("part < 0"), asked.where("block < 0").select("part", "users")
        self.start = asked.where("block < 0").select(F.col("part").alias("part"), F.col("data").alias("data"))  # not the columns of asks
        short = self.named.select("block", "starts", "places", "counts")
        self.blocks = short.repartition(self.deal, "block").persist(StorageLevel.MEMORY_AND_DISK)
        self.asks = asked.where("block >= 0").drop("users").repartition(self.deal, "part").persist(StorageLevel.MEMORY_AND_DISK)

    def sent(self, stored: DataFrame, vector) -> DataFrame:
        return self.asks.groupBy("part").cogroup(stored.groupBy("part")).applyInArrow(_send(vector), _SENT)

    def met(self, sent: DataFrame) -> DataFrame:
        """One product with E Eᵀ, as every block has it."""
        sums = {}
        if self.cut:
            open_blocks = self.blocks.where(F.col("block").isin(*self.cut)).groupBy("block")
            some = sent.where(F.col("block").isin(*self.cut)).groupBy("block")
            found = open_blocks.cogroup(some).applyInArrow(_cut_sum(self.whole, self.cut), "first int, sum double")
            totals = dict(found.groupBy("first").agg(F.sum("sum")).collect())
            sums = {block: totals[first] for block, first in self.cut.items() if first in totals}
        return self.blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_meet(self.whole, sums), _SENT)

    def round(self, stored: DataFrame, mixed) -> DataFrame:
        back = self.met(self.sent(stored, lambda data: mixed(data)[_VECTORS.index("r")]))
        own = stored.select("part", F.lit(-1).alias("block"), "data")
        sums = [*_PRODUCTS, *[f"b{ab}" for ab in _PRODUCTS], "total"]
        shape = f"part int, data binary, {', '.join(f'{name} double' for name in sums)}"
        return self.asks.groupBy("part").cogroup(back.union(own).groupBy("part")).applyInArrow(_gather(mixed), shape)

    def user_scores(self, scores: DataFrame, user: str) -> DataFrame:
        shape = T.StructType([T.StructField(user, self.types["name"]), T.StructField("score", T.DoubleType())])
        return self.users.groupBy("part").cogroup(scores.groupBy("part")).applyInArrow(_scored(to_arrow_schema(shape)), shape)

    def hub_sums(self, scores: DataFrame, subject: str, tag: str) -> DataFrame:
        sent = self.sent(scores, lambda data: data)
        count = T.LongType() if self.whole else T.DoubleType()
        types = {"subject": self.types["subject"], "tag": self.types["tag"], "confidence": T.DoubleType(), "tagnorm_cnt": count}
        shape = T.StructType([T.StructField(c, t) for c, t in types.items()])
        found = self.named.groupBy("block").cogroup(sent.groupBy("block"))
        found = found.applyInArrow(_named_sums(self.whole, to_arrow_schema(shape)), shape)
        if self.cut:
            found = found.groupBy("subject", "tag").agg(F.sum("confidence").alias("confidence"), F.sum("tagnorm_cnt").alias("tagnorm_cnt"))
        return found.select(F.col("subject").alias(subject), F.col("tag").alias(tag), "confidence", "tagnorm_cnt")


@contextmanager
def _bundled_edges(edges: DataFrame, user: str, hub: list[str], folder: str):
    bundles = _Bundles(edges, user, hub, folder)
    try:
        yield bundles
    finally:
        bundles.blocks.unpersist()
        bundles.asks.unpersist()


def user_authority(
    edges: DataFrame,
    user: str = "user_id",
    subject: str = "subject_id",
    tag: str = "tags_normalized",
    tol: float = TOLERANCE,
    max_iter: int | None = None,
    rounds: list[float] | None = None,
) -> DataFrame:
    """User scores (sum 1) after the rounds settle: ``user, score``.

    Rounds end when the residual is at most ``tol`` of the eigenvector's length. Groups of users that no tag joins have
    the scores of the strongest group only, the others zero. A list given as ``rounds`` receives the residuals.
    Null users are no users.
    """
    folder = scratch_folder(edges.sparkSession, "authority")
    edges = edges.where(F.col(user).isNotNull())
    with _bundled_edges(edges, user, [subject, tag], folder) as bundles:
        scores = _settle(bundles, tol, max_iter, folder, rounds)
        return written(bundles.user_scores(scores, user), f"{folder}/named")


class _Recurrence:
    """What the driver holds of the recurrence: the weights of scores x, residual r and last step p, and the eigenvalue.

    The small problem is solved on scaled vectors; a direction that others nearly hold is left out.
    """

    def __init__(self):
        self.mix, self.step, self.value = (0.0, 1.0, 0.0), (0.0, 0.0), 0.0

    def turned(self, found: dict) -> None:
        names = [v for v in "xrp" if found[f"{v}{v}"] > 0]
        size = {v: found[f"{v}{v}"] ** 0.5 for v in names}
        both = {frozenset(k): found["".join(sorted(k, key="xrp".index))] for k in ("xx", "rr", "pp", "xr", "xp", "rp")}
        gram = np.array([[both[frozenset((a, b))] / size[a] / size[b] for b in names] for a in names])
        image = np.array([[found[f"b{''.join(sorted(a + b, key='xrp'.index))}"] / size[a] / size[b] for b in names] for a in names])
        values, vectors = np.linalg.eigh(gram)
        sound = values > 1e-10 * values[-1]
        basis = vectors[:, sound] / np.sqrt(values[sound])
        inner, mixes = np.linalg.eigh(basis.T @ image @ basis)
        best = basis @ mixes[:, -1]
        weight = dict.fromkeys("xrp", 0.0) | {v: w / size[v] for v, w in zip(names, best.tolist())}
        sign = -1.0 if (weight["x"] or weight["r"]) < 0 else 1.0
        self.mix, self.value = tuple(sign * weight[v] for v in "xrp"), float(inner[-1])
        # The first scores are the start vector itself and no step.
        self.step = self.mix[1:] if "x" in names else (0.0, 0.0)


def _mixed(mix: tuple, step: tuple, value: float):
    """The vectors of the next round, from what the last one stored."""

    def mixed(data: np.ndarray) -> list[np.ndarray]:
        x, bx, p, bp, r, br = data.reshape(len(_VECTORS), -1)
        now = [mix[0] * own + mix[1] * rest + mix[2] * last for own, rest, last in ((x, r, p), (bx, br, bp))]
        steps = [step[0] * rest + step[1] * last for rest, last in ((r, p), (br, bp))]
        return [*now, *steps, now[1] - value * now[0]]

    return mixed


def _positive_shares(state: DataFrame, total: float) -> DataFrame:
    """(part, data): the scores alone, with sum 1."""

    def shares(batches):
        for batch in batches:
            found = [np.frombuffer(d).reshape(len(_VECTORS), -1)[0] for d in batch["data"].to_pylist()]
            data = pa.array([(np.maximum(x, 0.0) / total).tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["part"], data], names=["part", "data"])

    return state.mapInArrow(shares, "part int, data binary")


def _settle(bundles: _Bundles, tol, max_iter, folder, rounds=None) -> DataFrame:
    """(part, data): scores with sum 1. Only sums are read by the driver; two folders alternate."""
    state, some = bundles.start, not bundles.start.isEmpty()
    at, step, progress = _Recurrence(), 0, Progress("user scores")
    rounds = [] if rounds is None else rounds

    def mixed(data):  # the first vectors are taken as they are
        return list(data.reshape(len(_VECTORS), -1)[:-1])

    while some:
        new = bundles.round(state, mixed)
        seen = Observation()
        sums = [F.sum(name).alias(name) for name in new.columns[2:]]
        state = written(new, f"{folder}/scores-{step % 2}", seen, *sums).select("part", "data")
        found, step = seen.get, step + 1
        if found["xx"]:
            rounds.append((found["rr"] / found["xx"]) ** 0.5 / at.value if at.value else 0.0)
            if rounds[-1] <= tol:
                return _positive_shares(state, found["total"])
            progress.unsettled(rounds[-1], max_iter)
        at.turned(found)
        mixed = _mixed(at.mix, at.step, at.value)
    return state


def vector_distance(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """L2 distance of two score vectors, one row: ``distance``."""
    other = right.select(key, F.col(value).alias("_other"))
    gap = F.col(value) - F.col("_other")
    return left.join(other, key).agg(F.sqrt(F.sum(gap * gap)).alias("distance"))


def normalize_l1(df: DataFrame, value: str) -> DataFrame:
    """Scale a column to sum 1; the total is a one-row table."""
    total = df.agg(F.sum(value).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(value, F.col(value) / F.col("_total")).drop(
        "_total"
    )


def tag_confidence(
    edges: DataFrame,
    user: str = "user_id",
    subject: str = "subject_id",
    tag: str = "tags_normalized",
    tol: float = TOLERANCE,
    max_iter: int | None = None,
) -> DataFrame:
    """``subject, tag, confidence, tagnorm_cnt``: summed scores and number of the hub's tag rows."""
    folder = scratch_folder(edges.sparkSession, "confidence")
    hub = [subject, tag]
    edges = edges.where(F.col(user).isNotNull())
    with _bundled_edges(edges, user, hub, folder) as bundles:
        scores = _settle(bundles, tol, max_iter, folder)
        return written(bundles.hub_sums(scores, subject, tag), f"{folder}/named")


def tag_table(
    records: DataFrame,
    archive: DataFrame,
    mapping: Mapping[str, str] | None = None,
    tol: float = TOLERANCE,
    max_iter: int | None = None,
) -> DataFrame:
    """``iid, tags, tags_normalized, confidence, tag_cnt, tagnorm_cnt``, one row per raw tag.

    Rows are counted per user and tag once; both the edges and the raw tag counts come from that
    smaller table.
    """
    folder = scratch_folder(records.sparkSession, "tags")
    counted = (
        raw_tags(records, archive)
        .where(F.col("subject_id").isNotNull())
        .groupBy("user_id", "subject_id", "tags")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("tags_normalized", normalize_tag("tags", mapping))
    )
    counted = written(counted, f"{folder}/counted")
    edges = (
        counted.where(F.col("user_id").isNotNull())
        .groupBy("user_id", "subject_id", "tags_normalized")
        .agg(F.sum("n").alias("n"))
    )
    hubs = tag_confidence(edges, tol=tol, max_iter=max_iter)
    raw = counted.groupBy("subject_id", "tags", "tags_normalized").agg(
        F.sum(F.when(F.col("user_id").isNotNull(), F.col("n")).otherwise(0)).alias("tag_cnt")
    )
    return raw.join(hubs, ["subject_id", "tags_normalized"]).select(
        F.col("subject_id").alias("iid"),
        "tags",
        "tags_normalized",
        "confidence",
        "tag_cnt",
        "tagnorm_cnt",
    )
