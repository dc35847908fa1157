"""Best-fit packing of tokenised documents, certified by lower bounds from dual feasible functions.

Only lengths decide a packing, so packing moves one small row per piece and never ids. Pieces are dealt so that all
partitions hold the same mix of lengths. Each partition packs
its pieces by best-fit decreasing and compares its number of sequences with a lower bound. Sequences that
could still be improved (in proportion to the gap, and the one that is filled least) give their pieces back;
those pieces are dealt to as many partitions as they fill and packed again, as long as that saves sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.session import scratch_folder, written

from .encoders import definition_of, text_encoder

# Layout only: any value gives a packing of all pieces.
PIECES_PER_TASK = 100_000
_GIVEN_BACK = 4


def tokenized_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    limit: int = 1024,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: ``key``, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its ids and ``end_id``; null and empty texts are the end id alone. One longer than ``limit`` is
    cut into pieces of that length, the first of which may be shorter. ``ids_crc32`` covers the ids as
    little-endian unsigned 32-bit numbers; ``ids`` is that binary form.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(definition_of(tokenizer_path))
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    fields += [T.StructField("ids", T.BinaryType())] if with_ids else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = text_encoder(definition.value), np.array([end_id], "<u4")
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            packed = encoder.encode(batch.column(1).to_pylist())
            for k, raw in enumerate(packed):
                ids = np.concatenate([np.frombuffer(raw, encoder.dtype).astype("<u4"), tail])
                cuts = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)]
                data = memoryview(ids).cast("B")
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(k)
                    piece.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a : 4 * b]))
                    if with_ids:
                        kept.append(bytes(data[4 * a : 4 * b]))
            columns = [batch.column(0).take(pa.array(row, pa.int64()))]
            columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            columns += [pa.array(kept, pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return rows.mapInArrow(cut, T.StructType(fields))


def lower_bound(lengths: np.ndarray, limit: int) -> int:
    """Sequences that any packing needs: the best of two families of dual feasible functions.

    One counts lengths over ``limit - t`` whole and drops those under ``t``; the other rounds (k + 1) x / limit
    down, except where that is whole. The plain sum is the first with t = 0.
    """
    count = np.bincount(lengths, minlength=limit + 1).astype(np.int64)
    size = np.arange(limit + 1, dtype=np.int64)
    best = 0
    for t in range(limit // 2 + 1):
        value = np.where(size > limit - t, limit, np.where(size < t, 0, size))
        best = max(best, -(-int(count @ value) // limit))
    for k in range(1, 64):
        whole = size * (k + 1) % limit == 0
        value = np.where(whole, size * k, size * (k + 1) // limit * limit)  # in units of 1 / (k limit)
        best = max(best, -(-int(count @ value) // (k * limit)))
    return best


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> np.ndarray:
    """The sequence of every length; ``lengths`` must not increase. Rooms that occur are bits of one number."""
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms, used, out = 0, 0, np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            open_ = by_room[room]
            chosen = open_.pop()
            if not open_:
                rooms &= ~(1 << room)
        else:
            room, chosen, used = limit, used, used + 1
        left = room - size
        if left:
            by_room[left].append(chosen)
            rooms |= 1 << left
        out[i] = chosen
    return out


def _pack_task(limit: int, turn: int, columns: list[str]):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        whole = pa.Table.from_batches(parts)
        for hand in sorted(whole["_hand"].unique().to_pylist()):
            yield from pack_hand(whole.filter(pc.equal(whole["_hand"], hand)).combine_chunks(), hand)

    def pack_hand(table: pa.Table, hand: int) -> Iterator[pa.RecordBatch]:
        order = [("length", "descending")] + [(c, "ascending") for c in columns if c != "length"]
        table = table.sort_by(order)  # alike after a retry, whatever order the rows came in
        lengths = table["length"].to_numpy()
        chosen = best_fit_decreasing(lengths, limit)
        number = int(chosen.max()) + 1
        filled = np.bincount(chosen, weights=lengths, minlength=number).astype(np.int64)
        gap = number - lower_bound(lengths, limit)  # certified: no packing of these pieces saves more
        back = np.zeros(number, bool)
        if gap > 0:
            back[np.argsort(filled, kind="stable")[: 1 + _GIVEN_BACK * gap]] = True
            back &= filled < limit
        by_bin = np.argsort(chosen, kind="stable")
        ends = np.cumsum(lengths[by_bin])
        first = np.ones(len(ends), bool)
        first[1:] = chosen[by_bin][1:] != chosen[by_bin][:-1]
        starts = ends - lengths[by_bin]
        offset, opens = np.empty(len(ends), np.int64), np.empty(len(ends), bool)
        offset[by_bin] = starts - np.maximum.accumulate(np.where(first, starts, 0))
        opens[by_bin] = first
        sequence = pa.array(chosen + ((turn << 56) + (hand << 32)))
        out = table.select(columns).append_column("sequence_id", sequence).append_column("offset", pa.array(offset))
        out = out.append_column("_opens", pa.array(opens)).append_column("_back", pa.array(back[chosen]))
        yield from out.to_batches()

    return pack


def _deal(hands: int, columns: list[str]):
    """Every task deals its pieces by length, one to each hand in turn, so that all hands are alike."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            table = pa.Table.from_batches(parts)
            table = table.sort_by([("length", "ascending")] + [(c, "ascending") for c in columns if c != "length"])
            turn = (np.arange(table.num_rows) + TaskContext.get().partitionId()) % hands
            yield from table.append_column("_hand", pa.array(turn.astype(np.int32))).to_batches()

    return deal


def pack_pieces(pieces: DataFrame, limit: int = 1024, turns: list[dict] | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (columns ``length``, at most ``limit``, and any others).

    Every piece gets a place: sequences are gapless from 0 and hold at most ``limit``. Equal rows are separate
    pieces. An empty table gives an empty one. Numbers of sequences are unique but otherwise arbitrary.

    Tasks whose number of sequences is above their bound give their emptiest ones back; these pieces are dealt anew to as
    many tasks as their count needs, about ``PIECES_PER_TASK`` to each, and packed again.
    Turns end when nothing came back or when one saved no sequence; the places of the turn before then stay. A list
    given as ``turns`` receives the pieces, tasks and sequences of every turn.
    """
    spark, folder = pieces.sparkSession, scratch_folder(pieces.sparkSession, "packing")
    placed = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    marks = [T.StructField("_opens", T.BooleanType()), T.StructField("_back", T.BooleanType())]
    schema = T.StructType([*pieces.schema.fields, *placed, *marks])
    hands = T.StructType([*pieces.schema.fields, T.StructField("_hand", T.IntegerType())])
    opens, back = F.col("_opens").cast("long"), F.col("_back").cast("long")
    seen, turns = Observation(), [] if turns is None else turns
    left = written(pieces, f"{folder}/pieces", seen, F.count(F.lit(1)).alias("rows"))
    rows, before, turn, done, last = seen.get["rows"], None, 0, [], None
    while True:
        tasks = max(1, -(-rows // PIECES_PER_TASK))
        if tasks > 1:
            dealt = left.mapInArrow(_deal(tasks, pieces.columns), hands).repartition(tasks, "_hand")
        else:
            dealt = left.withColumn("_hand", F.lit(0)).coalesce(1)
        seen = Observation()
        packed = written(
            dealt.mapInArrow(_pack_task(limit, turn, pieces.columns), schema), f"{folder}/turn_{turn}", seen,
            F.coalesce(F.sum(opens), F.lit(0)).alias("used"), F.coalesce(F.sum(back), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(opens * back), F.lit(0)).alias("returned"),
        )
        found = seen.get
        turns.append({"rows": rows, "tasks": tasks, "sequences": found["used"]})
        if before is not None and found["used"] >= before:
            done.append(last)  # this turn saved nothing
            break
        if last is not None:
            done.append(last.where("not _back"))
        if tasks == 1 or not found["rows"]:
            done.append(packed)
            break
        left, last = packed.where("_back").select(*pieces.columns), packed
        rows, before, turn = found["rows"], found["returned"], turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, limit: int = 1024, **options) -> DataFrame:
    """``tokenized_pieces`` and ``pack_pieces`` in one: the pieces of all documents with their places."""
    return pack_pieces(tokenized_pieces(docs, tokenizer_path, limit=limit, **options), limit)
