"""Encoding through a table of distinct words, and decoding through a join of ids with pieces.

Texts are dealt into blocks. Each block names its distinct words; the words meet by value, so each is encoded
once, and its ids are joined with (id, piece) once; both go back to the blocks that named the word, where every
position of every text looks them up. A word comes at most once from a block, so no word is a hot key, and blocks are
dealt by a hash of the whole row. Texts and looked-up words travel in compressed bundles; a task reads the words of a
block, then its texts, as one stream, and holds no more than the words of one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encoders import WordEncoder, definition_of, grouped, pieces_by_id, release_memory

BLOCK_CHARS = 24_000_000  # layout only: results do not depend on it
_GROUP_CHARS = 250_000
_BUNDLED_ROWS = 5_000
_BUNDLED_WORDS = 200_000
_BUNDLE, _BUNDLE_SHAPE = ["block", "kind", "rows"], "block int, kind int, rows binary"
_SPACES = re.compile("[\x20\x09-\x0D]+")
_SPREAD = 3  # partitions per block, so that few blocks share a task


def _packed(batch: pa.RecordBatch) -> bytes:
    """A batch as one compressed value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(value) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


def packed_blocks(docs: DataFrame, key: str, text: str, blocks: int, parts: int) -> DataFrame:
    """(block, kind, rows): documents in compressed bundles, those of a block in one of ``parts`` partitions, kind 1."""
    rows = docs.select(
        F.pmod(F.xxhash64(key, text), F.lit(blocks)).cast("int").alias("block"),
        F.col(key).alias("key"),
        F.col(text).alias("text"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()  # of what an earlier task of this worker has left
        for whole in batches:
            yield from (bundled(whole.slice(a, _BUNDLED_ROWS)) for a in range(0, whole.num_rows, _BUNDLED_ROWS))
            release_memory()

    def bundled(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = pa.Table.from_batches([batch]).sort_by("block")
        block = table["block"].to_numpy()
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else []
        bundles = [
            _packed(table.slice(a, b - a).select(["key", "text"]).combine_chunks().to_batches()[0])
            for a, b in zip(cuts, cuts[1:])
        ]
        kinds = pa.array(np.ones(len(bundles), np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[cuts[:-1]] if bundles else [], pa.int32()), kinds, pa.array(bundles, pa.binary())], _BUNDLE
        )

    return rows.mapInArrow(pack, _BUNDLE_SHAPE).repartition(parts, "block")


def table_words(encoder: WordEncoder, texts: list[str]) -> list[list[str]]:
    """The words of every text. Where only the library can tell, a text is cut at ASCII white space, as no token has any, and
    only pieces that hold such characters are words as they stand."""
    out = encoder.words_of(texts)
    for k, words in enumerate(out):
        if words is None:
            out[k] = []
            for part in _SPACES.split(texts[k]):
                out[k] += [part] if encoder.needs_library(part) else encoder.pattern_words(part)
    return out


def block_words(bundles: DataFrame, definition) -> DataFrame:
    """(word, block): the distinct words of every block."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, found = WordEncoder(definition.value), {}
        for batch in batches:
            for block, rows in zip(batch.column("block").to_pylist(), batch.column("rows")):
                seen = found.setdefault(block, set())
                for texts in grouped(_unpacked(rows.as_buffer())["text"].to_pylist(), _GROUP_CHARS):
                    seen.update(*table_words(encoder, texts))
        for block, words in found.items():
            words.discard("")
            for part in _slices(sorted(words), 50_000):
                blocks = pa.array(np.full(len(part), block, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), blocks], ["word", "block"])
        found.clear()
        release_memory()

    return bundles.mapInArrow(name, "word string, block int")


def _slices(items: list, size: int) -> Iterator[list]:
    for a in range(0, len(items), size):
        yield items[a : a + size]


def encoded_words(words: DataFrame, definition) -> DataFrame:
    """(word, blocks, ids): each distinct word is encoded once, whatever number of blocks named it."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        encoder, last, blocks = WordEncoder(definition.value), None, []

        def table(words: list[str], named: list[list[int]]) -> pa.RecordBatch:
            packed = [encoder.library(w) if encoder.needs_library(w) else encoder.words.packed(w) for w in words]
            flat = np.frombuffer(b"".join(packed), encoder.dtype).astype(np.int32)
            ends = np.cumsum([0, *(len(p) // encoder.dtype.itemsize for p in packed)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            columns = [pa.array(words, pa.string()), pa.array(named, pa.list_(pa.int32())), ids]
            return pa.RecordBatch.from_arrays(columns, ["word", "blocks", "ids"])

        for batch in batches:
            done, named = [], []
            for word, block in zip(batch.column("word").to_pylist(), batch.column("block").to_pylist()):
                if word != last:
                    if last is not None:
                        done.append(last)
                        named.append(blocks)
                    last, blocks = word, []
                blocks.append(block)
            yield table(done, named)
        if last is not None:
            yield table([last], [blocks])
        encoder, done, named, batch = None, [], [], None
        release_memory()

    dealt = words.repartition("word").sortWithinPartitions("word")
    return dealt.mapInArrow(encode, "word string, blocks array<int>, ids array<int>")


def word_bundles(table: DataFrame, pieces: DataFrame, parts: int) -> DataFrame:
    """(block, kind, rows): the rows (word, blocks, ids) of every block with their ``decoded`` text in compressed bundles,
    kind 0. Ids are joined with ``pieces``, and one worker puts lists together and bundles them."""
    met, together, _ = _piece_rows(table, pieces, "ids", "decoded")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in together(batches):
            row, names = batch.column("row"), [f.name for f in batch.column("row").type]
            held.append(pa.RecordBatch.from_arrays([*row.flatten(), batch.column("decoded")], [*names, "decoded"]))
            if sum(b.num_rows for b in held) >= _BUNDLED_WORDS:
                yield bundled(pa.Table.from_batches(held))
                held = []
        if held:
            yield bundled(pa.Table.from_batches(held))
            held = []
        release_memory()

    def bundled(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        lists = table["blocks"].combine_chunks()
        block, row = lists.flatten().to_numpy(), lists.value_parent_indices().to_numpy()
        order = np.argsort(block, kind="stable")
        block, row = block[order], row[order]
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else np.zeros(1, np.int64)
        rows = table.select(["word", "ids", "decoded"])
        bundles = [_packed(rows.take(pa.array(row[a:b])).combine_chunks().to_batches()[0]) for a, b in zip(cuts, cuts[1:])]
        kinds = pa.array(np.zeros(len(bundles), np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[cuts[:-1]] if bundles else [], pa.int32()), kinds, pa.array(bundles, pa.binary())], _BUNDLE
        )

    return met.mapInArrow(pack, _BUNDLE_SHAPE).repartition(parts, "block")


def encode_by_table(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``key``, ``ids`` (array of int) as the tokenizer encodes the text without special ids, and ``decoded``, the ids'
    pieces joined by spaces, of every row.

    Null and empty texts have no ids; null keys, repeated keys and repeated rows give a row each.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(definition_of(tokenizer_path))
    total = docs.agg(F.sum(F.length(text))).first()[0] or 0
    blocks = max(spark.sparkContext.defaultParallelism, -(-total // block_chars))
    parts = _SPREAD * blocks
    bundles = packed_blocks(docs, key, text, blocks, parts)
    table = encoded_words(block_words(bundles, definition), definition)
    words = word_bundles(table, vocabulary(spark, tokenizer_path), parts)
    shape = [T.StructField(key, docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*shape, T.StructField("decoded", T.StringType())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, ids, decoded = WordEncoder(definition.value), None, {}, {}
        for batch in batches:
            for at, kind, rows in zip(*(batch.column(c).to_pylist() for c in ("block", "kind")), batch.column("rows")):
                if at != block:
                    ids.clear()
                    decoded.clear()
                    release_memory()
                    block, ids[""] = at, b""
                bundle = _unpacked(rows.as_buffer())
                if kind == 0:
                    words, lists = bundle["word"].to_pylist(), bundle["ids"].combine_chunks()
                    flat, ends = lists.values.to_numpy().astype(encoder.dtype), lists.offsets.to_numpy()
                    ids.update((w, flat[a:b].tobytes()) for w, a, b in zip(words, ends[:-1], ends[1:]))
                    decoded.update(zip(words, bundle["decoded"].to_pylist()))
                    continue
                first = 0
                for group in grouped(bundle["text"].to_pylist(), _GROUP_CHARS):
                    part, first = bundle.slice(first, len(group)), first + len(group)
                    words = table_words(encoder, group)
                    # A word that its block has not got is an error: its bundles would stand in another partition.
                    packed = [b"".join(map(ids.__getitem__, found)) for found in words]
                    texts = [" ".join(filter(None, map(decoded.get, found))) for found in words]
                    flat = np.frombuffer(b"".join(packed), encoder.dtype).astype(np.int32)
                    ends = np.cumsum([0, *(len(p) // encoder.dtype.itemsize for p in packed)], dtype=np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                    yield pa.RecordBatch.from_arrays(
                        [part["key"].combine_chunks(), lists, pa.array(texts, pa.string())], schema.names
                    )
        ids, decoded = {}, {}
        release_memory()

    # Both sides are dealt by block into equally many partitions, which a union puts together without a shuffle.
    stream = words.unionByName(bundles).sortWithinPartitions("block", "kind")
    return stream.mapInArrow(gather, schema)


def vocabulary(spark, tokenizer_path: str) -> DataFrame:
    """(id, piece): as many rows as the tokenizer has pieces."""
    pieces = pieces_by_id(definition_of(tokenizer_path))
    return spark.createDataFrame(list(enumerate(pieces)), "id int, piece string")


def decode_ids(encoded: DataFrame, pieces: DataFrame, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the text of ``ids``: their pieces joined by spaces, as tokenizers without a decoder do. Null stays null.

    Every id is a row that is joined with (id, piece), a table as large as the tokenizer file, which is broadcast; the
    rows of a list stay side by side, so they are put together again without a shuffle. An id that is no
    piece's is an error. A column ``to`` is replaced.
    """
    met, together, schema = _piece_rows(encoded, pieces, ids, to)
    return met.mapInArrow(together, schema).select("row.*", to)


def _piece_rows(encoded: DataFrame, pieces: DataFrame, ids: str, to: str):
    """Rows (row, place, id, piece), the function that makes rows (row, ``to``) of them again, and their schema."""
    kept = [c for c in encoded.columns if c != to]
    rows = encoded.select(F.struct(*kept).alias("row"), F.posexplode_outer(ids).alias("place", "id"))
    place = F.coalesce("place", F.lit(0))
    known = F.broadcast(pieces.select(F.col("id").alias("piece_id"), "piece"))
    met = rows.join(known, F.col("id") == F.col("piece_id"), "left").select(
        F.when(place == 0, F.col("row")).alias("row"), place.alias("place"), "id", "piece"
    )
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField(to, T.StringType())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, held, last = None, [], -1  # the list that the last batch ended in
        for batch in batches:
            places, found = batch.column("place").to_numpy(), batch.column("piece").to_pylist()
            if not len(places):
                continue
            if (batch.column("piece").is_null().to_numpy(False) & batch.column("id").is_valid().to_numpy(False)).any():
                raise ValueError("an id that is no piece's")
            if not ((places == 0) | (places == np.r_[last, places[:-1]] + 1)).all():
                raise RuntimeError("the ids of a list came apart")
            starts = np.flatnonzero(places == 0).tolist()
            held += found[: starts[0]] if starts else found
            if starts:
                if row is not None:
                    yield joined(row, [held])
                lists = [found[a:b] for a, b in zip(starts, starts[1:])]
                if lists:
                    yield joined(batch.column("row").take(pa.array(starts[:-1])), lists)
                row, held = batch.column("row").slice(starts[-1], 1), found[starts[-1] :]
            last = int(places[-1])
        if row is not None:
            yield joined(row, [held])

    def joined(rows: pa.Array, lists: list[list]) -> pa.RecordBatch:
        at = rows.type.get_field_index(ids)
        empty = rows.flatten()[at].is_null().to_pylist()
        texts = [None if e else " ".join(p for p in found if p is not None) for e, found in zip(empty, lists)]
        return pa.RecordBatch.from_arrays([rows, pa.array(texts, pa.string())], ["row", to])

    return met, gather, schema
