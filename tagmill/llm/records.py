"""Token ids as files of length-delimited binary records, with an offset index for reads in any order.

File: ``TOKREC01``, then one record per document: the payload's length (unsigned 64-bit), the masked checksum of
those eight bytes, the payload, the masked checksum of the payload (32 bits each; little-endian throughout).
Payload: bytes per id (2 or 4) as one byte, then the ids. A checksum is CRC-32, rotated right by 15 bits and
shifted by a constant, so that records which hold records keep telling checksums.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tagmill.session import scratch_folder, written

from .encoders import definition_of, text_encoder

MAGIC = b"TOKREC01"
_MASK = 0xA282EAD8  # fixed value: the constant that masked record checksums add
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + _TAIL.pack(masked(length)) + payload + _TAIL.pack(masked(payload))


def unframe(record: bytes) -> bytes:
    """The payload of one record; a broken one is an error."""
    length, check = _HEAD.unpack_from(record)
    payload = record[_HEAD.size : _HEAD.size + length]
    if masked(record[:8]) != check or len(record) != _HEAD.size + length + _TAIL.size:
        raise ValueError("broken record length")
    if _TAIL.unpack_from(record, _HEAD.size + length)[0] != masked(payload):
        raise ValueError("broken record")
    return payload


def opened(folder: str):
    """The file system and path of a folder that tasks write to or read from."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if re.match("[A-Za-z][A-Za-z0-9+.-]*:/", folder) else (fs.LocalFileSystem(), folder)


def write_records(
    docs: DataFrame, tokenizer_path: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int = 1
) -> DataFrame:
    """Encode all texts, append ``end_id`` to each and write them in ascending order of ``key``.

    Returns the index, stored beside the files: ``key``, file, part, offset, size, start (ids of all documents
    before it), n_tokens. Null keys come first; rows of one key go by text, equal rows stay apart; null texts are empty. A task
    writes its own file and names it in the index; files of lost or repeated attempts are not named there.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(definition_of(tokenizer_path))
    ordered = docs.select(F.col(key), F.col(text).alias("text"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = ordered.repartitionByRange(tasks, key).sortWithinPartitions(key, "text")
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("file", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("before", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = text_encoder(definition.value), TaskContext.get().partitionId()
        width = encoder.dtype.itemsize
        end, lead = np.array([end_id], encoder.dtype).tobytes(), bytes([width])
        name = f"records-{part:06d}-{uuid.uuid4().hex}.bin"
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        at, ids_before = len(MAGIC), 0
        with store.open_output_stream(f"{path}/{name}") as out:
            out.write(MAGIC)
            for batch in batches:
                offset, size, before, count = [], [], [], []
                for packed in encoder.encode(batch.column(1).to_pylist()):
                    record = frame(lead + packed + end)
                    out.write(record)
                    offset.append(at)
                    size.append(len(record))
                    before.append(ids_before)
                    count.append(len(packed) // width + 1)
                    at += len(record)
                    ids_before += count[-1]
                n = len(offset)
                columns = [batch.column(0), pa.array([name] * n, pa.string()), pa.array([part] * n, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (offset, size, before, count)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    rows = written(ordered.mapInArrow(write, T.StructType(fields)), f"{folder}/attempts")
    # One row per file, so a window over all of them is small: as many as tasks have written.
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    before = F.sum("_total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = files.select("part", F.coalesce(before, F.lit(0)).alias("_base"))
    index = rows.join(F.broadcast(bases), "part").select(
        key, "file", "part", "offset", "size", (F.col("before") + F.col("_base")).alias("start"), "n_tokens"
    )
    return written(index, f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of ``index`` name, in any selection and order, checked against their
    checksums: all columns of the index and ``ids``, little-endian unsigned 32-bit numbers."""
    schema = T.StructType([*index.schema.fields, T.StructField("ids", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        name, source = None, None
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "size")))
            ids, first, held = [], 0, 0
            for k, (file, offset, size) in enumerate(places):
                if file != name:
                    if source:
                        source.close()
                    name, source = file, store.open_input_file(f"{path}/{file}")
                payload = unframe(source.read_at(size, offset))
                ids.append(np.frombuffer(payload, f"<u{payload[0]}", offset=1).astype("<u4").tobytes())
                held += len(ids[-1])
                if held > 32 << 20 or k == batch.num_rows - 1:
                    part = batch.slice(first, len(ids))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], schema.names)
                    ids, first, held = [], k + 1, 0
        if source:
            source.close()

    return index.mapInArrow(read, schema)


def token_records(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write all documents to a fresh folder in the shared scratch space and read every record back."""
    folder = scratch_folder(docs.sparkSession, "records")
    return read_records(write_records(docs, tokenizer_path, folder, **options), folder)
