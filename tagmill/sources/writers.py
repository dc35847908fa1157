"""Dated datasets, flat files and feeds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_stamp
from ..session import scratch_folder, shuffle_partitions, written

# Fields of each item file, in order.
ITEM_FIELDS = {
    "user": ("uid", "name", "nickname", "joindate"),
    "record": ("uid", "iid", "typ", "state", "adddate", "rate", "tags", "comment"),
    "subject": (
        "subjectid",
        "subjecttype",
        "subjectname",
        "order",
        "alias",
        "staff",
        "relations",
    ),
    "index": ("indexid", "creator", "favourite", "date", "items"),
    "friends": ("user", "friend"),
}

DOCUMENTS_PER_FILE = 1_000
LINES_PER_FILE = 10_000


def dated_path(base: str, as_of: dt.date) -> str:
    return f"{base.rstrip('/')}/as_of={date_stamp(as_of)}"


def write_jsonlines(df: DataFrame, base: str, as_of: dt.date, rows_per_file: int = 0) -> str:
    """JSON lines with nulls written out, under a dated folder. Returns the folder."""
    path = dated_path(base, as_of)
    df.write.mode("overwrite").option("ignoreNullFields", "false").option(
        "maxRecordsPerFile", rows_per_file
    ).json(path)
    return path


def write_tsv(df: DataFrame, path: str, header: bool = False) -> None:
    _write_delimited(df, path, "\t", header)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    _write_delimited(df.select(*columns), path, ",", True)


def _write_delimited(df: DataFrame, path: str, separator: str, header: bool) -> None:
    """Quotes doubled, blanks kept, null and empty text both written as nothing."""
    df.write.mode("overwrite").csv(
        path,
        sep=separator,
        header=header,
        quote='"',
        escape='"',
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def flat_value(field: T.StructField) -> Column:
    """Arrays joined with ``;``, maps as ``k:v1,v2;k2:…``, everything else as it is."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.ArrayType):
        return F.array_join(column.cast("array<string>"), ";")
    if isinstance(kind, T.MapType):
        listed = isinstance(kind.valueType, T.ArrayType)

        def pair(entry):
            value = entry["value"].cast("array<string>") if listed else entry["value"]
            text = F.array_join(value, ",") if listed else value.cast("string")
            return F.concat_ws(":", entry["key"], text)

        return F.array_join(F.transform(F.map_entries(column), pair), ";")
    return column


def flat_items(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The given fields in order, ready for a flat file."""
    return df.select(*[flat_value(df.schema[name]).alias(name) for name in fields])


def write_item_tsv(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Tab-separated text with a header and a fixed field order."""
    write_tsv(flat_items(df, fields), path, header=True)


def route(
    df: DataFrame, predicates: Mapping[str, Column], rest: str | None = "rest"
) -> dict[str, DataFrame]:
    """One input split into named outputs; a row goes to the first predicate it meets, else to ``rest``.

    Each output is a filter of the same input. Persist ``df`` first where computing it twice
    costs more than storing it.
    """
    outputs, taken = {}, F.lit(False)
    for name, predicate in predicates.items():
        met = F.coalesce(predicate, F.lit(False))
        outputs[name] = df.where(met & ~taken)
        taken = taken | met
    if rest is not None:
        outputs[rest] = df.where(~taken)
    return outputs


def write_routed(
    df: DataFrame,
    predicates: Mapping[str, Column],
    path: str,
    rest: str | None = "rest",
    columns: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """``route``, stored by one pass over ``df``: a label is worked out per row and is the folder that the row goes to.

    Each output reads its own folder and has the ``columns`` named for it, all by default. A row without an output
    (``rest`` is None) is not stored.
    """
    label = None
    for name, predicate in predicates.items():
        met = F.coalesce(predicate, F.lit(False))
        label = F.when(met, F.lit(name)) if label is None else label.when(met, F.lit(name))
    label = F.lit(rest) if label is None else label.otherwise(F.lit(rest))
    labelled = df.withColumn("_route", label.cast("string"))
    labelled.where(F.col("_route").isNotNull()).write.mode("overwrite").partitionBy("_route").parquet(path)
    stored = df.sparkSession.read.schema(labelled.schema).parquet(path)
    names = [*predicates, *([rest] if rest is not None else [])]
    return {n: stored.where(F.col("_route") == n).select(*(columns or {}).get(n, df.columns)) for n in names}


def numbered_rows(df: DataFrame, path: str, to: str = "row") -> DataFrame:
    """Rows numbered from 0 in the order of their partitions, by the partitions' sizes; stored in ``path`` first, so that a
    retried task cannot number them anew."""
    stored = written(df.withColumn("_at", F.monotonically_increasing_id()), path)
    part = F.shiftright("_at", 33)  # the lower 33 bits count the partition's rows
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    parts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    parts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = stored.withColumn("_part", part).join(F.broadcast(parts), "_part")
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return joined.select(*df.columns, number.alias(to))


def write_numbered(df: DataFrame, path: str, rows: int, kind: str = "json") -> None:
    """Files of exactly ``rows`` rows, the last one excepted, each in a folder ``chunk=<number>`` from 0.

    A chunk is written by one task, chunks by as many as the session shuffles to.
    """
    numbered = numbered_rows(df, f"{scratch_folder(df.sparkSession, 'chunks')}/rows", "_row")
    chunks = numbered.withColumn("chunk", F.expr(f"_row div {rows}"))
    dealt = chunks.repartition(shuffle_partitions(df.sparkSession), "chunk").sortWithinPartitions("chunk", "_row")
    writer = dealt.drop("_row").write.mode("overwrite").partitionBy("chunk")
    if kind == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(kind).save(path)


def write_chunked(df: DataFrame, path: str, rows: int, kind: str = "json") -> None:
    """Files of at most ``rows`` rows; the part number replaces a running number."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).option(
        "ignoreNullFields", "false"
    ).format(kind).save(path)
