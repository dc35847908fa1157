"""Text cleaning and tag normalisation."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder, written

# Fixed value: every character that is neither letter, digit nor underscore is dropped.
NON_WORD = r"[^\p{L}\p{N}_]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def last_per_key(entries: Column) -> Column:
    """Map of ``array<struct<key, value>>``, the last entry of a key winning."""

    def kept(all_entries):
        return F.filter(
            all_entries,
            lambda e, at: ~F.exists(
                F.slice(all_entries, at + 2, F.size(all_entries)), lambda later: later["key"] == e["key"]
            ),
        )

    return F.map_from_entries(bind(entries, kept))


def strip_nul(col) -> Column:
    """Remove NUL characters."""
    return F.replace(_col(col), F.lit("\x00"), F.lit(""))


def strip_controls(col) -> Column:
    """Remove code points 0 to 31."""
    return F.regexp_replace(_col(col), r"[\x00-\x1f]", "")


def map_chars(col, mapping: Mapping[str, str] | None) -> Column:
    """Replace table entries, the longest match first.

    The table is a dict of the caller's and goes to every task; ``convert_by_table`` takes one of any size.
    One-to-one character tables become ``translate`` and stay in the JVM; tables with phrases
    go through an Arrow function that reads each text once.
    """
    col = _col(col)
    if not mapping:
        return col
    if all(len(k) == 1 and len(v) == 1 for k, v in mapping.items()):
        return F.translate(col, "".join(mapping), "".join(mapping.values()))
    return _phrase_converter(dict(mapping))(col)


def _phrase_converter(mapping: dict[str, str]):
    lengths: dict[str, list[int]] = {}
    for phrase in sorted(filter(None, mapping), key=len, reverse=True):
        sizes = lengths.setdefault(phrase[0], [])
        if len(phrase) not in sizes:
            sizes.append(len(phrase))

    def convert(text: str) -> str:
        out, at = [], 0
        while at < len(text):
            step = next((n for n in lengths.get(text[at], ()) if text[at : at + n] in mapping), 0)
            out.append(mapping[text[at : at + step]] if step else text[at])
            at += step or 1
        return "".join(out)

    @F.arrow_udf("string")
    def converted(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else convert(t) for t in texts.to_pylist()], pa.string())

    return converted


def phrases_named(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Stretches of each ``_text`` that begin like a ``_phrase`` of ``rows`` and are as long as one that begins so."""
    begins = rows.groupBy(F.substr("_phrase", F.lit(1), F.lit(2)).alias("_begin")).agg(
        F.collect_set(F.length("_phrase")).alias("_sizes")
    )
    places = texts.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("_text"))))
    pair = F.substr("_text", "_at", F.lit(2))
    # Phrases of one character begin with it alone; at the last place both beginnings are the same.
    places = places.withColumn("_begin", F.explode(F.array_distinct(F.array(F.left(pair, F.lit(1)), pair))))
    named = places.join(begins, "_begin").withColumn("_size", F.explode("_sizes"))
    named = named.where(F.col("_at") + F.col("_size") <= F.length("_text") + 1)
    return named.select("_text", "_at", "_size", F.substr("_text", "_at", "_size").alias("_phrase"))


def convert_by_table(
    df: DataFrame, col: str, table: DataFrame, source: str = "source", target: str = "target"
) -> DataFrame:
    """``map_chars`` for a conversion table of any size, held in a DataFrame: replaces ``col`` in ``df``.

    Each distinct text names its places; only places whose first one or two characters begin a phrase go on, and from
    there only the lengths that occur behind that beginning are cut out and meet the table by phrase. So a long phrase adds
    one row at places that begin like it and none elsewhere. At every place the longest phrase counts, from left to
    right. Null stays null. Of several rows for one phrase the smallest target counts.
    """
    rows = table.where(F.length(source) > 0).groupBy(F.col(source).alias("_phrase")).agg(F.min(target).alias("_target"))
    rows = written(rows, f"{scratch_folder(df.sparkSession, 'phrases')}/rows")
    texts = df.select(F.col(col).alias("_text")).where(F.length(col) > 0).distinct()
    named = phrases_named(texts, rows)
    hits = named.join(rows, "_phrase").groupBy("_text", "_at").agg(
        F.max(F.struct("_size", "_target")).alias("_best")
    )
    hits = hits.groupBy("_text").agg(F.sort_array(F.collect_list(F.struct("_at", "_best"))).alias("_hits"))
    text = F.col("_text")

    def step(done: Column, hit: Column) -> Column:
        between = F.substr(text, done["at"], hit["_at"] - done["at"])
        met = F.struct(
            (hit["_at"] + hit["_best"]["_size"]).alias("at"),
            F.concat(done["out"], between, hit["_best"]["_target"]).alias("out"),
        )
        return F.when(hit["_at"] >= done["at"], met).otherwise(done)

    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    converted = F.aggregate("_hits", start, step, lambda d: F.concat(d["out"], F.substr(text, d["at"])))
    by_text = hits.select("_text", converted.alias("_converted"))
    joined = df.join(by_text, df[col] == by_text["_text"], "left")
    return joined.withColumn(col, F.coalesce("_converted", col)).select(*df.columns)


def normalize_tag(col, mapping: Mapping[str, str] | None = None) -> Column:
    """Drop non-word characters, lower-case, convert the script with ``mapping``.

    A tag made of punctuation only becomes the empty string and stays a key.
    """
    return map_chars(F.lower(F.regexp_replace(_col(col), NON_WORD, "")), mapping)


def slice_tokens(col, drop_first: int = 2, drop_last: int = 1) -> Column:
    """Split on blanks and drop tokens at both ends."""
    tokens = F.split(_col(col), " ", -1)
    length = F.size(tokens) - drop_first - drop_last
    return F.slice(tokens, drop_first + 1, F.greatest(F.lit(0), length))


def second_token_lower(col) -> Column:
    return F.lower(F.get(F.split(_col(col), " ", -1), F.lit(1)))


def number_in(col, pattern: str = r"(\d+)", group: int = 1) -> Column:
    """The integer captured by ``pattern``, null when it is absent."""
    return F.regexp_extract(_col(col), pattern, group).try_cast("long")


def blank_to_null(col) -> Column:
    return F.nullif(_col(col), F.lit(""))


def to_json_text(col) -> Column:
    """JSON text with nulls kept and non-ASCII characters unescaped."""
    return F.to_json(_col(col), {"ignoreNullFields": "false"})
