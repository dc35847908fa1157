"""Repeated passages by a sparse suffix array over content-selected positions.

A passage of 50 words holds a minimiser: the smallest hash of 25 consecutive words among 26 neighbours.
Copies of a passage select the same place in it, so only suffixes at minimisers are retained, about 7 in 100 words. Suffixes
are compared by their first 25 words: equal neighbours in that order are the places where passages may repeat. From
there every match is extended left and right, window by window: each stretch of 50 words that covers such a
place is looked up among the others, and overlapping repeats of a text join to the longest spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.session import scratch_folder, written

PASSAGE_WORDS = 50
_WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multiplier for hashing


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of every word."""
    from xxhash import xxh64_intdigest

    known: dict[bytes, int] = {}
    out = [known.get(w) or known.setdefault(w, xxh64_intdigest(w, 7)) for w in words]
    return np.array(out, np.uint64)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words: a polynomial over 64-bit numbers, finished by mixing."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out, power, done = np.zeros(len(hashes) - size + 1, np.uint64), np.uint64(1), 0
        # Doubling: the sum over 2^k words from two sums over half of them.
        block, factor = hashes * _MIX, _MIX
        length, rest = 1, size
        while rest:
            if rest & 1:
                out += block[done : done + len(out)] * power
                power *= factor
                done += length
            rest >>= 1
            if rest:
                block = block[: len(block) - length] + block[length:] * factor
                factor *= factor
                length *= 2
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)  # fixed value: a published mixing constant
        return out ^ (out >> np.uint64(32))


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places that are the first smallest of ``window`` consecutive grams somewhere."""
    if len(grams) < window:
        return np.empty(0, np.int64)
    least = grams
    length = 1
    while length < window:
        step = min(length, window - length)
        least = np.minimum(least[: len(least) - step], least[step:])
        length += step
    # The first place of each window that holds its least value: the last such place seen from the right.
    places, found = np.arange(len(least)), np.full(len(least), -1)
    for offset in range(window - 1, -1, -1):
        same = grams[offset : offset + len(least)] == least
        found[same] = places[same] + offset
    return np.unique(found)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def by_value(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, and for each its places: all places in that order, and where each value's begin."""
    order = np.argsort(values, kind="stable")
    found, first = np.unique(values[order], return_index=True)
    return found, places[order], first


def _nested(firsts: list[np.ndarray], parts: list[np.ndarray], kind) -> pa.ListArray:
    """Per distinct value of each text the list of its places, one after the other."""
    sizes = np.cumsum([0, *map(len, parts)])
    offsets = np.concatenate([*(f + a for f, a in zip(firsts, sizes)), [sizes[-1]]])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int32), *parts]), kind))


def _retain(passage: int):
    gram = passage // 2

    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, places, firsts, suffixes = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                if len(words) >= passage:
                    grams = gram_hashes(word_hashes(words), gram)
                    at = minimisers(grams, passage - gram + 1)
                    rows.append(k)
                    sizes.append(len(words))
                    found, ordered, first = by_value(grams[at], at.astype(np.int32))
                    places.append(ordered)
                    firsts.append(first)
                    suffixes.append(found.view(np.int64))
            columns = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("id", "copy")]
            ends = pa.array(np.cumsum([0, *map(len, suffixes)]), pa.int32())
            flat = np.concatenate([np.empty(0, np.int64), *suffixes])
            columns += [pa.array(sizes, pa.int32())]
            columns += [pa.ListArray.from_arrays(ends, _nested(firsts, places, pa.int32()))]
            columns += [pa.ListArray.from_arrays(ends, pa.array(flat, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "copy", "n_words", "places", "suffixes"])

    return retain


def _extend(passage: int):
    gram = passage // 2

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, firsts, keys = [], [], [], []
            seeds = batch.column("places").to_pylist()
            for k, text in enumerate(batch.column("text").to_pylist()):
                stretch = gram_hashes(word_hashes(words_of(text)), passage)
                open_ = np.zeros(len(stretch) + 1, np.int64)
                places = np.array(seeds[k])
                np.add.at(open_, np.maximum(places - (passage - gram), 0), 1)
                np.add.at(open_, np.minimum(places + 1, len(stretch)), -1)
                at = np.flatnonzero(np.cumsum(open_)[:-1] > 0)
                found, ordered, first = by_value(stretch[at], at.astype(np.int32))
                rows.append(np.full(len(found), k))
                starts.append(ordered)
                firsts.append(first)
                keys.append(found)
            if rows:
                rows, keys = np.concatenate(rows), np.concatenate(keys)
                columns = [batch.column("id").take(pa.array(rows)), batch.column("copy").take(pa.array(rows))]
                columns += [batch.column("copied").take(pa.array(rows))]
                columns += [_nested(firsts, starts, pa.int32()), pa.array(keys.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "copy", "copied", "starts", "stretch"])

    return extend


def _joined(passage: int):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, begins, ends = [], [], []
            for k, starts in enumerate(batch.column("starts")):
                at = np.sort(starts.values.to_numpy())
                new = np.ones(len(at), bool)
                new[1:] = at[1:] > at[:-1] + passage
                first = np.flatnonzero(new)
                rows.append(np.full(len(first), k))
                begins.append(at[first])
                ends.append(at[np.r_[first[1:] - 1, len(at) - 1]] + passage)
            if rows:
                taken = pa.array(np.concatenate(rows))
                columns = [batch.column(c).take(taken) for c in ("id", "copy", "kept")]
                columns += [pa.array(np.concatenate(x).astype(np.int32)) for x in (begins, ends)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "copy", "kept", "begin", "end"])

    return join


def _retained(rows: DataFrame, passage: int, kind: str, folder: str) -> DataFrame:
    shape = f"id {kind}, copy long, n_words int, places array<array<int>>, suffixes array<long>"
    return written(rows.mapInArrow(_retain(passage), shape), f"{folder}/retained")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", passage: int = PASSAGE_WORDS) -> DataFrame:
    """Spans of at least ``passage`` words whose every stretch of ``passage`` words stands at another place too.

    Columns: id (the key), copy (a hash of the text), kept, begin, end (words, end exclusive). Where a stretch comes
    several times, its first place by key, text hash and position is kept, all others are not; neighbouring
    places of one kind form a span. Words are runs without ASCII white space, ASCII letters lower-cased. Texts
    that are equal are compared once: all but the one with the smallest key are one span that isn't kept. Null
    and short texts have no spans. Null keys come last; rows that agree in key and text count once.
    """
    folder, kind = scratch_folder(docs.sparkSession, "suffixes"), docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))
    rows = rows.where(F.octet_length("text") >= 2 * passage - 1)
    retained = _retained(rows, passage, kind, folder)

    owner = F.struct(F.col("id").isNull().alias("late"), F.col("id").alias("id"))
    copies = retained.groupBy("copy").agg(F.min(owner).alias("owner"), F.max(owner).alias("last"))
    copies = copies.select("copy", "owner", (F.col("owner") != F.col("last")).alias("copied"))

    suffixes = retained.select("id", "copy", F.explode(F.arrays_zip("places", "suffixes")).alias("s"))
    # One row per text and suffix with all its places, so a text that repeats itself does not make a key hot.
    suffixes = suffixes.select("id", "copy", F.col("s.places").alias("places"), F.col("s.suffixes").alias("suffix"))
    again = suffixes.groupBy("suffix").agg(F.sum(F.size("places")).alias("n")).where("n > 1").select("suffix")
    seeds = suffixes.join(again, "suffix").groupBy("id", "copy")
    seeds = seeds.agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    seeds = seeds.join(copies, "copy").where(owner == F.col("owner"))
    seeds = written(seeds.select("id", "copy", "places", "copied"), f"{folder}/seeds")

    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.copy") == F.col("r.copy"))
    seeded = rows.alias("l").join(seeds.alias("r"), same).select("l.id", "l.copy", "l.text", "r.places", "r.copied")
    shape = f"id {kind}, copy long, copied boolean, starts array<int>, stretch long"
    found = written(seeded.mapInArrow(_extend(passage), shape), f"{folder}/stretches")

    def place(start):
        return F.struct(F.col("id").isNull().alias("late"), "id", "copy", start.alias("start"))

    first, last = place(F.array_min("starts")), place(F.array_max("starts"))
    places = found.groupBy("stretch").agg(F.min(first).alias("first"), F.max(last).alias("last"))
    repeated = found.join(places.where("first <> last"), "stretch")
    own = F.when(first == F.col("first"), F.array_min("starts"))  # the place that is kept, if it is in this text
    sides = repeated.groupBy("id", "copy", "copied").agg(
        F.flatten(F.collect_list(F.filter("starts", lambda s: ~s.eqNullSafe(own)))).alias("more"),
        F.collect_list(own).alias("kept"),
    )
    kept = sides.where("not copied").select("id", "copy", F.lit(True).alias("kept"), F.col("kept").alias("starts"))
    more = sides.select("id", "copy", F.lit(False).alias("kept"), F.col("more").alias("starts"))
    starts = kept.unionByName(more).where(F.size("starts") > 0)
    starts = starts.withColumn("starts", F.array_distinct("starts"))
    spans = starts.mapInArrow(_joined(passage), f"id {kind}, copy long, kept boolean, begin int, end int")
    whole = retained.join(copies.where("copied"), "copy").select(
        "id", "copy", (owner == F.col("owner")).alias("kept"), F.lit(0).alias("begin"), F.col("n_words").alias("end")
    )
    return spans.unionByName(whole.distinct())


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space behind them."""
    data = text.encode()
    starts = [m.start() for m in _WORDS.finditer(data)] + [len(data)]
    out, at = [], 0
    for begin, end in sorted(spans):
        out.append(data[at : max(at, starts[begin])])
        at = max(at, starts[end])
    return b"".join([*out, data[at:]]).decode()


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", passage: int = PASSAGE_WORDS) -> DataFrame:
    """All rows and columns of ``docs``; from the texts, spans that aren't kept are cut. Nothing else changes; a text that is
    one such span becomes empty. Null and repeated keys are rows like others; rows that agree in key and text are cut alike."""
    spans = repeated_spans(docs, key, text, passage).where("not kept")
    listed = spans.groupBy("id", "copy").agg(F.collect_list(F.struct("begin", "end")).alias("spans")).alias("s")
    same = F.col(f"d.{key}").eqNullSafe(F.col("s.id")) & (F.xxhash64(f"d.{text}") == F.col("s.copy"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [t if s is None else cut_spans(t, [(x["begin"], x["end"]) for x in s]) for t, s in zip(texts, spans)]
        )

    joined = docs.alias("d").join(listed, same, "left")
    shortened = cut(F.col(f"d.{text}"), F.col("s.spans")).alias(text)
    return joined.select(*[shortened if c == text else F.col(f"d.`{c}`") for c in docs.columns])
