"""Spelling variants: words one edit apart, found by PartEnum signatures over their letter multisets.

A word is a binary vector with a dimension for every letter and occurrence ("banana": a1 a2 a3 b1 n1 n2). One
inserted, deleted or replaced letter changes at most two dimensions. Dimensions are dealt into ``PARTS`` parts
by hash; two vectors that differ in at most two dimensions agree in all but two parts, so every choice of
two parts to leave out gives one signature, the hash of what the others hold, and such words share at least one. Words meet by
signature; sketches of the letter pairs and then the words themselves are compared.

After Arasu, Ganti and Kaushik, *Efficient exact set-similarity joins* (2006), with one level of partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tagmill.session import scratch_folder, shuffle_partitions, written

from .graphs import spread_cells, whole_cells

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
SHORTEST = 7
TIMES = 10
PARTS = 5
TILE_ROWS = 4_096  # layout only
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(text: Column | str) -> Column:
    """All maximal runs of Latin letters in order, with only A-Z lower-cased; empty for a null text."""
    lowered = F.translate(text, _CAPITALS, _SMALL)
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0)), F.array().cast("array<string>"))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers from others, all bits of which depend on all of those."""
    x = x + np.uint64(0x9E3779B97F4A7C15)  # fixed values: a published mixing function
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _dimension(letter: str, occurrence: int, parts: int) -> tuple[int, int]:
    """The part of a dimension and its hash."""
    first = _mixed(np.array([ord(letter) << 40 | occurrence], np.uint64))
    return int(first[0]) % parts, int(_mixed(first)[0])


@cache
def _pair_bit(first: str, second: str) -> int:
    """The bit of a sketch that two neighbouring letters turn; an empty string is the word's end."""
    code = ord(first or "\0") << 32 | ord(second or "\0")
    return 1 << (int(_mixed(np.array([code], np.uint64))[0]) >> 58)


def letter_vectors(words: list[str], parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """What each part holds of every word's letter multiset, the exclusive or of its dimensions' hashes; and sketches of 64
    bits, each the parity of the pairs of neighbouring letters dealt to it: one edit changes four pairs and bits at most."""
    rows, sketches = [], []
    for word in words:
        held, sketch, seen, last = [0] * parts, 0, {}, ""
        for letter in word:
            seen[letter] = number = seen.get(letter, 0) + 1
            part, mark = _dimension(letter, number, parts)
            held[part] ^= mark
            sketch ^= _pair_bit(last, letter)
            last = letter
        rows.append(held)
        sketches.append(sketch ^ _pair_bit(last, ""))
    return np.array(rows, np.uint64).reshape(len(words), parts), np.array(sketches, np.uint64)


def signatures(held: np.ndarray) -> np.ndarray:
    """By row of ``letter_vectors`` one number for each choice of two parts to leave out."""
    whole = np.bitwise_xor.reduce(held, axis=1)
    left = combinations(range(held.shape[1]), 2)
    with np.errstate(over="ignore"):
        keys = [_mixed((whole ^ held[:, a] ^ held[:, b]) + np.uint64(n << 57)) for n, (a, b) in enumerate(left)]
    return np.stack(keys, axis=1)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, sketches = letter_vectors(batch.column("word").to_pylist())
        keys = signatures(held)
        ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1])
        lists = pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(sketches.view(np.int64)), lists], ["word", "n", "sketch", "signatures"]
        )


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one cell whose lengths differ by one at most and whose sketches by four bits at most.

    Cells are sorted by length, so a word meets the following ones until they are too long for it.
    """
    for table, cell in whole_cells(batches, ["key", "low", "high"], 16 * TILE_ROWS):
        table = table.combine_chunks()
        sketch, size = table["sketch"].to_numpy().view(np.uint64), table["size"].to_numpy()
        tile, across = table["tile"].to_numpy(), table["low"].to_numpy() != table["high"].to_numpy()
        at, step = np.arange(table.num_rows), 0
        while True:
            step += 1
            at = at[at + step < table.num_rows]
            at = at[(cell[at] == cell[at + step]) & (size[at + step] - size[at] <= 1)]
            if not len(at):
                break
            near = at[np.bitwise_count(sketch[at] ^ sketch[at + step]) <= 4]
            near = near[~across[near] | (tile[near] != tile[near + step])]
            if len(near):
                a, b = table.take(pa.array(near)).combine_chunks(), table.take(pa.array(near + step)).combine_chunks()
                pairs = [x[c].combine_chunks() for x in (a, b) for c in ("word", "n")]
                yield pa.RecordBatch.from_arrays(pairs, ["word", "n", "near", "near_n"])


def near_words(words: DataFrame, folder: str) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of the distinct ``word`` that one edit of a code point turns into each other."""
    shape = "word string, n long, sketch long, signatures array<long>"
    signed = written(words.select("word", "n").mapInArrow(_signed, shape), f"{folder}/signed")
    rows = signed.select(F.explode("signatures").alias("key"), "word", "n", "sketch", F.length("word").alias("size"))
    cells = spread_cells(rows, ["key"], "word", TILE_ROWS, f"{folder}/large")
    place = ["key", "low", "high"]
    dealt = cells.repartition(shuffle_partitions(words.sparkSession), *place).sortWithinPartitions(*place, "size")
    met = dealt.select(*place, "tile", "word", "n", "sketch", "size").mapInArrow(
        _candidates, "word string, n long, near string, near_n long"
    )
    pairs = met.where(F.levenshtein("word", "near", 1) == 1)
    one, other = F.struct("word", "n", "near", "near_n"), F.struct(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    return pairs.select(F.explode(F.array(one, other)).alias("pair")).select("pair.*").distinct()


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """One row per row of ``words`` (word, n; distinct, not null): word, form, root, n, n_near, form_n.

    ``n_near`` counts the words one inserted, deleted or replaced code point away. The form is the one of largest
    ``n`` among them (ties: the smallest in code-point order) if it is at least ``times`` the word's own; else form
    and form_n are null. The root follows the forms to the last; a word without form is its own. Empty in, empty out.
    """
    if times < 2:
        raise ValueError("forms that are not more frequent may go round in circles")
    spark = words.sparkSession
    folder = scratch_folder(spark, "variants")
    counted = written(words.select("word", F.col("n").cast("long").alias("n")), f"{folder}/words")
    near = near_words(counted, folder)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first")
    )
    enough = -F.col("first.less") >= times * F.col("n")
    seen = Observation()
    formed = written(
        counted.join(best, "word", "left").select(
            "word",
            F.when(enough, F.col("first.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, -F.col("first.less")).alias("form_n"),
        ),
        f"{folder}/formed",
        seen,
        F.max("n").alias("most"),
    )
    # Every step multiplies n, so a chain of forms has few steps; each turn doubles what is followed.
    steps, most = 0, seen.get["most"] or 0
    while times ** (steps + 1) <= most:
        steps += 1
    ways = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for turn in range((max(steps, 1) - 1).bit_length()):
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        followed = ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        ways = written(followed, f"{folder}/turn_{turn}")
    return formed.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
