"""Periodic runs of words by seed and extend on diagonals of the self-comparison.

A run of period q is a diagonal at lag q: words i and i + q are equal for all but its last q places. Periods are
taken by octaves, 2^j to 2^(j+1) - 1. Every run of an octave has a diagonal of at least k places, the minimum
guaranteed overlap, and k is no less than q, so inside the run a k-gram is found again at multiples of q only (its
first q words are no power of a shorter word, and such words differ from their own rotations). The pair of a
k-gram with its *next* occurrence in the document is therefore enough: the run's first k-gram meets its copy at
lag q. One pair per place and octave is looked at, never all pairs of a gram, and a diagonal that smaller
periods explain is never seeded. Seeds that an earlier extension at their lag has covered are passed over.

Grams are compared by ranks that double in length and are exact, no hashes. Documents are independent, so there
is no shuffle; a task works on slices of a few megabytes of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
REPEATS = 4
SLICE_BYTES = 4 << 20  # layout only: whole texts that are worked on together


def word_numbers(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words (runs without ASCII white space), a number for each word of each text, and the words per text.

    Equal words of one text have equal numbers, words of different texts never have.
    """
    words: list[bytes] = []
    sizes = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = text.split() if text else []
        sizes[k] = len(found)
        words += found
    if not words:
        return words, np.empty(0, np.int64), sizes
    held = np.empty(len(words), object)
    held[:] = words
    number, distinct = pd.factorize(held)
    return words, np.repeat(np.arange(len(texts)), sizes) * len(distinct) + number, sizes


class _Grams:
    """Ranks of all grams of 2^m words that occur again in their text; other places have rank 0 and stay out."""

    def __init__(self, numbers: np.ndarray):
        self.words, self.size = 1, len(numbers)
        self._keep(np.arange(self.size), numbers)

    def _keep(self, places: np.ndarray, keys: np.ndarray) -> None:
        _, rank, count = np.unique(keys, return_inverse=True, return_counts=True)
        again = count[rank] > 1
        self.places = places[again]
        self.rank = np.zeros(self.size, np.int64)
        self.rank[self.places] = rank[again] + 1

    def pairs(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the grams of ``words`` words, at most twice the present length, that may occur again."""
        step = words - self.words
        at = self.places[self.places + step < self.size]
        at = at[self.rank[at + step] > 0]
        return at, self.rank[at] * (self.size + 1) + self.rank[at + step]

    def double(self) -> None:
        self._keep(*self.pairs(2 * self.words))
        self.words *= 2


def _next_occurrences(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place whose gram comes again later, and the way to the next occurrence."""
    order = np.argsort(keys, kind="stable")
    at, key = places[order], keys[order]
    same = key[1:] == key[:-1]
    return at[:-1][same], (at[1:] - at[:-1])[same]


def _reach(numbers: np.ndarray, at: int, lag: int, step: int) -> int:
    """The first place from ``at`` on, forwards or backwards by ``step``, that differs from the one ``lag`` later."""
    width, last = 16, len(numbers) - lag
    while 0 <= at < last:
        a, b = (at, min(at + width, last)) if step > 0 else (max(at - width + 1, 0), at + 1)
        differ = np.flatnonzero(numbers[a:b] != numbers[a + lag : b + lag])
        if len(differ):
            return a + int(differ[0] if step > 0 else differ[-1])
        at, width = (b, 2 * width) if step > 0 else (a - 1, 2 * width)
    return at


def runs_of(numbers: np.ndarray, longest: int, least: int = LEAST_WORDS, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period; ``longest`` is the longest text's number of words."""
    found: list[tuple[int, int, int]] = []
    covered: dict[int, int] = {}  # lag: the first place behind the diagonals that were followed
    grams, low = _Grams(numbers), 1
    while repeats * low <= longest and len(grams.places):
        words = min(max(least - q, (repeats - 1) * q) for q in range(low, max(low, least) + 1))
        while 2 * grams.words <= words:
            grams.double()
        at, lag = _next_occurrences(*grams.pairs(words))
        near = (lag >= low) & (lag < 2 * low)
        at, lag = at[near], lag[near]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        first = np.ones(len(at), bool)  # the next place of a diagonal needs no seed of its own
        first[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        for a, q in zip(at[first].tolist(), lag[first].tolist()):
            if a < covered.get(q, 0):
                continue
            end = _reach(numbers, a + words, q, 1)
            start = _reach(numbers, a - 1, q, -1) + 1
            covered[q] = end
            length = end + q - start
            if length >= max(least, repeats * q):
                found.append((start, length, q))
        low *= 2
    runs = np.array(found, np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slices(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    first, texts, held = 0, [], 0
    for k, value in enumerate(column.cast(pa.binary())):
        texts.append(value.as_py())
        held += len(texts[-1] or b"")
        if held >= SLICE_BYTES:
            yield first, texts
            first, texts, held = k + 1, [], 0
    if texts:
        yield first, texts


def _list_of(sizes: np.ndarray, columns: dict[str, np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], list(columns)))


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, repeats: int = REPEATS
) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_words, runs (start, length, period), collapsed.

    Words are runs without ASCII white space, numbered from 0. A run is a stretch of words with smallest period q
    and at least ``least`` and ``repeats`` times q words that no neighbouring word extends; runs come by start,
    then period, and may overlap. ``collapsed`` is the text's words joined by single spaces, without the words that
    any run holds after its first q. Null, empty and wordless texts have no words, no runs and an empty
    ``collapsed``; null and repeated keys are rows like others. A text is worked on whole, in one task.
    """
    if repeats < 3:
        raise ValueError("a run has at least three repeats of its period")
    shape = "key {}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    shape = shape.format(docs.schema[key].dataType.simpleString())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                words, numbers, sizes = word_numbers(texts)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                runs = runs_of(numbers, int(sizes.max()), least, repeats)
                text = np.searchsorted(ends, runs[:, 0], "right")
                dropped = np.zeros(len(words) + 1, np.int64)
                np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
                np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
                kept = np.cumsum(dropped)[:-1] == 0
                collapsed = []
                for a, b in zip(starts.tolist(), ends.tolist()):
                    own = words[a:b] if kept[a:b].all() else [w for w, k in zip(words[a:b], kept[a:b]) if k]
                    collapsed.append(b" ".join(own).decode())
                places = {"start": runs[:, 0] - starts[text], "length": runs[:, 1], "period": runs[:, 2]}
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(sizes),
                        _list_of(np.bincount(text, minlength=len(texts)), places),
                        pa.array(collapsed, pa.string()),
                    ],
                    ["key", "n_words", "runs", "collapsed"],
                )

    return docs.select(key, text).mapInArrow(find, shape).withColumnRenamed("key", key)


def strongest(runs: Column) -> Column:
    """The run of greatest length by period, compared exactly; of equal ones the first. Null without runs."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
