"""Toxic texts by compression distance: which of two zstandard dictionaries shortens a text's windows more?

Both dictionaries share a body of ordinary text; one ends with spans that set toxic training texts apart, the other
with spans that set ordinary ones apart. Windows are a few whole words and overlap by half. A window's distance is
its length under the ordinary dictionary less that under the toxic one, less what ordinary windows of that length have.
How far ordinary windows go is calibrated on texts that no dictionary has
seen, and so are the weights and the cut that turn a text's distances into a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .encoders import grouped

# The training sample: so many labelled texts of each class at most, none longer than this. Documented bounds;
# everything that is scored is scored whole.
SAMPLE_PER_CLASS = 2_500
SAMPLE_BYTES = 32_768
WINDOW_WORDS, WINDOW = 4, 96  # longer windows than so many bytes are cut again
LEVEL = 9
# Each dictionary: so many bytes of ordinary text at most that both share, and so many of spans of its own. Documented bounds.
BODY_BYTES, SPAN_BYTES = 24_000, 4_000
_SPAN_Z, _SPAN_TEXTS = 6.0, 3
_ORDINARY_QUANTILE = 0.999
_FOLDS = 4
GROUP_CHARS = 2_000_000  # texts whose windows are kept at once; results do not depend on it
_WORD = re.compile(rb"[a-z\x80-\xff]+")
_STEP = re.compile(rb"\S++\s*+" + rb"(?:\S++\s*+)?" * (WINDOW_WORDS // 2 - 1))  # the words between two windows' starts
# Every window begins with what both dictionaries end with: that match pays for the block's headers, so a single short
# word shows in the length instead of leaving the block raw.
_PRIME = bytes(range(1, 9)) + bytes(range(14, 32))


def stretches(text: str) -> list[bytes]:
    """Consecutive stretches of the whole lower-cased text; an empty text is one empty stretch."""
    data = text.lower().encode()
    return [data[a : a + WINDOW] for a in range(0, len(data), WINDOW)] or [b""]


def windows(text: str) -> list[bytes]:
    """Windows of ``WINDOW_WORDS`` whole words at every second word of the lower-cased text. Those with over ``WINDOW``
    bytes are cut into pieces that overlap by half. A text without words is one empty window."""
    steps, out = _STEP.findall(text.lower().encode()), []
    for window in map(bytes.__add__, steps, steps[1:]) if len(steps) > 1 else steps:
        if len(window) <= WINDOW:
            out.append(window)
        else:
            out += [window[a : a + WINDOW] for a in range(0, len(window) - WINDOW // 2, WINDOW // 2)]
    return out or [b""]


def word_starts(text: str) -> set[bytes]:
    """All beginnings of 3 to 10 bytes of the words of a text, and the words that short."""
    words = set(_WORD.findall(text.lower().encode()))
    return {w[:n] for w in words for n in range(3, min(len(w), 10) + 1)}


def counted_starts(texts: list[str]) -> list[Counter]:
    """For each fold in how many of its texts a span occurs."""
    counts = [Counter() for _ in range(_FOLDS)]
    for i, text in enumerate(texts):
        counts[i % _FOLDS].update(word_starts(text))
    return counts


def telling_spans(a: Counter, b: Counter, na: int, nb: int) -> list[bytes]:
    """Spans in more of ``na`` own texts (``a``) than of ``nb`` others (``b``) beyond chance, the most telling first."""

    def z(span: bytes) -> float:
        p = (a[span] + b[span]) / (na + nb)
        return (a[span] / na - b[span] / nb) / math.sqrt(p * (1 - p) * (1 / na + 1 / nb) + 1e-12)

    # A small sample can't reach the full bar; the bar falls with it.
    bar = min(_SPAN_Z, max(3.0, math.sqrt(na) / 1.5))
    ranked = sorted((-v, -len(s), s) for s in a if a[s] >= _SPAN_TEXTS and (v := z(s)) >= bar)
    chosen: list[bytes] = []
    for _, _, span in ranked:
        if sum(map(len, chosen)) + len(span) > SPAN_BYTES:
            break
        if not any(span.startswith(c) or c.startswith(span) for c in chosen):
            chosen.append(span)
    return chosen


@dataclass
class ToxicityModel:
    """What scoring needs. Without texts of both classes to learn from, the score is ``constant``."""

    constant: float = 0.0
    toxic: bytes = b""
    ordinary: bytes = b""
    expected: tuple[float, float] = (0.0, 0.0)
    bar: float = 0.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_engines"}

    def lengths(self, texts) -> Iterator[np.ndarray]:
        """Of every window of each text the length under the ordinary dictionary and how much less it is under the
        toxic one. Windows that a group of texts repeats are compressed once."""
        if "_engines" not in self.__dict__:
            self._engines = _engine(self.ordinary), _engine(self.toxic)
        ordinary, toxic = (e.compress for e in self._engines)
        for group in grouped(texts, GROUP_CHARS):
            number: dict[bytes, int] = {}
            places = [np.array([number.setdefault(w, len(number)) for w in windows(t)]) for t in group]
            found = np.array([(len(ordinary(w)), len(toxic(w))) for w in (_PRIME + b" " + w for w in number)], np.int32)
            found[:, 1] = found[:, 0] - found[:, 1]
            yield from (found[at] for at in places)

    def distances(self, lengths: np.ndarray) -> np.ndarray:
        return lengths[:, 1] - (self.expected[0] + self.expected[1] * lengths[:, 0])

    def features(self, distances: np.ndarray) -> list[float]:
        top = np.sort(distances)[::-1]
        over = distances > self.bar
        beyond = math.log1p(np.maximum(top - self.bar, 0).sum())
        shares = [math.log1p(over.sum()), over.mean(), math.log1p(len(top)), beyond]
        return [distances.mean(), top[0], top[:3].mean(), top[:8].mean(), *shares]

    def scores(self, texts) -> np.ndarray:
        if not self.toxic:
            return np.full(len(texts), self.constant)
        x = np.array([self.features(self.distances(n)) for n in self.lengths(texts)]).reshape(len(texts), -1)
        x = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -50, 50)))


def _engine(content: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    kind = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    known.precompute_compress(compression_params=kind)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=kind)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        weights -= np.linalg.solve(curve, x.T @ (p - y) + 0.1 * weights)
    return weights


def _best_cut(logits: np.ndarray, y: np.ndarray, share: float) -> float:
    """The cut with the highest F score if a ``share`` of texts is toxic; precision and recall count alike."""
    best, cut = -1.0, 0.0
    values = np.unique(logits)
    for value in (values[1:] + values[:-1]) / 2 if len(values) > 1 else values:
        found = logits >= value
        hit, false = share * found[y == 1].mean(), (1 - share) * found[y == 0].mean()
        score = 2 * hit / (hit + false + share)
        if score > best:
            best, cut = score, float(value)
    return cut


def train(toxic: list[str], ordinary: list[str], share: float) -> ToxicityModel:
    """Dictionaries from all texts. Bar, weights and cut come from texts that the dictionaries of their fold
    have not seen. Without enough texts of both classes every score is ``share``."""
    toxic, ordinary = _without_copies(toxic), _without_copies(ordinary)
    nt, no = len(toxic), len(ordinary)
    if min(nt, no) < 2 * _FOLDS:
        return ToxicityModel(constant=share)
    rng = np.random.default_rng(0)
    parts = [w for text in ordinary for w in rng.choice(np.array(stretches(text), object), 3)]
    rng.shuffle(parts)
    body = b" ".join(parts)[:BODY_BYTES]
    starts = counted_starts(toxic), counted_starts(ordinary)

    def content(own: int, without: int | None) -> bytes:
        a, b = (sum((c for k, c in enumerate(starts[x]) if k != without), Counter()) for x in (own, 1 - own))
        sizes = [n - len(range(without, n, _FOLDS)) if without is not None else n for n in (nt, no)]
        spans = telling_spans(a, b, sizes[own], sizes[1 - own])
        return body + b" " + b" ".join(reversed(spans)) + b" " + _PRIME  # near offsets are the cheapest: best ones last

    lengths, y = [], []
    for fold in range(_FOLDS):
        part = ToxicityModel(toxic=content(0, fold), ordinary=content(1, fold))
        unseen = toxic[fold::_FOLDS] + ordinary[fold::_FOLDS]
        lengths += part.lengths(unseen)
        y += [1] * len(toxic[fold::_FOLDS]) + [0] * len(ordinary[fold::_FOLDS])
    y = np.array(y)
    model = ToxicityModel(toxic=content(0, None), ordinary=content(1, None))
    known = np.concatenate([n for n, c in zip(lengths, y) if not c])
    spread = float(known[:, 0].var())
    slope = float(((known[:, 0] - known[:, 0].mean()) * known[:, 1]).mean()) / spread if spread else 0.0
    model.expected = float(known[:, 1].mean() - slope * known[:, 0].mean()), slope
    model.bar = float(np.quantile(model.distances(known), _ORDINARY_QUANTILE))
    x = np.array([model.features(model.distances(n)) for n in lengths])
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.c_[np.ones(len(x)), (x - model.mean) / model.scale]
    model.weights = _logistic(x, y)
    model.weights[0] -= _best_cut(x @ model.weights, y, share)
    return model


def _without_copies(texts: list[str]) -> list[str]:
    """Texts without those that share half of their smallest hashes of three words with an earlier one: copies
    must not pass for evidence."""
    seen: dict[int, list[int]] = {}
    kept = []
    for text in texts:
        words = text.lower().encode().split()
        marks = sorted({zlib.crc32(b" ".join(words[i : i + 3])) for i in range(len(words))})[:16]
        met = Counter(i for mark in marks for i in seen.get(mark, ()))
        if marks and met and max(met.values()) * 2 >= len(marks):
            continue
        for mark in marks:
            seen.setdefault(mark, []).append(len(kept))
        kept.append(text)
    return kept


def is_held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> ToxicityModel:
    """Learn from labelled rows that aren't held out: at most ``SAMPLE_PER_CLASS`` of each label, chosen by a hash
    of the key among texts of at most ``SAMPLE_BYTES``, so the driver gets a bounded number of bytes.

    Null labels and keys teach nothing; a key labelled both ways counts as toxic; of a key with several texts one is taken.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~is_held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    short = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).where(F.octet_length("_text") <= SAMPLE_BYTES)
    usable = known.join(short.select("_id").distinct(), "_id")
    counts = {r["_toxic"]: r["n"] for r in usable.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("_id")
    chosen = [usable.where(F.col("_toxic") == c).orderBy(order, "_id").limit(SAMPLE_PER_CLASS) for c in (1, 0)]
    ids = chosen[0].unionByName(chosen[1])  # bounded: 2 * SAMPLE_PER_CLASS rows
    # Of a key's texts the one with the smallest hash, so a repeated key gives the same model every time.
    first = F.min(F.struct(F.xxhash64("_text").alias("mark"), F.col("_text").alias("text"))).alias("first")
    rows = short.join(F.broadcast(ids), "_id").groupBy("_id", "_toxic").agg(first)
    rows = sorted(rows.collect(), key=lambda r: r["_id"])
    found = {c: [r["first"]["text"] for r in rows if r["_toxic"] == c] for c in (1, 0)}
    total = sum(counts.values())
    return train(found[1], found[0], counts.get(1, 0) / total if total else 0.0)


def toxicity_score(text: Column | str, model: ToxicityModel) -> Column:
    """Score of every whole text, 0 to 1, 0.5 or more where toxic is the likelier; null texts are empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return score(text)


def with_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", to: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` and ``to``, by a model learnt from ``labels``; a column ``to`` is replaced.

    Null texts are scored as empty ones; null and repeated keys are rows like others. ``is_held_out`` is null for a null key.
    """
    return docs.withColumn(to, toxicity_score(text, fit_toxicity(docs, labels, key, text)))
