"""Token counts by a deterministic transducer compiled from a byte-pair vocabulary.

The transducer reads the bytes of words; the last byte of a word is a symbol of its own. Its states stand for how the
bytes read so far may still merge; each transition carries the change of the number of tokens. A word's last
symbol leads back to the start, so the counts of a text are the sum of its transitions. States and transitions
are compiled when a text first needs them, and forgotten when there are too many.

Symbols of many texts form one stream, cut into chunks that advance side by side. What a chunk does is a map
from the state before it to the state after it: constant as soon as a word ends inside the chunk, since the start
state follows. A prefix scan over the chunks composes these maps and so finds the state before each of them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encoders import WordEncoder, byte_alphabet, definition_of, grouped, is_plain, is_settled, spaced_words

# Counts do not depend on these; they bound a worker's memory.
MAX_STATES = 131_000
GROUP_CHARS = 4_000_000
_CHUNK = 512
_FINAL = 256


class Merges:
    """The vocabulary as tuples of symbols (byte, plus 256 for a word's last one)."""

    def __init__(self, definition: str):
        model = json.loads(definition)["model"]
        self.end = model["end_of_word_suffix"]
        self.code = {c: b for b, c in enumerate(byte_alphabet())}
        self.rank = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.rank[self.symbols(left), self.symbols(right)] = rank
        known = {self.symbols(t) for t in model["vocab"]} | {(b + f,) for b in range(256) for f in (0, _FINAL)}
        self.tokens = {t for t in known if self.split(t) == [t]}
        self.prefixes = {t[:n] for t in self.tokens for n in range(1, len(t))}
        self.pairs: dict = {}

    def symbols(self, token: str) -> tuple[int, ...]:
        last = token.endswith(self.end)
        codes = [self.code[c] for c in (token[: -len(self.end)] if last else token)]
        return (*codes[:-1], codes[-1] + _FINAL * last) if codes else ()

    def split(self, text: tuple[int, ...]) -> list[tuple[int, ...]]:
        """Byte-pair merging: the pair of lowest rank first, leftmost among equals."""
        parts = [(s,) for s in text]
        while len(parts) > 1:
            ranks = [self.rank.get(p, len(self.rank)) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == len(self.rank):
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, left: tuple[int, ...], right: tuple[int, ...]) -> bool:
        """Whether merging leaves these two neighbours as they are; a text's tokens are those whose neighbours
        all do."""
        found = self.pairs.get((left, right))
        if found is None:
            found = self.pairs[left, right] = self.split(left + right) == [left, right]
        return found


class Transducer:
    """States are tuples of places where a token may still begin: (bytes read since, the token before it, its
    count less the present one), longest first."""

    def __init__(self, definition: str):
        self.merges = Merges(definition)
        self.reset()

    def reset(self) -> None:
        self.states: list = [(((), None, 0),)]
        self.number = {self.states[0]: 0}
        self.column = np.full(2 * _FINAL, -1, np.int64)
        self.columns = 0
        self.next = np.full((1_024, 64), -1, np.int32)
        self.change = np.zeros((1_024, 64), np.int8)
        self.merges.pairs.clear()

    def columns_of(self, symbols: np.ndarray) -> np.ndarray:
        """Table columns of the symbols; new symbols get new columns."""
        for symbol in np.flatnonzero(np.bincount(symbols, minlength=2 * _FINAL)):
            if self.column[symbol] < 0:
                self.column[symbol] = self.columns
                self.columns += 1
        if self.columns > self.next.shape[1]:
            wider = ((0, 0), (0, self.columns))
            self.next = np.pad(self.next, wider, constant_values=-1)
            self.change = np.pad(self.change, wider)
        self.symbol = np.zeros(self.next.shape[1], np.int64)
        used = np.flatnonzero(self.column >= 0)
        self.symbol[self.column[used]] = used
        return self.column[symbols]

    def compile(self, state: int, column: int) -> None:
        symbol, merges = int(self.symbol[column]), self.merges
        places = self.states[state]
        for since, before, count in places:
            token = (*since, symbol)
            if token in merges.tokens and (before is None or merges.stay_apart(before, token)):
                change = count + 1
                break
        if symbol >= _FINAL:
            target = 0
        else:
            alive = [(t, b, c - change) for s, b, c in places if (t := (*s, symbol)) in merges.prefixes]
            key = (*alive, ((), token, 0))
            target = self.number.get(key)
            if target is None:
                target = self.number[key] = len(self.states)
                self.states.append(key)
                if target >= len(self.next):
                    self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                    self.change = np.concatenate([self.change, np.zeros_like(self.change)])
        self.next[state, column], self.change[state, column] = target, change

    def step(self, state: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        after = self.next[state, column]
        missing = np.flatnonzero(after < 0)
        if len(missing):
            width = self.next.shape[1]
            for pair in np.unique(state[missing].astype(np.int64) * width + column[missing]).tolist():
                self.compile(*divmod(pair, width))
            after = self.next[state, column]
        return after, self.change[state, column]

    def changes(self, symbols: np.ndarray) -> np.ndarray:
        """The change of the count at every symbol of a stream of whole words."""
        n = len(symbols)
        chunks = -(-n // _CHUNK)
        columns = self.columns_of(symbols)
        ends = symbols >= _FINAL
        last = np.full(chunks * _CHUNK, False)
        last[:n] = ends
        grid = last.reshape(chunks, _CHUNK)
        constant = grid.any(axis=1)
        first_end = np.where(constant, grid.argmax(axis=1), _CHUNK)
        starts = np.arange(chunks) * _CHUNK
        stops = np.minimum(starts + _CHUNK, n)
        out = np.zeros(n, np.int8)
        # A chunk behind its first word end starts from state 0, whatever came before.
        begin = np.where(constant, starts + first_end + 1, stops)
        begin[0] = 0
        after = self._advance(columns, out, begin, stops, np.zeros(chunks, np.int64))
        # Composition: the state before a chunk is that of the nearest constant map to its left (the stream's start
        # is one) carried over the chunks between; those are read in the same stride.
        constant[0] = True
        nearest = np.maximum.accumulate(np.where(constant, np.arange(chunks), 0))
        open_ = np.flatnonzero(constant)
        upto = np.append(open_[1:], chunks)  # the next chunk with a word end
        heads_end = np.where(upto < chunks, starts[np.minimum(upto, chunks - 1)] + first_end[np.minimum(upto, chunks - 1)] + 1, n)
        assert (nearest[np.minimum(upto, chunks) - 1] == open_).all()
        self._advance(columns, out, stops[open_], np.minimum(heads_end, n), after[open_])
        return out

    def _advance(self, columns, out, begin, stop, state) -> np.ndarray:
        """Read [begin, stop) of every chunk side by side; returns the states behind them."""
        state, length = state.copy(), stop - begin
        order = np.argsort(-length, kind="stable")
        lanes = order[: int((length > 0).sum())]
        now, at, left = state[lanes], begin[lanes], length[lanes]
        while len(lanes):
            now, change = self.step(now, columns[at])
            out[at] = change
            at, left = at + 1, left - 1
            if left[-1] == 0:
                live = int(np.searchsorted(-left, 0))
                state[lanes[live:]] = now[live:]
                lanes, now, at, left = lanes[:live], now[:live], at[:live], left[:live]
        return state


def word_symbols(spaced: bytes | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words between spaces, and their places."""
    codes = np.frombuffer(spaced, np.uint8)
    inside = codes != 32
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    places = np.flatnonzero(inside)
    return codes[places].astype(np.int64) + _FINAL * last[places], places


class TokenCounter:
    """Counts the tokens of texts as the tokenizers library does, special strings included."""

    def __init__(self, definition: str):
        self.encoder, self.transducer = WordEncoder(definition), Transducer(definition)
        special = sorted((t["content"] for t in json.loads(definition)["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def count(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros(len(texts), np.int64)
        plain = np.array([is_plain(text) for text in texts], bool)
        parts, owners = [], []
        if plain.any():
            spaced = spaced_words([t for t, p in zip(texts, plain) if p], self.encoder.classes)
            lines = [s.encode() for s in spaced]
            sizes = np.array([len(s) + 1 for s in lines])
            symbols, places = word_symbols(b" ".join(lines))
            parts.append(symbols)
            owners.append(np.flatnonzero(plain)[np.searchsorted(np.cumsum(sizes), places, side="right")])
        for k in np.flatnonzero(~plain).tolist():
            if not is_settled(texts[k]):
                counts[k] = len(self.encoder.library(texts[k])) // self.encoder.dtype.itemsize
                continue
            pieces = self.special.split(texts[k]) if self.special else [texts[k]]
            counts[k] += len(pieces) - 1
            words = [w for piece in pieces for w in self.encoder.pattern_words(piece)]
            symbols, _ = word_symbols(" ".join(words).encode())
            parts.append(symbols)
            owners.append(np.full(len(symbols), k))
        stream = np.concatenate(parts) if parts else np.empty(0, np.int64)
        if len(stream):
            changes = self.transducer.changes(stream)
            counts += np.bincount(np.concatenate(owners), weights=changes, minlength=len(texts)).astype(np.int64)
        if len(self.transducer.states) > MAX_STATES:
            self.transducer.reset()
        return counts


def token_counts(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes (UTF-8) and n_tokens of every row; null texts are empty. Keys play no part."""
    definition = docs.sparkSession.sparkContext.broadcast(definition_of(tokenizer_path))
    rows = docs.select(F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(definition.value)
        for batch in batches:
            found = [counter.count(group) for group in grouped(batch.column(2).to_pylist(), GROUP_CHARS)]
            total = pa.array(np.concatenate(found) if found else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], total], schema.names)

    return rows.mapInArrow(count, schema)
