"""Worker-side text encoding: the tokenizer's own cuts and models, about one model call per distinct word.

Two kinds of tokenizer file are known. *Word* vocabularies lower-case, drop white space and merge each word
by itself: their words are cut in bulk and looked up in a table of bounded size, and only unknown ones
go to the library's model. *Byte-level* vocabularies need every character in place: their merge table is run
over whole texts by the byte-pair engine of tiktoken, which gives the same ids. Other files are refused.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache, cached_property

import numpy as np

# Texts are encoded alike with any size of the table and of the groups; they bound a worker's memory.
CACHED_WORDS = 600_000
_LONG_WORD = 48
_GROUP_CHARS = 1_000_000

_SPACE, _LETTER, _DIGIT, _OTHER, _END = range(5)


def definition_of(path: str) -> str:
    """The tokenizer file's text; the driver reads it once and sends it to the tasks."""
    with open(path, encoding="utf-8") as source:
        return source.read()


def load_tokenizer(definition: str):
    """The tokenizer of a JSON definition, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself if it is printable
    Latin-1, else the next free one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(free)) for b in range(256)]


def pieces_by_id(definition: str) -> list[str]:
    """The vocabulary as a list: the piece of each id, added tokens included."""
    data = json.loads(definition)
    pieces = {i: t for t, i in data["model"]["vocab"].items()}
    pieces.update({t["id"]: t["content"] for t in data["added_tokens"]})
    return [pieces[i] for i in range(len(pieces))]


def latin_classes() -> np.ndarray:
    """White space, letter, digit or other for each Latin-1 character; NUL marks the end of a text."""
    import regex

    classes = np.full(256, _OTHER, np.uint8)
    for code in range(256):
        for pattern, value in ((r"\s", _SPACE), (r"\p{L}", _LETTER), (r"\p{N}", _DIGIT)):
            if regex.fullmatch(pattern, chr(code)) and not 0x1C <= code <= 0x1F:
                classes[code] = value
    classes[0] = _END
    return classes


def is_plain(text: str) -> bool:
    """Latin-1 without apostrophes, special strings or NUL: its words are runs of one class."""
    return "'" not in text and "<|" not in text and "\0" not in text and (text.isascii() or max(text) <= "ÿ")


@cache
def _is_settled(character: str) -> bool:
    old = unicodedata.ucd_3_2_0.category(character)
    return old != "Cn" and old[0] == unicodedata.category(character)[0]


def is_settled(text: str) -> bool:
    """Whether the class of every character has been the same since Unicode 3.2, so that all engines agree on
    it; other texts go to the library whole."""
    return text.isascii() or all(map(_is_settled, set(text)))


def spaced_words(texts: list[str], classes: np.ndarray) -> list[str]:
    """Plain texts lower-cased, with one space before each word and no other white space."""
    codes = np.frombuffer("\0".join(texts).lower().encode("latin-1"), np.uint8)
    kind = classes[codes]
    first = np.ones(len(kind), bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    first &= (kind != _SPACE) & (kind != _END)
    copies = (kind != _SPACE).astype(np.uint8) + first
    out = np.repeat(codes, copies)
    out[np.cumsum(copies, dtype=np.int64)[first] - 2] = 32
    return out.tobytes().decode("latin-1").split("\0")


class WordTable(dict):
    """Packed ids of words, encoded by the model when they are first asked for."""

    def __init__(self, model):
        super().__init__({"": b""})
        self.model = model
        self.letters = dict(enumerate(byte_alphabet()))

    def spelt(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.letters)

    def packed(self, word: str) -> bytes:
        return array("H", [t.id for t in self.model.tokenize(self.spelt(word))]).tobytes()

    def __missing__(self, word: str) -> bytes:
        packed = self.packed(word)
        if len(word) <= _LONG_WORD:
            self[word] = packed
        return packed


def is_word_vocabulary(definition: str) -> bool:
    """True for lower-casing vocabularies of single words, False for plain byte-level ones."""
    data = json.loads(definition)
    cut, steps = data["pre_tokenizer"] or {}, (data["normalizer"] or {}).get("normalizers", [])
    if cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and not steps:
        return False
    first = cut.get("pretokenizers", [{}])[0]
    if first.get("invert") and first["behavior"] == "Removed" and steps[-1:] == [{"type": "Lowercase"}]:
        return True
    raise ValueError("the cuts of this tokenizer are not known")


class WordEncoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does; null is empty."""

    dtype = np.dtype("<u2")

    def __init__(self, definition: str):
        self.definition, self.classes = definition, latin_classes()

    # What only some texts or tasks need is loaded when they do.
    @cached_property
    def tokenizer(self):
        tokenizer = load_tokenizer(self.definition)
        assert tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        return tokenizer

    @cached_property
    def words(self) -> WordTable:
        return WordTable(self.tokenizer.model)

    @cached_property
    def pattern(self):
        import regex

        cut = json.loads(self.definition)["pre_tokenizer"]["pretokenizers"][0]
        return regex.compile(cut["pattern"]["Regex"])

    def words_of(self, texts: list[str]) -> list[list[str]]:
        """The words of every text, some empty; None where only the library can tell."""
        plain = [is_plain(text) for text in texts]
        spaced = iter(spaced_words([t for t, p in zip(texts, plain) if p], self.classes) if any(plain) else [])
        return [next(spaced).split(" ") if p else self.other_words(t) for t, p in zip(texts, plain)]

    def other_words(self, text: str) -> list[str] | None:
        """By the tokenizer's normaliser and pattern, where the library isn't needed."""
        return None if self.needs_library(text) else self.pattern_words(text)

    @staticmethod
    def needs_library(text: str) -> bool:
        """Texts that may hold a special string, or characters that engines class differently."""
        return "<|" in text or not is_settled(text)

    def pattern_words(self, text: str) -> list[str]:
        return self.pattern.findall(self.tokenizer.normalizer.normalize_str(text)) if text else []

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for group in grouped(texts):
            find = self.words.__getitem__
            for text, words in zip(group, self.words_of(group)):
                yield self.library(text) if words is None else b"".join(map(find, words))
            if len(self.words) > CACHED_WORDS:
                self.words.clear()

    def library(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class ByteEncoder:
    """The same for byte-level vocabularies, whole texts by the merge ranks of the file."""

    dtype = np.dtype("<u4")

    def __init__(self, definition: str):
        import tiktoken

        self.tokenizer = load_tokenizer(definition)
        data, code = json.loads(definition), {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(code[c] for c in t): i for t, i in data["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ranks = {t: i for t, i in ranks.items() if i not in special.values()}
        # Fixed value: the published pattern of byte-level vocabularies.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.engine = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for text in texts:
            if text and is_settled(text):
                yield self.engine.encode_to_numpy(text, allowed_special="all").astype(self.dtype).tobytes()
            else:
                ids = self.tokenizer.encode(text or "", add_special_tokens=False).ids
                yield np.array(ids, self.dtype).tobytes()


def release_memory() -> None:
    """Hand freed memory back to the system: workers live on for later tasks, beside the executor's own heap."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_encoder(definition: str) -> WordEncoder | ByteEncoder:
    return WordEncoder(definition) if is_word_vocabulary(definition) else ByteEncoder(definition)


def grouped(texts: Iterable[str | None], chars: int = _GROUP_CHARS) -> Iterator[list[str]]:
    """Lists of texts of about ``chars`` characters; null becomes empty."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group
