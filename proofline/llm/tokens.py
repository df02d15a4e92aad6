"""Token ids of whole texts, every different word encoded once.

A byte-level tokenizer splits a text into words before its merges and treats a word alike
wherever it stands, so a worker keeps the ids of the words it has met.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers

VOCABULARY = "byte_bpe_50k.json"
# words that a worker keeps before it begins anew, and the longest of them
KEPT_WORDS = 300_000
KEPT_WORD_CHARS = 64

# The split of byte-level vocabularies for texts of plain signs and Latin letters, where
# Python's expressions can state it; other texts are encoded whole by the library.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ʯ"
_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \t\n\r0-9{_LETTERS}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)
_PLAIN = re.compile(rf"[ -~\t\n\r{_LETTERS}]*")

# The byte-level alphabet: printable bytes stand for themselves, the others follow at U+0100.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _packed(ids: Sequence[int]) -> bytes:
    return array("I", ids).tobytes() if array("I").itemsize == 4 else np.array(ids, "<u4").tobytes()


class _Words(dict):
    """The packed ids of words, found by the merges of the vocabulary when first asked for."""

    def __init__(self, model):
        super().__init__()
        self._model = model

    def __missing__(self, word: str) -> bytes:
        letters = word.encode("utf-8").decode("latin-1").translate(_BYTE_LETTERS)
        ids = _packed([t.id for t in self._model.tokenize(letters)])
        if len(word) <= KEPT_WORD_CHARS:
            self[word] = ids
        return ids


class WordTokenizer:
    """Encodes whole texts with the tokenizers library, without added special tokens."""

    def __init__(self, path: str):
        # tasks share the cores already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # only the plain byte-level form is split here
        self._by_word = (
            type(self._tokenizer.pre_tokenizer).__name__ == "ByteLevel"
            and not self._tokenizer.pre_tokenizer.add_prefix_space
            and self._tokenizer.normalizer is None
        )
        self._words = _Words(self._tokenizer.model)

    def encode_whole(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; no text has none."""
        if not text:
            return b""
        if not self._by_word or not _PLAIN.fullmatch(text) or any(s in text for s in self._special):
            return self.encode_whole(text)
        if len(self._words) > KEPT_WORDS:
            self._words.clear()
        return b"".join(map(self._words.__getitem__, _WORD.findall(text)))


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(vocabulary: str = VOCABULARY) -> WordTokenizer:
    """The tokenizer of this worker; ``vocabulary`` is a public tokenizer's file name or a path."""
    path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def encoded(texts: Sequence[str | None], vocabulary: str = VOCABULARY) -> Iterator[bytes]:
    return map(word_tokenizer(vocabulary).encode, texts)
