"""Word-wise encoding equals the library's own on whole texts."""

from __future__ import annotations

import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from proofline.llm.tokens import word_tokenizer

ODD = ["", " ", "  a", "a \nb", "a\n\n b c", "it's I'll a'b c 'd", "x <|endoftext|> y", "é²½ ３ a١ b", "a b", "\x1c a", "ß ñ ʯ ʰ", "日本 語", "a\x7fb", "\t\r\n "]


def test_odd_texts():
    t = word_tokenizer()
    for text in [*ODD, *map("".join, itertools.product(["a", "'s", ".", "1", " ", "\n", "'"], repeat=5))]:
        assert t.encode(text) == t.encode_whole(text), repr(text)
    assert t.encode(None) == b""


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    t = word_tokenizer()
    assert t.encode(text) == t.encode_whole(text)
