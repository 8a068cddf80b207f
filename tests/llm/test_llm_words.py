"""The word-wise tokenizer against the library on whole texts."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_engine.llm import word_tokens
from corpus_engine.llm.word_tokens import WordEncoder, default_tokenizer

ENCODER = WordEncoder(default_tokenizer())
PIECES = st.sampled_from(["a", "A", "é", "É", ".", ",", "'", "s", "t", "I", "İ", "̇", "́", "ß", " ", "\n", "\t", "1", "²", "Ω", "日", "क़",
                          "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "...", "don't", " ", "\x1c", "word", "Thing."])


def whole(text):
    return ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def ours(text):
    return np.frombuffer(ENCODER.encode(text.encode()), "<u2").tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_ids_equal_the_library(text):
    assert ours(text) == whole(text)


def test_a_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(word_tokens, "CACHE_WORDS", 5)
    text = " ".join(f"word{c}." for c in "abcdefghijkl")
    assert ours(text) == whole(text)
    assert ours("a b c d e f g") == whole("a b c d e f g")


def test_nothing():
    assert ENCODER.encode(None) == ENCODER.encode(b"") == b""
