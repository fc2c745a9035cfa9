"""Texts encoded by pieces: ids as the library's, and few calls of it."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketmill.llm import packing, piecewise, queries, records

ODD = " .,'’\"()_-sStTİΣßǅﬁéÃ×÷́̇\t\n\r\x0b\x1c\x85\xa0   　​1½²日<|endoftext|>"


def encoders():
    return packing.word_encoder(queries.WORD_TOKENIZER, "<u2"), records.encoder(queries.TOKENIZER, "<u2")


def library(path):
    return Tokenizer.from_file(path)


WHOLE = [library(queries.WORD_TOKENIZER), library(queries.TOKENIZER)]


def same(texts):
    for enc, tok in zip(encoders(), WHOLE):
        for got, text in zip(enc.encode(texts), texts, strict=True):
            assert np.frombuffer(got, "<u2").tolist() == tok.encode(text or "", add_special_tokens=False).ids, text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(ODD), st.characters(codec="utf-8")), max_size=60), max_size=4))
def test_any_texts_encode_like_the_library(texts):
    same(texts)


def test_odd_texts_nulls_and_slices():
    texts = [None, "", " ", "é. à, ×. ÷, a.b,c", "  x 　 y", "(a). b_, c", "<|endoftext|>, x <|endoftext|> y.<|endoftext|>", "x" * 9000 + ", y", None]
    same(texts)
    part = pa.array(["left out", *texts, "too"]).slice(1, len(texts))
    for enc in encoders():
        assert enc.encode(part) == enc.encode(texts)
        assert enc.encode([]) == [] and enc.encode([None, ""]) == [b"", b""]


def test_the_store_is_bounded_and_steps_do_not_matter(monkeypatch):
    monkeypatch.setattr(piecewise, "CACHE_PIECES", 50)
    monkeypatch.setattr(piecewise, "STEP", 64)
    rng = np.random.default_rng(2)
    for make, path in ((packing.WordEncoder, queries.WORD_TOKENIZER), (piecewise.ByteEncoder, queries.TOKENIZER)):
        enc, tok = make(path, "<u2"), library(path)
        for _ in range(20):
            texts = [" ".join(f"w{chr(97 + i % 26)}{'xyz'[i % 3] * (i % 7)}, é" for i in rng.integers(0, 400, 30)) for _ in range(3)]
            for got, text in zip(enc.encode(texts), texts):
                assert np.frombuffer(got, "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids
            assert len(enc.n) == len(enc.kept) == len(enc.used) <= 50 + 64 and len(enc.flat) == enc.n.sum()


class Counted:
    def __init__(self, tok):
        self.tok, self.texts = tok, 0

    def encode_batch_fast(self, texts, **kw):
        self.texts += len(texts)
        return self.tok.encode_batch_fast(texts, **kw)


@pytest.mark.parametrize("which", [0, 1])
def test_new_words_go_to_the_library_together(which):
    enc = type(encoders()[which])([queries.WORD_TOKENIZER, queries.TOKENIZER][which], "<u2")
    enc.tok = Counted(enc.tok)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c for a in letters for b in letters for c in "xyz"]
    # a stop after a sign elsewhere in the text leaves the cuts before other stops as they are
    enc.encode(['(see). ' + ", ".join(words)])
    assert enc.tok.texts < 20
