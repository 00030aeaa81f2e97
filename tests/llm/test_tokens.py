"""Word-wise ids are the tokenizer's own ids of the whole text."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import ids_of
from ledgerloom.llm import common, tokens

ENCODER = tokens.encoder(tokens.tokenizer_path())
PIECES = st.lists(
    st.sampled_from(["the", " ", "\n", "\t", "\r\n", "'s", "don't", "́", "é", "İ", "Σ", "ς", " ", "\x1c",
                     " ", "<|endoftext|>", "<|start", "oftext|>", "12", "½", "\U0001f600", "ß", "a" * 90, "Ａ"])
    | st.text(max_size=6)
)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_words_give_the_ids_of_the_text(pieces):
    import numpy as np

    text = "".join(pieces)
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids_of(text)[:-1]


def test_the_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    small = tokens.WordEncoder(tokens.tokenizer_path())
    for n in range(20):
        text = f"word some{n} other{n} " + "x" * 100
        assert small.encode(text) == ENCODER.encode(text)
        assert len(small.known) < 12


def test_all_latin_characters_alone_and_in_a_word():
    import numpy as np

    characters = [chr(n) for n in range(256)]
    texts = characters + [f"a{c}b" for c in characters] + [f"1{c}'s{c}" for c in characters]
    for text, ids in zip(texts, ENCODER.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)[:-1], repr(text)


def test_one_text_of_many_words_keeps_the_bound(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    small = tokens.WordEncoder(tokens.tokenizer_path())
    text = " ".join(f"wörd{chr(97 + n % 26)}{chr(97 + n // 26)}, the no{n}% a.b" for n in range(600))
    assert small.encode(text) == ENCODER.encode(text)
    assert np.frombuffer(small.encode(text), "<u4").tolist() == ids_of(text)[:-1]
    assert len(small.known) <= 50


def test_an_encoder_takes_the_memory_of_other_work(monkeypatch):
    kept = {"of other work": object()}
    monkeypatch.setattr(common, "KEPT_BY_WORKER", kept)
    monkeypatch.setattr(tokens, "KEPT_BY_WORKER", kept)
    found = tokens.encoder(tokens.tokenizer_path())
    assert list(kept.values()) == [found] and tokens.encoder(tokens.tokenizer_path()) is found


def test_a_word_is_learned_once_whatever_symbols_surround_it():
    small = tokens.WordEncoder(tokens.tokenizer_path())
    text = "word word, (word) word. WORD! word\xa0word"
    assert np.frombuffer(small.encode(text), "<u4").tolist() == ids_of(text)[:-1]
    assert len(small.known) == 6


LATIN = st.text(st.sampled_from("''''strevmldST 1\xb2\xe9.!\xa0\x85\x1c") | st.characters(max_codepoint=255), max_size=20)


@settings(max_examples=500, deadline=None)
@given(LATIN)
def test_latin_texts_are_cut_as_the_tokenizer_cuts_them(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids_of(text)[:-1]
