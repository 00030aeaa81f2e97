"""Language ID: held-out accuracy, exact sums, undetermined texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from helpers import clashing, empty, messy
from ledgerloom.llm import language


def test_held_out_documents_are_recognised(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    out = language.held_out(F.col("doc_id"))
    prototypes = language.train(documents.filter(~out))
    assert sorted(prototypes) == ["de", "en", "es", "fr"]
    judged = language.predict(documents.filter(out), prototypes).collect()
    right = [r.lang == r.lang_pred for r in judged]
    assert len(right) > 20 and sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in judged)


def plain_vector(text):
    """Trigram by trigram."""
    codes = [0]
    for c in text.lower():
        code = ord(c) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    if codes[-1]:
        codes.append(0)
    total = np.zeros(language.DIMENSION, np.int64)
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        first, second, third = (language.letter_vector(x).astype(np.int64) for x in (a, b, c))
        total += np.roll(first, 2) * np.roll(second, 1) * third
    return total


TEXTS = ["Das ist gut.", "", ".", "a", "...", None, "ñandú é", "ab", "1", "x y", "\U0001f600", "中文字符。中文"]


def test_bundles_are_sums_of_bound_trigrams(monkeypatch):
    for size in (1, 2, 3, len(TEXTS)):
        monkeypatch.setattr(language, "BATCH_TEXTS", size)
        vectors, letters = language.bundle(TEXTS, list(range(len(TEXTS))), len(TEXTS))
        for text, vector, count in zip(TEXTS, vectors, letters, strict=True):
            assert (vector == plain_vector(text or "")).all(), text
            assert count == any(c.isalpha() for c in (text or "").lower())
    one, _ = language.bundle(TEXTS, [0] * len(TEXTS), 1)
    assert (one[0] == sum(plain_vector(t or "") for t in TEXTS)).all()


def test_rare_letters_take_the_sorting_path(monkeypatch):
    text = "".join(chr(0x4E00 + n % 300) for n in range(2000))
    monkeypatch.setattr(language, "TRIGRAMS", 70)
    vectors, _ = language.bundle([text, "abc"], [0, 1], 2)
    assert (vectors[0] == plain_vector(text)).all() and (vectors[1] == plain_vector("abc")).all()


def test_a_long_text_is_bundled_in_pieces(monkeypatch):
    text = "Thandorea enthe, ereonti. " * 300
    whole, _ = language.bundle([text], [0], 1)
    monkeypatch.setattr(language, "BATCH_CHARS", 1000)
    pieces, _ = language.bundle([text], [0], 1)
    assert (whole == pieces).all()


def test_awkward_rows(spark):
    prototypes = language.train(messy(spark))
    judged = language.predict(clashing(messy(spark)), prototypes).collect()
    assert len(judged) == messy(spark).count()
    for r in judged:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in prototypes
        assert r.row == "kept"
    assert language.train(empty(spark)) == {}
    assert {r.lang_pred for r in language.predict(messy(spark), {}).collect()} == {"und"}
    assert language.predict(empty(spark), prototypes).count() == 0


def test_prototypes_do_not_depend_on_the_order_of_rows(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    first, second = (language.train(frame) for frame in (documents, documents.repartition(6, "source")))
    assert all((first[name] == second[name]).all() for name in first)
