"""Every stage of the pipeline on its own input, against a plain version."""

from __future__ import annotations

import random
from collections import Counter
from zlib import crc32

import pytest

import corpus_pipeline
from helpers import DOCUMENT_DDL, clashing, empty, messy
from ledgerloom.llm import mixing
from ledgerloom.llm.common import written
from test_packing import check as check_packing
from test_simhash import plain_components, plain_simhash


@pytest.fixture(scope="module")
def stages(spark, small):
    """(docs that a stage read, rows it made) by name."""
    docs, found = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, small), name)
        found[name] = (docs.collect(), after.collect())
        docs = after
    return found


def test_language_id_keeps_what_has_a_language(stages):
    before, after = stages["language_id"]
    assert sorted(after) == sorted(before)  # all documents of the small table are in some language


def test_one_document_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    ordered = sorted(before, key=lambda r: r.doc_id)
    root = plain_components([plain_simhash(r.text) for r in ordered], 3)
    assert sorted(after) == [ordered[n] for n in sorted(set(root))]
    assert len(after) < len(before)


def test_the_mix_comes_near_its_targets(stages):
    before, after = stages["source_mixing"]
    assert set(after) <= set(before)
    assert max(Counter(r.doc_id for r in after).values()) <= 3
    words = lambda rows, name: sum(len(r.text.split()) for r in rows if r.source == name)
    names = sorted({r.source for r in before})
    sizes = [words(before, name) for name in names]
    for name, aim in zip(names, mixing.targets(sizes, mixing.default_weights(len(names))), strict=True):
        largest = max(len(r.text.split()) for r in before if r.source == name)
        assert abs(words(after, name) - aim) <= largest / 2 + 1


def test_everything_is_packed(stages):
    before, after = stages["best_fit_packing"]
    check_packing(after, [(r.doc_id, r.text) for r in before], 4096)


def test_run_is_the_stages_in_turn(spark, small, stages):
    found = corpus_pipeline.run(spark, small)
    _, last = stages["best_fit_packing"]
    piece = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(piece, found.collect())) == Counter(map(piece, last))


def test_awkward_tables_pass_all_stages(spark, small):
    for table in (messy(spark), clashing(messy(spark)), empty(spark)):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, small), name)
            assert docs.columns == table.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()


def test_rejected_documents_go(spark, small):
    rows = [(1, "das ist ein Satz", "de", "a", 16), (2, "123 !!!", "de", "a", 7), (3, None, None, "a", 0)]
    docs = spark.createDataFrame(rows, DOCUMENT_DDL)
    assert [r.doc_id for r in corpus_pipeline.identified(spark, docs, small).collect()] == [1]


def test_noise_goes_and_single_words_stay(spark, small):
    draw = random.Random(11)
    given = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    alphabets = ["0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмно", "αβγδεζηθικλμνξ"]
    alphabets.append("".join(map(chr, range(0x4E00, 0x5000))))
    noise = ["".join(draw.choices(letters, k=500)) for letters in alphabets for _ in range(20)]
    texts = [r.text for r in given.limit(150).collect()]
    words = [word for text in texts for word in text.split()[:1] if any(map(str.isalpha, word))]
    rows = [(10**9 + n, text, None, "a", len(text)) for n, text in enumerate(noise)]
    rows += [(2 * 10**9 + n, word, None, "a", len(word)) for n, word in enumerate(words)]
    docs = given.unionByName(spark.createDataFrame(rows, DOCUMENT_DDL))
    kept = Counter(r.doc_id // 10**9 for r in corpus_pipeline.identified(spark, docs, small).collect())
    assert kept[1] <= len(noise) // 20
    assert (kept[0], kept[2]) == (given.count(), len(words))


def test_language_id_learns_from_every_labelled_row(spark, small):
    """One labelled document, which op9 would hold out."""
    held_out = next(n for n in range(100) if crc32(str(n).encode()) % 4 == 2)
    docs = spark.createDataFrame([(held_out, "das ist ein Satz", "de", "a", 16)], DOCUMENT_DDL)
    assert corpus_pipeline.identified(spark, docs, small).count() == 1
