"""Content-defined chunks against plain loops."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import clashing, empty, messy
from ledgerloom.llm import chunks


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=200))
def test_the_gear_hash_of_all_places_at_once(data):
    value, wanted = 0, []
    for byte in data:
        value = (2 * value + int(chunks.GEAR[byte])) % (1 << 32)
        wanted.append(value)
    assert chunks.gear_hash(data).tolist() == wanted


def plain_boundaries(data: bytes) -> list[int]:
    hashes, ends, start = chunks.gear_hash(data).tolist(), [], 0
    for place in range(len(data)):
        size = place + 1 - start
        mask = int(chunks.STRICT if size < chunks.USUAL else chunks.LOOSE)
        if size >= chunks.MOST or size >= chunks.LEAST and not hashes[place] & mask:
            ends.append(place + 1)
            start = place + 1
    return ends + ([len(data)] if start < len(data) else [])


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=3000), st.integers(0, 3))
def test_boundaries_are_those_of_a_plain_loop(text, kind):
    data = (text * (kind + 1)).encode()
    found = chunks.boundaries(data)
    assert found == plain_boundaries(data)


def test_chunks_resist_a_shift(small):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(f"{small}/documents.parquet")["text"].to_pylist() if len(t) > 4000]
    for text in texts[:10]:
        moved = "Some words in front. " + text
        assert chunks.containment(chunks.fingerprint(text), chunks.fingerprint(moved)) > 0.9
        assert chunks.containment(chunks.fingerprint(text), chunks.fingerprint(text)) == 1.0


def test_empty_fingerprints():
    assert chunks.containment({}, {}) == 1.0
    assert chunks.containment({}, {1: 2}) == chunks.containment({1: 2}, {}) == 0.0


def plain(rows):
    """doc_id, n_chars, edited hash and likenesses of rows in order."""
    found = []
    for n, (key, text) in enumerate(rows):
        text, following = text or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = (chunks.fingerprint(t) for t in (text, edited, following))
        found.append(
            (
                key,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                chunks.encoded(own),
                chunks.encoded(other),
                chunks.containment(own, other),
                chunks.containment(own, after),
            )
        )
    return found


@pytest.mark.parametrize("chars", [20_000, 10**9])
def test_documents_against_their_successors(spark, small, chars):
    documents = spark.read.parquet(f"{small}/documents.parquet").repartition(3)
    found = [tuple(r) for r in chunks.compare_with_next(documents, chars_per_task=chars).collect()]
    wanted = plain(sorted((r.doc_id, r.text) for r in documents.collect()))
    assert sorted(found) == sorted(wanted)


@pytest.mark.parametrize("keyed", [True, False])
def test_awkward_rows(spark, keyed):
    table = messy(spark) if keyed else messy(spark).filter("doc_id is not null")
    rows = sorted(
        ((r.doc_id, r.text) for r in table.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""),
    )
    found = [tuple(r) for r in chunks.compare_with_next(clashing(table), chars_per_task=1000).collect()]
    assert sorted(found, key=str) == sorted(plain(rows), key=str)


def test_one_row_and_none(spark):
    assert chunks.compare_with_next(empty(spark)).count() == 0
    one = messy(spark).filter("doc_id = 1")
    (row,) = chunks.compare_with_next(one).collect()
    assert row.near_next == 1.0


def test_fingerprint_column(spark):
    rows = messy(spark).select("text", chunks.fingerprint_column(F.col("text")).alias("found")).collect()
    assert all(r.found == chunks.encoded(chunks.fingerprint(r.text)) for r in rows)
