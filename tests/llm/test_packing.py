"""Packing against the tokenizer's own ids and one global best-fit."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing, crc_of, empty, ids_of, messy
from ledgerloom.llm import packing


def check(rows, documents, capacity):
    """Every piece of every document once, right ids, sequences gapless and within capacity."""
    wanted = defaultdict(int)
    for key, text in documents:
        ids = ids_of(text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            wanted[(key, piece, start, len(part), crc_of(part))] += 1
    found, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        found[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best(rows, capacity):
    lengths = np.asarray([r.length for r in rows])
    return int(packing.best_fit(lengths, capacity).max()) + 1


@pytest.mark.parametrize("group_bins", [5, packing.GROUP_BINS])
def test_documents_are_packed_nearly_as_well_as_at_once(spark, small, group_bins):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").repartition(7)
    rows = packing.pack(documents, group_bins=group_bins).collect()
    count = check(rows, [tuple(r) for r in documents.collect()], packing.CAPACITY)
    assert count <= 1.1 * best(rows, packing.CAPACITY) + 1


def test_small_sequences_and_ids(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").limit(60)
    rows = packing.pack(documents, capacity=100, with_ids=True).collect()
    check(rows, [tuple(r) for r in documents.collect()], 100)
    texts = dict(documents.collect())
    for r in rows[:200]:
        part = ids_of(texts[r.doc_id])[r.start : r.start + r.length]
        assert np.frombuffer(r.ids, "<u4").tolist() == part


def test_awkward_rows(spark):
    table = messy(spark)
    rows = packing.pack(clashing(table)).collect()
    check(rows, [(r.doc_id, r.text) for r in table.collect()], packing.CAPACITY)
    assert packing.pack(empty(spark)).count() == 0


def test_bins_that_cannot_be_merged_are_emitted(spark):
    documents = spark.range(40).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("the "), 60).alias("text")
    )
    rows = packing.pack(documents.repartition(8), capacity=100, group_bins=4).collect()
    assert len({r.sequence_id for r in rows}) == 40


def test_best_fit_takes_the_tightest_bin():
    bins = packing.best_fit(np.asarray([60, 50, 40, 50]), 100)
    assert bins[0] == bins[2] and bins[1] == bins[3] and bins[0] != bins[1]
