"""Binary records: round trip, order, damage, shuffled reads."""

from __future__ import annotations

import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import clashing, empty, ids_of, messy
from ledgerloom.llm import records
from ledgerloom.session import fresh_dir


@settings(max_examples=100, deadline=None)
@given(st.none() | st.integers(-(1 << 63), (1 << 63) - 1), st.lists(st.integers(0, (1 << 32) - 1)))
def test_a_frame_gives_back_its_record(key, ids):
    data = b"xx" + records.frame_record(key, np.asarray(ids, "<u4").tobytes())
    found, values, end = records.read_record(memoryview(data), 2)
    assert (found, values.tolist(), end) == (key, ids, len(data))
    for cut in range(2, len(data)):
        with pytest.raises(records.RecordError):
            records.read_record(memoryview(data[:cut]), 2)


def test_every_changed_byte_is_noticed():
    data = records.frame_record(5, np.asarray([1, 2, 70000], "<u4").tobytes())
    for place in range(len(data) - 1):
        damaged = bytearray(data)
        damaged[place] ^= 0x40
        with pytest.raises(records.RecordError):
            records.read_record(memoryview(bytes(damaged)), 0)


def test_ids_that_fit_take_two_bytes():
    narrow = records.frame_record(1, struct.pack("<3I", 1, 2, 65535))
    wide = records.frame_record(1, struct.pack("<3I", 1, 2, 65536))
    assert len(wide) - len(narrow) == 6


def written(spark, frame, **options):
    path = fresh_dir(spark, "records")
    records.write_records(frame, path, **options)
    return path


def test_files_hold_the_table_in_order(spark):
    table = messy(spark)
    path = written(spark, clashing(table), chars_per_file=40_000)
    read = records.read_records(spark, path).orderBy("part", "record").collect()
    keys = [r.key for r in read]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    found = sorted((str(r.key), np.frombuffer(r.ids, "<u4").tolist()) for r in read)
    assert found == sorted((str(r.doc_id), ids_of(r.text)) for r in table.collect())


def test_the_index_leads_to_any_subset(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    path = written(spark, documents, chars_per_file=100_000)
    index = records.read_index(spark, path)
    assert index.select("part").distinct().count() > 2
    some = index.filter(F.col("key") % 7 == 3)
    read = {r.key: np.frombuffer(r.ids, "<u4").tolist() for r in records.read_records(spark, path, some).collect()}
    texts = {r.doc_id: r.text for r in documents.collect() if r.doc_id % 7 == 3}
    assert read == {key: ids_of(text) for key, text in texts.items()}


def test_empty_table(spark):
    path = written(spark, empty(spark))
    assert records.read_records(spark, path).count() == 0
    assert records.token_starts(records.read_index(spark, path)).count() == 0


def test_long_texts_side_by_side_do_not_overfill_a_file(spark):
    rows = [(n, f"wort {n}") for n in range(400)] + [(400 + n, f"{n} lang " * 700) for n in range(40)]
    rows += [(900, "immer gleich " * 400)] * 40 + [(950, "zu lang " * 4000), (None, None), (951, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    path = written(spark, table, chars_per_file=20_000)
    files = records._files(spark, path).selectExpr("part", "length(content) as size").collect()
    read = records.read_records(spark, path).orderBy("part", "record").collect()
    texts, held = {n: len(text or "") for n, text in rows}, {}
    for r in read:
        held.setdefault(r.part, []).append(texts[r.key])
    assert all(sum(lengths) <= 20_000 or len(lengths) == 1 for lengths in held.values())
    assert all(f.size <= 20_000 or len(held[f.part]) == 1 for f in files)
    assert [r.key for r in read] == sorted((n for n, _ in rows), key=lambda n: -1 if n is None else n)
    assert sorted((str(r.key), np.frombuffer(r.ids, "<u4").tolist()) for r in read) == sorted(
        (str(n), ids_of(text)) for n, text in rows
    )
    some = records.read_index(spark, path).filter(F.col("key") >= 395)
    assert records.read_records(spark, path, some).count() == some.count() == 5 + 40 + 40 + 2
