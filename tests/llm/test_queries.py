"""Every registered query on the small tables, against SQL or a plain version."""

from __future__ import annotations

import hashlib
import importlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from helpers import crc_of, ids_of
from ledgerloom.llm import mixing
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.sql import ORACLES
from oracle_check import connect, difference
from test_chunks import plain as plain_chunks
from test_packing import check as check_packing
from test_simhash import plain_components, plain_simhash


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert difference(QUERIES[name](spark, small), connect(small), ORACLES[name]) is None


def test_awkward_conversations_equal_sql(spark, tmp_path):
    rows = [
        (1, 0, "user", "Hello."),
        (1, None, "assistant", "Before all."),
        (1, None, None, None),
        (1, 2, "assistant", "</s>\\[INST]"),
        (1, 2, "assistant", "</s>\\[INST]"),
        (2, None, "user", ""),
        (3, 5, None, "no role"),
        (3, 4, "assistant", "long " * 50_000),
    ]
    kinds = "conv_id bigint, turn int, role string, text string"
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "conversations.parquet"))
    name, connection = "op1_chat_format", duckdb.connect()
    connection.sql(f"create view conversations as from '{tmp_path}/conversations.parquet/*.parquet'")
    assert difference(QUERIES[name](spark, str(tmp_path)), connection, ORACLES[name]) is None


def test_vectors_of_unequal_length_equal_sql(spark, tmp_path):
    rows = [(n, [((n * 37 + k * 11) % 19 - 9) / 8 for k in range(1 + n % 4)]) for n in range(120)]
    rows += [(200, None), (250, [1.0, None]), (300, [float("nan")]), (350, []), (351, [float("inf")])]
    kinds = "vec_id bigint, embedding array<float>"
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "embeddings.parquet"))
    name, connection = "op10_exact_top_k", duckdb.connect()
    connection.sql(f"create view embeddings as from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert difference(QUERIES[name](spark, str(tmp_path)), connection, ORACLES[name]) is None


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    contract = importlib.import_module("__spark_entry__")
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_fingerprints(spark, small, documents):
    found = [tuple(r) for r in QUERIES["op2_document_fingerprints"](spark, small).collect()]
    assert sorted(found) == sorted(plain_chunks(sorted((r.doc_id, r.text) for r in documents)))


def test_sharding(spark, small, documents):
    rows = QUERIES["op3_sharding"](spark, small).collect()
    data = {r.doc_id: (r.text or "").encode() for r in documents}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        key: (len(text) + 1, zlib.crc32(text)) for key, text in data.items()
    }
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    largest = max(map(len, data.values()))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)


def test_packing(spark, small, documents):
    rows = QUERIES["op5_best_fit_packing"](spark, small).collect()
    count = check_packing(rows, [(r.doc_id, r.text) for r in documents], 4096)
    assert count <= 1.03 * sum(r.length for r in rows) / 4096 + 1


def test_simhash(spark, small, documents):
    rows = QUERIES["op6_simhash_near_dedup"](spark, small).collect()
    ordered = sorted(documents, key=lambda r: r.doc_id)
    prints = [plain_simhash(r.text) for r in ordered]
    root = plain_components(prints, 3)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        r.doc_id: (f"{p:016x}", ordered[n].doc_id) for r, p, n in zip(ordered, prints, root, strict=True)
    }


def test_mixing(spark, small, documents):
    rows = QUERIES["op7_source_mixing"](spark, small).collect()
    sizes = {r.doc_id: len((r.text or "").split()) for r in documents}
    assert {r.doc_id: r.size for r in rows} == sizes
    source = {r.doc_id: r.source for r in documents}
    totals = Counter()
    for key, size in sizes.items():
        totals[source[key]] += size
    names = sorted(totals)
    wanted = dict(zip(names, mixing.targets([totals[n] for n in names], [1, 2, 3] * len(names)), strict=False))
    taken = Counter()
    for r in rows:
        name = source[r.doc_id]
        assert (r.source_size, r.target) == (totals[name], pytest.approx(wanted[name]))
        assert r.taken <= 3 * r.size
        taken[name] += r.taken
    assert all(abs(taken[name] - wanted[name]) <= 1 for name in names)


def test_records(spark, small, documents):
    rows = sorted(QUERIES["op8_token_records"](spark, small).collect())
    start = 0
    for r, document in zip(rows, sorted(documents, key=lambda d: d.doc_id), strict=True):
        ids = ids_of(document.text)
        assert tuple(r) == (document.doc_id, start, len(ids), crc_of(ids))
        start += len(ids)


def test_language(spark, small, documents):
    rows = QUERIES["op9_language_id"](spark, small).collect()
    lang = {r.doc_id: r.lang for r in documents}
    assert {r.doc_id: r.held_out for r in rows} == {
        key: zlib.crc32(str(key).encode()) % 4 == 2 for key in lang
    }
    out = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(out) >= 0.97 * len(out)


def test_the_extra_conversation(spark, small):
    (row,) = QUERIES["op1_chat_format"](spark, small).filter("conv_id = -7").collect()
    said = "</s>[INST] ok [/INST]"
    turns = f"user\n{said}\nassistant\n{said}\n"
    assert row.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert (row.n_turns, row.loss_chars) == (2, len(said))
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
