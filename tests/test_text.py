from __future__ import annotations

import base64
import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import predicates, text

AWKWARD = [
    "plain",
    "é",
    "\x7f",
    "\x01\x1f",
    'quote " and / slash',
    "a\\u00e9",
    "\\",
    "\\\\u0041é",
    "\U0001f600 smile",
    "\n\t\b\f\r",
    "日本 ",
    "\\\x7fu00E9",
    "",
    None,
]


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def test_canonical_json_is_byte_equal_to_json_dumps(spark):
    rows = [(value, place, None) for place, value in enumerate(AWKWARD)]
    frame = spark.createDataFrame(rows, "z string, a bigint, m bigint")
    found = frame.select("a", text.canonical_row_json(frame).alias("j")).orderBy("a").collect()
    assert [row["j"] for row in found] == [
        canonical({"z": value, "a": place, "m": None}) for value, place, _ in rows
    ]


def test_manifest_digest_column_equals_the_driver_digest(spark):
    document = {
        "batch_id": "b-é",
        "contract_version": "retail-v2",
        "produced_at": 5,
        "tables": {"orders": {"rows": 1, "objects": [{"key": "k", "bucket": "b", "etag": None}]}},
    }
    kind = (
        "produced_at bigint, contract_version string, batch_id string, tables struct<orders:struct<"
        "rows:bigint,objects:array<struct<key:string,bucket:string,etag:string>>>>"
    )
    frame = spark.createDataFrame([document], kind)
    found = frame.select(text.sha256_hex(text.canonical_row_json(frame)).alias("d")).first()["d"]
    assert found == text.manifest_digest({**document, "identity_digest": "ignored"})
    assert found == hashlib.sha256(canonical(document).encode()).hexdigest()


def test_generation_id(spark):
    batches = ["lab-001", "a/b c", "---", "", "x" * 80, "-é-" + "y" * 70, "ok_1"]
    frame = spark.createDataFrame([(batch, "f" * 64) for batch in batches], "b string, d string")
    found = [row[0] for row in frame.select(text.generation_id(F.col("b"), F.col("d"))).collect()]
    for batch, value in zip(batches, found):
        safe = re.sub("[^A-Za-z0-9_-]", "-", batch).strip("-")[:64] or "batch"
        digest = hashlib.sha256(f"{batch}:{'f' * 64}".encode()).hexdigest()
        assert value == f"g-{safe}-{digest[:12]}"


@pytest.mark.parametrize("name", text.PATTERNS)
def test_contract_regex_is_a_full_match(spark, name):
    samples = [
        "a",
        "a\n",
        "a" * 64,
        "a" * 64 + "\n",
        "a" * 128,
        "a" * 129,
        "-a",
        "_a1",
        "1a",
        "g-x-0123456789ab",
        "g--0123456789ab",
        "g-x-0123456789AB",
        "x\na",
        "a.b_c-d",
        "",
    ]
    frame = spark.createDataFrame([(sample,) for sample in samples], "s string")
    found = [row[0] for row in frame.select(text.contract_regex(F.col("s"), name)).collect()]
    assert found == [bool(re.fullmatch(text.PATTERNS[name], sample)) for sample in samples]


def test_uri_parts(spark):
    uris = ["s3://b/k/x.gz", "s3://b/", "s3://b", "s3:///k", "http://b/k", "s3://b//k", None]
    frame = spark.createDataFrame([(uri,) for uri in uris], "u string")
    found = [row[0] for row in frame.select(text.uri_parts(F.col("u"))).collect()]
    assert [tuple(part) if part else None for part in found] == [
        ("s3", "b", "k/x.gz"),
        ("s3", "b", ""),
        None,
        None,
        None,
        ("s3", "b", "k"),
        None,
    ]


def test_small_functions(spark):
    digest = hashlib.sha256(b"x").digest()
    frame = spark.createDataFrame(
        [(base64.b64encode(digest).decode(), '"etag"', "success-1-2", "é" * 600, 105, None)],
        "checksum string, etag string, name string, long string, cents bigint, nothing bigint",
    )
    row = frame.select(
        text.checksum_hex(F.col("checksum")),
        text.etag_normalize(F.col("etag")),
        text.run_prefix(F.col("name")),
        F.length(text.failure_stage(F.col("long"))),
        F.length(text.failure_code(F.col("long"))),
        predicates.tax_cents(F.col("cents")),
        predicates.null_to_zero(F.col("nothing")),
        predicates.unless(F.col("nothing") > 0),
    ).first()
    assert tuple(row) == (digest.hex(), "etag", "success", 64, 512, 18, 0, True)


def test_valid_at_is_half_open(spark):
    frame = spark.createDataFrame([(10, 20), (10, None)], "a bigint, b bigint")
    moments = [9, 10, 19, 20]
    found = frame.select(
        *[predicates.valid_at(F.col("a"), F.col("b"), moment).alias(f"t{moment}") for moment in moments]
    ).collect()
    assert [tuple(row) for row in found] == [
        (False, True, True, False),
        (False, True, True, True),
    ]


def test_plain_rows_are_concatenated_and_equal_the_encoder(spark):
    """Encoded whole before; a row with any text to escape still is."""
    kinds = "z string, a bigint, y string, b boolean, i int, s smallint, t tinyint"
    rows = [(value, place - 7, "plain", place % 2 == 0, place, place, -place) for place, value in enumerate(AWKWARD)]
    frame = spark.createDataFrame([*rows, (None,) * 7, ("SALE", -(2**63), "a\n", None, 0, 0, 0)], kinds)
    found = [row["j"] for row in frame.select(text.canonical_row_json(frame).alias("j")).collect()]
    assert found == [canonical(row.asDict()) for row in frame.collect()]
    numbers = frame.select("a", "b", "i")
    plan = numbers.select(text.canonical_row_json(numbers).alias("j"))._jdf.queryExecution().toString().lower()
    assert "to_json" not in plan and "structstojson" not in plan
