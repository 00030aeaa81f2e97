"""Files, proofs, manifests, and the build - publish - serve path."""

from __future__ import annotations

import gzip
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from golden import KNOWLEDGE, as_batch, changed, golden_rows
from ledgerloom.operators import fingerprint, metering, proofs
from ledgerloom.plans.build import build_generation, publish, serve, verify_published
from ledgerloom.plans.report import QualityGateError
from ledgerloom.schemas import SCHEMAS, TABLES
from ledgerloom.sources import batch_files, generations, synthetic

ROWS = golden_rows(12)


def manifest_for(batch, batch_id="lab-001", objects=None):
    tables = {name: batch[name] for name in TABLES}
    return batch_files.build_manifest(
        fingerprint.table_fingerprints(tables),
        batch_id=batch_id,
        produced_at=KNOWLEDGE,
        as_of_knowledge_time=KNOWLEDGE,
        objects=objects,
    )


def landed(batch, store, batch_id="lab-001"):
    """The manifest of a batch whose six tables lie as files in the store."""
    tables = {name: batch[name] for name in TABLES}
    objects = batch_files.land_batch(tables, store, "landing", batch_id)
    return batch_files.bind_objects(manifest_for(batch, batch_id), objects)


def files_below(root):
    return {str(f): f.stat().st_mtime_ns for f in Path(root).rglob("*") if f.is_file()}


@pytest.fixture(scope="module")
def batch(spark):
    return as_batch(spark, ROWS)


@pytest.fixture(scope="module")
def document(batch):
    return manifest_for(batch)


def test_ndjson_round_trip(spark, batch, tmp_path):
    folder = str(tmp_path / "products")
    batch_files.write_batch_table(batch["products"], folder, files=2)
    files = sorted(Path(folder).glob("*.json.gz"))
    first = json.loads(gzip.open(files[0], "rt").readline())
    assert list(first) == sorted(SCHEMAS["products"].names) and first["effective_to"] is None
    back = batch_files.read_batch_table(spark, [str(file) for file in files], "products")
    assert back.schema == SCHEMAS["products"]
    assert sorted(map(tuple, back.collect())) == sorted(ROWS["products"])


def test_bad_rows_fail_or_are_quarantined(spark, tmp_path):
    good = '{"payment_id":"a","order_id":"o","amount_cents":1,"status":"CAPTURED"}\n'
    (tmp_path / "p.jsonl").write_text(good + '{"payment_id":"b","amount_cents":"many"}\n')
    path = str(tmp_path / "p.jsonl")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        batch_files.read_batch_table(spark, path, "payments").collect()
    rows = batch_files.read_batch_table(spark, path, "payments", quarantine=True).collect()
    assert [row["_corrupt_record"] is None for row in rows] == [True, False]


def test_manifest_round_trip_and_checks(spark, batch, document, tmp_path):
    proof = {"bucket": "b", "key": "k", "version_id": "v", "size_bytes": 3, "sha256": "a" * 64, "etag": "e"}
    tables = {name: {**entry, "objects": [proof]} for name, entry in document["tables"].items()}
    bound = {**document, "tables": tables}
    bound["identity_digest"] = batch_files.manifest_digest(bound)
    folder = str(tmp_path / "manifest")
    batch_files.write_manifest(spark, bound, folder)
    manifests = batch_files.read_manifests(spark, folder)
    assert batch_files.manifest_tables(manifests).count() == 6
    objects = batch_files.manifest_objects(manifests)
    assert objects.count() == 6
    stale = synthetic.stale_object(objects, "orders", "v0")
    keys = ("table_name", "bucket", "key", "version_id")
    reasons = {row["reason"] for row in proofs.object_proof(stale, objects, keys).collect()}
    assert reasons == {"MISSING_OBJECT", "UNDECLARED_OBJECT"}

    batch_files.check_manifest(bound, batch_id="lab-001")
    with pytest.raises(batch_files.ManifestError, match="MANIFEST_DIGEST"):
        batch_files.check_manifest({**bound, "produced_at": 1})
    with pytest.raises(batch_files.ManifestError, match="MANIFEST_IDENTITY"):
        batch_files.check_manifest(bound, batch_id="other")
    old = {**bound, "contract_version": "retail-v1"}
    old["identity_digest"] = batch_files.manifest_digest(old)
    with pytest.raises(batch_files.ManifestError, match="MANIFEST_IDENTITY"):
        batch_files.check_manifest(old)


def test_file_inventory_hashes_files_in_tasks(spark, tmp_path):
    contents = {"a/x.bin": b"x" * 100, "b y.bin": b"y", "c.txt": "é".encode()}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    found = proofs.file_inventory(spark, str(tmp_path)).collect()
    assert {row["sha256"]: row["size_bytes"] for row in found} == {
        hashlib.sha256(content).hexdigest(): len(content) for content in contents.values()
    }


def test_fingerprint_ignores_order_and_counts_copies(spark, batch):
    orders = batch["orders"]
    one = fingerprint.table_fingerprint(orders).first()
    assert fingerprint.table_fingerprint(orders.repartition(5).orderBy(F.rand(1))).first() == one
    assert fingerprint.table_fingerprint(orders.unionByName(orders.limit(1))).first() != one
    edited = orders.withColumn("total_cents", F.col("total_cents") + 1)
    assert fingerprint.table_fingerprint(edited).first() != one


@pytest.fixture(scope="module")
def store(spark, batch, tmp_path_factory):
    """A store with one landed batch, and its manifest."""
    folder = f"file://{tmp_path_factory.mktemp('store')}"
    return folder, landed(batch, folder)


def test_build_publish_serve(spark, batch, store, tmp_path):
    place, document = store
    root = str(tmp_path / "lake")
    with pytest.raises(generations.PublicationError, match="NO_ACTIVE_GENERATION"):
        serve(spark, root)
    with pytest.raises(RuntimeError, match="INJECTED_FAILURE"):
        build_generation(spark, document, place, root, inject_failure=True)
    assert generations.active_pointer(spark, root) == (None, 0)

    # The failed attempt stays invisible; the next call recovers with an attempt of its own.
    built = build_generation(spark, document, place, root)
    assert (built.status, built.attempt) == ("built", 2)
    assert {row["table_name"]: row["rows"] for row in built.evidence.collect()} == {
        name: len(ROWS[name]) for name in TABLES
    }
    metrics = {row["metric"]: row["value"] for row in built.metrics.collect()}
    assert metrics["orders"] == len(ROWS["orders"]) and metrics["captured_cents"] > 0
    assert publish(spark, root, built.generation_id, expected_pointer_version=0) == 1
    assert publish(spark, root, built.generation_id, expected_pointer_version=0) == 1
    generation, tables = serve(spark, root)
    assert generation == built.generation_id
    assert spark.sql("select count(*) from orders").first()[0] == len(ROWS["orders"])
    assert tables["orders"].columns[-1] == "generation_id"

    # A replay returns the same generation, writes nothing, and a held reader still reads.
    before = files_below(root)
    replayed = build_generation(spark, document, place, root)
    assert (replayed.status, replayed.attempt) == ("replayed", 2)
    assert replayed.generation_id == built.generation_id
    assert replayed.metrics.collect() == built.metrics.collect()
    assert files_below(root) == before
    assert tables["orders"].count() == len(ROWS["orders"])

    # The same batch id with other content is refused, whatever the content.
    other = as_batch(spark, golden_rows(8))
    with pytest.raises(generations.PublicationError, match="CONFLICT"):
        build_generation(spark, landed(other, f"{place}/again"), f"{place}/again", root)
    assert files_below(root) == before

    # A second generation: stale first, then at the right version; the first stays readable.
    second = build_generation(spark, landed(other, place, "lab-002"), place, root)
    with pytest.raises(generations.PublicationError, match="STALE_PUBLISHER"):
        publish(spark, root, second.generation_id, expected_pointer_version=0)
    with pytest.raises(generations.PublicationError, match="STALE_PUBLISHER"):
        generations.commit_pointer(spark, root, second.generation_id, 1)
    assert generations.active_pointer(spark, root) == (generation, 1)
    assert publish(spark, root, second.generation_id, expected_pointer_version=1) == 2
    assert generations.pinned_read(spark, root, generation)["orders"].count() == 12
    assert verify_published(spark, root).isEmpty()

    # A new attempt with an empty table replaces the old rows for readers; no attempt is written twice.
    emptied = {name: batch[name] for name in TABLES} | {"returns": batch["returns"].limit(0)}
    digest = document["identity_digest"]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        generations.write_generation(emptied, root, generation, 2, digest)
    attempt = generations.allocate_attempt(spark, root, generation)
    assert attempt == 3
    generations.write_generation(emptied, root, generation, attempt, digest)
    assert generations.pinned_read(spark, root, generation)["returns"].count() == 0
    assert generations.pinned_read(spark, root, generation)["orders"].count() == 12

    # Content changed behind the evidence is found.
    folder = Path(f"{root}/payments/generation_id={second.generation_id}/attempt=1")
    edited = other["payments"].withColumn("amount_cents", F.lit(0).cast("bigint"))
    edited.write.mode("append").parquet(str(folder))
    problems = [tuple(row) for row in verify_published(spark, root).collect()]
    assert problems == [(second.generation_id, "payments", "DIGEST_MISMATCH")]


def test_a_torn_pointer_file_does_not_stop_publication(spark, batch, store, tmp_path):
    place, document = store
    root = str(tmp_path / "lake")
    built = build_generation(spark, document, place, root)
    assert publish(spark, root, built.generation_id, expected_pointer_version=0) == 1
    Path(root, "_pointer", "2.json").write_text("")
    assert generations.active_pointer(spark, root) == (built.generation_id, 2)
    assert serve(spark, root)[0] == built.generation_id
    second = build_generation(spark, landed(as_batch(spark, golden_rows(8)), place, "lab-003"), place, root)
    assert publish(spark, root, second.generation_id, expected_pointer_version=2) == 3


def test_build_refuses_what_the_manifest_or_the_gates_refuse(spark, batch, store, tmp_path):
    place, document = store
    root = str(tmp_path / "lake")
    first = ROWS["orders"][0]
    broken = as_batch(spark, changed(ROWS, "orders", 0, total_cents=first[8] + 1))

    def with_objects(objects):
        return batch_files.bind_objects(document, objects)

    objects = {name: proof["objects"] for name, proof in document["tables"].items()}
    # Stored content that is not what the manifest's table digest says.
    fewer = batch.replace(payments=batch["payments"].limit(3))
    for wrong, code in ((broken, "TABLE_DIGEST.*orders"), (fewer, "ROW_COUNT.*payments")):
        name = f"bad-{code[:3].lower()}"
        bad = batch_files.land_batch({t: wrong[t] for t in TABLES}, place, "landing", name)
        other = {**with_objects(bad), "batch_id": name}
        other["identity_digest"] = batch_files.manifest_digest(other)
        with pytest.raises(batch_files.ManifestError, match=code):
            build_generation(spark, other, place, root)
    with pytest.raises(QualityGateError, match="ORDER_TOTAL,UNDERPAID"):
        build_generation(spark, landed(broken, place, "lab-bad"), place, root)

    # Unbound, malformed, missing and tampered objects.
    with pytest.raises(batch_files.ManifestError, match="UNBOUND_TABLE"):
        build_generation(spark, manifest_for(batch), place, root)
    with pytest.raises(batch_files.ManifestError, match="UNBOUND_TABLE"):
        with_objects({**objects, "orders": []})
    with pytest.raises(batch_files.ManifestError, match="OBJECT_TABLE_SET"):
        with_objects({"orders": objects["orders"]})
    item = objects["orders"][0]
    for change, code in (
        ({"bucket": ""}, "OBJECT_IDENTITY"),
        ({"version_id": None}, "OBJECT_IDENTITY"),
        ({"size_bytes": 0}, "OBJECT_EVIDENCE"),
        ({"sha256": "zz"}, "OBJECT_EVIDENCE"),
        ({"size_bytes": item["size_bytes"] + 1}, "OBJECT_PROOF"),
        ({"sha256": "0" * 64}, "OBJECT_PROOF"),
        ({"key": "lab-001/orders/none.json.gz"}, "OBJECT_PROOF"),
    ):
        bad = with_objects({**objects, "orders": [{**item, **change}, *objects["orders"][1:]]})
        with pytest.raises(batch_files.ManifestError, match=code):
            build_generation(spark, bad, place, root)

    with pytest.raises(generations.PublicationError, match="NOT_VALIDATED"):
        publish(spark, root, "g-none-0123456789ab", expected_pointer_version=0)
    assert generations.active_pointer(spark, root) == (None, 0)


def test_evidence_of_another_digest_is_not_published(spark, batch, store, tmp_path):
    place, document = store
    root = str(tmp_path / "lake")
    tables = {name: batch[name] for name in TABLES}
    generation = "g-lab-001-0123456789ab"
    generations.register_batch(spark, root, "lab-001", "a" * 64, generation)
    generations.write_generation(tables, root, generation, 1, "b" * 64)
    with pytest.raises(generations.PublicationError, match="NOT_VALIDATED"):
        publish(spark, root, generation, expected_pointer_version=0)


def test_a_shared_folder_is_required_off_one_machine(monkeypatch):
    from types import SimpleNamespace

    from ledgerloom.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", applicationId="x", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_result_reconciliation_fails_closed(spark):
    kind = "metric string, value bigint"
    expected = spark.createDataFrame([("orders", 5), ("gross", 7), ("gone", 1)], kind)
    actual = spark.createDataFrame([("orders", 5), ("gross", 8), ("extra", 2)], kind)
    found = metering.result_reconciliation(expected, actual).collect()
    assert {row["metric"]: row["passed"] for row in found} == {
        "orders": True,
        "gross": False,
        "gone": False,
        "extra": False,
    }


def test_metering(spark):
    runs = spark.createDataFrame(
        [(120.0, None, None), (None, 60, None), (None, 30, 3)],
        "dpu_seconds double, execution_seconds bigint, workers bigint",
    )
    scans = spark.createDataFrame([(4096,), (8192,), (0,), (20_000_000,)], "bytes bigint")
    row = metering.usage_metering(runs, scans).first()
    assert (row["dpu_seconds"], row["bytes_scanned"], row["scans"], row["billable_bytes"]) == (
        330.0,
        20_012_288,
        3,
        2 * 10_485_760 + 20_000_000,
    )
    assert row["compute_usd"] == round(330 / 3600 * 0.44, 6)
