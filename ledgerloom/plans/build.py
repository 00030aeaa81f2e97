"""From a manifest and six tables to a published generation."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.batch import Batch
from ledgerloom.functions.predicates import unless
from ledgerloom.functions.text import generation_id as generation_id_column
from ledgerloom.operators.aggregates import batch_metrics
from ledgerloom.operators.fingerprint import table_fingerprint, table_fingerprints
from ledgerloom.operators.lifecycle import evidence_complete
from ledgerloom.operators.proofs import file_inventory, fingerprint_proof, row_count_proof
from ledgerloom.plans.report import assert_valid
from ledgerloom.schemas import TABLES
from ledgerloom.session import literal_frame
from ledgerloom.skew import DEFAULT_POLICY, SkewPolicy
from ledgerloom.sources.batch_files import (
    ManifestError,
    check_manifest,
    check_objects,
    object_path,
    read_batch_table,
)
from ledgerloom.sources.generations import (
    PublicationError,
    active_pointer,
    all_evidence,
    allocate_attempt,
    commit_pointer,
    generation_evidence,
    pinned_read,
    read_all_attempts,
    register_batch,
    registered_batch,
    registered_generations,
    stage_attempt,
    write_evidence,
)


@dataclass(frozen=True)
class BuildResult:
    """`status` is built, or replayed where the batch had been built before and nothing was written."""

    generation_id: str
    attempt: int
    status: str
    evidence: DataFrame
    metrics: DataFrame


def generation_id_of(spark: SparkSession, document: dict) -> str:
    identity = literal_frame(
        spark,
        [{"batch_id": document["batch_id"], "digest": document["identity_digest"]}],
        batch_id=pa.string(),
        digest=pa.string(),
    )
    return identity.select(
        generation_id_column(F.col("batch_id"), F.col("digest")).alias("id")
    ).first()["id"]


def verify_objects(spark: SparkSession, document: dict, store: str) -> None:
    """Size and sha256 of every stored object against the manifest; files are hashed in tasks."""
    items = [
        {**item, "table_name": name, "path": object_path(store, item)}
        for name, proof in document["tables"].items()
        for item in proof["objects"]
    ]
    kinds = {name: pa.string() for name in ("table_name", "path", "bucket", "key", "version_id", "sha256")}
    declared = literal_frame(spark, items, size_bytes=pa.int64(), **kinds)
    try:
        stored = file_inventory(spark, [item["path"] for item in items])
        # The listing names files in full; what follows the store is the object's bucket and key.
        places = stored.select(
            F.substring_index("path", "/", -1).alias("name"), "path", "size_bytes", "sha256"
        )
        found = declared.withColumn("name", F.substring_index("path", "/", -1)).alias("d").join(
            places.alias("s"),
            (F.col("d.name") == F.col("s.name")) & F.expr("endswith(s.path, concat('/', d.bucket, '/', d.key))"),
            "left",
        )
        wrong = found.filter(
            unless(
                (F.col("d.size_bytes") == F.col("s.size_bytes")) & (F.col("d.sha256") == F.col("s.sha256"))
            )
        )
        names = sorted({row["table_name"] for row in wrong.select("d.table_name").distinct().collect()})
    except AnalysisException as error:
        raise ManifestError("OBJECT_PROOF: a declared object does not exist") from error
    if names:
        raise ManifestError(f"OBJECT_PROOF: {names}")


def read_objects(spark: SparkSession, document: dict, store: str) -> dict[str, DataFrame]:
    """The six tables, read from exactly the objects that the manifest names."""
    return {
        name: read_batch_table(
            spark, [object_path(store, item) for item in proof["objects"]], name
        )
        for name, proof in document["tables"].items()
    }


def verify_tables(document: dict, tables: dict[str, DataFrame]) -> list[dict]:
    """Row counts and content digests of all six tables against the manifest, in one pass each.

    Returns the proofs, so that the evidence needs no further pass.
    """
    spark = tables["orders"].sparkSession
    kinds = {"table_name": pa.string(), "rows": pa.int64(), "fingerprint": pa.string()}
    declared = literal_frame(
        spark,
        [
            {"table_name": name, "rows": proof["rows"], "fingerprint": proof["sha256"]}
            for name, proof in document["tables"].items()
        ],
        **kinds,
    )
    # Six rows: taken to the driver once, so that the tables are hashed once for both checks.
    hashed = [row.asDict() for row in table_fingerprints(tables).collect()]
    actual = literal_frame(spark, hashed, **kinds)
    wrong = row_count_proof(declared, actual).collect()
    if wrong:
        raise ManifestError(f"ROW_COUNT: {sorted(row['table_name'] for row in wrong)}")
    wrong = fingerprint_proof(declared, actual).collect()
    if wrong:
        raise ManifestError(f"TABLE_DIGEST: {sorted(row['table_name'] for row in wrong)}")
    return hashed


def _complete(spark: SparkSession, root: str, generation_id: str) -> bool:
    """Whether the evidence of a registered generation is whole: digest, six tables, valid counts."""
    evidence = generation_evidence(spark, root, generation_id).withColumn("snapshot_id", F.col("attempt"))
    known = registered_generations(spark, root).filter(F.col("generation_id") == generation_id)
    return not evidence_complete(evidence, known).filter("complete").isEmpty()


def _result(
    spark: SparkSession, root: str, generation_id: str, status: str, policy: SkewPolicy
) -> BuildResult:
    evidence = generation_evidence(spark, root, generation_id)
    attempt = evidence.select("attempt").first()["attempt"]
    tables = pinned_read(spark, root, generation_id)
    batch = Batch({name: tables[name].drop("generation_id") for name in TABLES}, 0, policy)
    return BuildResult(generation_id, attempt, status, evidence, batch_metrics(batch))


def build_generation(
    spark: SparkSession,
    document: dict,
    store: str,
    root: str,
    *,
    policy: SkewPolicy = DEFAULT_POLICY,
    inject_failure: bool = False,
) -> BuildResult:
    """From a manifest and the stored objects it names to a readable generation.

    A batch that was built before is returned as it is, and nothing is written; the same batch id with
    another digest is refused. Objects are proven first. Then every table is parsed once, into a new
    attempt that no reader sees; counts, digests and all gates run on that Parquet, and evidence, which
    makes the attempt readable, is written only when they hold. A failed attempt stays invisible, and
    the next call takes a new one.
    """
    check_manifest(document)
    check_objects(document)
    batch_id, digest = document["batch_id"], document["identity_digest"]
    generation = generation_id_of(spark, document)
    known = registered_batch(spark, root, batch_id)
    if known is not None:
        if known["manifest_digest"] != digest:
            raise PublicationError(f"CONFLICT: batch {batch_id} was reused with different content")
        if _complete(spark, root, generation):
            return _result(spark, root, generation, "replayed", policy)
    verify_objects(spark, document, store)
    register_batch(spark, root, batch_id, digest, generation)
    attempt = allocate_attempt(spark, root, generation)
    staged = stage_attempt(read_objects(spark, document, store), root, generation, attempt)
    proofs = verify_tables(document, staged)
    assert_valid(Batch(staged, document["as_of_knowledge_time"], policy))
    if inject_failure:
        raise RuntimeError("INJECTED_FAILURE: publication blocked")
    write_evidence(staged, proofs, root, generation, attempt, digest)
    return _result(spark, root, generation, "built", policy)


def publish(
    spark: SparkSession, root: str, generation_id: str, *, expected_pointer_version: int
) -> int:
    """Advance the pointer by one version, if it still is at the expected one.

    The generation must belong to a registered batch and have whole evidence of that batch's digest.
    Publishing the active generation again is a no-op, so a retry after a lost answer is safe.
    """
    if not _complete(spark, root, generation_id):
        raise PublicationError("NOT_VALIDATED: whole evidence of all six tables is required")
    active, version = active_pointer(spark, root)
    if active == generation_id:
        return version
    if version != expected_pointer_version:
        raise PublicationError(
            f"STALE_PUBLISHER: expected {expected_pointer_version}, actual {version}"
        )
    commit_pointer(spark, root, generation_id, version + 1)
    return version + 1


def serve(spark: SparkSession, root: str) -> tuple[str, dict[str, DataFrame]]:
    """Resolve the pointer once and register the six pinned tables as temporary views."""
    generation, _ = active_pointer(spark, root)
    if generation is None:
        raise PublicationError("NO_ACTIVE_GENERATION")
    tables = pinned_read(spark, root, generation)
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return generation, tables


def verify_published(spark: SparkSession, root: str) -> DataFrame:
    """(generation_id, table_name, problem): content that no longer matches its evidence.

    One distributed pass per table re-hashes all its generations; the loop is over the six tables
    (more only if a table's columns changed between generations).
    """
    recorded = all_evidence(spark, root)
    kinds = {"generation_id": pa.string(), "table_name": pa.string(), "problem": pa.string()}
    active, _ = active_pointer(spark, root)
    known = active is None or not recorded.filter(F.col("generation_id") == active).isEmpty()
    problems = literal_frame(
        spark,
        [] if known else [{"generation_id": active, "problem": "POINTER_TO_MISSING_GENERATION"}],
        **kinds,
    )
    for table, columns in recorded.select("table_name", "columns").distinct().collect():
        expected = recorded.filter(
            (F.col("table_name") == table) & (F.col("columns") == columns)
        ).select("generation_id", "attempt", "table_name", "rows", "fingerprint")
        rows = read_all_attempts(spark, root, table, columns).join(
            expected.select("generation_id", "attempt"), ["generation_id", "attempt"], "left_semi"
        )
        actual = table_fingerprint(rows, by=["generation_id", "attempt"]).select(
            "generation_id",
            "attempt",
            F.col("rows").alias("actual_rows"),
            F.col("fingerprint").alias("actual"),
        )
        both_empty = (F.col("rows") == 0) & F.col("actual_rows").isNull()
        same = (F.col("rows") == F.col("actual_rows")) & (F.col("fingerprint") == F.col("actual"))
        differing = expected.join(actual, ["generation_id", "attempt"], "left").filter(
            unless(both_empty | same)
        )
        problems = problems.unionByName(
            differing.select("generation_id", "table_name", F.lit("DIGEST_MISMATCH").alias("problem"))
        )
    return problems
