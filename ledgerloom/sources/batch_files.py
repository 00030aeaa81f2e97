"""Batch files: gzipped NDJSON tables and the manifest that names them."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import PATTERNS, canonical_row_json, manifest_digest
from ledgerloom.operators.proofs import file_inventory
from ledgerloom.schemas import CONTRACT_VERSION, MANIFEST, SCHEMAS, TABLES
from ledgerloom.session import literal_frame


class ManifestError(ValueError):
    """The manifest does not hold for the data it names."""


def read_batch_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    *,
    quarantine: bool = False,
) -> DataFrame:
    """Rows of the listed NDJSON files (gzip by suffix) under a declared schema.

    Bad rows fail the read, or land in `_corrupt_record` with quarantine. A gzip file is read by one
    task, so producers should write many; what follows spreads again at its first shuffle.
    """
    kind = SCHEMAS[schema] if isinstance(schema, str) else schema
    reader = spark.read
    if quarantine:
        kind = T.StructType([*kind.fields, T.StructField("_corrupt_record", T.StringType())])
        return reader.schema(kind).option("mode", "PERMISSIVE").json(paths)
    return reader.schema(kind).option("mode", "FAILFAST").json(paths)


def write_batch_table(
    frame: DataFrame, folder: str, *, files: int | None = None, rows_per_file: int = 1_000_000
) -> None:
    """Gzipped NDJSON with sorted keys and nulls kept, cut into files of a bounded number of rows."""
    ordered = frame.select(*sorted(frame.columns))
    if files is not None:
        ordered = ordered.repartition(files)
    (
        ordered.write.option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .json(folder)
    )


def build_manifest(
    table_proofs: DataFrame,
    *,
    batch_id: str,
    produced_at: int,
    as_of_knowledge_time: int,
    objects: Mapping[str, Sequence[Mapping[str, object]]] | None = None,
) -> dict:
    """The manifest document for (table_name, rows, fingerprint) proofs, one row per table."""
    rows = {row["table_name"]: row for row in table_proofs.collect()}
    if set(rows) != set(TABLES):
        raise ManifestError("exactly six tables are required")
    document = {
        "batch_id": batch_id,
        "contract_version": CONTRACT_VERSION,
        "produced_at": produced_at,
        "as_of_knowledge_time": as_of_knowledge_time,
        "tables": {
            name: {
                "rows": rows[name]["rows"],
                "sha256": rows[name]["fingerprint"],
                "objects": [dict(item) for item in (objects or {}).get(name, ())],
            }
            for name in TABLES
        },
    }
    return {**document, "identity_digest": manifest_digest(document)}


def land_batch(
    tables: Mapping[str, DataFrame], store: str, bucket: str, batch_id: str
) -> dict[str, list[dict]]:
    """Write the six tables below a store; returns the stored objects of each table with their proofs.

    A folder has no object versions, so the start of the content's digest stands for one.
    """
    objects = {}
    for name in TABLES:
        folder = f"{batch_id}/{name}"
        write_batch_table(tables[name], f"{store}/{bucket}/{folder}")
        found = file_inventory(
            tables[name].sparkSession, f"{store}/{bucket}/{folder}", "*.json.gz"
        ).select(F.substring_index("path", "/", -1).alias("file"), "size_bytes", "sha256")
        objects[name] = [
            {
                "bucket": bucket,
                "key": f"{folder}/{row['file']}",
                "version_id": row["sha256"][:16],
                "size_bytes": row["size_bytes"],
                "sha256": row["sha256"],
                "etag": row["sha256"][:32],
            }
            for row in found.orderBy("file").collect()
        ]
    return objects


def bind_objects(
    document: dict, objects: Mapping[str, Sequence[Mapping[str, object]]]
) -> dict:
    """The manifest bound to the stored objects of each table, with its digest taken anew."""
    if set(objects) != set(document["tables"]):
        raise ManifestError("OBJECT_TABLE_SET: object tables do not match the manifest")
    tables = {}
    for name, proof in document["tables"].items():
        if not objects[name]:
            raise ManifestError(f"UNBOUND_TABLE: no objects registered for {name}")
        tables[name] = {**proof, "objects": [dict(item) for item in objects[name]]}
    bound = {**document, "tables": tables}
    return {**bound, "identity_digest": manifest_digest(bound)}


def check_objects(document: dict) -> None:
    """Every table is bound to objects, each with a full identity and well-formed evidence."""
    for name, proof in document["tables"].items():
        if not proof.get("objects"):
            raise ManifestError(f"UNBOUND_TABLE: table {name} is not bound to an object")
        for item in proof["objects"]:
            if not (item.get("bucket") and item.get("key") and item.get("version_id")):
                raise ManifestError(f"OBJECT_IDENTITY: table {name} has an incomplete object identity")
            size, digest = item.get("size_bytes"), item.get("sha256")
            sized = isinstance(size, int) and size >= 1
            if not sized or not re.fullmatch(PATTERNS["manifest_digest"], str(digest)):
                raise ManifestError(f"OBJECT_EVIDENCE: table {name} has invalid object evidence")


def object_path(store: str, item: Mapping[str, object]) -> str:
    """Where an object lies below a store, such as s3a:/ or a folder of buckets."""
    return f"{store}/{item['bucket']}/{item['key']}"


def check_manifest(
    document: dict, *, batch_id: str | None = None, digest: str | None = None
) -> None:
    """Identity of one manifest document: its own digest, the contract and the six tables."""
    computed = manifest_digest(document)
    if document.get("identity_digest") != computed or (digest and digest != computed):
        raise ManifestError("MANIFEST_DIGEST: canonical identity mismatch")
    wrong_batch = batch_id is not None and document["batch_id"] != batch_id
    if wrong_batch or document["contract_version"] != CONTRACT_VERSION:
        raise ManifestError("MANIFEST_IDENTITY: batch id or contract version mismatch")
    if not re.fullmatch(PATTERNS["batch_id"], str(document["batch_id"])):
        raise ManifestError("MANIFEST_IDENTITY: malformed batch id")
    if set(document.get("tables", {})) != set(TABLES):
        raise ManifestError("MANIFEST_TABLE_SET: exactly six tables are required")


def write_manifest(spark: SparkSession, document: dict, folder: str) -> None:
    """One JSON document per manifest, as a one-line text file."""
    line = json.dumps(document, sort_keys=True, separators=(",", ":"))
    literal_frame(spark, [{"value": line}], value=pa.string()).write.text(folder)


def read_manifests(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Manifests as rows, with nested table proofs."""
    return spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(paths, multiLine=True)


def manifest_tables(manifests: DataFrame) -> DataFrame:
    """(batch_id, table_name, rows, fingerprint), one row per declared table."""
    entries = manifests.select("batch_id", F.explode("tables").alias("table_name", "proof"))
    return entries.select(
        "batch_id",
        "table_name",
        F.col("proof.rows").alias("rows"),
        F.col("proof.sha256").alias("fingerprint"),
    )


def manifest_objects(manifests: DataFrame) -> DataFrame:
    """(batch_id, table_name, bucket, key, version_id, size_bytes, sha256, etag) per file."""
    entries = manifests.select("batch_id", F.explode("tables").alias("table_name", "proof"))
    files = entries.select("batch_id", "table_name", F.explode("proof.objects").alias("file"))
    return files.select("batch_id", "table_name", "file.*")


def manifest_digests(manifests: DataFrame) -> DataFrame:
    """(batch_id, digest) of each manifest row's canonical identity.

    Rows carry the proofs as a struct per table, so that the names sort with the other keys.
    """
    identity = [name for name in manifests.columns if name != "identity_digest"]
    return manifests.select(
        "batch_id", F.sha2(canonical_row_json(manifests, identity), 256).alias("digest")
    )
