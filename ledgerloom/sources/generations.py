"""Generations: six tables written under one id, evidence of what was written, pinned reads.

Layout below a root folder:

    <table>/generation_id=<id>/attempt=<n>/*.parquet
    _evidence/generation_id=<id>/attempt=<n>/*.json
    _attempts/<id>/<n>
    _batches/<batch id>.json
    _pointer/<version>.json

An attempt's number is allocated, its folder is never written twice, and it becomes readable only when
its evidence, written last, names it. So a rebuilt generation never removes files under a reader, an
empty table replaces a full one, and a half-written attempt stays invisible. Small files (batch
identities, pointer versions) are written under another name and then renamed without overwriting: the
name is the commit, and a torn write leaves nothing under it.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.fingerprint import table_fingerprints
from ledgerloom.schemas import TABLES
from ledgerloom.session import literal_frame

EVIDENCE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("manifest_digest", T.StringType()),
        T.StructField("columns", T.StringType()),
    ]
)


class PublicationError(RuntimeError):
    """The generation cannot be published or served."""


def tag_generation(frame: DataFrame, generation_id: str) -> DataFrame:
    return frame.withColumn("generation_id", F.lit(generation_id))


def _attempt_dir(root: str, table: str, generation_id: str, attempt: int) -> str:
    return f"{root}/{table}/generation_id={generation_id}/attempt={attempt}"


def generation_sink(
    frame: DataFrame, root: str, table: str, generation_id: str, attempt: int
) -> None:
    """Write one table of a new attempt; the generation id is the partition folder, not a column."""
    frame.write.mode("errorifexists").parquet(_attempt_dir(root, table, generation_id, attempt))


def read_attempt(
    spark: SparkSession, root: str, table: str, generation_id: str, attempt: int, schema: T.StructType
) -> DataFrame:
    rows = spark.read.schema(schema).parquet(_attempt_dir(root, table, generation_id, attempt))
    return tag_generation(rows, generation_id)


def read_all_attempts(
    spark: SparkSession, root: str, table: str, columns: str
) -> DataFrame:
    """One table over every generation and attempt; both are partition columns."""
    schema = T.StructType.fromJson(json.loads(columns))
    schema = schema.add("generation_id", T.StringType()).add("attempt", T.LongType())
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def stage_attempt(
    tables: dict[str, DataFrame], root: str, generation_id: str, attempt: int
) -> dict[str, DataFrame]:
    """Write the six tables of an attempt, invisible until its evidence is; returns what was written."""
    staged = {}
    for name in TABLES:
        frame = tables[name]
        generation_sink(frame, root, name, generation_id, attempt)
        place = _attempt_dir(root, name, generation_id, attempt)
        staged[name] = frame.sparkSession.read.schema(frame.schema).parquet(place)
    return staged


def write_evidence(
    staged: dict[str, DataFrame],
    fingerprints: list[dict],
    root: str,
    generation_id: str,
    attempt: int,
    manifest_digest: str,
) -> DataFrame:
    """Make a staged attempt readable: six rows of table_name, rows, fingerprint, digest and columns."""
    spark = staged["orders"].sparkSession
    rows = [
        {
            **proof,
            "manifest_digest": manifest_digest,
            "columns": staged[proof["table_name"]].schema.json(),
        }
        for proof in fingerprints
    ]
    kinds = {field.name: pa.int64() if field.name == "rows" else pa.string() for field in EVIDENCE}
    evidence = literal_frame(spark, rows, **kinds)
    evidence.coalesce(1).write.mode("errorifexists").json(
        f"{root}/_evidence/generation_id={generation_id}/attempt={attempt}"
    )
    return generation_evidence(spark, root, generation_id)


def write_generation(
    tables: dict[str, DataFrame],
    root: str,
    generation_id: str,
    attempt: int,
    manifest_digest: str,
) -> DataFrame:
    """Write the six tables as a new attempt, then evidence counted on the written files."""
    staged = stage_attempt(tables, root, generation_id, attempt)
    proofs = [row.asDict() for row in table_fingerprints(staged).collect()]
    return write_evidence(staged, proofs, root, generation_id, attempt, manifest_digest)


def all_evidence(spark: SparkSession, root: str) -> DataFrame:
    """Evidence of the latest complete attempt of every generation."""
    schema = T.StructType(
        [
            *EVIDENCE.fields,
            T.StructField("generation_id", T.StringType()),
            T.StructField("attempt", T.LongType()),
        ]
    )
    files, folder = hadoop_path(spark, f"{root}/_evidence")
    if not files.exists(folder):
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    rows = spark.read.schema(schema).json(f"{root}/_evidence")
    latest = rows.groupBy("generation_id").agg(F.max("attempt").alias("attempt"))
    return rows.join(latest, ["generation_id", "attempt"])


def generation_evidence(spark: SparkSession, root: str, generation_id: str) -> DataFrame:
    return all_evidence(spark, root).filter(F.col("generation_id") == generation_id)


def pinned_read(spark: SparkSession, root: str, generation_id: str) -> dict[str, DataFrame]:
    """The six tables of one generation, all from the attempt its evidence names."""
    rows = generation_evidence(spark, root, generation_id).collect()
    if {row["table_name"] for row in rows} != set(TABLES):
        raise PublicationError(f"UNKNOWN_GENERATION: {generation_id}")
    return {
        row["table_name"]: read_attempt(
            spark,
            root,
            row["table_name"],
            generation_id,
            row["attempt"],
            T.StructType.fromJson(json.loads(row["columns"])),
        )
        for row in rows
    }


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a name in the store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, place = hadoop_path(spark, folder)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def put_once(spark: SparkSession, path: str, content: dict) -> bool:
    """Write a small JSON file whole, unless the name is taken: False if it is.

    The content goes to a hidden name first; renaming without overwrite commits it. That step is atomic
    where the file system's rename is, and a local folder checks and then renames.
    """
    files, place = hadoop_path(spark, path)
    files.mkdirs(place.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(json.dumps(content, sort_keys=True).encode("utf-8"))
    finally:
        stream.close()
    kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(place), options)
    except Exception:
        files.delete(draft, False)
        if files.exists(place):
            return False
        raise
    return True


def allocate_attempt(spark: SparkSession, root: str, generation_id: str) -> int:
    """The next attempt number of a generation; no two callers get the same one."""
    folder = f"{root}/_attempts/{generation_id}"
    number = max([0, *[int(name) for name in _names(spark, folder) if name.isdigit()]]) + 1
    while not put_once(spark, f"{folder}/{number}", {}):
        number += 1
    return number


BATCH = "batch_id string, manifest_digest string, generation_id string"


def registered_batch(spark: SparkSession, root: str, batch_id: str) -> dict | None:
    """The accepted identity of a batch, None before it has one."""
    path = f"{root}/_batches/{batch_id}.json"
    files, place = hadoop_path(spark, path)
    if not files.exists(place):
        return None
    return spark.read.schema(BATCH).json(path).first().asDict()


def register_batch(spark: SparkSession, root: str, batch_id: str, digest: str, generation_id: str) -> None:
    """Accept a batch's identity for good; a batch id that has another digest is refused."""
    identity = {"batch_id": batch_id, "manifest_digest": digest, "generation_id": generation_id}
    put_once(spark, f"{root}/_batches/{batch_id}.json", identity)
    known = registered_batch(spark, root, batch_id)
    if known["manifest_digest"] != digest:
        raise PublicationError(f"CONFLICT: batch {batch_id} was reused with different content")


def registered_generations(spark: SparkSession, root: str) -> DataFrame:
    """(generation_id, manifest_digest) of every accepted batch."""
    if not _names(spark, f"{root}/_batches"):
        return literal_frame(spark, [], generation_id=pa.string(), manifest_digest=pa.string())
    known = spark.read.schema(BATCH).option("pathGlobFilter", "*.json").json(f"{root}/_batches")
    return known.select("generation_id", "manifest_digest")


def pointer_versions(spark: SparkSession, root: str) -> list[int]:
    names = _names(spark, f"{root}/_pointer")
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[0] != ".")


def active_pointer(spark: SparkSession, root: str) -> tuple[str | None, int]:
    """(active generation, pointer version); (None, 0) before the first publication.

    A version whose file names no generation (put there by other means, then torn) is used up but
    changes nothing: the generation of the version before it stays active.
    """
    versions = pointer_versions(spark, root)
    for version in reversed(versions):
        row = spark.read.schema("generation_id string").json(f"{root}/_pointer/{version}.json").first()
        if row is not None and row["generation_id"] is not None:
            return row["generation_id"], versions[-1]
    return None, versions[-1] if versions else 0


def commit_pointer(spark: SparkSession, root: str, generation_id: str, version: int) -> None:
    """Put the pointer file of a version only if no one else has: the compare-and-swap."""
    if not put_once(spark, f"{root}/_pointer/{version}.json", {"generation_id": generation_id}):
        raise PublicationError("STALE_PUBLISHER: pointer version is taken")
