"""Declared against actual: row counts, table sets, stored objects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import unless
from ledgerloom.functions.text import etag_normalize


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            for name, frame in tables.items()
        ],
    )


def row_count_proof(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables (table_name, rows) whose declared and actual counts differ or exist on one side only."""
    return (
        declared.select("table_name", F.col("rows").alias("declared_rows"))
        .join(
            actual.select("table_name", F.col("rows").alias("actual_rows")),
            "table_name",
            "full_outer",
        )
        .filter(unless(F.col("declared_rows") == F.col("actual_rows")))
    )


def fingerprint_proof(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables (table_name, fingerprint) whose declared and actual digests differ."""
    return (
        declared.select("table_name", F.col("fingerprint").alias("declared"))
        .join(actual.select("table_name", F.col("fingerprint").alias("actual")), "table_name", "full_outer")
        .filter(unless(F.col("declared") == F.col("actual")))
    )


def manifest_table_set(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Names on one side only, with the side they are missing from."""
    left = declared.select("table_name").distinct().withColumn("is_declared", F.lit(True))
    right = actual.select("table_name").distinct().withColumn("is_actual", F.lit(True))
    return (
        left.join(right, "table_name", "full_outer")
        .filter(F.col("is_declared").isNull() | F.col("is_actual").isNull())
        .select(
            "table_name",
            F.when(F.col("is_declared").isNull(), "declared").otherwise("actual").alias("missing_from"),
        )
    )


def table_set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference both ways; empty when the sets are equal. Nulls are compared as values.

    Both sets meet in one aggregation: a row is in one of them only if its sides' extremes agree.
    """
    sides = left.withColumn("only_in", F.lit("left")).unionByName(
        right.withColumn("only_in", F.lit("right"))
    )
    met = sides.groupBy(*left.columns).agg(
        F.min("only_in").alias("only_in"), F.max("only_in").alias("other_side")
    )
    return met.filter(F.col("only_in") == F.col("other_side")).drop("other_side")


def object_proof(declared: DataFrame, stored: DataFrame, keys: Sequence[str] = ("bucket", "key", "version_id")) -> DataFrame:
    """Objects whose size, sha256 or etag differ from the declared proof, or that one side lacks.

    Both sides carry `keys`, size_bytes, sha256 and etag.
    """
    keys = list(keys)

    def side(frame: DataFrame, prefix: str) -> DataFrame:
        return frame.select(
            *keys,
            F.lit(True).alias(f"{prefix}_present"),
            F.col("size_bytes").alias(f"{prefix}_size"),
            F.col("sha256").alias(f"{prefix}_sha256"),
            etag_normalize(F.col("etag")).alias(f"{prefix}_etag"),
        )

    def same(what: str) -> Column:
        return F.coalesce(F.col(f"declared_{what}") == F.col(f"stored_{what}"), F.lit(False))

    joined = side(declared, "declared").join(side(stored, "stored"), keys, "full_outer")
    reason = (
        F.when(F.col("stored_present").isNull(), "MISSING_OBJECT")
        .when(F.col("declared_present").isNull(), "UNDECLARED_OBJECT")
        .when(~same("size"), "SIZE")
        .when(~same("sha256"), "SHA256")
        .when(~same("etag"), "ETAG")
    )
    return joined.select(*keys, reason.alias("reason")).filter(F.col("reason").isNotNull())


def file_inventory(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """(path, size_bytes, sha256) of every file below the given paths, size and digest of what was read.

    Spark lists and reads the files, so any store it can read from will do. A file is one row while it is
    hashed, so it must fit into a task's memory and the 2 GB of a binary value; writers here bound the rows
    per file. Empty files are not listed: no Spark file source shows them, and an object proof needs a size
    of at least 1.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths).select(
        "path",
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def content_inventory(frame: DataFrame, path: Column, content: Column) -> DataFrame:
    """(path, size_bytes, sha256) of content held in a column, in path order."""
    binary = content.cast("binary")
    return frame.select(
        path.alias("path"),
        F.octet_length(binary).cast("bigint").alias("size_bytes"),
        F.sha2(binary, 256).alias("sha256"),
    ).orderBy("path")
