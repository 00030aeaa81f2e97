"""Seals: digest trees of a generation's tables, kept beside its evidence, that say where content changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.digest_tree import differing_nodes, digest_tree, tree_depth
from ledgerloom.sources.generations import PublicationError, generation_evidence, hadoop_path, pinned_read

NODES = "table_name string, node string, rows long, digest string"


def _place(spark: SparkSession, root: str, generation_id: str) -> tuple[str, dict[str, int]]:
    """(folder of the readable attempt's seal, depth of each table's tree by the rows of its evidence)."""
    evidence = generation_evidence(spark, root, generation_id).collect()
    if not evidence:
        raise PublicationError(f"UNKNOWN_GENERATION: {generation_id}")
    depths = {row["table_name"]: tree_depth(row["rows"]) for row in evidence}
    return f"{root}/_seals/generation_id={generation_id}/attempt={evidence[0]['attempt']}", depths


def _trees(tables: dict[str, DataFrame], depths: dict[str, int]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            digest_tree(frame.drop("generation_id"), depths[name]).select(F.lit(name).alias("table_name"), "*")
            for name, frame in tables.items()
        ],
    )


def seal(spark: SparkSession, root: str, generation_id: str) -> DataFrame:
    """Write the trees of a generation; returns the roots (table_name, rows, digest).

    Who can edit the store can edit the seal too: roots kept elsewhere prove that it is the one written.
    Sealing again writes the trees of what is there then.
    """
    place, depths = _place(spark, root, generation_id)
    _trees(pinned_read(spark, root, generation_id), depths).write.mode("overwrite").parquet(place)
    return spark.read.schema(NODES).parquet(place).filter("node = ''").select("table_name", "rows", "digest")


def damage(spark: SparkSession, root: str, generation_id: str) -> DataFrame:
    """(table_name, node, rows_before, rows_after): leaves whose rows are no longer those sealed."""
    place, depths = _place(spark, root, generation_id)
    files, folder = hadoop_path(spark, f"{place}/_SUCCESS")
    if not files.exists(folder):
        raise PublicationError(f"NOT_SEALED: {generation_id}")
    sealed = spark.read.schema(NODES).parquet(place)
    found = [
        differing_nodes(
            sealed.filter(F.col("table_name") == name), digest_tree(frame.drop("generation_id"), depths[name])
        )
        .filter(F.length("node") == depths[name])
        .select(F.lit(name).alias("table_name"), "*")
        for name, frame in pinned_read(spark, root, generation_id).items()
    ]
    return reduce(DataFrame.unionByName, found)
