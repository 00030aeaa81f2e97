"""A table's content as a tree of digests: proof against a forger, and a short way to what differs.

Every row is hashed; copies collapse to one hash and a count, so that no number of identical rows meets in
one task. Leaves are the hashes with the same first hex digits, sorted and hashed together; SHA-256 spreads
distinct rows evenly, so the number of digits alone bounds a leaf. A node above covers the up to 16 nodes
whose name begins with its own, and the root, of the empty name, covers the table. Unlike sums of hashes,
whose rows can be chosen to cancel out, any change of rows changes the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import unless
from ledgerloom.functions.text import canonical_row_json, sha256_hex
from ledgerloom.session import fresh_dir

#: Distinct rows that a leaf should hold, and the children of a node: one hex digit.
ROWS_PER_LEAF = 1024
CHILDREN = 16


def tree_depth(rows: int) -> int:
    """Digits of a leaf's name for a table of so many rows; trees of one depth can be compared."""
    depth = 0
    while ROWS_PER_LEAF * CHILDREN**depth < rows:
        depth += 1
    return depth


def _hashed(frame: DataFrame, depth: int) -> DataFrame:
    rows = frame.select(canonical_row_json(frame).alias("row"))
    hashed = rows.select("row", sha256_hex(F.col("row")).alias("row_hash"))
    return hashed.withColumn("node", F.substring("row_hash", 1, depth))


def _covering(members: Column) -> Column:
    """The digest of a node: over its sorted members, whatever order they came in."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(members)), ","), 256).alias("digest")


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes with names of `level` digits over those with one more."""
    name = F.substring("node", 1, level).alias("node")
    member = F.concat_ws(":", "node", "rows", "digest")
    named = nodes.select(name, "rows", member.alias("member"))
    return named.groupBy("node").agg(F.sum("rows").alias("rows"), _covering(F.col("member")))


def digest_tree(frame: DataFrame, depth: int) -> DataFrame:
    """(node, rows, digest) of every node that covers a row, from the leaves to the root, named ''.

    The leaves are written to the shared folder once; each level above is a sixteenth of the one below. Null
    columns are part of a row's hash, copies count, and an empty table has no nodes.
    """
    spark = frame.sparkSession
    copies = _hashed(frame, depth).groupBy("node", "row_hash").agg(F.count(F.lit(1)).alias("copies"))
    leaves = copies.groupBy("node").agg(
        F.sum("copies").alias("rows"), _covering(F.concat_ws(":", "row_hash", "copies"))
    )
    path = fresh_dir(spark, "digest-leaves")
    leaves.write.parquet(path)
    levels = [spark.read.schema(leaves.schema).parquet(path)]
    for level in reversed(range(depth)):
        levels.append(_above(levels[-1], level))
    return reduce(DataFrame.unionByName, levels)


def differing_nodes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(node, rows_before, rows_after) of the nodes of two trees that differ; null rows where one has none."""
    left = before.select("node", F.col("rows").alias("rows_before"), F.col("digest").alias("was"))
    right = after.select("node", F.col("rows").alias("rows_after"), F.col("digest").alias("now"))
    both = left.join(right, "node", "full")
    return both.filter(unless(F.col("was") == F.col("now"))).select("node", "rows_before", "rows_after")


def changed_rows(before: DataFrame, after: DataFrame, depth: int, nodes: DataFrame | None = None) -> DataFrame:
    """(node, row, copies_before, copies_after) of rows that one table holds more often than the other.

    `nodes` names the differing nodes, found from two trees if it is not given; rows under all other leaves
    are hashed but neither shuffled nor compared. Rows are shown as canonical JSON.
    """
    if nodes is None:
        nodes = differing_nodes(digest_tree(before, depth), digest_tree(after, depth))
    leaves = nodes.filter(F.length("node") == depth).select("node").distinct()
    sides = [
        _hashed(frame, depth).select(
            "*", *[F.lit(int(n == side)).alias(name) for side, name in enumerate(("was", "now"))]
        )
        for n, frame in enumerate((before, after))
    ]
    suspects = reduce(DataFrame.unionByName, sides).join(leaves, "node", "left_semi")
    counted = suspects.groupBy("node", "row_hash").agg(
        F.any_value("row").alias("row"),
        F.sum("was").alias("copies_before"),
        F.sum("now").alias("copies_after"),
    )
    return counted.filter("copies_before <> copies_after").drop("row_hash")
