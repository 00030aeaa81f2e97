"""Digest trees against a plain version, and where they say that a table changed."""

from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from golden import as_batch, golden_rows
from ledgerloom.functions.text import canonical_row_json
from ledgerloom.operators import digest_tree as trees
from ledgerloom.plans.seal import damage, seal
from ledgerloom.schemas import TABLES
from ledgerloom.sources.generations import PublicationError, write_generation


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(frame, depth):
    copies = Counter(sha(r.row) for r in frame.select(canonical_row_json(frame).alias("row")).collect())
    found = {}
    for leaf in {h[:depth] for h in copies}:
        own = sorted((h, n) for h, n in copies.items() if h.startswith(leaf))
        members = sorted(f"{h}:{n}" for h, n in own)
        found[leaf] = (sum(n for _, n in own), sha(",".join(members)))
    level = dict(found)
    for length in reversed(range(depth)):
        above = {}
        for name in {node[:length] for node in level}:
            own = {node: value for node, value in level.items() if node.startswith(name)}
            members = sorted(f"{node}:{rows}:{digest}" for node, (rows, digest) in own.items())
            above[name] = (sum(rows for rows, _ in own.values()), sha(",".join(members)))
        found |= above
        level = above
    return found


def collected(tree):
    return {r["node"]: (r["rows"], r["digest"]) for r in tree.collect()}


@pytest.fixture(scope="module")
def table(spark):
    ids = spark.range(600)
    return ids.select(
        (F.col("id") % 400).alias("id"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("xé"), F.col("id") % 3)).alias("name"),
    )


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_tree_equals_a_plain_version(table, depth):
    tree = collected(trees.digest_tree(table, depth))
    assert tree == plain_tree(table, depth)
    assert tree[""][0] == 600


def test_order_and_partitions_do_not_matter_but_copies_do(table):
    tree = collected(trees.digest_tree(table, 1))
    assert collected(trees.digest_tree(table.repartition(7).orderBy(F.rand(1)), 1)) == tree
    assert collected(trees.digest_tree(table.unionByName(table.limit(1)), 1))[""] != tree[""]


def test_depth_bounds_a_leaf():
    assert [trees.tree_depth(n) for n in (0, 1024, 1025, 16 * 1024, 16 * 1024 + 1)] == [0, 0, 1, 1, 2]


def test_an_empty_table_has_no_nodes(table):
    assert trees.digest_tree(table.limit(0), 2).isEmpty()
    assert trees.differing_nodes(trees.digest_tree(table.limit(0), 0), trees.digest_tree(table, 0)).count() == 1


def test_a_single_changed_row_is_found_in_its_leaves(table):
    edited = table.withColumn("name", F.when(F.col("id") == 399, "other").otherwise(F.col("name")))
    one, other = trees.digest_tree(table, 2), trees.digest_tree(edited, 2)
    nodes = trees.differing_nodes(one, other)
    assert {len(r["node"]) for r in nodes.collect()} == {0, 1, 2}
    assert nodes.filter(F.length("node") == 2).count() <= 2
    found = {(r["row"], r["copies_before"], r["copies_after"]) for r in trees.changed_rows(table, edited, 2).collect()}
    assert found == {('{"id":399,"name":null}', 1, 0), ('{"id":399,"name":"other"}', 0, 1)}
    assert trees.changed_rows(table, table.repartition(3), 2).isEmpty()


def test_identical_rows_meet_as_one(spark):
    same = spark.range(20_000).select(F.lit(1).alias("id"))
    tree = collected(trees.digest_tree(same, 1))
    text = sha('{"id":1}')
    leaf = (20_000, sha(f"{text}:20000"))
    assert tree == {text[0]: leaf, "": (20_000, sha(f"{text[0]}:20000:{leaf[1]}"))}


def test_a_sealed_generation_shows_the_table_and_leaf_that_changed(spark, tmp_path):
    root, generation = str(tmp_path / "lake"), "g-sealed-0123456789ab"
    batch = as_batch(spark, golden_rows(12))
    write_generation({name: batch[name] for name in TABLES}, root, generation, 1, "d" * 64)
    with pytest.raises(PublicationError, match="NOT_SEALED"):
        damage(spark, root, generation)
    roots = {r["table_name"]: r["rows"] for r in seal(spark, root, generation).collect()}
    assert roots == {name: batch[name].count() for name in TABLES if batch[name].count()}
    assert damage(spark, root, generation).isEmpty()
    folder = Path(f"{root}/payments/generation_id={generation}/attempt=1")
    batch["payments"].limit(1).withColumn("amount_cents", F.lit(0).cast("bigint")).write.mode("append").parquet(
        str(folder)
    )
    rows = batch["payments"].count()
    assert [tuple(r) for r in damage(spark, root, generation).collect()] == [("payments", "", rows, rows + 1)]
    with pytest.raises(PublicationError, match="UNKNOWN_GENERATION"):
        seal(spark, root, "g-none-0123456789ab")
