"""Shards: nearly equal sizes, gapless slots, groups kept together where they can be."""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from helpers import clashing, empty, messy
from ledgerloom.llm import sharding
from ledgerloom.session import fresh_dir


def check(rows, shards, tolerance):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += max(r.size or 1, 1)
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    mean = sum(sizes.values()) / shards
    assert all(abs(sizes[n] - mean) <= tolerance * mean for n in range(shards)), sizes


def test_sizes_are_nearly_equal_with_one_group_of_a_third(spark):
    rows = spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"),
        (F.col("id") % 97 + 1).alias("size"),
    )
    placed = sharding.shard(rows, ["text"], "size", 8).cache()
    found = placed.collect()
    assert sorted(r.id for r in found) == list(range(30_000))
    check(found, 8, 0.02)
    split = placed.groupBy("text").agg(F.countDistinct("shard").alias("n")).filter("n > 1").collect()
    assert all(r.text == "same" or r.n == 2 for r in split) and len(split) <= 8


def test_many_null_texts_do_not_fill_a_range(spark):
    # Three quarters of the rows have next to no size, so bounds on size alone leave them in few ranges.
    rows = spark.range(40_000).select(
        "id",
        F.when(F.col("id") % 4 == 0, F.repeat(F.col("id").cast("string"), 60)).alias("text"),
    )
    sized = rows.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    placed = sharding.shard(sized, ["text"], "size", 4, ranges_per_shard=8, rows_per_range=500)
    found = placed.collect()
    assert sorted(r.id for r in found) == list(range(40_000))
    assert max(Counter(r.shard_range for r in found).values()) <= 500
    check(found, 4, 0.05)


def test_identical_rows_only(spark):
    rows = spark.range(4000).select(F.lit(1).alias("id"), F.lit(None).cast("string").alias("t"), F.lit(5).alias("size"))
    check(sharding.shard(rows, ["t"], "size", 4).collect(), 4, 0.02)


def test_a_giant_row_does_not_stop_the_search(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") == 7, 10**9).otherwise(1).alias("size"))
    found = sharding.shard(rows, ["id"], "size", 4).collect()
    assert len(found) == 500
    check(found, 4, 4.0)


def test_awkward_rows(spark):
    table = messy(spark).withColumn("bytes", F.octet_length("text"))
    found = sharding.shard(clashing(table), ["text"], "bytes", 3).collect()
    assert len(found) == table.count() and all(r.row == "kept" for r in found)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert sharding.shard(empty(spark), ["text"], "n_chars", 3).count() == 0


def test_written_shards(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    path = fresh_dir(spark, "shards")
    sharding.write_shards(sharding.shard(documents, ["text"], "n_chars", 4), path)
    assert spark.read.parquet(path).groupBy("shard").count().count() == 4
