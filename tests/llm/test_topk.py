"""Exact search against brute force in whole numbers."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import topk

DDL = "vec_id long, embedding array<float>, score string, tile string"


def plain(rows, asks, k):
    whole = []
    for key, vector in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole.append((key, [math.floor(256 * x) for x in vector]))
    lists = defaultdict(list)
    queries = {}
    for key, vector in whole:
        if asks(key):
            queries.setdefault(key, []).append(vector)
    for key, vectors in queries.items():
        for vector in vectors:
            for other, values in whole:
                if other != key:
                    score = sum(a * b for a, b in zip(vector, values, strict=False))
                    lists[key].append((-max(min(score, topk.MOST), topk.LEAST), other))
    return sorted(
        (key, rank, other, -score)
        for key, found in lists.items()
        for rank, (score, other) in enumerate(sorted(found)[:k], 1)
    )


@pytest.mark.parametrize("tiles", [(7, 11), (2048, 16_384)])
def test_ties_short_vectors_and_unusable_rows(spark, tiles):
    generator = np.random.default_rng(3)
    rows = [(n, generator.integers(-2, 3, 4).astype(float).tolist(), "s", "t") for n in range(300)]
    rows += [(n, [1.0, 1.0, 0.0, 0.0], "s", "t") for n in range(300, 400)]
    rows += [
        (401, None, "s", "t"),
        (402, [1.0, None, 2.0, 0.0], "s", "t"),
        (403, [float("nan"), 1.0, 1.0, 1.0], "s", "t"),
        (404, [float("inf"), 1.0, 1.0, 1.0], "s", "t"),
        (405, [0.1], None, None),
        (410, [], None, None),
        (None, [9.0, 9.0, 9.0, 9.0], None, None),
        (407, [3.0, 3.0, 3.0, 3.0], None, None),
        (407, [3.0, 3.0, 3.0, 3.0], None, None),
    ]
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    found = topk.top_k(frame, F.col("vec_id") % 10 == 0, 5, query_tile=tiles[0], candidate_tile=tiles[1])
    assert sorted(map(tuple, found.collect())) == plain([r[:2] for r in rows], lambda key: key % 10 == 0, 5)


def test_very_large_components(spark):
    rows = [(n, [float(3.0e7 * (n - 5)), 1.0e7 * n + 0.37]) for n in range(10)]
    rows += [(20, [3.0e30, 1.0]), (21, [-3.0e30, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") < 30, 3).collect()))
    assert found == plain(rows, lambda key: key < 30, 3)


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], DDL)
    assert topk.top_k(none, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], None, None)], DDL)
    assert topk.top_k(one, F.col("vec_id") % 50 == 0).count() == 0


def test_the_merge_tree_has_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "FAN_IN", 2)
    generator = np.random.default_rng(4)
    rows = [(n, generator.normal(size=8).tolist()) for n in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("vec_id") % 50 == 0, 5, candidate_tile=20)
    assert sorted(map(tuple, found.collect())) == plain(rows, lambda key: key % 50 == 0, 5)
