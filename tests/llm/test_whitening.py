from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import whitening
from ledgerloom.llm.queries import QUERIES

DDL = "vec_id long, embedding array<float>, n string, label int"


def plainly(rows: list[tuple], components: int = 8):
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=1)
    c = np.zeros((len(kept), width))
    for place, (_, v) in enumerate(kept):
        c[place, : len(v)] = np.asarray(v, np.float32)
    x = np.floor(1024 * c).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / max(n, 1))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    moved = n * x.astype(object) - sums.astype(object)
    return [k for k, _ in kept], values, centred @ vectors / np.sqrt(values), (moved * moved).sum(1), values / centred.var(0).sum()


def check(found, rows):
    keys, values, white, deviation, explained = plainly(rows)
    place = {key: p for p, key in enumerate(keys)}
    assert len(found) == len(keys) * len(values)
    got = np.full(white.shape, np.nan)
    for row in found:
        p = place[row["vec_id"]]
        got[p, row["component"] - 1] = row["whitened"]
        assert (row["n"], row["deviation"]) == (len(keys), deviation[p])
        assert abs(row["explained"] / explained[row["component"] - 1] - 1) < 1e-9
        assert row["identity_error"] < 1e-8
    signs = np.sign((got * white).sum(0))
    assert np.abs(got * signs - white).max() < 1e-7


def test_given_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op13_embedding_whitening"](spark, small).collect(), rows)


def test_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(n, rng.standard_normal(60).tolist()) for n in range(300)]
    rows += [(1000, None), (1001, [None] * 60), (1002, [float("nan")] * 60), (1003, [1.0, float("inf")]), (1004, [2.0, 3.0]), (1005, [])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(3)
    check(whitening.whiten(frame).collect(), rows)


def test_null_and_repeated_keys_are_rows(spark):
    rng = np.random.default_rng(5)
    vectors = [v.tolist() for v in rng.standard_normal((20, 3))]
    rows = [(None if n < 10 else 7, v, "x", 1) for n, v in enumerate(vectors)]
    found = whitening.whiten(spark.createDataFrame(rows, DDL)).collect()
    assert len(found) == 60 and sum(r["vec_id"] is None for r in found) == 30


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None], [[]]])
def test_nothing_to_whiten(spark, vectors):
    frame = spark.createDataFrame([(n, v, "x", 1) for n, v in enumerate(vectors)], DDL)
    assert whitening.whiten(frame).collect() == []


def test_components_that_are_zero_have_no_rows(spark):
    rng = np.random.default_rng(6)
    flat = rng.integers(-9, 9, (50, 3)) @ rng.integers(-9, 9, (3, 60))
    rows = [(n, v.tolist(), "x", 1) for n, v in enumerate(flat.astype(float))]
    found = whitening.whiten(spark.createDataFrame(rows, DDL)).collect()
    assert {r["component"] for r in found} == {1, 2, 3} and found[0]["identity_error"] < 1e-8


def test_huge_entries(spark):
    """Entries stop at 2^53; deviations that do not fit into a long are null."""
    # S of the first dimension: -2^53 + 100000, 2^53 - 100000, 100000. Of the second: 306144.
    assert (3 * 100_000 - 100_000) ** 2 + (3 * 103_072 - 306_144) ** 2 == 40_009_437_184
    rows = [(0, [3e38, 1.0], "x", 1), (1, [-3e38, 2.0], "x", 1), (2, [0.0, 3.0], "x", 1)]
    found = whitening.whiten(spark.createDataFrame(rows, DDL)).collect()
    assert {r["vec_id"]: (r["component"], r["deviation"]) for r in found} == {
        0: (1, None),
        1: (1, None),
        2: (1, 40_009_437_184),
    }


def test_iteration_finds_close_eigenvalues():
    rng = np.random.default_rng(7)
    basis, _ = np.linalg.qr(rng.standard_normal((200, 200)))
    values = np.linspace(1, 2, 200) ** 2
    matrix = (basis * values) @ basis.T
    found, vectors = whitening.leading_components(lambda q: matrix @ q, 200, 8)
    assert np.allclose(found, values[::-1][:8], rtol=1e-12)
    assert np.abs(np.abs(np.sum(vectors * basis[:, ::-1][:, :8], axis=0)) - 1).max() < 1e-12
