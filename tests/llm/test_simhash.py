"""SimHash components against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import clashing, empty, messy, roots
from ledgerloom.llm import simhash


def plain_simhash(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[n : n + 3]) for n in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, bits):
    pairs = [
        (a, b)
        for a in range(len(values))
        for b in range(a)
        if (values[a] ^ values[b]).bit_count() <= bits
    ]
    return roots(len(values), pairs)


def check(rows, table, bits=3):
    keys = [r.doc_id for r in table]
    prints = [plain_simhash(r.text) for r in table]
    root = plain_components(prints, bits)
    least = {}
    for key, own in zip(keys, root, strict=True):
        if key is not None:
            least[own] = min(key, least.get(own, key))
    wanted = sorted(
        (str(key), f"{value:016x}", str(least.get(own)))
        for key, value, own in zip(keys, prints, root, strict=True)
    )
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == wanted
    stay = [r for r in rows if r.stays]
    assert len(stay) == len(set(root))
    assert all(r.doc_id == r.component_id for r in stay)


def test_documents(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    check(simhash.near_duplicates(documents).collect(), documents.collect())


def test_awkward_rows(spark):
    table = messy(spark)
    check(simhash.near_duplicates(table).collect(), table.collect())
    found = simhash.near_duplicates(clashing(table)).collect()
    assert len(found) == table.count() and all(r.size == "kept" for r in found)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def clustered(seed, centres, members, flips):
    generator = np.random.default_rng(seed)
    found = set()
    for centre in generator.integers(0, 1 << 64, centres, dtype=np.uint64):
        value = int(centre)
        for _ in range(int(generator.integers(1, members))):
            for bit in generator.integers(0, 64, int(generator.integers(0, flips + 1))):
                value ^= 1 << int(bit)
            found.add(value)
    return sorted(found)


@pytest.mark.parametrize("sample, bits", [(60_000, 3), (500, 3), (300, 0), (400, 6)])
def test_links_connect_what_brute_force_connects(spark, sample, bits):
    values = clustered(sample + bits, 500, 6, 4)
    signed = np.asarray(values, np.uint64).view(np.int64)
    points = spark.createDataFrame([(int(v),) for v in signed], "point long")
    edges = simhash.links(points, bits, sample_points=sample)
    place = {int(v): n for n, v in enumerate(signed)}
    pairs = [(place[r.a], place[r.b]) for r in edges.collect()]
    assert all((values[a] ^ values[b]).bit_count() <= bits for a, b in pairs)
    assert roots(len(values), pairs) == plain_components(values, bits)
    found = {r.point: r.root for r in simhash.components(edges).collect()}
    own = roots(len(values), pairs)
    for a in {a for pair in pairs for a in pair}:
        same = [signed[n] for n in range(len(values)) if own[n] == own[a]]
        assert found.get(int(signed[a]), int(signed[a])) == min(same)


def test_one_dense_group_gives_few_edges(spark):
    generator = np.random.default_rng(5)
    values = {0}
    while len(values) < 3000:
        values.add(sum(1 << int(b) for b in set(generator.integers(0, 64, 2))))
        if len(values) > 2000:
            break
    points = spark.createDataFrame([(v - (1 << 64) if v >= 1 << 63 else v,) for v in values], "point long")
    edges = simhash.links(points)
    assert edges.count() < 20 * len(values)
    found = simhash.components(edges)
    assert found.select("root").distinct().count() == 1


def crowded_points(kind):
    """Points of which many lie in one leaf: random ones, one half in common, or all few bits apart."""
    generator = np.random.default_rng(len(kind))
    values = set(clustered(9, 300, 4, 3))
    wide = generator.integers(0, 1 << 32, 1500, dtype=np.uint64).tolist()
    if kind == "upper":
        values |= {(7 << 32) | v for v in wide}
    elif kind == "lower":
        values |= {(v << 32) | 7 for v in wide}
    elif kind == "ball":
        values |= {sum(1 << int(b) for b in set(generator.integers(0, 64, 3).tolist())) for _ in range(1500)}
    else:
        values |= {v ^ (1 << int(b)) for v, b in zip(list(values), generator.integers(0, 64, len(values)), strict=True)}
    return sorted(values)


@pytest.mark.parametrize("kind", ["spread", "upper", "lower", "ball"])
def test_crowded_shards_are_split_and_lose_no_link(spark, kind, monkeypatch):
    values = crowded_points(kind)
    signed = np.asarray(values, np.uint64).view(np.int64)
    points = spark.createDataFrame([(int(v),) for v in signed], "point long")
    seen = {}
    shards = simhash._shards

    def watched(visits, max_bits, shard_rows):
        found = shards(visits, max_bits, shard_rows)
        seen["largest"] = max(visits.groupBy("half", "leaf").count().toArrow()["count"].to_pylist())
        sizes = found.groupBy("round", "half", "leaf", "low", "high").count().collect()
        seen["group"] = max(r["count"] for r in sizes)
        seen["rounds"] = {r["round"] for r in sizes}
        return found

    monkeypatch.setattr(simhash, "_shards", watched)
    edges = simhash.links(points, 3, sample_points=400, shard_rows=200).collect()
    assert seen["largest"] > 200 and len(seen["rounds"]) > 1
    assert kind == "ball" or max(seen["rounds"]) > 0  # cuts found, and not blocks alone
    assert seen["group"] <= 3 * 200  # two blocks, dealt by hash
    place = {int(v): n for n, v in enumerate(signed)}
    pairs = [(place[r.a], place[r.b]) for r in edges]
    assert all((values[a] ^ values[b]).bit_count() <= 3 for a, b in pairs)
    assert roots(len(values), pairs) == plain_components(values, 3)


@pytest.mark.parametrize("bits", [0, 3])
def test_a_shard_links_what_brute_force_links(bits):
    """Whole, with visitors that it does not own, and in two parts."""
    values = crowded_points("ball")[:1200]
    points = np.asarray(values, np.uint64)
    everyone = np.ones(len(points), bool)
    found = simhash.link_shard(points, 0, everyone, bits).edges().tolist()
    assert len(found) < len(points)
    assert roots(len(values), found) == plain_components(values, bits)
    owned = np.arange(len(points)) % 3 == 0
    part = (np.arange(len(points)) % 2).astype(np.int64)
    found = simhash.link_shard(points, 1, owned, bits, part).edges().tolist()
    wanted = [
        (a, b) for a in range(len(values)) for b in range(a)
        if (values[a] ^ values[b]).bit_count() <= bits and (owned[a] or owned[b]) and part[a] != part[b]
    ]
    assert all((owned[a] or owned[b]) and part[a] != part[b] for a, b in found)
    assert roots(len(values), found) == roots(len(values), wanted)


def test_a_half_in_common_is_told_apart_by_the_other(monkeypatch):
    generator = np.random.default_rng(3)
    points = np.unique((7 << 32) | generator.integers(0, 1 << 32, 20_000, dtype=np.uint64))
    compare, compared = simhash._compare, []

    def counted(links, points, owned, own, visiting, max_bits):
        compared.append(len(own) * len(visiting))
        compare(links, points, owned, own, visiting, max_bits)

    monkeypatch.setattr(simhash, "_compare", counted)
    simhash.link_shard(points, 0, np.ones(len(points), bool), 3)
    assert sum(compared) < 0.8 * len(points) ** 2


def test_a_long_chain_is_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = simhash.components(edges).collect()
    assert len(found) == 300 and {r.root for r in found} == {0}


def test_every_near_point_is_reached_in_the_tree():
    generator = np.random.default_rng(1)
    points = generator.integers(0, 1 << 32, 4000, dtype=np.uint32)
    tree = simhash.build_tree(points[:500], 20)
    rows, leaves, owned = simhash.descend(tree, points, 1)
    home = dict(zip(rows[owned].tolist(), leaves[owned].tolist(), strict=True))
    assert len(home) == len(points) == owned.sum()
    visited = {}
    for row, leaf in zip(rows.tolist(), leaves.tolist(), strict=True):
        visited.setdefault(row, set()).add(leaf)
    moved = points ^ (np.uint32(1) << generator.integers(0, 32, 4000).astype(np.uint32))
    other_rows, other_leaves, other_owned = simhash.descend(tree, moved, 1)
    for row, leaf in zip(other_rows[other_owned].tolist(), other_leaves[other_owned].tolist(), strict=True):
        assert leaf in visited[row]
