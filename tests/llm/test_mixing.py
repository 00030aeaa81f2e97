"""The mix: targets, exact quotas, whole documents, reruns."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing, empty, messy
from ledgerloom.llm import mixing
from ledgerloom.llm.common import word_count


def test_targets_stop_at_three_times_the_source():
    found = mixing.targets([100, 1000, 10], [1, 2, 3])
    assert found[2] == 30
    assert found == pytest.approx([300, 780, 30])
    assert mixing.targets([], []) == []
    assert mixing.targets([0, 0], [1, 2]) == [0, 0]
    assert sum(mixing.targets([5, 0, 7], [1, 2, 3])) == pytest.approx(12)


def test_quotas_are_split_exactly():
    quotas = np.asarray([1000, 0, 37, 250_000])
    for shards in (1, 3, 8):
        rows = mixing.split_quotas(quotas, shards, seed=3)
        assert rows.shape == (shards, 4) and (rows >= 0).all()
        assert (rows.sum(axis=0) == quotas).all()
        assert np.ptp(rows.sum(axis=1)) <= shards
        assert (rows == mixing.split_quotas(quotas, shards, seed=3)).all()


def test_permutations_are_permutations():
    blocks = np.arange(97)
    place = mixing._permuted(blocks, np.full(97, 97), seed=1, epoch=0)
    assert sorted(place) == list(range(97)) and (place != blocks).any()


def one_source(documents=300, size=50, share=1.7, block_words=64):
    words = documents * size
    blocks = -(-words // block_words)
    full, rest = divmod(round(words * share), words)
    quota = full * blocks + -(-rest // block_words)
    source = mixing.Source("a", words, 1.0, float(round(words * share)), blocks, quota)
    columns = np.zeros(documents, np.int64), np.arange(documents) * size, np.full(documents, size)
    return source, columns


def taken_of(source, runs, columns, block_words=64):
    taken, shards = np.zeros(len(columns[0]), np.int64), []
    for drawn in mixing.draw([source], runs, *columns, block_words=block_words, whole=False):
        taken[drawn.rows] += drawn.words
        shards += [(drawn.epoch, *pair) for pair in zip(drawn.rows.tolist(), drawn.shards.tolist(), strict=True)]
    return taken, shards


def test_words_come_from_the_blocks_that_the_tree_gives_to_shards():
    source, columns = one_source()
    split = mixing.split_quotas(np.asarray([source.quota]), 8, seed=0)
    taken, shards = taken_of(source, np.cumsum(split, axis=0), columns)
    assert taken.sum() == source.target
    # A tree that gives all blocks to one shard moves the documents, not their words.
    stub = np.zeros_like(split)
    stub[0] = split.sum(axis=0)
    same, moved = taken_of(source, np.cumsum(stub, axis=0), columns)
    assert (same == taken).all() and moved != shards and {shard for *_, shard in moved} == {0}
    # A tree that loses the last shard's blocks loses their words.
    lost = np.cumsum(split[:-1], axis=0)
    fewer, _ = taken_of(source, lost, columns)
    missing = taken.sum() - fewer.sum()
    assert 64 * (split[-1, 0] - 1) < missing <= 64 * split[-1, 0]
    nothing, none = taken_of(source, np.zeros_like(split), columns)
    assert not nothing.any() and not none


def test_a_document_of_many_blocks_takes_the_words_of_all_of_them():
    source, columns = one_source(documents=3, size=1000, share=2.5, block_words=64)
    runs = np.cumsum(mixing.split_quotas(np.asarray([source.quota]), 4, seed=1), axis=0)
    taken, _ = taken_of(source, runs, columns)
    assert taken.tolist() == [3000, 2500, 2000]


def sized(frame):
    return frame.withColumn("size", word_count(F.col("text")))


def by_source(rows):
    taken, sizes, target = Counter(), Counter(), {}
    for r in rows:
        words = sum(c.words for c in r.copies)
        assert words <= 3 * r.size
        taken[r.source] += words
        sizes[r.source] += r.size
        target[r.source] = (r.source_size, r.target)
    return taken, sizes, target


@pytest.mark.parametrize("whole", [False, True])
def test_words_taken_come_to_the_target(spark, small, whole):
    documents = sized(spark.read.parquet(f"{small}/documents.parquet"))
    rows = mixing.plan(documents, whole_documents=whole, block_words=64).collect()
    taken, sizes, target = by_source(rows)
    names = sorted(sizes)
    wanted = mixing.targets([sizes[n] for n in names], mixing.default_weights(len(names)))
    for name, aim in zip(names, wanted, strict=True):
        assert target[name] == (sizes[name], pytest.approx(aim))
        largest = max(r.size for r in rows if r.source == name)
        assert abs(taken[name] - aim) <= (largest / 2 + 1 if whole else 1)
    if whole:
        assert all(c.words == r.size for r in rows for c in r.copies)
    # At most one document of a source is taken in part.
    parts = Counter(r.source for r in rows for c in r.copies if c.words != r.size)
    assert all(n == 1 for n in parts.values())


def test_reruns_and_other_partitionings_agree(spark, small):
    documents = sized(spark.read.parquet(f"{small}/documents.parquet"))
    found = [
        {r.doc_id: r.copies for r in mixing.plan(frame, block_words=64).collect()}
        for frame in (documents, documents.repartition(5))
    ]
    assert found[0] == found[1]


def test_shards_hold_their_quotas_and_no_copy_twice(spark, small):
    documents = sized(spark.read.parquet(f"{small}/documents.parquet"))
    rows = mixing.mix(mixing.plan(documents, least_shards=4, block_words=64)).collect()
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    words = defaultdict(int)
    for r in rows:
        words[r.shard] += r.words
    assert set(words) == set(range(4))
    assert max(words.values()) < 2 * min(words.values())
    spread = mixing.shuffled(mixing.mix(mixing.plan(documents, least_shards=4)))
    assert spread.count() >= len({r.doc_id for r in rows})


def test_awkward_rows(spark):
    table = sized(messy(spark))
    rows = mixing.plan(table).collect()
    assert len(rows) == table.count()
    taken, sizes, target = by_source(rows)
    assert {name: size for name, (size, _) in target.items()} == dict(sizes)
    for name in sizes:
        assert abs(taken[name] - target[name][1]) <= 1
    extra = clashing(messy(spark)).withColumn("size", F.lit(None).cast("long"))
    assert all(not r.copies for r in mixing.plan(extra).collect())
    assert mixing.mix(mixing.plan(sized(empty(spark)))).count() == 0
