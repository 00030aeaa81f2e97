"""Mix sources to target weights, in exact quotas of blocks.

Every source is a stream of its documents in a seeded random order, cut into blocks of words. The mix
takes some whole epochs of a source and the first words of one more. Its quota of blocks (those of all
epochs together) is split among the output shards by a tree: each node draws, from a multivariate
hypergeometric distribution, how many blocks of every source go to its left half, so that all quotas and
all shard sizes stay exact. The draws of a source are then numbered, each epoch in a permutation of its
own, and every shard takes a run of its quota's length: no block is drawn twice in an epoch. What the mix takes of
a document is summed over the blocks that shards draw. The tree is built in the tasks, once per worker.
Within a shard a seeded order shuffles the documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import carried, delivered, partitions
from ledgerloom.session import literal_frame

#: No document is taken more often than this.
MOST_EPOCHS = 3
#: Words of a block. It grows with the input so that the tree's draws stay below its generator's limit.
BLOCK_WORDS = 4096
MOST_BLOCKS = 100_000_000
#: Documents of one slice of a source's order; a slice is summed in one task.
SLICE_ROWS = 500_000
#: Output shards at least, and the words that one holds; a shard is shuffled in one task.
SHARDS = 64
WORDS_PER_SHARD = 20_000_000


@dataclass(frozen=True)
class Source:
    """A source's words, its weight and target, and the blocks of one epoch and of all draws."""

    name: str | None
    words: int
    weight: float
    target: float
    blocks: int
    quota: int


def targets(words: Sequence[int], weights: Sequence[float]) -> list[float]:
    """Shares of all words by weight; one above MOST_EPOCHS times its source stops there, and the excess
    is shared again by weight among the others, until none is above."""
    left, open_to = float(sum(words)), list(range(len(words)))
    found = [0.0] * len(words)
    while open_to:
        weight = sum(weights[i] for i in open_to)
        over = [i for i in open_to if left * weights[i] / weight > MOST_EPOCHS * words[i]]
        if not over:
            for i in open_to:
                found[i] = left * weights[i] / weight
            break
        for i in over:
            found[i] = float(MOST_EPOCHS * words[i])
            left -= found[i]
        stopped = set(over)
        open_to = [i for i in open_to if i not in stopped]
    return found


def default_weights(sources: int) -> list[float]:
    return [1.0 + i % 3 for i in range(sources)]


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of every source (column) for every shard (row): exact totals, shard sizes at most one apart."""
    generator = np.random.default_rng([seed, shards, len(quotas)])
    rows: list[np.ndarray] = []

    def split(here: np.ndarray, leaves: int) -> None:
        if leaves == 1:
            rows.append(here)
            return
        left = leaves // 2
        amount = int(here.sum()) * left // leaves
        drawn = generator.multivariate_hypergeometric(here, amount, method="marginals")
        split(drawn, left)
        split(here - drawn, leaves - left)

    split(np.asarray(quotas, np.int64), shards)
    return np.stack(rows)


def _permuted(block: np.ndarray, blocks: np.ndarray, seed: int, epoch: int) -> np.ndarray:
    """Place of every block in its epoch's order: a seeded affine permutation of 0 to blocks - 1."""
    place = np.empty(len(block), np.int64)
    for count in np.unique(blocks):
        own = blocks == count
        generator = np.random.default_rng([seed, epoch, int(count)])
        while gcd(step := int(generator.integers(1, max(2, count))), int(count)) != 1:
            pass
        place[own] = (block[own] * step + int(generator.integers(0, count))) % count
    return place


@lru_cache(maxsize=4)
def _runs(quotas: tuple[int, ...], shards: int, seed: int) -> np.ndarray:
    """Where every shard's run of a source's draws ends (row: shard, column: source); one tree per worker."""
    return np.cumsum(split_quotas(np.asarray(quotas, np.int64), shards, seed), axis=0)


@dataclass(frozen=True)
class Drawn:
    """Documents that shards draw in one epoch: row numbers, the shard of each, and the words it takes."""

    epoch: int
    rows: np.ndarray
    shards: np.ndarray
    words: np.ndarray


def draw(
    sources: Sequence[Source],
    runs: np.ndarray,
    source: np.ndarray,
    start: np.ndarray,
    size: np.ndarray,
    *,
    block_words: int,
    whole: bool,
    seed: int = 0,
) -> Iterator[Drawn]:
    """What the shards, by their runs of draws, take of documents at `start` in their sources' streams.

    Words are summed over the blocks that a document lies in and that some shard's run reaches; a block
    outside all runs gives none. The document goes to the shard that draws the block it begins in.
    """
    own = {name: np.asarray([getattr(s, name) for s in sources], np.int64)[source] for name in ("words", "blocks")}
    wanted = np.asarray([round(s.target) for s in sources], np.int64)[source]
    full = wanted // np.maximum(own["words"], 1)
    rest = wanted - full * own["words"]
    last_block = own["blocks"] - 1
    # An empty document counts with the block it stands at.
    first = np.minimum(start // block_words, last_block)
    last = np.minimum(np.maximum(start + size - 1, start) // block_words, last_block)
    spans = last - first + 1
    heads = np.cumsum(spans) - spans
    row = np.repeat(np.arange(len(source)), spans)
    block = first[row] + np.arange(len(row)) - heads[row]
    begin = np.maximum(start[row], block * block_words)
    end = np.minimum((start + size)[row], (block + 1) * block_words)
    for epoch in range(MOST_EPOCHS):
        is_full = (epoch < full)[row]
        # The last epoch holds its first blocks only, the last of them in part: the stream's order is random.
        place = np.where(is_full, _permuted(block, own["blocks"][row], seed, epoch), block)
        number = epoch * own["blocks"][row] + place
        shard = np.empty(len(row), np.int64)
        for one in np.unique(source):
            mine = source[row] == one
            shard[mine] = np.searchsorted(runs[:, one], number[mine], "right")
        in_epoch = is_full | ((epoch == full)[row] & (begin < rest[row]))
        reached = in_epoch & (shard < len(runs))
        words = np.where(is_full, end, np.minimum(end, rest[row])) - begin
        taken = np.zeros(len(source), np.int64)
        np.add.at(taken, row, np.where(reached, np.maximum(words, 0), 0))
        partly = epoch >= full
        if whole:
            taken = np.where(partly & (2 * taken >= np.maximum(size, 1)), size, np.where(partly, 0, taken))
        rows = np.flatnonzero(reached[heads] & (~partly | (taken > 0))) if len(heads) else heads
        yield Drawn(epoch, rows, shard[heads][rows], taken[rows])


COPIES = "array<struct<epoch: int, shard: int, words: long>>"


def _copies(sources: list[Source], shards: int, seed: int, block_words: int, whole: bool) -> Column:
    """The copies of a document that the mix takes: from its source, place in the stream, and words."""
    quotas = tuple(s.quota for s in sources)

    @F.pandas_udf(COPIES)
    def copies(number: pd.Series, begin: pd.Series, size: pd.Series) -> pd.Series:
        columns = (column.to_numpy(np.int64) for column in (number, begin, size))
        runs = _runs(quotas, shards, seed)
        found: list[list[dict]] = [[] for _ in range(len(number))]
        for drawn in draw(sources, runs, *columns, block_words=block_words, whole=whole, seed=seed):
            each = (column.tolist() for column in (drawn.rows, drawn.shards, drawn.words))
            for row, shard, words in zip(*each, strict=True):
                found[row].append({"epoch": drawn.epoch, "shard": shard, "words": words})
        return pd.Series(found)

    return copies


def plan(
    frame: DataFrame,
    size: str = "size",
    source: str = "source",
    key: str = "doc_id",
    *,
    least_shards: int = SHARDS,
    words_per_shard: int = WORDS_PER_SHARD,
    seed: int = 0,
    weights: Sequence[float] | None = None,
    whole_documents: bool = False,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Add source_size, target and `copies` (epoch, shard, words taken) to every row.

    Sources are ordered by code point, null last; the default weights are 1, 2, 3, repeating. Together the
    targets make up all words. Words taken from a source equal its rounded target: at most one document of
    a source is taken in part, its first words; with `whole_documents` that one is taken whole if half of
    it or more would be, and the source is off by half a document at most. A null or negative size counts
    as 0; a document without words is copied in whole epochs only. Repeated rows are separate documents; an
    empty table gives no rows; columns of the added names are replaced. Reruns agree where rows differ in
    key; rows of one key may change places among themselves.
    """
    spark = frame.sparkSession
    place = F.xxhash64(F.lit(seed), F.col(f"`{key}`"))
    rows = carried(
        frame,
        source=F.col(f"`{source}`").cast("string"),
        size=F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)), F.lit(0)),
        place=place,
    )
    light = rows.select("source", "size", "place")
    counts = light.groupBy("source").agg(F.sum("size").alias("words"), F.count("size").alias("rows"))
    # One row per source: the recipe of a mix is metadata.
    found = sorted(counts.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    total = sum(r["words"] for r in found)
    per_block = max(block_words, total * MOST_EPOCHS // MOST_BLOCKS)
    weight = list(weights) if weights is not None else default_weights(len(found))
    sources = []
    for row, own, target in zip(
        found, weight, targets([r["words"] for r in found], weight), strict=True
    ):
        blocks = max(1, -(-row["words"] // per_block))
        full, rest = divmod(round(target), row["words"]) if row["words"] else (0, 0)
        quota = full * blocks + -(-rest // per_block)
        sources.append(Source(row["source"], row["words"], own, target, blocks, quota))
    recipe = [
        {"recipe_source": s.name, "number": n, "source_size": s.words, "target": s.target}
        for n, s in enumerate(sources)
    ]
    kinds = dict(
        recipe_source=pa.string(), number=pa.int64(), source_size=pa.int64(), target=pa.float64()
    )
    recipe_frame = literal_frame(spark, recipe, **kinds)

    # Where each document stands in its source's stream: slices of the hash order are summed first, so
    # that a source of any size is spread over many tasks.
    slices = max(1, -(-max([r["rows"] for r in found], default=0) // SLICE_ROWS))
    slices = max(slices, partitions(spark, 0, 1)) if found else 1
    of_slice = F.floor((F.col("place") / F.lit(float(1 << 64)) + F.lit(0.5)) * slices).cast("long")
    numbered = rows.join(recipe_frame, F.col("source").eqNullSafe(F.col("recipe_source")))
    sliced = numbered.withColumn("slice", of_slice)
    sums = sliced.groupBy("number", "slice").agg(F.sum("size").alias("slice_words"))
    # One row per source and slice.
    earlier = Window.partitionBy("number").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        "number", "slice", F.coalesce(F.sum("slice_words").over(earlier), F.lit(0)).alias("base")
    )
    within = (
        Window.partitionBy("number", "slice")
        .orderBy("place", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = sliced.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    known = placed.join(bases, ["number", "slice"])
    shards = max(least_shards, -(-total // words_per_shard))
    copies = _copies(sources, shards, seed, per_block, whole_documents)
    return delivered(
        known,
        source_size=F.col("source_size"),
        target=F.col("target"),
        copies=copies("number", F.col("base") + F.col("inside"), "size"),
    )


def mix(planned: DataFrame, key: str = "doc_id", *, seed: int = 0) -> DataFrame:
    """The mix itself: a row for every copy, with epoch, shard, words, and `place`, the order in its shard."""
    rows = carried(planned, copy=F.explode("copies"), own=F.col(f"`{key}`"))
    return delivered(
        rows,
        epoch=F.col("copy.epoch"),
        shard=F.col("copy.shard"),
        words=F.col("copy.words"),
        place=F.xxhash64(F.lit(seed), F.col("copy.epoch"), F.col("own")),
    )


def shuffled(mixed: DataFrame) -> DataFrame:
    """The mix with every shard in one partition, in its own random order."""
    return mixed.repartition("shard").sortWithinPartitions("shard", "place")
