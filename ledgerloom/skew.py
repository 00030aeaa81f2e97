"""Joins and running totals that stay balanced when one key holds a large share of the rows.

`hot_keys` looks for heavy keys on a sample. What it finds only steers the physical strategy: every
function below returns the same rows whatever set of keys it is given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import shared_dir


@dataclass(frozen=True)
class SkewPolicy:
    """A key is hot from about `hot_rows` rows on; a slice of a hot key has `slice_rows` or so.

    There can be no more hot keys than the rows of a frame divided by `hot_rows`: some thousands, even
    where a frame has tens of billions of rows. A policy with a threshold too low for that sets `most_keys`:
    only so many keys, the heaviest, are hot then, and all others go the ordinary way.
    """

    hot_rows: int = 4_000_000
    sample_fraction: float = 0.001
    slice_rows: int = 1_000_000
    most_keys: int | None = None


DEFAULT_POLICY = SkewPolicy()

#: Rows dealt out by key that one task should get. Keys pack so well that a shuffle's bytes say little about what
#: its rows take in a sort or a hash table, so larger frames name their tasks instead of leaving them to bytes.
ROWS_PER_TASK = 1_000_000

#: The column of a hot-key frame that says the slices' worth of rows that a key has.
SLICES = "_slices"


def hot_keys(
    frame: DataFrame,
    keys: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
    rows: int | None = None,
) -> DataFrame | None:
    """All hot keys (`most_keys` at most) and their estimated rows as a literal frame, None without any.

    A frame of fewer rows than make a key hot has none; its count is metadata for Parquet. Otherwise
    one job counts keys on a sample of the key columns. The keys are pinned as literals, so the two
    sides of a split can never disagree about them, not even after an executor is lost.
    """
    if (frame.count() if rows is None else rows) < policy.hot_rows:
        return None
    sampled = frame.select(*keys)
    # A hot key must show up with a thousand sampled rows or so, whatever the threshold.
    fraction = min(1.0, max(policy.sample_fraction, 1000 / policy.hot_rows))
    if fraction < 1.0:
        sampled = sampled.sample(fraction, seed=7)
    found = (
        sampled.groupBy(*keys)
        .count()
        .filter(F.col("count") >= max(1, int(policy.hot_rows * fraction)))
        .select(*keys, (F.col("count") / fraction / policy.slice_rows).alias(SLICES))
    )
    if policy.most_keys is not None:
        found = found.orderBy(F.desc(SLICES), *keys).limit(policy.most_keys)
    heaviest = found.toArrow()
    if heaviest.num_rows == 0:
        return None
    return frame.sparkSession.createDataFrame(heaviest, found.schema)


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks for so many rows dealt out by key, None for the few that the session's own partitions will hold."""
    if rows <= 4 * ROWS_PER_TASK:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(rows / ROWS_PER_TASK))


def spread(frame: DataFrame, keys: Sequence[str], tasks: int | None) -> DataFrame:
    """The frame dealt out by its keys to so many tasks, as it is where there is no number."""
    return frame if tasks is None else frame.repartition(tasks, *keys)


def spread_groups(
    frame: DataFrame,
    keys: Sequence[str],
    tasks: int | None,
    hot: DataFrame | None,
    aggregate: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """An aggregate by `keys`, or by them and more, over rows dealt out to so many tasks first.

    Tables with few rows per key gain nothing from collapsing before the shuffle, where hash tables grow with
    the files read. The rows of hot keys still collapse first.
    """
    if tasks is None:
        return aggregate(frame)
    if hot is None:
        return aggregate(spread(frame, keys, tasks))
    hot_rows, other_rows = split_hot(frame, hot, keys)
    return aggregate(hot_rows).unionByName(aggregate(spread(other_rows, keys, tasks)))


def split_hot(frame: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of hot keys, all other rows). Null keys are compared as values."""
    marked = hot.select(*[F.col(key).alias(f"_hot_{key}") for key in keys])
    condition = reduce(
        Column.__and__, [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    )
    small = F.broadcast(marked)
    return frame.join(small, condition, "left_semi"), frame.join(small, condition, "left_anti")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Join many rows to a side that has one row per key (`inner`, `left`, `left_semi`, `left_anti`).

    The lookup rows of hot keys number at most one per hot key, so they are broadcast and the rows of
    those keys stay where they were read; everything else is an ordinary shuffled equi join, over `tasks`
    tasks if that is given.
    """
    keys = list(keys)
    if hot is None:
        return spread(rows, keys, tasks).join(lookup, keys, how)
    hot_rows, other_rows = split_hot(rows, hot, keys)
    hot_lookup = F.broadcast(lookup.join(F.broadcast(hot.select(*keys)), keys, "left_semi"))
    others = spread(other_rows, keys, tasks).join(lookup, keys, how)
    return hot_rows.join(hot_lookup, keys, how).unionByName(others)


def running_sums(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    hot: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Add cumulative sums per key in the given order, the current row included.

    Ordinary keys use a window, over `tasks` tasks if that is given. The rows of hot keys are range-partitioned by key and order, so one
    key spreads over many slices: each slice sums its own rows and adds the total of the slices
    before it. The slice numbers are fixed with a checkpoint, because a second evaluation of the
    range partitioning could cut elsewhere.
    """
    keys, order = list(keys), list(order)
    inputs = {name: f"_in_{name}" for name in sums}
    prepared = frame.select("*", *[column.alias(inputs[name]) for name, column in sums.items()])

    def within(*partition: str):
        return (
            Window.partitionBy(*partition)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    def plain(rows: DataFrame) -> DataFrame:
        window = within(*keys)
        return spread(rows, keys, tasks).select(
            *frame.columns, *[F.sum(inputs[name]).over(window).alias(name) for name in sums]
        )

    if hot is None:
        return plain(prepared)

    hot_rows, other_rows = split_hot(prepared, hot, keys)
    shared_dir(frame.sparkSession)
    wanted = hot.agg(F.sum(SLICES)).first()[0]
    slices = max(2, ceil(wanted), int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = (
        hot_rows.repartitionByRange(slices, *keys, *order)
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint()
    )
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[F.sum(inputs[name]).alias(f"_total_{name}") for name in sums]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per key and slice it touches: at most hot keys + slices rows.
    carried = totals.select(
        *[F.col(key).alias(f"_of_{key}") for key in keys],
        F.col("_slice").alias("_of_slice"),
        *[F.sum(f"_total_{name}").over(earlier).alias(f"_carry_{name}") for name in sums],
    )
    same_slice = reduce(
        Column.__and__,
        [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys],
        F.col("_slice") == F.col("_of_slice"),
    )
    local = within("_slice", *keys)
    sums_local = sliced.select("*", *[F.sum(inputs[n]).over(local).alias(n) for n in sums])
    balanced = sums_local.join(F.broadcast(carried), same_slice, "left").select(
        *frame.columns,
        *[
            F.when(F.col(name).isNull(), F.col(f"_carry_{name}"))
            .otherwise(F.col(name) + F.coalesce(F.col(f"_carry_{name}"), F.lit(0)))
            .alias(name)
            for name in sums
        ],
    )
    return plain(other_rows).unionByName(balanced)
