"""Shards of nearly equal size by sampled splitters.

Rows are range-partitioned by (hash of the group columns, serial number), so that equal groups lie
together. Size-weighted samples of the keys give quantiles as range boundaries; the exact size of every
range is then counted, and ranges that came out overfull are sampled again and subdivided, by serial
number too where a single group fills them, until none is: overfull is a range of too much size or of
too many rows. Consecutive ranges are dealt to the shards by
their exact cumulative size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import carried, delivered, written
from ledgerloom.session import literal_frame

#: Ranges per shard: a shard's size is off by about one range at most.
RANGES_PER_SHARD = 256
#: Rows of a range at most, whatever their sizes: a range is ranked in one task.
ROWS_PER_RANGE = 2_000_000
#: Expected samples per range to be.
SAMPLES_PER_RANGE = 24

Splitters = list[tuple[int, int]]


def _range_of(hashes: np.ndarray, serials: np.ndarray, splitters: Splitters) -> np.ndarray:
    """Number of splitters (hash, serial) at or below each row's key."""
    first = np.asarray([s[0] for s in splitters], np.int64)
    second = np.asarray([s[1] for s in splitters], np.int64)
    low, high = np.searchsorted(first, hashes, "left"), np.searchsorted(first, hashes, "right")
    found = low.copy()
    for start in np.unique(low[low < high]):
        same = np.flatnonzero((low == start) & (high > start))
        own = second[start : high[same[0]]]
        found[same] = start + np.searchsorted(own, serials[same], "right")
    return found


def _range_column(splitters: Splitters) -> Column:
    @F.pandas_udf("long")
    def ranges(hashes: pd.Series, serials: pd.Series) -> pd.Series:
        return pd.Series(_range_of(hashes.to_numpy(), serials.to_numpy(), splitters))

    return ranges("hash", "serial")


def _cut(known: set, samples: list, pieces: int, whole_groups: bool) -> None:
    """Add boundaries that cut sorted samples of equal load into `pieces` runs.

    A boundary before any serial number keeps a group whole; a group is cut inside only where such a
    boundary is known already.
    """
    ordered = sorted((row["hash"], row["serial"]) for row in samples)
    for k in range(1, pieces) if ordered else []:
        value, serial = ordered[len(ordered) * k // pieces]
        known.add((value, -1) if whole_groups or (value, -1) not in known else (value, serial))


def shard(
    frame: DataFrame,
    group: Sequence[str],
    size: str,
    shards: int,
    *,
    ranges_per_shard: int = RANGES_PER_SHARD,
    rows_per_range: int = ROWS_PER_RANGE,
    seed: int = 0,
) -> DataFrame:
    """Add `shard` (0 to shards - 1), `shard_range` and `slot` (gapless from 0 in its shard).

    Law: the shards' sums of `size` are nearly equal, however large one group is. Rows of equal `group`
    values stay together but where a boundary between shards falls inside the group. No range has more than
    `rows_per_range` rows, nor over twice its share of the size unless one row makes up the excess. A size that is null
    or below 1 counts as 1; null group values are equal to each other; repeated rows are placed each for
    itself; an empty table gives no rows; columns of the added names are replaced.
    """
    keyed = carried(
        frame,
        hash=F.xxhash64(*[F.col(f"`{name}`") for name in group]),
        size=F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(1)), F.lit(1)),
        serial=F.monotonically_increasing_id(),
    )
    rows = written(keyed, "shards")  # pins the serial numbers
    light = rows.select("hash", "serial", "size")
    total, count = light.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("size")).first()
    aim = max(1, shards * ranges_per_shard, -(-count // rows_per_range))
    full = max(1.0, total / aim)
    splitters: Splitters = []
    attempt, overfull = 0, {0: aim}  # range: pieces to cut it into
    while overfull and count > 1:
        # Chance in proportion to load, the share that a row has of a range's size and of its rows.
        chance = (F.col("size") / F.lit(full) + F.lit(1 / rows_per_range)) * SAMPLES_PER_RANGE
        luck = F.pmod(F.xxhash64(F.lit(seed), F.lit(attempt), "serial"), F.lit(1 << 30)) / F.lit(1 << 30)
        within = light.withColumn("range", _range_column(splitters)).filter(luck < chance)
        if attempt:
            among = [{"range": number} for number in overfull]
            within = within.join(literal_frame(frame.sparkSession, among, range=pa.int64()), "range")
        # Bounded: some SAMPLES_PER_RANGE keys for every range to be.
        samples: dict[int, list] = {}
        for row in within.select("range", "hash", "serial").collect():
            samples.setdefault(row["range"], []).append(row)
        fresh = set(splitters)
        for number, pieces in overfull.items():
            _cut(fresh, samples.get(number, []), pieces, attempt == 0)
        splitters, attempt = sorted(fresh), attempt + 1
        sizes = light.withColumn("range", _range_column(splitters)).groupBy("range")
        counted = sizes.agg(F.sum("size"), F.count("size"), F.max("size")).collect()
        ranges = sorted(map(tuple, counted))
        # A range that is full of one large row cannot be cut to advantage.
        overfull = {
            r: max(2, round(held / full + n / rows_per_range))
            for r, held, n, most in ranges
            if (held > 2 * full and held - most > full) or n > rows_per_range
        }
    if count <= 1:
        ranges = [(0, total, count, total)]
    dealt, before, slots = [], 0, dict.fromkeys(range(shards), 0)
    for number, held, n, _ in ranges:
        own = min(shards - 1, int((before + held / 2) * shards / total)) if total else 0
        dealt.append({"range": number, "of_shard": own, "first_slot": slots[own]})
        before, slots[own] = before + held, slots[own] + n
    places = literal_frame(
        frame.sparkSession, dealt, range=pa.int64(), of_shard=pa.int32(), first_slot=pa.int64()
    )
    ranked = rows.withColumn("range", _range_column(splitters)).withColumn(
        "rank", F.row_number().over(Window.partitionBy("range").orderBy("hash", "serial"))
    )
    return delivered(
        ranked.join(places, "range"),
        shard=F.col("of_shard"),
        shard_range=F.col("range"),
        slot=F.col("first_slot") + F.col("rank") - 1,
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; every range is a file of its own, sorted by slot."""
    spread = sharded.repartition("shard", "shard_range").sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
