"""Order-insensitive content digest of a whole table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import canonical_escapes, holds_text, ordered_json, sha256_hex

# Fixed values of the digest: 60 of the 64 hex digits, as 12 lanes of 20 bits, 5 digits each.
HASH_DIGITS, LANE_DIGITS = 64, 5
LANES = [f"lane{place}" for place in range(HASH_DIGITS // LANE_DIGITS)]

#: The value of a hex digit by its character.
_DIGITS = np.array([int(chr(c), 16) if chr(c) in "0123456789abcdef" else 0 for c in range(128)], dtype=np.uint8)


def _group_numbers(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    """A number per row that equal values of the first columns share, nulls among them."""
    numbers = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns[:columns]:
        encoded = column.dictionary_encode(null_encoding="encode")
        own = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        numbers = np.unique(numbers * len(encoded.dictionary) + own, return_inverse=True)[1]
    return numbers


def _lane_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and lane sums of each group in a batch; the last column is the hash, those before name the group.

    Sums of digits are taken by place first: a lane's sum follows from them.
    """
    weights = 16 ** np.arange(LANE_DIGITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.num_columns - 1
        hashes = batch.column(keys).cast(pa.binary(), safe=False)
        start = hashes.offset * HASH_DIGITS
        characters = np.frombuffer(hashes.buffers()[2], dtype=np.uint8)
        digits = _DIGITS[characters[start : start + len(hashes) * HASH_DIGITS].reshape(-1, HASH_DIGITS)]
        numbers = _group_numbers(batch, keys)
        _, first = np.unique(numbers, return_index=True)
        members = [digits] if len(first) == 1 else [digits[numbers == numbers[row]] for row in first]
        places = np.array([rows.sum(axis=0, dtype=np.int64) for rows in members])
        used = places[:, : len(LANES) * LANE_DIGITS].reshape(len(first), len(LANES), LANE_DIGITS)
        sums = [pa.array([len(rows) for rows in members], pa.int64())]
        sums += [pa.array(lane, pa.int64()) for lane in (used @ weights).T]
        groups = batch.take(pa.array(first)).columns[:keys]
        yield pa.RecordBatch.from_arrays([*groups, *sums], names=[*batch.schema.names[:keys], "rows", *LANES])


def table_fingerprint(
    frame: DataFrame, *, by: Sequence[str] = (), escape: bool = True
) -> DataFrame:
    """(rows, fingerprint) of the whole table, or of each group of `by`; copies count.

    Each row's sha256 is cut into 20-bit lanes and the lanes are summed over all rows, by batch and
    then by task: nothing is shuffled but one partial row per task and group, and identical rows,
    however many, cannot pile up anywhere. A lane holds 2**43 rows before a bigint overflows
    (which fails, as arithmetic is checked). It shows any accidental difference; proof against a
    forger who picks the rows is left to the sha256 of each file.
    """
    # One projection per step: the text is looked through for escapes, but made once.
    hashed_columns = [name for name in frame.columns if name not in by]
    text = frame.select(*by, ordered_json(frame, hashed_columns, escape=escape).alias("text"))
    if escape and holds_text(frame, hashed_columns):
        text = text.select(*by, canonical_escapes(F.col("text")).alias("text"))
    hashed = text.select(*by, sha256_hex(F.col("text")).alias("h"))
    kinds = [*hashed.schema.fields[:-1], *[T.StructField(name, T.LongType()) for name in ("rows", *LANES)]]
    summed = hashed.mapInArrow(_lane_sums, T.StructType(kinds))
    digest = F.sha2(
        F.concat_ws(":", *[F.coalesce(F.sum(name), F.lit(0).cast("bigint")) for name in ("rows", *LANES)]), 256
    )
    return summed.groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("rows"), digest.alias("fingerprint")
    )


def table_fingerprints(tables: dict[str, DataFrame], *, escape: bool = True) -> DataFrame:
    """(table_name, rows, fingerprint), one row per table."""
    return reduce(
        DataFrame.unionByName,
        [
            table_fingerprint(frame, escape=escape).select(
                F.lit(name).alias("table_name"), "rows", "fingerprint"
            )
            for name, frame in tables.items()
        ],
    )
