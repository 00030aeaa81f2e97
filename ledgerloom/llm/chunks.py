"""Document fingerprints from content-defined chunks.

A gear hash over the UTF-8 bytes marks possible boundaries. Chunking is normalised: below the usual size
a boundary must match a stricter mask, above it a looser one, so sizes gather around the usual one. A
boundary depends on the bytes right before it alone; an edit shifts the text behind it without
changing the chunks there. A fingerprint is the set of a text's chunk digests, each weighted by its length.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import partitions

#: Bytes of a chunk: least, usual, most.
LEAST, USUAL, MOST = 16, 48, 256
#: The strict mask has two bits more than the loose one.
LOOSE = np.uint32(0b1111 << 28)
STRICT = np.uint32(0b111111 << 26)
#: Characters of text that one task compares.
CHARS_PER_TASK = 32_000_000

#: A seeded random number for every byte.
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hash(data: bytes) -> np.ndarray:
    """h[i] = 2 * h[i - 1] + GEAR[data[i]] modulo 2**32, for all i at once.

    A byte has left the hash after 32 steps; five doublings of the window sum it up.
    """
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        if step >= len(h):
            break
        wider = h.copy()
        wider[step:] += h[:-step] << np.uint32(step)
        h = wider
    return h


def boundaries(data: bytes) -> list[int]:
    """End of every chunk."""
    if not data:
        return []
    h = gear_hash(data)
    loose = np.flatnonzero((h & LOOSE) == 0)
    strict = (loose[(h[loose] & STRICT) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    ends, start, size = [], 0, len(data)
    while size - start > LEAST:
        usual, most = min(start + USUAL, size), min(start + MOST, size)
        at = bisect_left(strict, start + LEAST)
        end = strict[at] if at < len(strict) and strict[at] < usual else 0
        if not end:
            at = bisect_left(loose, usual)
            end = loose[at] if at < len(loose) and loose[at] < most else most
        ends.append(end)
        start = end
    if start < size:
        ends.append(size)
    return ends


def fingerprint(text: str | None) -> dict[int, int]:
    """digest -> bytes of the distinct chunks; none for null or empty text."""
    data = (text or "").encode()
    found, start = {}, 0
    for end in boundaries(data):
        found[xxhash.xxh3_64_intdigest(data[start:end])] = end - start
        start = end
    return found


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """Bytes of the distinct chunks that the other has too, as a share; two empty ones are alike."""
    if not own:
        return 0.0 if other else 1.0
    shared = sum(size for digest, size in own.items() if digest in other)
    return shared / sum(own.values())


def encoded(found: dict[int, int]) -> str:
    """A fingerprint as text: 16 hex digits and the length of every chunk, sorted."""
    return " ".join(f"{digest:016x}:{size}" for digest, size in sorted(found.items()))


def fingerprint_column(text: Column) -> Column:
    """The fingerprint of each text as a string; null text counts as empty."""

    @F.pandas_udf("string")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([encoded(fingerprint(t)) for t in texts])

    return fingerprints(text)


EDITED_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
EDITED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the following text, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Rows of an output batch.
BATCH_ROWS = 500


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each own row against the row after it; a row that is only looked at (not own) gives none."""
    previous, rows = None, []
    for batch in batches:
        keys, own, texts = batch.column("key").to_pylist(), batch.column("own"), batch.column("text")
        for key, mine, value in zip(keys, own.to_pylist(), texts, strict=True):
            text = value.as_py() or ""
            found = fingerprint(text)
            if previous and previous[1]:
                rows.append(_row(previous, text, found))
            previous = (key, mine, text, found)
            if len(rows) >= BATCH_ROWS:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _row(previous: tuple, following: str, following_found: dict[int, int]) -> tuple:
    key, _, text, found = previous
    edited = edit(text, following)
    edited_found = fingerprint(edited)
    return (
        key,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        encoded(found),
        encoded(edited_found),
        containment(found, edited_found),
        containment(found, following_found),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, EDITED, strict=True)], schema=EDITED
    )


def compare_with_next(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    chars_per_task: int = CHARS_PER_TASK,
) -> DataFrame:
    """Fingerprint each text, its edited form and the next one by key, and measure containment.

    The next document follows in ascending order of key, null keys first, rows of one key in the order of
    their texts; after the last comes the first. Texts move once: ranges of keys begin at keys of the
    table itself, so the first row of each range is known and is also sent to the range before it. Null
    text counts as empty, and an empty text's edited form is empty; a table of one row is followed by
    itself; an empty table gives no rows; repeated rows follow one another; other columns take no part.
    Rows of one key go to one task: the key is expected to be (nearly) unique.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text")
    )
    chars, first, nulls = rows.agg(
        F.sum(F.length("text")), F.min("key"), F.count_if(F.col("key").isNull())
    ).first()
    count = partitions(spark, chars, chars_per_task)
    shares = [n / count for n in range(1, count)]
    cuts = rows.agg(F.percentile_approx("key", shares or [0.5], 100_000)).first()[0] or []
    starts = sorted({cut for cut in cuts if cut > first}) if shares else []
    # Range n holds keys from starts[n - 1] on; null keys come first, so they are in range 0.
    searched = np.asarray(starts, np.int64)

    @F.pandas_udf("array<int>")
    def ranges(keys: pd.Series, is_null: pd.Series) -> pd.Series:
        values = keys.to_numpy(np.int64)
        own = np.searchsorted(searched, values, "right")
        found = [[int(n)] for n in own]
        begins = np.zeros(len(values), bool)
        if len(searched):
            begins = (own > 0) & (searched[np.maximum(own, 1) - 1] == values)
        for row in np.flatnonzero(begins):
            found[row].append(int(own[row]) - 1)
        for row in np.flatnonzero(is_null.to_numpy() if nulls else values == first):
            found[row].append(-1)
        return pd.Series(found)

    last = len(starts)
    own_ranges = ranges(F.coalesce("key", F.lit(-(1 << 63))), F.col("key").isNull())
    sent = rows.select("key", "text", F.posexplode(own_ranges).alias("copy", "range")).select(
        "key",
        "text",
        (F.col("copy") == 0).alias("own"),
        F.when(F.col("range") < 0, F.lit(last)).otherwise(F.col("range")).alias("range"),
        # A row that is looked at comes after all rows of the range, also where it wraps around.
        (F.col("copy") > 0).alias("looked_at"),
    )
    return (
        sent.repartitionById(last + 1, "range")
        .sortWithinPartitions("looked_at", F.asc_nulls_first("key"), "text")
        .mapInArrow(_compared, EDITED_DDL)
    )
