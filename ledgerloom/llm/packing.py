"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing: every partition packs its own pieces by best fit, longest first. Bins
that are nearly full are final. The others are items of the next round: they meet in groups of up to
`GROUP_BINS`, are packed by best fit again, and so on, until one group is left or a round merges
(almost) nothing more. Groups are drawn by hash, so each sees the same mix of lengths, and their size is
bounded whatever the input. No round drops a bin: what cannot be merged is emitted as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import give_back, written
from ledgerloom.llm.tokens import BATCH_TEXTS, END_ID, encoder, tokenizer_path

CAPACITY = 4096
#: A bin with at most this much room left is final.
NEARLY_FULL = 8
#: Bins that meet in one group of a merge round.
GROUP_BINS = 32_768
#: Pieces that are packed together in a partition before its memory is freed.
LOCAL_PIECES = 262_144
#: A round that leaves more than this share of its bins unmerged is the last.
WORTHWHILE = 0.98

PIECE = pa.struct(
    [
        ("key", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
        ("offset", pa.int64()),
    ]
)
BINS = pa.schema([("sequence_id", pa.int64()), ("fill", pa.int64()), ("pieces", pa.list_(PIECE))])
BINS_DDL = (
    "sequence_id long, fill long, pieces array<struct<key: long, piece: int, start: long, "
    "length: long, ids_crc32: long, ids: binary, offset: long>>"
)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of every item: longest first, each into the fullest bin it fits in.

    Bins are kept by their room; a bit set of the rooms in use finds the tightest one.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, opened = 0, np.empty(len(lengths), np.int64), 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, opened = capacity, opened, opened + 1
        bins[item] = chosen
        left = room - length
        if left:
            by_room[left].append(chosen)
            rooms |= 1 << left
    return bins


def _grouped(lengths: np.ndarray, bins: np.ndarray) -> tuple:
    """Items in order of their bins; of each bin its first item, size and fill; places within bins."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.flatnonzero(np.diff(bins[order], prepend=-1))
    before = ends[first] - lengths[order][first]
    counts = np.diff(np.append(first, len(order)))
    places = ends - lengths[order] - np.repeat(before, counts)
    fills = np.append(before[1:], ends[-1:]) - before
    return order, first, counts, places, fills


def _bins(ids: np.ndarray, fills: np.ndarray, pieces: pa.StructArray, ends: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pieces)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(fills), lists], schema=BINS)


def _local(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode_batch
    end = np.asarray([end_id], "<u4").tobytes()
    serial = TaskContext.get().partitionId() << 36
    columns: list[list] = [[], [], [], [], [], []]

    def packed() -> pa.RecordBatch:
        nonlocal serial
        lengths = np.asarray(columns[3], np.int64)
        order, first, counts, places, fills = _grouped(lengths, best_fit(lengths, capacity))
        arrays = [pa.array(c, f.type).take(order) for c, f in zip(columns, PIECE, strict=False)]
        pieces = pa.StructArray.from_arrays([*arrays, pa.array(places)], fields=list(PIECE))
        ids = serial + np.arange(len(first))
        serial += len(first)
        for column in columns:
            column.clear()
        return _bins(ids, fills, pieces, np.append(first[1:], len(order)))

    for batch in batches:
        keys = batch.column(0).to_pylist()
        for begin in range(0, len(keys), BATCH_TEXTS):
            texts = batch.column(1).slice(begin, BATCH_TEXTS).to_pylist()
            for key, ids in zip(keys[begin : begin + BATCH_TEXTS], encode(texts), strict=True):
                encoded = ids + end
                for piece, start in enumerate(range(0, len(encoded) // 4, capacity)):
                    part = encoded[start * 4 : (start + capacity) * 4]
                    row = (key, piece, start, len(part) // 4, zlib.crc32(part), part if with_ids else None)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            if len(columns[0]) >= LOCAL_PIECES:
                yield packed()
    if columns[0]:
        yield packed()
    give_back()


def _merged(group: pa.Table, capacity: int) -> pa.Table:
    """One group of open bins, packed as items; a bin takes the id of its longest item."""
    group = group.combine_chunks().sort_by([("fill", "descending"), ("sequence_id", "ascending")])
    ids, fills = group["sequence_id"].to_numpy(), group["fill"].to_numpy()
    lists = group["pieces"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    order, first, _, places, new_fills = _grouped(fills, best_fit(fills, capacity))
    lists = lists.take(pa.array(order))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    moved = flat.field("offset").to_numpy() + np.repeat(places, sizes)
    fields = [flat.field(field.name) for field in PIECE][:-1]
    pieces = pa.StructArray.from_arrays([*fields, pa.array(moved)], fields=list(PIECE))
    ends = np.append(np.cumsum(sizes)[first[1:] - 1], len(flat))
    return pa.Table.from_batches([_bins(ids[order][first], new_fills, pieces, ends)])


def pack(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    group_bins: int = GROUP_BINS,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, ids, sequence_id, offset.

    A document is its ids followed by `end_id`; only documents longer than `capacity` are cut, at its
    multiples. `ids` (little-endian unsigned 32-bit) is null unless asked for. Null text counts as empty
    and still has its end id; a null key is kept; repeated rows are packed each for itself; an empty table
    gives no rows. Other columns of the input take no part, whatever their names. A very long text gives
    many full pieces and at most one shorter one.
    """
    path = tokenizer or tokenizer_path()
    documents = frame.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string"))
    level = written(
        documents.mapInArrow(lambda b: _local(b, path, end_id, capacity, with_ids), BINS_DDL), "bins"
    )
    is_open = F.col("fill") < capacity - NEARLY_FULL
    finished, open_bins = level.filter(~is_open), level.filter(is_open)
    waiting = open_bins.count()
    for seed in range(64):
        if waiting < 2:
            break
        groups = ceil(waiting / group_bins)
        by_hash = F.pmod(F.xxhash64(F.lit(seed), "sequence_id"), F.lit(groups)).alias("meets_in")
        merged = open_bins.groupBy(by_hash).applyInArrow(lambda g: _merged(g, capacity), BINS_DDL)
        level = written(merged, "bins")
        finished, open_bins = finished.unionByName(level.filter(~is_open)), level.filter(is_open)
        left = open_bins.count()
        if groups == 1 or left > WORTHWHILE * waiting:
            break
        waiting = left
    every = finished.unionByName(open_bins)
    return every.select("sequence_id", F.inline("pieces")).select(
        F.col("key").alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        "ids",
        "sequence_id",
        "offset",
    )
