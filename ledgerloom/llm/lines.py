"""Lines that many documents share, dropped from all of them but one.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys are 128-bit hashes,
and the top of a hash names its shard. A shard is an index over its distinct hashes: a minimal perfect hash
(a cascade of bit arrays, some three bits a key) gives every hash a slot of its own in compact arrays, which
hold a fingerprint of 32 bits, the number of documents, and the document that keeps the line.

Documents are not joined to lines. A batch of documents asks every shard about all its hashes in one
message, the shard probes its arrays for many messages at once, and only the lines that go come back. A
line that very many documents hold is spread: counting takes a few documents of each batch, and a shard that
is asked much stands in several slices, each with the arrays and a part of the messages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import ROW, delivered, partitions, written

#: Code points that a key has at least, and documents that hold it, for its lines to go.
LEAST_CHARS, LEAST_DOCUMENTS = 40, 5
#: Lines of a shard, by the most that the bytes of the texts allow.
KEYS_PER_SHARD = 500_000
#: Questions to one shard from which on it is sliced, and slices that all shards may have together besides.
ASKED_PER_SLICE, MOST_SLICES = 1_000_000, 50_000
#: Entries that a shard merges, or probes, at once.
AT_ONCE = 1_000_000
#: Bits that a level of the perfect hash has for each key that is left.
SPARSENESS = 1.5
#: Levels after which a shard is given up: no two different hashes meet in so many.
MOST_LEVELS = 200

_FINGERPRINT = np.uint64(0xFFFFFFFF)
ENTRY = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<i8")])

ASK = pa.schema(
    [
        ("shard", pa.int32()),
        ("asked", pa.int64()),
        ("entries", pa.binary()),
        ("texts", pa.binary()),
        ("ordinals", pa.binary()),
    ]
)
ASK_DDL = "shard int, asked long, entries binary, texts binary, ordinals binary"
INDEX = pa.schema(
    [
        ("shard", pa.int32()),
        ("asked", pa.int64()),
        ("keys", pa.int64()),
        *[(n, pa.binary()) for n in ("levels", "bits", "fingerprints", "counts", "kept_slots", "keepers")],
    ]
)
INDEX_DDL = (
    "shard int, asked long, keys long, levels binary, bits binary, fingerprints binary, counts binary, "
    "kept_slots binary, keepers binary"
)
ANSWER = pa.schema([("key", pa.int64()), ("text_key", pa.int64()), ("ordinal", pa.int32())])
ANSWER_DDL = "key long, text_key long, ordinal int"


def line_keys(text: str | None) -> tuple[list[str], list[bytes]]:
    """The lines of a text, and their keys as UTF-8."""
    lines = (text or "").split("\n")
    return lines, [key.strip() for key in (text or "").encode().lower().split(b"\n")]


def is_long(key: bytes, least_chars: int) -> bool:
    """Whether a key has so many code points."""
    return len(key) >= least_chars and (len(key) >= 4 * least_chars or len(key.decode()) >= least_chars)


def ordinals(keys: list[bytes], least_chars: int) -> dict[bytes, int]:
    """The distinct long keys of a text, numbered in the order in which they come first."""
    found: dict[bytes, int] = {}
    for key in keys:
        if len(key) >= least_chars and key not in found and is_long(key, least_chars):
            found[key] = len(found)
    return found


# --- the perfect hash ---------------------------------------------------------------------------


def _mixed(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = high + low * np.uint64(2 * level + 1) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Distinct hashes -> 0 .. n-1, each number once.

    In every level the hashes that are left fall on a bit array; a bit that exactly one hash meets is set and
    is that hash's, the others go on to the next level. A slot is the number of bits set before the hash's.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self._starts = np.cumsum(sizes) - sizes
        counts = np.bitwise_count(bits).astype(np.int64)
        self._before = np.cumsum(counts) - counts

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        while len(high):
            if len(sizes) == MOST_LEVELS:
                raise RuntimeError("equal hashes given to a perfect hash")
            # Whole bytes, so that the levels can lie in one array.
            size = -(-max(8, int(SPARSENESS * len(high))) // 8) * 8
            places = (_mixed(high, low, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little"))
            left = ~alone[places]
            high, low = high[left], low[left]
        return cls(np.asarray(sizes, np.int64), np.concatenate(bits) if bits else np.empty(0, np.uint8))

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of every hash; -1 for one that surely was not given to build."""
        found = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, (size, start) in enumerate(zip(self.sizes, self._starts, strict=True)):
            places = (_mixed(high[left], low[left], level) % np.uint64(size)).astype(np.int64) + start
            octets, shifts = self.bits[places >> 3], (places & 7).astype(np.uint8)
            hit = (octets >> shifts) & 1 == 1
            below = octets[hit] & ((np.uint8(1) << shifts[hit]) - np.uint8(1))
            found[left[hit]] = self._before[places[hit] >> 3] + np.bitwise_count(below)
            left = left[~hit]
            if not len(left):
                break
        return found


class ShardIndex:
    """Compact arrays by slot: fingerprints, numbers of documents (up to the least that counts), keepers."""

    def __init__(self, row: dict):
        self._hash = PerfectHash(np.frombuffer(row["levels"], "<i8"), np.frombuffer(row["bits"], np.uint8))
        self._fingerprints = np.frombuffer(row["fingerprints"], "<u4")
        self._counts = np.frombuffer(row["counts"], np.uint8)
        self._kept_slots = np.frombuffer(row["kept_slots"], "<u4")
        self._keepers = np.frombuffer(row["keepers"], "<i8")

    @staticmethod
    def row(shard: int, asked: int, entries: np.ndarray, least: int) -> tuple:
        """The index row of a shard's merged entries (sorted by hash, then document downwards)."""
        first = _first_of_key(entries)
        keys, counts = entries[first], np.diff(np.append(np.flatnonzero(first), len(entries)))
        made = PerfectHash.build(keys["high"], keys["low"])
        slots = made.slots(keys["high"], keys["low"])
        fingerprints = np.empty(len(keys), "<u4")
        fingerprints[slots] = keys["low"] & _FINGERPRINT
        by_slot = np.empty(len(keys), np.uint8)
        by_slot[slots] = np.minimum(counts, least)
        shared = np.flatnonzero(counts >= least)
        shared = shared[np.argsort(slots[shared])]
        arrays = (
            made.sizes.astype("<i8"),
            made.bits,
            fingerprints,
            by_slot,
            slots[shared].astype("<u4"),
            keys["doc"][shared].astype("<i8"),
        )
        return (shard, asked, len(keys), *[a.tobytes() for a in arrays])

    def goes(self, entries: np.ndarray, least: int) -> np.ndarray:
        """Whether the line goes from the document, for every entry."""
        slots = self._hash.slots(entries["high"], entries["low"])
        if (slots < 0).any() or (self._fingerprints[slots] != entries["low"] & _FINGERPRINT).any():
            raise RuntimeError("a line is asked for that was not counted: the documents have changed")
        goes = self._counts[slots] >= least
        keeper = self._keepers[np.searchsorted(self._kept_slots, slots[goes])]
        goes[goes] = keeper != entries["doc"][goes]
        return goes


def _first_of_key(entries: np.ndarray) -> np.ndarray:
    new = (entries["high"][1:] != entries["high"][:-1]) | (entries["low"][1:] != entries["low"][:-1])
    return np.append(np.ones(min(len(entries), 1), bool), new)


def merged(entries: np.ndarray, least: int) -> np.ndarray:
    """The `least` largest documents of every hash, sorted by hash and document downwards.

    That is enough to tell a hash of `least` documents, and the largest, and it can be merged again.
    """
    entries = entries[np.lexsort((~entries["doc"], entries["low"], entries["high"]))]
    first = _first_of_key(entries)
    entries = entries[first | np.append(np.ones(min(len(entries), 1), bool), np.diff(entries["doc"]) != 0)]
    first = np.flatnonzero(_first_of_key(entries))
    place = np.arange(len(entries)) - np.repeat(first, np.diff(np.append(first, len(entries))))
    return entries[place < least]


# --- documents ask, shards answer -----------------------------------------------------------------


def _asking(shards: int, least_chars: int, least: int, counting: bool) -> Callable:
    """Messages of a batch of documents, one for each shard. Counting needs a few documents of a hash only."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, numbers = [], [], []
            for text in batch.column(1):
                own = ordinals(line_keys(text.as_py())[1], least_chars)
                digests.extend(map(xxhash.xxh3_128_digest, own))
                sizes.append(len(own))
                numbers.append(np.arange(len(own), dtype="<i4"))
            if not digests:
                continue
            hashes = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
            entries = np.empty(len(hashes), ENTRY)
            entries["high"], entries["low"] = hashes[:, 0], hashes[:, 1]
            entries["doc"] = np.repeat(batch.column(0).to_numpy(), sizes)
            places = _shards_of(entries, shards)
            if counting:
                asked_of = np.bincount(places, minlength=shards)
                entries = merged(entries, least)
                texts = numbers = None
                places = _shards_of(entries, shards)
            else:
                texts = np.repeat(batch.column(2).to_numpy(), sizes)
                numbers = np.concatenate(numbers)
            order = np.argsort(places, kind="stable")
            entries, places = entries[order], places[order]
            cuts = np.append(np.flatnonzero(np.diff(places, prepend=-1)), len(places))
            rows = []
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                shard, own = int(places[begin]), order[begin:end]
                rows.append(
                    (
                        shard,
                        int(asked_of[shard]) if counting else end - begin,
                        entries[begin:end].tobytes(),
                        None if counting else texts[own].tobytes(),
                        None if counting else numbers[own].tobytes(),
                    )
                )
            yield _batch(rows, ASK)

    return asked


def _shards_of(entries: np.ndarray, shards: int) -> np.ndarray:
    return ((entries["high"] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _indexing(least: int) -> Callable:
    """Sorted messages to index rows: entries are merged as they come, so a shard holds a bounded state."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, asked, held, waiting, n_waiting = None, 0, np.empty(0, ENTRY), [], 0
        for batch in batches:
            for own, count, data in zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True):
                if own != shard:
                    if shard is not None:
                        entries = merged(np.concatenate([held, *waiting]), least)
                        yield _batch([ShardIndex.row(shard, asked, entries, least)], INDEX)
                    shard, asked, held, waiting, n_waiting = own, 0, np.empty(0, ENTRY), [], 0
                entries = np.frombuffer(data, ENTRY)
                waiting.append(entries)
                asked, n_waiting = asked + count, n_waiting + len(entries)
                if n_waiting > max(AT_ONCE, len(held)):
                    held, waiting, n_waiting = merged(np.concatenate([held, *waiting]), least), [], 0
        if shard is not None:
            entries = merged(np.concatenate([held, *waiting]), least)
            yield _batch([ShardIndex.row(shard, asked, entries, least)], INDEX)

    return indexed


def _answering(least: int) -> Callable:
    """Per slice of a shard: its index row, then the messages; out come the lines that go."""

    def answers(index: ShardIndex, waiting: list[tuple]) -> pa.RecordBatch:
        entries, texts, numbers = (np.concatenate(part) for part in zip(*waiting, strict=True))
        goes = index.goes(entries, least)
        columns = (entries["doc"][goes], texts[goes], numbers[goes])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c), f.type) for c, f in zip(columns, ANSWER, strict=True)],
            schema=ANSWER,
        )

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, waiting, n_waiting = None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["bits"] is not None:
                    if waiting:
                        yield answers(index, waiting)
                    index, waiting, n_waiting = ShardIndex(row), [], 0
                    continue
                waiting.append(
                    (
                        np.frombuffer(row["entries"], ENTRY),
                        np.frombuffer(row["texts"], "<i8"),
                        np.frombuffer(row["ordinals"], "<i4"),
                    )
                )
                n_waiting += len(waiting[-1][0])
                if n_waiting > AT_ONCE:
                    yield answers(index, waiting)
                    waiting, n_waiting = [], 0
        if waiting:
            yield answers(index, waiting)

    return answered


def _dropping(place: int, least_chars: int) -> Callable:
    """Texts without the lines whose ordinals are named."""

    def dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            totals, losses, texts = [], [], []
            for text, named in zip(rows.field(place), batch.column(1), strict=True):
                text, gone = text.as_py(), named.as_py()
                if not gone:
                    text = text or ""
                    totals.append(text.count("\n") + 1)
                    losses.append(0)
                    texts.append(text)
                    continue
                lines, keys = line_keys(text)
                gone, known = set(gone), ordinals(keys, least_chars)
                kept = [
                    line for line, key in zip(lines, keys, strict=True) if known.get(key, -1) not in gone
                ]
                totals.append(len(lines))
                losses.append(len(lines) - len(kept))
                texts.append("\n".join(kept))
            arrays = [rows, pa.array(totals, pa.int64()), pa.array(losses, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [ROW, "n_lines", "n_dropped", "kept_text"])

    return dropped


def drop_repeated_lines(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
    keys_per_shard: int = KEYS_PER_SHARD,
    asked_per_slice: int = ASKED_PER_SLICE,
) -> DataFrame:
    """All columns, with n_lines (before dropping), n_dropped and kept_text.

    A line goes if its key has `least_chars` code points or more and `least_documents` or more documents hold
    it, unless its document is the one of them with the largest key column. Texts are cut at line ends; a null
    or empty text is one empty line. Rows of one key column are one document: they count once and all keep
    their lines, or none does. A row without a key column counts for no document and loses no line. An empty
    table gives no rows; columns named like the added ones are replaced by them. The input must be the same
    whenever it is read; a line that was not counted is an error.
    """
    if not 1 <= least_documents <= 255:
        raise ValueError("least_documents must be from 1 to 255")
    spark = frame.sparkSession
    named = {name.lower(): name for name in frame.columns}
    place = frame.columns.index(named[text.lower()])
    rows = frame.select(
        F.struct(
            *[
                F.col(f"`{n}`").cast("string").alias(n) if i == place else F.col(f"`{n}`")
                for i, n in enumerate(frame.columns)
            ]
        ).alias(ROW),
        F.col(f"`{key}`").cast("long").alias("key"),
        F.col(f"`{text}`").cast("string").alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    documents = rows.filter(F.col("key").isNotNull()).select("key", "text", "text_key")

    # A long key has `least_chars` bytes at least, and a line end but for a text's last line.
    most = documents.agg(F.sum(F.ceil((F.octet_length("text") + 1) / (least_chars + 1)))).first()[0]
    shards = partitions(spark, most, keys_per_shard)
    counting = documents.select("key", "text").mapInArrow(
        _asking(shards, least_chars, least_documents, counting=True), ASK_DDL
    )
    index = written(
        counting.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard")
        .select("shard", "asked", "entries")
        .mapInArrow(_indexing(least_documents), INDEX_DDL),
        "line-index",
    )

    # All slices besides the first of each shard together are MOST_SLICES at most.
    asked = index.agg(F.sum("asked")).first()[0] or 0
    each = max(asked_per_slice, asked // MOST_SLICES + 1)
    slices = F.ceil(F.col("asked") / each).cast("int")
    sliced = index.filter(F.col("asked") > each).select("shard", slices.alias("slices"))
    messages = documents.mapInArrow(
        _asking(shards, least_chars, least_documents, counting=False), ASK_DDL
    ).join(F.broadcast(sliced), "shard", "left")
    spread = F.pmod(F.xxhash64("entries", "texts"), F.coalesce("slices", F.lit(1))).cast("int")
    standing = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1)))
    meeting = messages.withColumn("slice", spread).drop("slices", "asked").unionByName(
        standing.drop("asked", "keys"), allowMissingColumns=True
    )
    # The slices of a shard lie far from each other.
    target = F.pmod(F.col("shard") + F.xxhash64("slice") * F.sign("slice").cast("long"), F.lit(shards))
    gone = (
        meeting.repartitionById(shards, target.cast("int"))
        .sortWithinPartitions("shard", "slice", F.col("bits").isNull())
        .mapInArrow(_answering(least_documents), ANSWER_DDL)
        .groupBy("key", "text_key")
        .agg(F.collect_set("ordinal").alias("gone"))
    )
    judged = rows.drop("text").join(gone, ["key", "text_key"], "left").select(ROW, "gone")
    schema = T.StructType(
        [
            judged.schema[ROW],
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    left = judged.mapInArrow(_dropping(place, least_chars), schema)
    return delivered(left, **{n: F.col(n) for n in ("n_lines", "n_dropped", "kept_text")})
