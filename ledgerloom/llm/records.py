"""Token ids as length-delimited binary records, with a separate offset index.

Frame of a record (all numbers little-endian):

    payload length      unsigned 64-bit
    masked checksum     unsigned 32-bit, of the eight length bytes
    payload             key (signed 64-bit), flags (1: the key is null), width of an id (2 or 4 bytes),
                        number of ids (unsigned 32-bit), ids
    masked checksum     unsigned 32-bit, of the payload
    line end            one byte, 0x0A

A checksum is CRC-32, rotated right by 15 bits and raised by a constant, so that a checksum of bytes
that hold checksums stays telling. Spark writes the files with its own text writer, whose lines may hold
any bytes, and reads them with its binary-file reader: both go to any store that Spark knows, and a
failed task leaves nothing behind. Files hold consecutive ranges of keys, in the order of their part
numbers. The index is a Parquet table of file, place and size of every record.

Ranges of keys even out rows, not characters, so a task goes on in a further file when one is full: it
hands its records to the writer as one value per file, and the writer begins a file with each value.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import partitions
from ledgerloom.llm.tokens import BATCH_TEXTS, END_ID, encoder, tokenizer_path

# Fixed values of the record format.
MASK_DELTA = 0xA282EAD8
LENGTH = struct.Struct("<Q")
CHECKSUM = struct.Struct("<I")
PAYLOAD_HEAD = struct.Struct("<qBBI")
LINE_END = b"\n"

#: Characters of text, and bytes of records, that a file has at most, unless it holds a single record. A file
#: must be read whole, so this bounds a task's memory.
CHARS_PER_FILE = 32_000_000
#: Characters that a record counts besides its text, for its frame.
FRAME_CHARS = 32
#: Characters of texts that are encoded at once, unless one text has more.
BATCH_CHARS = 4_000_000
#: More files than Spark's writer lets one task begin; a file's number is its task's times this, and its own.
FILES_PER_TASK = 1_000_001

RECORD_DDL = "part long, record int, first_token long, key long, ids binary"
INDEX_DDL = "part long, record int, offset long, size long, key long, n_tokens long, first_token long"


class RecordError(ValueError):
    """A record file is cut short or damaged."""


def masked(data: bytes) -> int:
    checksum = zlib.crc32(data)
    return (((checksum >> 15) | (checksum << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame_record(key: int | None, ids: bytes) -> bytes:
    """One frame; `ids` are unsigned 32-bit, stored in two bytes each where all of them fit."""
    values = np.frombuffer(ids, "<u4")
    width = 2 if not len(values) or int(values.max()) < 1 << 16 else 4
    body = values.astype("<u2").tobytes() if width == 2 else ids
    payload = PAYLOAD_HEAD.pack(key or 0, key is None, width, len(values)) + body
    length = LENGTH.pack(len(payload))
    return b"".join(
        (length, CHECKSUM.pack(masked(length)), payload, CHECKSUM.pack(masked(payload)), LINE_END)
    )


def read_record(data: memoryview, offset: int) -> tuple[int | None, np.ndarray, int]:
    """(key, ids, offset of the next frame), both checksums verified."""
    start = offset + LENGTH.size + CHECKSUM.size
    if start > len(data):
        raise RecordError(f"frame at {offset}: cut short")
    length_bytes = data[offset : offset + LENGTH.size]
    (length,) = LENGTH.unpack(length_bytes)
    if CHECKSUM.unpack(data[start - CHECKSUM.size : start])[0] != masked(length_bytes):
        raise RecordError(f"frame at {offset}: wrong length checksum")
    end = start + length + CHECKSUM.size
    if end + len(LINE_END) > len(data):
        raise RecordError(f"frame at {offset}: cut short")
    payload = data[start : start + length]
    if CHECKSUM.unpack(data[start + length : end])[0] != masked(payload):
        raise RecordError(f"frame at {offset}: wrong payload checksum")
    key, is_null, width, count = PAYLOAD_HEAD.unpack(payload[: PAYLOAD_HEAD.size])
    ids = np.frombuffer(payload[PAYLOAD_HEAD.size :], f"<u{width}")
    if len(ids) != count:
        raise RecordError(f"frame at {offset}: {len(ids)} ids, {count} declared")
    return (None if is_null else key), ids, end + len(LINE_END)


def write_records(
    frame: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    chars_per_file: int = CHARS_PER_FILE,
) -> None:
    """Encode every text and write it, with `end_id` appended, in ascending order of key.

    Null keys come first and stay null; null text counts as empty and holds the end id alone; repeated
    rows are written each for itself, rows of one key in the order of their texts' hashes. An empty table
    gives no record. Other columns take no part. A text of any length is one record. No file has more than
    `chars_per_file` characters of text or bytes, but for a single record that alone has more.
    """
    spark = frame.sparkSession
    tokens = tokenizer or tokenizer_path()
    rows = frame.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text")
    )
    chars = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + FRAME_CHARS)).first()[0]
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(
        partitions(spark, chars, chars_per_file), F.asc_nulls_first("key"), tie
    ).sortWithinPartitions(F.asc_nulls_first("key"), tie)
    end = np.asarray([end_id], "<u4").tobytes()

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokens).encode_batch
        held: list[bytes] = []
        held_chars = held_bytes = 0
        for batch in batches:
            for keys, texts in _encoded_at_once(batch):
                for key, text, ids in zip(keys, texts, encode(texts), strict=True):
                    record, chars = frame_record(key, ids + end), len(text or "") + FRAME_CHARS
                    if held and max(held_chars + chars, held_bytes + len(record)) > chars_per_file:
                        yield _file_content(held)
                        held, held_chars, held_bytes = [], 0, 0
                    held.append(record)
                    held_chars, held_bytes = held_chars + chars, held_bytes + len(record)
        if held:
            yield _file_content(held)

    lines = ordered.mapInArrow(framed, "line binary").select(F.col("line").cast("string"))
    writer = lines.write.option("compression", "none").option("lineSep", "\n")
    writer.option("maxRecordsPerFile", 1).text(f"{path}/data")
    files = _files(spark, path)
    files.mapInArrow(_indexed, INDEX_DDL).write.parquet(f"{path}/index")


def _encoded_at_once(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Keys and texts of a batch, a bounded number of texts and of characters at once."""
    begin, chars = 0, 0
    for end, length in enumerate(pc.utf8_length(batch.column(1)).to_pylist()):
        if end > begin and (end - begin >= BATCH_TEXTS or chars + (length or 0) > BATCH_CHARS):
            yield tuple(c.slice(begin, end - begin).to_pylist() for c in batch.columns)
            begin, chars = end, 0
        chars += length or 0
    if begin < batch.num_rows:
        yield tuple(c.slice(begin).to_pylist() for c in batch.columns)


def _file_content(records: list[bytes]) -> pa.RecordBatch:
    # The text writer adds the last line end itself.
    return pa.RecordBatch.from_arrays([pa.array([b"".join(records)[:-1]], pa.binary())], ["line"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    task, file = (F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", n).cast("long") for n in (1, 2))
    part = (task * FILES_PER_TASK + file).alias("part")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    return found.select(part, "content")


def _heads(data: memoryview) -> Iterator[tuple[int, int, int, int | None, int, int]]:
    """(record, offset, size, key, number of ids, ids before it) of every frame, payloads left unread."""
    record = offset = first = 0
    around = LENGTH.size + 2 * CHECKSUM.size + len(LINE_END)
    while offset < len(data):
        start = offset + LENGTH.size + CHECKSUM.size
        if start + PAYLOAD_HEAD.size > len(data):
            raise RecordError(f"frame at {offset}: cut short")
        length_bytes = data[offset : offset + LENGTH.size]
        if CHECKSUM.unpack(data[offset + LENGTH.size : start])[0] != masked(length_bytes):
            raise RecordError(f"frame at {offset}: wrong length checksum")
        size = LENGTH.unpack(length_bytes)[0] + around
        if offset + size > len(data):
            raise RecordError(f"frame at {offset}: cut short")
        key, is_null, _, count = PAYLOAD_HEAD.unpack(data[start : start + PAYLOAD_HEAD.size])
        yield record, offset, size, None if is_null else key, count, first
        record, offset, first = record + 1, offset + size, first + count


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield _batch([(part, *head) for head in _heads(memoryview(content.as_buffer()))], INDEX)


INDEX = pa.schema(
    [
        ("part", pa.int64()),
        ("record", pa.int32()),
        ("offset", pa.int64()),
        ("size", pa.int64()),
        ("key", pa.int64()),
        ("n_tokens", pa.int64()),
        ("first_token", pa.int64()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """part, record, offset, size, key, n_tokens, first_token (ids before it in its file)."""
    return spark.read.schema(INDEX_DDL).parquet(f"{path}/index")


def token_starts(index: DataFrame) -> DataFrame:
    """part, tokens_before: ids in all earlier files; one row per file."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    # One row per file of the data set: metadata, not data.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"))


def read_records(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """part, record, first_token, key, ids (little-endian unsigned 32-bit) of the wanted index rows, or of all.

    All records are read file by file, where they lie, and every checksum is verified. Any subset of the index may be asked for instead:
    then each file is opened once and only the wanted frames in it are parsed, at the places the index
    names.
    """
    if wanted is None:
        return _files(spark, path).mapInArrow(_walked, RECORD_DDL)
    # A file holds a bounded amount of text, so its list of places is bounded too.
    places = wanted.groupBy("part").agg(F.collect_list(F.struct("offset", "record", "first_token")).alias("places"))
    return _files(spark, path).join(places, "part").mapInArrow(_picked, RECORD_DDL)


RECORDS = pa.schema(
    [
        ("part", pa.int64()),
        ("record", pa.int32()),
        ("first_token", pa.int64()),
        ("key", pa.int64()),
        ("ids", pa.binary()),
    ]
)
#: Bytes of ids after which a batch is handed on.
BATCH_BYTES = 8_000_000


def _parsed(
    part: int, data: memoryview, places: Iterator[tuple[int, int, int]]
) -> Iterator[pa.RecordBatch]:
    """The frames at (record, offset, first token) of one file, in batches of a bounded number of ids."""
    rows, held = [], 0
    for record, offset, first in places:
        key, ids, _ = read_record(data, offset)
        rows.append((part, record, first, key, ids.astype("<u4").tobytes()))
        held += len(rows[-1][-1])
        if held >= BATCH_BYTES:
            yield _batch(rows, RECORDS)
            rows, held = [], 0
    if rows:
        yield _batch(rows, RECORDS)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = memoryview(content.as_buffer())
            yield from _parsed(part, data, ((record, at, first) for record, at, *_, first in _heads(data)))


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, contents, places = (batch.column(n) for n in ("part", "content", "places"))
        for part, content, wanted in zip(parts.to_pylist(), contents, places, strict=True):
            found = sorted((p["offset"], p["record"], p["first_token"]) for p in wanted.as_py())
            places_of = ((record, offset, first) for offset, record, first in found)
            yield from _parsed(part, memoryview(content.as_buffer()), places_of)
