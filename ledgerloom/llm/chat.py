"""Chat formatting by columnar byte assembly.

A turn becomes `<s>[INST]role[/INST]text</s>`. Roles and texts that hold one of these four control strings
are escaped: a backslash goes in after the string's first character, and every backslash is doubled, so a
control string in the output always is the template's. Batches of sorted turns are assembled without a
loop over rows: numpy computes the lengths of all segments, their cumulative offsets and the place of
every byte, and headers and contents are scattered into one buffer allocated beforehand, which becomes an
Arrow string column as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
TURN, ROLE_END, TEXT_END = "<s>[INST]", "[/INST]", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
ESCAPE = "\\"
LOSS_ROLE = "assistant"

#: Bytes of turns that are assembled at once, and after which a conversation continues in a further row.
BATCH_BYTES = 8_000_000
#: A segment longer than this is copied as a slice instead of byte by byte.
SLICE_BYTES = 65_536

FORMATTED_DDL = "conv_id long, part int, text string, loss_spans array<struct<begin: long, end: long>>"
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss_spans", SPANS)]
)


def escape(texts: pa.Array) -> pa.Array:
    """Escaped texts, as a whole column; null counts as empty."""
    texts = pc.fill_null(texts, "")
    texts = pc.replace_substring(texts, ESCAPE, ESCAPE * 2)
    for control in CONTROL:
        texts = pc.replace_substring(texts, control, control[0] + ESCAPE + control[1:])
    return texts


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if ESCAPE in text else text


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value bytes, starts and lengths of a string column without nulls."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    return data, ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)


def _scatter(out: np.ndarray, at: np.ndarray, column: tuple) -> None:
    """Copy every value of a column to its place in the buffer."""
    data, starts, lengths = column
    for row in np.flatnonzero(lengths > SLICE_BYTES):
        out[at[row] : at[row] + lengths[row]] = data[starts[row] : starts[row] + lengths[row]]
    small = lengths <= SLICE_BYTES
    at, starts, lengths = at[small], starts[small], lengths[small]
    firsts = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    out[np.repeat(at, lengths) + inside] = data[np.repeat(starts, lengths) + inside]


def assemble(roles: pa.Array, texts: pa.Array, first_turns: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(formatted strings, loss spans in bytes) of the conversations that begin at `first_turns`."""
    escaped_roles, escaped_texts = _bytes_of(escape(roles)), _bytes_of(escape(texts))
    count = len(roles)
    fixed = [np.frombuffer(part.encode(), np.uint8) for part in (TURN, ROLE_END, TEXT_END)]
    segments = np.empty((count, 5), np.int64)
    segments[:, 0], segments[:, 2], segments[:, 4] = (len(part) for part in fixed)
    segments[:, 1], segments[:, 3] = escaped_roles[2], escaped_texts[2]
    ends = np.cumsum(segments.ravel()).reshape(count, 5)
    begins = ends - segments
    out = np.empty(int(ends[-1, -1]) if count else 0, np.uint8)
    for place, part in zip((0, 2, 4), fixed, strict=True):
        out[begins[:, place][:, None] + np.arange(len(part))] = part
    _scatter(out, begins[:, 1], escaped_roles)
    _scatter(out, begins[:, 3], escaped_texts)

    offsets = np.append(begins[first_turns, 0], len(out)).astype(np.int32)
    strings = pa.StringArray.from_buffers(len(first_turns), pa.py_buffer(offsets), pa.py_buffer(out))
    learned = pc.fill_null(pc.equal(roles, LOSS_ROLE), False).to_numpy(zero_copy_only=False)
    turns = np.flatnonzero(learned)
    conversation = np.searchsorted(first_turns, turns, "right") - 1
    base = offsets[conversation]
    spans = pa.StructArray.from_arrays(
        [pa.array(begins[turns, 3] - base), pa.array(ends[turns, 3] - base)], ["begin", "end"]
    )
    per = np.bincount(conversation, minlength=len(first_turns))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per)), pa.int32()), spans)
    return strings, lists


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to conversations; the last one of a batch waits for its further turns."""
    waiting: list[pa.RecordBatch] = []
    held, parts = 0, (None, 0)  # of the conversation that was cut last: its id and next part

    def assembled(rows: pa.Table, cut: bool) -> pa.RecordBatch:
        nonlocal parts
        ids = rows["conv_id"].combine_chunks()
        values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        new = np.append(True, (values[1:] != values[:-1]) | (known[1:] != known[:-1]))
        first = np.flatnonzero(new)
        strings, spans = assemble(_whole(rows["role"]), _whole(rows["text"]), first)
        own = ids.take(pa.array(first))
        numbers = np.zeros(len(first), np.int32)
        if parts[1] and own[0].as_py() == parts[0]:
            numbers[0] = parts[1]
        parts = (own[-1].as_py(), int(numbers[-1]) + 1) if cut else (None, 0)
        return pa.RecordBatch.from_arrays([own, pa.array(numbers), strings, spans], schema=FORMATTED)

    for batch in batches:
        if not batch.num_rows:
            continue
        for piece in _pieces(batch):
            waiting.append(piece)
            held += piece.nbytes
            if held < BATCH_BYTES:
                continue
            rows = pa.Table.from_batches(waiting)
            last = _last_start(rows["conv_id"])
            if last:
                yield assembled(rows.slice(0, last), cut=False)
                waiting = rows.slice(last).to_batches()
                held = sum(b.nbytes for b in waiting)
            if held >= BATCH_BYTES:  # one conversation beyond the bound goes on in a further row
                yield assembled(pa.Table.from_batches(waiting), cut=True)
                waiting, held = [], 0
    if waiting:
        yield assembled(pa.Table.from_batches(waiting), cut=False)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    chunks = column.chunks
    return chunks[0] if len(chunks) == 1 else pa.concat_arrays(chunks)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most BATCH_BYTES, or single turns."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(lengths.astype(np.int64)) // BATCH_BYTES
    cuts = np.append(np.flatnonzero(np.diff(run, prepend=-1)), len(run))
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(begin, end - begin)


def _last_start(ids: pa.ChunkedArray) -> int:
    """Where the last conversation of sorted turns begins."""
    last = ids[-1].as_py()
    other = pc.is_valid(ids) if last is None else pc.fill_null(pc.not_equal(ids, last), True)
    places = np.flatnonzero(other.to_numpy())
    return int(places[-1]) + 1 if len(places) else 0


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, part, text, loss_spans (places in the UTF-8 bytes of text) of every conversation.

    Turns are ordered by turn, nulls first, then role, then text. Null roles and texts count as empty, a
    null conv_id is a conversation of its own, repeated rows are turns of their own; an empty table gives
    no rows; other columns take no part. A conversation of more than some BATCH_BYTES continues in further
    rows, cut between turns and numbered by part, so a task never holds a whole group. Parts of one
    conversation come in order and in one partition. One turn must fit into a row.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    )
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_formatted, FORMATTED_DDL)
    )


_TURN = re.compile(
    re.escape(TURN) + r"(.*?)" + re.escape(ROLE_END) + r"(.*?)" + re.escape(TEXT_END), re.DOTALL
)


def parse_chat(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def learned_text(text: str, spans: list[dict]) -> str:
    """What the loss mask covers, unescaped."""
    data = text.encode()
    return "".join(unescape(data[s["begin"] : s["end"]].decode()) for s in spans)
