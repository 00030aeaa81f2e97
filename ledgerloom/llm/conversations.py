"""Conversations repaired with the cheapest edits, in one pass over sorted turns.

A turn is kept, reroled or deleted, and turns may be inserted, so that the initials of the roles are a system
turn or none and then pairs of user and assistant, or nothing at all. What came before a turn matters by its
state only (nothing, a system turn, an open user turn, a full pair), so the pass carries four costs. Equal costs
are decided by the string of edits. Strings that end with the edit of the same turn are never prefixes of each
other, so the order of the four best strings is all that later turns need of them: costs above the least one
and that order make a configuration, there are few of these, and a turn of each kind leads from one to another
by a fixed table. Per turn the pass keeps two bytes, the entry of the table, which hold the way back for all
four states.

Turns are partitioned by conversation and sorted, and the state is carried from Arrow batch to Arrow batch. A
conversation that ends within the bounds of a part is traced back at once. A giant one leaves its parts as
rows with their two bytes a turn; a second pass walks these backwards, without the texts, and the parts are
then repaired independently of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

# Costs of edits, roles, the least that a text must hold, and the ends of a whole text.
REROLE, DELETE, INSERT, KEEP_TRUNCATED = 2, 3, 2, 1
SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
WORDLESS = r"[^\x20\x09-\x0D]"
WHITE = "\x20\t\n\x0b\f\r"
ENDS = (".", "!", "?")

#: Turns and characters of a part: a task holds one part of a conversation at most, or a single turn.
PART_TURNS, PART_CHARS = 65_536, 8_000_000

# Faults of a turn, the first that fits.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

# States: nothing yet, a system turn, an open user turn, a full pair.
START, AFTER_SYSTEM, OPEN, PAIRED = range(4)
STATES = range(4)
_KEPT = {(START, "s"): AFTER_SYSTEM, (START, "u"): OPEN, (AFTER_SYSTEM, "u"): OPEN, (OPEN, "a"): PAIRED,
         (PAIRED, "u"): OPEN}
#: The state after an inserted or reroled turn, and that turn's role.
_MADE = {START: OPEN, AFTER_SYSTEM: OPEN, OPEN: PAIRED, PAIRED: OPEN}
_ROLE = {START: USER, AFTER_SYSTEM: USER, OPEN: ASSISTANT, PAIRED: USER}
_MOST_INSERTS = 3
_LEGAL = {"su", "ua", "au"}

# Kinds of turns: one that must go, and each initial whole or truncated.
_MUST_GO = 8
_INITIALS = {"s": 0, "u": 2, "a": 4}
KINDS = range(9)


def kind_of(role: str, fault: int) -> int:
    if fault in (BLANK, DUPLICATE):
        return _MUST_GO
    return _INITIALS.get(role[:1], 6) + (fault == TRUNCATED)


def _edits(state: int, kind: int) -> Iterator[tuple[int, str, int]]:
    """(cost, edits, next state) of a turn met in a state, with insertions before it."""
    cost, edits = 0, ""
    for _ in range(_MOST_INSERTS + 1):
        yield cost + DELETE, edits + "D", state
        if kind != _MUST_GO:
            more = KEEP_TRUNCATED * (kind % 2)
            kept = _KEPT.get((state, "sua?"[kind // 2]))
            if kept is not None:
                yield cost + more, edits + "K", kept
            yield cost + REROLE + more, edits + "R", _MADE[state]
        state, cost, edits = _MADE[state], cost + INSERT, edits + "I"


#: What it costs at most to go on from one state as from another, by insertions, or by deleting a system turn
#: that only the other could have kept. A state dearer than that by another is never part of the cheapest edits.
_DETOUR = {
    (START, OPEN): 2, (START, PAIRED): 4, (AFTER_SYSTEM, OPEN): 2, (AFTER_SYSTEM, PAIRED): 4,
    (OPEN, PAIRED): 2, (OPEN, AFTER_SYSTEM): 2, (OPEN, START): 5,
    (PAIRED, OPEN): 2, (PAIRED, AFTER_SYSTEM): 0, (PAIRED, START): 3,
}


def _needed(best: list) -> list:
    """Without the states that a detour from another one undercuts."""
    return [
        own
        and (
            None
            if any(
                best[other] and best[other][0] + cost < own[0]
                for (other, state), cost in _DETOUR.items()
                if state == place
            )
            else own
        )
        for place, own in enumerate(best)
    ]


def _table() -> tuple[list, list[list[int]], list]:
    """(configurations, entry by configuration and kind, entries as (configuration, cost, way back))."""
    first = ((0, 0), None, None, None)
    configurations, entries, steps, known = [first], [], [], {first: 0}
    for configuration in configurations:
        row = []
        for kind in KINDS:
            best: list = [None] * 4
            for state in STATES:
                if configuration[state] is None:
                    continue
                cost, rank = configuration[state]
                for more, edits, following in _edits(state, kind):
                    found = (cost + more, rank, edits, state)
                    if best[following] is None or found < best[following]:
                        best[following] = found
            best = _needed(best)
            least = min(found[0] for found in best if found)
            order = sorted(found[1:3] for found in best if found)
            new = tuple(f and (f[0] - least, order.index(f[1:3])) for f in best)
            if new not in known:
                known[new] = len(configurations)
                configurations.append(new)
            row.append(len(entries))
            entries.append((known[new], least, tuple(f and (f[3], f[2]) for f in best)))
        steps.append(row)
    return configurations, steps, entries


CONFIGURATIONS, STEPS, ENTRIES = _table()
#: By entry: the configuration it leads to, and the cost it adds.
_NEXT = [entry[0] for entry in ENTRIES]
_COST = [entry[1] for entry in ENTRIES]
_BACK = [entry[2] for entry in ENTRIES]


def end_of(configuration: int) -> tuple[int, int, str]:
    """(cost, state, insertions) of the cheapest way to end."""
    found = []
    for state, own in enumerate(CONFIGURATIONS[configuration]):
        edits, at = "", state
        while own and len(edits) <= _MOST_INSERTS:
            if at in (START, PAIRED):
                found.append((own[0] + INSERT * len(edits), own[1], edits, state))
            at, edits = _MADE[at], edits + "I"
    cost, _, edits, state = min(found)
    return cost, state, edits


def traced(entries: np.ndarray, state: int) -> tuple[int, list[str]]:
    """(state before, edits by turn) of the turns with these entries that lead to a state."""
    edits = [""] * len(entries)
    for place in range(len(entries) - 1, -1, -1):
        state, edits[place] = _BACK[entries[place]][state]
    return state, edits


def replayed(state: int, edits: list[str], ending: str, roles: list[str], texts: list[str]) -> tuple[list, list]:
    """Roles and texts after the edits."""
    new_roles, new_texts = [], []

    def made(text: str) -> None:
        nonlocal state
        new_roles.append(_ROLE[state])
        new_texts.append(text)
        state = _MADE[state]

    for edit, role, text in zip(edits, roles, texts, strict=True):
        for _ in edit[:-1]:
            made("")
        if edit[-1] == "R":
            made(text)
        elif edit[-1] == "K":
            new_roles.append(role)
            new_texts.append(text)
            state = _KEPT[state, role[:1]]
    for _ in ending:
        made("")
    return new_roles, new_texts


# --- the pass over sorted turns -------------------------------------------------------------------

_PARTS = {
    "conv_id": "long",
    "part": "int",
    "roles": "array<string>",
    "texts": "array<string>",
    "audit": "string",
    "entries": "binary",
    "end_state": "int",
    "ending": "string",
    **dict.fromkeys(("n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "long"),
}
PARTS_DDL = ", ".join(f"{name} {kind}" for name, kind in _PARTS.items())
COUNTS = ("n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Conversation:
    """What is carried of one conversation: its state, its counts, and the turns of the current part."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.part, self.configuration, self.cost = conv_id, 0, 0, 0
        self.faults, self.n_turns, self.illegal, self.initial = [0, 0, 0, 0], 0, 0, None
        self.least = self.last = None
        self.distinct = 0
        self._fresh()

    def _fresh(self) -> None:
        self.roles, self.texts, self.entries, self.chars = [], [], [], 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.n_turns += 1
        self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last, self.distinct = turn, self.distinct + 1
        entry = STEPS[self.configuration][kind_of(role, fault)]
        self.configuration, self.cost = _NEXT[entry], self.cost + _COST[entry]
        self.entries.append(entry)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def is_full(self) -> bool:
        return len(self.entries) >= PART_TURNS or self.chars >= PART_CHARS

    def spilled(self) -> tuple:
        row = (self.conv_id, self.part, self.roles, self.texts, None, self._packed(), None, None, *[0] * 7)
        self.part += 1
        self._fresh()
        return row

    def _packed(self) -> bytes:
        return np.asarray(self.entries, "<u2").tobytes()

    def closed(self) -> tuple:
        more, state, ending = end_of(self.configuration)
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.distinct
        counts = (self.n_turns, gaps, *self.faults[1:], self.illegal, self.cost + more)
        if self.part:
            held = (self.roles, self.texts, None, self._packed(), state, ending)
        else:
            before, edits = traced(np.asarray(self.entries, "<u2"), state)
            held = (
                *replayed(before, edits, ending, self.roles, self.texts),
                "".join(edits) + ending,
                None,
                None,
                None,
            )
        return (self.conv_id, self.part, *held, *counts)


def _forward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current: _Conversation | None = None
    rows, chars = [], 0
    for frame in frames:
        columns = ("conv", "is_known", "turn", "has_turn", "role", "text", "fault", "is_turn")
        for conv, known, turn, has_turn, role, text, fault, is_turn in zip(
            *[frame[name].tolist() for name in columns], strict=True
        ):
            conv_id = conv if known else None
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    chars += current.chars
                    rows.append(current.closed())
                current = _Conversation(conv_id)
            if is_turn:
                current.add(turn if has_turn else None, role, text, fault)
                if current.is_full():
                    chars += current.chars
                    rows.append(current.spilled())
            if chars >= PART_CHARS or len(rows) >= 10_000:
                yield _frame(rows)
                rows, chars = [], 0
    if current is not None:
        rows.append(current.closed())
    if rows:
        yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = dict(zip(_PARTS, zip(*rows, strict=True), strict=True))
    nullable = {"long": "Int64", "int": "Int32"}
    return pd.DataFrame(
        {n: pd.Series(list(c), dtype=nullable.get(_PARTS[n], object)) for n, c in columns.items()}
    )


TRACE_DDL = "trace_conv long, trace_part int, state int, edits string"


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of giant conversations, last part first: their edits and the state before them.

    The edits of a turn end with its own, so the string of a part can be cut again.
    """
    state = 0
    for batch in batches:
        rows = []
        for conv_id, part, entries, end_state in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            state, edits = traced(np.frombuffer(entries, "<u2"), state if end_state is None else end_state)
            rows.append((conv_id, part, state, "".join(edits)))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string())
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays(arrays, ["trace_conv", "trace_part", "state", "edits"])


def cut_edits(audit: str) -> list[str]:
    """A string of edits, turn by turn: insertions belong to the turn that follows."""
    edits, begin = [], 0
    for place, edit in enumerate(audit):
        if edit != "I":
            edits.append(audit[begin : place + 1])
            begin = place + 1
    return edits


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of giant conversations with their traces, repaired."""
    for batch in batches:
        for row in batch.to_pylist():
            ending = row["ending"] or ""
            edits = cut_edits(row["edits"])
            roles, texts = replayed(row["state"], edits, ending, row["roles"], row["texts"])
            row |= {"roles": roles, "texts": texts, "audit": row["edits"] + ending}
            yield pa.RecordBatch.from_pylist([{n: row[n] for n in _REPAIRED}], schema=_REPAIRED_SCHEMA)


_REPAIRED = [n for n in _PARTS if n not in ("entries", "end_state", "ending")]
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
_REPAIRED_SCHEMA = pa.schema([(n, _ARROW[_PARTS[n]]) for n in _REPAIRED])
_REPAIRED_DDL = ", ".join(f"{n} {_PARTS[n]}" for n in _REPAIRED)


def fault(text: Column, is_repeat: Column) -> Column:
    """The first fault of a turn: BLANK, DUPLICATE, TRUNCATED or NONE."""
    last = F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1))
    return (
        F.when(~F.regexp_like(text, F.lit(WORDLESS)), BLANK)
        .when(is_repeat, DUPLICATE)
        .when(~last.isin(*ENDS), TRUNCATED)
        .otherwise(NONE)
    )


def repair(turns: DataFrame, is_turn: Column | None = None) -> DataFrame:
    """conv_id, part, roles, texts, audit, and counts, of every conversation repaired.

    Turns are taken in the order of turn (nulls first), role, text. Null roles and texts count as one space, a
    null conv_id is a conversation of its own, an empty table gives no rows, other columns take no part. A row
    for which `is_turn` is not true stands for its conversation only. Repeated rows are duplicates of the first.

    Edits: K keeps a turn, R makes it user or assistant, D deletes it (blank and duplicate turns must go), I
    inserts an empty one. `audit` has the edits in order; among the cheapest it is the ASCII-least string.
    n_turns, gaps, blank, duplicate, truncated, illegal and cost stand in the last part of a conversation and
    are 0 in all others, so that sums are right. gaps: whole numbers between the least and the greatest turn
    that are no turn, which must fit into a long; illegal: neighbours that no repaired conversation has.

    A conversation of more than PART_TURNS turns or PART_CHARS characters has several parts, in order. One
    conversation is one task in the pass over sorted turns, which streams with a bounded memory and spilling
    sorts; its parts are repaired by many.
    """
    known = F.lit(True) if is_turn is None else F.coalesce(is_turn, F.lit(False))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        known.alias("is_turn"),
    )
    seen = Window.partitionBy("conv_id", "is_turn", "role", "text").orderBy(F.asc_nulls_first("turn"))
    judged = (
        rows.repartition("conv_id")
        .withColumn("copy", F.row_number().over(seen))
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "copy")
        .select(
            F.coalesce("conv_id", F.lit(0)).alias("conv"),
            F.col("conv_id").isNotNull().alias("is_known"),
            F.coalesce("turn", F.lit(0)).alias("turn"),
            F.col("turn").isNotNull().alias("has_turn"),
            "role",
            "text",
            fault(F.col("text"), F.col("copy") > 1).alias("fault"),
            "is_turn",
        )
    )
    parts = written(judged.mapInPandas(_forward, PARTS_DDL), "conversation-parts")
    spilled = parts.filter(F.col("audit").isNull())
    traces = (
        spilled.select("conv_id", "part", "entries", "end_state")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("part"))
        .mapInArrow(_backward, TRACE_DDL)
    )
    same = F.col("conv_id").eqNullSafe(F.col("trace_conv")) & (F.col("part") == F.col("trace_part"))
    mended = spilled.join(traces, same).select(*parts.columns, "state", "edits").mapInArrow(_applied, _REPAIRED_DDL)
    return parts.filter(F.col("audit").isNotNull()).select(*_REPAIRED).unionByName(mended)
