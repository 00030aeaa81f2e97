from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from ledgerloom.llm import conversations as c
from ledgerloom.llm.queries import QUERIES, _digests, REPAIRED_DDL, damaged

WHOLE = re.compile(r"(s?(ua)+)?")


def cheapest(turns: list[tuple[str, str, int]]) -> tuple[int, str, list]:
    """(cost, audit, repaired turns), by search over all edits in the order of cost and audit."""
    queue, seen = [(0, "", 0, ())], set()
    while queue:
        cost, audit, place, made = heapq.heappop(queue)
        initials = "".join(role[:1] or "?" for role, _ in made)
        if place == len(turns) and WHOLE.fullmatch(initials):
            return cost, audit, list(made)
        state = (place, initials[-1:] if initials != "s" else "S", audit)
        if state in seen:
            continue
        seen.add(state)
        # What cannot be completed is dropped: a prefix of the pattern only.
        if not re.fullmatch(r"s?(ua)*u?", initials):
            continue
        if len(audit) - place < 3:
            for role in ("user", "assistant"):
                heapq.heappush(queue, (cost + 2, audit + "I", place, (*made, (role, ""))))
        if place < len(turns):
            role, text, fault = turns[place]
            heapq.heappush(queue, (cost + 3, audit + "D", place + 1, made))
            if fault not in (c.BLANK, c.DUPLICATE):
                more = fault == c.TRUNCATED
                heapq.heappush(queue, (cost + more, audit + "K", place + 1, (*made, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(queue, (cost + 2 + more, audit + "R", place + 1, (*made, (new, text))))
    raise AssertionError


def by_table(turns):
    conversation = c._Conversation(1)
    for role, text, fault in turns:
        conversation.add(0, role, text, fault)
    row = dict(zip(c._PARTS, conversation.closed(), strict=True))
    return row["cost"], row["audit"], list(zip(row["roles"], row["texts"], strict=True))


def test_table_finds_the_cheapest_edits():
    rng = random.Random(5)
    for _ in range(1500):
        turns = [
            (rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "unit"]), f"t{n}", rng.choice([0, 0, 0, 1, 2, 3, 3]))
            for n in range(rng.randrange(6))
        ]
        assert by_table(turns) == cheapest(turns), turns


def plainly(rows: list[tuple]) -> dict:
    """conv_id -> what the registered query returns, from (conv_id, turn, role, text) rows."""
    held: dict = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own = held.setdefault(conv, [])
        known = [" " if v is None else str(v) for v in (conv, turn)]
        fate = zlib.crc32(":".join(known).encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = {}
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        judged, seen = [], set()
        for _, role, text in own:
            bare = text.strip(" \t\n\v\f\r")
            fault = c.BLANK if not bare else c.DUPLICATE if (role, text) in seen else c.TRUNCATED if bare[-1] not in ".!?" else c.NONE
            seen.add((role, text))
            judged.append((role, text, fault))
        known = [turn for turn, _, _ in own if turn is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        cost, audit, made = by_table(judged)
        if len(judged) <= 9:
            assert (cost, audit, made) == cheapest(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        faults = [sum(j[2] == f for j in judged) for f in (c.BLANK, c.DUPLICATE, c.TRUNCATED)]
        out[conv] = (gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def queried(frame) -> dict:
    parts = c.repair(damaged(frame), __import__("pyspark.sql.functions", fromlist=["col"]).col("is_turn"))
    found = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_digests, REPAIRED_DDL)
    return {row[0]: tuple(row)[1:] for row in found.collect()}


DDL = "conv_id long, turn long, role string, text string"


def awkward(rng: random.Random) -> list[tuple]:
    texts = ["Yes.", "No", "", None, " \n", "What? \t", "so. on", "é!", "x" * 50_000 + "."]
    rows = [
        (rng.choice([1, 2, 3, 4, 5, None, -9]), rng.choice([*range(5), None, 7, 1 << 60]), rng.choice(["system", "user", "assistant", None, "tool", ""]), rng.choice(texts))
        for _ in range(150)
    ]
    return rows + rows[:20]


@pytest.mark.parametrize("bound", [65_536, 3, 1])
def test_awkward_rows_in_parts_of_any_size(spark, monkeypatch, bound):
    # Workers are forked anew for a bound of their own, so it is passed by the closure of the module's function.
    rows = awkward(random.Random(3))
    forward = c._forward

    def bounded(frames):
        c.PART_TURNS = bound
        try:
            yield from forward(frames)
        finally:
            c.PART_TURNS = 65_536

    monkeypatch.setattr(c, "_forward", bounded)
    frame = spark.createDataFrame(rows, DDL).repartition(4)
    assert queried(frame) == plainly(rows)


def test_given_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, small).collect()}
    assert found == plainly(rows)


def test_empty_and_extra_columns(spark):
    assert queried(spark.createDataFrame([], DDL)) == {}
    frame = spark.createDataFrame([(1, 0, "user", "Hi.", "x", "y")], f"{DDL}, part string, copy string")
    row = c.repair(frame).first()
    assert (row["audit"], row["roles"], row["cost"]) == ("KI", ["user", "assistant"], 2)
