"""Formatted chats, read back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import chat

TEXTS = st.lists(
    st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "é", "\U0001f600", "ok ", "\n", "[", "INST]"])
).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | TEXTS, TEXTS), min_size=1, max_size=6)


def expected(turns):
    return [(role or "", text or "") for role, text in turns]


@settings(max_examples=200, deadline=None)
@given(st.lists(TURNS, min_size=1, max_size=4))
def test_assembled_conversations_give_back_their_turns(conversations):
    first = np.cumsum([0] + [len(c) for c in conversations])[:-1]
    roles = pa.array([r for c in conversations for r, _ in c], pa.string())
    texts = pa.array([t for c in conversations for _, t in c], pa.string())
    strings, spans = chat.assemble(roles, texts, first)
    for own, text, mask in zip(conversations, strings.to_pylist(), spans.to_pylist(), strict=True):
        assert chat.parse_chat(text) == own
        assert chat.learned_text(text, mask) == "".join(t for r, t in own if r == "assistant")
        bare = text
        for role, said in own:
            safe = chat.escape(pa.array([role, said])).to_pylist()
            assert not any(control in part for part in safe for control in chat.CONTROL)
            bare = bare.replace(f"<s>[INST]{safe[0]}[/INST]{safe[1]}</s>", "", 1)
        assert bare == ""


def batches(rows, size):
    table = pa.Table.from_pylist(
        [dict(zip(("conv_id", "turn", "role", "text"), row, strict=True)) for row in rows],
        pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]),
    )
    return table.to_batches(max_chunksize=size)


def test_conversations_cross_batches_and_long_ones_continue(monkeypatch):
    rows = [(None, 0, "user", "n")] + [
        (conv, turn, "assistant" if turn % 2 else "user", f"{conv}-{turn} " * 10)
        for conv, turns in ((1, 3), (2, 200), (3, 1), (4, 90))
        for turn in range(turns)
    ]
    for limit, size in ((2000, 7), (10**7, 1000), (1, 3), (10**7, 2)):
        monkeypatch.setattr(chat, "BATCH_BYTES", limit)
        found, parts = {}, {}
        for batch in chat._formatted(iter(batches(rows, size))):
            for r in batch.to_pylist():
                assert r["part"] == parts.get(r["conv_id"], 0)
                parts[r["conv_id"]] = r["part"] + 1
                found.setdefault(r["conv_id"], []).extend(chat.parse_chat(r["text"]))
        assert found == {
            conv: [(role, text) for c, _, role, text in rows if c == conv] for conv in (None, 1, 2, 3, 4)
        }
        assert limit > 2000 or parts[2] > 1


def test_awkward_rows(spark):
    ddl = "conv_id long, turn long, role string, text string, part int, loss_spans string"
    rows = [
        (1, 1, "assistant", "b" * 300_000, 1, "x"),
        (1, 0, None, "a", 1, "x"),
        (1, 1, "assistant", "b" * 300_000, 1, "x"),
        (1, None, "user", None, 1, "x"),
        (None, 0, "user", "", None, None),
    ]
    found = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, ddl)).collect()}
    assert chat.parse_chat(found[1].text) == [("user", ""), ("", "a")] + [("assistant", "b" * 300_000)] * 2
    assert chat.learned_text(found[1].text, [s.asDict() for s in found[1].loss_spans]) == "b" * 600_000
    assert chat.parse_chat(found[None].text) == [("user", "")]
    assert chat.format_chats(spark.createDataFrame([], ddl)).count() == 0
