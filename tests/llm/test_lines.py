from __future__ import annotations

import numpy as np
import pytest
from helpers import clashing, empty, messy
from pyspark.sql import functions as F

from ledgerloom.llm import lines

STRIPPED = " \t\n\v\f\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def plainly(rows: list[tuple], least_chars: int, least_documents: int) -> list[tuple]:
    def key(line):
        return line.strip(STRIPPED).translate(LOWER)

    held: dict[str, set] = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least_chars:
                held.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        cut = (text or "").split("\n")
        kept = [
            line
            for line in cut
            if doc is None or len(held.get(key(line), ())) < least_documents or max(held[key(line)]) == doc
        ]
        out.append((doc, len(cut), len(cut) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def delivered(frame, **options) -> list[tuple]:
    found = lines.drop_repeated_lines(frame, **options)
    return sorted(map(tuple, found.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)


def shared_lines() -> list[tuple]:
    wide = "é" * 39
    rows = [
        (n, "\n".join(["  A line That many Documents hold, word for word.\t", f"own {n}", wide, wide + "É"]))
        for n in range(12)
    ]
    rows += [(3, "x\n" + "a line that many documents hold, word for word."), (11, rows[0][1]), (11, rows[11][1])]
    rows += [(None, rows[0][1])] * 6 + [(-5, rows[0][1]), (20, ""), (21, None), (22, "\n\n")]
    rows += [(n, "another line of forty code points or more\n" * 3) for n in range(30, 35 - 1)]
    return rows


@pytest.mark.parametrize("options", [{}, {"keys_per_shard": 1}, {"keys_per_shard": 1, "asked_per_slice": 1}])
def test_equals_the_plain_version(spark, options):
    rows = shared_lines()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = plainly(rows, 40, 5)
    assert delivered(frame, **options) == expected
    assert sum(row[2] for row in expected) > 20


def test_other_thresholds(spark):
    rows = shared_lines()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert delivered(frame, least_chars=1, least_documents=2) == plainly(rows, 1, 2)
    assert delivered(frame, least_chars=1, least_documents=1) == plainly(rows, 1, 1)


def test_awkward_rows(spark):
    rows = [tuple(r) for r in messy(spark).select("doc_id", "text").collect()]
    assert delivered(messy(spark)) == plainly(rows, 40, 5)
    assert delivered(clashing(messy(spark))) == plainly(rows, 40, 5)
    kept = lines.drop_repeated_lines(clashing(messy(spark)))
    assert kept.filter("serial != 'kept'").isEmpty() and "lang" in kept.columns
    assert delivered(empty(spark)) == []


def test_named_columns_are_replaced(spark):
    frame = messy(spark).withColumns({"n_lines": F.lit("x"), "KEPT_TEXT": F.lit("y"), "gone": F.lit(1), "key": F.lit(2)})
    assert len(delivered(frame)) == frame.count()


def test_hash_is_perfect_and_minimal():
    numbers = np.random.default_rng(1).integers(0, 1 << 63, (50_000, 2)).astype(np.uint64)
    made = lines.PerfectHash.build(numbers[:, 0], numbers[:, 1])
    slots = made.slots(numbers[:, 0], numbers[:, 1])
    assert sorted(slots) == list(range(50_000))
    assert made.bits.nbytes * 8 < 4 * 50_000
    with pytest.raises(RuntimeError):
        lines.PerfectHash.build(np.ones(2, np.uint64), np.ones(2, np.uint64))


def test_counts_can_be_merged_again():
    rng = np.random.default_rng(2)
    entries = np.zeros(3000, lines.ENTRY)
    entries["high"], entries["doc"] = rng.integers(0, 40, 3000), rng.integers(-30, 30, 3000)
    whole = lines.merged(entries, 5)
    parts = [lines.merged(part, 5) for part in np.array_split(entries, 7)]
    assert (lines.merged(np.concatenate(parts), 5) == whole).all()
    for high in range(40):
        docs = sorted(set(entries["doc"][entries["high"] == high].tolist()), reverse=True)
        assert whole["doc"][whole["high"] == high].tolist() == docs[:5]


def test_the_index_decides(spark, monkeypatch):
    """Arrays that say otherwise change the result: it comes from them."""
    frame = spark.createDataFrame(shared_lines(), "doc_id long, text string")
    with pytest.raises(ValueError):
        lines.drop_repeated_lines(frame, least_documents=0)
    entries = np.zeros(5, lines.ENTRY)
    entries["doc"] = range(5)
    row = dict(zip(lines.INDEX.names, lines.ShardIndex.row(0, 5, lines.merged(entries, 5), 5), strict=True))
    assert lines.ShardIndex(row).goes(entries, 5).tolist() == [True] * 4 + [False]
    row["counts"] = bytes([4])
    assert not lines.ShardIndex(row).goes(entries, 5).any()
    row["fingerprints"] = b"\1\0\0\0"
    with pytest.raises(RuntimeError):
        lines.ShardIndex(row).goes(entries, 5)
