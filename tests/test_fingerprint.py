from __future__ import annotations

import hashlib
import json

from ledgerloom.operators.fingerprint import table_fingerprint


def expected(rows: list[dict]) -> str:
    lanes = [0] * 12
    for row in rows:
        digits = hashlib.sha256(json.dumps(row, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        lanes = [total + int(digits[5 * n : 5 * n + 5], 16) for n, total in enumerate(lanes)]
    return hashlib.sha256(":".join(map(str, [len(rows), *lanes])).encode()).hexdigest()


def test_fingerprint_sums_the_lanes_of_every_row_by_group(spark):
    """Lanes were read digit by digit with conv; now they are summed in batches, whose groups may be mixed."""
    values = [(n % 3 or None, "x" if n % 2 else None, n * 7 - 500, ["SALE", "é", "a\"", None][n % 4]) for n in range(1000)]
    frame = spark.createDataFrame(values, "g bigint, k string, a bigint, z string").repartition(3)
    rows = [row.asDict() for row in frame.collect()]
    whole = table_fingerprint(frame)
    assert "conv(" not in whole._jdf.queryExecution().toString()
    assert tuple(whole.first()) == (1000, expected(rows))
    found = {(row["g"], row["k"]): (row["rows"], row["fingerprint"]) for row in table_fingerprint(frame, by=["g", "k"]).collect()}
    wanted = {}
    for row in rows:
        wanted.setdefault((row["g"], row["k"]), []).append({"a": row["a"], "z": row["z"]})
    assert found == {key: (len(group), expected(group)) for key, group in wanted.items()}
    assert tuple(table_fingerprint(frame.limit(0)).first()) == (0, expected([]))
    assert table_fingerprint(frame.limit(0), by=["g"]).isEmpty()


def test_derived_tables_make_no_arrays_of_rows(spark, small):
    """Every row went through an array of structs before, one element per variant."""
    from ledgerloom.sources import star_tables

    for name in ("orders", "order_lines", "payments", "returns", "products"):
        plan = star_tables.DERIVED[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate inline" not in plan, name
