from __future__ import annotations

import pytest

from golden import added, as_batch, changed, golden_rows, side_by_side
from ledgerloom.operators import gates
from ledgerloom.operators.aggregates import batch_metrics
from ledgerloom.plans.report import (
    QualityGateError,
    assert_valid,
    validate,
    violation_report,
    violation_summary,
)
from ledgerloom.schemas import SCHEMAS, VIOLATION

CLEAN = golden_rows()
ORDER, LINE = CLEAN["orders"][0], CLEAN["order_lines"][0]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_clean_batch_passes_with_golden_numbers(spark):
    batch = as_batch(spark, CLEAN)
    report, metrics = validate(batch)
    assert report.schema.names == VIOLATION.names
    assert report.isEmpty()
    assert {row["metric"]: row["value"] for row in metrics.collect()} == {
        "orders": 30,
        "order_lines": 58,
        "payments": 30,
        "returns": 2,
        "inventory_movements": 120,
        "products": 20,
        "gross_order_cents": 200693,
        "captured_cents": 200693,
        "refunded_cents": 2629,
    }


MUTATIONS = {
    "broken total": (changed(CLEAN, "orders", 0, total_cents=ORDER[8] + 1), "ORDER_TOTAL,UNDERPAID"),
    "subtotal": (
        changed(CLEAN, "orders", 0, subtotal_cents=ORDER[5] + 1, tax_cents=ORDER[6] - 1),
        "ORDER_SUBTOTAL",
    ),
    "null total": (changed(CLEAN, "orders", 0, total_cents=None), "ORDER_TOTAL,UNDERPAID"),
    "currency": (changed(CLEAN, "orders", 3, currency="EUR"), "CURRENCY"),
    "null currency": (changed(CLEAN, "orders", 3, currency=None), "CURRENCY"),
    "line total": (
        changed(CLEAN, "order_lines", 0, line_total_cents=LINE[5] + 1),
        "LINE_TOTAL,ORDER_SUBTOTAL",
    ),
    "null price": (
        changed(CLEAN, "order_lines", 0, unit_price_cents=None),
        "INVALID_LINE,LINE_TOTAL",
    ),
    "negative price": (
        changed(CLEAN, "order_lines", 0, unit_price_cents=-1, line_total_cents=-LINE[3]),
        "INVALID_LINE,ORDER_SUBTOTAL",
    ),
    "no quantity": (
        changed(CLEAN, "order_lines", 5, quantity=0, line_total_cents=0),
        "INVALID_LINE,ORDER_SUBTOTAL",
    ),
    "orphan line": (
        added(CLEAN, "order_lines", ("o-none", "l-1", "p-001", 1, 10, 10)),
        "ORPHAN_LINE",
    ),
    "orphan payment": (added(CLEAN, "payments", ("pay-x", "o-none", 10, "CAPTURED")), "ORPHAN_PAYMENT"),
    "null payment order": (added(CLEAN, "payments", ("pay-x", None, 10, "CAPTURED")), "ORPHAN_PAYMENT"),
    "authorized only": (changed(CLEAN, "payments", 4, status="AUTHORIZED"), "UNDERPAID"),
    "orphan return": (added(CLEAN, "returns", ("ret-x", ORDER[0], "l-9", 1, 10)), "ORPHAN_RETURN"),
    "invalid return": (changed(CLEAN, "returns", 0, quantity=0), "INVALID_RETURN"),
    "return quantity": (changed(CLEAN, "returns", 0, quantity=LINE[3] + 1), "RETURN_QUANTITY"),
    "cumulative return": (
        added(CLEAN, "returns", ("ret-x", ORDER[0], LINE[1], LINE[3], 1)),
        "RETURN_QUANTITY",
    ),
    "excess refund": (
        changed(CLEAN, "returns", 0, refund_cents=ORDER[8] + 1),
        "EXCESS_REFUND",
    ),
    "negative stock": (
        added(
            CLEAN,
            "inventory_movements",
            ("bad", LINE[2], ORDER[2], -1_000_000, "CORRUPTION", ORDER[3] + 1),
        ),
        "NEGATIVE_INVENTORY",
    ),
    "missing product": (
        {**CLEAN, "products": [row for row in CLEAN["products"] if row[0] != LINE[2]]},
        "MISSING_DIMENSION",
    ),
    "unknown yet": (
        changed(CLEAN, "products", 0, loaded_at=1_800_000_000),
        "MISSING_DIMENSION",
    ),
    "closed before": (
        changed(CLEAN, "products", 0, effective_to=ORDER[3]),
        "MISSING_DIMENSION",
    ),
    "overlapping version": (
        added(
            CLEAN,
            "products",
            (
                CLEAN["products"][0][0],
                "overlap",
                CLEAN["products"][0][2] + 1,
                None,
                CLEAN["products"][0][4] + 1,
            ),
        ),
        "AMBIGUOUS_DIMENSION",
    ),
    "duplicate payment": (added(CLEAN, "payments", (*CLEAN["payments"][0][:2], 0, "AUTHORIZED")), "DUPLICATE_ID"),
    "duplicate order": (added(CLEAN, "orders", ORDER), "DUPLICATE_ID"),
    "duplicate product": (
        changed(
            added(CLEAN, "products", CLEAN["products"][0]), "products", 20, effective_to=1_699_999_999
        ),
        "DUPLICATE_ID",
    ),
}


def test_mutations_give_exactly_their_codes(spark):
    cases = {name: rows for name, (rows, _) in MUTATIONS.items()} | {"clean": CLEAN}
    batch = as_batch(spark, side_by_side(cases))
    report = sorted(map(tuple, violation_report(batch).collect()))
    found: dict[str, set[str]] = {name: set() for name in cases}
    for code, entity, _ in report:
        found[entity.split("|")[0]].add(code)
    assert {name: ",".join(sorted(codes)) for name, codes in found.items()} == {
        name: codes for name, (_, codes) in MUTATIONS.items()
    } | {"clean": ""}
    separate = sorted(tuple(row) for gate in gates.GATES.values() for row in gate(batch).collect())
    assert report == separate


def test_assert_valid_lists_codes(spark):
    rows, codes = MUTATIONS["broken total"]
    with pytest.raises(QualityGateError, match=codes):
        assert_valid(as_batch(spark, rows))


def test_duplicate_line_is_reported_but_not_ambiguous(spark):
    rows = added(CLEAN, "order_lines", LINE)
    batch = as_batch(spark, rows)
    assert gates.gate_ambiguous_dimension(batch).isEmpty()
    assert rows_of(gates.gate_duplicate_id(batch)) == [
        ("DUPLICATE_ID", f"{LINE[0]}:{LINE[1]}", "duplicate line identity")
    ]


def test_row_level_codes_count_every_copy(spark):
    bad = changed(CLEAN, "orders", 0, currency="EUR")
    twice = added(bad, "orders", bad["orders"][0])
    assert gates.gate_currency(as_batch(spark, twice)).count() == 2


def test_colliding_composite_keys_are_not_duplicates(spark):
    rows = added(
        {**CLEAN, "order_lines": []},
        "order_lines",
        ("a:b", "c", "p-001", 1, 1, 1),
        ("a", "b:c", "p-001", 1, 1, 1),
    )
    assert gates.duplicates(as_batch(spark, rows)["order_lines"], ("order_id", "line_id")).isEmpty()


def test_each_movement_below_zero_is_reported(spark):
    rows = {
        **CLEAN,
        "inventory_movements": [
            ("m2", "p", "s", -5, "SALE", 10),
            ("m1", "p", "s", 5, "OPENING", 10),
            ("m3", "p", "s", -1, "SALE", 11),
            ("m4", "p", "s", -1, "SALE", 12),
            ("m5", "p", "s", 2, "RETURN", 13),
        ],
    }
    found = gates.gate_negative_inventory(as_batch(spark, rows))
    assert [tuple(row)[:2] for row in found.collect()] == [("NEGATIVE_INVENTORY", "p:s")] * 2


def test_empty_batch(spark):
    empty = as_batch(spark, {name: [] for name in SCHEMAS})
    assert violation_report(empty).isEmpty()
    assert violation_summary(empty).isEmpty()
    assert {row["value"] for row in batch_metrics(empty).collect()} == {0}


def test_is_violated(spark):
    rows, _ = MUTATIONS["currency"]
    assert gates.is_violated(gates.gate_currency(as_batch(spark, rows)))
    assert not gates.is_violated(gates.gate_currency(as_batch(spark, CLEAN)))
