"""One function per violation code. Each returns (code, entity_id, message)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.batch import Batch
from ledgerloom.functions.predicates import null_to_zero, unless
from ledgerloom.functions.text import entity_key
from ledgerloom.operators import aggregates as agg
from ledgerloom.operators.inventory import running_stock
from ledgerloom.operators.temporal import dimension_matches, line_events
from ledgerloom.schemas import CURRENCIES, ENTITY_NAMES, IDENTITY_KEYS, MESSAGES
from ledgerloom.skew import lookup_join, spread_groups

# The conditions a row must meet, shared with the one-pass report.


def line_is_valid() -> Column:
    return (F.col("quantity") > 0) & (F.col("unit_price_cents") >= 0)


def line_adds_up() -> Column:
    return F.col("line_total_cents") == F.col("quantity") * F.col("unit_price_cents")


def order_adds_up() -> Column:
    expected = F.col("subtotal_cents") + F.col("tax_cents") - F.col("discount_cents")
    return F.col("total_cents") == expected


def currency_is_known() -> Column:
    return F.col("currency").isin(*CURRENCIES)


def return_is_valid() -> Column:
    return (F.col("quantity") > 0) & (F.col("refund_cents") >= 0)


def subtotal_matches() -> Column:
    return null_to_zero(F.col("line_subtotal")) == F.col("subtotal_cents")


def is_paid() -> Column:
    return null_to_zero(F.col("captured_cents")) >= F.col("total_cents")


def refund_is_covered() -> Column:
    return F.col("refund_cents") <= null_to_zero(F.col("captured_cents"))


def return_is_covered() -> Column:
    return F.col("returned_quantity") <= F.col("ordered_quantity")


def stock_is_covered() -> Column:
    return F.col("stock") >= 0


def violations(rows: DataFrame, code: str, entity_id: str | Column) -> DataFrame:
    entity = F.col(entity_id) if isinstance(entity_id, str) else entity_id
    return rows.select(
        F.lit(code).alias("code"),
        entity.cast("string").alias("entity_id"),
        F.lit(MESSAGES[code]).alias("message"),
    )


def duplicates(frame: DataFrame, keys: tuple[str, ...], copies: str | None = None) -> DataFrame:
    """Keys seen more than once. Copies collapse before the shuffle, or are counted in a column already."""
    seen = F.count(F.lit(1)) if copies is None else F.sum(copies)
    return frame.groupBy(*keys).agg(seen.alias("seen")).filter(F.col("seen") > 1).drop("seen")


def duplicate_ids(frame: DataFrame, table: str, copies: str | None = None) -> DataFrame:
    keys = IDENTITY_KEYS[table]
    return duplicates(frame, keys, copies).select(
        F.lit("DUPLICATE_ID").alias("code"),
        entity_key(*[F.col(key) for key in keys]).alias("entity_id"),
        F.lit(f"duplicate {ENTITY_NAMES[table]} identity").alias("message"),
    )


def duplicates_in(batch: Batch, table: str) -> DataFrame:
    keys, tasks = IDENTITY_KEYS[table], batch.tasks(table)
    hot = None if tasks is None else batch.hot(table, *keys)
    return spread_groups(batch[table], keys, tasks, hot, lambda rows: duplicate_ids(rows, table))


def gate_duplicate_id(batch: Batch) -> DataFrame:
    return reduce(DataFrame.unionByName, [duplicates_in(batch, table) for table in IDENTITY_KEYS])


def sorted_duplicates(batch: Batch) -> DataFrame:
    return gate_duplicate_id(batch).orderBy("message", "entity_id")


def gate_invalid_line(batch: Batch) -> DataFrame:
    return violations(batch["order_lines"].filter(unless(line_is_valid())), "INVALID_LINE", "line_id")


def gate_line_total(batch: Batch) -> DataFrame:
    return violations(batch["order_lines"].filter(unless(line_adds_up())), "LINE_TOTAL", "line_id")


def gate_order_total(batch: Batch) -> DataFrame:
    return violations(batch["orders"].filter(unless(order_adds_up())), "ORDER_TOTAL", "order_id")


def gate_currency(batch: Batch) -> DataFrame:
    return violations(batch["orders"].filter(unless(currency_is_known())), "CURRENCY", "order_id")


def gate_order_subtotal(batch: Batch) -> DataFrame:
    compared = lookup_join(
        batch["orders"],
        agg.line_totals(batch["order_lines"]),
        ["order_id"],
        "left",
        batch.hot("orders", "order_id"),
    )
    return violations(compared.filter(unless(subtotal_matches())), "ORDER_SUBTOTAL", "order_id")


def gate_underpaid(batch: Batch) -> DataFrame:
    compared = lookup_join(
        agg.completed_orders(batch["orders"]),
        agg.captured_by_order(batch["payments"]),
        ["order_id"],
        "left",
        batch.hot("orders", "order_id"),
    )
    return violations(compared.filter(unless(is_paid())), "UNDERPAID", "order_id")


def gate_orphan_payment(batch: Batch) -> DataFrame:
    orphans = lookup_join(
        batch["payments"],
        agg.order_keys(batch["orders"]),
        ["order_id"],
        "left_anti",
        batch.hot("payments", "order_id"),
    )
    return violations(orphans, "ORPHAN_PAYMENT", "payment_id")


def gate_orphan_line(batch: Batch) -> DataFrame:
    orphans = lookup_join(
        batch["order_lines"],
        agg.order_keys(batch["orders"]),
        ["order_id"],
        "left_anti",
        batch.hot("order_lines", "order_id"),
    )
    return violations(orphans, "ORPHAN_LINE", "line_id")


def gate_orphan_return(batch: Batch) -> DataFrame:
    orphans = lookup_join(
        batch["returns"],
        agg.returned_lines(batch),
        ["order_id", "line_id"],
        "left_anti",
        batch.hot("returns", "order_id", "line_id"),
    )
    return violations(orphans, "ORPHAN_RETURN", "return_id")


def gate_invalid_return(batch: Batch) -> DataFrame:
    invalid = agg.valid_returns(batch).filter(unless(return_is_valid()))
    return violations(invalid, "INVALID_RETURN", "return_id")


def gate_return_quantity(batch: Batch) -> DataFrame:
    """Both sides are one row per line key, so no key is heavy; the inner join drops orphans."""
    compared = agg.returned_by_line(batch["returns"]).join(
        agg.returned_lines(batch), ["order_id", "line_id"]
    )
    return violations(
        compared.filter(unless(return_is_covered())),
        "RETURN_QUANTITY",
        entity_key(F.col("order_id"), F.col("line_id")),
    )


def gate_excess_refund(batch: Batch) -> DataFrame:
    compared = agg.refunds_by_order(agg.valid_returns(batch)).join(
        agg.captured_by_order(batch["payments"]), "order_id", "left"
    )
    return violations(compared.filter(unless(refund_is_covered())), "EXCESS_REFUND", "order_id")


def gate_negative_inventory(batch: Batch) -> DataFrame:
    return violations(
        running_stock(batch).filter(unless(stock_is_covered())),
        "NEGATIVE_INVENTORY",
        entity_key(F.col("product_id"), F.col("store_id")),
    )


def gate_missing_dimension(batch: Batch) -> DataFrame:
    counted = dimension_matches(line_events(batch), batch)
    return violations(
        counted.filter(F.col("dimension_matches") == 0), "MISSING_DIMENSION", "product_id"
    )


def gate_ambiguous_dimension(batch: Batch) -> DataFrame:
    counted = dimension_matches(line_events(batch), batch)
    return violations(
        counted.filter(F.col("dimension_matches") > 1), "AMBIGUOUS_DIMENSION", "product_id"
    )


GATES: dict[str, Callable[[Batch], DataFrame]] = {
    "DUPLICATE_ID": gate_duplicate_id,
    "INVALID_LINE": gate_invalid_line,
    "LINE_TOTAL": gate_line_total,
    "ORDER_SUBTOTAL": gate_order_subtotal,
    "ORDER_TOTAL": gate_order_total,
    "CURRENCY": gate_currency,
    "ORPHAN_PAYMENT": gate_orphan_payment,
    "UNDERPAID": gate_underpaid,
    "ORPHAN_RETURN": gate_orphan_return,
    "INVALID_RETURN": gate_invalid_return,
    "RETURN_QUANTITY": gate_return_quantity,
    "EXCESS_REFUND": gate_excess_refund,
    "NEGATIVE_INVENTORY": gate_negative_inventory,
    "ORPHAN_LINE": gate_orphan_line,
    "MISSING_DIMENSION": gate_missing_dimension,
    "AMBIGUOUS_DIMENSION": gate_ambiguous_dimension,
}


def is_violated(violation: DataFrame) -> bool:
    """Existence only: stops at the first row found."""
    return not violation.isEmpty()
