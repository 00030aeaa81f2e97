"""Every gate in one report, from one pass over the order lines and one over the returns.

The lines are grouped once, by everything that tells them apart, into line facts: copies, sums and how
many of them break a row rule. All codes that need lines are read off these facts, which are written to
the shared folder, so that the largest table is scanned and shuffled once. Returns with the quantity of
their line are kept in the same way.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.batch import Batch
from ledgerloom.functions.predicates import unless
from ledgerloom.functions.text import entity_key
from ledgerloom.operators import aggregates as agg
from ledgerloom.operators import gates
from ledgerloom.operators.temporal import dimension_matches
from ledgerloom.schemas import COMPLETED, IDENTITY_KEYS, MESSAGES
from ledgerloom.session import literal_frame
from ledgerloom.skew import lookup_join, spread_groups


class QualityGateError(ValueError):
    """The batch has violations; the text lists the distinct codes."""


#: Copies of a violation that one row may hold at once.
COPIES_AT_ONCE = 10_000


def _emit(rows: DataFrame, *checks: tuple[str, Column, Column]) -> DataFrame:
    """A violation for every (code, entity id, times) of every row, as many times as that says."""
    found = [
        F.when(
            times > 0,
            F.struct(
                F.lit(code).alias("code"),
                entity.cast("string").alias("entity_id"),
                F.lit(MESSAGES[code]).alias("message"),
                times.cast("bigint").alias("times"),
            ),
        )
        for code, entity, times in checks
    ]
    any_found = reduce(Column.__or__, [times > 0 for _, _, times in checks])
    once = rows.filter(any_found).select(F.inline(F.array_compact(F.array(*found))))
    last = F.floor((F.col("times") - 1) / COPIES_AT_ONCE)
    runs = once.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("run"))
    here = F.least(F.lit(COPIES_AT_ONCE), F.col("times") - F.col("run") * COPIES_AT_ONCE).cast("int")
    copies = F.array_repeat(F.struct("code", "entity_id", "message"), here)
    return runs.select(F.inline(copies))


def _once(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def line_facts(batch: Batch) -> DataFrame:
    """One row per distinct (order, line, product): copies, sums, and copies that break a row rule."""
    def facts(lines: DataFrame) -> DataFrame:
        return lines.groupBy("order_id", "line_id", "product_id").agg(
            F.count(F.lit(1)).alias("copies"),
            F.sum("line_total_cents").alias("line_total_cents"),
            F.max("quantity").alias("ordered_quantity"),
            F.count_if(unless(gates.line_is_valid())).alias("invalid"),
            F.count_if(unless(gates.line_adds_up())).alias("wrong_total"),
        )

    hot = batch.hot("order_lines", "order_id")
    return spread_groups(batch["order_lines"], ["order_id"], batch.tasks("order_lines"), hot, facts)


def return_facts(batch: Batch, lines: DataFrame) -> DataFrame:
    """The returns, each with the quantity of its line and whether it has one."""
    keys = ["order_id", "line_id"]
    ordered = lines.join(batch["returns"].select(*keys).distinct(), keys, "left_semi")
    ordered = ordered.groupBy(*keys).agg(F.max("ordered_quantity").alias("ordered_quantity"))
    return lookup_join(
        batch["returns"],
        ordered.withColumn("has_line", F.lit(True)),
        keys,
        "left",
        batch.hot("returns", *keys),
    )


def _order_grain(batch: Batch, lines: DataFrame) -> DataFrame:
    """Line sums and captures meet in one aggregation by order, then join the order rows."""
    nothing = F.lit(None).cast("bigint")
    facts = (
        lines.select("order_id", F.col("line_total_cents").alias("line"), nothing.alias("captured"))
        .unionByName(
            agg.captured_payments(batch["payments"]).select(
                "order_id", nothing.alias("line"), F.col("amount_cents").alias("captured")
            )
        )
        .groupBy("order_id")
        .agg(F.sum("line").alias("line_subtotal"), F.sum("captured").alias("captured_cents"))
    )
    orders = lookup_join(
        batch["orders"], facts, ["order_id"], "left", batch.hot("orders", "order_id"), batch.tasks("orders")
    )
    entity = F.col("order_id")
    completed = F.coalesce(F.col("status") == COMPLETED, F.lit(False))
    return _emit(
        orders,
        ("ORDER_SUBTOTAL", entity, _once(unless(gates.subtotal_matches()))),
        ("ORDER_TOTAL", entity, _once(unless(gates.order_adds_up()))),
        ("CURRENCY", entity, _once(unless(gates.currency_is_known()))),
        ("UNDERPAID", entity, _once(completed & unless(gates.is_paid()))),
    )


def _line_grain(batch: Batch, lines: DataFrame) -> DataFrame:
    """Row rules, orphans and product versions of the lines: one join to orders, one to the dimension."""
    known = lookup_join(
        lines,
        agg.order_times(batch["orders"]).withColumn("has_order", F.lit(True)),
        ["order_id"],
        "left",
        batch.hot("order_lines", "order_id"),
        batch.tasks("order_lines"),
    )
    line, product = F.col("line_id"), F.col("product_id")
    has_order, matches = F.col("has_order").isNotNull(), F.col("dimension_matches")
    return _emit(
        dimension_matches(known, batch),
        ("INVALID_LINE", line, F.col("invalid")),
        ("LINE_TOTAL", line, F.col("wrong_total")),
        ("ORPHAN_LINE", line, F.when(has_order, 0).otherwise(F.col("copies"))),
        ("MISSING_DIMENSION", product, _once(has_order & (matches == 0))),
        ("AMBIGUOUS_DIMENSION", product, _once(has_order & (matches > 1))),
    )


def _return_grain(returns: DataFrame) -> DataFrame:
    entity, orphan = F.col("return_id"), F.col("has_line").isNull()
    return _emit(
        returns,
        ("ORPHAN_RETURN", entity, _once(orphan)),
        ("INVALID_RETURN", entity, _once(~orphan & unless(gates.return_is_valid()))),
    )


def _return_sums(batch: Batch, returns: DataFrame) -> DataFrame:
    """Returned against ordered quantity by line, refunds against captures by order."""
    valid = returns.filter("has_line")
    by_line = valid.groupBy("order_id", "line_id").agg(
        F.sum("quantity").alias("returned_quantity"), F.max("ordered_quantity").alias("ordered_quantity")
    )
    by_order = agg.refunds_by_order(valid).join(
        agg.captured_by_order(batch["payments"]), "order_id", "left"
    )
    line = entity_key(F.col("order_id"), F.col("line_id"))
    return _emit(
        by_line, ("RETURN_QUANTITY", line, _once(unless(gates.return_is_covered())))
    ).unionByName(
        _emit(by_order, ("EXCESS_REFUND", F.col("order_id"), _once(unless(gates.refund_is_covered()))))
    )


def _duplicates(batch: Batch, lines: DataFrame) -> DataFrame:
    keys, tasks = IDENTITY_KEYS["order_lines"], batch.tasks("order_lines")
    hot = None if tasks is None else batch.hot("order_lines", *keys)
    repeated = spread_groups(
        lines, keys, tasks, hot, lambda rows: gates.duplicate_ids(rows, "order_lines", "copies")
    )
    others = [gates.duplicates_in(batch, name) for name in IDENTITY_KEYS if name != "order_lines"]
    return reduce(DataFrame.unionByName, [repeated, *others])


def violation_report(batch: Batch) -> DataFrame:
    """All violations of the batch (code, entity_id, message), duplicates kept."""
    lines = batch.kept("line-facts", lambda: line_facts(batch))
    returns = batch.kept("return-facts", lambda: return_facts(batch, lines))
    return reduce(
        DataFrame.unionByName,
        [
            _order_grain(batch, lines),
            _line_grain(batch, lines),
            _return_grain(returns),
            _return_sums(batch, returns),
            _duplicates(batch, lines),
            gates.gate_orphan_payment(batch),
            gates.gate_negative_inventory(batch),
        ],
    )


def violation_summary(batch: Batch) -> DataFrame:
    """Violations counted by code."""
    return (
        violation_report(batch).groupBy("code").agg(F.count(F.lit(1)).alias("violations"))
    )


def violated_codes(report: DataFrame) -> DataFrame:
    """One row: the distinct codes, sorted and comma-joined; empty text for a clean batch."""
    return report.agg(
        F.array_join(F.sort_array(F.collect_set("code")), ",").alias("codes")
    )


def violated_by_code(report: DataFrame) -> DataFrame:
    """(code, violated) of every code there is, from one report."""
    codes = literal_frame(
        report.sparkSession, [{"code": code} for code in gates.GATES], code=pa.string()
    )
    found = report.select("code").distinct().withColumn("found", F.lit(True))
    return codes.join(found, "code", "left").select(
        "code", F.coalesce("found", F.lit(False)).alias("violated")
    )


def validate(batch: Batch) -> tuple[DataFrame, DataFrame]:
    """(violations, metrics)."""
    return violation_report(batch), agg.batch_metrics(batch)


def assert_valid(batch: Batch) -> None:
    codes = violated_codes(violation_report(batch)).first()["codes"]
    if codes:
        raise QualityGateError(codes)
