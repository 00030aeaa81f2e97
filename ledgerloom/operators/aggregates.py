"""Per-key sums and batch totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.batch import Batch
from ledgerloom.functions.predicates import null_to_zero
from ledgerloom.schemas import CAPTURED, COMPLETED, TABLES
from ledgerloom.skew import lookup_join


def captured_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("status") == CAPTURED)


def completed_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") == COMPLETED)


def line_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.sum("line_total_cents").alias("line_subtotal"))


def captured_by_order(payments: DataFrame) -> DataFrame:
    return (
        captured_payments(payments)
        .groupBy("order_id")
        .agg(F.sum("amount_cents").alias("captured_cents"))
    )


def refunds_by_order(returns: DataFrame) -> DataFrame:
    return returns.groupBy("order_id").agg(F.sum("refund_cents").alias("refund_cents"))


def returned_by_line(returns: DataFrame) -> DataFrame:
    return returns.groupBy("order_id", "line_id").agg(
        F.sum("quantity").alias("returned_quantity")
    )


def ordered_by_line(lines: DataFrame) -> DataFrame:
    """One row per line key, so that a repeated line is not counted twice."""
    return lines.groupBy("order_id", "line_id").agg(F.max("quantity").alias("ordered_quantity"))


def order_times(orders: DataFrame) -> DataFrame:
    """One timestamp per order id (the latest, if copies disagree)."""
    return orders.groupBy("order_id").agg(F.max("order_ts").alias("order_ts"))


def order_keys(orders: DataFrame) -> DataFrame:
    return orders.select("order_id").distinct()


def returned_lines(batch: Batch) -> DataFrame:
    """One row per line key that has returns, with its ordered quantity.

    Returns are few beside lines: filtering the lines by them first keeps most lines out of the
    shuffle, and needs none where the return keys are small enough to broadcast.
    """
    keys = ["order_id", "line_id"]
    return ordered_by_line(
        lookup_join(
            batch["order_lines"].select(*keys, "quantity"),
            batch["returns"].select(*keys).distinct(),
            keys,
            "left_semi",
            batch.hot("order_lines", *keys),
        )
    )


def valid_returns(batch: Batch) -> DataFrame:
    """Returns whose line exists: only these count towards sums and metrics."""
    return lookup_join(
        batch["returns"],
        returned_lines(batch),
        ["order_id", "line_id"],
        "left_semi",
        batch.hot("returns", "order_id", "line_id"),
    )


def batch_metrics(batch: Batch) -> DataFrame:
    """Nine numbers in long form (metric, value)."""

    def metric(frame: DataFrame, name: str, value: Column) -> DataFrame:
        return frame.agg(null_to_zero(value).cast("bigint").alias("value")).select(
            F.lit(name).alias("metric"), "value"
        )

    counted = [metric(batch[table], table, F.count(F.lit(1))) for table in TABLES]
    summed = [
        metric(batch["orders"], "gross_order_cents", F.sum("total_cents")),
        metric(captured_payments(batch["payments"]), "captured_cents", F.sum("amount_cents")),
        metric(valid_returns(batch), "refunded_cents", F.sum("refund_cents")),
    ]
    return reduce(DataFrame.unionByName, counted + summed)


def business_result(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        null_to_zero(F.sum("total_cents")).alias("gross_cents"),
    )


def six_table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row, one count per table."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, frame in tables.items()
    ]
    stacked = reduce(DataFrame.unionByName, counts)
    return stacked.agg(
        *[F.max(F.when(F.col("name") == name, F.col("rows"))).alias(name) for name in tables]
    )
