"""Retail tables derived from the given star-schema tables (orders, lineitem, part, events).

The derived batch is consistent by construction and then faulted by key modulus, so that every
violation code occurs. Each derived table is written once per session as Parquet in the shared
folder: later queries read it with column pruning and filter pushdown instead of deriving it again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.batch import Batch
from ledgerloom.session import fresh_dir
from ledgerloom.skew import hot_keys, lookup_join, running_sums, tasks_for

# Fixed values of the derived batch.
KNOWLEDGE_TIME = 996_000_000
OPENING_TS = 788_918_399
FIRST_EFFECTIVE = 700_000_000
SECOND_EFFECTIVE = 880_000_000
NOT_YET_KNOWN = 999_999_999

_written: dict[tuple[str, str, str], DataFrame] = {}
_batches: dict[tuple[str, str], Batch] = {}


def _long(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")


def _epoch(frame: DataFrame, name: str) -> Column:
    """Epoch seconds, rounded down. Zone-free timestamps do not depend on the session time zone."""
    moment = F.col(name)
    if isinstance(frame.schema[name].dataType, T.TimestampNTZType):
        day = F.datediff(F.to_date(moment), F.lit("1970-01-01").cast("date"))
        clock = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
        return _long(day) * 86400 + _long(clock)
    return F.unix_seconds(moment)


def _rows(frame: DataFrame, *variants: tuple[Column | None, dict[str, Column]]) -> DataFrame:
    """Zero or more output rows per input row: each variant is (condition or None, columns).

    One projection per variant, over the rows it is for: most rows have one variant only, and making them as
    elements of an array costs several times as much.
    """
    made = [
        (frame if condition is None else frame.filter(condition)).select(
            *[column.alias(name) for name, column in columns.items()]
        )
        for condition, columns in variants
    ]
    return reduce(DataFrame.unionByName, made)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """The derived table, written on first use in this session and read from Parquet from then on."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _written:
        frame = build(spark, sf_dir)
        source = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
        path = fresh_dir(spark, f"derived-{source}-{name}")
        frame.write.parquet(path)
        _written[slot] = spark.read.schema(frame.schema).parquet(path)
    return _written[slot]


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir, "clean_lines", _clean_lines)


def _clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = given(spark, sf_dir, "lineitem")
    # Line numbers repeat within an order, so the line id is the running count in a total order.
    order = [
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_extendedprice",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
        "l_discount",
        "l_tax",
    ]
    rows = lineitem.count()
    numbered = running_sums(
        lineitem.select("l_orderkey", *order),
        ["l_orderkey"],
        order,
        {"line_id": _long(1)},
        hot_keys(lineitem, ["l_orderkey"], rows=rows),
        tasks_for(spark, rows),
    )
    return numbered.select(
        F.col("l_orderkey").alias("order_id"),
        "line_id",
        F.col("l_partkey").alias("product_id"),
        _long(F.col("l_quantity")).alias("quantity"),
        _long(F.floor(F.round(F.col("l_extendedprice") * 100) / F.col("l_quantity"))).alias(
            "unit_price_cents"
        ),
        F.col("l_returnflag").alias("return_flag"),
    )


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir, "clean_orders", _clean_orders)


def _clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    subtotals = (
        clean_lines(spark, sf_dir)
        .groupBy("order_id")
        .agg(F.sum(F.col("quantity") * F.col("unit_price_cents")).alias("line_sum"))
    )
    base = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_custkey") % 3).alias("store_id"),
        _epoch(orders, "o_orderdate").alias("order_ts"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "OPEN")
        .otherwise("PENDING")
        .alias("status"),
    )
    subtotal = F.coalesce(F.col("line_sum"), _long(0))
    return lookup_join(base, subtotals, ["order_id"], "left", hot_keys(base, ["order_id"])).select(
        "order_id",
        "customer_id",
        "store_id",
        "order_ts",
        "status",
        subtotal.alias("subtotal_cents"),
        _long(F.floor(subtotal * 18 / 100)).alias("tax_cents"),
        _long(F.when(F.col("order_id") % 10 == 0, 100).otherwise(0)).alias("discount_cents"),
    )


def _multiple(name: str, of: int) -> Column:
    return F.col(name) % of == 0


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = clean_lines(spark, sf_dir)
    first = F.col("line_id") == 1
    total = F.col("quantity") * F.col("unit_price_cents")
    plain = {
        "order_id": F.col("order_id"),
        "line_id": F.col("line_id"),
        "product_id": F.col("product_id"),
        "quantity": F.col("quantity"),
        "unit_price_cents": F.col("unit_price_cents"),
        "line_total_cents": total,
    }
    return _rows(
        lines,
        (
            None,
            plain
            | {
                "quantity": F.when(_multiple("order_id", 307) & first, _long(0)).otherwise(
                    F.col("quantity")
                ),
                "line_total_cents": total
                + F.when(_multiple("order_id", 101) & first, _long(1)).otherwise(_long(0)),
            },
        ),
        (_multiple("order_id", 401) & first, plain | {"order_id": -F.col("order_id") - 1}),
        (_multiple("order_id", 701) & (F.col("line_id") == 2), plain),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = clean_orders(spark, sf_dir)
    total = F.col("subtotal_cents") + F.col("tax_cents") - F.col("discount_cents")
    plain = {name: F.col(name) for name in base.columns} | {
        "total_cents": total,
        "currency": F.lit("INR"),
    }
    return _rows(
        base,
        (
            None,
            plain
            | {
                "total_cents": total
                + F.when(_multiple("order_id", 97), _long(1)).otherwise(_long(0)),
                "currency": F.when(_multiple("order_id", 113), "EUR").otherwise("INR"),
            },
        ),
        (_multiple("order_id", 499), plain),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("order_id")
    return _rows(
        clean_orders(spark, sf_dir),
        (
            None,
            {
                "payment_id": order,
                "order_id": F.when(_multiple("order_id", 211), -order - 1).otherwise(order),
                "amount_cents": F.col("subtotal_cents")
                + F.col("tax_cents")
                - F.col("discount_cents"),
                "status": F.when(_multiple("order_id", 103), "AUTHORIZED").otherwise(
                    "CAPTURED"
                ),
            },
        ),
        (
            _multiple("order_id", 607),
            {
                "payment_id": order,
                "order_id": order,
                "amount_cents": _long(0),
                "status": F.lit("AUTHORIZED"),
            },
        ),
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line = F.col("order_id"), F.col("line_id")
    returned = clean_lines(spark, sf_dir).filter(F.col("return_flag") == "R")
    plain = {
        "return_id": order * 100 + line,
        "order_id": order,
        "line_id": line,
        "quantity": _long(1),
        "refund_cents": F.col("unit_price_cents"),
    }
    return _rows(
        returned,
        (
            _multiple("order_id", 17) | _multiple("order_id", 331) | _multiple("order_id", 269),
            plain
            | {
                "order_id": F.when(_multiple("order_id", 331), -order - 7).otherwise(order),
                "quantity": F.when(_multiple("order_id", 51), F.col("quantity") + 1)
                .when(_multiple("order_id", 269), _long(0))
                .otherwise(_long(1)),
                "refund_cents": F.when(
                    _multiple("order_id", 85), _long(100_000_000_000)
                ).otherwise(F.col("unit_price_cents")),
            },
        ),
        (_multiple("order_id", 119), plain),
    )


def inventory_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"))
    # At most five residues (a remainder of 3 keeps its sign): a bounded array, not a join.
    stores = given(spark, sf_dir, "orders").agg(
        F.collect_set(F.col("o_custkey") % 3).alias("stores")
    )
    opening = {
        "product_id": F.col("part"),
        "reason": F.lit("OPENING"),
        "movement_ts": _long(OPENING_TS),
    }
    per_store = (
        part.withColumn("store", F.explode(stores.scalar()))
        .select(
            (-(F.col("part") * 3 + F.col("store")) - 1).alias("movement_id"),
            opening["product_id"].alias("product_id"),
            F.col("store").alias("store_id"),
            _long(F.when(_multiple("part", 29), 5).otherwise(1_000_000)).alias("quantity_delta"),
            opening["reason"].alias("reason"),
            opening["movement_ts"].alias("movement_ts"),
        )
    )
    repeated = part.filter(_multiple("part", 59)).select(
        (-(F.col("part") * 3) - 1).alias("movement_id"),
        opening["product_id"].alias("product_id"),
        _long(100).alias("store_id"),
        _long(0).alias("quantity_delta"),
        opening["reason"].alias("reason"),
        opening["movement_ts"].alias("movement_ts"),
    )
    lines = clean_lines(spark, sf_dir)
    rows = lines.count()
    sold = lookup_join(
        lines.select("order_id", "line_id", "product_id", "quantity", "return_flag"),
        clean_orders(spark, sf_dir).select("order_id", "store_id", "order_ts"),
        ["order_id"],
        "inner",
        hot_keys(lines, ["order_id"], rows=rows),
        tasks_for(spark, rows),
    )
    number = F.col("order_id") * 100 + F.col("line_id")
    sale = {
        "movement_id": number,
        "product_id": F.col("product_id"),
        "store_id": F.col("store_id"),
        "quantity_delta": -F.col("quantity"),
        "reason": F.lit("SALE"),
        "movement_ts": F.col("order_ts"),
    }
    moved = _rows(
        sold,
        (None, sale),
        (
            (F.col("return_flag") == "R") & _multiple("order_id", 17),
            sale
            | {
                "movement_id": -number - 100_000_000,
                "quantity_delta": _long(1),
                "reason": F.lit("RETURN"),
                "movement_ts": F.col("order_ts") + 5,
            },
        ),
    )
    return per_store.unionByName(repeated).unionByName(moved)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ~_multiple("p_partkey", 97)
    even = _multiple("p_partkey", 2)
    nothing = F.lit(None).cast("bigint")

    def version(category: Column, start: int, end: Column, loaded: Column) -> dict[str, Column]:
        return {
            "product_id": F.col("p_partkey"),
            "category": category,
            "effective_from": _long(start),
            "effective_to": end,
            "loaded_at": loaded,
        }

    return _rows(
        given(spark, sf_dir, "part"),
        (
            kept,
            version(
                F.col("p_type"),
                FIRST_EFFECTIVE,
                F.when(even, _long(SECOND_EFFECTIVE)),
                _long(FIRST_EFFECTIVE),
            ),
        ),
        (
            kept & even,
            version(
                F.concat(F.lit("V2-"), F.col("p_type")),
                SECOND_EFFECTIVE,
                nothing,
                _long(
                    F.when(_multiple("p_partkey", 83), NOT_YET_KNOWN).otherwise(
                        SECOND_EFFECTIVE
                    )
                ),
            ),
        ),
        (
            _multiple("p_partkey", 89),
            version(
                F.lit("overlap"), FIRST_EFFECTIVE + 1, nothing, _long(FIRST_EFFECTIVE + 1)
            ),
        ),
        (
            _multiple("p_partkey", 79),
            version(F.lit("dup"), FIRST_EFFECTIVE, nothing, _long(FIRST_EFFECTIVE)),
        ),
    )


DERIVED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders": orders,
    "order_lines": order_lines,
    "payments": payments,
    "returns": returns,
    "inventory_movements": inventory_movements,
    "products": products,
}


class _WrittenTables(dict):
    """Six tables, each derived and written when a query first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__({name: None for name in DERIVED})
        self._origin = (spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        spark, sf_dir = self._origin
        return written(spark, sf_dir, name, DERIVED[name])


class StarBatch(Batch):
    """The faulted batch derived from the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__({name: None for name in DERIVED}, KNOWLEDGE_TIME)
        self.tables = _WrittenTables(spark, sf_dir)

    def materialise(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in DERIVED}


def faulted_batch(spark: SparkSession, sf_dir: str) -> StarBatch:
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _batches:
        _batches[slot] = StarBatch(spark, sf_dir)
    return _batches[slot]


def action_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifecycle actions read off the event stream, ordered by `seq` (seconds tie)."""
    events = given(spark, sf_dir, "events")
    user, event = F.col("user_id"), F.col("event_id")
    return events.select(
        (user % 10).alias("pointer_id"),
        user.alias("batch_id"),
        event.alias("seq"),
        _epoch(events, "ts").alias("ts"),
        F.when(F.col("event_type") == "signup", "register")
        .when(F.col("event_type") == "view", "start_build")
        .when(F.col("event_type") == "click", "validate")
        .when(F.col("event_type") == "purchase", "publish")
        .otherwise("fail")
        .alias("action"),
        F.concat(
            F.when(event % 11 == 0, "d2-").otherwise("d1-"), user.cast("string")
        ).alias("manifest_digest"),
        F.concat(
            F.lit("loc-"), F.when(event % 13 == 0, "1").otherwise("0")
        ).alias("manifest_version_id"),
        (event % 4).alias("expected_pointer_version"),
    )
