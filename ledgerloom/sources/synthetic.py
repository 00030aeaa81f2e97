"""Deterministic synthetic retail batches, and faults to put into any batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.batch import Batch

# Fixed values of the workload.
START_TS = 1_700_000_000
PRODUCTS = 20
STORES = 3
CATEGORIES = ("grocery", "home", "electronics")
DAY = 86_400
HOUR = 3_600
ORDER_SPACING = 10
PRICES, PRICE_STEP, LOWEST_PRICE = 50, 37, 1000
DISCOUNT_EVERY, DISCOUNT_CENTS = 10, 100
RETURN_EVERY, RETURN_DELAY = 17, 5
LEAST_OPENING, OPENING_PER_ORDER = 100, 4
FAULTS = (
    "broken_total",
    "excess_refund",
    "missing_product",
    "overlapping_version",
    "negative_stock",
)


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _draw(index: Column, seed: int, salt: Column | int) -> Column:
    """0, 1 or 2: a multiply-and-take-the-high-digits hash of (seed, index, salt) in bigint range."""
    salted = salt if isinstance(salt, Column) else _long(salt)
    mixed = (index % 1_000_003) * 48_271 + salted * 69_621 + _long(seed % 65_536) * 16_807 + 11
    once = (mixed % 2_147_483_647) * 48_271 % 2_147_483_647
    return F.call_function("div", once, _long(1_024)) % 3


def _padded(prefix: str, value: Column, width: int) -> Column:
    text = value.cast("string")
    return F.concat(
        F.lit(prefix), F.repeat(F.lit("0"), F.greatest(F.lit(0), width - F.length(text))), text
    )


def _product(number: Column) -> Column:
    return _padded("p-", number, 3)


def synthetic_batch(
    indexes: DataFrame, order_count: int, *, seed: int = 21, knowledge_time: int = START_TS + 100_000
) -> Batch:
    """A clean batch with one order per row of `indexes` (a bigint column `index` from 0 on).

    Everything about an order follows from its index and the seed, so any partitioning of the
    indexes, and any recomputation, gives the same batch. Use spark.range(n) for a workload of n.
    """
    index = F.col("index")
    customers = max(5, order_count // 5)
    heads = indexes.select(
        index,
        _padded("o-", index, 8).alias("order_id"),
        _padded("s-", index % STORES + 1, 2).alias("store_id"),
        (index * ORDER_SPACING + START_TS).alias("order_ts"),
        (_draw(index, seed, 0) + 1).alias("line_count"),
    )
    step = F.col("step")
    lines = heads.withColumn(
        "step", F.explode(F.sequence(_long(0), F.col("line_count") - 1))
    ).select(
        index,
        "step",
        "order_id",
        "store_id",
        "order_ts",
        F.concat(F.lit("l-"), (step + 1).cast("string")).alias("line_id"),
        _product((index * 3 + step) % PRODUCTS + 1).alias("product_id"),
        (_draw(index, seed, step + 1) + 1).alias("quantity"),
        ((index + step) % PRICES * PRICE_STEP + LOWEST_PRICE).alias("unit_price_cents"),
    )
    # Three lines at most: the subtotal is an expression over the order row, not an aggregate.
    per_line = F.transform(
        F.sequence(_long(0), F.col("line_count") - 1),
        lambda line: (_draw(index, seed, line + 1) + 1) * ((index + line) % PRICES * PRICE_STEP + LOWEST_PRICE),
    )
    subtotal = F.aggregate(per_line, _long(0), lambda total, value: total + value)
    tax = F.call_function("div", F.col("subtotal_cents") * 18, _long(100))
    orders = (
        heads.withColumn("subtotal_cents", subtotal)
        .withColumn("tax_cents", tax)
        .withColumn("discount_cents", F.when(index % DISCOUNT_EVERY == 0, _long(DISCOUNT_CENTS)).otherwise(_long(0)))
        .select(
            index,
            "order_id",
            _padded("c-", index % customers, 5).alias("customer_id"),
            "store_id",
            "order_ts",
            F.lit("COMPLETED").alias("status"),
            "subtotal_cents",
            "tax_cents",
            "discount_cents",
            (F.col("subtotal_cents") + F.col("tax_cents") - F.col("discount_cents")).alias(
                "total_cents"
            ),
            F.lit("INR").alias("currency"),
        )
    )
    payments = orders.select(
        _padded("pay-", index, 8).alias("payment_id"),
        "order_id",
        F.col("total_cents").alias("amount_cents"),
        F.lit("CAPTURED").alias("status"),
    )
    returned = lines.filter((index % RETURN_EVERY == 0) & (step == 0))
    returns = returned.select(
        _padded("ret-", index, 8).alias("return_id"),
        "order_id",
        "line_id",
        _long(1).alias("quantity"),
        F.col("unit_price_cents").alias("refund_cents"),
    )
    spark = indexes.sparkSession
    numbers = spark.range(1, PRODUCTS + 1).withColumnRenamed("id", "number")
    products = numbers.select(
        _product(F.col("number")).alias("product_id"),
        F.element_at(
            F.array(*[F.lit(name) for name in CATEGORIES]), (F.col("number") % 3 + 1).cast("int")
        ).alias("category"),
        _long(START_TS - DAY).alias("effective_from"),
        F.lit(None).cast("bigint").alias("effective_to"),
        _long(START_TS - HOUR).alias("loaded_at"),
    )
    store = _padded("s-", F.col("store"), 2)
    opening = numbers.withColumn("store", F.explode(F.sequence(_long(1), _long(STORES)))).select(
        F.concat_ws("-", F.lit("opening"), _product(F.col("number")), store).alias("movement_id"),
        _product(F.col("number")).alias("product_id"),
        store.alias("store_id"),
        _long(max(LEAST_OPENING, order_count * OPENING_PER_ORDER)).alias("quantity_delta"),
        F.lit("OPENING").alias("reason"),
        _long(START_TS - 1).alias("movement_ts"),
    )

    def moved(rows: DataFrame, reason: str, delta: Column, delay: int) -> DataFrame:
        return rows.select(
            F.concat_ws("-", F.lit(reason.lower()), F.col("order_id"), F.col("line_id")).alias(
                "movement_id"
            ),
            "product_id",
            "store_id",
            delta.alias("quantity_delta"),
            F.lit(reason).alias("reason"),
            (F.col("order_ts") + delay).alias("movement_ts"),
        )

    movements = opening.unionByName(
        moved(lines, "SALE", -F.col("quantity"), 0)
    ).unionByName(moved(returned, "RETURN", _long(1), RETURN_DELAY))
    return Batch(
        {
            "orders": orders.drop("index"),
            "order_lines": lines.select(
                "order_id",
                "line_id",
                "product_id",
                "quantity",
                "unit_price_cents",
                (F.col("quantity") * F.col("unit_price_cents")).alias("line_total_cents"),
            ),
            "payments": payments,
            "returns": returns,
            "inventory_movements": movements,
            "products": products,
        },
        knowledge_time,
    )


def expected_results(batch: Batch) -> DataFrame:
    """What a query on the published batch must return: order count and gross cents."""
    return batch["orders"].agg(
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("total_cents"), _long(0)).alias("gross_cents"),
    )


def _first(frame: DataFrame, *keys: str) -> DataFrame:
    """The row with the least key, as a one-row frame."""
    return frame.orderBy(*keys).limit(1)


def inject_fault(batch: Batch, fault: str) -> Batch:
    """The batch with one named fault; the faulted row is the one with the least key."""
    orders, lines = batch["orders"], batch["order_lines"]
    first_order = F.broadcast(_first(orders, "order_id").select("order_id").distinct())
    if fault == "broken_total":
        hit = F.col("hit").isNotNull()
        marked = orders.join(first_order.withColumn("hit", F.lit(1)), "order_id", "left")
        total = F.when(hit, F.col("total_cents") + 1).otherwise(F.col("total_cents"))
        return batch.replace(
            orders=marked.withColumn("total_cents", total).select(*orders.columns)
        )
    if fault == "excess_refund":
        kinds = dict(batch["returns"].dtypes)
        bad = (
            lines.join(F.broadcast(_first(orders, "order_id")), "order_id")
            .orderBy("order_id", "line_id")
            .limit(1)
            .select(
                F.lit("ret-excess" if kinds["return_id"] == "string" else -1)
                .cast(kinds["return_id"])
                .alias("return_id"),
                "order_id",
                "line_id",
                _long(1).alias("quantity"),
                (F.col("total_cents") + 1).alias("refund_cents"),
            )
        )
        return batch.replace(returns=batch["returns"].unionByName(bad))
    if fault == "missing_product":
        sold = F.broadcast(_first(lines, "order_id", "line_id").select("product_id"))
        return batch.replace(products=batch["products"].join(sold, "product_id", "left_anti"))
    if fault == "overlapping_version":
        products = batch["products"]
        overlap = _first(products, "product_id", "effective_from", "loaded_at").select(
            "product_id",
            F.lit("overlapping-version").alias("category"),
            (F.col("effective_from") + 1).alias("effective_from"),
            "effective_to",
            (F.col("loaded_at") + 1).alias("loaded_at"),
        )
        return batch.replace(products=products.unionByName(overlap))
    if fault == "negative_stock":
        kinds = dict(batch["inventory_movements"].dtypes)
        bad = (
            lines.join(F.broadcast(_first(orders, "order_id")), "order_id")
            .orderBy("order_id", "line_id")
            .limit(1)
            .select(
                F.lit("negative-stock" if kinds["movement_id"] == "string" else 0)
                .cast(kinds["movement_id"])
                .alias("movement_id"),
                "product_id",
                "store_id",
                _long(-1_000_000).alias("quantity_delta"),
                F.lit("CORRUPTION").alias("reason"),
                (F.col("order_ts") + 1).alias("movement_ts"),
            )
        )
        return batch.replace(
            inventory_movements=batch["inventory_movements"].unionByName(bad)
        )
    raise ValueError(f"unknown fault: {fault}")


def stale_object(objects: DataFrame, table: str, version_id: str) -> DataFrame:
    """Declared objects with one table's version replaced while its old evidence is kept."""
    hit = F.col("table_name") == table
    return objects.withColumn(
        "version_id", F.when(hit, F.lit(version_id)).otherwise(F.col("version_id"))
    )
