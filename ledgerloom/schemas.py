"""The six retail tables: columns, identity keys and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Declared, never inferred: an all-null effective_to would be inferred as string.
SCHEMAS: dict[str, T.StructType] = {
    "orders": _table(
        ("order_id", STRING),
        ("customer_id", STRING),
        ("store_id", STRING),
        ("order_ts", LONG),
        ("status", STRING),
        ("subtotal_cents", LONG),
        ("tax_cents", LONG),
        ("discount_cents", LONG),
        ("total_cents", LONG),
        ("currency", STRING),
    ),
    "order_lines": _table(
        ("order_id", STRING),
        ("line_id", STRING),
        ("product_id", STRING),
        ("quantity", LONG),
        ("unit_price_cents", LONG),
        ("line_total_cents", LONG),
    ),
    "payments": _table(
        ("payment_id", STRING),
        ("order_id", STRING),
        ("amount_cents", LONG),
        ("status", STRING),
    ),
    "returns": _table(
        ("return_id", STRING),
        ("order_id", STRING),
        ("line_id", STRING),
        ("quantity", LONG),
        ("refund_cents", LONG),
    ),
    "inventory_movements": _table(
        ("movement_id", STRING),
        ("product_id", STRING),
        ("store_id", STRING),
        ("quantity_delta", LONG),
        ("reason", STRING),
        ("movement_ts", LONG),
    ),
    "products": _table(
        ("product_id", STRING),
        ("category", STRING),
        ("effective_from", LONG),
        ("effective_to", LONG),
        ("loaded_at", LONG),
    ),
}

TABLES: tuple[str, ...] = tuple(SCHEMAS)

IDENTITY_KEYS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id",),
    "order_lines": ("order_id", "line_id"),
    "payments": ("payment_id",),
    "returns": ("return_id",),
    "inventory_movements": ("movement_id",),
    "products": ("product_id", "effective_from", "loaded_at"),
}

# The words each table's duplicate message uses.
ENTITY_NAMES: dict[str, str] = {
    "orders": "order",
    "order_lines": "line",
    "payments": "payment",
    "returns": "return",
    "inventory_movements": "movement",
    "products": "product",
}

# The domains the gates test.
COMPLETED = "COMPLETED"
CAPTURED = "CAPTURED"
CURRENCIES = ("INR", "USD")
CONTRACT_VERSION = "retail-v2"

# Violation code -> message.
MESSAGES: dict[str, str] = {
    "INVALID_LINE": "quantity and price must be valid",
    "LINE_TOTAL": "line total is not quantity * price",
    "ORDER_SUBTOTAL": "line sum differs from subtotal",
    "ORDER_TOTAL": "financial equation does not balance",
    "CURRENCY": "unsupported currency",
    "ORPHAN_PAYMENT": "order is missing",
    "UNDERPAID": "captured payment is below order total",
    "ORPHAN_RETURN": "order line is missing",
    "INVALID_RETURN": "return values must be positive",
    "RETURN_QUANTITY": "returned quantity exceeds ordered",
    "EXCESS_REFUND": "refund exceeds captured payment",
    "NEGATIVE_INVENTORY": "stock fell below zero",
    "ORPHAN_LINE": "order is missing",
    "MISSING_DIMENSION": "no knowable product version for order time",
    "AMBIGUOUS_DIMENSION": "multiple knowable product versions overlap at order time",
}

VIOLATION = T.StructType(
    [
        T.StructField("code", STRING),
        T.StructField("entity_id", STRING),
        T.StructField("message", STRING),
    ]
)

OBJECT_PROOF = _table(
    ("bucket", STRING),
    ("key", STRING),
    ("version_id", STRING),
    ("size_bytes", LONG),
    ("sha256", STRING),
    ("etag", STRING),
)

TABLE_PROOF = T.StructType(
    [
        T.StructField("rows", LONG),
        T.StructField("sha256", STRING),
        T.StructField("objects", T.ArrayType(OBJECT_PROOF)),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("batch_id", STRING),
        T.StructField("contract_version", STRING),
        T.StructField("produced_at", LONG),
        T.StructField("as_of_knowledge_time", LONG),
        T.StructField("tables", T.MapType(STRING, TABLE_PROOF)),
        T.StructField("identity_digest", STRING),
    ]
)
