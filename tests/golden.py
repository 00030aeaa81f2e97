"""The small golden batch as plain tuples, drawn row by row from one random stream."""

from __future__ import annotations

import random

import pyarrow as pa

from ledgerloom.batch import Batch
from ledgerloom.schemas import SCHEMAS, STRING
from ledgerloom.skew import DEFAULT_POLICY, SkewPolicy

START = 1_700_000_000
KNOWLEDGE = 1_700_100_000


def golden_rows(orders: int = 30, seed: int = 21) -> dict[str, list[tuple]]:
    draw = random.Random(seed)
    names = [f"p-{number:03d}" for number in range(1, 21)]
    kinds = ("grocery", "home", "electronics")
    rows: dict[str, list[tuple]] = {table: [] for table in SCHEMAS}
    rows["products"] = [
        (name, kinds[number % 3], START - 86_400, None, START - 3_600)
        for number, name in enumerate(names, start=1)
    ]
    rows["inventory_movements"] = [
        (f"opening-{name}-s-0{store}", name, f"s-0{store}", max(100, orders * 4), "OPENING", START - 1)
        for name in names
        for store in (1, 2, 3)
    ]
    for at in range(orders):
        order, store, when = f"o-{at:08d}", f"s-0{at % 3 + 1}", START + at * 10
        lines = []
        for place in range(1 + draw.randrange(3)):
            quantity, price = 1 + draw.randrange(3), 1000 + (at + place) % 50 * 37
            name = names[(at * 3 + place) % 20]
            lines.append((order, f"l-{place + 1}", name, quantity, price, quantity * price))
        subtotal = sum(line[5] for line in lines)
        tax, discount = subtotal * 18 // 100, 100 * (at % 10 == 0)
        total = subtotal + tax - discount
        customer = f"c-{at % max(5, orders // 5):05d}"
        rows["orders"].append(
            (order, customer, store, when, "COMPLETED", subtotal, tax, discount, total, "INR")
        )
        rows["order_lines"] += lines
        rows["payments"].append((f"pay-{at:08d}", order, total, "CAPTURED"))
        sold = [
            (f"sale-{order}-{line[1]}", line[2], store, -line[3], "SALE", when) for line in lines
        ]
        rows["inventory_movements"] += sold
        if at % 17 == 0:
            first = lines[0]
            rows["returns"].append((f"ret-{at:08d}", order, first[1], 1, first[4]))
            rows["inventory_movements"].append(
                (f"return-{order}-{first[1]}", first[2], store, 1, "RETURN", when + 5)
            )
    return rows


def as_batch(
    spark, rows: dict[str, list[tuple]], policy: SkewPolicy = DEFAULT_POLICY, knowledge=KNOWLEDGE
) -> Batch:
    frames = {}
    for name, schema in SCHEMAS.items():
        columns = list(zip(*rows[name])) or [()] * len(schema.names)
        kinds = [pa.string() if field.dataType == STRING else pa.int64() for field in schema.fields]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        frames[name] = spark.createDataFrame(pa.table(arrays, names=schema.names), schema)
    return Batch(frames, knowledge, policy)


def changed(rows: dict[str, list[tuple]], table: str, place: int, **values) -> dict[str, list[tuple]]:
    """A copy with some columns of one row replaced."""
    names = SCHEMAS[table].names
    row = dict(zip(names, rows[table][place]), **values)
    copy = {name: list(table_rows) for name, table_rows in rows.items()}
    copy[table][place] = tuple(row[name] for name in names)
    return copy


def added(rows: dict[str, list[tuple]], table: str, *more: tuple) -> dict[str, list[tuple]]:
    copy = {name: list(table_rows) for name, table_rows in rows.items()}
    copy[table] += list(more)
    return copy


def side_by_side(cases: dict[str, dict[str, list[tuple]]]) -> dict[str, list[tuple]]:
    """Several batches as one: every id gets its case's name in front, so they do not interact."""
    merged: dict[str, list[tuple]] = {name: [] for name in SCHEMAS}
    for case, rows in cases.items():
        for table, schema in SCHEMAS.items():
            is_id = [name.endswith("_id") for name in schema.names]
            merged[table] += [
                tuple(
                    f"{case}|{value}" if marked and value is not None else value
                    for marked, value in zip(is_id, row)
                )
                for row in rows[table]
            ]
    return merged
