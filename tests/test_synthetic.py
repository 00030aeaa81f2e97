from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators.fingerprint import table_fingerprints
from ledgerloom.plans.report import violated_codes, violation_report
from ledgerloom.schemas import SCHEMAS
from ledgerloom.sources.synthetic import FAULTS, inject_fault, synthetic_batch


def indexes(spark, count):
    return spark.range(count).withColumnRenamed("id", "index")


@pytest.fixture(scope="module")
def batch(spark):
    return synthetic_batch(indexes(spark, 60), 60)


def test_schemas_are_the_declared_ones(batch):
    for name, schema in SCHEMAS.items():
        assert [(f.name, f.dataType) for f in batch[name].schema] == [
            (f.name, f.dataType) for f in schema
        ]


def test_partitioning_does_not_matter_and_the_seed_does(spark, batch):
    one = {row["table_name"]: row["fingerprint"] for row in table_fingerprints(batch.tables).collect()}
    again = synthetic_batch(indexes(spark, 60).repartition(7), 60)
    other = synthetic_batch(indexes(spark, 60), 60, seed=22)
    assert one == {r["table_name"]: r["fingerprint"] for r in table_fingerprints(again.tables).collect()}
    changed = {r["table_name"]: r["fingerprint"] for r in table_fingerprints(other.tables).collect()}
    assert changed["order_lines"] != one["order_lines"] and changed["products"] == one["products"]


def test_draws_are_spread(spark):
    lines = synthetic_batch(indexes(spark, 3000), 3000)["order_lines"]
    per_order = lines.groupBy("order_id").count().groupBy("count").agg(F.count("*").alias("n"))
    sizes = {row["count"]: row["n"] for row in per_order.collect()}
    assert set(sizes) == {1, 2, 3} and min(sizes.values()) > 800
    quantities = {row["quantity"]: row["count"] for row in lines.groupBy("quantity").count().collect()}
    assert set(quantities) == {1, 2, 3} and min(quantities.values()) > 1600


# The codes each fault must give.
CODES = {
    "broken_total": "ORDER_TOTAL,UNDERPAID",
    "excess_refund": "EXCESS_REFUND",
    "missing_product": "MISSING_DIMENSION",
    "overlapping_version": "AMBIGUOUS_DIMENSION",
    "negative_stock": "NEGATIVE_INVENTORY",
}


def test_clean_batch_passes(batch):
    assert violation_report(batch).isEmpty()


@pytest.mark.parametrize("fault", FAULTS)
def test_fault_gives_its_code(batch, fault):
    codes = set(violated_codes(violation_report(inject_fault(batch, fault))).first()["codes"].split(","))
    expected = set(CODES[fault].split(","))
    # A refund on a line already returned may exceed its quantity too.
    assert expected <= codes <= expected | {"RETURN_QUANTITY"}


def test_orders_of_one_small_file_are_dealt_out(spark, tmp_path, monkeypatch):
    keys = [5, 5, None, *range(7, 104)]
    pq.write_table(pa.table({"o_orderkey": pa.array(keys, pa.int64())}), tmp_path / "orders.parquet")
    whole = catalog._synthetic(spark, str(tmp_path))
    monkeypatch.setattr(catalog, "ORDERS_PER_FILE", 20)
    dealt = catalog._synthetic(spark, str(tmp_path))
    for name in ("orders", "order_lines", "inventory_movements"):
        assert sorted(map(str, dealt[name].collect())) == sorted(map(str, whole[name].collect()))
    assert whole["orders"].rdd.getNumPartitions() == 1
    assert 1 < dealt["orders"].rdd.getNumPartitions() <= 5
