"""Every catalog query against its SQL on the given tables, and the driver contract."""

from __future__ import annotations

import importlib

import pytest

from ledgerloom.catalog import QUERIES
from ledgerloom.oracles import ORACLES
from oracle_check import connect, difference

# Reading the report once is enough here: its other queries are compared by oracle_check.py.
HEAVY = {"violation_report", "violated_codes", "is_violated"}


@pytest.fixture(scope="module")
def database(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY))
def test_query_equals_sql(spark, small, database, name):
    assert difference(QUERIES[name](spark, small), database, ORACLES[name]) is None


def test_entry(spark):
    contract = importlib.import_module("__spark_entry__")
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    frame = contract.entry(spark)
    assert frame.columns == ["code", "violations"]


def test_derivation_ignores_the_session_time_zone(spark, small, database):
    from ledgerloom.sources.star_tables import action_log

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        sql = ORACLES["latest_snapshot"]
        assert difference(QUERIES["latest_snapshot"](spark, small), database, sql) is None
        assert action_log(spark, small).schema["ts"].dataType.typeName() == "long"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
