"""Hot-key paths must return exactly what the plain paths return."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from golden import START, added, as_batch, golden_rows
from ledgerloom import skew
from ledgerloom.batch import Batch
from ledgerloom.catalog import SPLIT
from ledgerloom.operators import gates, lifecycle, temporal
from ledgerloom.operators.inventory import running_stock
from ledgerloom.plans.report import violation_report
from ledgerloom.skew import SkewPolicy, hot_keys, lookup_join, running_sums
from ledgerloom.sources.star_tables import action_log, faulted_batch

EVERYTHING_HOT = SkewPolicy(hot_rows=1, sample_fraction=1.0)
SOME_HOT = SkewPolicy(hot_rows=40, sample_fraction=1.0)


def rows_of(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=repr)


def skewed(spark, rows=3000):
    draw = random.Random(5)
    data = [
        (
            draw.choice(["hot"] * 2 + [None] + [f"k{n}" for n in range(40)]),
            draw.randrange(50),
            number,
            draw.randrange(-5, 6) if draw.random() > 0.05 else None,
        )
        for number in range(rows)
    ]
    return spark.createDataFrame(data, "k string, ts bigint, id bigint, v bigint")


@pytest.mark.parametrize("policy", [EVERYTHING_HOT, SOME_HOT])
def test_running_sums_split_hot_keys(spark, policy):
    frame = skewed(spark)
    sums = {"total": F.col("v"), "seen": F.lit(1).cast("bigint")}
    plain = running_sums(frame, ["k"], ["ts", "id"], sums)
    hot = hot_keys(frame, ["k"], policy)
    assert hot is not None
    assert rows_of(running_sums(frame, ["k"], ["ts", "id"], sums, hot)) == rows_of(plain)


def test_running_sums_within_one_instant(spark):
    """All rows share key and time: only the id orders them, and slices still divide them."""
    frame = spark.range(5000).select(
        F.lit("k").alias("k"), F.lit(1).alias("ts"), "id", (F.col("id") % 7 - 3).alias("v")
    )
    hot = hot_keys(frame, ["k"], EVERYTHING_HOT)
    sums = {"total": F.col("v")}
    assert rows_of(running_sums(frame, ["k"], ["ts", "id"], sums, hot)) == rows_of(
        running_sums(frame, ["k"], ["ts", "id"], sums)
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("policy", [EVERYTHING_HOT, SOME_HOT])
def test_lookup_join_splits_hot_keys(spark, how, policy):
    frame = skewed(spark)
    lookup = spark.createDataFrame(
        [Row(k=k, w=n) for n, k in enumerate(["hot", "k1", "k2", "absent", None])]
    )
    hot = hot_keys(frame, ["k"], policy)
    assert rows_of(lookup_join(frame, lookup, ["k"], how, hot)) == rows_of(
        lookup_join(frame, lookup, ["k"], how)
    )


def test_the_split_queries_have_few_hot_keys_at_any_size(spark):
    """Every key has rows enough to be hot; only the heaviest of a fixed number are, and no row changes."""
    frame = spark.range(40_000).select(
        F.when(F.col("id") < 500, 1).otherwise(F.col("id") % 3_000).alias("k"), "id", F.lit(2).alias("v")
    )
    hot = hot_keys(frame, ["k"], SPLIT)
    assert hot.count() == SPLIT.most_keys < 3_000
    assert hot.filter("k = 1").count() == 1
    sums = {"total": F.col("v")}
    assert rows_of(running_sums(frame, ["k"], ["id"], sums, hot)) == rows_of(
        running_sums(frame, ["k"], ["id"], sums)
    )


@pytest.mark.parametrize("table, keys", [("inventory_movements", ["product_id", "store_id"])])
def test_small_tables_still_take_both_paths(spark, small, table, keys):
    movements = faulted_batch(spark, small)[table]
    hot = hot_keys(movements, keys, SPLIT)
    assert 0 < hot.count() <= SPLIT.most_keys < movements.select(*keys).distinct().count()


def test_few_rows_have_no_hot_keys(spark):
    assert hot_keys(skewed(spark, 100), ["k"]) is None


def test_report_with_a_third_of_all_rows_on_one_key(spark):
    rows = golden_rows(20)
    order, line = rows["orders"][0], rows["order_lines"][0]
    rows = added(rows, "orders", *[order] * 12)
    rows = added(rows, "order_lines", *[line] * 25)
    rows = added(rows, "payments", *[(f"x{n}", order[0], 1, "CAPTURED") for n in range(15)])
    rows = added(rows, "payments", *[(f"n{n}", None, 1, "CAPTURED") for n in range(15)])
    rows = added(rows, "returns", *[(f"r{n}", order[0], line[1], 1, 1) for n in range(30)])
    rows = added(
        rows,
        "inventory_movements",
        *[(f"h{n:03d}", line[2], order[2], -7, "SALE", order[3] + n % 3) for n in range(60)],
    )
    plain = as_batch(spark, rows)
    split = as_batch(spark, rows, SkewPolicy(hot_rows=5, sample_fraction=1.0))
    assert split.hot("payments", "order_id") is not None
    assert rows_of(violation_report(split)) == rows_of(violation_report(plain))
    assert rows_of(running_stock(split)) == rows_of(running_stock(plain))
    separate = [row for gate in gates.GATES.values() for row in rows_of(gate(split))]
    assert sorted(separate, key=repr) == rows_of(violation_report(plain))


def in_force(event, versions, knowledge):
    """Plain match of one (product, moment) against (product, category, from, to, loaded) versions."""
    product, moment = event
    return [
        v
        for v in versions
        if None not in (product, moment, v[0], v[2], v[4])
        and v[0] == product
        and v[4] <= knowledge
        and v[2] <= moment
        and (v[3] is None or moment < v[3])
    ]


def test_repeated_events_are_counted_each_for_itself(spark, small):
    batch = faulted_batch(spark, small)
    events = temporal.line_events(batch)
    once = rows_of(temporal.dimension_matches(events, batch))
    twice = rows_of(temporal.dimension_matches(events.union(events), batch))
    assert twice == sorted(once * 2, key=repr)


def test_segments_at_their_edges(spark):
    """Touching, empty, reversed, unknown, repeated and null intervals."""
    from ledgerloom.batch import Batch
    from ledgerloom.schemas import SCHEMAS

    draw = random.Random(3)
    versions = [
        ("p", "a", 10, 20, 1),
        ("p", "b", 20, None, 1),
        ("p", "c", 30, 30, 1),
        ("p", "d", 40, 35, 1),
        ("p", "e", 50, None, 999),
        ("p", None, None, None, 1),
        (None, "f", 1, None, 1),
        ("q", "g", 5, 9, 2),
        ("q", "g", 5, 9, 2),
    ] + [
        (
            draw.choice("rst"),
            str(n),
            draw.randrange(30),
            draw.choice([None, draw.randrange(40)]),
            draw.randrange(12),
        )
        for n in range(40)
    ]
    orders = [(f"o{n}", None, None, n, None, 0, 0, 0, 0, "INR") for n in range(60)]
    orders.append(("onull", None, None, None, None, 0, 0, 0, 0, "INR"))
    lines = [
        (order[0], product or "-", product, 1, 1, 1)
        for order in orders
        for product in ["p", "q", "r", "s", "t", "zz", None]
    ]
    rows = {name: [] for name in SCHEMAS} | {
        "products": versions,
        "orders": orders,
        "order_lines": lines,
    }
    batch = as_batch(spark, rows, knowledge=10)
    events = temporal.line_events(batch)
    for row in temporal.dimension_matches(events, batch).collect():
        found = in_force((row["product_id"], row["order_ts"]), versions, 10)
        assert row["dimension_matches"] == len(found)
        version = tuple(row[name] for name in temporal.VERSION)
        assert version == (found[0][1:] if len(found) == 1 else (None,) * 4)
    matched = {}
    for row in temporal.temporal_match(events, batch).collect():
        key = (row["product_id"], row["order_ts"])
        matched.setdefault((row["order_id"], row["line_id"], *key), []).append(row["category"])
    for (_, _, *key), categories in matched.items():
        wanted = [v[1] for v in in_force(key, versions, 10)] or [None]
        assert sorted(map(str, categories)) == sorted(map(str, wanted))


def test_one_offer_that_most_attempts_wait_for(spark):
    log = [(0, n, n, "publish", None, None, 0 if n < 400 else n - 399) for n in range(420)]
    kind = (
        "pointer_id bigint, batch_id bigint, seq bigint, action string, manifest_digest string, "
        "manifest_version_id string, expected_pointer_version bigint"
    )
    frame = spark.createDataFrame(log, kind)
    version, wanted = 0, {}
    for _, _, seq, *_, expected in log:
        hit = expected == version
        version += hit
        wanted[seq] = version if hit else None
    for policy in (SkewPolicy(), EVERYTHING_HOT):
        found = {r["seq"]: r["pointer_version"] for r in lifecycle.pointer_cas(frame, policy).collect()}
        assert found == wanted


def test_the_report_reads_the_order_lines_once(spark, small):
    import re

    batch = faulted_batch(spark, small)
    frame = violation_report(batch)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "derived-" in plan and "line-facts" in plan
    assert not re.search(r"derived-\w+-order_lines", plan)
    facts = batch.kept("line-facts", None)
    assert facts.agg(F.sum("copies")).first()[0] == batch["order_lines"].count()
    assert plan.count("Exchange hashpartitioning") <= 16


def test_many_copies_of_a_violation(spark):
    from ledgerloom.plans import report

    rows = spark.createDataFrame([("a", 25_003), ("b", 0), ("c", 1)], "id string, n bigint")
    found = report._emit(rows, ("LINE_TOTAL", F.col("id"), F.col("n"))).groupBy("entity_id").count()
    assert {r["entity_id"]: r["count"] for r in found.collect()} == {"a": 25_003, "c": 1}


@pytest.mark.parametrize(
    "name",
    ["replay_classification", "identity_conflicts"],
)
def test_lifecycle_splits_hot_batches(spark, small, name):
    log = action_log(spark, small)
    operator = getattr(lifecycle, name)
    assert rows_of(operator(log, SOME_HOT)) == rows_of(operator(log))


def test_one_product_of_ten_thousand_versions(spark):
    """Directories of chunks: the same matches as by arithmetic, beside products of one version or none."""
    versions, begin = 10_000, START
    products = [("p-1", f"c{n}", begin + 10 * n, begin + 10 * n + 10, begin) for n in range(versions) if n % 7]
    products += [("p-1", "wide", begin + 500, begin + 520, begin), ("p-2", "only", begin, None, begin)]
    frame = spark.createDataFrame(
        products, "product_id string, category string, effective_from long, effective_to long, loaded_at long"
    )
    batch = as_batch(spark, golden_rows()).replace(products=frame)
    times = [begin - 1, begin, begin + 9, begin + 499, begin + 505, begin + 519, begin + 520, begin + 99_999, begin + 100_000]
    times += range(begin + 3, begin + 100_000, 1_237)
    events = [(n, "l", p, t) for p in ("p-1", "p-2", "p-3") for n, t in enumerate(times)] + [(0, "l", "p-1", None)]
    found = temporal.dimension_matches(
        spark.createDataFrame(events, "order_id long, line_id string, product_id string, order_ts long"), batch
    ).collect()
    assert len(found) == len(events)
    for row in found:
        t, expected = row["order_ts"], []
        if t is not None and row["product_id"] == "p-2":
            expected = ["only"] * (t >= begin)
        elif t is not None and row["product_id"] == "p-1":
            n = (t - begin) // 10
            expected = [f"c{n}"] * (0 <= n < versions and n % 7 > 0) + ["wide"] * (500 <= t - begin < 520)
        assert row["dimension_matches"] == len(expected)
        assert row["category"] == (expected[0] if len(expected) == 1 else None)


def test_search_finds_the_last_start(spark):
    rows = [([*range(0, 2 * n, 2)], t) for n in (0, 1, 2, 3, 126, 127, 128, 1000) for t in (-1, 0, 1, n, 2 * n - 2, 9999)]
    frame = spark.createDataFrame(rows, "starts array<long>, t long")
    for row in frame.select("starts", "t", temporal.search("starts", "t").alias("place")).collect():
        assert row["place"] == sum(s <= row["t"] for s in row["starts"]) - 1


def many_lines(spark):
    """Lines, some of them repeated, of orders that are all there; one order has half of the lines."""
    golden = as_batch(spark, golden_rows())
    kinds = golden["orders"].schema["order_id"].dataType
    number = spark.range(3000)
    order = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 400).cast(kinds)
    line = (F.col("id") % 900).cast(golden["order_lines"].schema["line_id"].dataType)
    lines = number.crossJoin(golden["order_lines"].limit(1).drop("order_id", "line_id")).select(
        order.alias("order_id"), line.alias("line_id"), *golden["order_lines"].drop("order_id", "line_id").columns
    )
    orders = spark.range(400).crossJoin(golden["orders"].limit(1).drop("order_id")).select(
        F.col("id").cast(kinds).alias("order_id"), *golden["orders"].drop("order_id").columns
    )
    return golden.replace(order_lines=lines.select(*golden["order_lines"].columns),
                          orders=orders.select(*golden["orders"].columns))


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(hot_rows=500, sample_fraction=1.0)])
def test_rows_by_key_go_to_as_many_tasks_as_they_ask_for(spark, monkeypatch, policy):
    def found():
        made = many_lines(spark)
        batch = Batch(made.tables, made.knowledge_time, policy)
        events = temporal.line_events(batch)
        frames = [events, gates.gate_duplicate_id(batch), running_stock(batch), violation_report(batch)]
        return events.rdd.getNumPartitions(), [rows_of(frame) for frame in frames]

    _, plain = found()
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    tasks, dealt = found()
    assert dealt == plain and dealt[0] and dealt[1]
    # With a hot order the two parts meet in one more exchange.
    assert tasks >= 30 or policy.hot_rows == 500
