"""The lifecycle operators against a plain replay of random logs."""

from __future__ import annotations

import random

import pytest

from ledgerloom.operators import lifecycle
from ledgerloom.schemas import TABLES
from ledgerloom.skew import DEFAULT_POLICY, SkewPolicy

COLUMNS = (
    "pointer_id bigint, batch_id bigint, seq bigint, action string, manifest_digest string, "
    "manifest_version_id string, expected_pointer_version bigint"
)
MOVES = {
    ("register", "UNREGISTERED"): "REGISTERED",
    ("start_build", "REGISTERED"): "BUILDING",
    ("start_build", "FAILED"): "BUILDING",
    ("validate", "BUILDING"): "VALIDATED",
    ("publish", "VALIDATED"): "PUBLISHED",
    ("fail", "REGISTERED"): "FAILED",
    ("fail", "BUILDING"): "FAILED",
    ("fail", "VALIDATED"): "FAILED",
}
POLICIES = [DEFAULT_POLICY, SkewPolicy(hot_rows=30, sample_fraction=1.0)]


def random_log(seed: int, rows: int = 600, batches: int = 12, pointers: int = 3, versions: int = 9):
    draw = random.Random(seed)
    actions = ["register", "start_build", "start_build", "validate", "publish", "fail"]
    log = []
    for seq in range(rows):
        batch = 0 if draw.random() < 0.35 else draw.randrange(batches)
        log.append(
            (
                batch % pointers,
                batch,
                seq * 3,
                draw.choice(actions),
                draw.choice(["d1", "d1", "d2"]),
                draw.choice(["v1", "v1", "v2"]),
                draw.randrange(versions),
            )
        )
    return log


def replay(log):
    states, steps = {}, []
    for _, batch, seq, action, *_ in sorted(log, key=lambda row: row[2]):
        before = states.get(batch, "UNREGISTERED")
        after = MOVES.get((action, before))
        steps.append((batch, seq, action, before, after or before, after is not None))
        states[batch] = after or before
    return states, steps


def swap(log):
    versions, outcomes = {}, {}
    for pointer, _, seq, action, _, _, expected in sorted(log, key=lambda row: row[2]):
        if action == "publish":
            current = versions.get(pointer, 0)
            outcomes[seq] = current + 1 if expected == current else None
            versions[pointer] = current + (expected == current)
    return versions, outcomes


@pytest.mark.parametrize("seed,policy", [(1, POLICIES[0]), (2, POLICIES[1])])
def test_outcomes_equal_a_replay(spark, seed, policy):
    log = random_log(seed)
    states, steps = replay(log)
    frame = spark.createDataFrame(log, COLUMNS)
    found = lifecycle.action_outcomes(frame, policy).select(
        "batch_id", "seq", "action", "state_before", "state_after", "accepted"
    )
    assert sorted(map(tuple, found.collect()), key=lambda row: row[1]) == steps
    final = {row["batch_id"]: row["state"] for row in lifecycle.lifecycle_state(frame, policy).collect()}
    assert final == states
    attempts = {row["batch_id"]: row["attempts"] for row in lifecycle.build_attempts(frame, policy).collect()}
    assert attempts == {
        batch: sum(s[0] == batch and s[2] == "start_build" and s[5] for s in steps) for batch in states
    }


@pytest.mark.parametrize(
    "seed,versions,policy", [(1, 3, POLICIES[0]), (2, 9, POLICIES[0]), (2, 9, POLICIES[1])]
)
def test_pointer_swaps_equal_a_replay(spark, seed, versions, policy):
    log = random_log(seed, versions=versions)
    current, outcomes = swap(log)
    frame = spark.createDataFrame(log, COLUMNS)
    found = {row["seq"]: row["pointer_version"] for row in lifecycle.pointer_cas(frame, policy).collect()}
    assert found == outcomes
    active = {
        row["pointer_id"]: row["pointer_version"]
        for row in lifecycle.resolve_active(frame, policy).collect()
    }
    assert active == {pointer: version for pointer, version in current.items() if version}


def test_long_chain_on_one_pointer(spark):
    """A healthy pointer: every attempt is accepted, 70 links deep."""
    log = [(1, n, n, "publish", "d", "v", n) for n in range(70)]
    frame = spark.createDataFrame(log, COLUMNS)
    found = lifecycle.pointer_cas(frame, POLICIES[1])
    assert sorted(row["pointer_version"] for row in found.collect()) == list(range(1, 71))
    assert lifecycle.retained_generations(frame, POLICIES[1]).count() == 69


def test_replay_conflict_and_recovery(spark):
    log = [
        (0, 7, 1, "register", "d1", "v1", None),
        (0, 7, 2, "register", "d2", "v1", None),
        (0, 7, 3, "register", "d1", "v2", None),
        (0, 7, 4, "register", "d1", "v1", None),
        (0, 7, 5, "start_build", None, None, None),
        (0, 7, 6, "fail", None, None, None),
        (0, 7, 7, "register", "d1", "v1", None),
        (0, 7, 8, "start_build", None, None, None),
        (0, 7, 9, "validate", None, None, None),
        (0, 7, 10, "publish", None, None, 0),
        (0, 7, 11, "register", "d1", "v1", None),
        (0, 7, 12, "fail", None, None, None),
        (0, 8, 13, "publish", None, None, 0),
    ]
    frame = spark.createDataFrame(log, COLUMNS)
    conflicts = lifecycle.identity_conflicts(frame).orderBy("seq").collect()
    assert [(row["seq"], row["conflict"]) for row in conflicts] == [(2, "CONTENT"), (3, "LOCATION")]
    replays = lifecycle.replay_classification(frame).orderBy("seq").collect()
    assert [(row["seq"], row["classification"]) for row in replays] == [
        (4, "IN_PROGRESS"),
        (7, "RECOVERING"),
        (11, "REPLAYED"),
    ]
    illegal = lifecycle.illegal_transitions(frame).orderBy("seq").collect()
    assert [(row["seq"], row["reason"]) for row in illegal] == [
        (12, "ILLEGAL_TRANSITION"),
        (13, "UNKNOWN_GENERATION"),
    ]
    resolved = lifecycle.resolve_active(frame).first()
    assert (resolved["batch_id"], resolved["pointer_version"], resolved["status"]) == (7, 1, "RESOLVED")


def test_evidence(spark):
    full = [("g", "d", table, 5, 0) for table in TABLES]
    cases = {
        "good": full,
        "short": full[:5],
        "zero snapshot": [("g", "d", "orders", 0, 1), *full[1:]],
        "negative rows": [("g", "d", "orders", 1, -1), *full[1:]],
        "null rows": [("g", "d", "orders", 1, None), *full[1:]],
        "other digest": [("g", "x", "orders", 1, 1), *full[1:]],
        "stranger": [("g", "d", "other", 1, 1), *full],
        "none": [],
    }
    kind = "generation_id string, manifest_digest string, table_name string, snapshot_id bigint, rows bigint"
    rows = [(name, *row[1:]) for name, case in cases.items() for row in case]
    known = spark.createDataFrame([(name, "d") for name in cases], "generation_id string, manifest_digest string")
    checked = lifecycle.evidence_complete(spark.createDataFrame(rows, kind), known)
    assert {row["generation_id"]: row["complete"] for row in checked.collect()} == {
        name: name == "good" for name in cases
    }


def test_slices_of_one_pointer_compose(spark):
    """Chains that go on over slices, that start within one, and versions nobody expects."""
    from ledgerloom.skew import SkewPolicy

    draw = random.Random(8)
    log, version = [], 0
    for n in range(600):
        expected = version if draw.random() < 0.4 else draw.choice([None, -1, 0, version + 1, version + 2, version - 1])
        log.append((draw.choice([1, 1, 1, 2, None]), n, n, "publish", None, None, expected))
        version += expected == version and log[-1][0] == 1
    current, outcomes = swap([row for row in log if row[0] is not None])
    frame = spark.createDataFrame(log, COLUMNS)
    for rows in (17, 100_000):
        found = lifecycle.pointer_cas(frame, SkewPolicy(slice_rows=rows)).collect()
        assert {r["seq"]: r["pointer_version"] for r in found if r["pointer_id"] is not None} == outcomes
        assert all(r["outcome"] == "STALE_PUBLISHER" for r in found if r["pointer_id"] is None)
        assert len(found) == 600
    assert current[1] > 50


def test_a_replay_needs_one_exchange_and_one_sort(spark, tmp_path):
    spark.createDataFrame(random_log(1), COLUMNS).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = lifecycle.lifecycle_state(log)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1, plan


def test_one_batch_of_most_actions_is_cut_once(spark):
    # Long stretches without an accepted action, so that states have to pass through whole slices.
    draw, log = random.Random(5), []
    for seq in range(4000):
        stretch = seq // 700
        action = draw.choice(["register", "validate"]) if stretch % 2 else draw.choice(["start_build", "fail"])
        if seq == 3900:
            action = "start_build"
        if seq in (3910, 3920):
            action = "validate" if seq == 3910 else "publish"
        if 3900 < seq and seq not in (3910, 3920):
            action = "register"
        if seq < 900:
            action = "fail" if seq % 2 else "publish"
        log.append((1, 7 if seq % 5 else seq % 11, seq, action, "d1", "v1", 0))
    states, steps = replay(log)
    policy = SkewPolicy(hot_rows=100, sample_fraction=1.0, slice_rows=150)
    frame = spark.createDataFrame(log, COLUMNS)
    found = lifecycle.action_outcomes(frame, policy).collect()
    got = sorted((r.batch_id, r.seq, r.action, r.state_before, r.state_after, r.accepted) for r in found)
    assert got == sorted(steps)
    assert {r.batch_id: r.state for r in lifecycle.lifecycle_state(frame, policy).collect()} == states
