"""Batch lifecycle read from an append-only action log.

The log has batch_id, pointer_id, seq (unique, the order of events), action, manifest_digest,
manifest_version_id and expected_pointer_version. Replays of the log are folds by nature; here a batch is a
finite automaton, replayed with running maxima, and a slice of a batch that holds much of the log is a map
from states to states, so that slices are replayed side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.schemas import TABLES
from ledgerloom.session import fresh_dir, shared_dir
from ledgerloom.skew import DEFAULT_POLICY, SLICES, SkewPolicy, hot_keys, lookup_join, split_hot

# States and actions.
UNREGISTERED = "UNREGISTERED"
REGISTERED = "REGISTERED"
BUILDING = "BUILDING"
VALIDATED = "VALIDATED"
PUBLISHED = "PUBLISHED"
FAILED = "FAILED"
STATES = (UNREGISTERED, REGISTERED, BUILDING, VALIDATED, PUBLISHED, FAILED)
REGISTER, START_BUILD, VALIDATE, PUBLISH, FAIL = (
    "register",
    "start_build",
    "validate",
    "publish",
    "fail",
)


def registry(log: DataFrame) -> DataFrame:
    """The accepted (first) identity of each batch."""
    first = F.min_by(F.struct("seq", "manifest_digest", "manifest_version_id"), "seq")
    return (
        log.filter(F.col("action") == REGISTER)
        .groupBy("batch_id")
        .agg(first.alias("first"))
        .select(
            "batch_id",
            F.col("first.seq").alias("registered_seq"),
            F.col("first.manifest_digest").alias("accepted_digest"),
            F.col("first.manifest_version_id").alias("accepted_version_id"),
        )
    )


def _later_registrations(rows: DataFrame, log: DataFrame, policy: SkewPolicy) -> DataFrame:
    registrations = rows.filter(F.col("action") == REGISTER)
    return lookup_join(
        registrations,
        registry(log),
        ["batch_id"],
        "inner",
        hot_keys(log.filter(F.col("action") == REGISTER), ["batch_id"], policy),
    ).filter(F.col("seq") > F.col("registered_seq"))


def identity_conflicts(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Later registrations with another digest, or the same digest at another location."""
    other_digest = ~F.col("manifest_digest").eqNullSafe(F.col("accepted_digest"))
    other_place = ~F.col("manifest_version_id").eqNullSafe(F.col("accepted_version_id"))
    return (
        _later_registrations(log, log, policy)
        .filter(other_digest | other_place)
        .select(
            "batch_id",
            "seq",
            F.when(other_digest, "CONTENT").otherwise("LOCATION").alias("conflict"),
        )
    )


def _replayed(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], entry: Column) -> DataFrame:
    """Every action of each key, a batch or a slice of one, replayed in order from the state on entry.

    A failure sends every unpublished state to FAILED, so a history falls into attempts that end with one:
    BUILDING from the first start of an attempt, VALIDATED from the first validation after it, PUBLISHED for
    good from the first publication after that. Each of these is a running maximum over the actions before
    this one, and all of them share one exchange and one sort.
    """
    earlier = (
        Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )

    def last(condition: Column) -> Column:
        return F.max(F.when(condition, F.col("seq"))).over(earlier)

    def is_action(name: str) -> Column:
        return F.col("action") == name

    def since_failure(seen: str, *on_entry: str) -> Column:
        """Whether the step was made in the attempt that is open here."""
        in_first = F.col(seen).isNotNull() | F.col("_entry").isin(*on_entry)
        return F.when(F.col("_fail").isNull(), in_first).otherwise(
            F.coalesce(F.col(seen) > F.col("_fail"), F.lit(False))
        )

    entered = rows.withColumn("_entry", entry)
    known = entered.withColumn(
        "_registered",
        (F.col("_entry") != UNREGISTERED)
        | F.coalesce(F.max(is_action(REGISTER)).over(earlier), F.lit(False)),
    )
    begun = known.withColumns(
        {
            "_fail": last(F.col("_registered") & is_action(FAIL)),
            "_start": last(F.col("_registered") & is_action(START_BUILD)),
        }
    ).withColumn("_building", F.col("_registered") & since_failure("_start", BUILDING, VALIDATED))
    checked = begun.withColumn("_validate", last(F.col("_building") & is_action(VALIDATE))).withColumn(
        "_validated", since_failure("_validate", VALIDATED)
    )
    done = checked.withColumn("_publish", last(F.col("_validated") & is_action(PUBLISH)))
    before = (
        F.when(~F.col("_registered"), UNREGISTERED)
        .when(F.col("_publish").isNotNull() | (F.col("_entry") == PUBLISHED), PUBLISHED)
        .when(F.col("_validated"), VALIDATED)
        .when(F.col("_building"), BUILDING)
        .when(F.col("_fail").isNotNull() | (F.col("_entry") == FAILED), FAILED)
        .otherwise(REGISTERED)
    )
    state = F.col("state_before")
    target = (
        F.when(is_action(REGISTER) & (state == UNREGISTERED), REGISTERED)
        .when(is_action(START_BUILD) & state.isin(REGISTERED, FAILED), BUILDING)
        .when(is_action(VALIDATE) & (state == BUILDING), VALIDATED)
        .when(is_action(PUBLISH) & (state == VALIDATED), PUBLISHED)
        .when(is_action(FAIL) & state.isin(REGISTERED, BUILDING, VALIDATED), FAILED)
    )
    return done.withColumn("state_before", before).select(
        *columns,
        "state_before",
        F.coalesce(target, state).alias("state_after"),
        target.isNotNull().alias("accepted"),
    )


def _slice_entries(sliced: DataFrame) -> DataFrame:
    """(batch_id, slice, entry): the state in which each slice of a batch is entered.

    A slice is a map from every state on entry to the state on exit. The maps of a batch, one per slice, are
    applied one after another, from the unregistered state on.
    """
    starts = F.explode(F.array(*[F.lit(state) for state in STATES])).alias("entry")
    tried = sliced.select("batch_id", "_slice", "seq", "action", starts)
    keys = ["batch_id", "_slice", "entry"]
    exits = (
        _replayed(tried, [*keys, "seq"], keys, F.col("entry"))
        .groupBy(*keys)
        .agg(F.max_by("state_after", "seq").alias("exit"))
    )
    moves = F.collect_list(F.struct("entry", "exit")).alias("moves")
    maps = exits.groupBy("batch_id", "_slice").agg(moves)
    # One map per slice that the batch touches.
    ordered = F.array_sort(F.collect_list(F.struct("_slice", "moves")))
    nothing = F.array().cast("array<struct<slice: int, entry: string>>")
    state = F.struct(F.lit(UNREGISTERED).alias("now"), nothing.alias("entries"))

    def apply(held: Column, slice_map: Column) -> Column:
        entered = F.struct(slice_map["_slice"].alias("slice"), held["now"].alias("entry"))
        return F.struct(
            F.element_at(F.map_from_entries(slice_map["moves"]), held["now"]).alias("now"),
            F.array_append(held["entries"], entered).alias("entries"),
        )

    entries = maps.groupBy("batch_id").agg(F.aggregate(ordered, state, apply)["entries"].alias("entries"))
    return entries.select("batch_id", F.explode("entries").alias("e")).select(
        F.col("batch_id").alias("_of_batch"), F.col("e.slice").alias("_of_slice"), F.col("e.entry").alias("_known")
    )


def action_outcomes(
    log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every action with the batch state before it, the state after it and whether it was accepted.

    Of the log's columns only `columns` are kept, all by default. Batches are replayed side by side, in one
    exchange and one sort. The rows of a hot batch are cut into slices of its order once; slices are replayed
    from every state they might be entered in, these maps are composed, and each slice is then replayed from
    the state it is entered in.
    """
    columns = list(log.columns if columns is None else columns)
    rows = log.select(*dict.fromkeys([*columns, "batch_id", "seq", "action"]))
    hot = hot_keys(log, ["batch_id"], policy)
    if hot is None:
        return _replayed(rows, columns, ["batch_id"], F.lit(UNREGISTERED))
    hot_rows, other_rows = split_hot(rows, hot, ["batch_id"])
    others = _replayed(other_rows, columns, ["batch_id"], F.lit(UNREGISTERED))
    spark = log.sparkSession
    shared_dir(spark)
    wanted = hot.agg(F.sum(SLICES)).first()[0]
    slices = max(2, ceil(wanted), int(spark.conf.get("spark.sql.shuffle.partitions")))
    sliced = (
        hot_rows.repartitionByRange(slices, "batch_id", "seq")
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint()
    )
    # One row per hot batch and slice it touches: at most hot batches + slices rows.
    of_slice = F.col("batch_id").eqNullSafe(F.col("_of_batch")) & (F.col("_slice") == F.col("_of_slice"))
    entered = sliced.join(F.broadcast(_slice_entries(sliced)), of_slice)
    known = _replayed(entered, columns, ["batch_id", "_slice"], F.col("_known"))
    return others.unionByName(known)


def lifecycle_state(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Final state of each batch, with its last accepted action."""
    return (
        action_outcomes(log, policy, ["batch_id", "seq"])
        .groupBy("batch_id")
        .agg(
            F.max_by("state_after", "seq").alias("state"),
            F.max(F.when(F.col("accepted"), F.col("seq"))).alias("last_accepted_seq"),
        )
    )


def illegal_transitions(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Rejected actions with the reason. A repeated registration is a replay, not a transition."""
    reason = (
        F.when(F.col("state_before") == UNREGISTERED, "UNKNOWN_GENERATION")
        .when(F.col("action") == PUBLISH, "NOT_VALIDATED")
        .otherwise("ILLEGAL_TRANSITION")
    )
    return (
        action_outcomes(log, policy, ["batch_id", "seq", "action"])
        .filter(~F.col("accepted") & (F.col("action") != REGISTER))
        .select("batch_id", "seq", "action", "state_before", reason.alias("reason"))
    )


def build_attempts(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Accepted build starts per batch."""
    started = F.col("accepted") & (F.col("action") == START_BUILD)
    return (
        action_outcomes(log, policy, ["batch_id", "action"])
        .groupBy("batch_id")
        .agg(F.sum(started.cast("bigint")).alias("attempts"))
    )


def replay_classification(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Later identical registrations: REPLAYED, RECOVERING or IN_PROGRESS by the state they meet."""
    outcomes = action_outcomes(log, policy)
    return (
        _later_registrations(outcomes, log, policy)
        .filter(
            F.col("manifest_digest").eqNullSafe(F.col("accepted_digest"))
            & F.col("manifest_version_id").eqNullSafe(F.col("accepted_version_id"))
        )
        .select(
            "batch_id",
            "seq",
            F.when(F.col("state_before") == PUBLISHED, "REPLAYED")
            .when(F.col("state_before") == FAILED, "RECOVERING")
            .otherwise("IN_PROGRESS")
            .alias("classification"),
        )
    )


MAPS_DDL = "pointer_id long, slice int, entry long, exit long"
ENTRIES_DDL = "pointer_id long, slice int, entry long"
SWAPS_DDL = "pointer_id long, slice int, seq long, version long"


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices, last attempt first, to their maps from the version on entry to the version on exit.

    An attempt that expects v leads on as v + 1 does after it; versions that nobody expects stay as they are.
    """
    current, exits = None, {}

    def closed() -> pa.RecordBatch:
        columns = ([current[0]] * len(exits), [current[1]] * len(exits), list(exits), list(exits.values()))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["pointer_id", "slice", "entry", "exit"])

    for batch in batches:
        for pointer, number, expected in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (pointer, number) != current:
                if exits:
                    yield closed()
                current, exits = (pointer, number), {}
            exits[expected] = exits.get(expected + 1, expected + 1)
    if exits:
        yield closed()


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maps of a pointer's slices in order to the version on entry of each: maps applied one after another."""
    pointer = number = None
    version = following = 0
    for batch in batches:
        rows = []
        for own, place, entry, leads_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if own != pointer:
                pointer, number, following = own, None, 0
            if place != number:
                number, version = place, following
                rows.append((pointer, number, version))
            if entry == version:
                following = leads_to
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.int64())
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["pointer_id", "slice", "entry"])


def _swapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Attempts of a slice in order, with its version on entry, to the accepted ones and their new versions."""
    current, version = None, 0
    for batch in batches:
        rows = []
        for pointer, number, seq, expected, entry in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (pointer, number) != current:
                current, version = (pointer, number), entry
            if expected == version:
                version += 1
                rows.append((pointer, number, seq, version))
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["pointer_id", "slice", "seq", "version"])


def _sliced(attempts: DataFrame, policy: SkewPolicy) -> DataFrame:
    """Attempts cut into ranges of (pointer, seq) of about `slice_rows` rows, written so that they stay so."""
    spark = attempts.sparkSession
    slices = ceil(attempts.count() / policy.slice_rows)
    path = fresh_dir(spark, "attempts")
    if slices > 1:
        attempts = attempts.repartitionByRange(slices, "pointer_id", "seq").withColumn(
            "slice", F.spark_partition_id()
        )
    else:
        attempts = attempts.withColumn("slice", F.lit(0))
    attempts.write.parquet(path)
    return spark.read.schema(attempts.schema).parquet(path)


def pointer_cas(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Every publication attempt in order: PUBLISHED if it expected the current version, else stale.

    The version starts at 0 and grows by one with each accepted attempt. A slice of a pointer's attempts is
    a map from the version on entry to the version on exit, whatever the entry will be; maps are composed in
    the order of the slices, which gives each slice its entry, and slices are replayed side by side. Jobs
    are constant in number, and a pointer that has most attempts is spread over its slices. An attempt
    without a pointer or an expected version is stale.
    """
    attempts = log.filter(F.col("action") == PUBLISH).select(
        "pointer_id", "batch_id", "seq", "expected_pointer_version"
    )
    sliced = _sliced(attempts, policy)
    known = sliced.select(
        F.col("pointer_id").cast("bigint").alias("pointer_id"),
        "slice",
        F.col("seq").cast("bigint").alias("seq"),
        F.col("expected_pointer_version").cast("bigint").alias("expected"),
    ).filter(F.col("pointer_id").isNotNull() & (F.col("expected") >= 0))
    keys = ["pointer_id", "slice"]
    maps = (
        known.repartition(*keys)
        .sortWithinPartitions(*keys, F.desc("seq"))
        .select(*keys, "expected")
        .mapInArrow(_composed, MAPS_DDL)
    )
    # A slice's map has a row for each version that is expected in it, so this pass over a pointer is thin.
    entries = (
        maps.repartition("pointer_id").sortWithinPartitions(*keys).mapInArrow(_entered, ENTRIES_DDL)
    )
    accepted = (
        known.join(entries, keys)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "seq")
        .select(*keys, "seq", "expected", "entry")
        .mapInArrow(_swapped, SWAPS_DDL)
    )
    # Slices spread a pointer over the join too.
    marked = sliced.join(accepted, [*keys, "seq"], "left")
    hit = F.col("version").isNotNull()
    return marked.select(
        "pointer_id",
        "batch_id",
        "seq",
        "expected_pointer_version",
        F.when(hit, PUBLISHED).otherwise("STALE_PUBLISHER").alias("outcome"),
        F.col("version").alias("pointer_version"),
    )


def accepted_publications(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    return pointer_cas(log, policy).filter(F.col("outcome") == PUBLISHED)


def resolve_active(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """The active batch of each pointer: RESOLVED if its lifecycle says PUBLISHED, else invalid."""
    active = (
        accepted_publications(log, policy)
        .groupBy("pointer_id")
        .agg(
            F.max_by("batch_id", "pointer_version").alias("batch_id"),
            F.max("pointer_version").alias("pointer_version"),
        )
    )
    states = lifecycle_state(log, policy).select("batch_id", "state")
    return active.join(states, "batch_id", "left").select(
        "pointer_id",
        "batch_id",
        "pointer_version",
        F.when(F.col("state") == PUBLISHED, "RESOLVED")
        .otherwise("ACTIVE_POINTER_INVALID")
        .alias("status"),
    )


def retained_generations(log: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Batches that were active on a pointer once and have been superseded by another."""
    accepted = accepted_publications(log, policy)
    last = accepted.groupBy("pointer_id").agg(
        F.max_by("batch_id", "pointer_version").alias("active_batch_id")
    )
    return (
        accepted.groupBy("pointer_id", "batch_id")
        .agg(F.max("pointer_version").alias("pointer_version"))
        .join(last, "pointer_id")
        .filter(~F.col("batch_id").eqNullSafe(F.col("active_batch_id")))
        .select("pointer_id", "batch_id", "pointer_version")
    )


def evidence_complete(evidence: DataFrame, generations: DataFrame) -> DataFrame:
    """Validation evidence checked per generation.

    `evidence` has one row per reported table: generation_id, manifest_digest, table_name,
    snapshot_id, rows. `generations` has generation_id and manifest_digest.
    """
    row_is_valid = (F.col("snapshot_id") > 0) & (F.col("rows") >= 0)
    reported = evidence.groupBy("generation_id").agg(
        F.min("manifest_digest").alias("least_digest"),
        F.max("manifest_digest").alias("greatest_digest"),
        F.bool_and(F.coalesce(row_is_valid, F.lit(False))).alias("snapshots_valid"),
        F.bool_and(F.col("table_name").isin(*TABLES)).alias("tables_known"),
        F.count_distinct("table_name").alias("tables"),
    )
    digest_matches = (F.col("least_digest") == F.col("manifest_digest")) & (
        F.col("greatest_digest") == F.col("manifest_digest")
    )
    tables_complete = F.col("tables_known") & (F.col("tables") == len(TABLES))
    return generations.join(reported, "generation_id", "left").select(
        "generation_id",
        F.coalesce(digest_matches, F.lit(False)).alias("manifest_matches"),
        F.coalesce(tables_complete, F.lit(False)).alias("tables_complete"),
        F.coalesce(F.col("snapshots_valid"), F.lit(False)).alias("snapshots_valid"),
        F.coalesce(digest_matches & tables_complete & F.col("snapshots_valid"), F.lit(False)).alias(
            "complete"
        ),
    )


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot by committed_at; the higher id wins a tie."""
    return snapshots.orderBy(F.desc("committed_at"), F.desc("snapshot_id")).limit(1)
