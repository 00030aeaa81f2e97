"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.batch import Batch
from ledgerloom.functions import predicates, text
from ledgerloom.operators import aggregates as agg
from ledgerloom.operators import (
    digest_tree as trees,
    fingerprint,
    gates,
    inventory,
    lifecycle,
    metering,
    proofs,
    temporal,
)
from ledgerloom.plans import build, report
from ledgerloom.schemas import TABLES
from ledgerloom.session import fresh_dir
from ledgerloom.skew import SkewPolicy
from ledgerloom.sources import batch_files, generations, star_tables, synthetic
from ledgerloom.sources.star_tables import faulted_batch, given

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the registered generation.
GENERATION = "g-star-0123456789ab"
BATCH_ID = "star"
DIGEST = "d" * 64


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _batch_query(name: str, build: Callable[[star_tables.StarBatch], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(faulted_batch(spark, sf_dir))


def _log_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(star_tables.action_log(spark, sf_dir))


# --- gates, joins, aggregates and windows over the derived batch ---------------------------------

for _code, _gate in gates.GATES.items():
    _batch_query(f"gate_{_code.lower()}", _gate)

_batch_query("violation_report", report.violation_report)
_batch_query("violation_summary", report.violation_summary)
_batch_query("violated_codes", lambda b: report.violated_codes(report.violation_report(b)))
_batch_query("sorted_duplicates", gates.sorted_duplicates)
_batch_query("valid_returns", agg.valid_returns)
_batch_query("line_events", temporal.line_events)
_batch_query("resolve_product", lambda b: temporal.resolve_product(b).drop("dimension_matches"))
_batch_query("resolved_sales", temporal.resolved_sales)
_batch_query("line_totals", lambda b: agg.line_totals(b["order_lines"]))
_batch_query("captured_by_order", lambda b: agg.captured_by_order(b["payments"]))
_batch_query("refunds_by_order", lambda b: agg.refunds_by_order(agg.valid_returns(b)))
_batch_query("returned_by_line", lambda b: agg.returned_by_line(agg.valid_returns(b)))
_batch_query("batch_metrics", agg.batch_metrics)
_batch_query("running_stock", inventory.running_stock)


# --- the same operators with the heaviest keys of some rows treated as hot ----------------------------

# Low enough that the small tables have hot keys, so that the split paths have rows of their own; no more
# keys than that whatever the size, because they are literals.
SPLIT = SkewPolicy(hot_rows=8, sample_fraction=1.0, slice_rows=2000, most_keys=256)


def _split_batch(spark: SparkSession, sf_dir: str) -> Batch:
    tables = faulted_batch(spark, sf_dir).materialise()
    return Batch(tables, star_tables.KNOWLEDGE_TIME, SPLIT)


@query
def split_running_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.running_stock(_split_batch(spark, sf_dir))


@query
def split_gate_orphan_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_orphan_line(_split_batch(spark, sf_dir))


@query
def split_gate_orphan_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of one order and its neighbours repeated, so that an order is hot."""
    batch = _split_batch(spark, sf_dir)
    copies = F.explode(F.array_repeat(F.lit(1), 50)).alias("copy")
    few = batch["payments"].filter(F.col("order_id") % 97 == 5).select("*", copies).drop("copy")
    return gates.gate_orphan_payment(batch.replace(payments=batch["payments"].unionByName(few)))


@query
def split_resolve_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.resolve_product(_split_batch(spark, sf_dir)).drop("dimension_matches")


@query
def split_lifecycle_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.lifecycle_state(star_tables.action_log(spark, sf_dir), SPLIT)


@query
def split_pointer_cas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.pointer_cas(star_tables.action_log(spark, sf_dir), SPLIT)


@query
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = faulted_batch(spark, sf_dir)
    kept_orders = agg.completed_orders(batch["orders"]).select(
        F.lit("order").alias("kind"), F.col("order_id").alias("id"), "status"
    )
    kept_payments = agg.captured_payments(batch["payments"]).select(
        F.lit("payment").alias("kind"), F.col("payment_id").alias("id"), "status"
    )
    return kept_orders.unionByName(kept_payments)


@query
def entity_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = faulted_batch(spark, sf_dir)
    lines = batch["order_lines"].select(
        text.entity_key(F.col("order_id"), F.col("line_id")).alias("entity_id")
    )
    stock = batch["inventory_movements"].select(
        text.entity_key(F.col("product_id"), F.col("store_id")).alias("entity_id")
    )
    return lines.unionByName(stock)


@query
def is_violated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existence of every code, off the one report."""
    return report.violated_by_code(report.violation_report(faulted_batch(spark, sf_dir)))


@query
def probe_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    duplicates = gates.duplicates(faulted_batch(spark, sf_dir)["orders"], ("order_id",))
    return duplicates.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_duplicates"))


def _stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, json) of every row of all tables."""
    rows = [
        frame.select(F.lit(name).alias("table_name"), text.canonical_row_json(frame).alias("json"))
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def tag_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = faulted_batch(spark, sf_dir).materialise()
    return _stacked(
        {name: generations.tag_generation(frame, GENERATION) for name, frame in tables.items()}
    )


@query
def temporal_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = faulted_batch(spark, sf_dir)
    return temporal.temporal_match(temporal.line_events(batch), batch)


@query
def dimension_match_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = faulted_batch(spark, sf_dir)
    counted = temporal.dimension_matches(temporal.line_events(batch), batch)
    return counted.select("order_id", "line_id", "dimension_matches")


@query
def business_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.business_result(_published(spark, sf_dir)["orders"])


@query
def six_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.six_table_counts(_published(spark, sf_dir))


@query
def result_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_tables.clean_orders(spark, sf_dir)
    gross = F.sum(F.col("subtotal_cents") + F.col("tax_cents") - F.col("discount_cents"))

    def metric(frame: DataFrame, name: str, value: Column) -> DataFrame:
        return frame.agg(value.alias("value")).select(F.lit(name).alias("metric"), "value")

    rows = F.count(F.lit(1))
    expected = (
        metric(orders, "orders", rows)
        .unionByName(metric(star_tables.clean_lines(spark, sf_dir), "order_lines", rows))
        .unionByName(metric(given(spark, sf_dir, "part"), "parts", rows))
        .unionByName(metric(orders, "gross_order_cents", gross))
    )
    return metering.result_reconciliation(
        expected, agg.batch_metrics(faulted_batch(spark, sf_dir))
    )


# --- proofs and fingerprints -------------------------------------------------------------------


@query
def row_count_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean batch declares, the faulted one is what arrived."""
    batch = faulted_batch(spark, sf_dir)
    clean = {
        "orders": star_tables.clean_orders(spark, sf_dir),
        "order_lines": star_tables.clean_lines(spark, sf_dir),
        "payments": star_tables.clean_orders(spark, sf_dir),
    }
    declared = proofs.table_counts({name: clean.get(name, batch[name]) for name in TABLES})
    return proofs.row_count_proof(
        declared, proofs.table_counts({name: batch[name] for name in TABLES})
    )


def _named(frame: DataFrame, column: str) -> DataFrame:
    return frame.select(F.col(column).cast("string").alias("table_name"))


@query
def manifest_table_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names ordered against names in the dimension."""
    batch = faulted_batch(spark, sf_dir)
    return proofs.manifest_table_set(
        _named(batch["order_lines"], "product_id"), _named(batch["products"], "product_id")
    )


@query
def table_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = faulted_batch(spark, sf_dir)
    return proofs.table_set_difference(
        _named(batch["orders"], "order_id"), _named(batch["payments"], "order_id")
    )


@query
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = faulted_batch(spark, sf_dir)
    return fingerprint.table_fingerprints({name: batch[name] for name in TABLES})


@query
def digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the six tables' trees, each as deep as its rows ask for."""
    batch = faulted_batch(spark, sf_dir)
    rows = proofs.table_counts({name: batch[name] for name in TABLES}).collect()
    return reduce(
        DataFrame.unionByName,
        [
            trees.digest_tree(batch[name], trees.tree_depth(count)).select(
                F.lit(name).alias("table_name"), "node", "rows", "digest"
            )
            for name, count in rows
        ],
    )


@query
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with their totals and currency mended against the orders as they are."""
    orders = faulted_batch(spark, sf_dir)["orders"]
    total = F.col("subtotal_cents") + F.col("tax_cents") - F.col("discount_cents")
    mended = orders.withColumns({"total_cents": total, "currency": F.lit("INR")})
    return trees.changed_rows(mended, orders, trees.tree_depth(orders.count()))


def _page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as stored objects: host as bucket, path as key, page id as version."""
    pages = given(spark, sf_dir, "pages")
    place = text.uri_parts(F.col("url"), ("http", "https"))
    return pages.select(
        "page_id",
        F.coalesce(place["bucket"], F.lit("")).alias("bucket"),
        F.coalesce(place["key"], F.lit("")).alias("key"),
        F.col("page_id").cast("string").alias("version_id"),
        F.octet_length("html").cast("bigint").alias("size_bytes"),
        text.sha256_hex(F.col("html")).alias("sha256"),
        F.concat(F.lit('"'), F.md5("html"), F.lit('"')).alias("etag"),
    )


@query
def object_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = _page_objects(spark, sf_dir)
    page = F.col("page_id")
    declared = objects.filter(page % 17 != 0).select(
        "bucket",
        "key",
        "version_id",
        F.when(page % 7 == 0, F.col("size_bytes") + 1)
        .otherwise(F.col("size_bytes"))
        .alias("size_bytes"),
        F.when(page % 11 == 0, text.sha256_hex(F.col("key")))
        .otherwise(F.col("sha256"))
        .alias("sha256"),
        F.when(page % 13 == 0, F.lit("changed"))
        .otherwise(text.etag_normalize(F.col("etag")))
        .alias("etag"),
    )
    return proofs.object_proof(declared, objects.filter(page % 19 != 0).drop("page_id"))


@query
def object_evidence_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    return _page_objects(spark, sf_dir).select(
        "page_id",
        predicates.object_evidence_valid(
            F.col("bucket"),
            F.col("key"),
            F.when(page % 5 == 0, F.lit("")).otherwise(F.col("version_id")),
            F.when(page % 7 == 0, F.lit(0)).otherwise(F.col("size_bytes")),
            F.when(page % 11 == 0, F.substring("sha256", 1, 63)).otherwise(F.col("sha256")),
        ).alias("valid"),
    )


@query
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.col("source"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    return proofs.content_inventory(documents, path, F.col("text"))


# --- scalar functions ---------------------------------------------------------------------------


@query
def canonical_row_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = faulted_batch(spark, sf_dir)["products"]
    documents = given(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return products.select(text.canonical_row_json(products).alias("json")).unionByName(
        documents.select(text.canonical_row_json(documents, escape=False).alias("json"))
    )


@query
def sha256_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "documents").select(
        "doc_id", text.sha256_hex(F.col("text")).alias("sha256")
    )


@query
def generation_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "pages").select(
        "page_id", text.generation_id(F.col("url"), text.sha256_hex(F.col("html"))).alias("id")
    )


@query
def contract_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = text.sha256_hex(F.col("html"))
    place = text.uri_parts(F.col("url"), ("http", "https"))
    return given(spark, sf_dir, "pages").select(
        "page_id",
        text.contract_regex(F.coalesce(place["bucket"], F.lit("")), "batch_id").alias("host_is_batch"),
        text.contract_regex(F.col("url"), "batch_id").alias("url_is_batch"),
        text.contract_regex(digest, "manifest_digest").alias("sha_is_digest"),
        text.contract_regex(F.md5("html"), "manifest_digest").alias("md5_is_digest"),
        text.contract_regex(F.concat(digest, F.lit("\n")), "manifest_digest").alias(
            "newline_is_digest"
        ),
        text.contract_regex(text.generation_id(F.col("url"), digest), "generation_id").alias(
            "generation_ok"
        ),
        text.contract_regex(
            F.concat(F.lit("db_"), F.split_part(F.col("url"), F.lit("/"), F.lit(4))), "database"
        ).alias("database_ok"),
    )


@query
def null_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faulted_batch(spark, sf_dir)["products"].select(
        "product_id",
        "effective_from",
        predicates.null_to_zero(F.col("effective_to")).alias("effective_to"),
    )


@query
def valid_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = (F.col("effective_from"), F.col("effective_to"))
    moments = {
        "before": star_tables.FIRST_EFFECTIVE - 1,
        "at_start": star_tables.FIRST_EFFECTIVE,
        "before_end": star_tables.SECOND_EFFECTIVE - 1,
        "at_end": star_tables.SECOND_EFFECTIVE,
    }
    return faulted_batch(spark, sf_dir)["products"].select(
        "product_id",
        *ends,
        *[predicates.valid_at(*ends, moment).alias(name) for name, moment in moments.items()],
    )


@query
def uri_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = text.uri_parts(F.col("url"), ("http", "https"))
    rejected = text.uri_parts(F.col("url"), ("s3",))
    return given(spark, sf_dir, "pages").select(
        "page_id",
        place["scheme"].alias("scheme"),
        place["bucket"].alias("bucket"),
        place["key"].alias("key"),
        rejected.isNull().alias("is_rejected"),
    )


@query
def checksum_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    checksum = F.base64(F.unhex(text.sha256_hex(F.col("text"))))
    return given(spark, sf_dir, "documents").select(
        "doc_id", text.checksum_hex(checksum).alias("sha256")
    )


@query
def etag_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.concat(F.lit('"'), F.md5("text"), F.lit('"'))
    return given(spark, sf_dir, "documents").select(
        "doc_id", text.etag_normalize(quoted).alias("etag")
    )


@query
def tax_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_tables.clean_orders(spark, sf_dir).select(
        "order_id", "subtotal_cents", predicates.tax_cents(F.col("subtotal_cents")).alias("tax_cents")
    )


@query
def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "documents").select(
        "doc_id",
        text.failure_stage(F.col("text")).alias("failure_stage"),
        text.failure_code(F.col("text")).alias("failure_code"),
    )


@query
def run_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "documents").select(
        "doc_id", text.run_prefix(F.concat_ws("-", "source", "lang", "text")).alias("kind")
    )


@query
def manifest_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of one manifest per registered batch."""
    accepted = lifecycle.registry(star_tables.action_log(spark, sf_dir))
    proof = {
        name: F.struct(
            (F.col("registered_seq") + place).alias("rows"),
            F.sha2(F.concat(F.lit(name), F.col("accepted_digest")), 256).alias("sha256"),
            F.array(
                F.struct(
                    F.lit("landing").alias("bucket"),
                    F.concat(F.lit(f"{name}/"), F.col("batch_id").cast("string")).alias("key"),
                    F.col("accepted_version_id").alias("version_id"),
                    (F.col("registered_seq") * 10 + 1).alias("size_bytes"),
                    F.sha2(F.col("accepted_digest"), 256).alias("sha256"),
                    F.md5("accepted_digest").alias("etag"),
                )
            ).alias("objects"),
        ).alias(name)
        for place, name in enumerate(TABLES)
    }
    manifests = accepted.select(
        F.col("batch_id").cast("string").alias("batch_id"),
        F.lit("retail-v2").alias("contract_version"),
        F.col("registered_seq").alias("produced_at"),
        F.lit(star_tables.KNOWLEDGE_TIME).cast("bigint").alias("as_of_knowledge_time"),
        F.struct(*proof.values()).alias("tables"),
        F.lit("ignored").alias("identity_digest"),
    )
    return batch_files.manifest_digests(manifests)


# --- lifecycle log ------------------------------------------------------------------------------

for _name in (
    "registry",
    "identity_conflicts",
    "replay_classification",
    "lifecycle_state",
    "illegal_transitions",
    "build_attempts",
    "pointer_cas",
    "resolve_active",
    "retained_generations",
):
    _log_query(_name, getattr(lifecycle, _name))

_log_query("accepted_identity", lambda log: lifecycle.registry(log).select("batch_id", "accepted_digest"))


@query
def evidence_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    event, place = F.col("event_id"), F.col("place")
    generation = F.concat(F.lit("g-"), event.cast("string")).alias("generation_id")
    tables = F.array(*[F.lit(name) for name in TABLES])
    evidence = (
        events.filter(F.col("event_type") == "click")
        .select(event, F.posexplode(tables).alias("place", "table_name"))
        .filter(~((event % 7 == 0) & (place == 5)))
        .select(
            generation,
            F.when(event % 11 == 0, "d2").otherwise("d1").alias("manifest_digest"),
            "table_name",
            F.when((event % 19 == 0) & (place == 1), 0).otherwise(event).alias("snapshot_id"),
            F.when((event % 23 == 0) & (place == 2), -1).otherwise(event).alias("rows"),
        )
    )
    known = events.filter(F.col("event_type").isin("click", "view")).select(
        generation, F.lit("d1").alias("manifest_digest")
    )
    return lifecycle.evidence_complete(evidence, known)


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = star_tables.action_log(spark, sf_dir)
    return lifecycle.latest_snapshot(
        log.select(F.col("seq").alias("snapshot_id"), F.col("ts").alias("committed_at"))
    )


# --- metering -----------------------------------------------------------------------------------


@query
def outcome_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs named after the event number; the last two kinds never run."""
    kinds = [*list(metering.EXPECTED_OUTCOMES)[:6], "other"]
    event = F.col("event_id")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (event % len(kinds) + 1).cast("int"))
    runs = given(spark, sf_dir, "events").select(
        F.concat_ws("-", kind, event.cast("string")).alias("name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("status"),
        event.alias("seq"),
    )
    return metering.outcome_reconciliation(runs)


@query
def usage_metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    event = F.col("event_id")
    runs = events.filter(F.col("event_type") == "purchase").select(
        F.when(event % 3 != 0, (event % 500).cast("double")).alias("dpu_seconds"),
        (event % 300).alias("execution_seconds"),
        F.when(event % 5 != 0, event % 2 + 2).alias("workers"),
    )
    scans = events.filter(F.col("event_type") == "view").select(
        F.when(event % 4 == 0, F.lit(0).cast("bigint"))
        .otherwise(event * 1000 % 50_000_000)
        .alias("bytes")
    )
    return metering.usage_metering(runs, scans)


# --- files, generations, synthetic batches --------------------------------------------------------

_roots: dict[tuple[str, str], str] = {}


def _generation_root(spark: SparkSession, sf_dir: str) -> str:
    """The root the derived batch is written to as one generation, once per session."""
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _roots:
        root = fresh_dir(spark, "generations")
        tables = faulted_batch(spark, sf_dir).materialise()
        generations.write_generation(tables, root, GENERATION, 1, DIGEST)
        _roots[slot] = root
    return _roots[slot]


def _published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return generations.pinned_read(spark, _generation_root(spark, sf_dir), GENERATION)


@query
def write_batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six tables written as gzipped NDJSON with sorted keys; shown as the raw text lines."""
    folder, lines = fresh_dir(spark, "ndjson"), []
    for name, frame in faulted_batch(spark, sf_dir).materialise().items():
        batch_files.write_batch_table(frame, f"{folder}/{name}")
        line = spark.read.text(f"{folder}/{name}").select(F.col("value").alias("line"))
        lines.append(line.select(F.lit(name).alias("table_name"), "line"))
    return reduce(DataFrame.unionByName, lines)


@query
def read_batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A round trip of all six tables through gzipped NDJSON under their declared schemas."""
    folder, read = fresh_dir(spark, "ndjson"), {}
    for name, frame in faulted_batch(spark, sf_dir).materialise().items():
        batch_files.write_batch_table(frame, f"{folder}/{name}")
        read[name] = batch_files.read_batch_table(spark, f"{folder}/{name}", frame.schema)
    return _stacked(read)


@query
def generation_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second attempt, with the captured payments only, stands beside the first one untouched."""
    tables = faulted_batch(spark, sf_dir).materialise()
    root, read = fresh_dir(spark, "sink"), {}
    for name, frame in tables.items():
        second = agg.captured_payments(frame) if name == "payments" else frame
        generations.generation_sink(frame, root, name, GENERATION, 1)
        generations.generation_sink(second, root, name, GENERATION, 2)
        read[name] = generations.read_attempt(spark, root, name, GENERATION, 2, frame.schema)
    return _stacked(read)


@query
def generation_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generations.generation_evidence(
        spark, _generation_root(spark, sf_dir), GENERATION
    ).select("generation_id", "table_name", "rows", "fingerprint")


@query
def pinned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stacked(_published(spark, sf_dir))


@query
def read_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest built for the written generation, stored, read back and flattened."""
    root = _generation_root(spark, sf_dir)
    document = batch_files.build_manifest(
        generations.generation_evidence(spark, root, GENERATION),
        batch_id=BATCH_ID,
        produced_at=star_tables.KNOWLEDGE_TIME,
        as_of_knowledge_time=star_tables.KNOWLEDGE_TIME,
    )
    folder = fresh_dir(spark, "manifest")
    batch_files.write_manifest(spark, document, folder)
    return batch_files.manifest_tables(batch_files.read_manifests(spark, folder))


#: Orders that one file of indexes has at most. Their file says little about how many rows they will make: a few
#: megabytes of keys are millions of rows in six tables, which one task would make, pass for pass.
ORDERS_PER_FILE = 250_000
_indexes: dict[tuple[str, str], str] = {}


def _synthetic(spark: SparkSession, sf_dir: str):
    """As many synthetic orders as the given orders, with their keys as indexes, dealt out to files once per session."""
    keys = given(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("index"))
    rows = keys.count()
    slot = (spark.sparkContext.applicationId, sf_dir)
    if rows > ORDERS_PER_FILE and slot not in _indexes:
        path = fresh_dir(spark, "indexes")
        keys.repartitionByRange(ceil(rows / ORDERS_PER_FILE), "index").write.parquet(path)
        _indexes[slot] = path
    spread = spark.read.schema(keys.schema).parquet(_indexes[slot]) if slot in _indexes else keys
    return synthetic.synthetic_batch(spread, rows)


@query
def synthetic_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _synthetic(spark, sf_dir)
    return _stacked({name: batch[name] for name in TABLES})


@query
def build_publish_serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean batch landed as files, built from its manifest, replayed, published and served."""
    batch = _synthetic(spark, sf_dir)
    tables = {name: batch[name] for name in TABLES}
    store, lake = fresh_dir(spark, "store"), fresh_dir(spark, "lake")
    landed = batch_files.land_batch(tables, store, "landing", BATCH_ID)
    document = batch_files.build_manifest(
        fingerprint.table_fingerprints(tables),
        batch_id=BATCH_ID,
        produced_at=batch.knowledge_time,
        as_of_knowledge_time=batch.knowledge_time,
    )
    bound = batch_files.bind_objects(document, landed)
    built = build.build_generation(spark, bound, store, lake)
    replayed = build.build_generation(spark, bound, store, lake)
    version = build.publish(spark, lake, built.generation_id, expected_pointer_version=0)
    # In a session of its own, whose views no other query sees.
    _, served = build.serve(spark.newSession(), lake)
    proofs_of_served = fingerprint.table_fingerprints(
        {name: frame.drop("generation_id") for name, frame in served.items()}
    )
    return proofs_of_served.select(
        "table_name",
        "rows",
        "fingerprint",
        F.lit(version).cast("bigint").alias("pointer_version"),
        F.lit(replayed.status).alias("second_build"),
        F.lit(build.verify_published(spark, lake).isEmpty()).alias("is_verified"),
    )


@query
def synthetic_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synthetic(spark, sf_dir)["inventory_movements"]


@query
def expected_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic.expected_results(_synthetic(spark, sf_dir))


@query
def inject_fault(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = synthetic.inject_fault(faulted_batch(spark, sf_dir), "broken_total")
    return batch["orders"].select("order_id", "total_cents")


#: The gate that each fault of a batch must set off.
FAULT_GATES = {
    "broken_total": gates.gate_order_total,
    "excess_refund": gates.gate_excess_refund,
    "missing_product": gates.gate_missing_dimension,
    "overlapping_version": gates.gate_ambiguous_dimension,
    "negative_stock": gates.gate_negative_inventory,
}


def _mended(batch: Batch) -> Batch:
    """Without the derived batch's own overlapping versions and uncovered refunds, which hide an injected one."""
    captured = batch["payments"].filter(F.col("status") == "CAPTURED").select("order_id").distinct()
    returns, products = batch["returns"], batch["products"]
    covered = returns.filter(F.col("refund_cents") < 100_000_000_000).join(captured, "order_id", "left_semi")
    return batch.replace(
        returns=covered.select(*returns.columns),
        products=products.filter(~F.col("category").isin("overlap", "dup")),
    )


@query
def fault_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every violation that a fault's gate finds in the whole batch with that fault, the fault's own among them."""
    batch = _mended(faulted_batch(spark, sf_dir))
    found = [
        gate(synthetic.inject_fault(batch, fault)).select(F.lit(fault).alias("fault"), "code", "entity_id", "message")
        for fault, gate in FAULT_GATES.items()
    ]
    return reduce(DataFrame.unionByName, found)
