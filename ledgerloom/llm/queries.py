"""The registered queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat,
    chunks,
    conversations,
    language,
    lines,
    mixing,
    packing,
    records,
    sharding,
    simhash,
    topk,
    url_rules,
    whitening,
)
from ledgerloom.llm.common import word_count, written
from ledgerloom.session import fresh_dir
from ledgerloom.sources.star_tables import given

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the registered queries.
EXTRA_CONVERSATION = -7
EXTRA_TEXT = "</s>[INST] ok [/INST]"
SHARDS = 8
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
TOP = 5


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


CHAT_DDL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _read_chats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the formatted conversations say, one row each; parts of one conversation follow each other."""
    current, rows = None, []

    def closed() -> None:
        if current:
            conv, turns, all_turns, loss_chars, loss, chars = current
            rows.append((conv, turns, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

    for batch in batches:
        ids, parts, texts, spans = (batch.column(n) for n in range(4))
        for conv, part, text, own in zip(ids, parts, texts, spans, strict=True):
            value = text.as_py()
            if part.as_py() == 0:
                closed()
                current = [conv.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns = chat.parse_chat(value)
            learned = chat.learned_text(value, own.as_py())
            current[1] += len(turns)
            for role, said in turns:
                current[2].update(f"{role}\n{said}\n".encode())
            current[3] += len(learned)
            current[4].update(learned.encode())
            current[5] += len(value)
        yield _rows(rows, CHAT_DDL)
        rows.clear()
    closed()
    if rows:
        yield _rows(rows, CHAT_DDL)


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [part.split() for part in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(EXTRA_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    turns = given(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_chats(turns.union(extra)).mapInArrow(_read_chats, CHAT_DDL)


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.compare_with_next(given(spark, sf_dir, "documents"))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce("text", F.lit("")).cast("binary")
    sized = given(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = sharding.shard(sized, ["text_hash"], "size", SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = given(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(given(spark, sf_dir, "documents")).drop("ids")


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(given(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = given(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    planned = mixing.plan(written(sized, "sized"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, copy: total + copy["words"])
    shards = F.array_join(F.transform("copies", lambda copy: copy["shard"].cast("string")), ",")
    return planned.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), shards.alias("shards")
    )


@query
def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "records")
    records.write_records(given(spark, sf_dir, "documents"), path)
    # One row per file of some 32 MB; the walk over a file counts the tokens before each record in it.
    before = records.token_starts(records.read_index(spark, path))
    read = records.read_records(spark, path).select(
        "part",
        "first_token",
        F.col("key").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    start = (F.col("tokens_before") + F.col("first_token")).alias("start")
    return read.join(F.broadcast(before), "part").select("doc_id", start, "n_tokens", "ids_crc32")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    is_held_out = F.coalesce(language.held_out(F.col("doc_id")), F.lit(False))
    prototypes = language.train(documents.filter(~is_held_out))
    return language.predict(
        documents.select("doc_id", "text", is_held_out.alias("held_out")), prototypes
    ).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = given(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, TOP)


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents").select("doc_id", "text")
    left = lines.drop_repeated_lines(documents)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of the registered query: dropped, emptied, cut, repeated or given to the user, by a checksum.

    A dropped row stays as one that is no turn, so that its conversation is known.
    """

    def known(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    fated = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), fate.alias("fate"))
    cut = F.regexp_replace("text", "[.!?]", "")
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy")
    return fated.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, conversations.USER).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, cut).otherwise(F.col("text")).alias("text"),
        (F.col("fate") != 0).alias("is_turn"),
        copies,
    )


REPAIRED_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation; its parts follow each other."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    current = None

    def closed() -> tuple:
        conv, totals, audit, digest, _ = current
        return (conv, *totals, "".join(audit), digest.hexdigest())

    for batch in batches:
        rows = []
        for part in batch.to_pylist():
            if part["part"] == 0:
                if current:
                    rows.append(closed())
                current = [part["conv_id"], [0] * len(counts), [], hashlib.sha256(), False]
            current[1] = [total + part[name] for total, name in zip(current[1], counts, strict=True)]
            current[2].append(part["audit"])
            for role, text in zip(part["roles"], part["texts"], strict=True):
                current[3].update(f"{chr(10) if current[4] else ''}{role}:{text}".encode())
                current[4] = True
        if rows:
            yield _rows(rows, REPAIRED_DDL)
    if current:
        yield _rows([closed()], REPAIRED_DDL)


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged(given(spark, sf_dir, "conversations"))
    parts = conversations.repair(turns, F.col("is_turn"))
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(_digests, REPAIRED_DDL)


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(given(spark, sf_dir, "embeddings"))
