"""A corpus prepared for training, in four stages: language ID, near-duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the
docs of the next. All but the last return the columns of documents, whatever these are. Null or letterless
texts, empty tables and repeated rows are the operators' own cases: see their docstrings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language, mixing, packing, simhash
from ledgerloom.llm.common import word_count, written

#: The score of a text without likeness to a language varies about 0 by 1 / sqrt(components), whatever the
#: text. Letters of noise share some trigrams with a language, so five times that is asked for. Held-out
#: documents of sf0.01 with enough letters have 0.19 at least, random letters 0.164 at most.
LEAST_SCORE = 5 / language.DIMENSION**0.5
#: Letters, in different words, from which on the score tells: single words of a language score like noise.
TELLING_LETTERS = 64

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _whole(docs: DataFrame):
    """The document as one column, so that no operator's column can replace one of its own."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that resemble a language: `und` goes, and texts of enough letters with a low score.

    Learns from all labelled rows. A text with too few letters to tell stays.
    """
    judged = language.predict(docs.select(_whole(docs), "text"), language.train(docs))
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    too_short = F.length(F.array_join(words, "")) < TELLING_LETTERS
    kept = (F.col("lang_pred") != language.UNKNOWN) & (too_short | (F.col("score") > LEAST_SCORE))
    return judged.filter(kept).select("document.*")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest doc_id, of every group of near-duplicates."""
    found = simhash.near_duplicates(docs.select(_whole(docs), "doc_id", "text"), carry=["document"])
    return found.filter("stays").select("document.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources' words come to their targets; shuffled by shard.

    A document that the mix takes several times has as many rows. Documents are taken whole.
    """
    sized = docs.select(_whole(docs), "doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.shuffled(mixing.mix(mixing.plan(sized, whole_documents=True))).select("document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    return packing.pack(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("simhash_near_dedup", deduplicated),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

#: No stage but reading can be put in SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
