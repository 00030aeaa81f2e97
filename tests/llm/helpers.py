"""Small tables with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from ledgerloom.llm.tokens import tokenizer_path

DOCUMENT_DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators add, as columns of the input.
CLASHING = ("size", "shard", "slot", "copies", "fingerprint", "component_id", "stays", "lang_pred", "score",
            "row", "key", "text_hash", "host", "path", "rule", "verdict", "place", "serial", "words")

LONG = "Thandorea enthe ereonti. " * 8000


def messy(spark: SparkSession) -> DataFrame:
    """Null in every column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
        (2, "The quick brown fox jumps over the lazy dog.", "en", "b", 44),
        (2, "The quick brown fox jumps over the lazy dog.", "en", "b", 44),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, "!!! ... 123", "fr", None, 11),
        (None, "Ein Satz ohne Nummer.", "de", "c", 21),
        (None, None, None, None, None),
        (6, LONG, "en", "a", len(LONG)),
        (7, "éàü ñ x\ty\nz \U0001f600 <|endoftext|>", "fr", "b", 20),
        (-8, "mot " * 5000, "fr", "c", 20000),
    ]
    return spark.createDataFrame(rows, DOCUMENT_DDL)


def clashing(frame: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit("kept") for name in CLASHING})


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENT_DDL)


_tokenizer = Tokenizer.from_file(tokenizer_path())


def ids_of(text: str | None) -> list[int]:
    return [*_tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc_of(ids: list[int]) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def roots(count: int, pairs) -> list[int]:
    """Plain union-find: the smallest number each one can reach."""
    parent = list(range(count))

    def root(n: int) -> int:
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(n) for n in range(count)]
