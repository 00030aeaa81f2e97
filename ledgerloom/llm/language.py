"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, seeded by its code point. A trigram's vector binds those of
its letters, permuted by their place: the first rotated by two, the second by one, multiplied. A document's
vector bundles (adds up) its trigrams'; a language's prototype bundles those of all its documents. A
document gets the language whose prototype has the highest cosine with it.

Per batch, the distinct trigrams are counted first, so a vector is built once for each of them and bundling
is one matrix product. All sums are of integers: the order of rows cannot change them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import common
from ledgerloom.llm.common import ROW, carried, delivered

#: Components of a vector.
DIMENSION = 1024
SEED = 7
UNKNOWN = "und"
#: Characters that are worked on at once; a longer text is worked on in pieces of this size.
BATCH_CHARS = 1_000_000
BATCH_TEXTS = 512
#: Distinct trigrams that are bundled at once; writing with many letters has more of them in a batch.
TRIGRAMS = 16_384
#: Distinct code triples that may be counted by a table rather than by sorting.
TABLE = 1 << 21
SEPARATOR = 0


@lru_cache(maxsize=4096)
def letter_vector(code: int) -> np.ndarray:
    bits = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSION, dtype=np.int8)
    return bits * 2 - 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """Code points of the letters, runs of other characters as one separator, one at either end."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(SEPARATOR))
    framed = np.zeros(len(codes) + 2, np.int32)
    framed[1:-1] = codes
    keep = (framed != SEPARATOR) | np.append(True, framed[:-1] != SEPARATOR)
    return framed[keep]


def _trigrams(
    streams: list[np.ndarray], owners: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner and number of every trigram, the distinct ones as code points, which owners have letters."""
    sizes = np.asarray([len(s) for s in streams])
    stream = np.concatenate(streams)
    number = np.zeros(0x110000, np.int32)
    number[stream] = 1
    used = np.flatnonzero(number)
    width = len(used)
    number[used] = np.arange(width, dtype=np.int32)
    symbols = number[stream]
    owner = np.repeat(owners, sizes)
    letters = np.bincount(owner, weights=stream != SEPARATOR, minlength=count) > 0
    # Triples that begin with the last two codes of a text would run into the next one.
    inside = np.ones(max(0, len(stream) - 2), bool)
    ends = np.cumsum(sizes)[:-1]
    cuts = np.concatenate([ends - 2, ends - 1])
    inside[cuts[(cuts >= 0) & (cuts < len(inside))]] = False
    symbols = symbols.astype(np.int32 if width**3 < 1 << 31 else np.int64)
    triples = ((symbols[:-2] * width + symbols[1:-1]) * width + symbols[2:])[inside]
    owner = owner[:-2][inside]
    if width**3 <= TABLE:
        place = np.zeros(width**3, np.int32)
        place[triples] = 1
        distinct = np.flatnonzero(place)
        place[distinct] = np.arange(len(distinct), dtype=np.int32)
        column = place[triples]
    else:
        distinct, column = np.unique(triples, return_inverse=True)
    parts = np.stack([distinct // width**2, distinct // width % width, distinct % width])
    return owner, column, used[parts], letters


def _bundled(streams: list[np.ndarray], owners: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the trigram vectors of each owner's streams, and which have letters; one batch."""
    owner, column, trigrams, letters = _trigrams(streams, np.asarray(owners), count)
    total = np.zeros((count, DIMENSION), np.float32)
    for begin in range(0, trigrams.shape[1], TRIGRAMS):
        part = trigrams[:, begin : begin + TRIGRAMS]
        size = part.shape[1]
        here = slice(None) if size == trigrams.shape[1] else (column >= begin) & (column < begin + size)
        cells = owner[here] * size + (column[here] - begin)
        counts = np.bincount(cells, minlength=count * size).reshape(count, size)
        codes, places = np.unique(part, return_inverse=True)
        basis = np.stack([letter_vector(int(code)) for code in codes])
        first, second, third = places.reshape(part.shape)
        bound = np.roll(basis, 2, axis=1)[first] * np.roll(basis, 1, axis=1)[second] * basis[third]
        # Whole numbers below 2 ** 24, which single precision holds exactly: a batch has fewer characters.
        total += counts.astype(np.float32) @ bound.astype(np.float32)
    return total, letters


def bundle(texts: list[str | None], owners: list[int], count: int) -> tuple[np.ndarray, np.ndarray]:
    """(count x DIMENSION) sums of the trigram vectors of each owner's texts, and which have letters."""
    vectors, letters = np.zeros((count, DIMENSION), np.int64), np.zeros(count, bool)
    batch: list[tuple[int, np.ndarray]] = []
    held = 0

    def add() -> None:
        nonlocal held
        if batch:
            own, local = np.unique([owner for owner, _ in batch], return_inverse=True)
            found, counted = _bundled([piece for _, piece in batch], local, len(own))
            vectors[own] += found.astype(np.int64)
            letters[own] |= counted
            batch.clear()
            held = 0

    for owner, text in zip(owners, texts, strict=True):
        stream = _codes(text or "")
        for begin in range(0, max(1, len(stream) - 2), BATCH_CHARS):
            # Pieces of a long text overlap by two codes, so that each trigram is in one of them.
            batch.append((owner, stream[begin : begin + BATCH_CHARS + 2]))
            held += len(batch[-1][1])
            if held >= BATCH_CHARS or len(batch) >= BATCH_TEXTS:
                add()
    add()
    return vectors, letters


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language of a partition: the sum of its documents' vectors."""
    common.begin_other_work()
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        own = sorted(set(langs))
        number = {lang: n for n, lang in enumerate(own)}
        for begin in range(0, len(langs), BATCH_TEXTS):
            part = texts.slice(begin, BATCH_TEXTS).to_pylist()
            owners = [number[lang] for lang in langs[begin : begin + BATCH_TEXTS]]
            vectors, _ = bundle(part, owners, len(own))
            for lang, vector in zip(own, vectors, strict=True):
                sums[lang] = sums[lang] + vector if lang in sums else vector
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))],
            ["lang", "sums"],
        )
    common.give_back()


def train(frame: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Normalised prototypes of all languages in the frame, from all of its rows with both values.

    Sums leave a partition as one row per language and are added up by component; what reaches the driver
    is one vector per language. Languages without letters in their texts have none.
    """
    rows = frame.select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")
    ).dropna()
    sums = rows.mapInArrow(_sums, "lang string, sums array<long>")
    parts = sums.select("lang", F.posexplode("sums").alias("component", "value"))
    totals = parts.groupBy("lang", "component").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for row in totals.collect():
        found.setdefault(row["lang"], np.zeros(DIMENSION))[row["component"]] = row["value"]
    norms = {name: np.linalg.norm(vector) for name, vector in found.items()}
    return {name: found[name] / norms[name] for name in sorted(found) if norms[name] > 0}


def predict(
    frame: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", **kept: Column
) -> DataFrame:
    """Add lang_pred and score (the cosine, 0 to 1) to every row.

    Text that is null or has no letter, and any text when there are no prototypes, is `und` with score 0;
    ties go to the language that sorts first; repeated rows are judged alike; texts of any length are read
    whole; an empty table gives no rows; columns of the added names are replaced.
    """
    names = list(prototypes)
    matrix = np.stack(list(prototypes.values())) if names else np.zeros((0, DIMENSION))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.begin_other_work()
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(begin, BATCH_TEXTS)
                yield _judged(part, names, matrix)
        common.give_back()

    rows = carried(frame.withColumns(kept), text=F.col(f"`{text}`").cast("string"))
    schema = T.StructType(
        [rows.schema[ROW], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    found = rows.mapInArrow(judged, schema)
    return delivered(found, lang_pred=F.col("lang_pred"), score=F.col("score"))


def _judged(part: pa.RecordBatch, names: list[str], matrix: np.ndarray) -> pa.RecordBatch:
    vectors, has_letters = bundle(part.column("text").to_pylist(), list(range(part.num_rows)), part.num_rows)
    langs, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
    if names and part.num_rows:
        norms = np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
        cosines = (vectors @ matrix.T) / np.maximum(norms, 1.0)
        best = cosines.argmax(axis=1)
        scores = np.where(has_letters, np.clip(cosines.max(axis=1), 0.0, 1.0), 0.0)
        langs = [names[b] if known else UNKNOWN for b, known in zip(best, has_letters, strict=True)]
    return pa.RecordBatch.from_arrays(
        [part.column(ROW), pa.array(langs, pa.string()), pa.array(scores)], [ROW, "lang_pred", "score"]
    )


def held_out(key: Column) -> Column:
    """Documents that take no part in learning: crc32 of the key as text leaves 2 when divided by 4."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2
