"""Exact top-k search by integer inner product, in tiles.

Queries and candidates are cut into tiles of bounded size that meet on (query tile, candidate tile). A task
multiplies the two matrices and keeps the best k of each query by partial selection. The lists are merged
by a tree: in every round the lists of some neighbouring candidate tiles become one list of k.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import partitions

#: Vectors of a tile on average. Tiles are cut by a hash of id and vector, so equal rows share one.
QUERY_TILE = 2048
CANDIDATE_TILE = 16_384
#: Candidate tiles whose lists meet in a round of the merge tree.
FAN_IN = 16
#: Whole numbers that double precision holds exactly, and what a score can be.
EXACT = 1 << 53
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Candidates that are scored at once.
SCORED = 4096

LISTS_DDL = "query_id long, tile long, vec_id long, score long"
LISTS = pa.schema([(n, pa.int64()) for n in ("query_id", "tile", "vec_id", "score")])


def whole_components(vectors: Column) -> Column:
    """floor(256 * x) of every component as a double that is a whole number; null if a vector takes no part."""
    usable = F.forall(
        vectors,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    scaled = F.transform(vectors, lambda x: F.floor(x.cast("double") * 256).cast("double"))
    return F.when(vectors.isNotNull() & usable, scaled)


def matrix_of(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as the rows of a matrix; missing components are zero."""
    ends = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    matrix = np.zeros((len(vectors), width))
    rows = np.repeat(np.arange(len(vectors)), sizes)
    matrix[rows, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)] = values[ends[0] : ends[-1]]
    return matrix


def scores_of(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond 64 bits stop at the largest or smallest such number."""
    largest = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * queries.shape[1]
    if largest < EXACT:
        return (queries @ candidates.T).astype(np.int64)
    as_int = np.frompyfunc(int, 1, 1)
    exact = as_int(queries) @ as_int(candidates).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def best_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k highest scores, ties to the smaller column."""
    rows, columns = scores.shape
    if columns > k:
        # The k-th score of each row; all higher ones, and of those equal to it the first that fit.
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        higher = scores > least
        room = k - higher.sum(axis=1, keepdims=True)
        equal = scores == least
        chosen = higher | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= room))
    else:
        chosen = np.ones((rows, columns), bool)
    return np.nonzero(chosen)


def _tile(key: tuple, group: pa.Table, k: int) -> pa.Table:
    """The k best candidates of the tile for each query of the query tile."""
    tile = key[1].as_py()
    asks = group["asks"].to_numpy()
    left, right = group.filter(pa.array(asks)), group.filter(pa.array(~asks)).sort_by("id")
    if not left.num_rows or not right.num_rows:
        return LISTS.empty_table()
    vectors = [pa.concat_arrays(t["vector"].chunks) for t in (left, right)]
    width = max(max(v.value_lengths().to_pylist()) for v in vectors)
    queries, candidates = (matrix_of(v, width) for v in vectors)
    query_ids, ids = left["id"].to_numpy(), right["id"].to_numpy()
    found = []
    for begin in range(0, len(ids), SCORED):
        part = ids[begin : begin + SCORED]
        scores = scores_of(queries, candidates[begin : begin + SCORED])
        own = query_ids[:, None] == part[None, :]
        scores[own] = LEAST
        rows, columns = best_of(scores, k + int(own.sum(axis=1).max()))
        keep = ~own[rows, columns]
        rows, columns = rows[keep], columns[keep]
        found.append((rows, part[columns], scores[rows, columns]))
    rows, chosen, values = (np.concatenate(part) for part in zip(*found, strict=True))
    # The complement of a whole number sorts in the opposite order and cannot overflow.
    order = np.lexsort((chosen, ~values, rows))
    rows, chosen, values = rows[order], chosen[order], values[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    rows, chosen, values = (part[rank < k] for part in (rows, chosen, values))
    arrays = [query_ids[rows], np.full(len(rows), tile), chosen, values]
    return pa.Table.from_arrays([pa.array(a, pa.int64()) for a in arrays], schema=LISTS)


def top_k(
    frame: DataFrame,
    is_query: Column,
    k: int = 5,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    query_tile: int = QUERY_TILE,
    candidate_tile: int = CANDIDATE_TILE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates, all if there are fewer.

    Candidates are all rows but those with the query's own key; ties go to the smaller key. Vectors that are
    null or hold null or non-finite components, and rows with a null key, take no part; shorter vectors
    count as ending in zeros, an empty one scores 0. Repeated rows are candidates of their own; queries of
    one key share one list. Scores beyond 64 bits stop at the largest or smallest such number. An empty
    table gives no rows; other columns take no part.
    """
    rows = frame.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        whole_components(F.col(f"`{vector}`")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    count, asking = rows.agg(F.count("id"), F.count_if("asks")).first()
    spark = frame.sparkSession
    query_tiles = max(1, ceil(asking / query_tile))
    tiles = max(ceil(count / candidate_tile), min(partitions(spark, 0, 1), ceil(count / 1024)), 1)

    def numbers(end: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(end - 1).cast("long")))

    # The number of a tile comes from a hash: tiles keep their size on average, and a retried task finds
    # every row in the same tile again.
    own_tile = F.pmod(F.xxhash64("id", "vector"), F.lit(tiles))
    own_query_tile = F.pmod(F.xxhash64("vector", "id"), F.lit(query_tiles))
    queries = rows.filter("asks").select(
        own_query_tile.alias("query_tile"), numbers(tiles).alias("tile"), "asks", "id", "vector"
    )
    candidates = rows.select(
        numbers(query_tiles).alias("query_tile"), own_tile.alias("tile"), F.lit(False).alias("asks"), "id", "vector"
    )
    met = queries.union(candidates).groupBy("query_tile", "tile")
    lists = met.applyInArrow(lambda key, group: _tile(key, group, k), LISTS_DDL)
    best = [F.desc("score"), F.asc("vec_id")]
    while tiles > FAN_IN:
        tiles = ceil(tiles / FAN_IN)
        nearer = lists.withColumn("tile", F.floor(F.col("tile") / FAN_IN).cast("long"))
        place = F.row_number().over(Window.partitionBy("query_id", "tile").orderBy(*best))
        lists = nearer.withColumn("rank", place).filter(F.col("rank") <= k).drop("rank")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*best))
    return (
        lists.withColumn("rank", place)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
