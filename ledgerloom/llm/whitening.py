"""Embeddings whitened by their leading principal components.

Components are turned into whole numbers and written as blocks, so sums are exact and every pass reads the
same. The leading eigenvectors of the covariance V come from Chebyshev-filtered subspace iteration: V is never
built. A pass over the blocks centres the vectors and adds up X'(XQ) for a narrow matrix Q, a polynomial of V by
its three-term recurrence (one pass for each degree) damps the part of Q that belongs to small eigenvalues, and
after QR a Rayleigh-Ritz pass gives eigenvalues, vectors and residuals. It ends when the residuals certify the
wanted vectors to about what double precision holds. Only matrices of the vectors' width are on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

# An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Whole numbers that double precision holds exactly; entries beyond stop there.
EXACT = 1 << 53
#: Vectors of a block.
BLOCK = 4096
#: Columns of Q for each wanted component, the degree of the polynomial, and rounds of filter and Ritz.
OVERSAMPLING, DEGREE, MOST_ROUNDS = 4, 12, 60
#: Residuals that certify, as a share of the largest eigenvalue, and those that do if they fall no further.
CERTIFIED, SETTLED = 2e-14, 1e-11
#: Eigenvalues below this share of the largest count as zero.
ZERO = 1e-12

BLOCK_DDL = "ids array<long>, x binary"
WHITE_DDL = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double"
)


def _usable(vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < infinite)
    )


def _blocks(width: int) -> Callable:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(begin, BLOCK)
                ids, vectors = piece.columns
                ends = vectors.offsets.to_numpy()
                sizes = np.diff(ends)
                entries = np.zeros((len(vectors), width))
                places = np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)
                values = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
                entries[np.repeat(np.arange(len(vectors)), sizes), places] = values
                with np.errstate(over="ignore"):
                    whole = np.clip(np.floor(SCALE * entries), -EXACT, EXACT - 2 * SHIFT) + SHIFT
                data = whole.astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                    ["ids", "x"],
                )

    return packed


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for data in batch.column("x"):
            yield np.frombuffer(data.as_buffer(), "<i8").reshape(-1, width)


class _Pass:
    """Sums over all blocks; every task gives one matrix, added up by rows."""

    def __init__(self, blocks: DataFrame, width: int):
        self._blocks, self.width = blocks.select("x"), width

    def _summed(self, matrix_of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        names, width = [f"c{n}" for n in range(shape[1])], self.width

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for x in _matrices(batches, width):
                total += matrix_of(x)
            columns = [pa.array(np.arange(shape[0]), pa.int32()), *[pa.array(c) for c in total.T]]
            yield pa.RecordBatch.from_arrays(columns, ["place", *names])

        ddl = ", ".join(["place int", *[f"{name} double" for name in names]])
        parts = self._blocks.mapInArrow(partial, ddl).groupBy("place").agg(*[F.sum(n).alias(n) for n in names])
        total = np.zeros(shape)
        for row in parts.collect():
            total[row["place"]] = [row[name] for name in names]
        return total

    def sums(self) -> tuple[int, list[int]]:
        """Number of vectors and exact sums by dimension: high and low halves are added apart."""
        width = self.width

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in _matrices(batches, width):
                arrays = [np.arange(width), (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), np.full(width, len(x))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()) for a in arrays], ["place", "high", "low", "n"]
                )

        parts = self._blocks.mapInArrow(partial, "place long, high long, low long, n long")
        exact = [F.sum(F.col(n).cast("decimal(28,0)")).alias(n) for n in ("high", "low", "n")]
        found = {r["place"]: r for r in parts.groupBy("place").agg(*exact).collect()}
        if not found:
            return 0, [0] * width
        totals = [(int(found[d]["high"]) << 32) + int(found[d]["low"]) for d in range(width)]
        return int(found[0]["n"]), totals

    def products(self, centred: Callable, q: np.ndarray, n: int) -> np.ndarray:
        """V Q, and the variances by dimension as a last column."""

        def matrix(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return np.column_stack([c.T @ (c @ q), np.einsum("ij,ij->j", c, c)]) / n

        return self._summed(matrix, (self.width, q.shape[1] + 1))

    def second_moments(self, whitened: Callable, count: int, n: int) -> np.ndarray:
        """Means of products of whitened components, and their means as a last column."""

        def matrix(x: np.ndarray) -> np.ndarray:
            w = whitened(x)
            return np.column_stack([w.T @ w, w.sum(0)]) / n

        return self._summed(matrix, (count, count + 1))


def _centring(sums: list[int], n: int) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n without rounding the mean: its whole part goes first, as integers."""
    whole = np.asarray([s // n for s in sums], np.int64)
    rest = np.asarray([s % n / n for s in sums])
    return lambda x: (x - whole) - rest


def _filtered(product: Callable, q: np.ndarray, upper: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of V applied to Q, small on [0, upper] and 1 or so at `top`."""
    middle = half = upper / 2
    sigma = first = half / (middle - top)
    before, now = q, (product(q) - middle * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        new = (product(now) - middle * now) * (2 * following / half) - (sigma * following) * before
        before, now, sigma = now, new, following
    return now


def leading_components(product: Callable, width: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit vectors as columns), largest first, without those that are zero."""
    columns = min(width, wanted * OVERSAMPLING)
    q = np.eye(width) if columns == width else np.random.default_rng(13).standard_normal((width, columns))
    least = np.inf
    for _ in range(MOST_ROUNDS):
        q, _ = np.linalg.qr(q)
        image = product(q)
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        if values[0] <= 0:
            return np.empty(0), np.empty((width, 0))
        count = min(wanted, int((values > ZERO * values[0]).sum()))
        residual = np.linalg.norm(image - q * values, axis=0)[:count].max() / values[0]
        if columns == width or residual <= CERTIFIED or (residual <= SETTLED and residual > least / 2):
            return values[:count], q[:, :count]
        least = min(least, residual)
        # Nothing is left to damp if the vectors span fewer dimensions than Q has.
        q = _filtered(product, q, max(values[-1], ZERO * values[0]), values[0])
    raise RuntimeError(f"eigenvectors not certified: residual {residual:.1e} after {MOST_ROUNDS} rounds")


def deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Exact sums of (n x - S)^2 by row; None where one does not fit into a long."""
    largest = max(n * int(np.abs(x).max(initial=0)), *map(abs, sums))
    if largest < 1 << 61:
        moved = n * x - np.asarray(sums, np.int64)
        if int(np.abs(moved).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (moved * moved).sum(1).tolist()
    exact = n * x.astype(object) - np.asarray(sums, object)
    return [v if v < 1 << 63 else None for v in (exact * exact).sum(1).tolist()]


def whiten(
    frame: DataFrame, key: str = "vec_id", vector: str = "embedding", *, components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row per vector and component.

    Rows whose vector is null or holds a null or non-finite entry take no part, nor do other columns. A shorter
    vector counts as filled up with zeros. Null and repeated keys are rows like others. Components whose
    eigenvalue is zero have no rows, so one vector, equal vectors or an empty table give none at all. Entries
    beyond 2^53 in scaled size stop there; a deviation that does not fit into a long is null. Vectors of one
    eigenvalue are any orthonormal set.
    """
    rows = frame.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    ).filter(_usable(F.col("v")))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    blocks = written(rows.mapInArrow(_blocks(width), BLOCK_DDL), "vector-blocks")
    passes = _Pass(blocks, width)
    n, sums = passes.sums()
    spark = frame.sparkSession
    ddl = f"{WHITE_DDL}, identity_error double"
    if not n:
        return spark.createDataFrame([], ddl)
    centred = _centring(sums, n)
    spread: list[float] = []

    def product(q: np.ndarray) -> np.ndarray:
        found = passes.products(centred, q, n)
        spread[:] = found[:, -1].tolist()
        return found[:, :-1]

    values, vectors = leading_components(product, width, components)
    if not len(values):
        return spark.createDataFrame([], ddl)
    explained, projection = values / sum(spread), vectors / np.sqrt(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        return centred(x) @ projection

    moments = passes.second_moments(whitened, len(values), n)
    covariance = moments[:, :-1] - np.outer(moments[:, -1], moments[:, -1])
    error = float(np.abs(covariance - np.eye(len(values))).max())

    def delivered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _matrices([batch], width), strict=True):
                count, own = len(x), len(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(pa.array(np.repeat(np.arange(count), own))),
                        pa.array(np.tile(np.arange(1, own + 1), count), pa.int32()),
                        pa.array(np.full(count * own, n), pa.int64()),
                        pa.array([d for d in deviations(x, sums, n) for _ in range(own)], pa.int64()),
                        pa.array(whitened(x).ravel()),
                        pa.array(np.tile(explained, count)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained"],
                )

    return blocks.mapInArrow(delivered, WHITE_DDL).withColumn("identity_error", F.lit(error))
