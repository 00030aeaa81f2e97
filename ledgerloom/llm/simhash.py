"""Near-duplicates by SimHash fingerprints, found with vantage-point trees.

A document's fingerprint has a bit set where over half of its shingles' hashes have it. Equal fingerprints
collapse to one point each. Two points that differ in at most `max_bits` bits of 64 differ in at most half
as many in one of their 32-bit halves, so each half gets a forest of its own with that smaller radius,
where far fewer points lie near a boundary.

A vantage-point tree is built from a bounded sample of points: each node takes a vantage point and the
median of the distances to it, and splits what is inside from what is outside. Every point belongs to one
leaf, its shard. It also visits all other leaves that the triangle bound cannot rule out: those where its
distance to the vantage point is within the radius of the boundary. A shard with too many rows is split by
a smaller tree over a sample of its own rows, again and again; its vantage points may look at the other half,
where linked points differ in `max_bits` at most, so points that share a half are told apart as well. Rows too
close to each other for any cut are compared in pairs of blocks. In each shard the tree is carried on over
the shard's own points until few are left; those are compared exactly, on all 64 bits. A shard hands on a
spanning forest of the links it found, never all pairs. Components of the links are then found by rounds of
star contraction, with each round's edges written to the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import common
from ledgerloom.llm.common import ROW, WORD, carried, delivered, written

#: Shingle length in words, most differing bits, and the seed of the shingle hash.
SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42

#: Points that the trees are built from; a documented bound on what the driver holds.
SAMPLE_POINTS = 60_000
#: Distinct points that a shard should own; trees are as deep as this and the sample allow.
SHARD_POINTS = 2_000
#: A node with fewer sampled points is a leaf.
LEAF_SAMPLE = 40
#: Rows of a shard from which on it is split; it bounds what a task compares, to about twice as many.
SHARD_ROWS = 100_000
#: Levels of a crowded shard's own tree, rows it is built from (of those owned, and of all), and rounds of
#: splitting that shard numbers of 64 bits have room for.
SUBTREE_LEVELS, SUBTREE_SAMPLE, MOST_ROUNDS = 4, 1_000, 10
SUBTREE_NODES = (1 << SUBTREE_LEVELS) - 1
#: Squared shares of a cut's two sides from which on blocks copy fewer rows, and the bound of no cut at all.
WORTHWHILE, EVERYTHING = 0.9, 127
#: Owned points below which a shard's tree goes no deeper, and the block that is compared at once.
COMPARED = 512
BLOCK_ROWS, BLOCK_POINTS = 64, 32_768

_WORDS = re.compile(WORD)
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def shingles(text: str | None, length: int = SHINGLE_WORDS) -> list[str]:
    """Word shingles of the text with A-Z lower-cased, repeats included; fewer words are one shingle."""
    words = _WORDS.findall((text or "").translate(_LOWER))
    if len(words) < length:
        return [" ".join(words)] if words else []
    return list(map(" ".join, zip(*[words[n:] for n in range(length)], strict=False)))


def simhash(text: str | None, length: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint; zero without words."""
    found = shingles(text, length)
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, HASH_SEED) for s in found), np.uint64, len(found))
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 4096):
        part = np.unpackbits(hashes[begin : begin + 4096].view(np.uint8).reshape(-1, 8), axis=1)
        ones += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int(bits.view(np.uint64)[0])


def fingerprinted(frame: DataFrame, text: str, length: int) -> DataFrame:
    """The carried rows with a serial number and their fingerprint as a signed 64-bit number."""
    rows = carried(
        frame, serial=F.monotonically_increasing_id(), text=F.col(f"`{text}`").cast("string")
    )
    schema = T.StructType(
        [rows.schema[ROW], T.StructField("serial", T.LongType()), T.StructField("fingerprint", T.LongType())]
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.begin_other_work()
        for batch in batches:
            found = [simhash(t.as_py(), length) for t in batch.column("text")]
            signed = np.asarray(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("serial"), pa.array(signed)], names=schema.names
            )
        common.give_back()

    return rows.mapInArrow(hashed, schema)


# --- vantage-point trees ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a child below zero is the leaf of number -1 - child."""

    vantage: np.ndarray
    bound: np.ndarray
    inside: np.ndarray
    outside: np.ndarray
    leaves: int


def build_tree(points: np.ndarray, leaf_points: int, seed: int = 0) -> Tree:
    """A tree over sampled 32-bit points: random vantage points, median distances as boundaries."""
    generator = np.random.default_rng(seed)
    vantage, bound, children, leaves = [], [], [], 0

    def grow(own: np.ndarray) -> int:
        nonlocal leaves
        for _ in range(4 if len(own) > leaf_points else 0):
            point = own[generator.integers(len(own))]
            distances = np.bitwise_count(own ^ point)
            middle = int(np.median(distances))
            within = distances <= middle
            if within.all():  # at a tie of most distances, the boundary goes below it
                middle -= 1
                within = distances <= middle
            if within.any() and not within.all():
                node = len(vantage)
                vantage.append(point)
                bound.append(middle)
                children.append(None)
                children[node] = (grow(own[within]), grow(own[~within]))
                return node
        leaves += 1
        return -leaves

    root = grow(points)
    if root < 0:
        vantage, bound, children, leaves = [np.uint32(0)], [64], [(-1, -2)], 2
    sides = np.asarray(children, np.int64)
    return Tree(np.asarray(vantage, np.uint32), np.asarray(bound, np.int64), sides[:, 0], sides[:, 1], leaves)


def descend(tree: Tree, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, leaves, owned): every leaf each point visits; it owns the one its own side leads to.

    A side is ruled out only where the triangle bound shows that no point within `radius` can be there.
    """
    rows, leaves, owned = [], [], []
    stack = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        node, here, own = stack.pop()
        if not len(here):
            continue
        if node < 0:
            rows.append(here)
            leaves.append(np.full(len(here), -1 - node))
            owned.append(own)
            continue
        distances = np.bitwise_count(points[here] ^ tree.vantage[node]).astype(np.int64)
        bound = tree.bound[node]
        within = distances <= bound
        may_inside, may_outside = distances <= bound + radius, distances > bound - radius
        stack.append((int(tree.inside[node]), here[may_inside], (own & within)[may_inside]))
        stack.append((int(tree.outside[node]), here[may_outside], (own & ~within)[may_outside]))
    if not rows:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, bool)
    return np.concatenate(rows), np.concatenate(leaves), np.concatenate(owned)


class Links:
    """Links of numbered points, of which only a spanning forest is kept."""

    def __init__(self, count: int):
        self._parent = np.arange(count)
        self.kept: list[np.ndarray] = []

    def roots(self, numbers: np.ndarray) -> np.ndarray:
        found = self._parent[numbers]
        while (further := self._parent[found] != found).any():
            found[further] = self._parent[found[further]]
        self._parent[numbers] = found
        return found

    def star(self, point: int, others: np.ndarray) -> None:
        """Link a point with others: one link is kept for each tree that it joins to its own."""
        found, first = np.unique(self.roots(others), return_index=True)
        own = self.roots(np.asarray([point]))[0]
        apart = found != own
        if apart.any():
            ends = others[first[apart]]
            self.kept.append(np.column_stack([np.full(len(ends), point), ends]))
            self._parent[found[apart]] = own

    def edges(self) -> np.ndarray:
        return np.concatenate(self.kept) if self.kept else np.empty((0, 2), np.int64)


@dataclass(frozen=True)
class Cut:
    """One vantage point and its boundary, in one of the two halves, and what it does to the rows at hand."""

    side: int
    vantage: int
    bound: int
    within: np.ndarray
    reach: np.ndarray
    beyond: np.ndarray


def cuts(
    sides: Sides, radii: tuple[int, int], own: np.ndarray, visiting: np.ndarray, generator, tries: int
) -> Iterator[Cut]:
    """Cuts at the median distance of the owned rows: first in the tree's own half, then in the other."""
    for side, (values, radius) in enumerate(zip(sides, radii, strict=True)):
        for _ in range(tries):
            vantage = values[own[generator.integers(len(own))]]
            near, far = (np.bitwise_count(values[x] ^ vantage).astype(np.int64) for x in (own, visiting))
            bound = int(np.median(near))
            if (near <= bound).all():  # at a tie of most distances, the boundary goes below it
                bound -= 1
            within = near <= bound
            if within.any():
                yield Cut(side, int(vantage), bound, within, far <= bound + radius, far > bound - radius)


def link_shard(
    points: np.ndarray, half: int, owned: np.ndarray, max_bits: int, part: np.ndarray | None = None
) -> Links:
    """Links between the owned points of a shard and all points that visit it.

    The shard's tree is carried on over its own points: pairs of (owned, visiting) rows that a vantage
    point's triangle bound separates are never compared, and neither are rows connected before. Where
    `part` tells two parts apart, only pairs with one row in each are wanted.
    """
    links = Links(len(points))
    sides, radii = _sides(points, half), (max_bits // 2, max_bits)
    generator = np.random.default_rng(len(points))
    everyone = np.arange(len(points))
    if part is None:
        stack = [(everyone[owned], everyone)]
    else:
        stack = [(everyone[owned & (part == n)], everyone[part != n]) for n in (0, 1)]
    while stack:
        own, visiting = stack.pop()
        if not len(own) or not len(visiting):
            continue
        if len(own) > COMPARED:
            before = len(own) * len(visiting)
            for cut in cuts(sides, radii, own, visiting, generator, 6):
                after = cut.within.sum() * cut.reach.sum() + (~cut.within).sum() * cut.beyond.sum()
                if after < 0.9 * before:
                    stack.append((own[cut.within], visiting[cut.reach]))
                    stack.append((own[~cut.within], visiting[cut.beyond]))
                    break
            else:
                _compare(links, points, owned, own, visiting, max_bits)
            continue
        _compare(links, points, owned, own, visiting, max_bits)
    return links


def _compare(
    links: Links, points: np.ndarray, owned: np.ndarray, own: np.ndarray, visiting: np.ndarray, max_bits: int
) -> None:
    """Compare blocks of owned points with blocks of visiting ones, leaving out those in one tree already."""
    for first in range(0, len(visiting), BLOCK_POINTS):
        here = visiting[first : first + BLOCK_POINTS]
        for begin in range(0, len(own), BLOCK_ROWS):
            block = own[begin : begin + BLOCK_ROWS]
            others, tree = here, links.roots(block)
            if (tree == tree[0]).all():
                others = here[links.roots(here) != tree[0]]
                if not len(others):
                    continue
            near = np.bitwise_count(points[block][:, None] ^ points[others][None, :]) <= max_bits
            rows, columns = np.nonzero(near)
            left, right = block[rows], others[columns]
            # A point itself, and pairs of two owned points from their other side, say nothing new.
            new = (left != right) & ~(owned[right] & (left > right))
            left, right = left[new], right[new]
            heads = np.flatnonzero(np.diff(left, prepend=-1))
            for point, near_it in zip(left[heads].tolist(), np.split(right, heads[1:]), strict=False):
                links.star(point, near_it)


# --- shards of bounded size -------------------------------------------------------------------------


def build_subtree(points: np.ndarray, half: int, owned: np.ndarray, max_bits: int) -> tuple[list, list, list] | None:
    """A tree of SUBTREE_LEVELS levels, as a heap, that splits a crowded shard; None where none pays.

    A cut sends rows to both sides if they are near its boundary. Where the two sides' shares of the rows
    are r and s, comparing blocks of rows copies fewer of them than the cut does unless r^2 + s^2 < 1.
    A node without a worthwhile cut hands all its rows to its inner side.
    """
    nodes = SUBTREE_NODES
    side, vantage, bound = [0] * nodes, [0] * nodes, [EVERYTHING] * nodes
    sides, radii = _sides(points, half), (max_bits // 2, max_bits)
    generator = np.random.default_rng(len(points))
    stack = [(0, np.flatnonzero(owned), np.arange(len(points)))]
    while stack:
        node, own, visiting = stack.pop()
        if node >= nodes or len(own) < 2:
            continue
        found = list(cuts(sides, radii, own, visiting, generator, 8))
        costs = [cut.reach.mean() ** 2 + cut.beyond.mean() ** 2 for cut in found]
        if min(costs, default=1.0) >= WORTHWHILE:
            if not node:
                return None
            continue
        cut = found[int(np.argmin(costs))]
        side[node], vantage[node], bound[node] = cut.side, cut.vantage, cut.bound
        stack.append((2 * node + 1, own[cut.within], visiting[cut.reach]))
        stack.append((2 * node + 2, own[~cut.within], visiting[cut.beyond]))
    return side, vantage, bound


def descend_subtrees(
    points: np.ndarray, half: np.ndarray, owned: np.ndarray, trees: tuple[np.ndarray, ...], max_bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, leaves, owned) of every row in the subtree of its own shard; trees are matrices by row."""
    side, vantage, bound = trees
    upper, lower = _halves(points.view(np.int64))
    rows, nodes, own = np.arange(len(points)), np.zeros(len(points), np.int64), owned
    for _ in range(SUBTREE_LEVELS):
        # Side 0 is the half of the row's own tree, 1 the other one.
        in_own = side[rows, nodes] == 0
        value = np.where((half[rows] == 0) == in_own, upper[rows], lower[rows])
        radius = np.where(in_own, max_bits // 2, max_bits)
        distance = np.bitwise_count(value ^ vantage[rows, nodes].astype(np.uint32)).astype(np.int64)
        limit = bound[rows, nodes]
        within, inside, outside = distance <= limit, distance <= limit + radius, distance > limit - radius
        own = np.concatenate([(own & within)[inside], (own & ~within)[outside]])
        nodes = np.concatenate([2 * nodes[inside] + 1, 2 * nodes[outside] + 2])
        rows = np.concatenate([rows[inside], rows[outside]])
    return rows, nodes - SUBTREE_NODES, own


SHARD_DDL = "half int, leaf long, point long, owned boolean"
TREE_DDL = "half int, leaf long, side array<int>, vantage array<long>, bound array<int>"
EDGE_DDL = "a long, b long"
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])

Sides = tuple[np.ndarray, np.ndarray]


def _halves(points: np.ndarray) -> Sides:
    whole = points.view(np.uint64)
    return (whole >> np.uint64(32)).astype(np.uint32), whole.astype(np.uint32)


def _sides(points: np.ndarray, half: int) -> Sides:
    """The half that a tree is over, and the other one."""
    both = _halves(points)
    return both[half], both[1 - half]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, SUBTREE_NODES)


def _split(visits: DataFrame, crowded: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows of the crowded shards in smaller ones, shards that no cut separates)."""
    keys = ["half", "leaf"]

    def grown(key: tuple, group: pa.Table) -> pa.Table:
        points = group["point"].to_numpy().view(np.uint64)
        found = build_subtree(points, key[0].as_py(), group["owned"].to_numpy(), max_bits)
        side, vantage, bound = found or (None, None, None)
        lists = [pa.array([side], pa.list_(pa.int32())), pa.array([vantage], pa.list_(pa.int64()))]
        columns = [pa.array([k.as_py()], k.type) for k in key]
        names = [*keys, "side", "vantage", "bound"]
        return pa.table([*columns, *lists, pa.array([bound], pa.list_(pa.int32()))], names=names)

    def smaller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half, leaf, point = (batch.column(n).to_numpy() for n in range(3))
            owned = batch.column("owned").to_numpy(zero_copy_only=False)
            trees = tuple(_matrix(batch.column(n)) for n in ("side", "vantage", "bound"))
            rows, below, own = descend_subtrees(point.view(np.uint64), half, owned, trees, max_bits)
            leaves = (leaf[rows] << SUBTREE_LEVELS) + below
            yield pa.RecordBatch.from_arrays(
                [pa.array(half[rows]), pa.array(leaves), pa.array(point[rows]), pa.array(own)],
                ["half", "leaf", "point", "owned"],
            )

    luck = F.pmod(F.xxhash64(F.lit(2), "leaf", "point"), F.lit(1 << 30)) / F.lit(1 << 30)
    # Rows that a shard owns count for as much in its sample as all that visit it.
    share = F.when(F.col("owned"), SUBTREE_SAMPLE / F.col("own_rows")).otherwise(SUBTREE_SAMPLE / F.col("rows"))
    sampled = visits.join(crowded, keys).filter(luck < share).select(*visits.columns)
    trees = written(sampled.groupBy(*keys).applyInArrow(grown, TREE_DDL), "subtrees")
    joined = visits.join(trees.filter("side is not null"), keys)
    return (
        joined.select(*visits.columns, "side", "vantage", "bound").mapInArrow(smaller, SHARD_DDL),
        crowded.join(trees.filter("side is not null"), keys, "left_anti"),
    )


def _shards(visits: DataFrame, max_bits: int, shard_rows: int) -> DataFrame:
    """The visits in groups (round, half, leaf, low, high) of about 2 x shard_rows rows at most.

    Crowded shards are split by trees of their own, sampled from themselves, round after round. What no
    cut separates lies within few bits of each other: its rows are dealt into blocks, and a group holds
    two blocks, so that every pair of rows meets in one of them.
    """
    keys = ["half", "leaf"]
    groups = [*keys, "point", "owned"]
    done: list[DataFrame] = []
    for number in count():
        sizes = visits.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("owned").alias("own_rows")
        )
        crowded = written(sizes.filter(F.col("rows") > shard_rows), "crowded")
        none = crowded.isEmpty()
        calm = visits if none else visits.join(crowded, keys, "left_anti")
        nothing = F.lit(0).cast("long")
        done.append(
            calm.select(F.lit(number).alias("round"), *groups, *[nothing.alias(n) for n in ("low", "high", "part")])
        )
        if none:
            break
        # A shard that owns nothing has nothing to compare.
        crowded = crowded.filter("own_rows > 0")
        if number < MOST_ROUNDS:
            following, dense = _split(visits, crowded, max_bits)
            following = written(following, "visits")
        else:
            following, dense = visits.limit(0), crowded
        blocks = F.ceil(F.col("rows") / shard_rows)
        dealt = visits.join(dense, keys).withColumns(
            {"blocks": blocks, "part": F.pmod(F.xxhash64(F.lit(3), "point"), blocks)}
        )
        met = dealt.withColumn("other", F.explode(F.sequence(nothing, F.col("blocks") - 1)))
        pair = {"low": F.least("part", "other"), "high": F.greatest("part", "other")}
        done.append(met.withColumns(pair).select(F.lit(-1 - number).alias("round"), *groups, "low", "high", "part"))
        visits = following
    return reduce(DataFrame.unionByName, done)


def links(
    points: DataFrame,
    max_bits: int = MAX_BITS,
    *,
    sample_points: int = SAMPLE_POINTS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Edges (a, b) that connect all distinct values of `point` that differ in at most max_bits bits.

    The edges are a spanning forest for each shard: every link lies within a component, and no component
    is split, but copies of a link are left out.
    """
    total = points.count()
    share = min(1.0, sample_points / max(total, 1))
    luck = F.pmod(F.xxhash64(F.lit(1), "point"), F.lit(1 << 30)) / F.lit(1 << 30)
    sampled = points.filter(luck < share).select("point").toArrow()["point"].to_numpy().copy()
    leaf_points = max(LEAF_SAMPLE, int(SHARD_POINTS * share))
    trees = [build_tree(half, leaf_points, n) for n, half in enumerate(_halves(sampled))] if total else []
    radius = max_bits // 2

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for number, (tree, half) in enumerate(zip(trees, _halves(own), strict=True)):
                rows, leaves, owned = descend(tree, half, radius)
                numbers = pa.array(np.full(len(rows), number, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [numbers, pa.array(leaves), pa.array(own[rows]), pa.array(owned)],
                    ["half", "leaf", "point", "owned"],
                )

    def compared(key: tuple, group: pa.Table) -> pa.Table:
        held = group["point"].to_numpy().view(np.uint64)
        low, high = key[3].as_py(), key[4].as_py()
        part = None if low == high else (group["part"].to_numpy() == high).astype(np.int64)
        kept = link_shard(held, key[1].as_py(), group["owned"].to_numpy(), max_bits, part).edges()
        ends = held.view(np.int64)
        return pa.table({"a": ends[kept[:, 0]], "b": ends[kept[:, 1]]}, schema=EDGES)

    if not trees:
        return points.sparkSession.createDataFrame([], EDGE_DDL)
    visits = written(points.select("point").mapInArrow(shards, SHARD_DDL), "visits")
    grouped = _shards(visits, max_bits, shard_rows).groupBy("round", "half", "leaf", "low", "high")
    return grouped.applyInArrow(compared, EDGE_DDL)


# --- components -------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(point, root): the smallest point that each point of the edges can reach.

    Large-star and small-star contraction in turns, until every point hangs on its root. All work is
    joins and minima, which combine before they are shuffled; no point's neighbours are ever collected.
    """
    edges = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while True:
        # Large star: larger neighbours of a point move to the smallest point around it.
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # Small star: smaller neighbours of a point, and itself, move to the smallest of them.
        down = moved.filter("a <> b").distinct()
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(lowest, "a")
        contracted = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            lowest.select("a", F.col("m").alias("b"))
        )
        following = written(contracted.filter("a <> b").distinct(), "edges")
        # Stars only: nobody's root has a root itself, and every point has one root.
        roots = following.select(F.col("b").alias("a")).distinct()
        chained = following.join(roots, "a", "left_semi").isEmpty()
        edges = following
        if chained and edges.groupBy("a").count().filter("count > 1").isEmpty():
            break
    return edges.select(F.col("a").alias("point"), F.col("b").alias("root"))


def near_duplicates(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    carry: Column | list[str] | None = None,
) -> DataFrame:
    """Add fingerprint (16 hex digits), component_id and `stays` (one row of each component) to every row.

    A component holds what chains of fingerprints at most `max_bits` bits apart reach; component_id is its
    smallest key, null only if it has none but null keys. `stays` marks the row with that key, the first of
    repeated ones. Null text and text without words have fingerprint zero, which is linked like any other;
    an empty table gives no rows; `carry` names the columns to keep (all by default), and columns of the
    added names are replaced. Texts are hashed whole.
    """
    kept = frame.columns if carry is None else carry
    plain = frame.select(*[F.col(f"`{name}`") for name in dict.fromkeys([*kept, key, text])])
    rows = written(
        fingerprinted(plain, text, shingle_words).select(
            F.struct(*[F.col(f"row.`{name}`").alias(name) for name in dict.fromkeys([*kept, key])]).alias(ROW),
            F.col(f"row.`{key}`").cast("long").alias("key"),
            "serial",
            "fingerprint",
        ),
        "fingerprints",
    )
    # A null key comes after all others.
    first = F.struct(F.col("key").isNull().alias("unknown"), "key", "serial")
    points = written(
        rows.groupBy(F.col("fingerprint").alias("point")).agg(F.min(first).alias("first")), "points"
    )
    roots = components(links(points, max_bits))
    rooted = points.join(roots, "point", "left").withColumn("root", F.coalesce("root", "point"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    known = rooted.join(heads, "root").select("point", "head")
    joined = rows.join(known, rows["fingerprint"] == known["point"])
    return delivered(
        joined,
        fingerprint=F.lower(F.lpad(F.hex("fingerprint"), 16, "0")),
        component_id=F.col("head.key"),
        stays=F.col("serial") == F.col("head.serial"),
    )
