"""Nearest neighbours by inner product: vantage-point trees per shard, pruned by the triangle inequality.

Vectors are lifted to one more coordinate, sqrt(M*M - |x|*|x|) with M the largest
length, and queries get 0 there. Then the squared distance of a query to a point
is |q|*|q| + M*M - 2<q, x>: the nearest point has the largest inner product, and
the triangle inequality holds, as trees need.

A node has a vantage point and the median distance of its points to it. A query at
distance d from the vantage point, with its k-th best distance r so far, can skip
the inner half if d - r > median and the outer half if d + r < median. The factor
relaxes that to factor * r: at 1 the search is exact, below it more is skipped.

Data flow: the upper levels of a vantage-point tree, made from a bounded sample, cut the candidates into shards of
bounded size that each cover a part of the space. A task holds the tree of one shard, and queries pass by in batches.
A query first asks the shard it lies in, which gives it a k-th best distance; then, by the same inequality, only
shards that may hold something nearer. Every vector is moved to its shard and never copied; what is copied is a query, once
for each shard that is left open to it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentledger.sources.shared import durable

K, FACTOR, LEAF = 20, 1.0, 256
SHARDS, LEAST_ROWS, MOST_ROWS = 256, 8_192, 131_072  # shards to make, and rows of a shard at least and at most
SAMPLE, PER_LEAF = 65_536, 32  # vectors that the upper levels are made from, at most, and of each shard
ASKED = "shard long, kind int, vec_id long, embedding array<double>, least double"
HITS = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `embedding` as doubles, `norm`; without null and zero vectors, and ones with parts that are null or not finite.

    Rows without an id take no part either, nor do vectors whose squared length overflows.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    sound = vectors.select("vec_id", doubles.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    )
    return sound.withColumn("norm", norm).where((F.col("norm") > 0) & (F.col("norm") < F.lit(float("inf"))))


def _slack(squares: np.ndarray) -> float:
    """What distances between points of such squared lengths may be off by."""
    return 1e-7 * max(1.0, math.sqrt(float(squares.max(initial=0.0))))


class Tree:
    """Nodes as tuples: a leaf is an array of rows, an inner node is (vantage row, median, inner, outer)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.leaf = points, leaf
        self.squares = np.einsum("ij,ij->i", points, points)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        # The point farthest from another one is a good vantage point: distances from it vary.
        some = self.distances(self.points[rows[:1]], rows)[0]
        vantage = rows[int(some.argmax())]
        apart = self.distances(self.points[vantage][None], rows)[0]
        median = float(np.median(apart))
        inside = apart <= median
        if inside.all():  # many equal points
            half = len(rows) // 2
            return (vantage, math.inf, self._halves(rows[:half]), self._halves(rows[half:]))
        return (vantage, median, self._build(rows[inside]), self._build(rows[~inside]))

    def _halves(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        half = len(rows) // 2
        return (rows[0], math.inf, self._halves(rows[:half]), self._halves(rows[half:]))

    def distances(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        squares = np.einsum("ij,ij->i", queries, queries)[:, None] + self.squares[rows][None]
        return np.sqrt(np.maximum(squares - 2 * queries @ self.points[rows].T, 0))

    def search(self, queries: np.ndarray, offer: Callable[[np.ndarray, np.ndarray], None], reach: np.ndarray, factor: float) -> None:
        """Offer every leaf that is not pruned. `reach` holds each query's k-th best distance; `offer` brings it down."""
        slack = _slack(self.squares)  # distances are rounded; a leaf at the very edge is still looked at

        def down(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                offer(active, node)
                return
            vantage, median, inner, outer = node
            if math.isinf(median):
                down(inner, active)
                down(outer, active)
                return
            d = self.distances(queries[active], np.array([vantage]))[:, 0]
            near = d <= median
            for nearer in (True, False):  # each query's own side first: it lowers the reach for the other
                own = near if nearer else ~near
                down(inner if nearer else outer, active[own])
            for nearer in (True, False):
                other = active[near if nearer else ~near]
                gap = d[near if nearer else ~near]
                gap = median - gap if nearer else gap - median
                down(outer if nearer else inner, other[gap <= factor * reach[other] + slack])

        down(self.root, np.arange(len(queries)))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    return np.column_stack([vectors, np.sqrt(np.maximum(longest * longest - np.einsum("ij,ij->i", vectors, vectors), 0))])


def flat(queries: np.ndarray) -> np.ndarray:
    return np.column_stack([queries, np.zeros(len(queries))])


def reach_of(queries: np.ndarray, longest: float, scores: np.ndarray) -> np.ndarray:
    """Distance at which a candidate has this score; without end where there is none."""
    base = np.einsum("ij,ij->i", queries, queries) + longest * longest
    return np.where(np.isfinite(scores), np.sqrt(np.maximum(base - 2 * np.where(np.isfinite(scores), scores, 0), 0)), np.inf)


class Shard:
    """Candidates of one shard and their tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float) -> None:
        self.ids, self.vectors, self.longest = ids, vectors, longest
        self.tree = Tree(lifted(vectors, longest))

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float, least: np.ndarray | None = None) -> pd.DataFrame:
        """The k best candidates for each query that score `least` or more, by exact inner products."""
        ids, vectors = self.ids, self.vectors
        least = np.full(len(queries), -np.inf) if least is None else least
        scores = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), np.iinfo(np.int64).max)
        reach = reach_of(queries, self.longest, least)

        def offer(active: np.ndarray, rows: np.ndarray) -> None:
            near = queries[active] @ vectors[rows].T  # rounded differently by place, so only a first sieve
            near[ids[rows][None] == query_ids[active][:, None]] = -np.inf
            bar = np.maximum(scores[active, -1], least[active])[:, None]
            bar = bar - 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(bar), bar, 0)))
            some = ((near >= bar) & ~np.isneginf(near)).any(axis=1)
            active, near, bar = active[some], near[some], bar[some]
            if not len(active):
                return
            fresh = np.full(near.shape, -np.inf)
            row, column = np.nonzero((near >= bar) & ~np.isneginf(near))
            fresh[row, column] = np.einsum("ij,ij->i", queries[active[row]], vectors[rows[column]])
            fresh[fresh < least[active][:, None]] = -np.inf
            both = np.hstack([scores[active], fresh])
            names = np.hstack([found[active], np.broadcast_to(ids[rows], fresh.shape)])
            order = np.lexsort((names, -both), axis=1)[:, :k]
            scores[active] = np.take_along_axis(both, order, 1)
            found[active] = np.take_along_axis(names, order, 1)
            reach[active] = reach_of(queries[active], self.longest, np.maximum(scores[active, -1], least[active]))

        self.tree.search(flat(queries), offer, reach, factor)
        row, column = np.nonzero(np.isfinite(scores))
        return pd.DataFrame({"query_id": query_ids[row], "vec_id": found[row, column], "score": scores[row, column]})


def best_in_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, longest: float, k: int, factor: float) -> pd.DataFrame:
    return Shard(ids, vectors, longest).best(query_ids, queries, k, factor)


def _apart(points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(np.einsum("ij,ij->i", points, points) + vantage @ vantage - 2 * points @ vantage, 0))


@dataclass
class Space:
    """The upper levels for vectors of one length: a leaf is a number, an inner node (vantage point or None, median, inner, outer).

    A node without a vantage point parts equal points by a hash; both sides are always looked at. Where the
    leaves are too large, a hash deals each to `parts` shards.
    """

    longest: float
    root: object = 0
    leaves: int = 1
    parts: int = 1
    first: int = 0  # number of the first shard

    @classmethod
    def build(cls, longest: float, sample: np.ndarray, shards: int) -> Space:
        own, per_leaf = cls(longest, leaves=0), -(-len(sample) // shards) if shards else 1

        def made(rows: np.ndarray):
            if len(rows) <= max(1, per_leaf) or len(rows) < 2:
                own.leaves += 1
                return own.leaves - 1
            vantage = sample[rows[int(_apart(sample[rows], sample[rows[0]]).argmax())]]
            apart = _apart(sample[rows], vantage)
            median = float(np.median(apart))
            inside = apart <= median
            if inside.all():
                half = len(rows) // 2
                return (None, 0.0, made(rows[:half]), made(rows[half:]))
            return (vantage, median, made(rows[inside]), made(rows[~inside]))

        own.root = made(np.arange(len(sample)))
        return own

    @property
    def shards(self) -> int:
        return self.leaves * self.parts

    def route(self, points: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The shard of each point."""
        found = np.zeros(len(points), np.int64)

        def down(node, rows: np.ndarray, depth: int) -> None:
            if not len(rows):
                return
            if isinstance(node, int):
                found[rows] = node
                return
            vantage, median, inner, outer = node
            inside = (hashes[rows] >> np.uint64(depth % 60)) & np.uint64(1) == 0 if vantage is None else _apart(points[rows], vantage) <= median
            down(inner, rows[inside], depth + 1)
            down(outer, rows[~inside], depth + 1)

        down(self.root, np.arange(len(points)), 0)
        return self.first + found * self.parts + (hashes % np.uint64(self.parts)).astype(np.int64)

    def visits(self, queries: np.ndarray, reach: np.ndarray, factor: float) -> Iterator[tuple[np.ndarray, int]]:
        """Every leaf that is not pruned, with the queries that may find something in it."""
        slack = _slack(np.array([self.longest * self.longest]))
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                yield rows, node
                continue
            vantage, median, inner, outer = node
            if vantage is None:
                stack += [(inner, rows), (outer, rows)]
                continue
            gap = _apart(queries[rows], vantage) - median
            limit = factor * reach[rows] + slack
            stack += [(inner, rows[(gap <= 0) | (gap <= limit)]), (outer, rows[(gap > 0) | (-gap <= limit)])]


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ids, vectors and a hash of the ids."""
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
    own = batch.column("embedding")
    ends, parts = own.offsets.to_numpy(), own.flatten().to_numpy(zero_copy_only=False)
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ids, [parts[a - ends[0] : b - ends[0]] for a, b in zip(ends, ends[1:])], mixed ^ (mixed >> np.uint64(29))


def _by_length(vectors: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    lengths = np.array([len(v) for v in vectors])
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield n, rows, np.vstack([vectors[i] for i in rows])


def _rows(shard: np.ndarray, kind: int, ids: np.ndarray, vectors: np.ndarray, least: np.ndarray | None) -> pa.RecordBatch:
    n, dims = len(ids), vectors.shape[1]
    embedding = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dims, dims), pa.int32()), pa.array(vectors.ravel(), pa.float64()))
    low = pa.nulls(n, pa.float64()) if least is None else pa.array(least, pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(ids, pa.int64()), embedding, low], names=["shard", "kind", "vec_id", "embedding", "least"])


def _placed(shared, query: bool) -> Callable:
    """Every vector with its shard: as a candidate, or as a query that asks it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, hashes = _arrays(batch)
            for n, rows, own in _by_length(vectors):
                space = shared.value[n]
                points = flat(own) if query else lifted(own, space.longest)
                yield _rows(space.route(points, hashes[rows]), int(query), ids[rows], own, np.full(len(rows), -np.inf) if query else None)

    return run


def _open_shards(shared, factor: float) -> Callable:
    """Every query, once for each further shard that may hold something better than `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, hashes = _arrays(batch)
            least = batch.column("least").to_numpy(zero_copy_only=False)
            for n, rows, own in _by_length(vectors):
                space, points = shared.value[n], flat(own)
                had = space.route(points, hashes[rows])
                for some, leaf in space.visits(points, reach_of(own, space.longest, least[rows]), factor):
                    for part in range(space.parts):
                        shard = space.first + leaf * space.parts + part
                        new = some[had[some] != shard]
                        if len(new):
                            yield _rows(np.full(len(new), shard), 1, ids[rows[new]], own[new], least[rows[new]])

    return run


def _answers(shared, k: int, factor: float) -> Callable:
    """Searches the shards of a partition one after the other; a shard's candidates come before the queries that ask it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shard = None, [], None
        for batch in batches:
            shards, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "kind"))
            cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)]):
                part = batch.slice(low, high - low)
                if now != shards[low]:
                    now, held, shard = shards[low], [], None
                ids, vectors, _ = _arrays(part)
                if kinds[low] == 0:
                    held.append((ids, np.vstack(vectors)))
                    continue
                if held:
                    own = np.vstack([v for _, v in held])
                    shard, held = Shard(np.concatenate([i for i, _ in held]), own, shared.value[own.shape[1]].longest), []
                if shard is not None:
                    found = shard.best(ids, np.vstack(vectors), k, factor, part.column("least").to_numpy(zero_copy_only=False))
                    yield pa.RecordBatch.from_pandas(found.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"}), preserve_index=False)

    return run


def spaces(stored: DataFrame, shards: int = SHARDS, least_rows: int = LEAST_ROWS, most_rows: int = MOST_ROWS) -> dict[int, Space]:
    """The upper levels for every length of vector, from at most `SAMPLE` vectors with the smallest hashes of their ids."""
    lengths = stored.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max("norm").alias("norm")).orderBy("n").collect()
    total, found, first = sum(r.rows for r in lengths), {}, 0
    mark = F.shiftrightunsigned(F.xxhash64("vec_id"), 11) / float(1 << 53)
    for r in lengths:
        size = min(most_rows, max(least_rows, -(-total // shards)))
        wanted = -(-r.rows // size)
        leaves = max(1, min(wanted, SAMPLE // PER_LEAF * r.rows // total))
        space = Space(r.norm)
        if leaves > 1:
            some = stored.where((F.size("embedding") == r.n) & (mark < leaves * PER_LEAF / r.rows)).orderBy("vec_id").select("embedding").collect()
            if some:
                space = Space.build(r.norm, lifted(np.array([x.embedding for x in some]), r.norm), leaves)
        space.parts, space.first = -(-wanted // space.leaves), first
        found[r.n] = space
        first += space.shards
    return found


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    factor: float = FACTOR,
    shards: int = SHARDS,
    least_rows: int = LEAST_ROWS,
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """`query_id`, `rank` from 1, `vec_id`, `score`: the k largest inner products of every query row with all other rows.

    Scores are double sums over the original vectors, ties go to the smaller vec_id. Fewer candidates than k are all returned. Unusable
    vectors (see `usable`) take no part. Vectors of different lengths have no inner product: a query finds those of its
    own length. Ids that repeat are one vector, of which one row is taken. No usable row or no query gives no rows.

    A shard has between `least_rows` and about `most_rows` rows; beyond `shards` shards of the latter their number grows with the table.
    """
    sound = usable(vectors).withColumn("q", F.coalesce(is_query, F.lit(False)))
    stored = durable(sound.groupBy("vec_id").agg(F.min(F.struct("embedding", "norm")).alias("v"), F.max("q").alias("q")).select("vec_id", "v.embedding", "v.norm", "q"))
    own = spaces(stored, shards, least_rows, most_rows)
    if not own:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared, many = vectors.sparkSession.sparkContext.broadcast(own), sum(s.shards for s in own.values())  # bounded by SAMPLE

    def answered(asked: DataFrame) -> DataFrame:
        together = points.union(asked).repartition(many, "shard").sortWithinPartitions("shard", "kind")
        return together.mapInArrow(_answers(shared, k, factor), HITS)

    points = durable(stored.select("vec_id", "embedding").mapInArrow(_placed(shared, False), ASKED))
    queries = stored.where("q").select("vec_id", "embedding")
    near = durable(answered(queries.mapInArrow(_placed(shared, True), ASKED)))
    bar = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bar")).select(F.col("query_id").alias("vec_id"), "bar")
    known = queries.join(bar, "vec_id", "left").select("vec_id", "embedding", F.coalesce("bar", F.lit(float("-inf"))).alias("least"))
    found = near
    if many > len(own):  # else each query has asked the only shard of its length
        found = near.union(answered(known.mapInArrow(_open_shards(shared, factor), ASKED)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
