"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected onto a few Gaussian (2-stable) directions; the squared projected distance of two
vectors is their squared distance times a chi-square variable with that many degrees of freedom. A
kd-tree over the projections hands out points by their projected distance to the query: leaves come in
the order of their boxes, and of a leaf's points only those are verified on the original vectors that
pass the test. The test compares a projected distance with the chi-square quantile times the k-th found
distance: a point beyond it would, were it nearer than the k-th, have shown up already with the given
probability. Once the next box is beyond it the search stops.

Largest inner product becomes nearest distance by scaling each query to the largest norm M and giving
points one more coordinate, sqrt(M^2 - |x|^2), which is nothing where norms are equal. Equal vectors are
one point: its k + 1 smallest ids are all that an answer can need.

The tree's top, fitted on a bounded sample, cuts the points into cells, at most ``MAX_CELLS``; a cell of
more than ``shard_points`` points is dealt over several shards by hash. A query first searches its own
cell; the k-th distance found there decides, by the same test, which other cells it visits at all. A task
holds one shard and streams a bounded chunk of queries past it. Every row is indexed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, tidy

SHARD_POINTS = 8_192
#: Queries that one task streams past its shard.
CHUNK_QUERIES = 4_096
#: Vectors that a partition of the visits holds at least, in large tables.
PARTITION_BYTES = 32 << 20
DIRECTIONS = 16
LEAF = 64
#: The stopping test's probability that a nearer point would have been seen. A neighbour nearer than the k-th is found likelier still.
CONFIDENCE = 0.9
#: Bounds of the tree's top: its cells, and the sampled points a cell that it is fitted on.
MAX_CELLS, SAMPLE_PER_CELL = 4_096, 32
_SEED = 20240229


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square with m degrees of freedom <= x) = p, for an even m by its finite sum."""

    def cdf(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    lo, hi = 0.0, 1.0
    while cdf(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


class Projection:
    """Points with their lift, and queries scaled to the largest norm, on the Gaussian directions."""

    def __init__(self, size: int, top: float, directions: int = DIRECTIONS):
        self.top = top
        self.axes = np.random.default_rng(_SEED).standard_normal((size + 1, directions))

    def points(self, vectors: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.top**2 - (vectors * vectors).sum(1), 0))
        lift[lift < 1e-3 * self.top] = 0.0  # equal norms, up to rounding
        return vectors @ self.axes[:-1] + lift[:, None] * self.axes[-1]

    def queries(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(projections, factor of each query to norm ``top``)"""
        factor = self.top / np.sqrt((vectors * vectors).sum(1))
        return (vectors * factor[:, None]) @ self.axes[:-1], factor


class Cells:
    """The top of the tree: a complete binary tree of splits, as arrays in heap order."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, self.directions = depth, sample.shape[1]
        self.axis, self.value = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            own = parts.pop(node)
            if len(own):
                self.axis[node] = (own.max(0) - own.min(0)).argmax()
                self.value[node] = np.median(own[:, self.axis[node]])
            right = own[:, self.axis[node]] >= self.value[node]
            parts[2 * node], parts[2 * node + 1] = own[~right], own[right]

    def of(self, low: np.ndarray) -> np.ndarray:
        node = np.ones(len(low), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (low[np.arange(len(low)), self.axis[node]] >= self.value[node])
        return node - (1 << self.depth)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest coordinates of every cell."""
        low, high = np.full((2 << self.depth, self.directions), -np.inf), np.full((2 << self.depth, self.directions), np.inf)
        for node in range(1, 1 << self.depth):
            for child in (2 * node, 2 * node + 1):
                low[child], high[child] = low[node], high[node]
            high[2 * node, self.axis[node]] = min(high[node, self.axis[node]], self.value[node])
            low[2 * node + 1, self.axis[node]] = max(low[node, self.axis[node]], self.value[node])
        return low[1 << self.depth :], high[1 << self.depth :]


def _box_distances(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(0, np.maximum(low - at, at - high))
    return (gap * gap).sum(1)


class ProjectedTree:
    """A kd-tree over a shard's projections; points stand in the order of its leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection, leaf: int = LEAF):
        self.projection = projection
        low = projection.points(vectors)
        order = np.arange(len(low))
        bounds, leaves = [(0, len(low))], []
        while bounds:
            a, b = bounds.pop()
            if b - a <= leaf:
                leaves.append((a, b))
                continue
            own = low[order[a:b]]
            axis = int((own.max(0) - own.min(0)).argmax())
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)]
            bounds += [(a, a + mid), (a + mid, b)]
        self.ids, self.vectors, self.low = ids[order], vectors[order], low[order]
        self.leaves = np.array(sorted(leaves)).reshape(-1, 2)
        self.low_of = np.array([self.low[a:b].min(0) for a, b in self.leaves])
        self.high_of = np.array([self.low[a:b].max(0) for a, b in self.leaves])
        self.norm = (self.low * self.low).sum(1)
        self.leaf = np.repeat(np.arange(len(self.leaves)), np.diff(self.leaves, axis=1).ravel())

    def search(self, query: np.ndarray, at: np.ndarray, factor: float, k: int, limit: float, bound: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and inner products of what may be the k best, and how many points were verified.

        ``at`` and ``factor`` are the query's projection; ``limit`` is the chi-square quantile; ``bound`` is an
        inner product that k points found elsewhere reach.
        """
        near = _box_distances(at, self.low_of, self.high_of)
        top2 = 2 * self.projection.top**2
        places, scores = np.zeros(0, np.int64), np.zeros(0)
        kth, verified = bound, 0

        def verify(own):
            nonlocal places, scores, kth, verified
            verified += len(own)
            places, scores = np.concatenate([places, own]), np.concatenate([scores, self.vectors[own] @ query])
            if len(scores) >= k:
                bar = float(np.partition(scores, -k)[-k])
                kth = max(kth, bar)
                keep = scores >= bar
                places, scores = places[keep], scores[keep]

        def reach() -> float:
            return limit * max(top2 - 2 * factor * kth, 0.0) if kth > -np.inf else np.inf

        if kth == -np.inf:  # the nearest leaves give a first k-th distance, and with it the leaves that can be in reach at all
            first = np.argsort(near, kind="stable")[: -(-2 * k // LEAF)]
            verify(np.concatenate([np.arange(*self.leaves[i]) for i in first]))
            near[first] = np.inf
        rest = np.flatnonzero(near <= reach())
        if not len(rest):
            return places, scores, verified
        own = np.flatnonzero(np.isin(self.leaf, rest)) if 2 * len(rest) < len(near) else np.flatnonzero(near[self.leaf] < np.inf)
        apart = self.norm[own] - 2 * (self.low[own] @ at) + at @ at
        own, apart = own[(inside := apart <= reach())], apart[inside]
        # Their points come by projected distance, an eighth of them first, until the test holds.
        done = 0
        sizes = [len(own) // 8, len(own) // 4, len(own) // 2]
        order = np.argpartition(apart, sizes) if len(own) > 8 else np.argsort(apart)
        for upto in [*sizes, len(own)]:
            now = order[done:upto]
            verify(own[now[apart[now] <= reach()]])
            done = upto
            if done < len(own) and apart[order[done]] > reach():
                break
        return places, scores, verified


#: What a search returns: per query the points found, and a row without a point that says how many were verified.
_FOUND = "query string, point long, score double, verified long"


def _search(k: int, size: int, top: float, confidence: float):
    """Tasks: rows sorted by (shard, chunk, kind), points before queries -> each query's k best of each shard."""
    limit = chi_square_quantile(confidence, DIRECTIONS)
    schema = pa.schema([("query", pa.string()), ("point", pa.int64()), ("score", pa.float64()), ("verified", pa.int64())])

    def run(batches):
        projection = Projection(size, top)
        at, ids, rows, tree = None, [], [], None
        for batch in batches:
            shard, chunk = batch.column("shard").to_numpy(), batch.column("chunk").to_numpy()
            asks = batch.column("query").is_valid().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(shard) != 0) | (np.diff(chunk) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(shard)]):
                if (shard[lo], chunk[lo]) != at:
                    at, ids, rows, tree = (shard[lo], chunk[lo]), [], [], None
                vectors = _matrix(batch.column("vector").slice(lo, hi - lo))
                if not asks[lo]:
                    ids.append(batch.column("point").slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64))
                    rows.append(vectors)
                    continue
                if not rows:
                    continue
                if tree is None:
                    tree = ProjectedTree(np.concatenate(ids), np.concatenate(rows), projection)
                low, factor = projection.queries(vectors)
                bound = batch.column("bound").slice(lo, hi - lo).fill_null(-math.inf).to_numpy(zero_copy_only=False)
                out_q, out_p, out_s, out_v = [], [], [], []
                for i, q in enumerate(batch.column("query").slice(lo, hi - lo).to_pylist()):
                    places, scores, verified = tree.search(vectors[i], low[i], factor[i], k, limit, bound[i])
                    exact = (tree.vectors[places] * vectors[i]).sum(1)  # the same order of additions for every batch
                    best = np.lexsort((tree.ids[places], -exact))[:k]
                    out_q += [q] * (len(best) + 1)
                    out_p += [*tree.ids[places[best]].tolist(), None]
                    out_s += [*exact[best].tolist(), None]
                    out_v += [*[None] * len(best), verified]
                yield pa.record_batch([pa.array(out_q, pa.string()), pa.array(out_p, pa.int64()), pa.array(out_s, pa.float64()), pa.array(out_v, pa.int64())], schema=schema)

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _place(cells: Cells, size: int, top: float):
    """Tasks: points -> the points with their cell."""
    schema = pa.schema([("point", pa.int64()), ("vector", pa.list_(pa.float64())), ("cell", pa.int32())])

    def run(batches):
        projection = Projection(size, top)
        for batch in batches:
            if len(batch):
                cell = cells.of(projection.points(_matrix(batch.column("vector"))))
                yield pa.record_batch([batch.column("point"), batch.column("vector").cast(schema.field("vector").type), pa.array(cell.astype(np.int32))], schema=schema)

    return run


def _route(cells: Cells, size: int, top: float, limit: float, home: bool):
    """Tasks: queries -> the queries once per cell to visit: their own, or the others that their bound leaves in reach."""
    schema = pa.schema([("query", pa.string()), ("vector", pa.list_(pa.float64())), ("bound", pa.float64()), ("cell", pa.int32())])

    def run(batches):
        projection = Projection(size, top)
        low, high = cells.boxes()
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column("vector"))
            at, factor = projection.queries(vectors)
            own = cells.of(at)
            row, cell = np.arange(len(batch)), own
            if not home:
                bound = batch.column("bound").fill_null(-math.inf).to_numpy(zero_copy_only=False)
                row, cell = [], []
                for i in range(len(batch)):
                    reach = limit * max(2 * top**2 - 2 * factor[i] * bound[i], 0.0)
                    to = np.flatnonzero(_box_distances(at[i], low, high) <= reach)
                    to = to[to != own[i]]
                    row.append(np.full(len(to), i))
                    cell.append(to)
                row, cell = np.concatenate(row), np.concatenate(cell)
            take = pa.array(row)
            yield pa.record_batch([batch.column("query").take(take), batch.column("vector").take(take).cast(schema.field("vector").type), batch.column("bound").take(take), pa.array(cell.astype(np.int32))], schema=schema)

    return run


def search(vectors: DataFrame, is_query, k: int = 20, id_column: str = "vec_id", vector: str = "embedding", confidence: float = CONFIDENCE, shard_points: int = SHARD_POINTS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """The k rows with the largest inner product found for each row where ``is_query`` holds.

    Returns query_id, rank (from 1), vec_id, score (the double-precision inner product of the original
    vectors) and verified (points that the query's search compared on the original vectors); ties go to
    the smaller id; a query is never its own answer; fewer rows than k are all returned. Null or zero
    vectors, vectors with a null or non-finite component, of another length than most, or without an id
    take no part; very large components do. Rows that repeat an id stand as they are. Other columns are ignored, whatever
    their names; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    usable = F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("x", lambda c: c != 0)
    rows = vectors.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"), is_query.alias("q")).where(F.coalesce(usable, F.lit(False)))
    # -0.0 and 0.0 are the same component.
    rows = stored(rows.withColumn("x", F.transform("x", lambda c: c + F.lit(0.0))), "vectors")
    size = rows.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("m"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).orderBy(F.desc("m"), "n").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, verified long")
    # Division by a power of two is exact and keeps squares of very large components finite.
    unit = 2.0 ** math.frexp(size.most)[1]
    rows = rows.where(F.size("x") == size.n).withColumn("x", F.transform("x", lambda c: c / F.lit(unit)))
    top = float(rows.agg(F.max(F.aggregate("x", F.lit(0.0), lambda a, c: a + c * c))).first()[0] ** 0.5)
    # The k + 1 smallest ids of each distinct vector; the limit is applied before the shuffle too.
    key = F.md5(F.concat_ws(",", F.transform("x", lambda c: c.cast("string"))))
    classed = rows.withColumn("key", key)
    placed = classed.select("key", "id", "x").withColumn("rn", F.row_number().over(W.partitionBy("key").orderBy("id"))).where(F.col("rn") <= k + 1)
    members = stored(placed, "vector-classes")
    points = members.where("rn = 1").select(F.col("id").alias("point"), F.col("x").alias("vector"))
    n_points = points.count()
    depth = min(int(math.log2(MAX_CELLS)), max(0, math.ceil(math.log2(n_points / shard_points))))
    projection = Projection(size.n, top)
    sample = np.zeros((0, DIRECTIONS))
    if depth:
        some = points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE_PER_CELL << depth)  # at most SAMPLE_PER_CELL x MAX_CELLS rows
        low = some.mapInArrow(tidy(_projected(size.n, top)), "low array<double>")
        sample = np.array([r.low for r in low.toLocalIterator()])
    cells = Cells(sample, depth)
    shards = max(1, math.ceil(n_points / (shard_points << depth)))
    points = stored(points.mapInArrow(tidy(_place(cells, size.n, top)), "point long, vector array<double>, cell int"), "vector-cells")
    points = points.select("point", "vector", "cell", F.pmod(F.xxhash64("point"), F.lit(shards)).cast("int").alias("sub"))
    asked = classed.where("q").select("id", "key", "x")
    queries = stored(asked.groupBy("key").agg(F.first("x").alias("vector")).withColumnRenamed("key", "query"), "vector-queries")
    limit = chi_square_quantile(confidence, DIRECTIONS)

    def visit(asking: DataFrame, home: bool, name: str) -> DataFrame:
        routed = asking.mapInArrow(tidy(_route(cells, size.n, top, limit, home)), "query string, vector array<double>, bound double, cell int")
        # Each cell's queries are counted (at most MAX_CELLS rows) and cut into chunks, so that only a cell with more than one copies its points.
        asked_of = {r.cell: r["n"] for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        cuts = spark.createDataFrame([(c, math.ceil(n / chunk_queries)) for c, n in asked_of.items()], "cell int, chunks int")
        routed = routed.join(F.broadcast(cuts), "cell").select(F.lit(None).cast("long").alias("point"), "query", "vector", "bound", "cell", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("sub"), F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int").alias("chunk"))
        copied = points.join(F.broadcast(cuts), "cell")  # cells without a query have no work
        held = copied.select("point", F.lit(None).cast("string").alias("query"), "vector", F.lit(None).cast("double").alias("bound"), "cell", "sub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        both = held.unionByName(routed).withColumn("shard", F.col("cell").cast("long") * shards + F.col("sub"))
        # More partitions than units of work, so that few share one by chance, but none for less than PARTITION_BYTES beyond a few for each core.
        units = shards * sum(math.ceil(n / chunk_queries) for n in asked_of.values())
        moved = 8 * size.n * (n_points / (1 << depth) * units / shards + shards * sum(asked_of.values()))
        parts = min(4 * units, max(8 * spark.sparkContext.defaultParallelism, math.ceil(moved / PARTITION_BYTES)))
        met = both.repartition(max(8, parts), "shard", "chunk").sortWithinPartitions("shard", "chunk", F.col("query").isNotNull())
        found = met.select("shard", "chunk", "point", "query", "vector", "bound").mapInArrow(tidy(_search(k + 1, size.n, top, confidence)), _FOUND)
        return stored(found, name)

    found = visit(queries.withColumn("bound", F.lit(None).cast("double")), True, "neighbours-at-home")
    best = _best(found, k + 1)
    if depth:
        bounds = best.where(F.col("rn") == k + 1).select("query", F.col("score").alias("bound"))
        found = found.unionByName(visit(queries.join(bounds, "query", "left"), False, "neighbours-elsewhere"))
        best = _best(found, k + 1)
    work = found.groupBy("query").agg(F.sum("verified").alias("verified"))
    # Classes back to their members, then the first k that are not the query itself.
    of = members.where("rn = 1").select("key", F.col("id").alias("point"))
    full = best.join(of, "point").join(members.select("key", F.col("id").alias("vec_id")), "key").select("query", "vec_id", "score")
    answered = asked.select(F.col("id").alias("query_id"), F.col("key").alias("query")).join(full, "query").where("query_id <> vec_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = answered.withColumn("rank", rank).where(F.col("rank") <= k).join(work, "query")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", (F.col("score") * F.lit(unit) * F.lit(unit)).alias("score"), "verified")


def _projected(size: int, top: float):
    def run(batches):
        for batch in batches:
            if len(batch):
                low = Projection(size, top).points(_matrix(batch.column("vector")))
                yield pa.record_batch([pa.array(low.tolist(), pa.list_(pa.float64()))], names=["low"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "point")
    return found.where("point IS NOT NULL").withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k).select("query", "point", "score", "rn")
