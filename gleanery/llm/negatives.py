"""Hard-negative mining by Fagin's threshold algorithm over integer vectors.

Equal rows of one label are one point. Points are dealt over shards, each held by a task, which sorts its points by
every component; anchors stream past it. An anchor reads each component's list from the end that its own sign
favours, a block at a time, and scores the points that it meets there for the first time on their whole
vectors. What it hasn't met can score no more than the sum of its components times the values reached (the
threshold), so it stops once that is strictly below the k-th score of each of its windows, or once it has met all.

Anchors go down the lists together, at every end that one of them favours. So they meet the same points at the same depth,
each at least those that it would meet alone, and a block's points are scored for all anchors still searching as one product.

The first visit finds an anchor's positives, in shards of its own label alone; each positive's score gives a window of
scores, and the second visit finds the best rows of other labels in each window, in all shards. Anchors of equal
vector and label are searched once. All scores are integers, exact in double or 64-bit arithmetic.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import one_text_each, stored, tidy

SHARD_POINTS = 8_192
#: Anchors that one task streams past its shard.
CHUNK_ANCHORS = 8_192
#: Places of every list that are read first; each further block is twice as long.
BLOCK = 16
#: Scores that the anchors going down the lists together may hold.
HELD_SCORES = 1 << 21
_LEAST, _MOST = -(1 << 62), 1 << 62


class SortedLists:
    """A shard's points with a list of them per component, sorted by its value."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, first_ids: np.ndarray):
        self.vectors, self.labels, self.first_ids = vectors, labels, first_ids
        order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.ascontiguousarray(np.take_along_axis(vectors, order, 0).T)
        #: Per component and point its place in the list.
        self.place = np.empty(self.values.shape, np.int32)
        np.put_along_axis(self.place, order.T, np.arange(len(vectors), dtype=np.int32)[None, :], 1)
        self.largest = float(np.abs(vectors).max(initial=0))

    def _scores(self, places: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """Anchors by places, in the shortest type that holds every sum exactly."""
        most = self.largest * float(np.abs(anchors).max(initial=0)) * anchors.shape[1]
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
        return (anchors.astype(kind) @ self.vectors[places].astype(kind).T).astype(np.int64)

    def best(self, anchor: np.ndarray, label, same: bool, windows: list[tuple[int, int]], k: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
        """Per window (lowest and highest score) its k best points of the same or of other labels and their scores, and how many were scored."""
        return self.best_of(anchor[None, :], np.array([label]), same, [windows], k)[0]

    def best_of(self, anchors: np.ndarray, labels: np.ndarray, same: bool, windows: list[list[tuple[int, int]]], k: int) -> list[tuple[list[np.ndarray], list[np.ndarray], int]]:
        """What ``best`` returns, per anchor."""
        n = len(self.vectors)
        up, down = np.minimum(anchors, 0), np.maximum(anchors, 0)
        # The depth at which a point is met: in a list of zero weights for all anchors never (n).
        met = np.minimum(self.place[up.any(0)].min(0, initial=n), n - 1 - self.place[down.any(0)].max(0, initial=-1))
        places = np.argsort(met, kind="stable")
        met, of_label = met[places], self.labels[places]
        scores = np.empty((len(anchors), n), np.int64)
        scored = np.zeros(len(anchors), np.int64)
        highest = np.full(len(anchors), _LEAST)
        least = np.array([min((low for low, _ in own), default=_MOST) for own in windows])
        searching = np.arange(len(anchors))
        depth, block, start = 0, BLOCK, 0
        while len(searching):
            depth, block = min(n, depth + block), 2 * block
            end = int(np.searchsorted(met, depth)) if depth < n else n
            got = self._scores(places[start:end], anchors[searching])
            scores[searching, start:end] = got
            scored[searching] = end
            if end == n:
                break
            highest[searching] = np.maximum(highest[searching], got.max(1, initial=_LEAST))
            threshold = up[searching] @ self.values[:, depth - 1] + down[searching] @ self.values[:, n - depth]
            # No bar is above both the highest score met and its window's lowest.
            near = threshold < np.maximum(highest, least)[searching]
            stops = np.zeros(len(searching), bool)
            for i in np.flatnonzero(near):
                a = searching[i]
                fit = scores[a, :end][(of_label[:end] == labels[a]) == same]
                stops[i] = all(threshold[i] < self._bar(fit, low, high, k) for low, high in windows[a])
            searching, start = searching[~stops], end
        return [self._chosen(scores[a, : scored[a]], places, labels[a], same, windows[a], k) for a in range(len(anchors))]

    def _chosen(self, scores: np.ndarray, places: np.ndarray, label, same: bool, windows: list[tuple[int, int]], k: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
        """Each window's k best of the scores met."""
        if not windows:
            return [], [], len(scores)
        low, high = np.array(windows).T
        some = np.flatnonzero(scores >= low.min())
        some = some[((self.labels[places[some]] == label) == same) & (scores[some] <= high.max())]
        # The k best up to the least highest score are in every window that reaches down to them.
        some = some[scores[some] >= self._bar(scores[some], int(low.min()), int(high.min()), k)]
        some = some[np.lexsort((self.first_ids[places[some]], -scores[some]))]
        falling = -scores[some]
        first, last = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
        own = [some[i : min(i + k, j)] for i, j in zip(first.tolist(), last.tolist())]
        return [places[x] for x in own], [scores[x] for x in own], len(scores)

    @staticmethod
    def _bar(scores: np.ndarray, low: int, high: int, k: int) -> int:
        """What a point must reach to be among the window's k best."""
        inside = scores[(scores >= low) & (scores <= high)]
        return int(np.partition(inside, -k)[-k]) if len(inside) >= k else low


_FOUND = "cid long, window long, id long, score long, scored long"


def _search(k: int, same: bool):
    """Tasks: rows sorted by (shard, chunk, kind), points before anchors -> per anchor and window the k best rows of each shard.

    Anchors' windows are the positive scores they come from (none: all scores). A row without an id per anchor says
    how many points were scored.
    """
    schema = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])

    def run(batches):
        at, parts, held, ids = None, [], None, []
        for batch in batches:
            shard, asks = batch.column("shard").to_pylist(), batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = [i for i in range(1, len(shard)) if shard[i] != shard[i - 1] or asks[i] != asks[i - 1]]
            for lo, hi in zip([0, *cuts], [*cuts, len(shard)]):
                if shard[lo] != at:
                    at, parts, held, ids = shard[lo], [], None, []
                part = batch.slice(lo, hi - lo)
                vectors = part.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                labels = part.column("label").to_numpy(zero_copy_only=False)
                if not asks[lo]:
                    parts.append((vectors, labels, part.column("cid").to_numpy(zero_copy_only=False)))
                    ids += part.column("ids").to_pylist()
                    continue
                if not parts:
                    continue
                held = held or SortedLists(*(np.concatenate(x) for x in zip(*parts)))
                out: list[list] = [[] for _ in schema]
                cids, ids_or_scores = part.column("cid").to_pylist(), part.column("ids").to_pylist()
                # 50 p <= 100 n <= 95 p
                windows = [[(_LEAST, _MOST)] if same else [(-(-50 * p // 100), 95 * p // 100) for p in own] for own in ids_or_scores]
                step = max(1, HELD_SCORES // len(ids))
                for first in range(0, len(part), step):
                    some = slice(first, first + step)
                    for cid, own, (places, values, scored) in zip(cids[some], ids_or_scores[some], held.best_of(vectors[some], labels[some], same, windows[some], k)):
                        for i, (found, scores) in enumerate(zip(places, values)):
                            window = None if same else own[i]
                            rows = [(-s, x) for place, s in zip(found.tolist(), scores.tolist()) for x in ids[place]]
                            for s, x in sorted(rows)[:k]:
                                for column, value in zip(out, (cid, window, x, -s, None)):
                                    column.append(value)
                        for column, value in zip(out, (cid, None, None, None, scored)):
                            column.append(value)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def _visit(points: DataFrame, anchors: DataFrame, k: int, same: bool, shard_points: int, chunk_anchors: int, name: str) -> DataFrame:
    """Every anchor past every shard (``same``: of its label). Shards and chunks come from the rows that there are (of each label)."""
    n_of = lambda df, each, out: df.groupBy("label").agg(F.ceil(F.count("*") / each).cast("int").alias(out)) if same else F.lit(math.ceil(df.count() / each))
    shards, chunks = n_of(points, shard_points, "shards"), n_of(anchors, chunk_anchors, "chunks")
    if same:
        cut = stored(shards.join(chunks, "label"), f"{name}-cuts")
        points, anchors = points.join(cut, "label"), anchors.join(cut, "label")
    else:
        points, anchors = (df.withColumns({"shards": shards, "chunks": chunks}) for df in (points, anchors))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    deal = lambda c: F.pmod(F.xxhash64("cid"), F.col(c)).cast("int")
    columns = ["cid", "label", "ints", "ids"]
    rows = points.where("chunks > 0").select(*columns, F.lit(False).alias("asks"), deal("shards").alias("sub"), every("chunks").alias("chunk"))
    rows = rows.unionByName(anchors.where("shards > 0").select(*columns, F.lit(True).alias("asks"), every("shards").alias("sub"), deal("chunks").alias("chunk")))
    key = ["label", "sub", "chunk"] if same else ["sub", "chunk"]
    met = rows.withColumn("shard", F.concat_ws(":", *key)).repartition(*key).sortWithinPartitions("shard", "asks")
    return stored(met.select("shard", "asks", "cid", "label", "ints", "ids").mapInArrow(tidy(_search(k, same)), _FOUND), name)


def usable(rows: DataFrame, vector: str, label: str, id_column: str) -> DataFrame:
    """(id, label, ints) of the rows that take part, one per id."""
    x = F.col("x")
    whole = F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    some = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x")).where(F.coalesce(whole, F.lit(False)))
    # 100 times an inner product must fit a long.
    most = F.array_max(F.transform(x, lambda c: F.abs(F.floor(F.lit(256.0) * F.least(F.greatest(c, F.lit(-1e15)), F.lit(1e15))))))
    some = some.where(most.cast("double") * most.cast("double") * F.size(x) < F.lit(2.0**62 / 100))
    ints = F.transform(x, lambda c: F.floor(F.lit(256.0) * c).cast("long"))
    return one_text_each(some.select("id", F.struct("label", ints.alias("ints")).alias("row")), "id", "row").select("id", "row.label", "row.ints")


def mine(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, id_column: str = "vec_id", label: str = "label", vector: str = "embedding", shard_points: int = SHARD_POINTS, chunk_anchors: int = CHUNK_ANCHORS) -> DataFrame:
    """Per anchor (rows where ``is_anchor``, a Column over ``id``, holds) and positive the best rows of other labels in the positive's window.

    A row's components are floor(256 x), its score is the integer inner product with the anchor; higher scores come first, ties
    by smaller id. Positives are an anchor's first ``positives`` other rows of its label, negatives the first
    ``negatives`` rows of other labels with 50 * positive_score <= 100 * negative_score <= 95 * positive_score. Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score and scored (points that the
    anchor's search for negatives scored); a positive without a negative has no row.

    Rows without an id or label, with a null or empty vector or a null or non-finite component, of another length than
    most (ties: the shorter), or so large that 100 times an inner product may not fit a long take no part. Of rows with one
    id the least (label, vector) stands for all. An anchor of zeros scores 0 everywhere. Fewer rows than asked for are
    all returned. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows = stored(usable(vectors, vector, label, id_column), "labelled-vectors")
    size = rows.groupBy(F.size("ints").alias("n")).agg(F.count("*").alias("m")).orderBy(F.desc("m"), "n").first()
    if size is None:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, scored long")
    rows = rows.where(F.size("ints") == size.n)
    # A point is a label's equal rows; its smallest ids are all that an answer can need. The limit is applied before the shuffle too.
    most = max(positives + 1, negatives)
    ranked = rows.withColumn("rn", F.row_number().over(W.partitionBy("label", "ints").orderBy("id"))).where(F.col("rn") <= most)
    points = stored(ranked.groupBy("label", "ints").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("cid", F.get("ids", F.lit(0))), "labelled-points")
    anchors = rows.where(is_anchor).select(F.col("id").alias("anchor_id"), "label", "ints")
    of = points.select("label", "ints", "cid")
    anchors = stored(anchors.join(of, ["label", "ints"]).select("anchor_id", "label", "cid"), "anchors")
    asking = points.join(anchors.select("cid").distinct(), "cid", "left_semi").withColumn("ids", F.array().cast("array<bigint>"))

    near = _visit(points, asking, positives + 1, True, shard_points, chunk_anchors, "positives")
    place = F.row_number().over(W.partitionBy("cid").orderBy(F.desc("score"), "id"))
    near = stored(near.where("id IS NOT NULL").withColumn("rn", place).where(F.col("rn") <= positives + 1).select("cid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "best-positives")
    # A window per positive score; below 0 its ends cross.
    windows = near.where("positive_score >= 0").groupBy("cid").agg(F.sort_array(F.collect_set("positive_score")).alias("ids"))
    far = _visit(points, asking.drop("ids").join(windows, "cid"), negatives, False, shard_points, chunk_anchors, "negatives")
    place = F.row_number().over(W.partitionBy("cid", "window").orderBy(F.desc("score"), "id"))
    best = far.where("id IS NOT NULL").withColumn("rank", place).where(F.col("rank") <= negatives).select("cid", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    work = far.groupBy("cid").agg(F.sum("scored").alias("scored"))

    own = anchors.join(near, "cid").where("anchor_id <> positive_id")
    first = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    own = own.withColumn("rn", first).where(F.col("rn") <= positives)
    out = own.join(best, ["cid", "positive_score"]).join(work, "cid")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score", "scored")


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """The labels of ids divisible by 7 moved on by one, modulo 10."""
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))


def oracle_sql() -> str:
    """DuckDB SQL for the rows of the query over ``embeddings``."""
    return """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.id AS anchor, b.id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (SELECT anchor, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id, s.score, row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INT AS rank, id AS negative_id, positive_score::BIGINT AS positive_score, score::BIGINT AS negative_score
FROM n WHERE rank <= 3
"""
