"""Hard negatives: the threshold search against all scores, where it stops, edge cases, the query's SQL."""

import math

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gleanery.llm import negatives, queries

DATA = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, ids string, cid string, shards int, score double"


def _mined(rows, positives=5, wanted=3):
    """Rows (id, label, integers) by comparing all."""
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, label, x in rows:
        if i % 50:
            continue
        ranked = sorted((-score(x, y), j, other) for j, other, y in rows if j != i)
        for p, j, _ in [r for r in ranked if r[2] == label][:positives]:
            fit = [(n, m) for n, m, other in ranked if other != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, j, rank + 1, m, -p, -n) for rank, (n, m) in enumerate(fit[:wanted])]
    return sorted(out)


def _rows(found):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found.collect())


def test_matches_all_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 6))
    vectors = [(centres[i % 9] + rng.normal(size=6) * 0.4 if i % 4 else np.round(centres[i % 3], 1)) for i in range(700)]  # many equal ones
    vectors[100] = np.zeros(6)
    data = [(i, v.astype(np.float32).tolist(), i % 3, "a", "b", 1, 2.0) for i, v in enumerate(vectors)]
    want = _mined([(i, label, [math.floor(256 * c) for c in v]) for i, v, label, *_ in data])
    df = spark.createDataFrame(data, SCHEMA)
    for shard_points, chunk in ((8192, 8192), (40, 3)):
        assert _rows(negatives.mine(df, F.col("id") % 50 == 0, shard_points=shard_points, chunk_anchors=chunk)) == want
    assert len(want) > 100


def test_stops_at_the_threshold():
    """Where few components matter, few points are scored, and the result is that of all of them."""
    rng = np.random.default_rng(6)
    vectors = (rng.pareto(1.5, size=(5000, 8)) * 100).astype(np.int64)
    lists = negatives.SortedLists(vectors, np.arange(5000) % 2, np.arange(5000))
    for anchor in (np.array([9, 0, 0, 0, 0, 0, 0, 0]), np.array([5, 0, -2, 0, 0, 0, 1, 0]), vectors[7]):
        scores = vectors @ anchor
        top = int(scores.max())
        windows = [(top // 2, top * 95 // 100), (0, top)]
        places, values, scored = lists.best(anchor, 1, False, windows, 3)
        for (low, high), own, got in zip(windows, places, values):
            fit = [j for j in np.lexsort((np.arange(5000), -scores)) if j % 2 == 0 and low <= scores[j] <= high][:3]
            assert own.tolist() == fit and got.tolist() == scores[fit].tolist()
        assert scored < 2500


def test_anchors_share_their_scoring(monkeypatch):
    """A chunk's anchors are scored a block at a time for all of them, and each gets what comparing all gives."""
    rng = np.random.default_rng(7)
    points, k = rng.integers(-40, 40, size=(500, 16)), 3
    points[:20] *= rng.random((20, 16)) < 0.2  # some with few components
    points[3], labels = 0, np.arange(500) % 3
    asked = [[int(p) for p in np.unique(np.maximum(points @ points[i], 0))[-4:-1]] for i in range(300)]
    batch = lambda asks, places, ids: pa.record_batch({"shard": ["0"] * len(places), "asks": [asks] * len(places), "cid": places, "label": labels[places], "ints": points[places].tolist(), "ids": ids})
    calls, plain = [], negatives.SortedLists._scores
    monkeypatch.setattr(negatives.SortedLists, "_scores", lambda self, *a: calls.append(1) or plain(self, *a))
    found = negatives._search(k, False)([batch(False, np.arange(500), [[i] for i in range(500)]), batch(True, np.arange(300), asked)])
    got = sorted((r["cid"], r["window"], -r["score"], r["id"]) for b in found for r in b.to_pylist() if r["id"] is not None)
    want = []
    for i in range(300):
        ranked = sorted((-int(s), j) for j, s in enumerate(points @ points[i]) if labels[j] != labels[i])
        for p in asked[i]:
            want += [(i, p, s, j) for s, j in ranked if 50 * p <= -100 * s <= 95 * p][:k]
    assert got == sorted(want) and len(got) > 1000
    assert len(calls) <= 10


def test_big_integers_are_exact():
    vectors = np.array([[2**28 + 1, 3], [2**28, 3], [5, -7]], np.int64)
    lists = negatives.SortedLists(vectors, np.array([1, 1, 2]), np.arange(3))
    places, values, _ = lists.best(vectors[0], 1, True, [(negatives._LEAST, negatives._MOST)], 2)
    assert values[0].tolist() == [(2**28 + 1) ** 2 + 9, (2**28 + 1) * 2**28 + 9]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.6, 0.5], 2), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 0.0], 2), (7, [0.7, 0.1], None),
        (8, [1.0, 1.0, 1.0], 2), (9, [], 1), (10, [3e38, 0.0], 2), (50, [0.0, 0.0], 2), (1, [0.9, 0.0], 1), (None, [0.8, 0.0], 2),
    ]
    df = spark.createDataFrame([(*r, "a", "b", 1, 2.0) for r in rows], SCHEMA)
    got = _rows(negatives.mine(df, F.col("id") % 50 == 0))
    # The null anchor's positive scores 0, and so do both of the other label: ties by id.
    assert got == [(0, 1, 1, 2, 256 * 230, 256 * 153), (50, 2, 1, 0, 0, 0), (50, 2, 2, 1, 0, 0)]
    assert negatives.mine(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert negatives.mine(df.where("vec_id = 0"), F.col("id") % 50 == 0).count() == 0


def test_query_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    want = con.sql(negatives.oracle_sql())
    got = queries.op11_threshold_negatives(spark, DATA)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())
