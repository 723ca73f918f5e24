"""Matching against brute force on rows with vetoes, ties, empty texts and null buckets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.functions.similarity import _lcs
from gleanery.operators import candidates, match, ordered

VETO = match.MatchSchema(text="text", bucket="bucket", rank="rank", id="id", veto="a.kind = b.kind")
PLAIN = match.MatchSchema(text="text", bucket="bucket", rank="rank", id="id")
SCHEMA = "id long, text string, bucket string, rank long, kind long"


def set_ratio(a, b):
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    s, p, q = (len(" ".join(sorted(z))) for z in (x & y, x - y, y - x))
    if s and not (p and q):
        return 100.0
    gap = 1 if s else 0
    r = 100 * (1 - (p + q - 2 * _lcs(" ".join(sorted(x - y)), " ".join(sorted(y - x)))) / (2 * (s + gap) + p + q))
    return r if not s else max(r, 100 * (1 - (gap + p) / (2 * s + gap + p)), 100 * (1 - (gap + q) / (2 * s + gap + q)))


def barred(m, a, b):
    return bool(m.veto) and a[4] == b[4] and a[4] is not None


def decide(m, score):
    return "match" if score >= m.match_threshold else "ambiguous" if score >= m.ambiguous_floor else "new"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    words = ["alpha", "alpine", "beta", "betas", "gamma", "delta", "deltas", "omega"]
    out = []
    for i in range(120):
        text = " ".join(rng.choice(words, rng.integers(1, 5)))
        out.append((i, None if i % 29 == 0 else "" if i % 31 == 0 else text, None if i % 23 == 0 else f"b{i % 3}", int(rng.integers(0, 9)), int(rng.integers(0, 4)) if i % 7 else None))
    return out


@pytest.mark.parametrize("m", [PLAIN, VETO], ids=["plain", "veto"])
def test_pairs_and_best(spark, rows, m):
    frame = spark.createDataFrame(rows, SCHEMA)
    want = {(a[0], b[0]): set_ratio(a[1], b[1]) for a in rows for b in rows if a[0] < b[0] and a[2] == b[2] and a[2] is not None and not barred(m, a, b)}
    got = {(r.a_id, r.b_id): r for r in match.match_pairs(frame, m).collect()}
    assert set(got) == set(want) and all(abs(got[k].score - s) < 1e-9 and got[k].decision == decide(m, s) for k, s in want.items())
    some = {(r.a_id, r.b_id) for r in match.match_pairs(frame, m, floor=70).collect()}
    assert some == {k for k, s in want.items() if s >= 70}
    best = {r.id: r for r in match.match_best(frame.where("id < 60"), frame.where("id >= 60"), m).collect()}
    assert len(best) == 60
    for a in rows[:60]:
        scored = sorted(((-set_ratio(a[1], b[1]), b[0]) for b in rows[60:] if a[2] == b[2] and a[2] is not None and not barred(m, a, b)))
        top = -scored[0][0] if scored else 0.0
        r = best[a[0]]
        assert abs(r.score - top) < 1e-9 and r.decision == decide(m, top) and r.candidate == (scored[0][1] if r.decision != "new" else None)
        assert abs(r.runner_up - (-scored[1][0] if len(scored) > 1 else 0.0)) < 1e-9
    others = {(r.id, r.candidate) for r in match.bucket_candidates(frame, m).collect()}
    assert others == {p for a, b in want for p in ((a, b), (b, a))}


@pytest.mark.parametrize("m", [PLAIN, VETO], ids=["plain", "veto"])
def test_clusters(spark, rows, m):
    want = {}
    groups: dict = {}
    for a in sorted(rows, key=lambda r: (r[3], r[0])):
        home = next((g for g in groups.setdefault(a[2], []) if any(not barred(m, a, o) and set_ratio(a[1], o[1]) >= m.match_threshold for o in g)), None)
        if home is None:
            groups[a[2]].append(home := [])
        home.append(a)
        want[a[0]] = home[0][0]
    got = {r.id: r.cluster for r in match.cluster(spark.createDataFrame(rows, SCHEMA).repartition(5), m).collect()}
    assert got == want


@pytest.mark.parametrize("m", [PLAIN, VETO], ids=["plain", "veto"])
def test_leaders(spark, rows, m):
    old, new = [r for r in rows if r[0] % 4 == 0], [r for r in rows if r[0] % 4]
    leaders: dict = {}
    for o in sorted(old):
        leaders.setdefault(o[2], []).append(o)
    want = {}
    for a in sorted(new, key=lambda r: (r[3], r[0])):
        score, best = 0.0, None
        for other in leaders.setdefault(a[2], []):
            now = 0.0 if barred(m, a, other) else set_ratio(a[1], other[1])
            if now > score:
                score, best = now, other[0]
        decision = decide(m, score)
        if decision != "match":
            leaders[a[2]].append(a)
        want[a[0]] = (decision, best if decision == "match" else a[0], best if decision != "new" else None)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: (r.decision, r.leader, r.candidate) for r in match.leader_match(frame.where("id % 4 = 0"), frame.where("id % 4 <> 0"), m).collect()}
    assert got == want


def test_own_scorer_and_hot_bucket(spark):
    """Equal first letters match; one bucket holds every row."""
    m = match.MatchSchema(text="text", bucket="bucket", rank="rank", id="id", scorer=lambda a, b: F.when(F.substring(a, 1, 1) == F.substring(b, 1, 1), 100.0).otherwise(0.0))
    frame = spark.createDataFrame([(i, "abc"[i % 3] + str(i % 50), "one", i, 0) for i in range(600)], SCHEMA)
    assert {r.cluster for r in match.cluster(frame, m).collect()} == {0, 1, 2}
    assert {r.leader for r in match.leader_match(frame.where("false"), frame, m).collect()} == {0, 1, 2}


def test_large_units_take_rounds(spark, rows, m=VETO):
    """The same decisions whether a bucket streams whole, by components, or by rounds."""
    frame = spark.createDataFrame(rows, SCHEMA)
    old, new = frame.where("id % 4 = 0"), frame.where("id % 4 <> 0")
    whole = [{r.id: r.cluster for r in match.cluster(frame, m).collect()}, {r.id: r.leader for r in match.leader_match(old, new, m).collect()}]
    for most in (3, 40):
        assert [{r.id: r.cluster for r in match.cluster(frame, m, most).collect()}, {r.id: r.leader for r in match.leader_match(old, new, m, most).collect()}] == whole


def test_clusters_stream_along_texts(spark, rows, monkeypatch):
    """A bucket of 4,000 records and few texts, some of which tie others: links of texts alone, against a loop; the same by components and rounds."""
    texts = ["alpha beta", "alpha beta gamma", "gamma", "gamma delta", "omega", "", "beta alpha"]
    many = [(i, texts[i * i % 7], "one", i * 13 % 101, 0) for i in range(4000)]
    want, groups = {}, []
    near = {a: {b for b in texts if set_ratio(a, b) >= 82} for a in texts}
    for a in sorted(many, key=lambda r: (r[3], r[0])):
        home = next((g for g in groups if near[a[1]] & g[1]), None)
        if home is None:
            groups.append(home := (a[0], set()))
        home[1].add(a[1])
        want[a[0]] = home[0]
    written = []
    for module in (match, ordered, candidates):
        monkeypatch.setattr(module, "cut", lambda df, plain=module.cut: written.append(plain(df)) or written[-1])
    got = match.cluster(spark.createDataFrame(many, SCHEMA), PLAIN)
    assert {r.id: r.cluster for r in got.collect()} == want and all(df.count() < 100 for df in written)
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = {r.id: r.cluster for r in match.cluster(frame, PLAIN).collect()}
    assert all({r.id: r.cluster for r in match.cluster(frame, PLAIN, most).collect()} == whole for most in (3, 200))


def test_a_chain_needs_few_rounds(spark, monkeypatch):
    """Two chains of 5,000 in one bucket, each a component that streams whole: rounds are those of the components."""
    n, rounds = 5_000, []
    plain = ordered.cut
    monkeypatch.setattr(ordered, "cut", lambda df: rounds.append(1) or plain(df))
    links = spark.range(2 * n).where(f"id % {n} > 0").selectExpr("'b' AS bucket", "id AS at", "id", "id - 1 AS to_at", "id - 1 AS to", "false AS outside")
    got, rest = ordered.independent(links, "long", unit_links=n)
    assert rest is None and {r.id: r.leads for r in got.collect()} == {i: i % n % 2 == 0 for i in range(2 * n)}
    assert len(rounds) <= 20
    groups, rest = ordered.first_groups(links.drop("outside"), "long", unit_links=n)
    assert rest is None and {r.first for r in groups.collect()} == {0, n}


def test_bounds_hold():
    """No pair's ratio exceeds its bound, whatever the texts."""
    rng = np.random.default_rng(3)
    words = ["alpha", "alpine", "beta", "betas", "gamma", "d", "é", "omega-3", "漢字", "zz"]
    texts = ["", " ", *(" ".join(rng.choice(words, rng.integers(1, 6))) for _ in range(90)), *("".join(rng.choice(list("abcde "), 12)) for _ in range(60))]
    got = candidates.bounds(texts, texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert got[i, j] >= set_ratio(a, b) - 1e-3, (a, b)


def test_large_buckets_lose_nothing(spark):
    """A bucket of 2,000 names in blocks: the pairs at the floor are those of brute force, from few candidates."""
    rng = np.random.default_rng(4)
    syllables = [c + v for c in "bdfgklmnprst" for v in "aeiou"]
    names = sorted({" ".join("".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(rng.integers(2, 5))) for _ in range(2000)})
    names += [n.replace("a", "o", 1) for n in names[::20]]
    names = sorted(set(names))
    frame = spark.createDataFrame([("one", n) for n in names], "_bucket string, t string")
    met = candidates.pairs_above(frame.withColumnRenamed("t", "_ta"), frame.withColumnRenamed("t", "_tb"), 82.0, few=10, block=256)
    got = {(r._ta, r._tb) for r in met.collect()}
    assert len(got) < 0.02 * len(names) ** 2
    some = names[::97]
    assert all((a, b) in got for a in some for b in names if set_ratio(a, b) >= 82)


@pytest.mark.parametrize("name", ["token_set_ratio", "token_sort_ratio"])
def test_ratio_queries_score_names_not_pairs(spark, tmp_path, monkeypatch, name):
    """800 parts of a brand and type with four names: 16 pairs of names at most are scored; null brands pair with nothing."""
    from gleanery.plans import QUERIES

    names = ["red ring", "ring red", "red", "gear"]
    rows = [(i, names[i % 4], None if i % 100 == 99 else "b", "t") for i in range(800)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    met = []
    monkeypatch.setattr(match, "cut", lambda df, plain=match.cut: met.append(plain(df)) or met[-1])
    got = {(r.a, r.b) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    one = (lambda a, b: set(a.split()) <= set(b.split()) or set(b.split()) <= set(a.split())) if "set" in name else (lambda a, b: sorted(a.split()) == sorted(b.split()))
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[2] and b[2] and one(a[1], b[1])}
    assert met and all(df.count() <= 16 for df in met)


def test_equal_sorted_tokens_meet_alone(spark):
    """20,000 different texts of a bucket at a sort ratio of 100: 400 million pairs of them are never made."""
    from gleanery.functions.similarity import token_sort_ratio

    m = match.MatchSchema(text="text", bucket="bucket", rank="rank", id="id", scorer=token_sort_ratio)
    frame = spark.range(20_000).selectExpr("id", "if(id % 2 = 0, concat('a', id, ' b'), concat('b a', id - 1)) AS text", "'one' AS bucket", "id AS rank")
    got = match.match_pairs(frame, m, 100)
    assert got.where("b_id = a_id + 1 AND a_id % 2 = 0 AND score = 100").count() == got.count() == 10_000


def test_best_meets_few(spark, monkeypatch):
    """A bucket of 3,000 with few texts: lists of 16 and longer ones for the vetoed, never 9 million pairs; against a loop."""
    m = match.MatchSchema(text="text", bucket="bucket", rank="rank", id="id", veto="a.kind = b.kind OR a.id = b.id")
    rows = [(i, f"{'ab'[i % 2]} {'cde'[i % 3]}", "one", 0, 1 if i < 2500 else i % 5) for i in range(3000)]
    made = []
    monkeypatch.setattr(match, "cut", lambda df, plain=match.cut: made.append(plain(df)) or made[-1])
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: r for r in match.match_best(frame, frame, m).collect()}
    assert len(got) == 3000 and 3 < len(made) and sum(df.count() for df in made) < 30_000
    for a in rows[::113]:
        first = sorted((-set_ratio(a[1], b[1]), b[0]) for b in rows if b[0] != a[0] and b[4] != a[4])[:2]
        r = got[a[0]]
        assert abs(r.score + first[0][0]) < 1e-9 and abs(r.runner_up + first[1][0]) < 1e-9 and r.candidate == (first[0][1] if r.decision != "new" else None)


def test_candidates_in_pieces(spark, rows):
    """A bucket's candidates in pieces: no pair lost or doubled, and the pairs of one bucket in several tasks."""
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and a[2] == b[2] and a[2] is not None and not barred(VETO, a, b))
    assert sorted(map(tuple, match.bucket_candidates(frame, VETO, piece=7).collect())) == want
    some = match.bucket_candidates(frame.where("id < 60"), VETO, frame.where("id >= 50"), piece=3)
    assert sorted(map(tuple, some.collect())) == [p for p in want if p[0] < 60 and p[1] >= 50]
    one = match.bucket_candidates(frame.where("bucket = 'b1'"), VETO, piece=7)
    assert one.select(F.spark_partition_id()).distinct().count() > 2
