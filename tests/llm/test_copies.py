"""Near copies and repeated passages: brute force and edge cases; the pipeline end to end."""

from collections import Counter

import numpy as np

import corpus_pipeline
from gleanery.llm import components, jaccard, substring

from .conftest import prose


def _shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _copies(spark):
    base = prose(3, 150).split()
    rows = [(0, " ".join(base), 1), (1, " ".join(base), 1)]
    for i in range(2, 60):
        words = list(base)
        for k in range(i % 9):
            words[(k * 31 + i) % 150] = f"e{i}_{k}"
        rows.append((i, " ".join(words), 1))
    return spark.createDataFrame(rows + [(100 + i, prose(20 + i, 80), 1) for i in range(30)], "doc_id long, text string, key int")


def test_links_match_brute_force(spark):
    docs = _copies(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: _shingles(t) for i, t in texts.items()}
    links = Counter()
    for a in texts:
        for b in texts:
            if a < b and (texts[a] == texts[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                links[a] += 1
                links[b] += 1
    for block in (8, 1024):  # many units of a bucket, and one
        got = {r.doc_id: r for r in jaccard.near_duplicates(docs, block=block).collect()}
        assert {i: got[i].n_links for i in texts} == {i: links[i] for i in texts}
        assert all(got[i].class_id == i for i in texts if not links[i])


def test_pruning_keeps_pairs_at_the_threshold():
    need = jaccard.least_matches(0.8, 1e-6)
    rng = np.random.default_rng(0)
    lost = sum((rng.random((4000, n)) < 0.8).sum(1).min() < m for n, m in need.items())
    assert lost == 0 and need[120] > 60


def test_dense_intersections_equal_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    left, right = np.triu_indices(12, 1)
    left, right = np.tile(left, 3), np.tile(right, 3)
    assert jaccard._intersections(sets, left, right).tolist() == [len(set(sets[i]) & set(sets[j])) for i, j in zip(left, right)]


def test_near_copy_edges(spark, odd_docs, no_docs):
    got = jaccard.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.where("doc_id IS NOT NULL").count()
    by = {r.doc_id: r for r in got}
    assert by[8].class_id == 7 and by[9].class_id == 7 and by[1].class_id == 1 and by[2].n_links == 0
    assert jaccard.near_duplicates(no_docs).count() == 0
    left = jaccard.one_of_each(odd_docs, jaccard.near_duplicates(odd_docs)).collect()
    ids = [r.doc_id for r in left]
    assert len(ids) == len(set(ids)) and 7 in ids and 8 not in ids and 9 not in ids and None in ids


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(5, 5), (3, 2)], "a long, b long")
    root = {r.node: r.root for r in components.components(edges).collect()}
    assert root == {i: 0 if i <= 20 else 21 for i in range(41)}
    assert components.components(edges.where("false")).count() == 0


def test_chain_scores_match_quadratic_search():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n = 25
        x, y = np.sort(rng.integers(0, 80, n)), rng.integers(0, 80, n)
        f = [0.0] * n
        for i in np.lexsort((-y, x)):
            f[i] = substring.GAIN + max([0.0] + [f[j] - substring.COST * ((x[i] - x[j]) + (y[i] - y[j])) for j in range(n) if x[j] <= x[i] and y[j] < y[i] and (x[j] < x[i])])
        best = substring.chains(x, y)[0]
        score = substring.GAIN
        for a, b in zip(best, best[1:]):
            assert x[b] > x[a] and y[b] > y[a]
            score += substring.GAIN - substring.COST * ((x[b] - x[a]) + (y[b] - y[a]))
        assert abs(score - max(f)) < 1e-9


def test_passages(spark):
    passage = prose(40, 70)
    fuzzy = " ".join(w if i % 23 else "zz" for i, w in enumerate(passage.split()))
    rows = [(1, prose(50, 30) + " " + passage + " " + prose(51, 30)), (2, prose(52, 40) + "\n" + passage), (3, fuzzy + " " + prose(53, 60)), (4, prose(54, 90)), (5, prose(50, 30) + " " + prose(55, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in substring.repeated_passages(docs).collect()}
    assert set(got) == {2, 3}  # the first holder keeps it; thirty shared words are no passage
    assert (got[2].start, got[2].end, got[2].source_id) == (40, 110, 1) and got[2].n_equal == 70
    assert got[3].start <= 1 and 66 <= got[3].end <= 71 and got[3].n_equal >= 60
    cut = {r.doc_id: r.text for r in substring.remove_passages(docs, substring.repeated_passages(docs)).collect()}
    assert cut[2].split() == prose(52, 40).split() and cut[1] == rows[0][1] and passage.split()[30] not in cut[3].split()[:5]


def test_exact_passages_near_each_other(spark):
    one, two, line = prose(60, 50), prose(61, 50), prose(62, 30)
    rows = [(1, f"{one} {prose(63, 28)} {two}"), (2, f"{one} {prose(64, 28)} {two}"), (3, f"{prose(65, 50)} {prose(66, 24)} {line}"), (4, f"{prose(65, 50)} {prose(67, 24)} {line}")]
    got = {(r.doc_id, r.start, r.end) for r in substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(2, 0, 50), (2, 78, 128), (4, 0, 50)} <= got


def _edited(text, every):
    return " ".join(w if i % every != every // 2 else f"edit{i}" for i, w in enumerate(text.split()))


def test_passages_with_many_edits(spark):
    """Sixty words with one in 8, 10 or 12 changed."""
    for every in (8, 10, 12):
        rows = [(k, prose(100 + 5 * k, 60)) for k in range(1, 41)]
        later = [(100 + k, f"{prose(k, 20)} {_edited(t, every)} own{k} words{k} follow{k}") for k, t in rows]
        got = {r.doc_id for r in substring.repeated_passages(spark.createDataFrame(rows + later, "doc_id long, text string")).collect()}
        assert len({d for d, _ in later} - got) <= (4 if every == 8 else 1), every


def test_passage_whose_seeds_are_in_other_documents_too(spark):
    """Every run of seven words that starts at a multiple of six stands in an earlier document of its own."""
    passage = [f"p{i}" for i in range(60)]
    early = [(k, " ".join(f"x{k}_{i}" for i in range(9)) + " " + " ".join(passage[k * 6 : k * 6 + 7]) + " " + " ".join(f"y{k}_{i}" for i in range(9))) for k in range(9)]
    rows = [*early, (50, " ".join(passage)), (60, "a b c d " + " ".join(passage) + " e f g")]
    got = {r.doc_id: r for r in substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[60].start, got[60].end, got[60].source_id) == (4, 64, 50)


def test_split_keeps_exact_runs_and_whole_chains():
    rng = np.random.default_rng(6)
    for _ in range(200):
        runs, x, y, i, j = [], 0, 0, [], []
        for n in rng.integers(1, 60, 6).tolist():
            x, y = x + int(rng.integers(1, 40)), y + int(rng.integers(1, 40))
            runs.append((x, x + n))
            i += range(x, x + n)
            j += range(y, y + n)
            x, y = x + n, y + n
        parts = list(substring.split(np.array(i), np.array(j), 18, 0.8))
        assert all(n >= 0.8 * max(b - a, v - u) for a, b, u, v, n in parts)
        assert all(b - a < 18 or any(p[0] <= a and b <= p[1] for p in parts) for a, b in runs)
        whole = (i[0], i[-1] + 1, j[0], j[-1] + 1, len(i))
        assert len(i) < 0.8 * max(whole[1] - whole[0], whole[3] - whole[2]) or parts == [whole]


def test_every_exact_repeat_is_covered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(sorted((r.doc_id, r.text.split()) for r in docs.collect()))
    spans: dict = {}
    for r in substring.repeated_passages(docs).collect():
        spans.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    first: dict = {}
    for i, w in texts.items():
        for k in range(len(w) - 50):
            if first.setdefault(tuple(w[k : k + 51]), i) < i:
                assert set(range(k, k + 51)) <= spans.get(i, set())


def test_passage_edges(spark, odd_docs, no_docs):
    got = substring.repeated_passages(odd_docs).collect()
    assert {8, 9, 12} <= {r.doc_id for r in got} and not {1, 2, 3, 4} & {r.doc_id for r in got}
    assert substring.repeated_passages(no_docs).count() == 0
    left = substring.remove_passages(odd_docs, substring.repeated_passages(odd_docs))
    assert left.columns == odd_docs.columns and 1 not in {r.doc_id for r in left.collect()}


def test_pipeline(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, d).collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
    ran = corpus_pipeline.run(spark, d)
    assert sorted(map(tuple, ran.select("doc_id", "piece", "length").collect())) == sorted(map(tuple, packed.select("doc_id", "piece", "length").collect()))


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    """Null rows, repeated ids and clashing columns through every stage; then empty tables."""
    labels = spark.createDataFrame([(7, 1, 0), (13, 0, 1), (6, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    for name, docs, marks in (("odd", odd_docs, labels), ("none", no_docs, labels.where("false"))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        marks.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got[0].__fields__ if got else {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"})
        ids = {r.doc_id for r in got}
        # 7 stays whole, 8 and 9 are copies of it, 12 keeps its own part, the rest is too short or (6, 10) repeats itself.
        assert ids == ({7, 12} if name == "odd" else set())
        assert len(got) == len({(r.doc_id, r.piece) for r in got})


def test_repeated_ids_have_one_text(spark):
    """Two texts under one id: copies and passages follow the least of them."""
    rows = [(1, prose(70, 90)), (2, "zzz " + prose(71, 90)), (2, prose(70, 90)), (3, prose(71, 90))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    least = min(rows[1][1], rows[2][1])
    copies = {r.doc_id: r.class_id for r in jaccard.near_duplicates(docs).collect()}
    assert jaccard.near_duplicates(docs).count() == 4 and copies[2] == (1 if least == rows[2][1] else 2)
    found = {r.doc_id for r in substring.repeated_passages(docs).collect()}
    assert found == ({2} if least == rows[2][1] else {3})


def test_stored_tables_can_be_discarded(spark):
    from gleanery.llm import common

    common.discard_stored(spark)
    df = common.stored(spark.range(3).toDF("a"), "some")
    assert df.count() == 3 and common.discard_stored(spark) == 1 and common.discard_stored(spark) == 0


def test_clashing_columns_and_the_least_row(spark):
    """A column named as the operators' own is kept; of rows that share an id that with the least text stays."""
    rows = [(1, "b b b b b b", "x", 1), (1, "a a a a a a", "y", 2), (2, None, "z", 3), (2, "w", "z", 4), (None, "n", "q", 5), (None, "n", "q", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, place0 int")
    groups = spark.createDataFrame([(1, 1), (2, 2)], "doc_id long, class_id long")
    kept = sorted((r.doc_id or 0, r.text, r.place0) for r in jaccard.one_of_each(docs, groups).collect())
    assert kept == [(0, "n", 5), (0, "n", 6), (1, "a a a a a a", 2), (2, None, 3)]
    passages = spark.createDataFrame([(1, 1, 3)], "doc_id long, start long, end long")
    left = substring.remove_passages(docs, passages)
    assert left.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text.split(), r.spans) for r in left.collect())
    assert got == [(0, ["n"], "q"), (0, ["n"], "q"), (1, ["a"] * 4, "y"), (1, ["b"] * 4, "x"), (2, ["w"], "z")]
