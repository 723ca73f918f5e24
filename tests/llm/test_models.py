"""Language models, toxicity and neighbours: held-out accuracy, recall, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from gleanery.llm import annsearch, langid, toxicity

DATA = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = langid.identify_folds(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    assert found.where("NOT accepted").count() <= 0.1 * found.count()


TOY = [("abab baba abba", "aa"), ("aab bba", "aa"), ("ab ba ab", "aa"), ("xyz zyx", "bb"), ("xa", "bb")]


def _brute_force(rows, order=3):
    """p(character | the characters before it in its word) per language, by the textbook recursion over dicts."""
    chars = {c for t, _ in rows for w in t.split() for c in w + "\x03"}
    top: dict = {}
    for t, lang in rows:
        for w in t.split():
            w = "\x02" + w + "\x03"
            for i in range(1, len(w)):
                g = w[max(0, i - order + 1) : i + 1]
                top.setdefault(lang, {})[g] = top.get(lang, {}).get(g, 0) + 1
    counts: dict = {}
    for lang, own in top.items():
        counts[lang] = {order: {g: n for g, n in own.items() if len(g) == order}}
        for n in range(order - 1, 0, -1):
            level = {g: c for g, c in own.items() if len(g) == n}
            for g in counts[lang][n + 1]:
                level[g[1:]] = level.get(g[1:], 0) + 1
            counts[lang][n] = level

    def p(lang, gram):
        n = len(gram)
        below = p(lang, gram[1:]) if n > 1 else 1 / (len(chars) + 1)
        after = {g: c for g, c in counts[lang][n].items() if g[:-1] == gram[:-1]}
        mass = sum(after.values())
        return (max(after.get(gram, 0) - 0.75, 0) + 0.75 * len(after) * below) / mass if mass else below

    return p, chars


def test_language_probabilities_are_kneser_ney(spark):
    model = langid.train(spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(TOY)], "doc_id long, text string, lang string"), order=3)
    assert model["langs"] == ["aa", "bb"]
    p, chars = _brute_force(TOY)
    table = {(r.n, r.gram): r for r in model["table"].collect()}
    for (n, gram), r in table.items():
        if gram != "\x02":
            assert all(abs(np.exp(r.logs[k]) - p(lang, gram)) < 1e-9 for k, lang in enumerate(model["langs"])), gram
    held = langid.arrays(model)
    words = ["abab", "xyz", "", "qa", "zzx"]
    scores = langid.score_words(held, words)
    for w, own in zip(words, scores):
        full = "\x02" + w + "\x03"
        for k, lang in enumerate(model["langs"]):
            want = sum(np.log(p(lang, full[max(0, i - 2) : i + 1])) for i in range(1, len(full)))
            assert abs(own[k] - want) < 1e-4
    for context in ("\x02", "\x02a", "ab", "zz"):  # over every character and one that was never seen
        for lang in model["langs"]:
            assert abs(sum(p(lang, (context + c)[-3:]) for c in [*chars, "?"]) - 1) < 1e-9


def test_language_model_beyond_its_bound(spark):
    """What the arrays can't hold is looked up in the written tables, with the same result."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(spark.createDataFrame([(10**6, "ab" * 500 + " word", "en"), (10**6 + 1, "ab" * 500 + "c", None)], "doc_id long, text string, lang string"))
    teach = F.col("doc_id") % 5 != 0
    whole, few, none = (sorted(map(tuple, langid.identify(docs, teach, ~teach, n).select("doc_id", "lang_pred", F.round("score", 4), F.round("entropy", 4), "accepted").collect())) for n in (langid.MODEL_BYTES, 40_000, 0))
    assert whole == few == none


def test_letters_only(spark):
    rows = [(1, "\u00b2 \u00bd \u2167 12"), (2, "a\u0301b cd"), (3, "\u0301"), (4, "x" * 300)]
    model = langid.train(spark.createDataFrame([(9, "ab cd a\u0301b", "en")], "doc_id long, text string, lang string"))
    got = {r.doc_id: r.best for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] == got[3] == -1 and got[2] == got[4] == 0
    assert langid._words("A\u0301b " + "y" * 99) == ["a\u0301b", "y" * 99]


def test_repeated_ids_calibrate_once_each(spark):
    rows = [(i % 3, f"alpha beta gamma delta {i}", "en") for i in range(600)] + [(7, "uno dos tres", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    marked = langid.predict(docs, model, truth="lang")
    assert marked.count() == len(rows) and set(langid.thresholds(docs, model, langid.arrays(model))) == {"en"}


def test_language_edges(spark, odd_docs, no_docs):
    known = odd_docs.select("doc_id", "text", "lang")
    got = langid.identify(known, F.lit(True), F.lit(False)).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3)) and by[13].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(no_docs.select("doc_id", "text", "lang"), F.lit(True), F.lit(True)).count() == 0
    untaught = langid.identify(known, F.lit(False), F.lit(False)).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_toxicity_finds_the_sentence(spark):
    def text(i, bad):
        s = [f"word{i % 7} other{i % 11} thing{(i * j) % 13} more{j}." for j in range(8)]
        return "\n".join(s[:4] + ([f"you nasty{'ly' if i % 2 else 'est'} fool{i % 3}."] if bad else []) + s[4:])

    docs = spark.createDataFrame([(i, text(i, i % 3 == 0)) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(None, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs.where("doc_id >= 400"), model).collect()
    assert all((r.score >= toxicity.THRESHOLD) == (r.doc_id % 3 == 0) for r in scored)
    blamed = toxicity.offending_sentences(docs.where("doc_id >= 400"), model).collect()
    assert {r.doc_id for r in blamed} == {i for i in range(400, 600) if i % 3 == 0} and all("nasty" in r.sentence for r in blamed)
    assert {r.doc_id % 3 for r in toxicity.clean_documents(docs, model).collect()} == {1, 2}


def test_noisy_or_gradient():
    """Loss by its definition over single sentences, gradient by finite differences."""
    rng = np.random.default_rng(3)
    n_features, sentences_of = 7, [3, 1, 4, 2, 2]
    doc = np.repeat(np.arange(5), sentences_of)
    first = np.concatenate([[0], np.cumsum(sentences_of)])
    sentence = np.sort(rng.integers(0, len(doc), 30))
    column = rng.integers(0, n_features, 30)
    y, pull, theta = np.array([1.0, 0, 1, 0, 1]), rng.random(5) + 0.5, 0.3 * rng.standard_normal(n_features + 1)

    def loss(t):
        total = 0.0
        for d in range(5):
            clean = 1.0
            for s in range(first[d], first[d + 1]):
                clean *= 1 - 1 / (1 + np.exp(-t[-1] - sum(t[c] for c, at in zip(column, sentence) if at == s)))
            total -= pull[d] * np.log(1 - clean if y[d] else clean)
        return total / 5 + toxicity._L2 / 2 * (t[:-1] ** 2).sum()

    found, gradient = toxicity.loss_and_gradient(theta, column, sentence, doc, first, y, pull)
    assert abs(found - loss(theta)) < 1e-9
    for k in range(len(theta)):
        step = np.eye(len(theta))[k] * 1e-6
        assert abs(gradient[k] - (loss(theta + step) - loss(theta - step)) / 2e-6) < 1e-6


def test_toxicity_sample_is_bounded(spark):
    rows = [(i % 40, f"fine words {i} stand here. " * 20) for i in range(400)] + [(100 + i, f"nasty words {i}. " * 20) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(10)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit
    toxicity.fit = lambda texts, y, share: seen.append((len(texts), int(y.sum()), share)) or fit(texts, y, share)
    try:
        toxicity.train(docs, labels, per_class=8)
        toxicity.train(docs, labels, class_bytes=1500)
    finally:
        toxicity.fit = fit
    assert seen[0] == (16, 8, 0.2) and seen[1][0] <= 10 and 1 <= seen[1][1] < 10


def test_toxicity_edges(spark, odd_docs, no_docs):
    assert toxicity.train(odd_docs, spark.createDataFrame([(7, 0)], "doc_id long, toxic int")) is None
    model = toxicity.fit(["a b. c d"] * 5 + ["e f. g h"] * 5, np.array([1] * 5 + [0] * 5))
    for m in (None, model):
        got = toxicity.score(odd_docs, m).collect()
        assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
        assert [r.score for r in got if r.doc_id in (1, 2, 3)] == [0, 0, 0]
        assert toxicity.score(no_docs, m).count() == 0


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x[100:900] = x[50]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 24), (5002, [float("nan")] * 24), (5003, [None] * 24), (5004, [1.0] * 3), (None, [1.0] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = annsearch.search(frame, F.col("vec_id") % 20 == 0, 20, shard_points=700).collect()
    lists: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        lists.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(lists) == set(range(0, 3000, 20)) and all(len(v) == 20 for v in lists.values())
    hits = 0
    y = x.astype(float)
    for q, found in lists.items():
        score = (y * y[q]).sum(1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(3000), -score))[:20]
        hits += len(set(best.tolist()) & {v for v, _ in found})
        assert q not in {v for v, _ in found} and all(abs(s - score[v]) < 1e-9 for v, s in found)
    assert hits >= 0.95 * 20 * len(lists)
    assert [v for v, _ in lists[100]] == [50, *range(101, 120)]


def test_neighbours_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert annsearch.search(empty, F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:4] for r in annsearch.search(two, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 0.5)]


def _recall_and_share(found, x, queries, k=20):
    """Recall against brute force, and the share of all points that the searches verified."""
    lists: dict = {}
    work: dict = {}
    for r in found:
        lists.setdefault(r.query_id, []).append(r.vec_id)
        work[r.query_id] = r.verified
    hits = 0
    for q in queries:
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score, kind="stable")[:k].tolist()) & set(lists[q]))
    return hits / (k * len(queries)), sum(work[q] for q in queries) / (len(queries) * len(x))


def test_stopping_test_decides(spark):
    """The given vectors have no structure: the test still spares a third; of clustered ones it verifies few."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("embedding IS NOT NULL").orderBy("vec_id").select("vec_id", "embedding")
    x = np.array([r.embedding for r in rows.collect()], float)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for shard, chunk in ((8192, 4096), (300, 30)):  # one cell; many cells and chunks of queries
        recall, share = _recall_and_share(annsearch.search(frame, F.col("vec_id") % 20 == 0, 20, shard_points=shard, chunk_queries=chunk).collect(), x, range(0, len(x), 20))
        assert recall >= 0.9 and share <= 0.8, (recall, share)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((60, 32))
    y = centres[rng.integers(0, 60, 6000)] + 0.1 * rng.standard_normal((6000, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "vec_id long, embedding array<double>")
    recall, share = _recall_and_share(annsearch.search(frame, F.col("vec_id") % 20 == 0, 20, shard_points=800).collect(), y, range(0, 6000, 20))
    assert recall >= 0.9 and share <= 0.25, (recall, share)


def test_cells_cut_space_and_boxes_hold_their_points():
    rng = np.random.default_rng(2)
    low = rng.standard_normal((4000, annsearch.DIRECTIONS))
    cells = annsearch.Cells(low[:500], 3)
    of = cells.of(low)
    least, most = cells.boxes()
    assert set(of) == set(range(8)) and all((low[of == c] >= least[c]).all() and (low[of == c] <= most[c]).all() for c in range(8))
    apart = np.array([annsearch._box_distances(low[0], least, most)[c] for c in of])
    assert (((low - low[0]) ** 2).sum(1) >= apart - 1e-9).all()


def test_very_large_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [2e200, 1e199]), (2, [1.0, 1.0]), (3, [0.0, 3e200])]
    got = annsearch.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 2, 3).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 3), (2, 1), (3, 0)] and got[0].score == 3e200
