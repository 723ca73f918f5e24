"""Toxicity by multiple-instance learning.

A text is a bag of sentences. A sentence scores p = sigmoid(bias + the weights of its words and of
their first four, five and six bytes, which carry stems to unseen endings), a text 1 - prod(1 - p)
over its sentences (noisy-or). Only texts carry labels: the likelihood's
gradient reaches a sentence through the noisy-or, so training itself decides which sentences are to
blame, and the same weights then point them out.

Fitting uses a bounded sample of labelled texts (at most ``MAX_PER_CLASS`` of each class, those with
the smallest hash of their id) and hashed words; scoring covers every sentence of every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_slice, fold, release, slices, stored, text_or_empty, tidy, utf8, word_hashes, words

#: The bounds of the training sample: labelled texts per class, and their bytes together.
MAX_PER_CLASS, MAX_CLASS_BYTES = 1500, 24 << 20
HASH_BITS = 22
#: Byte lengths of the word beginnings that are features too.
STEMS = (4, 5, 6)
#: A feature counts from so many training texts on.
LEAST_TEXTS = 4
THRESHOLD = 0.7
STEPS = 150
_L2 = 1e-4
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_FOLDED[[ord(c) for c in ",;:.!?\"()'*#$%&|<>"]] = 32
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def sentences(data: np.ndarray, off: np.ndarray):
    """Features of every sentence: (hash, sentence) per word and stem, sentence spans, first sentence per text.

    A sentence ends at a full stop, exclamation or question mark or line end, or with its text. Letters A-Z
    count as a-z and common punctuation as space; everything else of the text is used as it stands.
    """
    stops = np.flatnonzero(_STOP[data]) + 1
    borders = np.unique(np.concatenate([stops, off]))
    folded = _FOLDED[data]
    starts, ends, _ = words(folded, off)
    of = np.searchsorted(borders, starts, "right") - 1
    full = of[np.flatnonzero(np.diff(of, prepend=-1))]  # sentences with a word
    where = np.cumsum(np.diff(of, prepend=-1) != 0) - 1
    hashes, places = [word_hashes(folded, starts, ends)], [where]
    for n in STEMS:
        long = np.flatnonzero(ends - starts > n)
        hashes.append(word_hashes(folded, starts[long], starts[long] + n) + np.uint64(n))
        places.append(where[long])
    spans = np.stack([borders[full], borders[full + 1]], 1) if len(full) else np.zeros((0, 2), np.int64)
    doc = np.searchsorted(off, spans[:, 0], "right") - 1
    return np.concatenate(hashes), np.concatenate(places), spans, np.searchsorted(doc, np.arange(len(off)))


def _slot(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A feature's slot in the weight table, and the check value that tells others in that slot from it."""
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int64), (h & np.uint64(0xFFFF)).astype(np.uint16)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def sentence_logits(model: dict, h: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    slot, check = _slot(h)
    if len(model["weights"]) == 1:
        return np.full(n, model["bias"])
    w = model["weights"][slot]
    hit = np.flatnonzero(w)
    hit = hit[model["check"][slot[hit]] == check[hit]]
    return model["bias"] + np.bincount(sentence[hit], w[hit], n)


def _parts(data: np.ndarray, off: np.ndarray):
    for lo, hi in slices(off):
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]


def loss_and_gradient(theta: np.ndarray, column: np.ndarray, sentence: np.ndarray, doc: np.ndarray, first: np.ndarray, y: np.ndarray, pull: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted mean log loss of the noisy-or over texts, with the weights' penalty, and its gradient.

    theta has a weight per feature and the bias last; feature column[i] stands in sentence[i]; doc has each
    sentence's text, first each text's first sentence; pull weighs texts.
    """
    z = theta[-1] + np.bincount(sentence, theta[column], len(doc))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    survive = _sums(np.log1p(-np.minimum(p, 1 - 1e-12)), first)  # log of prod(1 - p)
    q = np.clip(-np.expm1(survive), 1e-9, 1 - 1e-9)
    loss = (pull * np.where(y > 0, -np.log(q), -survive)).sum() / len(y) + _L2 / 2 * (theta[:-1] ** 2).sum()
    # d loss / d z of a sentence: p for a clean text, -p (1 - q) / q for a toxic one.
    g_z = p * (pull * np.where(y > 0, -(1 - q) / q, 1.0))[doc]
    g = np.append(np.bincount(column, g_z[sentence], len(theta) - 1), g_z.sum()) / len(y)
    g[:-1] += _L2 * theta[:-1]
    return float(loss), g


def fit(texts: list[str], labels: np.ndarray, toxic_share: float | None = None, steps: int = STEPS) -> dict:
    """Weights by Adam on the noisy-or likelihood; classes weigh as in a corpus with this share of toxic texts."""
    data, off = utf8(pa.array(texts, pa.string()))
    data, off = data[off[0] : off[-1]], off - off[0]
    # Texts per slot bound a feature's texts from above: what can't reach LEAST_TEXTS is never held.
    texts_per_slot = np.zeros(1 << HASH_BITS, np.int32)
    for _, _, own, inner in _parts(data, off):
        h, sentence, _, first = sentences(own, inner)
        doc = np.repeat(np.arange(len(inner) - 1), np.diff(first))[sentence]
        pairs = np.unique(_slot(h)[0] * len(inner) + doc) // len(inner)
        texts_per_slot += np.bincount(pairs, minlength=1 << HASH_BITS).astype(np.int32)
    hashes, places, docs, n = [], [], [], 0
    firsts = [np.zeros(1, np.int64)]
    for lo, hi, own, inner in _parts(data, off):
        h, sentence, spans, first = sentences(own, inner)
        keep = texts_per_slot[_slot(h)[0]] >= LEAST_TEXTS
        hashes.append(h[keep])
        places.append((sentence[keep] + n).astype(np.int32))
        docs.append(np.repeat(np.arange(lo, hi, dtype=np.int32), np.diff(first)))
        firsts.append(first[1:] + n)
        n += len(spans)
    h, sentence, doc, first = (np.concatenate(x) for x in (hashes, places, docs, firsts))
    del hashes, places, docs, firsts
    used, column = np.unique(h, return_inverse=True)
    column = column.astype(np.int32)
    del h
    y = labels.astype(float)
    own = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    rate = own if toxic_share is None else np.clip(toxic_share, 1e-3, 1 - 1e-3)
    pull = np.where(y > 0, rate / own, (1 - rate) / (1 - own))
    theta = np.zeros(len(used) + 1)
    theta[-1] = np.log(rate / 10 / (1 - rate / 10))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        _, g = loss_and_gradient(theta, column, sentence, doc, first, y, pull)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    del sentence, column, doc
    release()
    weights, checks = np.zeros(1 << HASH_BITS, np.float32), np.zeros(1 << HASH_BITS, np.uint16)
    slot, check = _slot(used)
    order = np.argsort(np.abs(theta[:-1]))  # where two share a slot the heavier one stays
    weights[slot[order]], checks[slot[order]] = theta[:-1][order], check[order]
    return {"bias": float(theta[-1]), "weights": weights, "check": checks}


def train(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS, class_bytes: int = MAX_CLASS_BYTES) -> dict | None:
    """Fit on labelled texts of docs; None if a class has none.

    A document with several labels is toxic if any is; null labels and null texts don't count; rows that
    share an id are one document, read as the least of their texts. Of each class the texts with the smallest
    hash of their id are taken, at most ``per_class`` of them and (beyond the first) ``class_bytes`` together.
    """
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Only sizes travel here; texts are read again for the chosen few.
    sizes = docs.where(F.col("text").isNotNull()).select("doc_id", F.octet_length("text").alias("bytes"))
    ids = sizes.join(marked, "doc_id").groupBy("doc_id", "toxic").agg(F.max("bytes").alias("bytes"))
    ids = stored(ids.withColumn("turn", F.xxhash64(F.col("doc_id").cast("string"))), "labelled")
    rate = {r.toxic: r["n"] for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not rate.get(0) or not rate.get(1):
        return None
    chosen = []
    for label in (1, 0):
        room = class_bytes
        for i, r in enumerate(ids.where(F.col("toxic") == label).orderBy("turn", "doc_id").limit(per_class).collect()):
            room -= r.bytes
            if i and room < 0:
                break
            chosen.append((r.doc_id, label))
    picked = docs.sparkSession.createDataFrame(chosen, f"doc_id {dict(docs.dtypes)['doc_id']}, toxic int")  # at most 2 x per_class ids
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    found = rows.orderBy("doc_id").collect()
    return fit([r.text for r in found], np.array([r.toxic for r in found]), rate[1] / (rate[0] + rate[1]))


def _score(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("sentence_start", pa.int64()), ("sentence_length", pa.int64()), ("sentence_score", pa.float64())])

    def run(batches):
        model = shared.value
        for batch in batches:
            for lo, hi, data, off in each_slice(batch):
                word, sentence, spans, first = sentences(data, off)
                p = 1 / (1 + np.exp(-np.clip(sentence_logits(model, word, sentence, len(spans)), -30, 30)))
                score = -np.expm1(_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), first))
                n = hi - lo
                doc = np.repeat(np.arange(n), np.diff(first))
                best = np.full(n, -1)
                rank = np.argsort(p, kind="stable")
                best[doc[rank]] = rank  # the last one written is the largest
                has = best >= 0
                at = np.maximum(best, 0)
                none = ~has
                if len(spans):
                    start, length, top = spans[at, 0] - off[:-1], spans[at, 1] - spans[at, 0], p[at]
                else:
                    start, length, top = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(lo, n), pa.array(np.clip(score, 0, 1)), pa.array(start, pa.int64(), mask=none), pa.array(length, pa.int64(), mask=none), pa.array(top, pa.float64(), mask=none)],
                    schema=schema,
                )

    return run


def score(docs: DataFrame, model: dict | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: score, and the worst sentence as a byte span of the text with its own score.

    A null or wordless text scores 0 and has no sentence. Repeated ids keep a row each; of equal sentences
    the last is named. Without a model (no labels of one class) every score is 0. The model has
    2**HASH_BITS weights whatever the corpus, so it may be broadcast. Other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    model = model or {"bias": -30.0, "weights": np.zeros(1, np.float32), "check": np.zeros(1, np.uint16)}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(tidy(_score(shared)), "doc_id long, score double, sentence_start long, sentence_length long, sentence_score double")


def clean_documents(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of docs that score below the threshold, with their columns, whatever other columns are called; nothing is shuffled.

    A null or wordless text scores 0 and stays; rows that repeat an id are judged one by one; without a model all stay.
    """
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            keep = np.ones(len(batch), bool)
            for lo, hi, data, off in each_slice(batch):
                h, sentence, spans, first = sentences(data, off)
                p = 1 / (1 + np.exp(-np.clip(sentence_logits(shared.value, h, sentence, len(spans)), -30, 30)))
                keep[lo:hi] = -np.expm1(_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), first)) < threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(tidy(run), docs.schema)


def _locate(shared, least: float):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("sentence", pa.string()), ("score", pa.float64())])

    def run(batches):
        model = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, off in each_slice(batch):
                word, sentence, spans, first = sentences(data, off)
                p = 1 / (1 + np.exp(-np.clip(sentence_logits(model, word, sentence, len(spans)), -30, 30)))
                doc = np.repeat(np.arange(hi - lo), np.diff(first))
                hit = np.flatnonzero(p >= least)
                text = [data[a:b].tobytes().decode("utf-8", "replace").strip() for a, b in spans[hit]]
                yield pa.record_batch([ids.slice(lo, hi - lo).take(pa.array(doc[hit])), pa.array(spans[hit, 0] - off[doc[hit]]), pa.array(text, pa.string()), pa.array(p[hit])], schema=schema)

    return run


def offending_sentences(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """Every sentence that scores at least so much: doc_id, start (byte in the text), sentence, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(tidy(_locate(shared, least)), "doc_id long, start long, sentence string, score double")


def teaching_rows(column, folds: int = 3, held: int = 1):
    """Rows whose labels may be learnt."""
    return fold(column, folds) != held
