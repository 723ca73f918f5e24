"""Language identification with interpolated Kneser-Ney character models.

Training counts every character n-gram inside words of all training texts: tasks count words, turn
them into n-grams with their counts, and Spark sums per (language, n-gram). Lower orders use
continuation counts (how many different characters stand before), grams at a word's start their own
counts. Spark interpolates the orders by joins: each order is a written table of n-grams with their
64-bit hash and, for each language, the log of the probability and of the back-off weight. The tables
grow with the corpus; nothing is left out.

Scoring uses sorted hash arrays. What is broadcast has at most ``MODEL_BYTES``: the most frequent n-grams,
all of them if they fit. A word with an n-gram outside of them is scored by a join with the written
tables instead, so the result doesn't depend on the bound.

A text's language has the lowest cross-entropy per character. Confidence compares the cross-entropies
of all languages; it is accepted where it reaches its language's threshold, which is a quantile of the
right predictions on training rows that were kept out of the counts (calibrated rejection).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_slice, fold, mix64, stored, tidy

ORDER = 4
#: The bound of the broadcast arrays, over all languages; n-grams beyond it are looked up by a join.
MODEL_BYTES = 64 << 20
DISCOUNT = 0.75
REJECTED_SHARE = 0.005
UNKNOWN = "und"
#: Letters with the marks that combine with them; other characters end a word.
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_START, _END = "\x02", "\x03"
_FLUSH_WORDS, _FLUSH_CHARS = 200_000, 64 << 20
_CACHE_WORDS = 400_000
#: Characters of a part, the unit of the lookup by joins; a longer word is several parts.
_PART = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _codes(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the parts one after another, each code's place in its part, and where parts begin."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])[:-1]
    place = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
    return codes, place, first


def _gram_hashes(codes: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 .. order: the hash of the n codes that end at each code, 0 where the word has fewer."""
    out = []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, order + 1):
        earlier = np.zeros(len(codes), np.uint64)
        earlier[n - 1 :] = codes[: len(codes) - n + 1]
        h = h + mix64((earlier + np.uint64(1)) * _STEP + np.uint64(n))
        out.append(np.where(place >= n - 1, mix64(h + np.uint64(n)), np.uint64(0)))
    return out


def _count_grams(order: int):
    """Tasks: (lang, text) -> (lang, gram, n): the longest gram up to the order that ends at each character."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def grams_of(lang: str, words: Counter):
        keys = list(words)
        codes, place, _ = _codes([_START + w + _END for w in keys])
        weight = np.repeat(np.fromiter(words.values(), np.int64, len(keys)), np.fromiter((len(w) + 2 for w in keys), np.int64, len(keys)))
        h = _gram_hashes(codes, place, order)
        longest = np.choose(np.minimum(place, order - 1), h)
        use = place > 0
        at = np.flatnonzero(use)
        unique, seen, inverse = np.unique(longest[use], return_index=True, return_inverse=True)
        n = np.bincount(inverse, weight[use], len(unique)).astype(np.int64)
        text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        where = at[seen]
        low = where - np.minimum(place[where], order - 1)
        grams = [text[a : b + 1] for a, b in zip(low.tolist(), where.tolist())]
        return pa.record_batch([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n)], schema=schema)

    def run(batches):
        held: dict[str, Counter] = {}
        read: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = held.setdefault(lang, Counter())
                own.update(_words(text))
                read[lang] += len(text)
                if own and (len(own) >= _FLUSH_WORDS or read[lang] >= _FLUSH_CHARS):
                    yield grams_of(lang, held.pop(lang))
                    read[lang] = 0
        for lang, own in held.items():
            if own:
                yield grams_of(lang, own)

    return run


def _hashed(order: int):
    """Tasks: (n, gram, ...) -> the same with the gram's hash ``h``."""

    def run(batches):
        for batch in batches:
            grams, n = batch.column("gram").to_pylist(), batch.column("n").to_numpy()
            h = np.zeros(len(grams), np.uint64)
            codes, _, first = _codes(grams)
            if len(grams):
                hashes, last = _gram_hashes(codes, np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes)))), order), np.append(first, len(codes))[1:] - 1
                for k in range(1, order + 1):
                    h[n == k] = hashes[k - 1][last[n == k]]
            yield pa.record_batch([*batch.columns, pa.array(h.view(np.int64))], names=[*batch.schema.names, "h"])

    return run


def train(docs: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> dict | None:
    """Fit the models on every row with a text and a language; None if there is none.

    Returns the languages, the order, the log probability of an unknown character per language, and the
    written table (n, gram, h, total, logs, weights) of all orders. Its size follows the corpus.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = rows.mapInArrow(tidy(_count_grams(order)), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = stored(counted, "char-ngrams")
    langs = [r.lang for r in top.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return None
    ks = range(len(langs))
    # Counts per gram with a column per language, order by order from the longest.
    wide = top.groupBy("gram").agg(*(F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"c{k}") for k, x in enumerate(langs)))
    wide = stored(wide.withColumn("size", F.char_length("gram")), "ngram-counts")
    counts = {order: wide.where(F.col("size") == order).drop("size")}
    for n in range(order - 1, 0, -1):
        before = counts[n + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*(F.count(F.when(F.col(f"c{k}") > 0, 1)).alias(f"c{k}") for k in ks))
        both = before.unionByName(wide.where(F.col("size") == n).drop("size"))
        counts[n] = stored(both.groupBy("gram").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in ks)), f"ngram-counts-{n}")
    contexts = {n: stored(counts[n].groupBy(F.expr(f"substring(gram, 1, {n - 1})").alias("gram")).agg(*(F.sum(f"c{k}").alias(f"m{k}") for k in ks), *(F.count(F.when(F.col(f"c{k}") > 0, 1)).alias(f"t{k}") for k in ks)), f"ngram-contexts-{n}") for n in range(1, order + 1)}
    whole = contexts[1].first()
    alphabet = counts[1].count() + 1  # and any other character
    share = lambda m, t: F.when(m > 0, DISCOUNT * t / m).otherwise(1.0)
    unseen = [DISCOUNT * whole[f"t{k}"] / whole[f"m{k}"] / alphabet if whole[f"m{k}"] else 1 / alphabet for k in ks]
    levels, lower = [], None
    for n in range(1, order + 1):
        told = counts[n]
        if n == 1:
            told = told.select("gram", *(f"c{k}" for k in ks), *(F.lit(1 / alphabet).alias(f"p{k}") for k in ks), *(F.lit(whole[f"{x}{k}"]).alias(f"{x}{k}") for x in "mt" for k in ks))
        else:
            told = told.withColumns({"context": F.expr(f"substring(gram, 1, {n - 1})"), "rest": F.expr("substring(gram, 2)")})
            told = told.join(contexts[n].withColumnRenamed("gram", "context"), "context").join(lower.withColumnRenamed("gram", "rest"), "rest")
        seen = lambda k: F.when(F.col(f"m{k}") > 0, F.greatest(F.col(f"c{k}") - DISCOUNT, F.lit(0.0)) / F.col(f"m{k}")).otherwise(0.0)
        p = [(seen(k) + share(F.col(f"m{k}"), F.col(f"t{k}")) * F.col(f"p{k}")).alias(f"p{k}") for k in ks]
        lower = stored(told.select("gram", sum((F.col(f"c{k}") for k in ks), F.lit(0)).alias("total"), *p), f"ngram-probabilities-{n}")
        level = lower
        weights = F.array(*(F.lit(0.0) for _ in ks))
        if n < order:  # the start of a word is a context without being a gram: hence the outer join
            level = lower.join(contexts[n + 1], "gram", "full")
            weights = F.array(*(F.coalesce(F.log(share(F.col(f"m{k}"), F.col(f"t{k}"))), F.lit(0.0)) for k in ks))
        logs = F.array(*(F.coalesce(F.log(f"p{k}"), F.lit(0.0)) for k in ks))
        levels.append(level.select(F.lit(n).alias("n"), "gram", F.coalesce("total", F.lit(1 << 40)).alias("total"), logs.alias("logs"), weights.alias("weights")))
        lower = lower.drop("total")
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    table = stored(table.mapInArrow(tidy(_hashed(order)), "n int, gram string, total long, logs array<double>, weights array<double>, h long"), "ngram-model")
    return {"langs": langs, "order": order, "unseen": np.log(unseen), "table": table}


def arrays(model: dict, most: int = MODEL_BYTES) -> dict:
    """Sorted hash arrays of the model's most frequent n-grams within so many bytes; ``complete`` if that is all of them."""
    table, size = model["table"], len(model["langs"])
    rows = most // (8 + 8 * size)
    # At most a few hundred steps of frequency, whatever the corpus.
    step = F.floor(4 * F.log2("total")).cast("int")
    held, least = 0, 1 << 30
    spread = sorted((r.step, r["count"]) for r in table.groupBy(step.alias("step")).count().collect())
    for at, n in reversed(spread):
        if held + n > rows:
            break
        held, least = held + n, at
    found = table.where(step >= least).select("n", "h", F.col("logs").cast("array<float>"), F.col("weights").cast("array<float>")).toArrow() if held else None
    out = {"langs": model["langs"], "order": model["order"], "unseen": model["unseen"], "complete": held == sum(n for _, n in spread), "hash": [], "logs": [], "weights": []}
    for n in range(1, model["order"] + 1):
        part = found.filter(pa.compute.equal(found.column("n"), n)).combine_chunks() if found is not None else None
        matrix = lambda c: part.column(c).combine_chunks().flatten().to_numpy().reshape(-1, size) if part is not None else np.zeros((0, size), np.float32)
        key = part.column("h").to_numpy().view(np.uint64) if part is not None else np.zeros(0, np.uint64)
        sort = np.argsort(key)
        out["hash"].append(key[sort])
        out["logs"].append(matrix("logs")[sort])
        out["weights"].append(matrix("weights")[sort])
    return out


def score_parts(model: dict, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each part's characters in each language, and whether the arrays hold all of its longest grams.

    A part is a word with its start and end marks, or a stretch of one: the first characters of a stretch are
    context and don't count.
    """
    order = model["order"]
    codes, place, first = _codes(parts)
    skip = np.array([1 if p[0] == _START else order - 1 for p in parts], np.int64)
    h = _gram_hashes(codes, place, order)
    total = np.tile(np.asarray(model["unseen"], np.float64), (len(codes), 1))
    known = np.zeros(len(codes), bool)
    before = None
    for n in range(1, order + 1):
        key = model["hash"][n - 1]
        at = np.minimum(np.searchsorted(key, h[n - 1]), max(0, len(key) - 1))
        hit = (key[at] == h[n - 1]) & (place >= n - 1) if len(key) else np.zeros(len(codes), bool)
        if n > 1:  # the context of this gram is the gram one shorter that ended one code earlier
            held = np.zeros(len(codes), bool)
            held[1:] = before[0][:-1]
            held &= place >= n - 1
            context = np.zeros(len(codes), np.int64)
            context[1:] = before[1][:-1]
            miss = held & ~hit
            total[miss] += model["weights"][n - 2][context[miss]]
        total[hit] = model["logs"][n - 1][at[hit]]
        known |= hit & (place == n - 1) if n < order else hit
        before = hit, at
    context = place < np.repeat(skip, np.diff(np.append(first, len(codes))))
    total[context] = 0
    if not len(first):
        return np.zeros((0, len(model["langs"]))), np.zeros(0, bool)
    return np.add.reduceat(total, first, axis=0), np.logical_and.reduceat(known | context, first)


def score_words(model: dict, words: list[str]) -> np.ndarray:
    """Log probability of each word in each language, its end included."""
    return score_parts(model, [_START + w + _END for w in words])[0]


def _parts_of(word: str, order: int) -> list[str]:
    """The word with its marks as stretches of at most ``_PART`` characters, each after its context."""
    whole = _START + word + _END
    return [whole[max(0, lo - order + 1) : lo + _PART] for lo in range(0, len(whole), _PART) if lo == 0 or lo < len(whole)]


_SUMS = "row string, doc_id long, truth string, n long, sums array<double>, rest array<struct<part:string,times:long>>"


def _sum_texts(shared):
    """Tasks: texts -> per text the characters, the summed log probabilities of words that the arrays hold, and the other words' parts."""
    rest_type = pa.list_(pa.struct([("part", pa.string()), ("times", pa.int64())]))
    schema = pa.schema([("row", pa.string()), ("doc_id", pa.int64()), ("truth", pa.string()), ("n", pa.int64()), ("sums", pa.list_(pa.float64())), ("rest", rest_type)])

    def run(batches):
        import uuid

        model = shared.value
        size, order, complete = len(model["langs"]), model["order"], model["complete"]
        mark, number = uuid.uuid4().hex, 0
        index: dict[str, int] = {}
        kept, fine = np.zeros((0, size)), np.zeros(0, bool)
        for batch in batches:
            for lo, hi, _, _ in each_slice(batch, "text"):
                part = batch.slice(lo, hi - lo)
                found = [_words(t) for t in part.column("text").to_pylist()]
                if len(index) > _CACHE_WORDS:
                    index, kept, fine = {}, kept[:0], fine[:0]
                flat = [w for x in found for w in x]
                new = [w for w in dict.fromkeys(flat) if w not in index]
                if new:
                    index.update(zip(new, range(len(index), len(index) + len(new))))
                    scores, whole = score_parts(model, [_START + w + _END for w in new])
                    whole = whole | complete
                    kept, fine = np.concatenate([kept, scores * whole[:, None]]), np.concatenate([fine, whole])
                rows = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
                upto = np.cumsum([0, *map(len, found)])
                chars = np.cumsum([0, *map(len, flat)])[upto] + upto
                sums = np.zeros((len(flat) + 1, size))
                np.cumsum(kept[rows], axis=0, out=sums[1:])
                per = sums[upto[1:]] - sums[upto[:-1]]
                rest: list = [None] * len(found)
                if not complete:
                    open_ = np.flatnonzero(~fine[rows])
                    of = np.searchsorted(upto, open_, "right") - 1
                    for i, at in zip(of.tolist(), open_.tolist()):
                        rest[i] = rest[i] or Counter()
                        rest[i].update(_parts_of(flat[at], order))
                    rest = [r and [{"part": p, "times": t} for p, t in r.items()] for r in rest]
                names = [f"{mark}-{number + i}" for i in range(len(found))]
                number += len(found)
                yield pa.record_batch([pa.array(names), part.column("doc_id"), part.column("truth"), pa.array(np.diff(chars)), pa.FixedSizeListArray.from_arrays(pa.array(per.ravel()), size).cast(schema.field("sums").type), pa.array(rest, rest_type)], schema=schema)

    return run


def _needed(order: int):
    """Tasks: parts -> every gram of every order in them."""
    schema = pa.schema([("part", pa.string()), ("n", pa.int32()), ("h", pa.int64())])

    def run(batches):
        for batch in batches:
            parts = batch.column("part").to_pylist()
            if not parts:
                continue
            codes, place, first = _codes(parts)
            owner = np.repeat(np.arange(len(parts)), np.diff(np.append(first, len(codes))))
            for n, h in enumerate(_gram_hashes(codes, place, order), 1):
                at = np.flatnonzero(place >= n - 1)
                pair = np.unique(np.stack([owner[at], h[at].view(np.int64)]), axis=1)
                yield pa.record_batch([pa.array(parts).take(pa.array(pair[0])), pa.array(np.full(pair.shape[1], n, np.int32)), pa.array(pair[1])], schema=schema)

    return run


def _score_rest(langs: list[str], order: int, unseen: np.ndarray):
    """Tasks: parts with what the written tables say of their grams -> log probabilities per language."""
    schema = pa.schema([("part", pa.string()), ("scores", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            grams = [g for x in batch.column("grams").to_pylist() for g in x]
            model = {"langs": langs, "order": order, "unseen": unseen, "hash": [], "logs": [], "weights": []}
            for n in range(1, order + 1):
                own = {np.uint64(g["h"] % (1 << 64)): (g["logs"], g["weights"]) for g in grams if g["n"] == n and g["logs"] is not None}
                key = np.array(sorted(own), np.uint64)
                model["hash"].append(key)
                model["logs"].append(np.array([own[h][0] for h in key]).reshape(-1, len(langs)))
                model["weights"].append(np.array([own[h][1] for h in key]).reshape(-1, len(langs)))
            scores, _ = score_parts(model, batch.column("part").to_pylist())
            yield pa.record_batch([batch.column("part"), pa.array(scores.tolist(), schema.field("scores").type)], schema=schema)

    return run


def _verdict(batches):
    """Tasks: summed log probabilities -> best language, cross-entropy, margin and score."""
    schema = pa.schema([("doc_id", pa.int64()), ("truth", pa.string()), ("best", pa.int32()), ("entropy", pa.float64()), ("margin", pa.float64()), ("score", pa.float64())])
    for batch in batches:
        if not len(batch):
            continue
        n = batch.column("n").to_numpy()
        per = batch.column("sums").flatten().to_numpy().reshape(len(batch), -1) / np.maximum(n, 1)[:, None]
        ranked = np.sort(per, axis=1)
        margin = ranked[:, -1] - ranked[:, -2] if per.shape[1] > 1 else np.full(len(per), 1.0)
        scaled = np.exp((per - per.max(axis=1, keepdims=True)) * np.minimum(np.maximum(n, 1), 20)[:, None])
        score = 1 / scaled.sum(axis=1)
        none = n == 0
        columns = [np.where(none, -1, per.argmax(axis=1)).astype(np.int32), np.where(none, 0, -per.max(axis=1)), np.where(none, 0, margin), np.where(none, 0, score)]
        yield pa.record_batch([batch.column("doc_id"), batch.column("truth"), *map(pa.array, columns)], schema=schema)


def predict(docs: DataFrame, model: dict, held: dict | None = None, id_column: str = "doc_id", text: str = "text", truth: str | None = None) -> DataFrame:
    """doc_id, truth (a column of docs, if named), best (index of the language, -1 without letters), entropy, margin, score for every row.

    ``held`` are the model's ``arrays``. A null, empty or letterless text has no language. Repeated ids keep a
    row each; equal entropies go to the language first in order. Other columns are ignored.
    """
    held = held or arrays(model)
    shared = docs.sparkSession.sparkContext.broadcast(held)
    named = F.col(truth).cast("string") if truth else F.lit(None).cast("string")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), named.alias("truth"))
    summed = rows.mapInArrow(tidy(_sum_texts(shared)), _SUMS)
    if not held["complete"]:
        summed = stored(summed, "language-sums")
        order, ks = model["order"], range(len(model["langs"]))
        rest = stored(summed.select("row", F.inline("rest")), "language-rest")
        parts = rest.groupBy("part").agg(F.count("*").alias("texts")).select("part")
        needed = stored(parts.mapInArrow(tidy(_needed(order)), "part string, n int, h long"), "language-needed")
        told = needed.join(model["table"].select("n", "h", "logs", "weights"), ["n", "h"], "left").groupBy("part").agg(F.collect_list(F.struct("n", "h", "logs", "weights")).alias("grams"))  # a part has a bounded length
        scored = stored(told.mapInArrow(tidy(_score_rest(model["langs"], order, model["unseen"])), "part string, scores array<double>"), "language-parts")
        more = rest.join(scored, "part").groupBy("row").agg(*(F.sum(F.col("times") * F.get("scores", F.lit(k))).alias(f"s{k}") for k in ks))
        both = summed.join(more, "row", "left")
        summed = both.select("row", "doc_id", "truth", "n", F.array(*(F.get("sums", F.lit(k)) + F.coalesce(f"s{k}", F.lit(0.0)) for k in ks)).alias("sums"))
    return summed.select("doc_id", "truth", "n", "sums").mapInArrow(tidy(_verdict), "doc_id long, truth string, best int, entropy double, margin double, score double")


def thresholds(calibration: DataFrame, model: dict, held: dict, rejected: float = REJECTED_SHARE) -> dict[str, float]:
    """Per language the margin below which a prediction is rejected: the given share of right ones.

    A language with too few calibration rows for that share to hold one row rejects nothing.
    """
    marked = predict(calibration, model, held, truth="lang")
    name = F.element_at(F.array(*(F.lit(x) for x in model["langs"])), F.col("best") + 1)
    right = marked.where((F.col("best") >= 0) & (name == F.col("truth")))
    found = right.groupBy("truth").agg(F.percentile_approx("margin", rejected, 10_000).alias("t"), F.count("*").alias("n"))
    return {r.truth: r.t for r in found.collect() if r.n * rejected >= 1}


def identify(docs: DataFrame, train_rows, calibration_rows, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """Train on docs.where(train_rows), calibrate on docs.where(calibration_rows), predict every row.

    Returns doc_id, lang_pred (und without letters), score, entropy, margin, accepted. Without a single
    training row every text is und and not accepted.
    """
    model = train(docs.where(train_rows))
    if not model:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("entropy"), F.lit(0.0).alias("margin"), F.lit(False).alias("accepted"))
    held = arrays(model, model_bytes)
    limits = thresholds(docs.where(calibration_rows & F.col("lang").isNotNull()), model, held)
    found = predict(docs, model, held)
    name = F.when(F.col("best") < 0, F.lit(UNKNOWN)).otherwise(F.element_at(F.array(*(F.lit(x) for x in model["langs"])), F.greatest(F.col("best"), F.lit(0)) + 1))
    limit = F.element_at(F.array(*(F.lit(float(limits.get(x, 0.0))) for x in model["langs"])), F.greatest(F.col("best"), F.lit(0)) + 1)
    return found.select("doc_id", name.alias("lang_pred"), "score", "entropy", "margin", ((F.col("best") >= 0) & (F.col("margin") >= limit)).alias("accepted"))


def identify_folds(docs: DataFrame, folds: int = 5, calibration: int = 32) -> DataFrame:
    """Rows whose fold is not 0 teach; of these, every 32nd hash bucket calibrates and is left out of the counts."""
    teach = fold(F.col("doc_id"), folds) != 0
    tune = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(calibration)) == 0
    found = identify(docs.select("doc_id", "text", "lang"), teach & ~tune, teach & tune)
    return found.withColumn("held_out", fold(F.col("doc_id"), folds) == 0)
