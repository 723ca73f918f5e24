"""Quality rules with risk-controlled thresholds. DataFrame functions only.

Each document gets counts over its whole text. For every stratum (language), steps are tried from the
most lenient to the strictest on labelled good documents; a step sets the cutoffs of all rules together.
It is accepted while the exact binomial tail P(Bin(n, alpha) <= k) stays at or below the test level, where
k of n good documents would be rejected by any rule. Stopping at the first failure (a fixed-sequence test)
needs no correction along the steps, and testing the rules jointly none over the rules; the level is
divided by the strata (Bonferroni). So with confidence 1 - delta no stratum loses more than ``alpha`` of
its good documents to the rules. A stratum with too few labels for a step to pass has no cutoff: it keeps
its documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, text_or_empty

RULES = ("symbols", "dup_lines", "repeats", "shouting")
#: Cutoffs per thousand, lenient to strict, times the rule's factor: a document whose figure is above is rejected.
CUTOFFS = (700, 500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20)
FACTORS = {"symbols": 1, "dup_lines": 2, "repeats": 2, "shouting": 4}
ALPHA, DELTA = 0.02, 0.05
_BLANK = r"[\x20\x09-\x0D]"
_WINDOW = 8


def _windows(hashes: Column) -> Column:
    """A 64-bit hash of each run of eight words; null below eight words."""
    runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - _WINDOW), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(_WINDOW))))
    return F.when(F.size(hashes) >= _WINDOW, runs)


def _repeated_starts(placed: Column) -> Column:
    """From windows sorted by (hash, place): places of those that share their hash, ascending."""
    equal = lambda s, i: F.coalesce(F.get(placed, i)["h"] == s["h"], F.lit(False))
    return F.array_sort(F.transform(F.filter(placed, lambda s, i: equal(s, i - 1) | equal(s, i + 1)), lambda s: s["i"]))


def measure(docs: DataFrame, id_column: str = "doc_id", text: str = "text", stratum: str = "lang", carry: bool = False) -> DataFrame:
    """Counts over every whole text; a null text is an empty one, a null stratum is ''.

    n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words, n_shout
    (capitals A-Z and exclamation marks). Other columns of docs are ignored; with carry the whole row is
    kept as the struct ``row``.
    """
    row = ["row"] if carry else []
    base = docs.select(*([F.struct("*").alias("row")] if carry else []), F.col(id_column).alias("doc_id"), F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), text_or_empty(text).alias("t"))
    split = base.select(
        *row,
        "doc_id",
        "stratum",
        (F.octet_length("t") - F.octet_length(F.regexp_replace("t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.octet_length("t") - F.octet_length(F.regexp_replace("t", r"[A-Z!]", ""))).cast("long").alias("n_shout"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.filter(F.split("t", _BLANK + "+"), lambda x: x != "").alias("words"),
    )
    counted = split.select(
        *row,
        "doc_id",
        "stratum",
        "n_symbols",
        "n_shout",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windowed = counted.withColumn("windows", _windows(F.col("hashes"))).drop("hashes")
    # Only texts with a repeat sort their windows.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = windowed.withColumn("placed", F.when(repeats, placed)).drop("windows")
    found = found.withColumn("starts", F.when(F.col("placed").isNotNull(), _repeated_starts(F.col("placed")))).drop("placed")
    total = F.aggregate(
        "starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-_WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(_WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return found.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("starts")


def _rates() -> dict[str, Column]:
    """Each rule's figure per thousand, rounded down."""
    per_mille = lambda a, b: F.when(b > 0, F.floor(a * 1000 / b)).otherwise(0).cast("long")
    c = F.col
    return {
        "symbols": per_mille(c("n_symbols"), c("word_chars")),
        "dup_lines": per_mille(c("n_dup_lines"), c("n_lines")),
        "repeats": per_mille(c("n_repeat_words"), c("n_words")),
        "shouting": per_mille(c("n_shout"), c("word_chars")),
    }


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed exactly in log space; 1 where k is above the mean (never a pass)."""
    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))
    start = F.struct(first.alias("t"), first.alias("m"), F.lit(1.0).alias("s"))

    def step(a, j):
        t = a["t"] + F.log((n - j + 1) / j) + F.lit(odds)
        m = F.greatest(a["m"], t)
        return F.struct(t.alias("t"), m.alias("m"), (a["s"] * F.exp(a["m"] - m) + F.exp(t - m)).alias("s"))

    tail = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, step, lambda a: F.exp(a["m"] + F.log(a["s"])))
    return F.when(k > n * p, 1.0).otherwise(tail)


def cutoffs(measured: DataFrame, labels: DataFrame, id_column: str = "doc_id", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum that has cutoffs, with one per rule.

    Only labelled good documents count (quality = 1; a document with several labels is good if its
    lowest is 1; null labels don't count). The result has as many rows as there are strata.
    """
    good = labels.where(F.col("quality").isNotNull()).groupBy(F.col(id_column).alias("doc_id")).agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    rates = measured.where(F.col("n_words") > 0).select("doc_id", "stratum", *(v.alias(k) for k, v in _rates().items()))
    held = rates.join(good, "doc_id")
    above = lambda c: F.greatest(*((F.col(r) > c * FACTORS[r]).cast("int") for r in RULES))
    counts = held.groupBy("stratum").agg(F.count("*").alias("n"), *(F.sum(above(c)).alias(f"k_{c}") for c in CUTOFFS))
    tests = F.explode(F.array(*(F.struct(F.lit(i).alias("step"), F.lit(c).alias("cutoff"), F.col(f"k_{c}").alias("k")) for i, c in enumerate(CUTOFFS))))
    # One row per stratum: counted before the steps multiply them.
    counts = counts.withColumn("strata", F.count("*").over(W.partitionBy(F.lit(0))))
    long = counts.select("stratum", "n", "strata", tests.alias("x")).select("stratum", "n", "strata", "x.*")
    tried = long.withColumn("fails", (binomial_tail(F.col("n"), F.col("k"), alpha) > F.lit(delta) / F.col("strata")).cast("int"))
    passed = tried.withColumn("failed", F.max("fails").over(W.partitionBy("stratum").orderBy("step"))).where("failed = 0")
    return passed.groupBy("stratum").agg(*((F.min("cutoff") * FACTORS[r]).alias(f"cut_{r}") for r in RULES))


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measures, base rule, the rule that rejects (null: none) and kept, for every row of docs.

    Base: fewer than 20 words, or more than 30 % repeated words. A null text has no words and fails
    the base. Repeated ids keep a row each; an empty table gives no rows. The cutoff table has a row
    per language and is joined as it comes, without a broadcast hint.
    """
    measured = stored(measure(docs, id_column, text, stratum), "quality")
    cuts = stored(cutoffs(measured, labels, id_column, alpha, delta), "quality-cutoffs")
    return _judged(measured, cuts)


def _judged(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    rates = _rates()
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rule = F.coalesce(*(F.when(rates[r] > F.col(f"cut_{r}"), F.lit(r)) for r in RULES))
    judged = measured.join(cuts, "stratum", "left").withColumns({"base_failed": failed, "rule": rule})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that the rules keep, with their columns, whatever other columns are called.

    A null or empty text has no words and goes; rows that repeat an id are judged one by one; without labels enough for a
    cutoff the base rules judge alone. An empty table gives no rows.

    Measures are taken once for the cutoffs and again beside the rows, so that no text is shuffled: the
    cutoffs have a row per language and meet the rows where they are.
    """
    cuts = stored(cutoffs(stored(measure(docs), "quality"), labels), "quality-cutoffs")
    # A row number above the measures keeps the optimizer from copying them into pushed-down filters.
    measured = measure(docs, carry=True).withColumn("at", F.monotonically_increasing_id())
    return _judged(measured, cuts).where(F.col("kept") & (F.col("at") >= 0)).select("row.*")


def measures_sql(source: str = "documents") -> str:
    """DuckDB SQL for the counts of ``measure``."""
    return rf"""
base AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM {source}),
parts AS (
  SELECT doc_id, stratum,
    len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(regexp_replace(t, '[^A-Z!]', '', 'g')) AS n_shout,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM base),
windows AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM parts WHERE len(words) >= 8)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows),
gaps AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM again WHERE c > 1),
repeats AS (SELECT doc_id, sum(least(8, coalesce(i - p, 8))) AS n FROM gaps GROUP BY doc_id),
measured AS (
  SELECT doc_id, stratum, n_symbols, n_shout, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN repeats USING (doc_id))"""


def oracle_sql() -> str:
    """DuckDB SQL for the whole operator, thresholds included."""
    rates = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "shouting": ("n_shout", "word_chars")}
    rate = ", ".join(f"CASE WHEN {b} > 0 THEN {a} * 1000 // {b} ELSE 0 END AS {r}" for r, (a, b) in rates.items())
    steps = ", ".join(f"({i}, {c})" for i, c in enumerate(CUTOFFS))
    above = " OR ".join(f"{r} > cutoff * {FACTORS[r]}" for r in RULES)
    cut = ", ".join(f"min(cutoff) * {FACTORS[r]} AS cut_{r}" for r in RULES)
    over = " OR ".join(f"coalesce({r} > cut_{r}, false)" for r in RULES)
    return f"""WITH {measures_sql()},
rated AS (SELECT *, {rate} FROM measured),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT rated.* FROM rated JOIN good USING (doc_id) WHERE n_words > 0),
steps(step, cutoff) AS (VALUES {steps}),
counts AS (SELECT stratum, step, cutoff, count(*) AS n, count(*) FILTER ({above}) AS k FROM held, steps GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN k > n * {ALPHA} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
    lambda j: exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({ALPHA}) + (n - j) * ln(1 - {ALPHA})))) END AS tail FROM counts),
failed AS (
  SELECT *, max((tail > {DELTA} / (SELECT count(DISTINCT stratum) FROM counts))::INT) OVER (PARTITION BY stratum ORDER BY step) AS failed FROM tails),
cuts AS (SELECT stratum, {cut} FROM failed WHERE failed = 0 GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT ({over}) AS kept
FROM rated LEFT JOIN cuts USING (stratum)"""
