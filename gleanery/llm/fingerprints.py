"""I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms (words) whose inverse document frequency, log2(documents / document frequency), lies
in ``BAND``: neither the words of every text nor those of a handful. A term's md5 deals it to one of ``SUBSETS`` random subsets of the
lexicon, and by its other bits to nested smaller ones inside it, each of half the terms of the one before. A text is fingerprinted by each subset through the smallest nested one that still holds a
term of it: its distinct terms there are sorted and hashed. An edit changes only the subsets that its terms
are in, so texts with common parts agree on some of them, and the length of a text doesn't matter.

Main path: DataFrame functions only. Texts are shuffled once (by id, to meet the head of their next document,
which alone travels); the lexicon is bounded: a term in it stands in 1 of 2**BAND[1] documents at least, so there
are at most that many times the mean number of distinct terms of a document, whatever the corpus. It is counted,
and joined without a broadcast beyond ``LEXICON_ROWS``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Lowest and highest inverse document frequency, in bits.
BAND = (4, 12)
SUBSETS = 16
#: Rows of the lexicon (16 bytes each) up to which it is broadcast.
LEXICON_ROWS = 2_000_000
#: Ids that one task orders.
RUN_IDS = 100_000
#: A term's code: its subset (4 bits), its level (6 bits) and 52 bits of its own.
_OWN = 52


def distinct_terms(text: Column) -> Column:
    """Different words of a text; none for an empty one."""
    return F.array_remove(F.array_distinct(F.split(text, "[ \\t-\\r]+")), "")


def term_code(term: Column) -> Column:
    """Subset, level and own bits of a term, from its md5. A level has twice the terms of the one below; the lowest ones are the smallest nested subsets."""
    digits = lambda at, n: F.conv(F.substring(F.md5(term), at, n), 16, 10).cast("long")
    place = F.shiftleft(digits(1, 1), 6) + F.length(F.bin(digits(2, 14)))
    return F.shiftleft(place, _OWN) + digits(3, 13)


def lexicon(texts: DataFrame, n_texts: int, text: str = "text", band: tuple[int, int] = BAND) -> DataFrame:
    """(x, code) of the terms in the band: a hash to find the term by, and its code. Below 2**band[0] texts a term may still stand in one text."""
    terms = texts.select(F.explode(distinct_terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    most, least = max(1.0, n_texts / 2 ** band[0]), n_texts / 2 ** band[1]
    inside = terms.where((F.col("df") <= F.lit(most)) & (F.col("df") >= F.lit(least)))
    return inside.select(F.xxhash64("term").alias("x"), term_code(F.col("term")).alias("code"))


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it: columns would be inlined into its lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def signature(codes: Column) -> Column:
    """One hash per subset, empty where the text has no term of it. ``codes``: the text's distinct codes, ascending."""
    place = lambda c: F.shiftright(c, _OWN)

    def hashes(finest: Column) -> Column:
        held = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda b: F.filter(finest, lambda c: F.shiftright(c, _OWN + 6) == b))
        return F.transform(held, lambda a: F.when(F.size(a) > 0, F.substring(F.md5(F.array_join(a.cast("array<string>"), ",")), 1, 16)).otherwise(""))

    def of(sorted_codes: Column) -> Column:
        # The first place of each subset is its smallest nested subset with a term; only codes of those places are hashed.
        firsts = lambda places: F.filter(places, lambda p, i: (i == 0) | (F.shiftright(p, 6) != F.shiftright(F.get(places, i - 1), 6)))
        kept = lambda first: F.filter(sorted_codes, lambda c: F.array_contains(first, place(c)))
        return _let(F.array_distinct(F.transform(sorted_codes, place)), lambda places: _let(firsts(places), lambda first: _let(kept(first), hashes)))

    return _let(codes, of)


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Share of the subsets that either signature fills on which both agree; 1 for equal fingerprints."""
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != "") | (y != "")), lambda v: v))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != "") & (x == y)), lambda v: v))
    return F.when(equal, 1.0).when(either > 0, same.cast("double") / either).otherwise(0.0)


def next_in_order(ids: DataFrame, count: int) -> DataFrame:
    """ids with next_id: the next smaller doc_id, for the smallest the largest. Ids are dealt out by ranges, none of them to one task alone."""
    ranged = ids.repartitionByRange(max(8, math.ceil(count / RUN_IDS)), "doc_id").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ids-in-order")
    # A row per range: its first id is what follows the last of the range above.
    heads = ranged.groupBy("part").agg(F.max("doc_id").alias("head"))
    over = W.orderBy(F.desc("part"))
    heads = heads.select("part", F.coalesce(F.lead("head").over(over), F.max("head").over(W.partitionBy())).alias("after"))
    follow = F.lead("doc_id").over(W.partitionBy("part").orderBy(F.desc("doc_id")))
    linked = ranged.withColumn("_next", follow).join(heads, "part")
    return linked.select(*ids.columns, F.coalesce("_next", "after").alias("next_id"))


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and how alike they and the next document's are.

    The next document is that of the next smaller id (after the smallest: the largest). The edited text has the
    document's last floor(n_chars / 3) code points replaced by the next one's first as many, or all it has.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text is an empty one. A text without a term of the lexicon (all empty ones) has the hash of
    the whole text as its fingerprint, and is like equal texts only. Rows without an
    id take no part; of rows with one id that with the least text stands for all. A single document is its own
    next one. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    measured = lambda rows: rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.length("text")).cast("long").alias("n_chars"))
    ids = stored(measured(rows), "ids")
    if not ids.where("n > 1").isEmpty():
        rows = stored(rows.groupBy("doc_id").agg(F.min("text").alias("text")), "texts-of-ids")
        ids = stored(measured(rows), "ids")
    ids = ids.drop("n")
    count = ids.count()
    links = stored(next_in_order(ids, count), "next-ids").withColumn("taken", F.floor(F.col("n_chars") / 3).cast("int"))

    words = stored(lexicon(rows, count), "lexicon")
    known = F.broadcast(words) if words.count() <= LEXICON_ROWS else words

    asked = links.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), "taken")
    heads = rows.join(asked, "doc_id").select(F.col("for_id").alias("doc_id"), F.expr("substring(text, 1, taken)").alias("head"))
    edited = F.concat(F.expr("substring(text, 1, CAST(n_chars AS INT) - taken)"), F.col("head"))
    both = rows.join(links, "doc_id").join(heads, "doc_id").select("doc_id", "text", edited.alias("edited"))

    # Both parts read the same shuffled texts and stay where their document is.
    hashed = both.select("doc_id", F.sha2("edited", 256).alias("edited_sha256"), F.sha2("text", 256).alias("sha256"))
    side = F.explode(F.array(F.struct(F.lit(False).alias("e"), F.col("text").alias("t")), F.struct(F.lit(True).alias("e"), F.col("edited").alias("t"))))
    each = both.select("doc_id", side.alias("s")).select("doc_id", "s.e", F.explode(distinct_terms(F.col("s.t"))).alias("term"))
    each = each.select("doc_id", "e", F.xxhash64("term").alias("x")).join(known, "x")
    codes = each.groupBy("doc_id").agg(*(F.sort_array(F.collect_list(F.when(F.col("e") == own, F.col("code")))).alias(c) for own, c in ((False, "codes"), (True, "edited_codes"))))
    none = F.array().cast("array<bigint>")
    found = hashed.join(codes, "doc_id", "left").select("doc_id", "sha256", "edited_sha256", signature(F.coalesce("codes", none)).alias("sig"), signature(F.coalesce("edited_codes", none)).alias("edited_sig"))
    print_of = lambda sig, whole: F.when(F.exists(sig, lambda h: h != ""), F.array_join(sig, "-")).otherwise(F.col(whole))
    found = stored(found.select("doc_id", "edited_sha256", "sig", "edited_sig", print_of("sig", "sha256").alias("fingerprint"), print_of("edited_sig", "edited_sha256").alias("edited_fingerprint")), "fingerprints")

    after = found.select(F.col("doc_id").alias("next_id"), F.col("sig").alias("next_sig"), F.col("fingerprint").alias("next_fingerprint"))
    met = links.join(found, "doc_id").join(after, "next_id")
    return met.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("sig"), F.col("edited_sig"), F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig"), F.col("fingerprint") == F.col("next_fingerprint")).alias("near_next"),
    )


def oracle_sql() -> str:
    """DuckDB SQL for the rows of the query over ``documents``."""
    terms = lambda c: f"list_distinct(list_filter(string_split_regex({c}, '[ \\t-\\r]+'), lambda w: w <> ''))"
    near = lambda a, b, fa, fb: (
        f"CASE WHEN {fa} = {fb} THEN 1.0::DOUBLE ELSE coalesce(len(list_filter(list_zip({a}, {b}), lambda p: p[1] <> '' AND p[1] = p[2]))::DOUBLE"
        f" / nullif(len(list_filter(list_zip({a}, {b}), lambda p: p[1] <> '' OR p[2] <> '')), 0), 0) END"
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT doc_id, text, length(text) AS n_chars, length(text) // 3 AS taken,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id
  FROM d),
e AS (
  SELECT l.doc_id, l.n_chars, l.next_id, l.text, substring(l.text, 1, l.n_chars - l.taken) || substring(n.text, 1, l.taken) AS edited
  FROM l JOIN d n ON n.doc_id = l.next_id),
df AS (SELECT term, count(*) AS df FROM (SELECT unnest({terms("text")}) AS term FROM d) GROUP BY term),
lex AS (
  SELECT term, ('0x' || substring(md5(term), 1, 1))::BIGINT AS b, length(bin(('0x' || substring(md5(term), 2, 14))::BIGINT)) AS level,
    ('0x' || substring(md5(term), 3, 13))::BIGINT AS own
  FROM df, (SELECT count(*) AS n FROM d)
  WHERE df <= greatest(1.0, n / {2 ** BAND[0]}.0) AND df >= n / {2 ** BAND[1]}.0),
t AS (
  SELECT doc_id, false AS e, unnest({terms("text")}) AS term FROM e
  UNION ALL SELECT doc_id, true, unnest({terms("edited")}) FROM e),
m AS (SELECT doc_id, e, b, level, ((b * 64 + level) << {_OWN}) + own AS code, min(level) OVER (PARTITION BY doc_id, e, b) AS least FROM t JOIN lex USING (term)),
h AS (SELECT doc_id, e, b, substring(md5(string_agg(code::VARCHAR, ',' ORDER BY code)), 1, 16) AS h FROM m WHERE level = least GROUP BY doc_id, e, b),
s AS (
  SELECT k.doc_id, k.e, list(coalesce(h.h, '') ORDER BY k.b) AS sig, bool_or(h.h IS NOT NULL) AS some
  FROM (SELECT doc_id, e, b FROM d, (VALUES (false), (true)) v(e), range({SUBSETS}) r(b)) k
  LEFT JOIN h ON h.doc_id = k.doc_id AND h.e = k.e AND h.b = k.b GROUP BY k.doc_id, k.e),
f AS (
  SELECT doc_id, s.e, s.sig, CASE WHEN s.some THEN array_to_string(s.sig, '-') ELSE sha256(CASE WHEN s.e THEN e.edited ELSE e.text END) END AS fp
  FROM s JOIN e USING (doc_id))
SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
  {near("a.sig", "b.sig", "a.fp", "b.fp")} AS near_edited, {near("a.sig", "n.sig", "a.fp", "n.fp")} AS near_next
FROM e JOIN f a ON a.doc_id = e.doc_id AND NOT a.e JOIN f b ON b.doc_id = e.doc_id AND b.e JOIN f n ON n.doc_id = e.next_id AND NOT n.e
"""
