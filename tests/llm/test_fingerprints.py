"""I-Match fingerprints: the query's SQL, nested subsets by hand, edge cases, how well they tell edits from other texts."""

import hashlib
import math

import duckdb
from pyspark.sql import functions as F

from gleanery.llm import fingerprints, queries

DATA = "/root/testdata/sf0.01"


def _code(term):
    d = hashlib.md5(term.encode()).hexdigest()
    return ((int(d[0], 16) * 64 + len(f"{int(d[1:15], 16):b}")) << 52) + int(d[2:15], 16)


def _signature(terms):
    out = []
    for b in range(16):
        own = sorted(c for c in map(_code, terms) if c >> 58 == b)
        low = [c for c in own if c >> 52 == own[0] >> 52]
        out.append(hashlib.md5(",".join(map(str, low)).encode()).hexdigest()[:16] if low else "")
    return out


def test_signature_by_hand(spark):
    texts = ["", "a", " ".join(f"w{i}" for i in range(300)), "b c d b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    codes = F.sort_array(F.transform(fingerprints.distinct_terms(F.col("text")), fingerprints.term_code))
    for r in df.select("text", codes.alias("codes")).select("text", fingerprints.signature(F.col("codes")).alias("sig")).collect():
        assert r.sig == _signature(set(r.text.split())), r.text


def test_edges(spark, odd_docs, no_docs):
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(odd_docs).collect()}
    texts: dict = {}
    for r in odd_docs.where("doc_id IS NOT NULL").collect():
        texts[r.doc_id] = min(texts.get(r.doc_id, r.text or ""), r.text or "")
    assert got.keys() == texts.keys()
    order = sorted(texts, reverse=True)
    for d, after in zip(order, [*order[1:], order[0]]):
        t, n = texts[d], len(texts[d]) // 3
        edited = t[: len(t) - n] + texts[after][:n]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[d].near_next == 1.0) == (got[d].fingerprint == got[after].fingerprint)
    assert got[7].fingerprint == got[8].fingerprint and got[1].fingerprint == got[2].fingerprint
    assert got[1].near_edited == 1.0 and all(0 <= x <= 1 for r in got.values() for x in (r.near_edited, r.near_next))
    assert fingerprints.fingerprint_documents(no_docs).count() == 0
    one = fingerprints.fingerprint_documents(odd_docs.where("doc_id = 5")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"one two tone ").hexdigest()


def test_order_over_many_ranges(spark):
    ids = spark.range(1, 1000).selectExpr("id * id % 7919 AS doc_id", "1L AS n_chars").distinct()
    got = {r.doc_id: r.next_id for r in fingerprints.next_in_order(ids, 10**7).collect()}
    order = sorted(got, reverse=True)
    assert [got[d] for d in order] == [*order[1:], order[0]]


def test_query_sql_and_separation(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.sql(fingerprints.oracle_sql())
    rows = queries.op12_imatch_fingerprints(spark, DATA).collect()
    plain = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(plain(r[c] for c in want.columns) for r in rows) == sorted(map(plain, want.fetchall()))
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.9 * len(rows)
    assert math.fsum(r.near_next for r in rows) <= 0.02 * len(rows) <= 0.3 * len(rows) <= math.fsum(r.near_edited for r in rows)
