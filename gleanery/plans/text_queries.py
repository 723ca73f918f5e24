"""Scalar text and JSON functions over documents, pages, parts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import jsonld
from .registry import query

_KEY = r"trim(regexp_replace(regexp_replace(replace(lower(regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"
_FLAT = r"regexp_replace(regexp_replace({0}, '\s+', ' ', 'g'), '^ | $', '', 'g')"


@query(rf"SELECT doc_id, {_FLAT.format('text')} AS flat FROM documents")
def flatten(t):
    return t.documents.select("doc_id", T.flatten(F.col("text")).alias("flat"))


@query(f"SELECT doc_id, {_KEY.format('text')} AS key FROM documents")
def norm_key(t):
    return t.documents.select("doc_id", T.norm_key(F.col("text")).alias("key"))


@query(r"SELECT p_partkey, trim(regexp_replace(regexp_replace(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), '\b(presents?|featuring|feat|ft|live|tour|the|a|an|and|at|in|on|of|tickets?|show|event|night|free|\d{4})\b', ' ', 'g'), ' +', ' ', 'g')) AS title_key FROM part")
def title_key(t):
    return t.part.select("p_partkey", T.title_key(F.col("p_name")).alias("title_key"))


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(p_name, '\s+', ' ', 'g'), '^[ \-–—|:]+|[ \-–—|:]+$', '', 'g') AS title FROM part")
def clean_title(t):
    return t.part.select("p_partkey", T.clean_title(F.col("p_name")).alias("title"))


@query(r"""SELECT doc_id, CASE WHEN s = '' THEN 'event' WHEN length(s) > 70 THEN regexp_replace(s[1:70], '-[^-]*$', '') ELSE s END AS slug FROM (
  SELECT doc_id, regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM documents)""")
def slugify(t):
    return t.documents.select("doc_id", T.slugify(F.col("text")).alias("slug"))


@query()
def excerpt(t):
    return t.documents.select("doc_id", T.excerpt(F.col("text")).alias("excerpt"))


@query()
def strip_html(t):
    return t.pages.select("page_id", T.strip_html(F.col("html")).alias("text"))


@query(r"SELECT page_id, lower(regexp_extract(trim(url), '^(?:https?://)?(?:www\.)?([^/:?#]+)', 1, 'i')) AS domain FROM pages")
def domain_of(t):
    return t.pages.select("page_id", T.domain_of(F.col("url")).alias("domain"))


@query("SELECT l_orderkey, l_linenumber, (l_discount = 0) AS free FROM lineitem")
def is_free_price(t):
    price = F.when(F.col("l_discount") == 0, F.lit(" Free ")).otherwise(F.concat(F.lit("$"), F.col("l_extendedprice").cast("string")))
    return t.lineitem.select("l_orderkey", "l_linenumber", T.is_free_price(price).alias("free"))


@query()
def tame_caps(t):
    return t.part.select("p_partkey", T.tame_caps(F.upper("p_name")).alias("title"))


@query(r"SELECT doc_id, trim(regexp_replace(replace(replace(replace(lower(text), '''', ''), '’', ''), '\"', ''), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents".replace('\\"', '"'))
def search_norm(t):
    return t.documents.select("doc_id", T.search_norm(F.col("text")).alias("norm"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderpriority END AS value FROM orders")
def null_text(t):
    raw = F.when(F.col("o_orderstatus") == "O", F.lit("null")).otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", T.null_text(raw).alias("value"))


@query("SELECT p_partkey, substr(sha1(p_name || '|' || p_brand || '|' || p_type), 1, 12) AS key FROM part")
def sha1_key(t):
    return t.part.select("p_partkey", T.sha1_key(12, F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("key"))


RULES = [("music", ["red", "blue"]), ("food", ["small", "large"]), ("arts", ["steel", "brass", "copper"])]


def _matches(column: str, words: list[str]) -> str:
    return f"regexp_matches(lower({column}), '(^|[^a-z0-9])({'|'.join(words)})([^a-z0-9]|$)')"


@query("SELECT p_partkey, CASE WHEN len(c) = 0 THEN ['community'] ELSE c[1:2] END AS categories FROM (SELECT p_partkey, list_distinct_ordered FROM (SELECT p_partkey, list_filter(["
       + ", ".join(f"CASE WHEN {_matches(x, w)} THEN '{k}' END" for x in ("p_type", "p_name") for k, w in RULES)
       + "], lambda x: x IS NOT NULL) AS l FROM part), LATERAL (SELECT list_filter(l, lambda x, i: list_position(l, x) = i) AS list_distinct_ordered)) AS s(p_partkey, c)")
def classify_all(t):
    return t.part.select("p_partkey", T.classify_all([F.col("p_type"), F.col("p_name")], RULES, "community").alias("categories"))


@query("SELECT p_partkey, (contains(lower(p_name), 'red') OR contains(lower(p_name), 'tin')) AS never FROM part")
def never_feature(t):
    return t.part.select("p_partkey", T.contains_any(F.col("p_name"), ["red", "tin"]).alias("never"))


@query(r"SELECT p_partkey, regexp_matches(lower(p_name || ' ' || p_type), '(^|[^a-z0-9])' || lower(split_part(p_name, ' ', 1)) || '([^a-z0-9]|$)') AS promoted FROM part")
def self_promoted(t):
    token = F.array(F.get(F.split("p_name", " "), 0))
    return t.part.select("p_partkey", T.self_promoted(token, F.col("p_name"), F.col("p_type")).alias("promoted"))


@query("SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: x <> '') AS parts FROM part")
def split_list(t):
    return t.part.select("p_partkey", T.split_list(F.concat(F.lit("["), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(", ]"))).alias("parts"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE o_orderstatus || ', ' || o_orderpriority END AS joined FROM orders")
def join_nonempty(t):
    return t.orders.select("o_orderkey", T.join_nonempty(", ", F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")), F.col("o_orderpriority")).alias("joined"))


@query("SELECT p_partkey, CASE WHEN length(p_name || ' at ' || p_brand || ', ' || p_type || ' | Parts') <= 40 THEN p_name || ' at ' || p_brand || ', ' || p_type || ' | Parts' WHEN length(p_name || ', ' || p_type || ' | Parts') <= 40 THEN p_name || ', ' || p_type || ' | Parts' WHEN length(p_name || ' | Parts') <= 40 THEN p_name || ' | Parts' WHEN length(p_name) <= 40 THEN p_name ELSE rtrim(p_name[1:39]) || '…' END AS title FROM part")
def fit_title(t):
    return t.part.select("p_partkey", T.fit_title(F.col("p_name"), F.col("p_brand"), F.col("p_type"), "Parts", 40).alias("title"))


@query("SELECT p_partkey, p_type || ' ' || p_name || ' at ' || p_brand || '.' AS description FROM part")
def meta_description(t):
    return t.part.select("p_partkey", T.meta_description(F.lit(""), F.col("p_type"), F.col("p_name"), F.col("p_brand")).alias("description"))


@query()
def first_sentence(t):
    return t.documents.select("doc_id", T.first_sentence(T.flatten(F.col("text"))).alias("head"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_decode(t):
    parsed = F.from_json("props", "struct<k:long>", {"mode": "PERMISSIVE"})
    return t.events.select("event_id", F.coalesce(parsed["k"], F.lit(None).cast("long")).alias("k"))


@query("SELECT event_id, '{\"type\":\"' || event_type || '\",\"user\":' || user_id || '}' AS payload FROM events")
def json_encode(t):
    return t.events.select("event_id", F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))).alias("payload"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_double_decode(t):
    twice = F.get_json_object(F.to_json(F.struct(F.col("props").alias("body"))), "$.body")
    return t.events.select("event_id", F.from_json(twice, "struct<k:long>")["k"].alias("k"))


@query("SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT) > 50, false) AS flag FROM events")
def json_flag(t):
    return t.events.select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("long") > 50, F.lit(False)).alias("flag"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def list_or_object(t):
    """A field that is a list on odd ids and an object on even ones: the first entry either way."""
    raw = F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("["), F.col("props"), F.lit("]"))).otherwise(F.col("props"))
    return t.events.select("event_id", T.first_of_list_or_object(raw, "k", "long").alias("k"))


@query("SELECT event_id, unnest(CASE WHEN event_id % 2 = 0 THEN [event_type, event_type || '2', event_type || '3'] ELSE [event_type || '3', event_type, event_type || '2'] END) AS kind, unnest([1, 2, 3]) AS place FROM events")
def json_walk(t):
    """Three event objects a document, three levels deep or side by side in lists, in the order of the walk."""
    node = lambda n, types, more: F.concat(F.lit(f'{{"@type":{types},"name":"'), F.col("event_type"), F.lit(f'{n}"{more}'))
    last = F.concat(node("3", '["Thing","TalkEvent"]', "}"))
    second = lambda more, end: F.concat(node("2", '"MusicEvent"', more), end)
    deep = F.concat(F.lit('{"@graph":[{"@type":"Place"},'), node("", '"Event"', ',"subEvent":['), second(',"itemListElement":[{"@type":"Place"},', last), F.lit("]}]}]}"))
    flat = F.concat(F.lit('{"@graph":['), node("", '"Event"', ',"subEvent":'), second("}", F.lit("}],")), F.lit('"itemListElement":[['), last, F.lit("]]}"))
    docs = t.events.select("event_id", F.try_parse_json(F.when(F.col("event_id") % 2 == 0, deep).otherwise(flat)).alias("doc"))
    found = F.filter(F.array_sort(F.transform(jsonld.nodes(F.col("doc")), lambda s: F.struct(s["path"].alias("path"), jsonld.part(s["v"], "$.name").alias("name"), jsonld.is_event(s["v"]).alias("ok")))), lambda s: s["ok"])
    return docs.select("event_id", F.posexplode(found).alias("i", "n")).select("event_id", F.col("n.name").alias("kind"), (F.col("i") + 1).cast("long").alias("place"))


@query("SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: x <> 'red')[1:2] AS words FROM part")
def array_first_k(t):
    return t.part.select("p_partkey", F.slice(F.filter(F.split("p_name", " "), lambda x: x != "red"), 1, 2).alias("words"))


@query("SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red')")
def array_contains(t):
    return t.part.where(F.array_contains(F.split("p_name", " "), "red")).select("p_partkey")


@query("SELECT p_partkey AS external_id, p_name AS title, p_brand AS venue_name FROM part")
def column_mapping(t):
    from ..sources import readers

    return readers.mapped(t.part, {"external_id": "p_partkey", "title": "p_name", "venue_name": "p_brand"})


def _pairs_at_100(t, scorer):
    """Pairs of parts of a brand and type whose names score 100; a null brand or type is equal to none."""
    from ..operators import match

    p = t.part.select("p_partkey", "p_name", F.lit(0).alias("rank"), F.concat(F.length("p_brand"), F.lit("|"), "p_brand", "p_type").alias("bucket"))
    m = match.MatchSchema(text="p_name", bucket="bucket", rank="rank", id="p_partkey", scorer=scorer)
    return match.match_pairs(p, m, 100).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))


@query("SELECT l.p_partkey AS a, r.p_partkey AS b FROM part l JOIN part r ON l.p_brand = r.p_brand AND l.p_type = r.p_type AND l.p_partkey < r.p_partkey AND (len(list_filter(string_split(l.p_name, ' '), lambda x: NOT list_contains(string_split(r.p_name, ' '), x))) = 0 OR len(list_filter(string_split(r.p_name, ' '), lambda x: NOT list_contains(string_split(l.p_name, ' '), x))) = 0)")
def token_set_ratio(t):
    """Pairs of equal brand and type at 100: one name's words hold the other's."""
    from ..functions.similarity import token_set_ratio as ratio

    return _pairs_at_100(t, ratio)


@query("SELECT l.p_partkey AS a, r.p_partkey AS b FROM part l JOIN part r ON l.p_brand = r.p_brand AND l.p_type = r.p_type AND l.p_partkey < r.p_partkey AND list_sort(string_split(l.p_name, ' ')) = list_sort(string_split(r.p_name, ' '))")
def token_sort_ratio(t):
    """Pairs of equal brand and type at 100: the same words, in whatever order."""
    from ..functions.similarity import token_sort_ratio as ratio

    return _pairs_at_100(t, ratio)
