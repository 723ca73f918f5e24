"""Fuzzy names and aliases inside addresses against brute force, beyond the size at which a table used to be cut by tokens."""

import numpy as np

from gleanery.functions.similarity import _lcs
from gleanery.operators import venues

NAMES = "id long, key string, address_key string, domain string, city string"
ALIASES = "alias string, ordinal long, slug string, venue_city string"


def _ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 200 * _lcs(a, b) / (len(a) + len(b))


def test_one_word_names_match_many_aliases(spark):
    aliases = [("greenhouse", 1, "green", ""), ("old town hall", 2, "hall", "")] + [(f"{i:x}", 10 + i, f"v{i}", "") for i in range(20_001)]
    names = [(1, "greenhouses", "", "", ""), (2, "olde towne halls", "", "", ""), (3, "", "12 main old town hall", "", "")]
    got = venues.resolve(spark.createDataFrame(names, NAMES), spark.createDataFrame(aliases, ALIASES), spark.createDataFrame([], "domain string, slug string"))
    found = {r.id: (r.slug, r.via) for r in got.collect()}
    assert found[1] == ("green", "fuzzy") and found[3] == ("hall", "address")
    assert (2 in found) == (_ratio("olde towne halls", "old town hall") >= 90)


def test_pairs_lose_nothing(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abc"), rng.integers(1, 7)))
    aliases = sorted({" ".join(word() for _ in range(rng.integers(1, 5))) for _ in range(80)})
    keys = set()
    for a in aliases:
        for _ in range(3):
            chars = list(a)
            for _ in range(rng.integers(0, 4)):
                at = int(rng.integers(0, len(chars) + 1))
                chars[at : at + int(rng.integers(0, 2))] = rng.choice(list("abcd"), rng.integers(0, 2)).tolist()
            keys.add("".join(chars))
    keys = sorted(k for k in keys if k.strip())
    for threshold in (70, 90, 100):
        pairs = venues._fuzzy_pairs(spark.createDataFrame([(k,) for k in keys], "key string"), spark.createDataFrame([(a,) for a in aliases], "alias string"), threshold)
        got = {(r.key, r.alias) for r in pairs.collect()}
        assert {(k, a) for k in keys for a in aliases if _ratio(k, a) >= threshold} <= got


def test_every_part_gives_an_alias(spark):
    from gleanery.plans import QUERIES

    slugs = {r.slug for r in QUERIES["venue_resolve"](spark, "/root/testdata/sf0.001").collect()}
    assert any(int(s[1:]) % 2 for s in slugs if s != "v-site")


def test_city_pick_without_pairs(spark):
    """The same picks as from all pairs, and 400 million pairs never made."""
    cities = ["", None, "North", "north", "South", "Far"]
    names = spark.createDataFrame([(i, i % 4, cities[i * 5 % 6]) for i in range(60)], "id int, place int, city string")
    known = spark.createDataFrame([(i % 5, cities[i * 7 % 5], 100 - i, f"v{i}") for i in range(23)], "place int, venue_city string, ordinal int, slug string")
    want = {(r.id, r.slug) for r in venues.pick_by_city(names.join(known, "place"), ["id"]).collect()}
    assert {(r.id, r.slug) for r in venues.pick_among(names, known, ["place"]).collect()} == want
    assert len(want) < 60  # some find none
    one = spark.range(20_000).selectExpr("id", "0 AS place", "if(id % 2 = 0, '', 'near') AS city")
    many = spark.range(20_000).selectExpr("0 AS place", "if(id = 7, 'Near', 'far') AS venue_city", "id + 1 AS ordinal")
    got = venues.pick_among(one, many, ["place"])
    assert {(r.city, r.ordinal): r["count"] for r in got.groupBy("city", "ordinal").count().collect()} == {("", 1): 10_000, ("near", 8): 10_000}
