"""Literal cases of text, date and matching functions, and properties of the matcher."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleanery.functions import dates as D
from gleanery.functions import similarity as S
from gleanery.functions import text as T
from gleanery.operators import match, venues


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'int'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (T.flatten, " a  b\n c ", "a b c"),
        (T.norm_key, "Café “Olé” & Søn’s", "cafe ole and sn s"),
        (T.title_key, "The <b>Jazz</b> Night 2026 presents", "jazz"),
        (T.slugify, "Été!", "ete"),
        (T.slugify, "", "event"),
        (T.domain_of, "https://www.Example.com:80/x?y", "example.com"),
        (T.strip_html, "<h2>Hi</h2><p>a&amp;amp;b</p><ul><li>x<li>y</ul>[tag a=1]", "## Hi\n\na&b\n\n- x\n- y"),
        (T.tame_caps, "LIVE BBQ AT THE 10TH PIER: THE END", "Live BBQ at the 10th Pier: The End"),
        (T.tame_caps, "Mixed Case stays", "Mixed Case stays"),
        (T.null_text, "0000-00-00", ""),
        (T.first_sentence, "At St. Mary Hall. Then more.", "At St. Mary Hall."),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f(F.col("s")), s=given) == want


def test_excerpt_and_prices(spark):
    assert one(spark, T.excerpt(F.col("s"), 12), s="alpha beta gamma") == "alpha beta…"
    assert one(spark, T.is_free_price(F.col("s")), s=" Free entry ") and not one(spark, T.is_free_price(F.col("s")), s="$5")
    assert one(spark, T.is_free_price(F.col("s")), s=None) is False


@pytest.mark.parametrize(("a", "b", "want"), [("beethoven 9", "beethoven s ninth", 90.0), ("jazz night at the wharf", "jazz brunch at the wharf", 85.1), ("a b", "b a c", 100.0), ("", "x", 0.0)])
def test_set_ratio(spark, a, b, want):
    assert abs(one(spark, S.token_set_ratio(F.col("a"), F.col("b")), a=a, b=b) - want) < 0.05
    assert one(spark, S.token_set_ratio(F.col("a"), F.col("b")), a=b, b=a) == one(spark, S.token_set_ratio(F.col("a"), F.col("b")), a=a, b=b)


def test_sort_ratio(spark):
    assert abs(one(spark, S.token_sort_ratio(F.col("a"), F.col("b")), a="center tabard", b="tabard centre") - 92.3) < 0.05


def test_time_ranges(spark):
    day = F.lit("2026-09-15").cast("date")
    at = lambda s: one(spark, D.parse_time_range(F.col("s"), day), s=s)
    assert (at("4:00 PM - 5:00 PM").start.hour, at("4:00 PM - 5:00 PM").end.hour) == (16, 17)
    assert (at("7 - 9pm").start.hour, at("7 - 9pm").end.hour) == (19, 21)
    assert at("10 pm to 1 am").end == dt.datetime(2026, 9, 16, 1) and at("6:30 p.m.").start.minute == 30 and at("soon").start is None


def test_zones_and_labels(spark):
    wall = F.lit("2026-03-08 02:30:00").cast("timestamp")
    assert one(spark, D.iso_utc(D.to_utc(wall)), s="") == "2026-03-08T08:30:00Z"
    assert one(spark, D.days_label(F.array(*map(F.lit, (0, 1, 2, 3, 4)))), s="") == "Mon–Fri"
    assert one(spark, D.days_label(F.array(*map(F.lit, (4, 0, 2)))), s="") == "Mon, Wed, Fri"
    assert one(spark, D.days_label(F.array(*map(F.lit, range(7)))), s="") == "Daily"
    assert one(spark, D.time_label(F.lit("16:00"), F.lit("18:00")), s="") == "4–6 pm"
    assert one(spark, D.time_label(F.lit("11:30"), F.lit("14:00")), s="") == "11:30 am–2 pm"
    assert one(spark, D.time_label(F.lit("21:00"), F.lit("close")), s="") == "9 pm–close"


def _records(spark, rows):
    return spark.createDataFrame(rows, "id long, bucket string, text string, rank int")


M = match.MatchSchema(text="text", bucket="bucket", rank="rank", id="id")


def test_cluster_is_stable_and_greedy(spark):
    rows = [(i, "b", f"jazz night part {i % 4} of the year {i % 3}", i % 5) for i in range(40)]
    frame = _records(spark, rows)
    first = sorted(map(tuple, match.cluster(frame, M).collect()))
    assert first == sorted(map(tuple, match.cluster(frame.repartition(7), M).collect()))


def test_leader_match_and_merge(spark):
    old = _records(spark, [(1, "b", "summer jazz concert", 0)])
    new = _records(spark, [(2, "b", "summer jazz concert series", 1), (3, "b", "pottery class", 2), (4, "b", "pottery class", 3), (5, "c", "alone", 0)])
    got = {r.id: (r.decision, r.leader) for r in match.leader_match(old, new, M).collect()}
    assert got == {2: ("match", 1), 3: ("new", 3), 4: ("match", 3), 5: ("new", 5)}
    once = match.merge(old.unionByName(new).withColumn("e", F.lit(1)), "e", M, ["text"])
    assert once.first().text == "summer jazz concert"


def test_venues(spark):
    names = spark.createDataFrame([(1, "city hall", "", "", ""), (2, "city hall", "", "", "north"), (3, "lyceum theater", "", "", ""), (4, "", "9 front st big arena", "", ""), (5, "", "", "x.org", ""), (6, "city hall", "", "x.org", "elsewhere")], "id long, key string, address_key string, domain string, city string")
    aliases = spark.createDataFrame([("city hall", 0, "south-hall", "south"), ("city hall", 1, "north-hall", "north"), ("lyceum theatre", 2, "lyceum", ""), ("big arena", 3, "arena", "")], "alias string, ordinal int, slug string, venue_city string")
    domains = spark.createDataFrame([("x.org", "x")], "domain string, slug string")
    got = {r.id: (r.slug, r.via) for r in venues.resolve(names, aliases, domains).collect()}
    assert got == {1: ("south-hall", "name"), 2: ("north-hall", "name"), 3: ("lyceum", "fuzzy"), 4: ("arena", "address"), 5: ("x", "domain")}
