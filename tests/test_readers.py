"""Readers of landed payloads: recurrence rules, calendars, JSON-LD walks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleanery.functions import recurrence
from gleanery.operators import listings
from gleanery.sources import calendars, jsonld, landed

A, Z = "2026-01-06", "2026-03-31"


def _day(text):
    return F.lit(text).cast("date")


def _dates(spark, start, rule, first=A, last=Z, gone=()):
    df = spark.createDataFrame([(dt.date.fromisoformat(start), rule, [dt.date.fromisoformat(g) for g in gone])], "s date, r string, x array<date>")
    return sorted(str(r.day) for r in recurrence.expand(df, "s", "r", "x", _day(first), _day(last)).collect())


@pytest.mark.parametrize(
    ("start", "rule", "want"),
    [
        ("2026-01-05", "FREQ=WEEKLY;BYDAY=MO,WE;COUNT=4", ["2026-01-07", "2026-01-12", "2026-01-14"]),
        ("2026-01-31", "FREQ=MONTHLY", ["2026-01-31", "2026-03-31"]),
        ("2026-01-31", "FREQ=MONTHLY;COUNT=2", ["2026-01-31", "2026-03-31"]),
        ("2026-01-01", "FREQ=DAILY;INTERVAL=3;UNTIL=20260108T235959Z", ["2026-01-07"]),
        ("2020-02-29", "FREQ=YEARLY;COUNT=3", []),
        ("2024-02-29", "FREQ=YEARLY", []),
        ("1990-01-01", "FREQ=WEEKLY;INTERVAL=4", ["2026-01-12", "2026-02-09", "2026-03-09"]),
        ("2025-11-11", "FREQ=MONTHLY;BYDAY=2TU", ["2026-01-13", "2026-02-10", "2026-03-10"]),
        ("2025-11-28", "freq=monthly;byday=-1fr", ["2026-01-30", "2026-02-27", "2026-03-27"]),
        ("2025-01-01", "FREQ=MONTHLY;BYDAY=5SU", ["2026-03-29"]),
        ("2020-03-01", "FREQ=YEARLY;BYMONTH=3;BYDAY=1SU", ["2026-03-01"]),
        ("2020-01-01", "FREQ=YEARLY;BYDAY=10MO", ["2026-03-09"]),
        ("2026-01-08", None, ["2026-01-08"]),
        ("2026-01-08", "FREQ=HOURLY", ["2026-01-08"]),
        ("2026-01-08", "FREQ=WEEKLY;INTERVAL=x;COUNT=2", ["2026-01-08", "2026-01-15"]),
        ("2027-01-08", "FREQ=DAILY", []),
    ],
)
def test_rules(spark, start, rule, want):
    assert _dates(spark, start, rule) == want


def test_left_out_dates_count(spark):
    assert _dates(spark, "2026-01-05", "FREQ=WEEKLY;COUNT=4", gone=["2026-01-12", "2026-01-13"]) == ["2026-01-19", "2026-01-26"]


def test_leap_days_reach_their_count(spark):
    assert _dates(spark, "2096-02-29", "FREQ=YEARLY;COUNT=2", "2096-01-01", "2110-01-01") == ["2096-02-29", "2104-02-29"]


CALENDAR = """BEGIN:VCALENDAR
BEGIN:VEVENT
UID:7
SUMMARY:Long
  name\\, too
DTSTART;VALUE=DATE:20260110
DTEND;VALUE=DATE:20260112
RRULE:FREQ=WEEKLY;INTERVAL=2;COUNT=3
EXDATE;VALUE=DATE:20260124
END:VEVENT
BEGIN:VEVENT
UID:8
SUMMARY:Late\\nshow
DTSTART:20260310T020000Z
DTEND:20260310T040000Z
LOCATION:Gull Loft\\, 4 Elm St
END:VEVENT
BEGIN:VEVENT
SUMMARY:Away match
DTSTART;TZID=Nowhere/Land:20260115T190000
DTEND;TZID=Nowhere/Land:20260121T190000
LOCATION:Elsewhere
END:VEVENT
BEGIN:VEVENT
UID:9
DTSTART:20260115T190000
END:VEVENT
END:VCALENDAR
"""


def test_calendar(spark):
    pages = spark.createDataFrame([("a", CALENDAR.replace("\n", "\r\n")), ("b", "not a calendar"), ("c", None)], "source string, body string")
    got = {r.external_id: r for r in calendars.ics(pages, "body", "source", _day(A), _day(Z)).collect()}
    assert got.keys() == {"7:2026-01-10", "7:2026-02-07", "8:2026-03-09", "Away match:2026-01-15"}
    whole, late = got["7:2026-02-07"], got["8:2026-03-09"]
    assert whole.title == "Long name, too" and whole.all_day and str(whole.ends) == "2026-02-08 23:59:59"
    assert (str(late.starts), str(late.ends), late.title, late.venue_name) == ("2026-03-09 21:00:00", "2026-03-09 23:00:00", "Late show", "Gull Loft, 4 Elm St")
    few = calendars.ics(pages, "body", "source", _day(A), _day(Z), title_includes=("LATE", "away"), location_includes=("loft", "else"), title_replace={"show": "Show"}, max_days=5)
    assert [r.title for r in few.collect()] == ["Late Show"]


def test_county(spark):
    body = '{"data":[{"title":"CAMP","start_date":"2026-01-05","end_date":"2026-01-26","recurring_type":"Week","start_time":"6:00 PM","end_time":"12:00 AM","slug":"camp"},{"title":"Long","start_date":"2026-01-05","end_date":"2026-02-26"},{"title":"Off","start_date":"2026-01-09","postponed":"1"},{"title":"Bad","start_date":"soon"},{"title":"Day","start_date":"2026-02-02","end_date":"0000-00-00","cancelled":"1"}]}'
    got = {r.external_id: r for r in calendars.county(spark.createDataFrame([(body,)], "b string"), "b", _day(A), _day(Z), "https://x.example").collect()}
    assert got.keys() == {"camp:2026-01-12", "camp:2026-01-19", "camp:2026-01-26", "Day:2026-02-02"}
    assert got["camp:2026-01-12"].title == "Camp" and got["camp:2026-01-12"].ends is None and got["camp:2026-01-12"].info_url == "https://x.example/camp"
    assert got["Day:2026-02-02"].cancelled and got["Day:2026-02-02"].all_day and str(got["Day:2026-02-02"].ends) == "2026-02-02 23:59:59"


NESTED = """<script type="application/ld+json">{"@graph":[{"@type":"Organization"},{"@type":["Thing","Festival Event"],"name":"Fest","startDate":"2026-01-10",
 "subEvent":[{"@type":"MusicEvent","name":"Night &amp; Day","startDate":"2026-01-11T20:00:00-06:00","url":"/n","location":[{"name":"Loft","address":{"streetAddress":"4 Elm St","addressLocality":"Harrow"}}],"offers":[{"price":0,"url":"/t"}],"organizer":"Me","image":[{"url":"/i.png"}],
   "subEvent":{"@type":"TalkEvent","name":"Talk","startDate":"2026-01-11T18:00:00","location":"Annex","offers":{"price":"7.50"}}}]}]}</script>
<script type='application/ld+json'>{"itemListElement":[{"@type":"Event","name":"One","startDate":"2026-01-12","url":"/same"},{"@type":"Event","name":"Two","startDate":"2026-01-12","url":"/same"}]}</script>
<script type="application/ld+json">{broken</script><script type="application/ld+json">[[{"@type":"Event","name":"Ctl\tchar","startDate":"2026-01-13"}]]</script>"""


def test_nested_events(spark):
    pages = spark.createDataFrame([("s", 1, "/p1", NESTED), ("s", 2, "/p2", NESTED), ("s", 3, "/p3", None)], "source string, page int, url string, html string")
    got = {r.external_id: r for r in jsonld.events(pages, "html", "source", "page", "url", _day(A), _day(Z)).collect()}
    # What has no url of its own is the page's; lists are walked from their end, so that the last of an id stays.
    own = {f"{p}:2026-01-{d}" for p in ("/p1", "/p2") for d in (10, 11, 13)}
    assert got.keys() == own | {"/n:2026-01-11", "/same:2026-01-12"}
    night, talk = got["/n:2026-01-11"], got["/p1:2026-01-11"]
    assert (night.title, night.venue_name, night.address, night.city, night.price, night.ticket_url, night.organizer, night.image_url) == ("Night & Day", "Loft", "4 Elm St, Harrow", "Harrow", "Free", "/t", "Me", "/i.png")
    assert str(night.starts) == "2026-01-11 20:00:00" and not night.all_day and got["/p1:2026-01-10"].all_day
    assert (talk.venue_name, talk.price) == ("Annex", "$7.50") and got["/same:2026-01-12"].title == "Two" and got["/p1:2026-01-13"].title == "Ctl char"


def test_walk_stops_at_its_depth(spark):
    doc = '{"@type":"Event"}'
    for _ in range(6):
        doc = f'{{"@type":"AEvent","subEvent":[{doc}]}}'
    df = spark.createDataFrame([(doc,)], "d string").select(F.try_parse_json("d").alias("v"))
    n = lambda depth: df.select(F.size(F.filter(jsonld.nodes(F.col("v"), depth), lambda s: jsonld.is_event(s["v"])))).first()[0]
    assert [n(0), n(2), n(8), n(12)] == [1, 2, 5, 7]


def test_ends_keep_the_offset_of_their_start(spark):
    """Clocks go forward on 2026-03-08 and back on 2026-11-01 in Chicago."""
    at = lambda text: dt.datetime.fromisoformat(text)
    rows = [("1", at("2026-03-08 01:00"), False, None, "America/Chicago"), ("2", at("2026-03-08 01:00"), True, None, "America/Chicago"), ("3", at("2026-11-01 00:30"), False, None, "Nowhere/Land"), ("4", at("2026-11-01 00:30"), True, None, "America/Chicago"), ("5", at("2026-11-01 00:30"), False, at("2026-11-01 00:10"), "America/Chicago"), ("6", at("2026-07-01 08:00"), False, at("2026-07-01 07:00"), None)]
    raw = spark.createDataFrame(rows, "external_id string, starts timestamp, all_day boolean, ends timestamp, zone string")
    none = {c: F.lit("") for c in ("venue_name", "address", "city", "description", "price", "info_url")}
    raw = raw.withColumns({**none, "source": F.lit("s"), "title": F.lit("T"), "time_tba": F.lit(False), "regions": F.array().cast("array<string>"), "cancelled": F.lit(None).cast("boolean")})
    source = spark.createDataFrame([("s", "B", False, ["home"], "hall")], "source string, tier string, curated boolean, source_regions array<string>, default_slug string")
    resolved = spark.createDataFrame([], "source string, external_id string, slug string, place_city string, place_regions array<string>")
    got = {r.external_id: (str(r.start)[5:16], str(r.end)[5:19], r.zone) for r in listings.normalize(raw, source, resolved, []).collect()}
    chicago = "America/Chicago"
    assert got["1"] == ("03-08 07:00", "03-08 10:00:00", chicago) and got["2"] == ("03-08 07:00", "03-09 05:59:59", chicago)
    assert got["3"] == ("11-01 05:30", "11-01 08:30:00", chicago) and got["4"] == ("11-01 05:30", "11-02 04:59:59", chicago)
    assert got["5"][1] == "11-01 08:30:00" and got["6"] == ("07-01 13:00", "07-01 16:00:00", chicago)


def test_links_lead_to_an_origin(spark):
    cases = [("1", "hall.example/a", None, "/x", "B"), ("2", None, "https://www.hall.example/t", "/x", "B"), ("3", None, None, "https://hall.example/i", "B"), ("4", None, None, "https://hall.example/i", "A"), ("5", "//other.example", None, None, "B")]
    raw = spark.createDataFrame([("s", *c) for c in cases], "source string, external_id string, website string, ticket_url string, info_url string, tier string")
    origins = spark.createDataFrame([("hall.example", "hall", "Town", ["r"])], "domain string, origin_slug string, origin_city string, origin_regions array<string>")
    got = {r.external_id: (r.origin_url, r.origin_tier, r.origin_slug) for r in listings.with_origins(raw, origins).collect()}
    assert got == {"1": ("https://hall.example/a", "A", "hall"), "2": ("https://www.hall.example/t", "A", "hall"), "3": ("https://hall.example/i", "A", "hall"), "4": ("", None, None), "5": ("", None, None)}


def test_landed_files(spark, tmp_path):
    """Files whole with their path, lines that fit no schema, XML elements, pictures by their first bytes, refused payloads."""
    def put(name, data):
        at = tmp_path / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)

    put("json/source=a/1.json", b'{"x": 1}\n')
    put("json/source=b/2.json", b"{broken")
    bodies = landed.texts(spark, str(tmp_path / "json"), "*.json")
    assert {(r.source, r.path.rsplit("/", 1)[1]) for r in bodies.collect()} == {("a", "1.json"), ("b", "2.json")}
    assert [(r.path.rsplit("/", 1)[1], r.reason) for r in landed.refused(bodies, landed.not_json(F.col("body"))).collect()] == [("2.json", "no JSON")]
    put("csv/rows.csv", b"title,n\nok,1\nbad,x\n")
    good, bad = landed.csv_rows(spark, str(tmp_path / "csv"), "title string, n int")
    assert [(r.title, r.n) for r in good.collect()] == [("ok", 1)] and [r.reason for r in bad.collect()] == ["bad line: bad,x"]
    put("xml/feed.xml", b"<rss><item><title>A</title></item><item><title>B</title></item></rss>")
    elements, none = landed.xml_rows(spark, str(tmp_path / "xml"), "item", "title string")
    assert sorted(r.title for r in elements.collect()) == ["A", "B"] and none.isEmpty()
    put("img/a.png", b"\x89PNG\r\n\x1a\n0000")
    put("img/b.bin", b"nothing")
    assert {r.path.rsplit("/", 1)[1]: r.kind for r in landed.images(spark, str(tmp_path / "img")).collect()} == {"a.png": "png", "b.bin": "other"}


def test_listed_calendars_and_cards(spark):
    listing = "<a href='/x/Details/b'> <a href=\"/x/Details/a?q\"> <a href='/x/Details/b'> <a href='/x/Details/skip-it'> <a href='/x/Details/c'> <a href='/x/Details/d'>"
    event = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:u\r\nSUMMARY:{0}\r\nDTSTART:20260110T190000\r\nLOCATION:{1}\r\nEND:VEVENT\r\nEND:VCALENDAR"
    listings = spark.createDataFrame([("s", "/x", listing)], "source string, base string, body string")
    details = spark.createDataFrame([("s", "a", "p/a", event.format("A", "12 Elm")), ("s", "b", "p/b", event.format("B", "Loft")), ("s", "c", "p/c", event.format("C", "")[:60])], "source string, slug string, path string, body string")
    got, bad = landed.listed_calendars(listings, details, _day(A), _day(Z), skip=("skip it",), most=4)
    assert {(r.external_id, r.venue_name, r.address, r.info_url) for r in got.collect()} == {("a:2026-01-10", "", "12 Elm", "/x/Details/a"), ("b:2026-01-10", "Loft", "Loft", "/x/Details/b")}
    assert {(r.path, r.reason) for r in bad.collect()} == {("p/c", "no whole calendar"), ("s/d", "not landed")}
    few, _ = landed.listed_calendars(listings, details, _day(A), _day(Z), most=1)
    assert [r.title for r in few.collect()] == ["B"]


def test_object_values_are_read_once(spark):
    """The walk goes to many tasks whatever the pages' bytes, and dates and titles are read once each, not again for every filter on them."""
    pages = spark.createDataFrame([("s", 1, "/p", '<script type="application/ld+json">{"@type":"Event","name":"<b>A</b>","startDate":"2026-02-01","endDate":"2026-02-02"}</script>')], "source string, page int, url string, html string")
    found = jsonld.events(pages, "html", "source", "page", "url", _day(A), _day(Z), max_days=4)
    assert [(r.title, r.external_id) for r in found.collect()] == [("A", "/p:2026-02-01")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.endDate") == 1 and plan.count("$.startDate") == 2 and "RepartitionByExpression" in plan
