"""Readers over payloads that Spark composes from the given tables, link extraction from pages, lookups and leftovers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators import listings as L
from ..operators import review, signals, tables, venues, views
from ..sources import archive, calendars, jsonld, landed, snapshots
from ..sources import readers as R
from .date_queries import RULE_DAYS, rule_of
from .registry import query


def _day():
    return F.to_date("o_orderdate")

stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
_AT = "strftime(o_orderdate::TIMESTAMP, '%Y-%m-%d %H:%M:%S')"


@query(f"SELECT o_orderkey || ':' || strftime(o_orderdate::TIMESTAMP, '%Y-%m-%d') AS external_id, o_orderpriority AS title, {_AT} AS starts, 'v' || o_custkey AS venue_name FROM orders")
def src_tribe(t):
    """A calendar page per customer; odd customers give their venue as a list."""
    venue = F.to_json(F.struct(F.concat(F.lit("v"), F.col("o_custkey")).alias("venue"), F.lit("1 Main").alias("address")))
    venue = F.when(F.col("o_custkey") % 2 == 1, F.concat(F.lit("["), venue, F.lit("]"))).otherwise(venue)
    e = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), stamp("o_orderdate").alias("start_date"), venue.alias("venue"))
    pages = t.orders.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(e).alias("events"))).alias("body"))
    return R.tribe(pages, "body").select("external_id", "title", stamp("starts").alias("starts"), "venue_name")


@query("SELECT 't' || o_orderkey AS external_id, o_orderkey % 3 = 0 AS time_tba, CASE WHEN o_orderkey % 2 = 0 THEN '$10' ELSE '$10-25' END AS price, o_orderstatus = 'F' AS cancelled FROM orders")
def src_ticketmaster(t):
    day = F.struct(F.lit(None).cast("string").alias("dateTime"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("localDate"), F.when(F.col("o_orderkey") % 3 != 0, "19:00:00").alias("localTime"))
    price = F.array(F.struct(F.lit(10.0).alias("min"), F.when(F.col("o_orderkey") % 2 == 0, 10.0).otherwise(25.0).alias("max")))
    body = F.to_json(F.struct(F.concat(F.lit("t"), F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_orderstatus") == "F", "Cancelled").otherwise("onsale").alias("status"), day.alias("start"), price.alias("prices")))
    sweeps = t.orders.select(body.alias("body")).withColumn("sweep", F.explode(F.array(F.lit(1), F.lit(2))))
    return R.tickets(sweeps, "body", "sweep").select("external_id", "time_tba", "price", "cancelled")


@query("SELECT o_orderkey || ':' || o_orderdate::DATE AS external_id, o_orderpriority AS title, strftime(o_orderdate::DATE + INTERVAL 19 HOUR, '%Y-%m-%d %H:%M:%S') AS starts FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
def src_civicplus(t):
    item = F.concat(F.lit("<item><title>"), F.col("o_orderpriority"), F.lit("</title><link>/cal?EID="), F.col("o_orderkey"), F.lit("</link><c:EventDates>"), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("</c:EventDates><c:EventTimes>07:00 PM - 09:00 PM</c:EventTimes></item>"))
    feeds = t.orders.groupBy("o_custkey").agg(F.concat(F.lit("<rss>"), F.array_join(F.collect_list(item), ""), F.lit("</rss>")).alias("body"))
    found = R.rss(feeds, "body", F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date"))
    return found.select("external_id", "title", stamp("starts").alias("starts"))


_ICS_TIMES = """CASE WHEN o_orderkey % 10 <> 0 AND o_orderkey % 3 = 0 THEN '00:00:00' ELSE strftime(o_orderdate::TIMESTAMP, '%H:%M:%S') END"""
_ICS_LOCAL = f"((o_orderdate::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE '{D.DEFAULT_ZONE}')"


@query(f"""
WITH {RULE_DAYS},
o AS (SELECT *, o_orderkey % 10 <> 0 AND o_orderkey % 3 = 0 AS whole, o_orderkey % 5 AS k FROM orders),
e AS (
  SELECT o_orderkey, day, o_orderpriority AS title, CASE WHEN whole THEN day::TIMESTAMP ELSE day + o_orderdate::TIME END AS starts
  FROM r JOIN o USING (o_orderkey) WHERE o_orderkey % 10 <> 0 AND NOT (o_orderkey % 10 = 9 AND day = s + 21)
  UNION ALL SELECT o_orderkey, {_ICS_LOCAL}::DATE, o_orderpriority, {_ICS_LOCAL} FROM o WHERE o_orderkey % 10 = 0
  UNION ALL SELECT o_orderkey, o_orderdate::DATE + 22, 'Moved ' || o_orderpriority, CASE WHEN whole THEN (o_orderdate::DATE + 22)::TIMESTAMP ELSE o_orderdate::TIMESTAMP + INTERVAL 22 DAY END FROM o WHERE o_orderkey % 10 = 9)
SELECT 'u' || o_orderkey || ':' || day AS external_id, replace(e.title, 'LOW', 'Low') AS title, strftime(starts, '%Y-%m-%d %H:%M:%S') AS starts,
  strftime(starts + CASE WHEN whole THEN to_days(CAST(k AS INT)) + INTERVAL '23:59:59' ELSE to_days(CAST(k AS INT)) + INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M:%S') AS ends, whole AS all_day, 'Hall ' || o_custkey || ', 1 Main' AS venue_name
FROM e JOIN o USING (o_orderkey)
WHERE day BETWEEN DATE '1999-01-01' AND DATE '1999-03-31' AND regexp_matches(lower(e.title), 'medium|low') AND o_custkey % 4 <> 0 AND k <= 3
""")
def src_ics(t):
    """A calendar per customer with rules of every kind, days left out and moved, whole days, UTC times, folded lines."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    whole, zulu = (key % 10 != 0) & (key % 3 == 0), key % 10 == 0
    k = (key % 5).cast("int")

    def lines(start, end, title, more):
        stamp = lambda name, c, d: F.when(whole, F.concat(F.lit(f"{name};VALUE=DATE:"), F.date_format(d, "yyyyMMdd"))).when(zulu, F.concat(F.lit(f"{name}:"), F.date_format(c, "yyyyMMdd'T'HHmmss'Z'"))).otherwise(F.concat(F.lit(f"{name};TZID=America/Chicago:"), F.date_format(c, "yyyyMMdd'T'HHmmss")))
        place = F.when(F.col("o_custkey") % 4 == 0, "Park").otherwise("Hall")
        parts = [F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:u"), key), F.concat(F.lit("SUMMARY:"), F.substring(title, 1, 3), F.lit("\r\n "), F.substring(title, 4, 99)), stamp("DTSTART", start, start), stamp("DTEND", end, F.date_add(end, 1)), F.concat(F.lit("LOCATION:"), place, F.lit(" "), F.col("o_custkey"), F.lit("\\, 1 Main")), *more, F.lit("END:VEVENT\r\n")]
        return F.concat_ws("\r\n", *parts)

    ends = F.col("o_orderdate") + F.make_dt_interval(k, F.lit(2))
    gone = F.when(key % 10 == 9, F.concat(F.lit("EXDATE;VALUE=DATE:"), F.date_format(F.date_add(day, 14), "yyyyMMdd")))
    main = lines(F.col("o_orderdate"), F.when(whole, F.date_add(day, k).cast("timestamp")).otherwise(ends), F.col("o_orderpriority"), [F.concat(F.lit("RRULE:"), rule_of(key)), gone])
    later = F.expr("INTERVAL 22 DAYS")
    moved = lines(F.col("o_orderdate") + later, F.when(whole, F.date_add(day, k + 22).cast("timestamp")).otherwise(ends + later), F.concat(F.lit("Moved "), "o_orderpriority"), [F.concat(F.lit("RECURRENCE-ID;VALUE=DATE:"), F.date_format(F.date_add(day, 21), "yyyyMMdd"))])
    events = t.orders.select("o_custkey", F.concat(main, F.when(key % 10 == 9, moved).otherwise("")).alias("e"))
    pages = events.groupBy("o_custkey").agg(F.concat(F.lit("BEGIN:VCALENDAR\r\n"), F.array_join(F.collect_list("e"), ""), F.lit("END:VCALENDAR\r\n")).alias("body"))
    found = calendars.ics(pages, "body", "o_custkey", F.lit("1999-01-01").cast("date"), F.lit("1999-03-31").cast("date"), title_includes=("medium", "LOW"), location_includes=("hall",), title_replace={"LOW": "Low"}, max_days=3)
    return found.select("external_id", "title", stamp("starts").alias("starts"), stamp("ends").alias("ends"), "all_day", "venue_name")


@query(f"""
WITH o AS (
  SELECT *, o_custkey % 10 AS source, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS block,
    CASE WHEN o_orderkey % 3 = 0 THEN {_ICS_LOCAL} ELSE o_orderdate::TIMESTAMP END AS starts FROM orders),
e AS (
  SELECT source, o_custkey AS page, block, 1 AS depth, o_orderpriority AS title, starts, CASE WHEN o_orderkey % 4 = 0 THEN '/c/' || o_custkey ELSE '/e/' || o_orderkey END AS url,
    CASE WHEN o_orderkey % 5 = 0 THEN 'Free' WHEN o_orderkey % 5 = 1 THEN '$12.5' WHEN o_orderkey % 5 = 2 THEN '$12' ELSE '' END AS price,
    CASE o_orderkey % 3 WHEN 0 THEN 'Hall' WHEN 1 THEN 'Loft' ELSE 'Yard' END AS venue_name, o_orderkey % 6 AS k FROM o
  UNION ALL SELECT source, o_custkey, block, 0, 'Big ' || o_orderkey, o_orderdate::DATE::TIMESTAMP, '/big', '', '', 0 FROM o WHERE o_orderkey % 4 = 3)
SELECT source, url || ':' || starts::DATE AS external_id, title, strftime(starts, '%Y-%m-%d %H:%M:%S') AS starts, price, venue_name, depth = 0 AS all_day
FROM e WHERE k <= 4 AND starts::DATE BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
QUALIFY row_number() OVER (PARTITION BY source, external_id ORDER BY page, block, depth) = 1
""")
def src_jsonld(t):
    """A page per customer with a block per order: four kinds of nesting, three levels deep; offers and places as lists, objects and texts."""
    key = F.col("o_orderkey")
    text = lambda name, c: F.concat(F.lit(f'"{name}":"'), c, F.lit('"'))
    number = F.when(key % 5 == 0, "0").when(key % 5 == 1, "12.5").when(key % 5 == 2, '"12"')
    offer = F.concat(F.lit('{"price":'), F.coalesce(number, F.lit("null")), F.lit("}"))
    offer = F.when(key % 2 == 0, F.concat(F.lit("["), offer, F.lit(',{"price":99}]'))).otherwise(offer)
    place = F.when(key % 3 == 0, '[{"name":"Hall"},{"name":"Other"}]').when(key % 3 == 1, '{"@type":"Place","name":"Loft"}').otherwise('"Yard"')
    kind = F.when(key % 2 == 0, '"MusicEvent"').otherwise('["Thing","SaleEvent"]')
    start = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(key % 3 == 0, "Z").otherwise(""))
    end = F.concat(F.date_format(F.col("o_orderdate") + F.make_dt_interval((key % 6).cast("int")), "yyyy-MM-dd'T'HH:mm:ss"), F.when(key % 3 == 0, "Z").otherwise(""))
    parts = [F.concat(F.lit('"@type":'), kind), text("name", F.col("o_orderpriority")), text("startDate", start), text("endDate", end), F.when(key % 4 != 0, text("url", F.concat(F.lit("/e/"), key))), F.concat(F.lit('"offers":'), offer), F.concat(F.lit('"location":'), place)]
    e = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    big = F.concat(F.lit('{"@type":"BigEvent","name":"Big '), key, F.lit('","url":"/big","startDate":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('","subEvent":{"@type":"Talks","subEvent":[['), e, F.lit("]]}}"))
    doc = (
        F.when(key % 4 == 0, F.concat(F.lit('{"@graph":['), e, F.lit("]}")))
        .when(key % 4 == 1, F.concat(F.lit('{"@graph":[{"@type":"Place"},{"@type":"Festival","subEvent":['), e, F.lit("]}]}")))
        .when(key % 4 == 2, F.concat(F.lit('[{"itemListElement":[{"@type":"ListItem","subEvent":'), e, F.lit("}]}]")))
        .otherwise(big)
    )
    block = F.concat(F.lit("<script type='application/ld+json'>"), doc, F.lit("</script>"))
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", block.alias("b")))), lambda s: s["b"]), "<p>")
    pages = t.orders.groupBy("o_custkey").agg(blocks.alias("html")).select("*", (F.col("o_custkey") % 10).alias("source"), F.concat(F.lit("/c/"), "o_custkey").alias("url"))
    found = jsonld.events(pages, "html", "source", "o_custkey", "url", F.lit("1996-01-01").cast("date"), F.lit("1999-12-31").cast("date"), max_days=4)
    return found.select("source", "external_id", "title", stamp("starts").alias("starts"), "price", "venue_name", "all_day")


_LINKS = """regexp_extract_all(html, '(?:href=["'']|<loc>\\s*)([^"''<\\s]*/[^"''<\\s]*)', 1)"""


@query(f"SELECT page_id, slug, place FROM (SELECT page_id, slug, row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) AS place FROM (SELECT page_id, unnest(l) AS slug, unnest(range(len(l))) AS pos FROM (SELECT page_id, {_LINKS} AS l FROM pages)) GROUP BY page_id, slug) WHERE place <= 5")
def src_sitemap(t):
    return R.links(t.pages, "html", "page_id", "/", "^$", 5).select("page_id", "slug", F.col("place").cast("long").alias("place"))


@query(f"""WITH {RULE_DAYS}, l AS (SELECT o_orderkey, o_custkey % 5 AS source, row_number() OVER (PARTITION BY o_custkey % 5 ORDER BY o_custkey, o_orderkey) AS place FROM orders WHERE o_orderkey % 6 <> 5 AND o_orderpriority <> '5-LOW'),
k AS (SELECT * FROM l WHERE place <= 300)
SELECT 's' || source AS source, 'e-' || o_orderkey || ':' || day AS external_id, o_orderpriority AS title, strftime(day + o_orderdate::TIME, '%Y-%m-%d %H:%M:%S') AS starts, CASE WHEN o_orderkey % 2 = 0 THEN 'Hall' ELSE '' END AS venue_name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Hall' ELSE '1 Main' END AS address, '/s' || source || '/Details/e-' || o_orderkey AS info_url FROM k JOIN orders USING (o_orderkey) JOIN r USING (o_orderkey) WHERE o_orderkey % 7 <> 3 AND o_orderkey % 11 <> 3
UNION ALL SELECT 's' || source, 'refused', CASE WHEN o_orderkey % 7 = 3 THEN 'not landed' ELSE 'no whole calendar' END, count(*)::VARCHAR, '', '', '' FROM k WHERE o_orderkey % 7 = 3 OR o_orderkey % 11 = 3 GROUP BY 1, 3
""")
def src_growthzone(t):
    """Listing pages of five sources and a calendar per event, landed as files in the shared folder and read back; some calendars are missing, some broken off."""
    key = F.col("o_orderkey")
    folder = f"{tables.shared_dir(t.spark)}/landed-{uuid.uuid4().hex}"
    rows = t.orders.withColumns({"source": F.concat(F.lit("s"), F.col("o_custkey") % 5), "slug": F.concat(F.when(F.col("o_orderpriority") == "5-LOW", "skip-me-").otherwise("e-"), key)})
    link = F.concat(F.lit("<a href='/"), "source", F.lit("/Details/"), "slug", F.lit("?x'>"))
    pages = rows.where(key % 6 != 5).groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_custkey", key, link.alias("a")))), lambda s: s["a"]), " ").alias("value"))
    pages.write.partitionBy("source").text(f"{folder}/listing")
    stamp_ = F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss")
    gone = F.when(key % 10 == 9, F.concat(F.lit("EXDATE;VALUE=DATE:"), F.date_format(F.date_add("o_orderdate", 14), "yyyyMMdd")))
    event = F.concat_ws("\r\n", F.lit("BEGIN:VCALENDAR\r\nBEGIN:VEVENT"), F.concat(F.lit("SUMMARY:"), "o_orderpriority"), F.concat(F.lit("DTSTART:"), stamp_), F.concat(F.lit("LOCATION:"), F.when(key % 2 == 0, "Hall").otherwise("1 Main")), F.concat(F.lit("RRULE:"), rule_of(key)), gone, F.lit("END:VEVENT"), F.when(key % 11 != 3, "END:VCALENDAR"))
    # One row a calendar, many calendars a file: a record per line with the calendar's path, as a collector's batch would be.
    rows.where(key % 7 != 3).select("source", "slug", F.to_json(F.struct("slug", event.alias("body"))).alias("value")).select("source", "value").write.partitionBy("source").text(f"{folder}/calendars")
    listings = landed.texts(t.spark, f"{folder}/listing").select("source", "body", F.concat(F.lit("/"), "source").alias("base"))
    lines = t.spark.read.text(f"{folder}/calendars").select("source", F.from_json("value", "slug string, body string").alias("r"), F.col("_metadata.file_path").alias("path"))
    events, bad = landed.listed_calendars(listings, lines.select("source", "r.slug", "path", "r.body"), F.lit("1999-01-01").cast("date"), F.lit("1999-03-31").cast("date"), skip=("skip me",), most=300)
    none = F.lit("")
    reasons = bad.select(F.regexp_extract("path", "(?:source=)?(s[0-9])/", 1).alias("source"), "reason").groupBy("source", "reason").agg(F.count("*").cast("string").alias("n"))
    kept = events.select("source", "external_id", "title", stamp("starts").alias("starts"), "venue_name", "address", "info_url")
    return kept.unionByName(reasons.select("source", F.lit("refused").alias("external_id"), F.col("reason").alias("title"), F.col("n").alias("starts"), none.alias("venue_name"), none.alias("address"), none.alias("info_url")))


@query("SELECT o_orderkey AS external_id, o_orderpriority AS title, o_orderdate::DATE::VARCHAR AS day FROM orders WHERE o_orderstatus = 'O'")
def src_duda(t):
    rows = t.orders.withColumn("Day", _day().cast("string"))
    return R.mapped(rows, {"external_id": "o_orderkey", "title": "o_orderpriority", "day": "Day"}, {"o_orderstatus": "O"})


@query("""
WITH o AS (
  SELECT *, o_orderdate::DATE AS d1, o_orderdate::DATE + CAST(o_orderkey % 23 AS INT) AS d2, o_orderkey % 3 = 0 AND o_orderkey % 23 > 0 AS weekly FROM orders WHERE o_orderkey % 7 <> 0),
e AS (
  SELECT *, unnest(CASE WHEN weekly THEN generate_series(d1, d2, INTERVAL 7 DAY) ELSE [d1::TIMESTAMP] END)::DATE AS day FROM o
  WHERE weekly OR d2 - d1 <= 10)
SELECT CASE WHEN o_orderkey % 5 = 0 THEN replace(o_orderpriority, 'SPECIFIED', 'Specified') ELSE 's' || o_orderkey END || ':' || day AS external_id,
  strftime(day + CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL '18:30:00' ELSE INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S') AS starts,
  CASE WHEN o_orderkey % 2 = 1 THEN strftime(CASE WHEN weekly THEN day ELSE d2 END + INTERVAL '23:59:59', '%Y-%m-%d %H:%M:%S')
    WHEN o_orderkey % 4 = 0 THEN strftime(CASE WHEN weekly THEN day ELSE d2 END + INTERVAL 20 HOUR, '%Y-%m-%d %H:%M:%S')
    WHEN NOT weekly AND d2 > d1 THEN strftime(d2 + INTERVAL 0 HOUR, '%Y-%m-%d %H:%M:%S') END AS ends,
  o_orderkey % 2 = 1 AS all_day, CASE WHEN o_orderkey % 5 = 0 THEN '1 Main' ELSE '1 Main, Town' END AS address, [x for x in ['Music', CASE WHEN o_orderkey % 5 = 0 THEN 'Food' END] if x IS NOT NULL] AS categories
FROM e WHERE day BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
""")
def src_govcal(t):
    """Double-encoded rows of a county: weekly runs, long runs, times, places, categories; every seventh is postponed."""
    key = F.col("o_orderkey")
    when = lambda c, value: F.when(c, value)
    e = F.struct(
        when(key % 5 != 0, F.concat(F.lit("s"), key)).alias("slug"), F.col("o_orderpriority").alias("title"), _day().cast("string").alias("start_date"),
        F.date_add(_day(), (key % 23).cast("int")).cast("string").alias("end_date"), when(key % 7 == 0, "1").otherwise("0").alias("postponed"),
        when(key % 2 == 0, "6:30 PM").alias("start_time"), when(key % 4 == 0, "8:00 pm").otherwise("12:00 AM").alias("end_time"),
        when((key % 3 == 0) & (key % 23 > 0), "Week").otherwise("None").alias("recurring_type"), F.lit("1 Main").alias("event_address"), when(key % 5 == 0, "null").otherwise("Town").alias("event_city"),
        when(key % 5 == 0, "Music, Food,").otherwise("Music").alias("category"),
    )
    once = t.orders.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(e).alias("data"))).alias("b"))
    twice = once.select(F.when(F.col("o_custkey") % 2 == 0, F.col("b")).otherwise(F.regexp_extract(F.to_json(F.struct("b")), r'(?s)^\{"b":(.*)\}$', 1)).alias("body"))
    found = calendars.county(twice, "body", F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date"), "https://county.example/")
    return found.select("external_id", stamp("starts").alias("starts"), stamp("ends").alias("ends"), "all_day", "address", "categories")


@query("""SELECT 'f-' || o_orderkey || ':' || o_orderdate::DATE AS external_id, o_orderpriority || ' ' || o_orderkey AS title, o_orderdate::DATE AS starts,
  strftime(o_orderdate::DATE + CASE WHEN o_orderkey % 9 < 8 THEN CAST(o_orderkey % 9 AS INT) ELSE 0 END + INTERVAL '23:59:59', '%Y-%m-%d %H:%M:%S') AS ends,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Yard' ELSE 'Yard, ' || o_custkey || ' Main, Town' END AS address, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'Town' END AS city, 'Fun' AS description
FROM orders WHERE (o_orderkey % 9 = 8 OR o_orderkey % 9 <= 5) AND o_orderdate::DATE <= DATE '1998-12-31' AND o_orderdate::DATE + CASE WHEN o_orderkey % 9 < 8 THEN CAST(o_orderkey % 9 AS INT) ELSE 0 END >= DATE '1998-01-01'""")
def src_festival_cards(t):
    """A page of cards per customer and detail pages with an address for three of four, landed as files and joined by address."""
    key, k = F.col("o_orderkey"), (F.col("o_orderkey") % 9).cast("int")
    folder = f"{tables.shared_dir(t.spark)}/cards-{uuid.uuid4().hex}"
    end = F.when(k == 8, "soon").otherwise(F.date_add(_day(), k).cast("string"))
    card = F.concat(F.lit("<article><a href='/f/f-"), key, F.lit("'><h3 class='title'>"), F.col("o_orderpriority"), F.lit(" "), key, F.lit("</h3></a><i class='venue'>Yard</i><p class='summary'>Fun. </p><b class='start'>"), _day().cast("string"), F.lit("</b><b class='end'>"), end, F.lit("</b></article>"))
    t.orders.groupBy((F.col("o_custkey") % 20).alias("page")).agg(F.array_join(F.collect_list(card), "").alias("value")).write.partitionBy("page").text(f"{folder}/pages")
    block = F.concat(F.lit("<script type='application/ld+json'>{\"address\":{\"streetAddress\":\""), "o_custkey", F.lit(" Main\",\"addressLocality\":\"Town\"}}</script>"))
    t.orders.where(key % 4 != 0).select(F.to_json(F.struct(F.concat(F.lit("https://f.example/f/f-"), key).alias("url"), block.alias("body"))).alias("value")).write.text(f"{folder}/details")
    pages = landed.texts(t.spark, f"{folder}/pages").select(F.lit("f").alias("source"), F.lit("https://f.example").alias("base"), "body")
    details = t.spark.read.schema("url string, body string").json(f"{folder}/details")
    found = landed.festival_cards(pages, details, F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date"), 5)
    return found.select("external_id", "title", F.to_date("starts").alias("starts"), stamp("ends").alias("ends"), "address", "city", "description")


@query("SELECT substr(sha1(o_orderpriority || '|' || strftime(o_orderdate::TIMESTAMP, '%Y-%m-%dT%H:%M:%S') || '|v' || o_custkey), 1, 12) AS external_id, o_orderpriority AS title FROM orders WHERE o_orderkey % 3 <> 0")
def src_manual_csv(t):
    rows = t.orders.select(F.concat(F.lit(" "), F.col("o_orderpriority")).alias("title"), F.when(F.col("o_orderkey") % 3 == 0, "soon").otherwise(stamp("o_orderdate")).alias("start"), F.concat(F.lit("v"), F.col("o_custkey")).alias("venue"))
    return R.manual(rows).select("external_id", "title")


@query("SELECT 'Show ' || o_orderkey AS title, strftime((o_orderdate::DATE - 1) + CAST(((4 - (isodow(o_orderdate::DATE - 1) - 1)) % 7 + 7) % 7 AS INT) + INTERVAL 20 HOUR, '%Y-%m-%d %H:%M:%S') AS starts, 'Hall' AS venue_name FROM orders")
def src_rundown(t):
    """A post per order: a Friday heading, then one event at 8 pm."""
    body = F.concat(F.lit("<p><strong>FRIDAY</strong></p><p><strong>Show "), F.col("o_orderkey"), F.lit("</strong> 8 pm @ Hall, downtown</p><p><strong>Old</strong> 9 pm, rescheduled</p>"))
    return R.prose(t.orders.select(_day().alias("posted"), body.alias("body")), "body", "posted").select("title", stamp("starts").alias("starts"), "venue_name")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 0")
def required_fields(t):
    rows = t.nation.withColumn("n_name", F.when(F.col("n_regionkey") != 0, F.col("n_name")))
    return L.complete(rows, "n_nationkey", "n_name").select("n_nationkey", "n_name")


@query("SELECT event_type AS source_id, count(*) AS n, sum(user_id)::BIGINT AS users FROM events WHERE event_id % 2 = 1 GROUP BY 1")
def sink_raw_archive(t):
    """Two runs appended to an archive in the shared folder, and one read back with its schema."""
    path = f"{tables.shared_dir(t.spark)}/archive-{uuid.uuid4().hex}"
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    run = (F.col("event_id") % 2).cast("int")
    archive.append(rows, path, run, "event_type", "event_id", F.col("ts"))
    back = archive.scan(t.spark, path, 1, "event_id long, user_id long")
    return back.groupBy("source_id").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


@query("SELECT event_id FROM events WHERE ts::DATE = DATE '2024-01-10'")
def scan_run(t):
    """One day's run out of an archive with a run a day: only its partition is read."""
    path = f"{tables.shared_dir(t.spark)}/archive-{uuid.uuid4().hex}"
    archive.append(t.events.select("event_id", "event_type", "ts"), path, F.date_format("ts", "yyyyMMdd").cast("int"), "event_type", "event_id", F.col("ts"))
    return archive.scan(t.spark, path, 20240110, "event_id long").select("event_id")


@query("""WITH e AS (SELECT event_type AS source_id, ts::DATE AS run, count(*) AS n, max(ts)::TIMESTAMP AS pulled_at, event_type = 'error' OR day(ts::TIMESTAMP) % 7 = 0 AS failed FROM events GROUP BY 1, 2, 5),
r AS (SELECT source_id, run, CASE WHEN day(run) % 3 = 0 THEN 100000 + n ELSE n END AS n, pulled_at, CASE WHEN failed AND day(run) % 3 <> 0 THEN 'failed' ELSE 'ok' END AS status FROM e)
SELECT r.source_id, run, status, n, strftime(pulled_at, '%Y-%m-%d %H:%M:%S') AS pulled_at, strftime(last, '%Y-%m-%d %H:%M:%S') AS last_ok
FROM r LEFT JOIN (SELECT source_id, max(pulled_at) AS last FROM r WHERE status = 'ok' GROUP BY 1) USING (source_id)""")
def sink_source_run(t):
    """Results of every source and day written, then those of each third day once more: a rerun replaces its own rows alone."""
    path = f"{tables.shared_dir(t.spark)}/source-runs-{uuid.uuid4().hex}"
    failed = (F.col("event_type") == "error") | (F.dayofmonth("ts") % 7 == 0)
    pulls = t.events.groupBy(F.to_date("ts").alias("run"), F.col("event_type").alias("source_id"), failed.alias("failed")).agg(F.count("*").alias("n"), F.max("ts").alias("pulled_at"))
    results = pulls.select("run", "source_id", F.when(F.col("failed"), "failed").otherwise("ok").alias("status"), "n", "pulled_at", F.lit("").alias("error"))
    snapshots.source_runs(results, path)
    again = results.where(F.dayofmonth("run") % 3 == 0).withColumns({"n": F.col("n") + 100000, "status": F.lit("ok")})
    snapshots.source_runs(again, path)
    good = snapshots.last_good(t.spark, path).select("source_id", stamp("last_successful_pull").alias("last_ok"))
    return snapshots.read(t.spark, path).join(good, "source_id", "left").select("source_id", "run", "status", "n", stamp("pulled_at").alias("pulled_at"), "last_ok")


@query("SELECT p_partkey, arg_min(r_name, pos) AS origin FROM (SELECT p_partkey, unnest([p_size % 7, p_size % 5, p_size % 3]) AS k, unnest([0, 1, 2]) AS pos FROM part) JOIN region ON r_regionkey = k GROUP BY 1")
def origin_url(t):
    """First of three keys that is a region's."""
    known = t.region.select(F.col("r_regionkey").alias("domain"), F.col("r_name").alias("origin"))
    return L.origin_of(t.part, F.array(*(F.col("p_size") % n for n in (7, 5, 3))), known, "p_partkey")


@query("SELECT page_id, CASE WHEN contains(html, '<') AND length(html) > 20 THEN html ELSE url END AS description FROM pages")
def description_pick(t):
    return t.pages.select("page_id", L.rich_description([F.col("url"), F.col("html")], F.col("url")).alias("description"))


@query("SELECT n_nationkey, CASE WHEN n_regionkey < 3 THEN upper(r_name) ELSE '' END AS label FROM nation LEFT JOIN region ON r_regionkey = n_regionkey")
def area_label(t):
    labels = t.region.where("r_regionkey < 3").select(F.col("r_regionkey").alias("n_regionkey"), F.upper("r_name").alias("label"))
    return L.label_of(t.nation, labels, "n_regionkey", "label", "").select("n_nationkey", "label")


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0 AND s_acctbal > 0")
def hh_filter(t):
    windows = F.when(F.col("s_acctbal") > 0, F.array(F.lit("16:00"))).otherwise(F.array().cast("array<string>"))
    rows = t.supplier.select("s_suppkey", windows.alias("windows"), F.when(F.col("s_suppkey") % 4 == 0, "unverified").otherwise("ok").alias("status"))
    return L.happy_hours(rows, "windows", "status").select("s_suppkey")


@query("SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN n_name END AS page FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def hh_venue_join(t):
    pages = t.nation.where("n_nationkey < 10").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("page"))
    return L.label_of(t.supplier, pages, "s_nationkey", "page").select("s_suppkey", "page")


@query("SELECT s_nationkey, list(s_suppkey ORDER BY s_name, s_suppkey) AS spots FROM supplier GROUP BY 1")
def hh_grouped(t):
    return views.grouped_items(t.supplier, "s_nationkey", "s_suppkey", "s_name").withColumnRenamed("items", "spots")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Mon–Wed · 4–6 pm' ELSE 'Sat, Sun · 9 pm–close' END AS label FROM orders")
def hh_views(t):
    even = F.col("o_orderkey") % 2 == 0
    days = F.when(even, F.array(*map(F.lit, (0, 1, 2)))).otherwise(F.array(*map(F.lit, (6, 5))))
    label = F.concat_ws(" · ", D.days_label(days), D.time_label(F.when(even, "16:00").otherwise("21:00"), F.when(even, "18:00").otherwise("close")))
    return t.orders.select("o_orderkey", label.alias("label"))


def _fuzzy_names(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.regexp_replace("p_name", "([a-z])$", "$1s").alias("key"), F.lit("").alias("address_key"), F.lit("").alias("domain"), F.lit("").alias("city"))


def _part_aliases(t):
    a = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("ordinal"))
    return a.select(F.col("p_name").alias("alias"), "ordinal", F.concat(F.lit("v"), F.col("ordinal")).alias("slug"), F.lit("").alias("venue_city"))


@query("SELECT p_partkey AS id, 'v' || (SELECT min(q.p_partkey) FROM part q WHERE q.p_name = p.p_name) AS slug FROM part p WHERE regexp_matches(p_name, '[a-z]$')")
def venue_fuzzy(t):
    """Part names with an added letter find their own name as the best alias."""
    none = t.region.where("false").select(F.lit("").alias("domain"), F.lit("").alias("slug"))
    return venues.resolve(_fuzzy_names(t), _part_aliases(t), none).where("via = 'fuzzy'").select("id", "slug")


@query("WITH n AS (SELECT p_name, min(p_partkey) AS first FROM part GROUP BY 1), f AS (SELECT a.p_name, min(q.first) AS first FROM n a JOIN n q ON length(q.p_name) >= 8 AND contains('7 road ' || a.p_name, q.p_name) GROUP BY 1) SELECT p_partkey AS id, 'v' || f.first AS slug FROM part JOIN f USING (p_name)")
def venue_address(t):
    names = t.part.select(F.col("p_partkey").alias("id"), F.lit("").alias("key"), F.concat(F.lit("7 road "), F.col("p_name")).alias("address_key"), F.lit("").alias("domain"), F.lit("").alias("city"))
    none = t.region.where("false").select(F.lit("").alias("domain"), F.lit("").alias("slug"))
    return venues.resolve(names, _part_aliases(t), none).where("via = 'address'").select("id", "slug")


@query("SELECT page_id, regexp_extract(url, '^(?:https?://)?(?:www\\.)?([^/:?#]+)', 1) AS slug FROM pages")
def venue_domain(t):
    """Pages by the domain of their address, through the resolver."""
    site = T.domain_of(F.col("url"))
    asked = t.pages.select(F.col("page_id").alias("id"), F.lit("").alias("key"), F.lit("").alias("address_key"), site.alias("domain"), F.lit("").alias("city"))
    known = t.pages.select(site.alias("domain")).distinct().withColumn("slug", F.col("domain"))
    none = t.region.where("false").select(F.lit("").alias("alias"), F.lit(1).alias("ordinal"), F.lit("").alias("slug"), F.lit("").alias("venue_city"))
    return venues.resolve(asked, none, known).select(F.col("id").alias("page_id"), "slug")


@query("SELECT c_custkey, coalesce(CASE WHEN c_nationkey < 5 THEN 'n' || c_nationkey END, CASE WHEN c_custkey % 2 = 0 THEN 'seg-' || c_mktsegment END) AS slug FROM customer")
def venue_default(t):
    origin = t.nation.where("n_nationkey < 5").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("n"), F.col("n_nationkey")).alias("o"))
    default = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("seg-"), F.col("c_mktsegment")))
    return L.label_of(t.customer, origin, "c_nationkey", "o").select("c_custkey", L.first_filled(F.col("o"), default=default).alias("slug"))


@query("SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 5) AS known FROM orders")
def src_key_lookup(t):
    return L.with_known(t.orders.select("o_orderkey"), t.lineitem.where("l_linenumber = 5").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, o_orderpriority AS organizer FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey")
def raw_organizer_join(t):
    raw = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.to_json(F.struct(F.col("o_orderpriority").alias("organizer"))).alias("payload"))
    return L.organizers(t.lineitem.select("l_orderkey", "l_linenumber"), raw, "l_orderkey", "payload")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT'")
def queue_occ_venue(t):
    queue = t.orders.where("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey")
    return L.attach(queue, t.customer, "c_custkey", "inner").select("o_orderkey", "c_name")


@query("SELECT s_suppkey, row_number() OVER (ORDER BY CASE WHEN s_acctbal > 5000 THEN 0 WHEN s_acctbal > 0 THEN 1 ELSE 2 END, s_suppkey % 3 <> 0, s_suppkey) AS ord FROM supplier")
def ingest_order(t):
    from pyspark.sql import Window as W

    tier = F.when(F.col("s_acctbal") > 5000, "A").when(F.col("s_acctbal") > 0, "B").otherwise("C")
    return t.supplier.select("s_suppkey", F.row_number().over(W.orderBy(signals.source_rank(tier, F.col("s_suppkey") % 3 == 0, F.col("s_suppkey")))).cast("long").alias("ord"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'https://img/' || o_orderkey END AS image FROM orders")
def record_image_flag(t):
    url = F.concat(F.lit("https://img/"), F.col("o_orderkey"))
    return t.orders.select("o_orderkey", L.image_of(F.col("o_orderkey") % 2 == 0, url).alias("image"))


@query("SELECT 'o' AS source, o_orderkey AS id FROM orders UNION ALL SELECT 'l', l_orderkey FROM lineitem")
def union_sources(t):
    return t.orders.select(F.lit("o").alias("source"), F.col("o_orderkey").alias("id")).unionByName(t.lineitem.select(F.lit("l").alias("source"), F.col("l_orderkey").alias("id")))


@query("SELECT 'event' AS kind, o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'venue', s_suppkey FROM supplier")
def union_index(t):
    return t.orders.where("o_orderstatus = 'P'").select(F.lit("event").alias("kind"), F.col("o_orderkey").alias("id")).unionByName(t.supplier.select(F.lit("venue").alias("kind"), F.col("s_suppkey").alias("id")))


_WORDS = "(SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)"


@query(f"SELECT p_partkey, list_sort(list_intersect(w, ['red', 'green', 'blue'])) AS hits FROM {_WORDS}")
def intersect_sources(t):
    return t.part.select("p_partkey", F.array_sort(F.array_intersect(F.split("p_name", " "), F.array(*map(F.lit, ("red", "green", "blue"))))).alias("hits"))


@query(f"SELECT p_partkey, list_sort(list_distinct(list_filter(w, lambda x: x <> 'red'))) AS rest FROM {_WORDS}")
def except_sources(t):
    return t.part.select("p_partkey", F.array_sort(F.array_except(F.split("p_name", " "), F.array(F.lit("red")))).alias("rest"))


@query("SELECT event_id, upper(event_type[1:1]) || event_type[2:] AS label FROM events")
def label_maps(t):
    labels = {n: n.capitalize() for n in ("view", "click", "signup", "purchase", "error")}
    return t.events.select("event_id", T.label_map(F.col("event_type"), labels).alias("label"))


@query("SELECT p_partkey, regexp_replace(p_name, '([aeiou]) ([a-z])', '\\1, \\2', 'g') AS fixed FROM part")
def regex_fixes(t):
    return t.part.select("p_partkey", T.regex_fixes(F.col("p_name"), [("([aeiou]) ([a-z])", "$1, $2")]).alias("fixed"))


@query("SELECT event_id, extract(hour FROM ts::TIMESTAMP) * 60 + extract(minute FROM ts::TIMESTAMP) AS minutes FROM events")
def clock_parse(t):
    at = D.parse_time_range(F.date_format("ts", "h:mm a"), F.to_date("ts"))["start"]
    return t.events.select("event_id", (F.hour(at) * 60 + F.minute(at)).cast("long").alias("minutes"))


@query("SELECT event_id, strftime(ts::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def iso_parse(t):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return t.events.select("event_id", stamp(D.iso_parse(text)).alias("at"))


@query("SELECT s_suppkey, s_suppkey % 2 = 0 AS stale FROM supplier")
def stale_source(t):
    pulled = F.when(F.col("s_suppkey") % 2 == 0, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2024-02-01 00:00:00")).cast("timestamp")
    health = t.supplier.select("s_suppkey", F.lit("ok").alias("status"), F.lit(False).alias("underdelivered"), pulled.alias("last_pull"))
    found = signals.alerts(health, "s_suppkey", F.lit("2024-02-10").cast("timestamp")).withColumn("stale", F.lit(True)).drop("kind")
    return t.supplier.select("s_suppkey").join(found, "s_suppkey", "left").select("s_suppkey", F.coalesce("stale", F.lit(False)).alias("stale"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderstatus <> 'F' THEN 'published' ELSE 'held' END AS state, (o_orderkey % 2 = 0 AND NOT (o_orderkey % 3 = 0 AND o_orderstatus <> 'F')) AS ambiguous, o_orderkey % 3 <> 0 AS open FROM orders")
def approve(t):
    """Every third id gets a yes: it is published unless cancelled, and its open question is closed."""
    k = F.col("o_orderkey")
    records = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "cancelled").otherwise("active").alias("status"), F.lit(False).alias("approved"), F.lit("held").alias("publish_state"), (k % 2 == 0).alias("ambiguous"))
    queue = t.orders.select("o_orderkey", F.lit(None).cast("timestamp").alias("resolved_at"))
    after, closed = review.approve(records, queue, "o_orderkey", F.lit("1998-01-01").cast("timestamp"), ids=t.orders.where(k % 3 == 0))
    return after.join(closed, "o_orderkey").select("o_orderkey", F.col("publish_state").alias("state"), "ambiguous", F.col("resolved_at").isNull().alias("open"))


@query("SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'C' END AS tier, CASE WHEN s_suppkey % 5 = 0 THEN 7 ELSE 0 END AS expected_min FROM supplier WHERE s_suppkey % 9 <> 0")
def src_config_tables(t):
    """Registry documents into rows: defaults for what is left out, rows without a required field refused."""
    name = F.when(F.col("s_suppkey") % 9 != 0, F.col("s_name"))
    doc = F.to_json(F.struct(F.col("s_suppkey").alias("id"), name.alias("name"), F.when(F.col("s_suppkey") % 2 == 0, "A").alias("tier"), F.when(F.col("s_suppkey") % 5 == 0, 7).alias("expected_min")))
    return archive.registry(t.supplier.select(doc.alias("doc")), "doc", "id long, name string, tier string, expected_min int", ["id", "name"], {"tier": "C", "expected_min": 0})


@query("SELECT 'big' AS section, rank, '- ' || o_orderkey || ' (' || o_orderpriority || ')' AS line FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5 UNION ALL SELECT 'counts', rank, event_type || ': ' || n FROM (SELECT event_type, count(*) AS n, row_number() OVER (ORDER BY event_type) AS rank FROM events GROUP BY 1)")
def sink_report_rows(t):
    """Report sections as (section, rank, line) rows, ready to be written as text."""
    big = views.report_lines("big", t.orders, 5, F.format_string("- %s (%s)", "o_orderkey", "o_orderpriority"), F.desc("o_totalprice"), "o_orderkey")
    kinds = views.count_by(t.events, "event_type")
    return big.unionByName(views.report_lines("counts", kinds, None, F.concat_ws(": ", "event_type", "n"), "event_type"))