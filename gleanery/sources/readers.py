"""Landed payloads to raw listings. Each reader takes a DataFrame of payload texts and gives columns of the raw record.

Raw columns: external_id, title, starts (local wall time), ends, all_day, venue_name, address, city,
price, website, description, cancelled. A reader gives those that its payload has.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date_range, parse_time_range
from ..functions.text import join_nonempty, null_text

TRIBE = "struct<events:array<struct<id:long,title:string,all_day:boolean,start_date:string,end_date:string,cost:string,url:string,venue:string,organizer:array<struct<organizer:string>>>>>"
PLACE = "struct<venue:string,address:string,city:string>"
TICKETS = "struct<id:string,name:string,status:string,start:struct<dateTime:string,localDate:string,localTime:string>,prices:array<struct<min:double,max:double>>>"


def tribe(payloads: DataFrame, body: str) -> DataFrame:
    """Calendar-API pages: one row per event; the venue may be an object or a list of them."""
    e = payloads.select(F.explode(F.from_json(body, TRIBE)["events"]).alias("e")).select("e.*")
    place = F.coalesce(F.get(F.from_json("venue", f"array<{PLACE}>"), 0), F.from_json("venue", PLACE))
    place = F.when(F.startswith(F.col("venue"), F.lit("[")), F.get(F.from_json("venue", f"array<{PLACE}>"), 0)).otherwise(F.from_json("venue", PLACE))
    e = e.withColumn("place", place)
    return e.select(
        F.concat_ws(":", "id", F.substring("start_date", 1, 10)).alias("external_id"),
        "title",
        F.try_to_timestamp("start_date").alias("starts"),
        F.try_to_timestamp("end_date").alias("ends"),
        "all_day",
        F.col("place.venue").alias("venue_name"),
        join_nonempty(", ", F.col("place.address"), F.col("place.city")).alias("address"),
        F.col("cost").alias("price"),
        F.array_join(F.transform("organizer", lambda o: o["organizer"]), ", ").alias("organizer"),
    )


def tickets(payloads: DataFrame, body: str, sweep: str) -> DataFrame:
    """Ticket-API events over several sweeps, the first sweep of an id wins; no time given means time to be announced."""
    from ..operators.signals import first_of

    e = payloads.select(sweep, F.from_json(body, TICKETS).alias("e")).select(sweep, "e.*")
    e = first_of(e.where("id IS NOT NULL"), ["id"], sweep)
    day = F.concat_ws(" ", "start.localDate", F.coalesce("start.localTime", F.lit("00:00:00")))
    low, high = F.array_min(F.transform("prices", lambda p: p["min"])), F.array_max(F.transform("prices", lambda p: p["max"]))
    money = lambda c: F.regexp_replace(c.cast("string"), r"\.0$", "")
    return e.select(
        F.col("id").alias("external_id"),
        F.col("name").alias("title"),
        F.coalesce(F.try_to_timestamp(F.col("start.dateTime")), F.try_to_timestamp(day)).alias("starts"),
        (F.col("start.dateTime").isNull() & F.col("start.localTime").isNull()).alias("time_tba"),
        F.when(low == high, F.concat(F.lit("$"), money(low))).when(low.isNotNull(), F.concat(F.lit("$"), money(low), F.lit("-"), money(high))).alias("price"),
        F.coalesce(F.lower("status").isin("cancelled", "canceled"), F.lit(False)).alias("cancelled"),
    )


def tag(item: Column, name: str) -> Column:
    """Text of an XML element by local name, whatever its prefix."""
    return F.trim(F.regexp_extract(item, rf"(?s)<(?:\w+:)?{name}\b[^>]*>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</(?:\w+:)?{name}>", 1))


def rss(payloads: DataFrame, body: str, first: Column, last: Column) -> DataFrame:
    """Feed items with date and time ranges that overlap [first, last]; 'StreetCity, ST 12345' is split again."""
    item = payloads.select(F.explode(F.regexp_extract_all(body, F.lit(r"(?s)<item\b[^>]*>(.*?)</item>"), 1)).alias("item"))
    days = item.select("item", parse_date_range(tag(F.col("item"), "EventDates")).alias("d")).where(F.col("d.d2") >= first).where(F.col("d.d1") <= last)
    times = parse_time_range(tag(F.col("item"), "EventTimes"), F.col("d.d1"))
    where = F.regexp_replace(tag(F.col("item"), "Location"), r"([a-z])([A-Z][a-z]+, [A-Z]{2} \d{5})", "$1, $2")
    link = F.regexp_extract(tag(F.col("item"), "link"), r"EID=(\d+)", 1)
    out = days.select(tag(F.col("item"), "title").alias("title"), link.alias("eid"), "d", times.alias("t"), where.alias("address"))
    return out.select(F.concat_ws(":", "eid", F.col("d.d1").cast("string")).alias("external_id"), "title", F.coalesce("t.start", F.col("d.d1").cast("timestamp")).alias("starts"), F.col("t.end").alias("ends"), F.col("t.start").isNull().alias("all_day"), "address")


def links(pages: DataFrame, html: str, key: str, pattern: str, skip: str, most: int) -> DataFrame:
    """(key, slug, place) of the first ``most`` distinct links that hold the pattern, in order of appearance."""
    from pyspark.sql import Window as W

    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(rf"(?:href=[\"']|<loc>\s*)([^\"'<\s]*{re.escape(pattern)}[^\"'<\s]*)"), 1)).alias("at", "slug"))
    first = found.where(~F.col("slug").rlike(skip)).groupBy(key, "slug").agg(F.min("at").alias("at"))
    return first.withColumn("place", F.row_number().over(W.partitionBy(key).orderBy("at"))).where(F.col("place") <= most).drop("at")


def mapped(rows: DataFrame, mapping: dict[str, str], require: dict[str, str] | None = None) -> DataFrame:
    """Only mapped columns are ever read; rows must equal the required values."""
    for column, value in (require or {}).items():
        rows = rows.where(F.col(column) == value)
    return rows.select(*(F.col(v).alias(k) for k, v in mapping.items()))


def manual(rows: DataFrame) -> DataFrame:
    """Hand-kept CSV rows: blank titles and bad dates go; the id hashes title, start and venue."""
    t = rows.select(*(F.trim(c).alias(c.strip()) for c in rows.columns)).withColumn("starts", F.try_to_timestamp("start")).where("title <> '' AND starts IS NOT NULL")
    key = F.substring(F.sha1(F.concat_ws("|", "title", F.date_format("starts", "yyyy-MM-dd'T'HH:mm:ss"), "venue").cast("binary")), 1, 12)
    return t.select(key.alias("external_id"), "title", "starts", F.col("venue").alias("venue_name"))


def prose(posts: DataFrame, body: str, posted: str) -> DataFrame:
    """One event per paragraph: a bold name, then a time and '@ venue'; a heading of a weekday holds for what follows.

    The weekday's date is the next one from the day before the post.
    """
    from pyspark.sql import Window as W

    from ..functions.dates import weekday_to_date

    days = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
    p = posts.select(posted, body, F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<p>(.*?)</p>"), 1)).alias("n", "p"))
    named = F.lower(F.regexp_extract("p", r"(?i)\b(mon|tues|wednes|thurs|fri|satur|sun)day\b", 0))
    bold = F.trim(F.regexp_extract("p", r"(?is)<strong>(.*?)</strong>", 1))
    p = p.withColumns({"day": F.nullif(named, F.lit("")), "name": bold})
    head = F.when((F.length(F.regexp_replace("p", "<[^>]+>", "")) <= 12) & F.col("day").isNotNull(), F.col("day"))
    p = p.withColumn("section", F.last(head, ignorenulls=True).over(W.partitionBy(posted, body).orderBy("n"))).where(head.isNull() & (F.col("name") != "") & ~F.col("p").rlike("(?i)reschedul|postpon|cancel"))
    number = F.array_position(F.array(*map(F.lit, days)), F.coalesce("day", "section")).cast("int") - 1
    on = weekday_to_date(F.date_sub(posted, 1), number)
    when = parse_time_range(F.regexp_replace("p", "(?is)<strong>.*?</strong>", ""), on)
    return p.where(number >= 0).select(F.col("name").alias("title"), F.coalesce(when["start"], on.cast("timestamp")).alias("starts"), when["end"].alias("ends"), F.trim(F.regexp_extract("p", r"@\s*([^,<]+)", 1)).alias("venue_name"))
