"""Landed payloads: files that collectors left in a folder, one payload a file, under ``source=<id>/...`` folders.

Every reader here keeps the file's path as the payload's key, and what can't be read comes back as rows of (path,
reason) instead of failing the scan or vanishing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import join_nonempty
from ..operators.tables import cut
from . import calendars, jsonld
from .readers import links

def _key() -> Column:
    return F.col("_metadata.file_path").alias("path")


def texts(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(path, body and the folder's partition columns): each file whole. ``pattern`` is a glob that the file's name must fit."""
    scan = spark.read.option("wholetext", True)
    rows = (scan.option("pathGlobFilter", pattern) if pattern else scan).text(folder)
    return rows.select(_key(), F.col("value").alias("body"), *[c for c in rows.columns if c != "value"])


def csv_rows(spark: SparkSession, folder: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their path, refused (path, reason)): lines that don't fit the schema are refused one by one."""
    scan = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(f"{schema}, _corrupt string")
    rows = cut(scan.csv(folder).select("*", _key()))  # Spark gives refused lines only beside the parsed ones
    good = rows.where("_corrupt IS NULL").drop("_corrupt")
    return good, rows.where("_corrupt IS NOT NULL").select("path", F.concat(F.lit("bad line: "), F.col("_corrupt")).alias("reason"))


def xml_rows(spark: SparkSession, folder: str, row_tag: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(elements with their path, refused (path, reason)) of XML files."""
    rows = spark.read.option("rowTag", row_tag).option("columnNameOfCorruptRecord", "_corrupt").schema(f"{schema}, _corrupt string").xml(folder)
    rows = cut(rows.select("*", _key()))
    return rows.where("_corrupt IS NULL").drop("_corrupt"), rows.where("_corrupt IS NOT NULL").select("path", F.lit("bad element").alias("reason"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, kind) of binary files by their first bytes; content is read for nothing else."""
    rows = spark.read.format("binaryFile").load(folder)
    start = F.hex(F.substring("content", 1, 4))
    kind = F.when(start.startswith("FFD8FF"), "jpeg").when(start == "89504E47", "png").when(start == "47494638", "gif").otherwise("other")
    return rows.select("path", "length", kind.alias("kind"))


def refused(payloads: DataFrame, reason: Column) -> DataFrame:
    """(path, reason) of payloads for which there is a reason."""
    return payloads.select("path", reason.alias("reason")).where("reason IS NOT NULL")


def not_json(body: Column) -> Column:
    return F.when(F.try_parse_json(body).isNull(), "no JSON")


def not_calendar(body: Column) -> Column:
    whole = F.coalesce(F.contains(body, F.lit("BEGIN:VCALENDAR")) & F.contains(body, F.lit("END:VCALENDAR")), F.lit(False))
    return F.when(~whole, "no whole calendar")


def listed_calendars(listings: DataFrame, details: DataFrame, first: Column, last: Column, pattern: str = "/Details/", skip: tuple[str, ...] = (), most: int = 80, **options) -> tuple[DataFrame, DataFrame]:
    """(events, refused) of listings whose links lead to a landed calendar each.

    listings(source, base, body) are pages, details(source, slug, path, body) the calendars by the slug that follows the
    pattern in a link. The first ``most`` slugs of a source in order of appearance count, less those that one of the
    ``skip`` patterns finds with hyphens read as spaces. Ids are ``slug:date``; a place that begins with a digit is an address and
    no name; without an own link an event leads to its page. Calendars that are cut off or no calendars are refused, as are
    slugs without a landed file.
    """
    found = links(listings, "body", "source", pattern, "^$", 2**31 - 1)
    slug = F.regexp_extract("slug", rf"{re.escape(pattern)}([^\"'?/#]+)", 1)
    each = found.select("source", slug.alias("slug"), "place").where("slug <> ''").groupBy("source", "slug").agg(F.min("place").alias("place"))
    for p in skip:
        each = each.where(~F.translate("slug", "-", " ").rlike(f"(?i){p}"))
    each = each.withColumn("_n", F.row_number().over(W.partitionBy("source").orderBy("place"))).where(F.col("_n") <= most).select("source", "slug")
    met = each.join(details, ["source", "slug"], "left")
    bad = refused(met.select(F.coalesce("path", F.concat_ws("/", "source", "slug")).alias("path"), "body"), F.when(F.col("body").isNull(), "not landed").otherwise(not_calendar(F.col("body"))))
    good = met.where(not_calendar(F.col("body")).isNull() & F.col("body").isNotNull()).withColumn("_key", F.concat_ws("\x1f", "source", "slug"))
    events = calendars.ics(good, "body", "_key", first, last, **options)
    part = lambda n: F.get(F.split("_key", "\x1f"), F.lit(n))
    events = events.withColumns({"source": part(0), "slug": part(1)}).join(listings.select("source", "base").distinct(), "source")
    out = events.select(
        "source",
        F.concat_ws(":", "slug", F.to_date("starts")).alias("external_id"),
        "title",
        "starts",
        "ends",
        "all_day",
        F.when(~F.col("venue_name").rlike(r"^\d"), F.col("venue_name")).otherwise("").alias("venue_name"),
        F.col("venue_name").alias("address"),
        "description",
        F.coalesce("info_url", F.concat("base", F.lit(pattern), "slug")).alias("info_url"),
    )
    return out, bad


def festival_cards(pages: DataFrame, details: DataFrame, first: Column, last: Column, max_days: int = 7) -> DataFrame:
    """Events of festival cards in pages(source, base, body), with the address that the landed detail page of each card's link gives.

    details(url, body). Cards whose span doesn't meet [first, last] or is longer than ``max_days`` go, as do those without a
    start; a missing end, or one before the start, is the start. An event is all day until 23:59:59 of its last day; the id is ``slug:start``, the
    slug being the link's last part. A card without a landed page has an empty address.
    """
    card = pages.select("source", "base", F.explode(F.regexp_extract_all("body", F.lit(r"(?is)<article\b[^>]*>(.*?)</article>"), 1)).alias("c"))
    text = lambda css: F.trim(F.regexp_replace(F.regexp_extract("c", rf"(?is)class=[\"']{css}[\"'][^>]*>(.*?)</", 1), "<[^>]+>", ""))
    href = F.regexp_extract("c", r"(?i)href=[\"']([^\"']+)", 1)
    day = lambda css: F.to_date(F.try_to_timestamp(text(css), F.lit("yyyy-MM-dd")))
    e = card.select("source", F.when(href.startswith("/"), F.concat("base", href)).otherwise(href).alias("url"), text("title").alias("title"), text("venue").alias("venue"), text("summary").alias("summary"), day("start").alias("d1"), day("end").alias("d2"))
    e = e.where("d1 IS NOT NULL").withColumn("d2", F.greatest("d1", F.coalesce("d2", "d1")))
    e = e.where((F.col("d2") >= first) & (F.col("d1") <= last) & (F.datediff("d2", "d1") <= max_days))
    nodes = details.select("url", F.explode(F.regexp_extract_all("body", F.lit(jsonld.BLOCK), 1)).alias("b")).select("url", F.try_parse_json("b").alias("v"))
    place = nodes.select("url", jsonld.part(F.col("v"), "$.address.streetAddress").alias("street"), jsonld.part(F.col("v"), "$.address.addressLocality").alias("town")).where("street IS NOT NULL OR town IS NOT NULL")
    place = place.groupBy("url").agg(F.min(F.struct("street", "town")).alias("a"))
    j = e.join(place, "url", "left")
    end = F.col("d2").cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    empty = lambda c: F.coalesce(c, F.lit(""))
    return j.select("source", F.concat_ws(":", F.regexp_extract("url", "([^/]+)/?$", 1), "d1").alias("external_id"), "title", F.col("d1").cast("timestamp").alias("starts"), end.alias("ends"), F.lit(True).alias("all_day"), F.col("venue").alias("venue_name"), join_nonempty(", ", F.col("venue"), empty(F.col("a.street")), empty(F.col("a.town"))).alias("address"), empty(F.col("a.town")).alias("city"), F.regexp_replace("summary", r"[. ]+$", "").alias("description"), F.col("url").alias("info_url"))
