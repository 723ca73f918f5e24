"""iCalendar payloads and county calendars to raw listings, a row per date of a recurring event in the window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DEFAULT_ZONE, known_zone
from ..functions.recurrence import expand
from ..functions.text import clean_title, flatten, join_nonempty, null_text, tame_caps


def components(payloads: DataFrame, body: str, *keep: str) -> DataFrame:
    """VEVENT blocks of unfolded calendars as rows: the ``keep`` columns, uid, title, start and end (local wall time of their
    zone), zone, all_day, location, description, url, rrule, exdates (dates) and recurrence_id (the date that the row replaces)."""
    flat = F.regexp_replace(body, r"\r?\n[ \t]", "")
    block = payloads.select(*keep, F.explode(F.regexp_extract_all(flat, F.lit(r"(?s)BEGIN:VEVENT\r?\n(.*?)END:VEVENT"), 1)).alias("b"))
    line = lambda name, group: F.regexp_extract("b", rf"(?m)^{name}((?:;[^:\r\n]*)?):(.*?)\r?$", group)
    value = lambda name: line(name, 2)
    tzid = F.nullif(F.regexp_extract(line("DTSTART", 1), r"TZID=\"?([^;:\"]+)", 1), F.lit(""))
    stamp = lambda c: F.coalesce(F.try_to_timestamp(F.substring(c, 1, 15), F.lit("yyyyMMdd'T'HHmmss")), F.try_to_timestamp(F.substring(c, 1, 8), F.lit("yyyyMMdd")))
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, r"\\[nN]", "\n"), r"\\([,;\\])", "$1")
    # Several EXDATE lines may stand in an event, and several dates in a line.
    gone = F.flatten(F.transform(F.regexp_extract_all("b", F.lit(r"(?m)^EXDATE(?:;[^:\r\n]*)?:(.*?)\r?$"), 1), lambda x: F.split(x, ",")))
    return block.select(
        *keep,
        value("UID").alias("uid"),
        plain(value("SUMMARY")).alias("title"),
        stamp(value("DTSTART")).alias("start"),
        stamp(value("DTEND")).alias("end"),
        F.when(value("DTSTART").endswith("Z"), "UTC").otherwise(tzid).alias("zone"),
        value("DTSTART").rlike(r"^\d{8}$").alias("all_day"),
        plain(value("LOCATION")).alias("location"),
        plain(value("DESCRIPTION")).alias("description"),
        value("URL").alias("url"),
        F.nullif(value("RRULE"), F.lit("")).alias("rrule"),
        F.array_compact(F.transform(gone, lambda x: F.to_date(F.try_to_timestamp(F.substring(F.trim(x), 1, 8), F.lit("yyyyMMdd"))))).alias("exdates"),
        F.to_date(F.try_to_timestamp(F.substring(value("RECURRENCE-ID"), 1, 8), F.lit("yyyyMMdd"))).alias("recurrence_id"),
    )


def ics(
    payloads: DataFrame,
    body: str,
    source: str,
    first: Column,
    last: Column,
    zone: str = DEFAULT_ZONE,
    title_includes: tuple[str, ...] = (),
    location_includes: tuple[str, ...] = (),
    title_replace: dict[str, str] | None = None,
    max_days: int | None = None,
) -> DataFrame:
    """Events of each source's calendars with a date in [first, last], times on the wall in ``zone``.

    A recurring event has a row per date; a component with a RECURRENCE-ID takes the place of that date. An
    all-day end is the day after the last and becomes 23:59:59 of the last. A title or place must hold one of the
    given texts, whatever their case (none: all pass); replacements come after. Events of more than ``max_days`` go. The
    id is ``UID:date`` (without a UID ``title:date``). Events without a title or start go. Times in another
    known zone are moved to ``zone``; an unknown zone counts as ``zone``.
    """
    e = components(payloads, body, source).withColumn("title", clean_title(F.col("title"))).where("title <> '' AND start IS NOT NULL")
    own = known_zone(F.col("zone"), zone)
    moved = lambda c: F.when(F.col("all_day") | (own == zone), F.col(c)).otherwise(F.from_utc_timestamp(F.to_utc_timestamp(c, own), zone))
    e = e.withColumns({"start": moved("start"), "end": moved("end")})
    e = e.withColumn("day0", F.to_date("start"))
    single = e.where("recurrence_id IS NOT NULL").where(F.col("day0").between(first, last)).withColumn("day", F.col("day0"))
    series = expand(e.where("recurrence_id IS NULL"), "day0", "rrule", "exdates", first, last)
    replaced = e.where("recurrence_id IS NOT NULL").select(source, "uid", F.col("recurrence_id").alias("day")).distinct()
    e = series.join(replaced, [source, "uid", "day"], "left_anti").select(single.columns).unionByName(single)
    holds = lambda c, words: F.lit(True) if not words else F.exists(F.array(*(F.lit(w.lower()) for w in words)), lambda w: F.contains(F.lower(c), w))
    e = e.where(holds(F.col("title"), title_includes)).where(holds(F.col("location"), location_includes))
    title = F.col("title")
    for old, new in (title_replace or {}).items():
        title = F.replace(title, F.lit(old), F.lit(new))
    later = F.make_dt_interval(F.datediff("day", "day0"))
    last_day = F.greatest(F.date_sub(F.to_date("end"), 1), F.col("day0"))
    whole_end = F.coalesce(last_day, F.col("day0")).cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND") + later
    out = e.select(
        source,
        F.concat_ws(":", F.coalesce(F.nullif("uid", F.lit("")), "title"), "day").alias("external_id"),
        title.alias("title"),
        (F.col("start") + later).alias("starts"),
        F.when(F.col("all_day"), whole_end).otherwise(F.col("end") + later).alias("ends"),
        "all_day",
        flatten(F.col("location")).alias("venue_name"),
        F.col("description").alias("description"),
        F.nullif("url", F.lit("")).alias("info_url"),
    )
    # Whole days between the two, as the wall tells them.
    return out if max_days is None else out.where(F.coalesce(F.floor((F.unix_timestamp("ends") - F.unix_timestamp("starts")) / 86400) <= max_days, F.lit(True)))


COUNTY = "struct<data:array<struct<title:string,start_date:string,end_date:string,start_time:string,end_time:string,venue_name:string,event_address:string,event_city:string,slug:string,cancelled:string,postponed:string,recurring_type:string,content:string,event_website:string,category:string>>>"


def county(payloads: DataFrame, body: str, first: Column, last: Column, detail: str, max_days: int = 10) -> DataFrame:
    """Rows of a county calendar: JSON, or a JSON string that holds it, under ``data``.

    Postponed rows and those without a title or a good start date go, as do runs of more than ``max_days`` unless they are
    weekly: these have a row per week in [first, last]. An end at or before the start is null; without a start time a row
    is all day until 23:59:59 of its last day. The id is ``slug:date`` (without a slug ``title:date``).
    """
    inner = F.from_json(F.concat(F.lit('{"v":'), F.col(body), F.lit("}")), "struct<v:string>")["v"]
    text = F.when(F.trim(body).startswith('"'), inner).otherwise(F.col(body))
    e = payloads.select(F.explode(F.from_json(text, COUNTY)["data"]).alias("e")).select("e.*")
    v = lambda c: F.coalesce(null_text(F.col(c)), F.lit(""))
    e = e.withColumn("title", clean_title(v("title"))).withColumn("title", tame_caps(F.col("title"))).where("title <> ''").where(v("postponed") != "1")
    day = lambda c: F.to_date(F.try_to_timestamp(v(c), F.lit("yyyy-MM-dd")))
    # An empty end is the start's; one that is no date refuses the row.
    e = e.withColumns({"d1": day("start_date"), "d2": F.when(v("end_date") == "", day("start_date")).otherwise(day("end_date"))}).where("d1 IS NOT NULL AND d2 IS NOT NULL")
    e = e.withColumn("d2", F.greatest("d1", "d2")).where((F.col("d2") >= first) & (F.col("d1") <= last))
    weekly = (v("recurring_type") == "Week") & (F.col("d2") > F.col("d1"))
    e = e.withColumn("weekly", weekly).where((F.datediff("d2", "d1") <= max_days) | F.col("weekly"))
    rrule = F.when(F.col("weekly"), F.concat(F.lit("FREQ=WEEKLY;UNTIL="), F.date_format("d2", "yyyyMMdd")))
    # A row without a rule has its start alone, which must lie in the window too.
    e = expand(e.withColumn("rrule", rrule), "d1", "rrule", None, first, last)
    clock = lambda c: F.date_format(F.try_to_timestamp(F.upper(F.regexp_replace(v(c), r"\s+", "")), F.lit("h:mma")), "HH:mm:ss")
    e = e.withColumns({"st": clock("start_time"), "et": clock("end_time"), "until": F.when(F.col("weekly"), F.col("day")).otherwise(F.col("d2"))})
    at = lambda d, t: (F.concat_ws(" ", d, t)).try_cast("timestamp")
    starts = at("day", F.coalesce("st", F.lit("00:00:00")))
    timed = F.when(F.col("et").isNotNull(), at("until", F.col("et")))
    e = e.withColumns({"starts": starts, "timed": timed})
    return e.select(
        F.concat_ws(":", F.coalesce(F.nullif(v("slug"), F.lit("")), "title"), "day").alias("external_id"),
        "title",
        "starts",
        F.when(F.col("st").isNull(), at("until", F.lit("23:59:59"))).when(F.col("timed") > F.col("starts"), F.col("timed")).alias("ends"),
        F.col("st").isNull().alias("all_day"),
        v("venue_name").alias("venue_name"),
        join_nonempty(", ", v("event_address"), v("event_city")).alias("address"),
        v("event_city").alias("city"),
        v("content").alias("description"),
        F.when(v("slug") != "", F.concat(F.lit(detail.rstrip("/") + "/"), v("slug"))).alias("info_url"),
        v("event_website").alias("website"),
        F.filter(F.transform(F.split(v("category"), ","), lambda c: F.trim(c)), lambda c: c != "").alias("categories"),
        (v("cancelled") == "1").alias("cancelled"),
    )
