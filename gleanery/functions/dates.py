"""Date and time functions as Columns. Instants are UTC timestamps (session zone UTC)."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ZONE = "America/Chicago"
DATE_FORMATS = ("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy")
STAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "MMMM d, yyyy h:mm a", "MMM d, yyyy h:mm a", "M/d/yyyy h:mm a")


def with_valid_zone(df: DataFrame, column: str, zones: DataFrame, default: str = DEFAULT_ZONE) -> DataFrame:
    """Zone names that are not in zones(zone) become the default; Spark's own functions would fail on them."""
    known = zones.select(F.col("zone").alias(column), F.lit(True).alias("_known")).distinct()
    return df.join(known, column, "left").withColumn(column, F.when(F.col("_known"), F.col(column)).otherwise(F.lit(default))).drop("_known")


def known_zone(zone: Column, default: str = DEFAULT_ZONE) -> Column:
    """The zone if the system's time-zone data (a few hundred names) has it, else the default."""
    return F.when(zone.isin(*sorted(zoneinfo.available_timezones())), zone).otherwise(F.lit(default))


def to_utc(local: Column, zone: Column | str = DEFAULT_ZONE) -> Column:
    return F.to_utc_timestamp(local, zone)


def from_utc(instant: Column, zone: Column | str = DEFAULT_ZONE) -> Column:
    return F.from_utc_timestamp(instant, zone)


def iso_utc(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_day(instant: Column, zone: Column | str = DEFAULT_ZONE) -> Column:
    return F.to_date(from_utc(instant, zone))


def default_end(start: Column, all_day: Column, instant: Column | None = None) -> Column:
    """End where a source gives none: the day's last second, or three hours on.

    Without ``instant`` on the wall. With it (the start as an instant) the end is an instant too, at the offset that
    the start had: three hours pass, and a day ends at 23:59:59 of that offset, whatever the clocks do meanwhile.
    """
    day_end = F.date_trunc("day", start) + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    if instant is None:
        return F.when(all_day, day_end).otherwise(start + F.expr("INTERVAL 3 HOURS"))
    return F.when(all_day, instant + (day_end - start)).otherwise(instant + F.expr("INTERVAL 3 HOURS"))


def recent(start: Column, as_of: Column, days: int = 1) -> Column:
    """The date-wise comparison with 'now less some days': equal dates pass whatever the hour."""
    return F.to_date(start) >= F.to_date(as_of - F.make_dt_interval(F.lit(days)))


def weekend_friday(day: Column) -> Column:
    """Friday of the weekend that holds or follows the day."""
    return F.date_add(day, F.lit(4) - F.weekday(day))


def weekday_to_date(anchor: Column, weekday: Column) -> Column:
    """First date from the anchor on with that weekday (Monday 0)."""
    return F.date_add(anchor, F.pmod(weekday - F.weekday(anchor), F.lit(7)))


def _minutes(text: Column, meridiem: Column) -> Column:
    hour = F.regexp_extract(text, r"(\d{1,2})", 1).cast("int")
    minute = F.coalesce(F.nullif(F.regexp_extract(text, r":(\d{2})", 1), F.lit("")).cast("int"), F.lit(0))
    pm = F.lower(meridiem).startswith("p")
    return F.when(meridiem == "", hour * 60 + minute).otherwise((hour % 12 + F.when(pm, 12).otherwise(0)) * 60 + minute)


def parse_time_range(times: Column, day: Column) -> Column:
    """struct(start, end) of '4:00 PM - 5:00 PM', '7 - 9pm' or a single time on a day; nulls if there is none.

    The first time takes the second's am/pm where it has none, and an end at or before the start is the
    next day's.
    """
    clock, mark = r"\d{1,2}(?::\d{2})?", r"(?:am|pm|a\.m\.|p\.m\.)"
    pair = rf"(?i)({clock})\s*({mark})?\s*(?:-|–|—|to)\s*({clock})\s*({mark})?"
    single = rf"(?i)\b({clock})\s*({mark})"
    text = F.coalesce(times, F.lit(""))
    pick = lambda p, i: F.regexp_extract(text, p, i)
    two = text.rlike(pair)
    second = pick(pair, 4)
    first = F.when(pick(pair, 2) == "", second).otherwise(pick(pair, 2))
    a = F.when(two, _minutes(pick(pair, 1), first)).when(text.rlike(single), _minutes(pick(single, 1), pick(single, 2)))
    b = F.when(two, _minutes(pick(pair, 3), second))
    at = lambda m: day.cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), m)
    return F.struct(at(a).alias("start"), at(F.when(b <= a, b + 1440).otherwise(b)).alias("end"))


def parse_date(text: Column) -> Column:
    return F.coalesce(*(F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in DATE_FORMATS))


def parse_date_range(dates: Column) -> Column:
    """struct(d1, d2) of one date or 'd1 - d2'; a second date that doesn't parse is the first."""
    parts = F.split(F.trim(dates), r"\s+(?:-|–|—|to|through)\s+", 2)
    d1 = parse_date(F.get(parts, 0))
    return F.struct(d1.alias("d1"), F.when(d1.isNotNull(), F.coalesce(parse_date(F.get(parts, 1)), d1)).alias("d2"))


def parse_local(text: Column, as_of: Column) -> Column:
    """struct(start, end, all_day, confident): local wall times of a time stamp text.

    A text without a year means this year, or the next if that is over 30 days past; one without a time
    is all day.
    """
    s = F.trim(F.coalesce(text, F.lit("")))
    has_year = s.rlike(r"\b(?:19|20)\d{2}\b")
    has_time = s.rlike(r"\d{1,2}:\d{2}") | s.rlike(r"(?i)\b\d{1,2}\s*(?:am|pm|a\.m\.|p\.m\.)\b")
    full = F.when(has_year, s).otherwise(F.concat(F.regexp_extract(s, r"^(\w+ \d{1,2})", 1), F.lit(", "), F.year(as_of).cast("string"), F.regexp_extract(s, r"^\w+ \d{1,2},?(.*)$", 1)))
    stamp = F.coalesce(*(F.try_to_timestamp(full, F.lit(f)) for f in STAMP_FORMATS), *(F.try_to_timestamp(full, F.lit(f)) for f in DATE_FORMATS))
    past = ~has_year & (stamp < as_of - F.expr("INTERVAL 30 DAYS"))
    start = F.when(past, F.add_months(stamp, 12).cast("timestamp") + (stamp - F.date_trunc("day", stamp))).otherwise(stamp)
    all_day = start.isNotNull() & ~has_time
    return F.struct(
        start.alias("start"),
        F.when(all_day, F.date_trunc("day", start) + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")).alias("end"),
        all_day.alias("all_day"),
        (start.isNotNull() & has_year).alias("confident"),
    )


def clock_label(t: Column) -> Column:
    """'7 pm', '7:30 pm'."""
    return F.lower(F.regexp_replace(F.date_format(t, "h:mm a"), ":00", ""))


def span_label(a: Column, b: Column) -> Column:
    """'Nov 6–8' within a month, else 'Oct 30–Nov 1'."""
    same = (F.month(a) == F.month(b)) & (F.year(a) == F.year(b))
    return F.concat(F.date_format(a, "MMM d"), F.lit("–"), F.when(same, F.date_format(b, "d")).otherwise(F.date_format(b, "MMM d")))


DAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def days_label(days: Column) -> Column:
    """Weekday numbers as 'Mon–Fri', 'Sat, Sun', 'Daily': runs of three or more become ranges."""
    names = F.array(*map(F.lit, DAYS))
    d = F.array_sort(F.array_distinct(days))
    name = lambda i: F.get(names, i)
    # Islands: value less place is the same along a run.
    runs = F.transform(F.array_distinct(F.transform(d, lambda x, i: x - i)), lambda k: F.filter(d, lambda x, i: x - i == k))
    labels = F.transform(runs, lambda r: F.when(F.size(r) >= 3, F.concat(name(F.get(r, 0)), F.lit("–"), name(F.element_at(r, -1)))).otherwise(F.array_join(F.transform(r, name), ", ")))
    return F.when(F.size(d) == 7, F.lit("Daily")).otherwise(F.array_join(labels, ", "))


def time_label(start: Column, end: Column) -> Column:
    """'4–6 pm', '11:30 am–2 pm', '9 pm–close' from HH:MM texts."""
    at = lambda c: F.to_timestamp(F.concat(F.lit("2000-01-01 "), c))
    a, b = clock_label(at(start)), clock_label(at(F.when(end == "close", F.lit("23:59")).otherwise(end)))
    shared = F.right(a, F.lit(3)) == F.right(b, F.lit(3))
    return F.when(end == "close", F.concat(a, F.lit("–close"))).when(shared, F.concat(F.regexp_replace(a, " [ap]m$", ""), F.lit("–"), b)).otherwise(F.concat(a, F.lit("–"), b))


def weekday_set(token: Column) -> Column:
    """Weekday numbers of 'Friday and Saturday', 'Thurs/Fri/Sat' or 'Tues-Sat' (a range may wrap), ascending."""
    stems = F.array(*(F.lit(d.lower()) for d in DAYS))
    number = lambda name: F.array_position(stems, F.lower(F.substring(name, 1, 3))).cast("int") - 1
    day = r"(mon|tue|wed|thu|fri|sat|sun)[a-z]*"
    named = F.transform(F.regexp_extract_all(token, F.lit(rf"(?i)\b{day}"), 1), number)
    span = rf"(?i)\b{day}\s*(?:-|–|—|to|through)\s*{day}"
    a, b = number(F.regexp_extract(token, span, 1)), number(F.regexp_extract(token, span, 2))
    ranged = F.transform(F.sequence(F.lit(0), F.pmod(b - a, F.lit(7))), lambda i: F.pmod(a + i, F.lit(7)))
    return F.array_sort(F.array_distinct(F.when(token.rlike(span), F.concat(named, ranged)).otherwise(named)))


def iso_parse(c: Column) -> Column:
    """An ISO time with its offset as an instant; anything else is null."""
    return F.try_to_timestamp(c)
