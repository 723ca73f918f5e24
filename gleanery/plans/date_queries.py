"""Date and time functions over orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.recurrence import expand
from ..operators import listings as L
from .registry import query

ZONE = D.DEFAULT_ZONE
_UTC = f"((o_orderdate::TIMESTAMP AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC')"
_LOCAL = f"((ts::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}')"
iso = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query(f"SELECT o_orderkey, strftime({_UTC}, '%Y-%m-%d %H:%M:%S') AS utc FROM orders")
def to_utc(t):
    return t.orders.select("o_orderkey", iso(D.to_utc(F.col("o_orderdate"))).alias("utc"))


@query(f"SELECT event_id, strftime({_LOCAL}, '%Y-%m-%d %H:%M:%S') AS wall FROM events")
def from_utc(t):
    return t.events.select("event_id", iso(D.from_utc(F.col("ts"))).alias("wall"))


@query("SELECT event_id, strftime(ts::TIMESTAMP, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def iso_utc(t):
    return t.events.select("event_id", D.iso_utc(F.col("ts")).alias("iso"))


@query(f"SELECT event_id, {_LOCAL}::DATE AS day FROM events")
def local_day(t):
    return t.events.select("event_id", D.local_day(F.col("ts")).alias("day"))


@query(f"SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 'Europe/Paris' WHEN c_nationkey = 1 THEN 'UTC' ELSE '{ZONE}' END AS zone FROM customer")
def valid_tz(t):
    zones = t.nation.where("n_nationkey < 2").select(F.when(F.col("n_nationkey") == 0, "Europe/Paris").otherwise("UTC").alias("zone"))
    named = t.customer.select("c_custkey", F.when(F.col("c_nationkey") == 0, "Europe/Paris").when(F.col("c_nationkey") == 1, "UTC").otherwise("No/Where").alias("zone"))
    return D.with_valid_zone(named, "zone", zones).select("c_custkey", "zone")


@query("SELECT o_orderkey, strftime(CASE WHEN o_orderstatus = 'O' THEN date_trunc('day', o_orderdate::TIMESTAMP) + INTERVAL 86399 SECOND ELSE o_orderdate::TIMESTAMP + INTERVAL 3 HOUR END, '%Y-%m-%d %H:%M:%S') AS ends FROM orders")
def default_end(t):
    return t.orders.select("o_orderkey", iso(D.default_end(F.col("o_orderdate"), F.col("o_orderstatus") == "O")).alias("ends"))


@query("SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate::TIMESTAMP ELSE date_trunc('day', o_orderdate::TIMESTAMP) END, '%Y-%m-%d %H:%M:%S') AS starts, (o_orderkey % 2 = 0) AS all_day FROM orders")
def parse_local(t):
    wall = F.when(F.col("o_orderkey") % 2 == 1, F.date_format("o_orderdate", "MMMM d, yyyy h:mm a")).otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    p = D.parse_local(wall, F.lit("2001-08-01 00:00:00").cast("timestamp"))
    return t.orders.select("o_orderkey", p.alias("p")).select("o_orderkey", iso(F.col("p.start")).alias("starts"), F.col("p.all_day").alias("all_day"))


_HOURS = "((o_orderkey % 12) + 1)"


@query(f"SELECT o_orderkey, strftime(o_orderdate::DATE + to_hours(CAST(12 + {_HOURS} % 12 AS INT)), '%Y-%m-%d %H:%M:%S') AS starts, strftime(o_orderdate::DATE + to_hours(CAST(12 + ({_HOURS} + 2) % 12 AS INT)) + CASE WHEN ({_HOURS} + 2) % 12 < {_HOURS} % 12 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%d %H:%M:%S') AS ends FROM orders")
def parse_time_range(t):
    """'10 - 12:00 pm', '11 - 1:00 pm': an end before the start is the next day's."""
    h = F.col("o_orderkey") % 12 + 1
    text = F.concat(h.cast("string"), F.lit(" - "), ((h + 1) % 12 + 1).cast("string"), F.lit(":00 pm"))
    p = D.parse_time_range(text, F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", p.alias("p")).select("o_orderkey", iso(F.col("p.start")).alias("starts"), iso(F.col("p.end")).alias("ends"))


@query("SELECT o_orderkey, o_orderdate::DATE AS d1, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE ELSE (o_orderdate::DATE + 2) END AS d2 FROM orders")
def parse_date_range(t):
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    later = F.date_format(F.date_add("o_orderdate", 2), "MMMM d, yyyy")
    text = F.when(F.col("o_orderkey") % 3 == 0, day).otherwise(F.concat(day, F.lit(" - "), later))
    return t.orders.select("o_orderkey", D.parse_date_range(text).alias("p")).select("o_orderkey", "p.d1", "p.d2")


@query("SELECT o_orderkey, strftime(date_trunc('day', o_orderdate::TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS starts, strftime(date_trunc('day', o_orderdate::TIMESTAMP) + INTERVAL 172799 SECOND, '%Y-%m-%d %H:%M:%S') AS ends FROM orders")
def all_day_bounds(t):
    d = F.date_trunc("day", "o_orderdate")
    return t.orders.select("o_orderkey", iso(d).alias("starts"), iso(D.default_end(d + F.expr("INTERVAL 1 DAY"), F.lit(True))).alias("ends"))


@query("SELECT o_orderkey, (o_orderdate::DATE + CAST(5 - isodow(o_orderdate::DATE) AS INT)) AS friday FROM orders")
def weekend_bounds(t):
    return t.orders.select("o_orderkey", D.weekend_friday(F.to_date("o_orderdate")).alias("friday"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-06-12' AND DATE '1998-06-14'")
def weekend_slice(t):
    friday = D.weekend_friday(F.lit("1998-06-10").cast("date"))
    return t.orders.where(F.to_date("o_orderdate").between(friday, F.date_add(friday, 2))).select("o_orderkey")


@query("SELECT o_orderkey, (o_orderdate::DATE + CAST((((o_orderkey % 7) - (isodow(o_orderdate::DATE) - 1)) % 7 + 7) % 7 AS INT)) AS day FROM orders")
def weekday_to_date(t):
    return t.orders.select("o_orderkey", D.weekday_to_date(F.to_date("o_orderdate"), (F.col("o_orderkey") % 7).cast("int")).alias("day"))


@query("SELECT event_id, lower(replace(strftime(ts::TIMESTAMP, '%-I:%M %p'), ':00', '')) AS label FROM events")
def clock_label(t):
    return t.events.select("event_id", D.clock_label(F.col("ts")).alias("label"))


@query("SELECT o_orderkey, strftime(a, '%b %-d') || '–' || CASE WHEN month(a) = month(b) THEN strftime(b, '%-d') ELSE strftime(b, '%b %-d') END AS label FROM (SELECT o_orderkey, o_orderdate::DATE AS a, o_orderdate::DATE + 3 AS b FROM orders)")
def span_label(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", D.span_label(d, F.date_add(d, 3)).alias("label"))


@query()
def days_label(t):
    """Weekdays on which each customer orders."""
    days = t.orders.groupBy("o_custkey").agg(F.collect_set(F.weekday("o_orderdate")).alias("d"))
    return days.select("o_custkey", D.days_label(F.col("d")).alias("label"))


@query()
def time_label(t):
    a = F.date_format("ts", "HH:mm")
    return t.events.select("event_id", D.time_label(a, F.when(F.col("event_id") % 5 == 0, "close").otherwise(F.date_format(F.col("ts") + F.expr("INTERVAL 90 MINUTES"), "HH:mm"))).alias("label"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE >= DATE '1998-08-01' - 1")
def recent(t):
    return t.orders.where(D.recent(F.col("o_orderdate"), F.lit("1998-08-01 18:00:00").cast("timestamp"))).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-01-01' AND DATE '1998-01-01' + 90")
def window_filter(t):
    return t.orders.where(L.in_window(F.to_date("o_orderdate"), F.lit("1998-01-01").cast("date"), 90)).select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE datediff('day', o_orderdate::DATE, l_shipdate::DATE) <= 30")
def span_filter(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.where(L.short_enough(F.col("o_orderdate"), F.col("l_shipdate"), 30)).select("l_orderkey", "l_linenumber")


#: A rule of each kind, by the order's key modulo their number. The last has its third date left out.
RULES = (
    None,
    "FREQ=DAILY;INTERVAL=3;COUNT=500",
    "FREQ=WEEKLY;BYDAY=MO,WE;COUNT=170",
    "FREQ=WEEKLY;INTERVAL=2;UNTIL=19990215T235959Z",
    "FREQ=MONTHLY;INTERVAL=2",
    "FREQ=MONTHLY;BYDAY=2TU,-1FR",
    "FREQ=YEARLY;COUNT=5",
    "FREQ=YEARLY;BYMONTH=2,3;BYDAY=5MO,1SU",
    "FREQ=DAILY;BYDAY=SA,SU;INTERVAL=5",
    "FREQ=WEEKLY",
)
RULE = f"(o_orderkey % {len(RULES)})"
#: Every day from an order to the end of the window, and which rule picks it, said day by day.
RULE_DAYS = f"""
d AS (SELECT o_orderkey, o_orderdate::DATE AS s, unnest(generate_series(o_orderdate::DATE, DATE '1999-03-31', INTERVAL 1 DAY))::DATE AS day FROM orders WHERE o_orderdate::DATE <= DATE '1999-03-31'),
p AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY day) AS nth FROM d WHERE CASE {RULE}
    WHEN 0 THEN day = s
    WHEN 1 THEN (day - s) % 3 = 0
    WHEN 2 THEN isodow(day) IN (1, 3)
    WHEN 3 THEN isodow(day) = isodow(s) AND (day - s) % 14 = 0 AND day <= DATE '1999-02-15'
    WHEN 4 THEN day(day) = day(s) AND datediff('month', s, day) % 2 = 0
    WHEN 5 THEN (isodow(day) = 2 AND day(day) BETWEEN 8 AND 14) OR (isodow(day) = 5 AND day(day) > day(last_day(day)) - 7)
    WHEN 6 THEN day(day) = day(s) AND month(day) = month(s)
    WHEN 7 THEN month(day) IN (2, 3) AND ((isodow(day) = 1 AND day(day) > 28) OR (isodow(day) = 7 AND day(day) <= 7))
    WHEN 8 THEN (day - s) % 5 = 0 AND isodow(day) > 5
    ELSE (day - s) % 7 = 0 END),
r AS (SELECT o_orderkey, s, day FROM p WHERE nth <= CASE {RULE} WHEN 1 THEN 500 WHEN 2 THEN 170 WHEN 6 THEN 5 ELSE 100000 END AND NOT ({RULE} = 9 AND day = s + 14) AND day >= DATE '1999-01-01')
"""


def rule_of(key):
    """The rule text of a key."""
    return F.get(F.array(*map(F.lit, RULES)), (key % len(RULES)).cast("int"))


@query(f"WITH {RULE_DAYS} SELECT o_orderkey, day FROM r")
def exp_recurrence(t):
    """Ten kinds of rules, of which some began years before the window."""
    rules = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("start"), rule_of(F.col("o_orderkey")).alias("rrule"))
    rules = rules.withColumn("gone", F.when(F.col("o_orderkey") % len(RULES) == 9, F.array(F.date_add("start", 14))))
    return expand(rules, "start", "rrule", "gone", F.lit("1999-01-01").cast("date"), F.lit("1999-03-31").cast("date")).select("o_orderkey", "day")


@query("SELECT o_orderkey, list_sort(list_distinct([isodow(o_orderdate::DATE) - 1, CAST(o_orderkey % 7 AS BIGINT)])) AS days FROM orders")
def weekday_set(t):
    names = F.array(*(F.lit(d) for d in ("Mondays", "Tues", "Wed", "Thurs", "Friday", "Sat", "Sunday")))
    token = F.concat(F.date_format("o_orderdate", "EEEE"), F.lit(" and "), F.get(names, (F.col("o_orderkey") % 7).cast("int")))
    return t.orders.select("o_orderkey", D.weekday_set(token).cast("array<bigint>").alias("days"))
