"""Recurrence rules (RRULE texts) as dates in a window, in Column expressions alone.

A rule is a grid of periods (days, weeks, months or years, each so many apart) and the dates that it picks in each:
weekdays, with an ordinal or without, or the start's own day. Without COUNT the grid begins just before the window,
however old the rule is; with COUNT it begins at the start, and ends once the count must be reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The weekdays of BYDAY, Monday first.
WEEKDAYS = ("MO", "TU", "WE", "TH", "FR", "SA", "SU")
#: Periods that a rule may need for each date that counts: a month without the day, a leap day, a day off the weekdays.
_PERIODS_PER_DATE = {"DAILY": 7, "WEEKLY": 1, "MONTHLY": 12, "YEARLY": 8}


def let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rule(text: Column) -> Column:
    """struct(freq, every, count, until, days array<struct(nth, day)>, months array<int>) of an RRULE; a rule of another frequency, or none, has a null freq."""
    upper = F.upper(F.coalesce(text, F.lit("")))
    part = lambda name: F.nullif(F.regexp_extract(upper, rf"(?:^|;){name}=([^;]+)", 1), F.lit(""))
    freq = part("FREQ")
    token = r"^([+-]?\d*)(MO|TU|WE|TH|FR|SA|SU)$"
    names = F.array(*map(F.lit, WEEKDAYS))
    day = lambda t: F.struct(F.nullif(F.regexp_extract(t, token, 1), F.lit("")).cast("int").alias("nth"), (F.array_position(names, F.regexp_extract(t, token, 2)).cast("int") - 1).alias("day"))
    listed = lambda name: F.filter(F.split(F.coalesce(part(name), F.lit("")), ","), lambda t: t != "")
    return F.struct(
        F.when(freq.isin(*_PERIODS_PER_DATE), freq).alias("freq"),
        F.greatest(F.coalesce(part("INTERVAL").try_cast("int"), F.lit(1)), F.lit(1)).alias("every"),
        part("COUNT").try_cast("int").alias("count"),
        F.to_date(F.try_to_timestamp(F.substring(part("UNTIL"), 1, 8), F.lit("yyyyMMdd"))).alias("until"),
        F.transform(F.filter(listed("BYDAY"), lambda t: t.rlike(token)), day).alias("days"),
        F.transform(listed("BYMONTH"), lambda t: t.try_cast("int")).alias("months"),
    )


def _weekdays_of(first: Column, last: Column, nth: Column, day: Column) -> Column:
    """Dates of a weekday in [first, last]: all, or the nth from the start (from the end if negative), none if there are fewer."""
    head = F.date_add(first, F.pmod(day - F.weekday(first), F.lit(7)))
    tail = F.date_sub(last, F.pmod(F.weekday(last) - day, F.lit(7)))
    one = F.when(nth > 0, F.date_add(head, (nth - 1) * 7)).when(nth < 0, F.date_add(tail, (nth + 1) * 7))
    all_ = F.transform(F.sequence(F.lit(0), F.greatest(F.datediff(tail, head), F.lit(0)).cast("int"), F.lit(7)), lambda i: F.date_add(head, i))
    return F.filter(F.when(nth.isNull(), all_).otherwise(F.array(one)), lambda d: d.between(first, last))


def dates(start: Column, r: Column, first: Column, last: Column) -> Column:
    """Ascending dates of rule struct r from start on that lie in [first, last]; a null freq gives the start alone.

    COUNT counts from the start, whether or not a date lies in the window. Weeks begin on Monday.
    """
    freq, every = r["freq"], r["every"]
    end = F.least(last, F.coalesce(r["until"], last))
    week, month, year = F.date_sub(start, F.weekday(start)), F.trunc(start, "month"), F.trunc(start, "year")
    months = lambda a, b: (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)

    def grid(base: Column, apart, of) -> Column:
        """Dates that ``of`` picks in each period; ``apart`` counts periods from base to a date."""
        most = r["count"] * _PERIODS_PER_DATE[of.freq] + _PERIODS_PER_DATE[of.freq]
        low = F.when(r["count"].isNull(), F.greatest(F.lit(0), F.floor(apart(base, first) / every).cast("int") - 1)).otherwise(0)
        high = F.least(F.floor(apart(base, end) / every).cast("int"), F.coalesce(most, F.lit(2**31 - 1)))
        return F.when(high < low, F.array().cast("array<date>")).otherwise(F.flatten(F.transform(F.sequence(low, high), lambda i: of(i * every))))

    def picked(freq_name: str):
        def put(f):
            f.freq = freq_name
            return f

        return put

    fits_month = lambda d: (F.size(r["months"]) == 0) | F.array_contains(r["months"], F.month(d))

    @picked("DAILY")
    def daily(i: Column) -> Column:
        d = F.date_add(start, i)
        return F.filter(F.array(d), lambda d: (F.size(r["days"]) == 0) | F.exists(r["days"], lambda x: x["day"] == F.weekday(d)))

    @picked("WEEKLY")
    def weekly(i: Column) -> Column:
        monday = F.date_add(week, i * 7)
        named = F.array_distinct(F.transform(r["days"], lambda x: x["day"]))
        return F.transform(F.when(F.size(named) > 0, named).otherwise(F.array(F.weekday(start))), lambda d: F.date_add(monday, d))

    def inside(low: Column, high: Column, own: Column, same: Column) -> Column:
        by_day = F.flatten(F.transform(r["days"], lambda x: _weekdays_of(low, high, x["nth"], x["day"])))
        return F.when(F.size(r["days"]) > 0, by_day).otherwise(F.filter(F.array(own), lambda d: same))

    @picked("MONTHLY")
    def monthly(i: Column) -> Column:
        low = F.add_months(month, i)
        own = F.date_add(low, F.dayofmonth(start) - 1)
        return inside(low, F.last_day(low), own, F.month(own) == F.month(low))

    @picked("YEARLY")
    def yearly(i: Column) -> Column:
        low = F.add_months(year, i * 12)
        # With BYMONTH, weekdays count within those months, else within the year.
        spans = F.when(F.size(r["months"]) > 0, F.transform(r["months"], lambda m: F.struct(F.add_months(low, m - 1).alias("a"), F.last_day(F.add_months(low, m - 1)).alias("b")))).otherwise(
            F.array(F.struct(low.alias("a"), F.date_sub(F.add_months(low, 12), 1).alias("b")))
        )
        own_month = lambda m: F.add_months(low, m - 1)
        by_day = F.flatten(F.transform(spans, lambda s: F.flatten(F.transform(r["days"], lambda x: _weekdays_of(s["a"], s["b"], x["nth"], x["day"])))))
        own = F.transform(F.when(F.size(r["months"]) > 0, r["months"]).otherwise(F.array(F.month(start))), lambda m: F.struct(own_month(m).alias("a"), F.date_add(own_month(m), F.dayofmonth(start) - 1).alias("d")))
        return F.when(F.size(r["days"]) > 0, by_day).otherwise(F.transform(F.filter(own, lambda s: F.month(s["a"]) == F.month(s["d"])), lambda s: s["d"]))

    found = (
        F.when(freq == "DAILY", grid(start, lambda a, b: F.datediff(b, a), daily))
        .when(freq == "WEEKLY", grid(week, lambda a, b: F.floor(F.datediff(b, a) / 7), weekly))
        .when(freq == "MONTHLY", grid(month, months, monthly))
        .when(freq == "YEARLY", grid(year, lambda a, b: F.year(b) - F.year(a), yearly))
        .otherwise(F.array(start))
    )
    fit = F.array_sort(F.array_distinct(F.filter(found, lambda d: (d >= start) & (d <= F.coalesce(r["until"], d)) & fits_month(d))))
    counted = lambda fit: F.when(r["count"].isNotNull() & freq.isNotNull(), F.slice(fit, 1, F.greatest(r["count"], F.lit(0)))).otherwise(fit)
    return F.filter(let(fit, counted), lambda d: d.between(first, last))


def expand(df: DataFrame, start: str, rrule: str, exdates: str | None, first: Column, last: Column, out: str = "day") -> DataFrame:
    """One row per date of each row's rule in [first, last]; exdates, an array of dates, are left out after counting.

    A row without a rule has its start alone; rows without a date in the window go, as do those without a start.
    """
    some = df.where(F.col(start).isNotNull())
    days = let(F.struct(rule(F.col(rrule)).alias("r"), F.col(start).alias("d")), lambda x: dates(x["d"], x["r"], first, last))
    if exdates:
        days = F.array_except(days, F.coalesce(exdates, F.array().cast("array<date>")))
    return some.withColumn(out, F.explode(days))
