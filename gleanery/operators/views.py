"""Published views: ranked lists, groups, rollups, facets, pages, search, feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import signals
from .tables import cut


def featured(pool: DataFrame, series: str, k: int, *order: Column) -> DataFrame:
    """The k best records, at most one of each series, with their place."""
    one = pool.withColumn("_n", F.row_number().over(W.partitionBy(series).orderBy(*order))).where("_n = 1").drop("_n")
    return one.orderBy(*order).limit(k).withColumn("place", F.row_number().over(W.orderBy(*order)))


def group_by_day(rows: DataFrame, day: str, start: str, id_: str, out: str) -> DataFrame:
    """A day's ids in order of their start."""
    return rows.groupBy(day).agg(F.transform(F.array_sort(F.collect_list(F.struct(start, id_))), lambda s: s[id_]).alias(out))


def facet_counts(rows: DataFrame, categories: str, free: str, area: str) -> DataFrame:
    """Rows per category, free rows, rows per area, in one pass: each row gives its facets, which are counted together."""
    facet = lambda kind, value: F.struct(F.lit(kind).alias("facet"), value.cast("string").alias("value"))
    facets = F.concat(F.transform(categories, lambda c: facet("category", c)), F.array(F.when(F.col(free), facet("free", F.lit("free"))), facet("area", F.col(area))))
    flat = rows.select(F.explode(facets).alias("f")).where("f IS NOT NULL AND f.value IS NOT NULL").select("f.*")
    return flat.groupBy("facet", "value").agg(F.count("*").alias("n"))


def facet_filter(rows: DataFrame, chosen: list[str], free: bool, areas: list[str], categories: str, is_free: str, area: str) -> DataFrame:
    """Rows that fit the choices; an empty choice lets all pass."""
    if chosen:
        rows = rows.where(F.arrays_overlap(categories, F.array(*map(F.lit, chosen))))
    if free:
        rows = rows.where(F.col(is_free))
    return rows.where(F.col(area).isin(areas)) if areas else rows


def series_rollup(rows: DataFrame, series: str, day: str, id_: str, today: Column, past: int) -> DataFrame:
    """Per series: upcoming ids by day, the next day, the last one, and the latest past ids."""
    at = F.struct(F.col(day).alias("day"), F.col(id_).alias("id"))
    live = F.col(day) >= today
    ids = lambda c: F.transform(c, lambda s: s["id"])
    # Only the latest past rows are ever collected; the cut is made before the shuffle too.
    latest = top_rows(rows.where(~live), [series], past, F.desc(day), F.desc(id_))
    kept = rows.where(live).select(series, at.alias("at"), F.lit(True).alias("live")).unionByName(latest.select(series, at.alias("at"), F.lit(False).alias("live")))
    return kept.groupBy(series).agg(
        ids(F.array_sort(F.collect_list(F.when(F.col("live"), F.col("at"))))).alias("upcoming"),
        F.min(F.when(F.col("live"), F.col("at.day"))).alias("next"),
        F.max("at.day").alias("last_end"),
        ids(F.sort_array(F.collect_list(F.when(~F.col("live"), F.col("at"))), asc=False)).alias("past"),
    )


def top_rows(rows: DataFrame, key: list[str], k: int, *order) -> DataFrame:
    """The first k rows of each key."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def description_pick(rows: DataFrame, series: str, text: str, day: str, id_: str, today: Column) -> DataFrame:
    """(series, description): the text of its next row that has one, else of its latest past row."""
    live = F.col(day) >= today
    order = F.struct((~live).alias("past"), F.abs(F.datediff(day, today)).alias("far"), F.col(id_).alias("id"))
    return rows.groupBy(series).agg(F.min_by(text, F.when(F.coalesce(F.col(text), F.lit("")) != "", order)).alias("description"))


def place_rollup(rows: DataFrame, place: str, day: str, id_: str, today: Column, past: int = 30) -> DataFrame:
    """Per place: how many rows are to come, and its latest past ids."""
    live = F.col(day) >= today
    latest = top_rows(rows.where(~live), [place], past, F.desc(day), F.desc(id_))
    kept = rows.where(live).select(place, F.lit(True).alias("live"), day, id_).unionByName(latest.select(place, F.lit(False).alias("live"), day, id_))
    gone = F.sort_array(F.collect_list(F.when(~F.col("live"), F.struct(day, id_))), asc=False)
    return kept.groupBy(place).agg(F.count_if("live").alias("upcoming"), F.transform(gone, lambda s: s[id_]).alias("past"))


def place_index(rollup: DataFrame, name: str) -> DataFrame:
    """Places with rows to come, most first, then by name. The index is one page: a row per place."""
    return rollup.where("upcoming > 0").withColumn("place", F.row_number().over(W.orderBy(F.desc("upcoming"), name)).cast("long"))


def list_pages(defs: DataFrame, rows: DataFrame, page: str, id_: str) -> DataFrame:
    """Every page of defs(page, kind, values) with its number of rows; pages without any are not to be indexed.

    kind ``city`` holds rows whose city, whatever its case, is among the values, ``category`` those with one of the categories,
    ``free`` those that are free. rows(id, city, categories, is_free).
    """
    keys = F.concat(F.array(F.concat(F.lit("city:"), F.lower(F.coalesce("city", F.lit(""))))), F.transform("categories", lambda c: F.concat(F.lit("category:"), c)), F.when(F.col("is_free"), F.array(F.lit("free:"))).otherwise(F.array().cast("array<string>")))
    held = rows.select(id_, F.explode(F.array_distinct(keys)).alias("_key"))
    wanted = F.when(F.col("kind") == "free", F.array(F.lit("free:"))).otherwise(F.transform("values", lambda v: F.concat_ws(":", "kind", F.when(F.col("kind") == "city", F.lower(v)).otherwise(v))))
    asked = defs.select(page, F.explode(wanted).alias("_key"))
    # A row counts once on a page however many of its values it has.
    counted = asked.join(held, "_key").select(page, id_).distinct().groupBy(page).agg(F.count("*").alias("n"))
    return defs.select(page).join(counted, page, "left").select(page, F.coalesce("n", F.lit(0)).cast("long").alias("n")).withColumn("noindex", F.col("n") == 0)


def page_counts(**pages: DataFrame) -> DataFrame:
    """(kind, n): the different pages of each kind; the first column of each table names its pages."""
    out = None
    for kind, rows in pages.items():
        own = rows.select(F.lit(kind).alias("kind"), F.col(rows.columns[0]).cast("string").alias("page"))
        out = own if out is None else out.unionByName(own)
    return out.groupBy("kind").agg(F.count_distinct("page").alias("n"))


def pages(defs: DataFrame, rows: DataFrame, key: list[str], id_: str) -> DataFrame:
    """Every defined page with its number of rows; pages without any are not to be indexed."""
    counted = rows.groupBy(*key).agg(F.count(id_).alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return defs.join(counted, key, "left").withColumn("n", n).withColumn("noindex", F.col("n") == 0)


#: Queries of a search that are sent to every task; more meet the rows by a shuffle.
FEW_QUERIES = 10_000


def search(queries: DataFrame, index: DataFrame, limit: int = 50, few: int = FEW_QUERIES) -> DataFrame:
    """Per query (q, tokens) the best index rows (id, title, hay, bonus): all tokens must be in hay.

    A token scores 3 at the title's start, 2 inside it, else 1. Rows are found by the first three letters of
    the query's longest token (fewer if it is shorter), which every match holds, so a query meets only rows
    that have them; the tokens are checked after. The index never goes to the driver: up to ``few`` queries are sent to its rows,
    more meet them in a join that both sides are shuffled for.
    """
    width = 3
    longest = F.array_max(F.transform("tokens", lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))["k"]
    asked = cut(queries.where(F.size("tokens") > 0).withColumn("_gram", F.substring(longest, 1, width)))
    # Rows are cut into pieces of the asked lengths alone: mostly of three letters.
    counted = asked.groupBy(F.length("_gram").alias("n")).count().collect()
    lengths = sorted(r.n for r in counted if r.n is not None)
    pieces = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("hay") - n + 1, F.lit(1))), lambda i: F.substring(F.col("hay"), i, F.lit(n)))
    grams = F.array_distinct(F.concat(*map(pieces, lengths))) if lengths else F.array().cast("array<string>")
    held = index.where(F.length("hay") > 0).withColumn("_gram", F.explode(grams))
    fits = F.forall("tokens", lambda k: F.contains(F.col("hay"), k))
    one = lambda k: F.when(F.startswith(F.col("title"), k), 3.0).when(F.contains(F.col("title"), k), 2.0).otherwise(1.0)
    # Without a hint Spark may take the exploded index, which it judges by the files' size, for the smaller side.
    side = asked.hint("broadcast" if sum(r["count"] for r in counted) <= few else "merge")
    hits = held.join(side, "_gram").where(fits).drop("_gram")
    score = F.aggregate("tokens", F.lit(0.0), lambda a, k: a + one(k)) + F.col("bonus")
    ranked = hits.withColumn("score", score).withColumn("_n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("_n") <= limit).drop("_n")


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows per key."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def ranked_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key with their place, most first. The ranking is one task over the keys, which are names, not rows."""
    return count_by(rows, key).withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), key)).cast("long"))


def round_label(rows: DataFrame, step: int = 5) -> DataFrame:
    """One row: the number of rows rounded down to a step, with a plus if there are more."""
    n = F.count("*")
    return rows.agg(F.concat((F.floor(n / step) * step).cast("string"), F.when(n % step > 0, "+").otherwise("")).alias("label"))


def grouped_items(rows: DataFrame, group: str, id_: str, *order: str) -> DataFrame:
    """(group, items): each group's ids in order. A group is a page: its list fits one."""
    return rows.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, id_))), lambda s: s[id_]).alias("items"))


def item_list_jsonld(rows: DataFrame, group: str, order: list[str], name: str, url: Column, item: Column) -> DataFrame:
    """(group, jsonld): an ItemList whose elements have their position. ``item`` is the struct of an element, ``url`` the group's page."""
    ranked = F.array_sort(F.collect_list(F.struct(*order, item.alias("item"))))
    elements = F.transform(ranked, lambda s, i: F.struct(F.lit("ListItem").alias("@type"), (i + 1).alias("position"), s["item"].alias("item")))
    g = rows.groupBy(group).agg(elements.alias("_items"))
    body = F.struct(F.lit("https://schema.org").alias("@context"), F.lit("ItemList").alias("@type"), F.lit(name).alias("name"), url.alias("url"), F.col("_items").alias("itemListElement"))
    return g.select(group, F.to_json(body).alias("jsonld"))


def event_jsonld(name: Column, start: Column, end: Column, status: Column, place: Column, street: Column, city: Column, price: Column, url: Column) -> Column:
    """A record as schema.org Event; fields without a value are left out, an offer only where there is a price."""
    filled = lambda c: F.nullif(c, F.lit(""))
    state = F.when(status == "cancelled", "https://schema.org/EventCancelled").otherwise("https://schema.org/EventScheduled")
    address = F.struct(F.lit("PostalAddress").alias("@type"), filled(street).alias("streetAddress"), filled(city).alias("addressLocality"))
    where = F.when(filled(place).isNotNull(), F.struct(F.lit("Place").alias("@type"), place.alias("name"), address.alias("address")))
    offer = F.when(filled(price).isNotNull(), F.struct(F.lit("Offer").alias("@type"), price.alias("price"), url.alias("url")))
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit("Event").alias("@type"), name.alias("name"), start.alias("startDate"), end.alias("endDate"), state.alias("eventStatus"), where.alias("location"), offer.alias("offers"), filled(url).alias("url")))


def url_list(*parts: tuple[DataFrame, str, str, Column]) -> DataFrame:
    """(path, lastmod) of pages: each part is (rows, path prefix, key column, last change)."""
    out = None
    for rows, prefix, key, changed in parts:
        own = rows.select(F.concat(F.lit(prefix), F.col(key)).alias("path"), changed.cast("date").alias("lastmod"))
        out = own if out is None else out.unionByName(own)
    return out


def redirects(series: DataFrame, today: Column, target: Column, days: int = 30) -> DataFrame:
    """One-off series with nothing to come whose last day is more than so many days past, with the page that takes their visitors.

    series(cadence, next, last_end).
    """
    return series.where((F.col("cadence") == "one_off") & F.col("next").isNull() & (F.datediff(today, "last_end") > days)).withColumn("target", target)


def report_lines(name: str, rows: DataFrame, k: int | None, line: Column, *order) -> DataFrame:
    """(section, rank, line) rows of a report section, its first k rows or all; a section is short."""
    top = rows.orderBy(*order).limit(k) if k else rows
    return top.select(F.lit(name).alias("section"), F.row_number().over(W.orderBy(*order)).cast("long").alias("rank"), line.alias("line"))


def region_feed(records: DataFrame, bridge: DataFrame, now: Column, shown: dict[str, Column]) -> DataFrame:
    """(region, record): a JSON record of every published, active record that has not ended, for each region whose rule it passes.

    records(id, series_slug, title, start, end, zone, all_day, categories, place struct or null, venue_name, price, ticket_url, info_url,
    image_url, image_credit, curation_score, independent_source_count, publish_state, status) have UTC times; they are told on
    the wall of their zone with its offset. bridge(id, source_id, name, url, origin_url, tier, origin_tier, curated, redistributable)
    gives the best source: its origin or address is the link, else the record's own. ``shown`` has each region's rule over
    the records' columns. Parts without a value are left out. Ready for write.partitionBy("region").text.
    """
    live = records.where((F.col("publish_state") == "published") & (F.col("status") == "active") & (F.col("end") >= now))
    rank = F.struct(signals.tier_rank(signals.effective_tier(F.col("tier"), F.col("origin_tier"))).alias("t"), (~F.col("curated")).alias("p"), "source_id")
    best = bridge.groupBy("id").agg(F.min_by(F.struct("name", "url", "origin_url", "tier", "redistributable"), rank).alias("s"))
    j = live.join(best, "id", "left")

    def told(c: str) -> Column:
        wall = F.from_utc_timestamp(c, F.col("zone"))
        offset = (F.unix_timestamp(wall) - F.unix_timestamp(c)).cast("int")
        sign = F.when(offset < 0, "-").otherwise("+")
        return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), sign, F.format_string("%02d:%02d", F.floor(F.abs(offset) / 3600).cast("int"), F.floor(F.abs(offset) % 3600 / 60).cast("int")))

    filled = lambda c: F.nullif(c, F.lit(""))
    place = F.coalesce(F.col("place"), F.when(filled(F.col("venue_name")).isNotNull(), F.from_json(F.to_json(F.struct(F.col("venue_name").alias("name"))), live.schema["place"].dataType)))
    source = F.when(F.col("s").isNotNull(), F.struct(F.col("s.name").alias("name"), F.col("s.tier").alias("tier"), F.col("s.redistributable").alias("redistributable")))
    image = F.when(filled(F.col("image_url")).isNotNull(), F.struct(F.col("image_url").alias("url"), F.col("image_credit").alias("credit")))
    link = F.coalesce(filled(F.col("s.origin_url")), filled(F.col("s.url")), filled(F.col("info_url")))
    record = F.struct(
        "id", "series_slug", "title", told("start").alias("start"), told("end").alias("end"), "all_day", F.get("categories", F.lit(0)).alias("category"), "categories", place.alias("venue"), "price",
        filled(F.col("ticket_url")).alias("ticket_url"), link.alias("info_url"), source.alias("source"), image.alias("image"), "curation_score", "independent_source_count",
    )
    regions = F.filter(F.array(*(F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in shown.items())), lambda r: r.isNotNull())
    return j.select(F.to_json(record).alias("record"), regions.alias("regions")).select(F.explode("regions").alias("region"), "record")


def ranked_section(name: str, rows: DataFrame, k: int, *order) -> DataFrame:
    """A report section: its first k rows with their rank."""
    top = rows.orderBy(*order).limit(k)
    return top.select(F.lit(name).alias("section"), *rows.columns, F.row_number().over(W.orderBy(*order)).cast("long").alias("rank")).select("section", "id", "n", "rank")


def is_draw(title: Column, words: Column, sources: Column, draw_sources: list[str], never: str, draw: str, limited: list[str], venue_ok: Column) -> Column:
    """Worth a drive: never-words lose, draw words win, else a draw source; limited sources count at big venues only."""
    hits = F.array_intersect(sources, F.array(*map(F.lit, draw_sources)))
    free = F.array_except(hits, F.array(*map(F.lit, limited)))
    return F.when(title.rlike(never), False).when(words.rlike(draw), True).otherwise((F.size(hits) > 0) & (venue_ok | (F.size(free) > 0)))


def shows_on_site(ring: Column, draw: Column, tagged: Column) -> Column:
    return F.when(ring == "core", True).when(ring == "outer", draw).otherwise(tagged)


def open_today(windows: Column, weekday: Column) -> Column:
    return F.exists(windows, lambda w: F.array_contains(w["d"], weekday))


def open_now(windows: Column, weekday: Column, clock: Column) -> Column:
    """Inside a window of today; 'close' ends at 23:59."""
    return F.exists(windows, lambda w: F.array_contains(w["d"], weekday) & (w["s"] <= clock) & (clock < F.when(w["e"] == "close", "23:59").otherwise(w["e"])))
