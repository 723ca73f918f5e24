"""Event objects in the JSON-LD blocks of pages: a walk over VARIANT values, level by level inside each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DEFAULT_ZONE, parse_local
from ..functions.recurrence import let
from ..functions.text import clean_title, join_nonempty, strip_html

#: Levels of lists and objects that a walk goes down.
DEPTH = 8
# The keys whose values are walked, the last named first.
WALKED = ("@graph", "subEvent", "itemListElement")
BLOCK = r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"


def part(v: Column, path: str, kind: str = "string") -> Column:
    """What stands at a path of a VARIANT, null where it is something else."""
    return F.try_variant_get(v, path, kind)


def nodes(doc: Column, depth: int = DEPTH, walked: tuple[str, ...] = WALKED) -> Column:
    """array<struct(path, v)> of the objects in a VARIANT: itself, list elements and values of the walked keys, down to so many levels.

    Ordering by path visits an object before what it holds, the last walked key before the others, and lists from their end.
    """

    def below(node: Column) -> Column:
        v, path = node["v"], node["path"]
        items = F.coalesce(part(v, "$", "array<variant>"), F.array().cast("array<variant>"))
        listed = let(F.struct(items.alias("x"), path.alias("p")), lambda s: F.transform(s["x"], lambda x, i: F.struct(F.array_append(s["p"], F.size(s["x"]) - i).alias("path"), x.alias("v"))))
        held = F.array(*(F.struct(F.array_append(path, F.lit(n)).alias("path"), part(v, f'$["{key}"]', "variant").alias("v")) for n, key in enumerate(reversed(walked))))
        return F.concat(listed, F.filter(held, lambda s: s["v"].isNotNull()))

    def down(level: Column, left: int) -> Column:
        if not left:
            return level
        return F.concat(level, let(F.flatten(F.transform(level, below)), lambda under: down(under, left - 1)))

    root = F.array(F.struct(F.array().cast("array<int>").alias("path"), doc.alias("v")))
    return F.filter(down(root, depth), lambda s: s["v"].isNotNull())


def is_event(v: Column) -> Column:
    """Whether an object's @type, or one of them, ends in Event."""
    types = F.coalesce(part(v, '$["@type"]', "array<string>"), F.array(part(v, '$["@type"]')))
    return F.exists(types, lambda t: F.coalesce(t.endswith("Event"), F.lit(False)))


def event_objects(pages: DataFrame, html: str, *keep: str, depth: int = DEPTH) -> DataFrame:
    """(keep columns, block, path, v): the event objects of each page. A block that is no JSON is tried again with control characters blanked, then skipped."""
    blocks = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(BLOCK), 1)).alias("block", "_text"))
    doc = F.coalesce(F.try_parse_json(F.trim("_text")), F.try_parse_json(F.regexp_replace("_text", r"[\x00-\x1f]", " ")))
    each = blocks.select(*keep, "block", doc.alias("_doc")).where("_doc IS NOT NULL").select(*keep, "block", F.explode(nodes(F.col("_doc"), depth)).alias("_n"))
    return each.select(*keep, "block", F.col("_n.path").alias("path"), F.col("_n.v").alias("v")).where(is_event(F.col("v")))


def _first(v: Column, path: str) -> Column:
    """The value at a path, of a list its first element."""
    return F.coalesce(F.get(part(v, path, "array<variant>"), F.lit(0)), F.when(part(v, path, "array<variant>").isNull(), part(v, path, "variant")))


def wall(text: Column, zone: str) -> Column:
    """Local wall time of an ISO text: with an offset moved to the zone, without one as it stands, another text as ``parse_local`` reads it."""

    def read(s: Column) -> Column:
        offset = s.rlike(r"\d[T ]\d.*(?:[zZ]|[+-]\d{2}:?\d{2})$")
        stamp = F.try_to_timestamp(s)
        return F.coalesce(F.when(offset, F.from_utc_timestamp(stamp, zone)).otherwise(stamp), parse_local(s, F.current_timestamp())["start"])

    return let(text, read)


def events(pages: DataFrame, html: str, source: str, page: str, url: str, first: Column, last: Column, zone: str = DEFAULT_ZONE, max_days: int | None = None, depth: int = DEPTH) -> DataFrame:
    """Raw records of the events in each source's pages; of an id the first in order of page, block and walk.

    ``page`` orders a source's pages, ``url`` is theirs. Events need a name and a start in [first, last]; those of more
    than ``max_days`` go. A place, offer or image may be a list, whose first counts; a place, address or organizer
    may be a text. A price of 0 is Free. The id is ``url:date``, by the event's own url or else the page's.
    """
    n = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * pages.sparkSession.sparkContext.defaultParallelism)
    # A page takes long for its bytes, by which Spark would put pages into few tasks.
    e = event_objects(pages.repartition(n, page), html, source, page, url, depth=depth)
    v = F.col("v")
    # Each step's values are made once: a filter on columns would be moved before them and make them again.
    once = lambda df, ok, **made: df.select("*", F.inline(F.filter(F.array(F.struct(*(c.alias(k) for k, c in made.items()))), ok)))
    e = once(e, lambda r: F.to_date(r["starts"]).between(first, last), starts=wall(part(v, "$.startDate"), zone))
    e = once(e, lambda r: F.coalesce(F.datediff(r["ends"], F.col("starts")) <= max_days, F.lit(True)) if max_days is not None else F.lit(True), ends=wall(part(v, "$.endDate"), zone))
    e = once(e, lambda r: r["title"] != "", title=clean_title(part(v, "$.name")), info_url=F.coalesce(F.nullif(part(v, "$.url"), F.lit("")), url))
    e = e.withColumn("external_id", F.concat_ws(":", "info_url", F.to_date("starts")))
    # The first of an id by one aggregate; no row is kept by chance. Objects travel whole, once, and are read after.
    e = e.groupBy(source, "external_id").agg(F.min_by(F.struct("v", "starts", "ends", "title", "info_url"), F.struct(page, "block", "path")).alias("r")).select(source, "external_id", "r.*")
    e = e.select(
        source, "external_id", "starts", "ends", "title", "info_url",
        part(v, "$.startDate").alias("s"), part(v, "$.description").alias("d"), part(v, "$.eventType").alias("kind"),
        _first(v, "$.location").alias("loc"), _first(v, "$.offers").alias("offer"), _first(v, "$.image").alias("img"), part(v, "$.organizer", "variant").alias("org"),
    )
    # An object's own text is its JSON; only what isn't an object is a text.
    text = lambda c: F.when(part(c, "$", "map<string,variant>").isNull(), part(c, "$"))
    loc, offer, img, org = (F.col(c) for c in ("loc", "offer", "img", "org"))
    address = join_nonempty(", ", part(loc, "$.address.streetAddress"), part(loc, "$.address.addressLocality"))
    price = part(offer, "$.price")
    empty = lambda c: F.coalesce(c, F.lit(""))
    return e.select(
        source,
        "external_id",
        "title",
        "starts",
        "ends",
        (F.length("s") <= 10).alias("all_day"),
        strip_html(F.coalesce(part(loc, "$.name"), text(loc))).alias("venue_name"),
        empty(F.coalesce(F.when(part(loc, "$.address", "map<string,variant>").isNull(), part(loc, "$.address")), address)).alias("address"),
        empty(part(loc, "$.address.addressLocality")).alias("city"),
        strip_html(F.col("d")).alias("description"),
        F.when(price.isin("0", "0.0", "0.00"), "Free").when(price != "", F.concat(F.lit("$"), price)).otherwise("").alias("price"),
        empty(part(offer, "$.url")).alias("ticket_url"),
        "info_url",
        empty(F.coalesce(part(img, "$.url"), text(img))).alias("image_url"),
        empty(F.coalesce(part(org, "$.name"), text(org))).alias("organizer"),
        F.filter(F.array("kind"), lambda k: k.isNotNull() & (k != "")).alias("categories"),
    )
