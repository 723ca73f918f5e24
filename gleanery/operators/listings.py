"""Raw listings and records: filters, picks, lookups and the projection of a raw record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from .signals import source_rank


def attach(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Rows with a dimension's columns by key; with ``left`` rows that it doesn't know have nulls."""
    return rows.join(table, key, how)


def label_of(rows: DataFrame, labels: DataFrame, key: str, out: str, default: str | None = None) -> DataFrame:
    """Rows with the label that labels(key, out) gives their key, else the default."""
    told = rows.join(labels, key, "left")
    return told if default is None else told.withColumn(out, F.coalesce(out, F.lit(default)))


def with_known(rows: DataFrame, seen: DataFrame, key: str, out: str = "known") -> DataFrame:
    """Rows with whether the source key stands already."""
    return rows.join(seen.select(key).distinct().withColumn(out, F.lit(True)), key, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def first_filled(*values: Column, default: Column | None = None) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), *([default] if default is not None else []))


def rich_description(fields: list[Column], plain: Column, least: int = 20) -> Column:
    """The first field that holds markup and more than so many characters, else the plain text."""
    return F.coalesce(*(F.when(F.contains(f, F.lit("<")) & (F.length(f) > least), f) for f in fields), plain)


def origin_of(rows: DataFrame, urls: Column, known: DataFrame, id_: str) -> DataFrame:
    """(id, origin) of the first of a row's urls whose site known(domain, origin) holds."""
    tried = rows.select(id_, F.posexplode(urls).alias("pos", "domain"))
    return tried.join(known, "domain").groupBy(id_).agg(F.min_by("origin", "pos").alias("origin"))


def blocking_key(venue: Column, fallback: Column) -> Column:
    """What a record's bucket is keyed by: its place if it has one, else the fallback."""
    return first_filled(venue, default=fallback)


def regions_or(own: Column, fallback: Column) -> Column:
    """A record's own regions, else its source's."""
    return F.when(F.size(own) > 0, own).otherwise(fallback)


def complete(rows: DataFrame, *required: str) -> DataFrame:
    """Rows that have every required field."""
    return rows.na.drop("any", subset=list(required))


def without_titles(rows: DataFrame, title: str, patterns: list[str]) -> DataFrame:
    """Rows whose title no pattern finds, whatever its case."""
    for p in patterns:
        rows = rows.where(~F.col(title).rlike(f"(?i){p}"))
    return rows


def in_window(day: Column, today: Column, days: int, back: int = 0) -> Column:
    """From so many days back to so many ahead."""
    return day.between(F.date_sub(today, back), F.date_add(today, days))


def short_enough(starts: Column, ends: Column, days: int) -> Column:
    """A listing that lasts longer is no event but a season."""
    return F.datediff(ends, starts) <= days


def upcoming(rows: DataFrame, day: str, today: Column) -> DataFrame:
    return rows.where(F.col(day) >= today)


def not_ended(rows: DataFrame, last_day: Column, today: Column) -> DataFrame:
    return rows.where(last_day >= today)


def multi_day(first: Column, last: Column, open_: Column) -> Column:
    """Whether an open record spans more than a day."""
    return (last > first) & open_


def publishable(rows: DataFrame, state: str, status: str, shown: list[str]) -> DataFrame:
    """Published rows of a status that is shown."""
    return rows.where(F.col(state) & F.col(status).isin(shown))


def happy_hours(rows: DataFrame, windows: str, status: str) -> DataFrame:
    """Places with a window whose entry somebody has checked."""
    return rows.where((F.col(status) != "unverified") & (F.size(windows) > 0))


def image_of(has: Column, url: Column) -> Column:
    """The image's address where a source has one, else null."""
    return F.when(has, F.nullif(url, F.lit("")))


def organizers(bridge: DataFrame, raw: DataFrame, key: str, payload: str) -> DataFrame:
    """Bridge rows with the organizer that their raw payload names."""
    told = raw.select(key, F.get_json_object(payload, "$.organizer").alias("organizer"))
    return bridge.join(told, key, "left")


# Fixed value: so much of a description tells a category.
DESCRIPTION_LETTERS = 400
#: Columns of a raw listing that a reader may leave out, and what they are then.
OPTIONAL = {
    "website": "string", "ticket_url": "string", "image_url": "string", "image_credit": "string", "html": "string", "source_categories": "array<string>", "date_confident": "boolean",
}
#: Columns of a source that the caller may leave out: the place that it is about, and its full name.
OPTIONAL_SOURCE = {"default_slug": "string", "default_city": "string", "default_regions": "array<string>", "credit": "string", "name": "string"}


def _with_optional(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns})


def with_scheme(url: Column) -> Column:
    """A link that names its scheme: 'site.example/x' would else be a path of our own."""
    bare = F.coalesce(url, F.lit(""))
    return F.when(bare == "", "").when(F.contains(bare, F.lit("://")), bare).otherwise(F.concat(F.lit("https://"), F.regexp_replace(bare, "^/+", "")))


def with_origins(raw: DataFrame, origins: DataFrame) -> DataFrame:
    """Listings with the origin that one of their links leads to: the first of website, ticket link and (unless the source itself
    is of tier A) info link on a known site. origins(domain, origin_slug, origin_city, origin_regions); rows without one have nulls and an empty origin_url."""
    key = ["source", "external_id"]
    links = F.array(with_scheme(F.col("website")), with_scheme(F.col("ticket_url")), F.when(F.col("tier") != "A", with_scheme(F.col("info_url"))).otherwise(""))
    tried = raw.select(*key, F.posexplode(links).alias("pos", "url")).where("url <> ''").withColumn("domain", T.domain_of(F.col("url")))
    hit = F.struct("url", "origin_slug", "origin_city", "origin_regions")
    found = tried.join(origins, "domain").groupBy(*key).agg(F.min_by(hit, "pos").alias("o"))
    return raw.join(found, key, "left").select("*", F.coalesce("o.url", F.lit("")).alias("origin_url"), F.when(F.col("o").isNotNull(), "A").alias("origin_tier"), "o.origin_slug", "o.origin_city", "o.origin_regions").drop("o")


def normalize(raw: DataFrame, source: DataFrame, resolved: DataFrame, rules: list[tuple[str, list[str]]], origins: DataFrame | None = None) -> DataFrame:
    """Raw listings as records; rows without a title or a start are refused.

    raw(source, external_id, title, starts, ends, all_day, time_tba, zone, venue_name, address, city, regions,
    description, price, info_url, cancelled and, if given, the columns of ``OPTIONAL``) has local times; source(source,
    name, tier, curated, source_regions and, if given, those of ``OPTIONAL_SOURCE``); resolved(source, external_id, slug, place_city,
    place_regions) are the places that the resolver found. Times become UTC, an unknown zone counts as the default one;
    an end that is missing or not after the start is set by rule, at the start's own offset. A listing without a place takes, if it
    names none itself, that of the site its links lead to (``origins``, see ``with_origins``), else the one that its source is about.
    Regions are the place's, else the listing's, else the source's; markup wins over the plain description; a record is keyed by
    its place, else by the name or address that the source gives. Categories come from the source's own,
    then the title, then the beginning of the description. rank orders records of an entity.
    """
    j = _with_optional(raw, OPTIONAL).join(_with_optional(source, OPTIONAL_SOURCE), "source").join(resolved, ["source", "external_id"], "left")
    if origins is None:
        nothing = {"origin_url": F.lit(""), "origin_tier": F.lit(None).cast("string"), "origin_slug": F.lit(None).cast("string"), "origin_city": F.lit(None).cast("string"), "origin_regions": F.lit(None).cast("array<string>")}
        j = j.withColumns(nothing)
    else:
        j = with_origins(j, origins)
    unnamed = F.col("slug").isNull() & (F.coalesce("venue_name", F.lit("")) == "")
    by_link = unnamed & F.col("origin_slug").isNotNull()
    by_source = unnamed & ~by_link & F.col("default_slug").isNotNull()
    pick = lambda own, link, source: F.when(by_link, F.col(link)).when(by_source, F.col(source)).otherwise(F.col(own))
    j = j.withColumns({"slug": pick("slug", "origin_slug", "default_slug"), "place_city": pick("place_city", "origin_city", "default_city"), "place_regions": pick("place_regions", "origin_regions", "default_regions")})
    zone = D.known_zone(F.col("zone"))
    start, told = D.to_utc(F.col("starts"), zone), D.to_utc(F.col("ends"), zone)
    end = F.when(told > start, told).otherwise(D.default_end(F.col("starts"), F.col("all_day") | F.col("time_tba"), start))
    named = F.concat(F.lit("k:"), first_filled(T.norm_key(F.col("venue_name")), T.norm_key(F.col("address")), default=F.lit("")))
    rich = rich_description([F.col("html")], F.lit(None).cast("string"))
    body = F.coalesce(F.when(rich.isNotNull(), T.strip_html(rich)), F.col("description"), F.lit(""))
    text = lambda c: F.coalesce(c, F.lit(""))
    out = j.select(
        "source",
        "external_id",
        T.clean_title(F.col("title")).alias("title"),
        T.title_key(F.col("title")).alias("title_key"),
        start.alias("start"),
        end.alias("end"),
        zone.alias("zone"),
        F.to_date("starts").alias("day"),
        "all_day",
        "time_tba",
        F.coalesce("date_confident", F.lit(True)).alias("date_confident"),
        "slug",
        first_filled(F.col("venue_name"), default=F.col("address")).alias("venue_name"),
        F.coalesce(F.concat(F.lit("v:"), F.col("slug")), named).alias("venue_key"),
        F.coalesce("place_city", "city", F.lit("")).alias("city"),
        F.coalesce(F.when(F.size("place_regions") > 0, F.col("place_regions")), F.when(F.size("regions") > 0, F.col("regions")), "source_regions").alias("regions"),
        body.alias("description"),
        text("price").alias("price"),
        text("ticket_url").alias("ticket_url"),
        text("info_url").alias("info_url"),
        "origin_url",
        "origin_tier",
        text("image_url").alias("image_url"),
        F.coalesce("image_credit", "credit", "name").alias("image_credit"),
        T.classify_all([F.array_join(F.coalesce("source_categories", F.array().cast("array<string>")), " "), F.col("title"), F.substring(text("description"), 1, DESCRIPTION_LETTERS)], rules, "other").alias("categories"),
        F.coalesce("cancelled", F.lit(False)).alias("cancelled"),
        source_rank(F.col("tier"), F.col("curated"), F.col("source")).alias("rank"),
    )
    return out.where((F.col("title") != "") & F.col("start").isNotNull())
