"""A run from raw listings to records that can be published: the operators of this package in their order."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import listings, match, review, signals, state
from .tables import cut

#: How records of one day and place are matched.
RECORDS = match.MatchSchema(
    text="title_key", bucket="bucket", rank="rank", id="id",
    field_rules={"title": "priority", "description": "longest", "start": "priority", "end": "priority", "categories": "priority", "price": "first_nonempty", "cancelled": "priority"},
)


def process_run(raw: DataFrame, source: DataFrame, resolved: DataFrame, standing: DataFrame, rules: list[tuple[str, list[str]]], strict: Column, m: match.MatchSchema = RECORDS) -> dict[str, DataFrame]:
    """Tables of a run's new records: ``records`` (merged, with series, scores, gates and publish state), ``bridge``, ``series``.

    raw, source and resolved are as ``listings.normalize`` takes them; source also has venue_optional and
    under (pulled short). standing(id, title_key, bucket) are the records that stand already, a bucket being
    a day and a place. Listings are normalized, matched against each other and those that stand in order of
    their source's rank, merged field by field, put into series by title and place, scored by independent sources,
    and held or published by their gates. What matched a standing record is in the bridge alone.
    """
    found = listings.normalize(raw, source, resolved, rules)
    key = F.substring(F.sha1(F.concat_ws("|", "source", "external_id").cast("binary")), 1, 16)
    found = cut(found.withColumns({"id": key, "bucket": F.concat_ws("|", "day", "venue_key")}))
    matched = match.leader_match(standing, found, m)
    joined = cut(found.join(matched.select("id", "decision", F.col("leader").alias("entity"), F.col("candidate").alias("near")), "id"))
    tiers = source.select("source", "tier", "curated", "venue_optional", "under")
    bridge = joined.select("entity", "source", "external_id", "info_url").join(tiers, "source").withColumn("origin_tier", F.lit(None).cast("string"))

    born = joined.join(standing.select(F.col("id").alias("entity")), "entity", "left_anti")
    merged = match.merge(born, "entity", m, list(m.field_rules))
    first = match.winner(born, "entity", m)
    own = first.select("entity", "title_key", "day", "slug", "venue_name", "venue_key", "city", "regions", "rank", (F.col("decision") == "ambiguous").alias("ambiguous"), F.when(F.col("decision") == "ambiguous", F.col("near")).alias("candidate"))
    new = merged.join(own, "entity")

    by_place = replace(m, bucket="venue_key", id="entity", text="title_key", rank="rank")
    places = match.leader_match(new.where("false"), new, by_place).select("entity", F.col("leader").alias("series"))
    heads = new.join(places.where("entity = series").select("entity"), "entity").select(F.col("entity").alias("series"), "title", "venue_key", T.slugify(F.col("title")).alias("slug_base"))
    series = state.unique_slugs(heads.withColumn("place", F.regexp_replace("venue_key", "[^a-z0-9]+", "-")), "slug_base", "place", "series").select("series", "title", "venue_key", F.col("unique_slug").alias("slug"))

    scores = signals.evidence_counts(bridge, "entity", "source", F.lit(False))
    status = F.when(F.col("cancelled"), "cancelled").otherwise("active")
    records = new.join(places, "entity").join(scores, "entity").withColumns({"status": status, "venue_id": F.col("slug"), "date_confident": F.lit(True)})
    gated = review.gates(records, bridge, "entity")
    published = review.publish_state(F.col("status") == "cancelled", F.lit(False), review.blocking(), strict)
    out = records.drop("ambiguous").join(gated, "entity").withColumn("publish_state", published)
    return {"records": out, "bridge": bridge, "series": series}
