"""Evidence per record: source ranks, independent counts, cadence, images, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def tier_rank(tier: Column) -> Column:
    return F.when(tier == "A", 0).when(tier == "B", 1).when(tier == "C", 2).otherwise(9)


def effective_tier(tier: Column, origin_tier: Column) -> Column:
    return F.when(origin_tier == "A", F.lit("A")).otherwise(tier)


def source_rank(tier: Column, curated: Column, source: Column) -> Column:
    return F.struct(tier_rank(tier).alias("tier"), (~F.coalesce(curated, F.lit(False))).alias("plain"), source.alias("source"))


def first_of(df: DataFrame, key: list[str], *order) -> DataFrame:
    """The first row of each key in this order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def top_k(df: DataFrame, key: list[str], k: int, *order) -> DataFrame:
    """The first k rows of each key with their rank, and ``more``: how many rows the key has beyond them."""
    w = W.partitionBy(*key)
    ranked = df.withColumn("rank", F.row_number().over(w.orderBy(*order))).withColumn("more", F.greatest(F.count("*").over(w) - k, F.lit(0)))
    return ranked.where(F.col("rank") <= k)


def primary_source(bridge: DataFrame, sources: DataFrame, record: str, source: str) -> DataFrame:
    """The best bridge row of each record: tier, then curated, then source id."""
    known = bridge.join(sources, source)
    return first_of(known, [record], tier_rank(effective_tier(F.col("tier"), F.col("origin_tier"))), ~F.col("curated"), source)


def evidence_counts(bridge: DataFrame, record: str, source: str, promoted: Column) -> DataFrame:
    """Distinct sources that don't promote themselves, all and curated ones."""
    own = F.when(~promoted, F.col(source))
    return bridge.groupBy(record).agg(F.count_distinct(own).alias("independent_source_count"), F.count_distinct(F.when(F.col("curated"), own)).alias("curation_score"))


def cadence(days: DataFrame, series: str, day: str) -> DataFrame:
    """Cadence of each series from the gaps of more than a day between its distinct days."""
    gap = F.datediff(day, F.lag(day).over(W.partitionBy(series).orderBy(day)))
    gaps = days.select(series, day).distinct().withColumn("gap", gap).withColumn("gap", F.when(F.col("gap") > 1, F.col("gap")))
    g = F.col("gap")
    found = gaps.groupBy(series).agg(
        F.count(g).alias("n"), F.max(g.between(340, 390)).alias("annual"), F.min(g <= 8).alias("weekly"), F.min(g.between(26, 35)).alias("monthly"), F.min(g.between(12, 16)).alias("biweekly")
    )
    two = F.col("n") >= 2
    kind = F.when(F.col("n") == 0, "one_off").when(F.col("annual"), "annual").when(two & F.col("weekly"), "weekly").when(two & (F.col("monthly") | F.col("biweekly")), "monthly").otherwise("irregular")
    return found.select(series, kind.alias("cadence"))


def most_common(df: DataFrame, key: str, value: str, latest: str) -> DataFrame:
    """Each key's most frequent value; ties go to the one seen last."""
    counted = df.groupBy(key, value).agg(F.count("*").alias("n"), F.max(latest).alias("latest"))
    return first_of(counted, [key], F.desc("n"), F.desc("latest"), value).select(key, value)


def best_image(bridge: DataFrame, record: str, never: str) -> DataFrame:
    """Best image of each record by effective tier, curation and bridge id, never one of source ``never``; records without one stay, with null."""
    usable = bridge.where((F.col("image_url") != "") & (F.col("source_id") != never))
    best = first_of(usable, [record], tier_rank(effective_tier(F.col("tier"), F.col("origin_tier"))), ~F.col("curated"), "bridge_id").select(record, "image_url")
    return bridge.select(record).distinct().join(best, record, "left")


def source_health(pulls: DataFrame, registry: DataFrame, source: str) -> DataFrame:
    """Per registered source its pulls, whether they fall short, and the last good one; sources without a pull too."""
    got = pulls.groupBy(source).agg(F.count("*").alias("n"), F.max("pulled_at").alias("last_pull"))
    n = F.coalesce("n", F.lit(0))
    return registry.join(got, source, "left").select(source, "expected_min", n.alias("n"), (n < F.col("expected_min")).alias("underdelivered"), "last_pull")


def alerts(health: DataFrame, source: str, as_of: Column, stale_weeks: int = 3) -> DataFrame:
    """Rows (source, kind): failed, skipped or underdelivered exclude each other; stale stands beside them."""
    kind = F.when(F.col("status") == "failed", "failed").when(F.col("status") == "skipped", "skipped").when(F.col("underdelivered"), "underdelivered")
    stale = health.where(F.col("last_pull") < as_of - F.expr(f"INTERVAL {7 * stale_weeks} DAYS")).select(source, F.lit("stale").alias("kind"))
    return health.select(source, kind.alias("kind")).where("kind IS NOT NULL").unionByName(stale)


def alerting(alerts: DataFrame) -> DataFrame:
    """Alerts that are worth a message: a source that was skipped on purpose is none."""
    return alerts.where("kind <> 'skipped'")


def run_stats(listings: DataFrame) -> DataFrame:
    """One row of a run's counters over its listings (known, decision): refreshed (their source row stood already), and of
    the others merged, created (new or ambiguous) and ambiguous."""
    fresh = ~F.col("known")
    counter = {"refreshed": F.col("known"), "merged": fresh & (F.col("decision") == "match"), "created": fresh & (F.col("decision") != "match"), "ambiguous": fresh & (F.col("decision") == "ambiguous")}
    return listings.agg(F.count("*").alias("listings"), *(F.count_if(c).alias(name) for name, c in counter.items()))


def source_list(bridge: DataFrame, record: str) -> DataFrame:
    """(record, links, sources): the ranked (name, url, tier) of its sources that have a link, and the ids of all.

    bridge(record, source_id, name, url, tier, origin_tier, curated) has a row per record and source; a record's sources are few.
    """
    tier = effective_tier(F.col("tier"), F.col("origin_tier"))
    entry = F.struct(tier_rank(tier).alias("rank"), (~F.col("curated")).alias("plain"), F.col("source_id").alias("id"), F.col("name").alias("name"), F.col("url").alias("url"), tier.alias("tier"))
    linked = F.array_sort(F.collect_list(F.when(F.coalesce(F.col("url"), F.lit("")) != "", entry)))
    return bridge.groupBy(record).agg(F.transform(linked, lambda s: F.struct(s["name"].alias("name"), s["url"].alias("url"), s["tier"].alias("tier"))).alias("links"), F.array_sort(F.collect_set("source_id")).alias("sources"))


def any_source(bridge: DataFrame, record: str, kind: Column, out: str = "found") -> DataFrame:
    """Whether any source of a record is of a kind."""
    return bridge.groupBy(record).agg(F.bool_or(kind).alias(out))
