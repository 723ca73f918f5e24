"""Cross-run state: misses, reschedules, cancellation flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .signals import effective_tier, tier_rank


def consecutive_misses(runs: DataFrame, bridge: DataFrame, sightings: DataFrame, run: str, key: list[str]) -> DataFrame:
    """Per (run, bridge row) how many runs in a row, up to this one, did not see it (0 where seen).

    runs(run) are the healthy runs; a row counts from its first sighting on. A sighting reaches until the next
    one of its row; the runs between are counted from the runs' numbers, so no row meets runs that another
    sighting covers. Runs are few (one per pull of a source).
    """
    numbered = runs.distinct().withColumn("_at", F.row_number().over(W.orderBy(run)))
    seen = sightings.select(run, *key).distinct().join(bridge.select(*key).distinct(), key, "left_semi").join(numbered, run)
    until = F.coalesce(F.lead("_at").over(W.partitionBy(*key).orderBy("_at")), numbered.agg(F.max("_at")).scalar() + 1)
    spans = seen.select(*key, F.col("_at").alias("_from"), until.alias("_until"))
    each = spans.select(*key, "_from", F.explode(F.sequence("_from", F.col("_until") - 1)).alias("_at"))
    return each.join(numbered, "_at").select(run, *key, (F.col("_at") - F.col("_from")).alias("misses"))


def mark_misses(state: DataFrame, seen: DataFrame, healthy: DataFrame, key: list[str], source: str) -> DataFrame:
    """Next state of (key, source, misses): 0 where seen, one more where a healthy source missed it, else unchanged."""
    flags = state.join(seen.select(*key).distinct().withColumn("_seen", F.lit(True)), key, "left").join(healthy.select(source).distinct().withColumn("_ok", F.lit(True)), source, "left")
    next_ = F.when(F.col("_seen"), 0).when(F.col("_ok"), F.col("misses") + 1).otherwise(F.col("misses"))
    return flags.withColumn("misses", next_).drop("_seen", "_ok")


def not_seen_now(earlier: DataFrame, now: DataFrame, key: list[str]) -> DataFrame:
    """Rows that an earlier run saw and this one doesn't."""
    return earlier.join(now.select(*key).distinct(), key, "left_anti")


def seen_now(rows: DataFrame, now: DataFrame, key: str, out: str = "seen") -> DataFrame:
    """Rows with whether this run saw their key."""
    return rows.join(now.select(key).distinct().withColumn(out, F.lit(True)), key, "left").withColumn(out, F.col(out).isNotNull())


def trusted_sources(results: DataFrame, source: str) -> DataFrame:
    """Sources whose misses mean something: pulled without error, with rows, not short of them, and not marked as untrusted.

    results(source, status, n, underdelivered, trust_misses); a null trust_misses trusts.
    """
    return results.where((F.col("status") == "ok") & (F.col("n") > 0) & ~F.coalesce("underdelivered", F.lit(False)) & F.coalesce("trust_misses", F.lit(True))).select(source)


def verdicts(bridge: DataFrame, records: DataFrame, results: DataFrame, as_of, need: int = 2, within: int = 7) -> tuple[DataFrame, DataFrame]:
    """(bridge with its next misses, records with their next status) after a run.

    bridge(record, source, tier, origin_tier, misses, seen), records(record, title_key, venue_key, day, start,
    status). Only active records that start after ``as_of`` count, and only misses of trusted sources. A row
    at ``need`` misses decides: a record that its source lists this run under the same title and venue within so
    many days has moved and is cancelled; else it is flagged, unless a source at least as good still sees it.
    Sources speak in their order; once one has decided, later ones no longer miss the record.
    """
    live = records.where((F.col("status") == "active") & (F.col("start") > as_of))
    missing = bridge.where("NOT seen").join(trusted_sources(results, "source"), "source").join(live.select("record", "title_key", "venue_key", "day"), "record")
    due = missing.where(F.col("misses") + 1 >= need)
    now = bridge.where("seen").join(records.where("status = 'active'").select("record", F.col("title_key").alias("_t"), F.col("venue_key").alias("_v"), F.col("day").alias("_d")), "record")
    now = now.select(F.col("record").alias("_r"), F.col("source").alias("_s"), "_t", "_v", "_d")
    same = (F.col("source") == F.col("_s")) & (F.col("title_key") == F.col("_t")) & (F.col("venue_key") == F.col("_v")) & (F.col("record") != F.col("_r"))
    elsewhere = due.where("title_key <> ''").join(now, same & (F.abs(F.datediff("day", "_d")) <= within), "left_semi").select("record", "source").withColumn("verdict", F.lit("cancelled"))
    flagged = should_flag(bridge, due, "record", "source").withColumn("verdict", F.lit("flagged_cancelled"))
    said = elsewhere.unionByName(flagged.join(elsewhere.select("record", "source"), ["record", "source"], "left_anti"))
    first = said.groupBy("record").agg(F.min("source").alias("_by"), F.min_by("verdict", "source").alias("verdict"))
    counted = missing.select("record", "source").join(first, "record", "left").where("_by IS NULL OR source <= _by").select("record", "source").withColumn("_missed", F.lit(1))
    misses = F.when(F.col("seen"), 0).otherwise(F.col("misses") + F.coalesce("_missed", F.lit(0)))
    after = bridge.join(counted, ["record", "source"], "left").withColumn("misses", misses).drop("_missed")
    return after, records.join(first, "record", "left").withColumn("status", F.coalesce("verdict", "status")).drop("_by", "verdict")


def moved(records: DataFrame, keys: list[str], day: str, id_: str, seen: str, within: int = 7) -> DataFrame:
    """Records that another record of equal keys, seen this run, replaces within so many days."""
    a, b = records.alias("a"), records.where(F.col(seen)).alias("b")
    on = F.col(f"a.{id_}") != F.col(f"b.{id_}")
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    on = on & (F.abs(F.datediff(f"a.{day}", f"b.{day}")) <= within)
    return a.join(b, on, "left_semi")


def should_flag(bridge: DataFrame, missing: DataFrame, record: str, source: str) -> DataFrame:
    """Missing rows (record, source) that no other source seen this run contradicts: none of their rank or better.

    A row ranks by its tier, or as tier A if it names an origin of tier A. bridge and missing hold record,
    source, tier, origin_tier; bridge also seen.
    """
    rank = lambda: tier_rank(effective_tier(F.col("tier"), F.col("origin_tier")))
    seen = bridge.where("seen").groupBy(record, source).agg(F.min(rank()).alias("t"))
    # The best source and the best of another source are all that a row can need.
    best = seen.groupBy(record).agg(F.min(F.struct("t", F.col(source).alias("s"))).alias("best"))
    other = seen.join(best, record).where(F.col(source) != F.col("best.s")).groupBy(record).agg(F.min("t").alias("other"))
    rest = missing.select(record, source, rank().alias("own")).join(best.join(other, record, "left"), record, "left")
    against = F.when(F.col("best.s") == F.col(source), F.col("other")).otherwise(F.col("best.t"))
    return rest.where(against.isNull() | (against > F.col("own"))).select(record, source).distinct()
