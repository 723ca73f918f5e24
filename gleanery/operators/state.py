"""Snapshots: upserts, additive schema, overrides, slugs. Each step makes a new DataFrame from the old one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .signals import first_of
from .tables import cut


def upsert(old: DataFrame, new: DataFrame, key: str, config: list[str]) -> DataFrame:
    """Config columns from new where it has the key; other columns and rows absent from new stay."""
    fresh = new.select(key, *(F.col(c).alias(f"_new_{c}") for c in config), F.lit(True).alias("_in"))
    j = old.join(fresh, key, "full_outer")
    cols = [F.when(F.col("_in"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in config else F.col(c) for c in old.columns]
    return j.select(*cols)


def with_columns_of(old: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Adds the columns that old lacks, from their default; columns that are there keep their values."""
    return old.withColumns({c: v for c, v in defaults.items() if c not in old.columns})


def unique_slugs(rows: DataFrame, slug: str, suffix: str, order: str, salt: str | None = None, standing: DataFrame | None = None, settle: bool = True) -> DataFrame:
    """rows with unique_slug, as if they were created one after another in their order (a column without repeats).

    A row takes its slug if no standing(slug) row and no row before it has that, else slug-suffix, else that with six
    digits of its hash and the salt's (by default the order's), else with forty. Without ``settle`` the six digits stand as they
    are, as the reference has it, even where another row has the same. An empty suffix adds nothing. In each round every row
    whose next choice is free takes it, unless a row before it is undecided and may still come to it; so slugs are
    settled against all that stand or come before, in as many rounds as such rows wait for each other.
    """
    salt = salt or order
    two = F.when(F.coalesce(F.col(suffix).cast("string"), F.lit("")) != "", F.concat_ws("-", slug, suffix)).otherwise(F.col(slug))
    digest = F.sha1(F.concat(two, F.col(salt).cast("string")).cast("binary"))
    six, forty = F.concat_ws("-", two, F.substring(digest, 1, 6)), F.concat_ws("-", two, F.sha1(F.concat_ws("|", two, F.col(salt).cast("string"), F.col(order).cast("string")).cast("binary")))
    options = F.array_distinct(F.array(F.col(slug), two, six, *([forty] if settle else [])))
    choices = rows.select(F.col(order).alias("o"), options.alias("all")).select("o", F.posexplode("all").alias("k", "s"), F.size("all").alias("n")).select("o", "k", "s", (F.col("k") == F.col("n") - 1).alias("last"))
    taken = standing.select(F.col("slug").alias("s")).distinct() if standing is not None else choices.select("s").where("false")
    # The last choice is taken whoever has it.
    choices = cut(choices.where("NOT last").join(taken, "s", "left_anti").select("o", "k", "s", "last").unionByName(choices.where("last")))
    done = cut(choices.select("o", "s").where("false"))
    while not choices.isEmpty():
        now = choices.groupBy("o").agg(F.min_by(F.struct("s", "last"), "k").alias("c")).select("o", "c.s", "c.last")
        first = choices.groupBy("s").agg(F.min("o").alias("first"))
        won = cut(now.join(first, "s").where("last OR o = first").select("o", "s"))
        done = cut(done.unionByName(won))
        by = won.groupBy("s").agg(F.min("o").alias("by"))
        choices = cut(choices.join(won.select("o"), "o", "left_anti").join(by, "s", "left").where("last OR by IS NULL OR o < by").select("o", "k", "s", "last"))
    return rows.join(done.select(F.col("o").alias(order), F.col("s").alias("unique_slug")), order)


def find_or_create_series(records: DataFrame, series: DataFrame, m, id_: str) -> tuple[DataFrame, DataFrame]:
    """((id, series), new series) for records, in the order of m: the series at the same place whose title is most alike, else a new one.

    records(id, rank, title, title_key, venue_key, place_slug, day); series(series, title_key, venue_key, slug) stand already. A
    title matches at the threshold of ``m`` or not at all. A new series has the id of the record that founds it, its title and place
    and a slug that neither a standing nor an earlier new series has.
    """
    from dataclasses import replace

    from .match import leader_match

    by_place = replace(m, text="title_key", bucket="venue_key", id=id_, rank="rank", ambiguous_floor=101.0, veto=None)
    kind = dict(records.dtypes)[id_]
    old = series.select(F.col("series").cast(kind).alias(id_), "title_key", "venue_key")
    found = cut(leader_match(old, records, by_place).select(id_, F.col("leader").alias("series")))
    heads = records.join(found.where(F.col(id_) == F.col("series")).select(id_), id_)
    heads = heads.select(F.col(id_).alias("series"), "rank", "title", "title_key", "venue_key", "place_slug", "day", T.slugify(F.col("title")).alias("_base"))
    # Creation order: rank, then id.
    heads = heads.withColumn("_order", F.struct("rank", "series")).withColumn("_salt", F.col("day").cast("string"))
    slugs = unique_slugs(heads, "_base", "place_slug", "_order", "_salt", series.select("slug"))
    return found, slugs.select("series", "title", "title_key", "venue_key", F.col("unique_slug").alias("slug"))


def merge_remap(pairs: DataFrame, ids: DataFrame, id_: str) -> DataFrame:
    """(drop, keep) of a list of merges (pos, keep, drop), applied in the order of pos.

    A pair counts if both ids exist when its turn comes: pairs with an id that is unknown or that an earlier
    counted pair dropped are skipped. A kept id that is dropped later takes what it holds along. Pairs are decided in order
    along their rivals (see ``ordered``), then chains are followed by doubling.
    """
    known = ids.select(id_)
    ok = pairs.where("keep <> drop").join(known.withColumnRenamed(id_, "keep"), "keep", "left_semi").join(known.withColumnRenamed(id_, "drop"), "drop", "left_semi")
    ends = F.explode(F.array("keep", "drop")).alias("_id")
    rivals = cut(ok.select("pos", ends).distinct().join(ok.select(F.col("drop").alias("_id"), F.col("pos").alias("_by")), "_id").where("_by < pos").select("pos", "_by").distinct())
    from .match import leads_by_rounds
    from .ordered import independent

    # A pair counts unless an earlier one that counts dropped one of its ids.
    decided, rest = independent(rivals.select(F.lit("").alias("bucket"), F.col("pos").alias("at"), F.col("pos").alias("id"), F.col("_by").alias("to_at"), F.col("_by").alias("to"), F.lit(False).alias("outside")), dict(pairs.dtypes)["pos"])
    if rest is not None:
        decided = decided.unionByName(leads_by_rounds(rest))
    out = cut(decided.where("NOT leads").select(F.col("id").alias("pos")))
    remap = cut(ok.join(out, "pos", "left_anti").select("drop", "keep"))
    while True:
        on = remap.select(F.col("drop").alias("_d"), F.col("keep").alias("_k"))
        after = cut(remap.join(on, F.col("keep") == F.col("_d"), "left").select("drop", F.coalesce("_k", "keep").alias("keep"), F.col("_k").isNotNull().alias("_moved")))
        remap = after.select("drop", "keep")
        if after.where("_moved").isEmpty():
            return remap


def merge_occurrences(records: DataFrame, bridge: DataFrame, queue: DataFrame, remap: DataFrame, id_: str, source: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, bridge, queue) after merges (drop, keep).

    Dropped records go, and their open questions with them; their sources move to the kept one, which keeps
    its own row of a source that both have; a kept record is no longer ambiguous.
    """
    gone, kept = remap.select(F.col("drop").alias(id_)), remap.select(F.col("keep").alias(id_)).distinct().withColumn("_kept", F.lit(True))
    left = records.join(gone, id_, "left_anti").join(kept, id_, "left")
    left = left.withColumns({"ambiguous": F.col("ambiguous") & F.col("_kept").isNull(), "candidate": F.when(F.col("_kept").isNull(), F.col("candidate"))}).drop("_kept")
    moved = bridge.join(remap.withColumnRenamed("drop", id_), id_, "left").withColumns({"_own": F.col("keep").isNull(), "_was": F.col(id_)}).withColumn(id_, F.coalesce("keep", id_)).drop("keep")
    sources = first_of(moved, [id_, source], F.desc("_own"), "_was").drop("_own", "_was")
    return left, sources, queue.join(gone, id_, "left_anti")


def _turn_links(records: DataFrame, turns: DataFrame, m, id_: str, floor: float) -> tuple[DataFrame, DataFrame]:
    """(classes (id, class), links (bucket, id, to, score) from classes that have a turn to those near them).

    Without a veto records of a bucket and text are one class, named after their least id; with one each record is its own.
    """
    from .match import _scored, class_links

    asked = records.join(turns, id_, "left_semi")
    if not m.veto:
        return class_links(asked, records, m, floor)
    near = _scored(asked, records, m, F.col(f"a.{id_}") != F.col(f"b.{id_}"), floor)
    return records.select(F.col(id_).alias("id"), F.col(id_).alias("class")), cut(near.select(F.col(f"a.{m.bucket}").alias("bucket"), F.col(f"a.{id_}").alias("id"), F.col(f"b.{id_}").alias("to"), "score"))


def _take_turns(match_at: float, ambiguous_at: float, schema):
    """Task over units of rows (unit, turn, id, class, standing, near, barred), members first, then turns, both by id: (id, other, merged)."""
    import pyarrow as pa

    def place(standing, i):  # nulls come first, NaN last, as Spark sorts them
        return (standing is not None, standing != standing, standing if standing is not None and standing == standing else 0, i)

    def run(batches):
        unit, members, stands, at, gone, merges, unsure = None, {}, {}, {}, set(), [], {}

        def least(c, i, barred):
            """The least member of a class that is still there, not the record itself and not barred."""
            own, k = members.get(c, ()), at.get(c, 0)
            while k < len(own) and own[k] in gone:
                k += 1
            at[c] = k
            while k < len(own) and (own[k] == i or own[k] in gone or own[k] in barred):
                k += 1
            return own[k] if k < len(own) else None

        def best(i, near, barred):
            score, found = None, None
            for link in near:  # highest scores first; equal ones go to the least id
                if found is not None and link["n"] != score:
                    break
                other = least(link["to"], i, barred)
                if other is not None and (found is None or other < found):
                    score, found = link["n"], other
            return found, score

        def told():
            rows = [(drop, keep, True) for drop, keep in merges] + [(i, c, False) for i, c in unsure.items()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                if r["unit"] != unit:
                    if merges or unsure:
                        yield told()
                    unit, members, stands, at, gone, merges, unsure = r["unit"], {}, {}, {}, set(), [], {}
                i = r["id"]
                if not r["turn"]:
                    members.setdefault(r["class"], []).append(i)
                    stands[i] = r["standing"]
                    continue
                if i in gone:
                    continue
                other, score = best(i, r["near"], set(r["barred"] or ()))
                if other is None:
                    continue
                if -score >= match_at:
                    keep, drop = (i, other) if place(r["standing"], i) < place(stands[other], other) else (other, i)
                    gone.add(drop)
                    merges.append((drop, keep))
                    unsure.pop(keep, None)  # a merge settles what was asked before about either
                    unsure.pop(drop, None)
                elif -score >= ambiguous_at:
                    unsure[i] = other
        if merges or unsure:
            yield told()

    return run


def dedup_moved(records: DataFrame, moved: DataFrame, never: DataFrame, m, id_: str, unit_links: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(merges (drop, keep), ambiguous (id, candidate)) for records whose bucket changed.

    records hold the columns of the match schema ``m`` and standing (lower is better); cancelled ones are
    left out by the caller. In id order, each moved record still there is matched against the others of its
    bucket, never-merge pairs (a, b) excepted: a match merges the two into the better standing one, a near
    match is for review. Records of a bucket and text are alike to all others, so links lead from text to text, never from
    record to record (with a veto each record has its own). Buckets don't touch each other, nor do components of links: turns
    stream in order, a bucket at a time, or a component where a bucket has more than ``unit_links``; a task holds the ids of one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    from .ordered import UNIT_LINKS, components

    turns = moved.select(id_).distinct()
    held = records.where(F.col(m.bucket).isNotNull())
    classes, links = _turn_links(held, turns, m, id_, min(m.match_threshold, m.ambiguous_floor))
    if links.groupBy("bucket").count().where(F.col("count") > (unit_links or UNIT_LINKS)).isEmpty():
        links = links.withColumn("unit", F.col("bucket").cast("string"))
    else:
        links = links.join(components(links), "id").withColumn("unit", F.col("component").cast("string"))
    near = links.groupBy("unit", F.col("id").alias("class")).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("n"), "to"))).alias("near"))
    pairs = never.select("a", "b").unionByName(never.select(F.col("b").alias("a"), F.col("a").alias("b")))
    barred = pairs.groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("barred"))
    own = classes.join(held.select(F.col(id_).alias("id"), "standing"), "id")
    columns = lambda turn, *more: ["unit", F.lit(turn).alias("turn"), "id", "class", "standing", *more]
    asked = own.join(turns.withColumnRenamed(id_, "id"), "id", "left_semi").join(near, "class").join(barred, "id", "left").select(*columns(True, "near", "barred"))
    members = own.join(links.select(F.col("to").alias("class"), "unit").distinct(), "class").select(*columns(False, *(F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in ("near", "barred"))))
    schema = held.select(F.col(id_).alias("id"), F.col(id_).alias("other"), F.lit(True).alias("merged")).schema
    rows = members.unionByName(asked).repartition("unit").sortWithinPartitions("unit", "turn", "id")
    found = cut(rows.mapInArrow(_take_turns(m.match_threshold, m.ambiguous_floor, to_arrow_schema(schema)), schema))
    merges = found.where("merged").select(F.col("id").alias("drop"), F.col("other").alias("keep"))
    return merges, found.where("NOT merged").select(F.col("id").alias(id_), F.col("other").alias("candidate"))


def reresolve(records: DataFrame, found: DataFrame, id_: str, place: str) -> DataFrame:
    """Records without a place take what another try found; resolved ones are not asked again. found(id, place)."""
    late = found.select(id_, F.col(place).alias("_found"))
    return records.join(late, id_, "left").withColumn(place, F.coalesce(place, "_found")).drop("_found")


def attach_series(records: DataFrame, forced: DataFrame, series: DataFrame, id_: str, key: str) -> DataFrame:
    """Records with the series that an override names, if that series exists."""
    ok = forced.join(series.select(key).distinct(), key, "left_semi").select(id_, F.col(key).alias("_forced"))
    return records.join(ok, id_, "left").withColumn(key, F.coalesce("_forced", key)).drop("_forced")


def settle_never_merged(records: DataFrame, never: DataFrame, id_: str) -> DataFrame:
    """Records of a never-merge pair (a, b) are no longer ambiguous."""
    named = never.select(F.explode(F.array("a", "b")).alias(id_)).distinct().withColumn("_settled", F.lit(True))
    return records.join(named, id_, "left").withColumn("ambiguous", F.col("ambiguous") & F.col("_settled").isNull()).drop("_settled")


def source_cancel(status: Column, told: Column) -> Column:
    """A source's own word cancels a record that is active or flagged."""
    return F.when(told & status.isin("active", "flagged_cancelled"), "cancelled").otherwise(status)


def live_series(series: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Series that still have a record."""
    return series.join(records.select(key).distinct(), key, "left_semi")


def seen_between(sightings: DataFrame, key: list[str], at: str, raw: str) -> DataFrame:
    """First and last time of each key, and the raw row that was seen last."""
    return sightings.groupBy(*key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.max_by(raw, F.struct(at, raw)).alias("raw_id"))


def apply_remap(rows: DataFrame, remap: DataFrame, id_: str) -> DataFrame:
    """Rows with dropped ids turned into kept ones."""
    return rows.join(remap.withColumnRenamed("drop", id_), id_, "left").withColumn(id_, F.coalesce("keep", id_)).drop("keep")


def override_status(rows: DataFrame, cancelled: DataFrame, uncancelled: DataFrame, id_: str) -> DataFrame:
    """cancelled ids become cancelled; uncancelled ones that were flagged or cancelled become active with no misses."""
    j = rows.join(cancelled.select(id_).distinct().withColumn("_c", F.lit(True)), id_, "left").join(uncancelled.select(id_).distinct().withColumn("_u", F.lit(True)), id_, "left")
    off = F.col("_u") & F.col("status").isin("flagged_cancelled", "cancelled")
    status = F.when(off, "active").when(F.col("_c"), "cancelled").otherwise(F.col("status"))
    return j.withColumns({"misses": F.when(off, 0).otherwise(F.col("misses")), "status": status}).drop("_c", "_u")


def minus_pairs(pairs: DataFrame, never: DataFrame) -> DataFrame:
    """Pairs (a, b) less the never-merge ones, in whichever order those are given."""
    low = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return low(pairs).join(low(never).distinct(), ["a", "b"], "left_anti")


def refresh(old: DataFrame, pulled: DataFrame, id_: str) -> DataFrame:
    """Records after their sources were pulled again, with ``moved``: whether the day or place changed.

    Both hold title, category, day, venue, description; old also status and misses, pulled also source,
    cancelled and primary (whether the source is the record's best). The best source's title, category and day
    win; a missing place is filled; a description is filled, or replaced by the best source's; a source's word
    that it is off cancels; misses go back to 0. Records that no source lists stay as they are.
    """
    best = pulled.where("primary").groupBy(id_).agg(*(F.min_by(c, "source").alias(f"_{c}") for c in ("title", "category", "day", "description")))
    first = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col("source")))
    any_ = pulled.groupBy(id_).agg(first("venue").alias("_venue"), first("description").alias("_any"), F.bool_or("cancelled").alias("_off"))
    j = old.join(any_, id_, "left").join(best.withColumn("_best", F.lit(True)), id_, "left")
    seen, by_best = F.col("_off").isNotNull(), F.col("_best").isNotNull()
    new = {c: F.when(by_best, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("title", "category", "day")}
    told = F.nullif("_description", F.lit(""))
    new["description"] = F.coalesce(told, F.nullif("description", F.lit("")), "_any", F.lit(""))
    new["venue"] = F.coalesce("venue", "_venue")
    new["status"] = source_cancel(F.col("status"), F.coalesce("_off", F.lit(False)))
    new["misses"] = F.when(seen, 0).otherwise(F.col("misses"))
    moved = (by_best & ~F.col("_day").eqNullSafe(F.col("day"))) | (F.col("venue").isNull() & F.col("_venue").isNotNull())
    return j.select(*(new.get(c, F.col(c)).alias(c) for c in old.columns), moved.alias("moved"))


def create_occurrences(records: DataFrame, decisions: DataFrame, key: list[str], id_: str) -> DataFrame:
    """New records that no existing one matched: with a stable id from their key, held, and with the near match to review.

    decisions(key, decision, candidate) come from the matcher; series comes along in records.
    """
    j = records.join(decisions, key)
    stable = F.substring(F.sha1(F.concat_ws("|", *key).cast("binary")), 1, 16)
    near = F.col("decision") == "ambiguous"
    fresh = j.where("decision <> 'match'").withColumns({id_: stable, "status": F.lit("active"), "publish_state": F.lit("held"), "ambiguous": near, "candidate": F.when(near, F.col("candidate"))})
    return fresh.drop("decision")
