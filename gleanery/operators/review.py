"""Named gates, publish states and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The gates' names; the first five hold a record back, the last only if asked to.
GATES = ("venue_unknown", "match_ambiguous", "cancellation_flagged", "source_underdelivered", "date_uncertain", "tier_c_only")


def gates(records: DataFrame, evidence: DataFrame, record: str) -> DataFrame:
    """Six booleans per record. evidence(record, tier, origin_tier, venue_optional, under); records without any count as tier C only."""
    good = F.col("tier").isin("A", "B") | (F.col("origin_tier") == "A")
    by = evidence.groupBy(record).agg(F.bool_and("venue_optional").alias("optional"), F.bool_and("under").alias("under"), F.bool_or(F.coalesce(good, F.lit(False))).alias("good"))
    j = records.join(by, record, "left")
    excused = F.coalesce("optional", F.lit(False)) & (F.coalesce("venue_name", F.lit("")) != "")
    return j.select(
        record,
        (F.col("venue_id").isNull() & ~excused).alias("venue_unknown"),
        F.coalesce("ambiguous", F.lit(False)).alias("match_ambiguous"),
        (F.col("status") == "flagged_cancelled").alias("cancellation_flagged"),
        F.coalesce("under", F.lit(False)).alias("source_underdelivered"),
        (~F.col("date_confident")).alias("date_uncertain"),
        (~F.coalesce("good", F.lit(False))).alias("tier_c_only"),
    )


def blocking(tier_c: bool = False) -> Column:
    """Whether a gate holds the record: five always do, tier C only on demand."""
    out = F.lit(False)
    for g in GATES if tier_c else GATES[:5]:
        out = out | F.col(g)
    return out


def state_counts(records: DataFrame, queue: DataFrame) -> DataFrame:
    """One row: how many records are published and held (publish_state), how many rows the queue now asks (insert or update) and how many closed themselves (action)."""
    states = records.agg(F.count_if(F.col("publish_state") == "published").alias("published"), F.count_if(F.col("publish_state") == "held").alias("held"))
    asked = queue.agg(F.count_if(F.col("action").isin("insert", "update")).alias("queued"), F.count_if(F.col("action") == "resolve").alias("auto_resolved"))
    return states.select("*", asked.select(F.struct("queued", "auto_resolved")).scalar().alias("q")).select("published", "held", "q.queued", "q.auto_resolved")


def gate_counts(gated: DataFrame) -> DataFrame:
    """(gate, n): how many records each gate stops."""
    stopped = F.filter(F.array(*(F.when(F.col(g), F.lit(g)) for g in GATES)), lambda x: x.isNotNull())
    return gated.select(F.explode(stopped).alias("gate")).groupBy("gate").agg(F.count("*").alias("n"))


def strict_flag(runs: DataFrame, run: str, first: int) -> DataFrame:
    """One row: whether so few runs have been that every record is still held for a look."""
    return runs.agg((F.count_distinct(run) <= first).alias("strict"))


def publish_state(cancelled: Column, approved: Column, blocking: Column, strict: Column) -> Column:
    return F.when(cancelled, "held").when(approved, "published").when(blocking, "held").when(strict, "held").otherwise("published")


def queue_upsert(open_rows: DataFrame, records: DataFrame, record: str, as_of: Column) -> DataFrame:
    """The queue after a run, with ``action``: insert, update or resolve.

    open_rows(record, created_at); records(record, reason, start, blocking, cancelled, decided, strict,
    on_site). A record needs an answer if a gate blocks it, it is neither cancelled nor decided, or strict
    mode holds it, and the site would show it. Events of more than a day ago need none: their rows are
    resolved, as are open rows that need no answer any more.
    """
    need = ((F.col("blocking") & ~F.col("cancelled") & ~F.col("decided")) | (F.col("strict") & ~F.col("blocking") & ~F.col("cancelled") & ~F.col("decided"))) & F.col("on_site")
    n = records.where((F.col("start") >= as_of - F.expr("INTERVAL 1 DAY")) & need).select(record, "reason", F.lit(True).alias("_need"))
    o = open_rows.select(record, "created_at", F.lit(True).alias("_open"))
    j = o.join(n, record, "full_outer")
    action = F.when(F.col("_open").isNull(), "insert").when(F.col("_need").isNull(), "resolve").otherwise("update")
    return j.select(record, "reason", F.coalesce("created_at", as_of).alias("created_at"), F.when(action == "resolve", as_of).alias("resolved_at"), action.alias("action"))


def approve(records: DataFrame, queue: DataFrame, record: str, as_of: Column, ids: DataFrame | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, queue) after a yes to these ids, to all open rows that only strict mode holds, or (neither) to all open rows.

    A yes publishes what isn't cancelled, settles its ambiguity and closes its open row. queue(record,
    resolved_at, strict_mode and the gates).
    """
    open_ = queue.where("resolved_at IS NULL")
    if ids is not None:
        named = ids.select(record)
    else:
        named = open_.where(F.col("strict_mode") & ~blocking()).select(record) if strict else open_.select(record)
    yes = named.distinct().withColumn("_yes", F.lit(True))
    ok = F.col("_yes").isNotNull() & (F.col("status") != "cancelled")
    after = records.join(yes, record, "left").withColumns({"approved": F.col("approved") | ok, "publish_state": F.when(ok, "published").otherwise(F.col("publish_state")), "ambiguous": F.col("ambiguous") & ~ok}).drop("_yes")
    closed = queue.join(yes, record, "left").withColumn("resolved_at", F.when(F.col("_yes").isNotNull() & F.col("resolved_at").isNull(), as_of).otherwise(F.col("resolved_at"))).drop("_yes")
    return after, closed


def open_items(queue: DataFrame, records: DataFrame, places: DataFrame, record: str, place: str) -> DataFrame:
    """Open rows with their record and, if it has one, its place."""
    return queue.where("resolved_at IS NULL").join(records, record).join(places, place, "left")


# The forms of a command line, and of a line after which a reply is quoted.
ID_LINE = r"(?i)^(approve|cancel|not-cancelled|uncancel|merge|never-merge|ignore|hide)\s+([\d\s,#]+)$"
ALIAS_LINE = r'(?i)^alias\s+"([^"]+)"\s*=\s*([a-z0-9-]+)\s*$'
VENUE_LINE = r'(?i)^venue\s+([a-z0-9-]+)\s+"([^"]+)"\s+("[^"]+"|\S+)\s*$'
BOUNDARY = r"^On .* wrote:\s*$|^-- ?$|^_{3,}\s*$|^From: "


def commands(messages: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(commands, unknown lines) of review texts, a command per line.

    messages(msg_id, text) give (msg_id, line, verb, ids, name, slug, city, raw). Quoted lines, comments and
    empty lines are skipped; a reply boundary ends the message. A line that is no command as a whole is unknown.
    """
    each = messages.select("msg_id", F.posexplode(F.split(F.coalesce(text, F.lit("")), r"\r?\n")).alias("line", "raw"))
    each = each.where(~F.col("raw").rlike(r"^\s*>")).withColumn("raw", F.trim("raw"))
    ends = each.groupBy("msg_id").agg(F.min(F.when(F.col("raw").rlike(BOUNDARY), F.col("line"))).alias("_end"))
    live = each.join(ends, "msg_id").where("(_end IS NULL OR line < _end) AND raw <> ''").where(~F.startswith("raw", F.lit("<!--")))
    part = lambda pattern, k: F.nullif(F.regexp_extract("raw", pattern, k), F.lit(""))
    ids = F.transform(F.regexp_extract_all(F.coalesce(part(ID_LINE, 2), F.lit("")), F.lit(r"(\d+)"), 1), lambda x: x.cast("long"))
    named = F.lower(part(ID_LINE, 1))
    same = F.when(named == "uncancel", "not-cancelled").when(named == "hide", "ignore").otherwise(named)
    verb = F.coalesce(F.when(F.size(ids) > 0, same), F.when(F.col("raw").rlike(ALIAS_LINE), "alias"), F.when(F.col("raw").rlike(VENUE_LINE), "venue"))
    name = F.trim(F.coalesce(part(ALIAS_LINE, 1), part(VENUE_LINE, 2)))
    slug = F.lower(F.coalesce(part(ALIAS_LINE, 2), part(VENUE_LINE, 1)))
    city = F.regexp_replace(part(VENUE_LINE, 3), '^"+|"+$', "")
    parsed = live.select("msg_id", "line", verb.alias("verb"), ids.alias("ids"), name.alias("name"), slug.alias("slug"), city.alias("city"), "raw")
    return parsed.where("verb IS NOT NULL"), parsed.where("verb IS NULL").select("msg_id", "line", "raw")


def override_rows(found: DataFrame, known: DataFrame, slugs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(overrides, refused) of parsed commands.

    overrides(kind, id, other, slug, name, city, msg_id, line): a row per id, or per pair for merges, or for an
    alias or venue. Refused (msg_id, line, raw, why): an id that known(id) doesn't hold, a merge without exactly
    two ids, an alias for a slug that neither slugs(slug) nor an earlier venue command holds, a venue whose slug is taken.
    """
    at = F.struct("msg_id", "line")
    asked = found.select("msg_id", "line", F.explode("ids").alias("id"))
    strange = asked.join(known.select("id").distinct(), "id", "left_anti").select("msg_id", "line").distinct().withColumn("_strange", F.lit(True))
    made = found.where("verb = 'venue'").groupBy("slug").agg(F.min(at).alias("_made"))
    marked = found.join(strange, ["msg_id", "line"], "left").join(slugs.select("slug").distinct().withColumn("_old", F.lit(True)), "slug", "left").join(made, "slug", "left")
    old, early = F.col("_old").isNotNull(), F.coalesce(F.col("_made") < at, F.lit(False))
    why = (
        F.when(F.col("_strange").isNotNull(), "unknown id")
        .when(F.col("verb").isin("merge", "never-merge") & (F.size("ids") != 2), "needs two ids")
        .when((F.col("verb") == "alias") & ~(old | early), "unknown place")
        .when((F.col("verb") == "venue") & (old | early), "place exists")
    )
    judged = marked.withColumn("why", why)
    fine = judged.where("why IS NULL")
    pair = F.col("verb").isin("merge", "never-merge")
    rows = F.when(pair, F.array(F.struct(F.get("ids", F.lit(0)).alias("id"), F.get("ids", F.lit(1)).alias("other")))).when(F.size("ids") > 0, F.transform("ids", lambda i: F.struct(i.alias("id"), F.lit(None).cast("long").alias("other")))).otherwise(F.array(F.struct(F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("other"))))
    out = fine.select(F.col("verb").alias("kind"), F.explode(rows).alias("r"), "slug", "name", "city", "msg_id", "line")
    return out.select("kind", "r.id", "r.other", "slug", "name", "city", "msg_id", "line"), judged.where("why IS NOT NULL").select("msg_id", "line", "raw", "why")
