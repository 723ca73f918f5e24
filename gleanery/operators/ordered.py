"""Greedy decisions in order over links, without a round per link.

A decision about a record depends on its links to earlier records alone. Links are grouped into units that don't touch
each other: buckets, or, where a bucket has more than ``UNIT_LINKS`` links, the connected components inside it. A
unit's links stream in order through one task, which keeps the decisions of that unit's records only. Components that
are larger still are left to rounds of joins, so no task ever meets more than the bound.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .tables import cut

#: Links of one unit that a task streams: some hundred bytes each for the records they name.
UNIT_LINKS = 1_000_000


def components(links: DataFrame, name: str = "component") -> DataFrame:
    """(id, component) of the ids in links(id, to): the least id that each is connected with.

    Each round takes the least label among an id's neighbours and then that label's own label, so labels travel twice as far
    each time; a chain of n links takes about log n rounds.
    """
    both = cut(links.select("id", "to").unionByName(links.select(F.col("to").alias("id"), F.col("id").alias("to"))).distinct())
    state = cut(both.groupBy("id").agg(F.least("id", F.min("to")).alias(name)))
    while True:
        near = both.join(state.select(F.col("id").alias("to"), name), "to").groupBy("id").agg(F.min(name).alias("_near"))
        least = state.join(near, "id").select("id", F.col(name).alias("_old"), F.least(name, "_near").alias("_least"))
        jump = state.select(F.col("id").alias("_least"), F.col(name).alias("_jump"))
        after = cut(least.join(jump, "_least", "left").select("id", "_old", F.least("_least", "_jump").alias(name)))
        state = after.select("id", name)
        if after.where(F.col(name) != F.col("_old")).isEmpty():
            return state


def in_units(links: DataFrame, unit_links: int = UNIT_LINKS) -> tuple[DataFrame, DataFrame | None]:
    """(links with their unit, links that fit no unit or None). links(bucket, id, to, ...), ids unique over all buckets."""
    counts = cut(links.groupBy("bucket").agg(F.count("*").alias("_n")))
    if counts.where(F.col("_n") > unit_links).isEmpty():
        return links.withColumn("unit", F.col("bucket").cast("string")), None
    sized = links.join(counts, "bucket")
    small = sized.where(F.col("_n") <= unit_links).drop("_n").withColumn("unit", F.col("bucket").cast("string"))
    large = cut(sized.where(F.col("_n") > unit_links).drop("_n"))
    found = components(large)
    named = large.join(found, "id").withColumn("unit", F.concat(F.lit("\0"), F.col("component").cast("string"))).drop("component")
    sizes = cut(named.groupBy("unit").agg(F.count("*").alias("_n")))
    named = named.join(sizes, "unit")
    fits = named.where(F.col("_n") <= unit_links).select(*links.columns, "unit")
    rest = None if sizes.where(F.col("_n") > unit_links).isEmpty() else cut(named.where(F.col("_n") > unit_links).select(*links.columns))
    # Written: a union of parts that are dealt by their unit already would not be dealt anew.
    return cut(small.unionByName(fits)), rest


def _streamed(links: DataFrame, decide, schema: str) -> DataFrame:
    """Rows that ``decide`` gives for each unit; it gets (id, [earlier ids], [whether each stands outside]) in order, and a dict of its own.

    links(unit, at, id, to_at, to, outside): at and to_at are the places of id and to in the order; every id that
    something links to comes with a row of its own first, unless it stands outside.
    """
    row = lambda at, id_, own: F.struct(F.col(at).alias("at"), F.col(id_).alias("id"), F.col("to").alias("to"), F.col("outside").alias("outside"), F.lit(own).alias("own"))
    both = F.when(F.col("outside"), F.array(row("at", "id", False))).otherwise(F.array(row("at", "id", False), row("to_at", "to", True)))
    rows = links.select("unit", F.explode(both).alias("r")).select("unit", "r.*")
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(frames):
        unit, known, current, earlier, outside = None, {}, None, [], []
        for frame in frames:
            out = []
            for u, i, to, off, own in zip(frame["unit"].tolist(), frame["id"].tolist(), frame["to"].tolist(), frame["outside"].tolist(), frame["own"].tolist()):
                if u != unit or i != current:
                    if current is not None:
                        out.append((current, decide(known, current, earlier, outside)))
                    if u != unit:
                        unit, known = u, {}
                    current, earlier, outside = i, [], []
                if not own:
                    earlier.append(to)
                    outside.append(off)
            if out:
                yield pd.DataFrame(out, columns=columns)
        if current is not None:
            yield pd.DataFrame([(current, decide(known, current, earlier, outside))], columns=columns)

    # An id's own rows and its links stand together: order by place, then id.
    return rows.repartition("unit").sortWithinPartitions("unit", "at", "id", "own").select("unit", "id", "to", "outside", "own").mapInPandas(run, schema)


def first_groups(links: DataFrame, kind: str, unit_links: int = UNIT_LINKS) -> tuple[DataFrame, DataFrame | None]:
    """((id, first) of every id in the links, links left over): the first member of the earliest group that an id's earlier links are in, else itself."""

    def decide(known, i, earlier, outside):
        # known: id -> (place of the group, its first id); groups are numbered as they are founded.
        best = min((known[e] for e in earlier), default=None)
        known[i] = best if best is not None else (len(known), i)
        return known[i][1]

    fits, rest = in_units(links.withColumn("outside", F.lit(False)), unit_links)
    return _streamed(fits, decide, f"id {kind}, first {kind}"), rest


def first_groups_of_classes(rows: DataFrame, links: DataFrame, kind: str, unit_links: int = UNIT_LINKS) -> tuple[DataFrame, DataFrame | None]:
    """((id, first) of every id in the rows(id, class, at) whose class has a link, links left over).

    links(bucket, id, to) join classes whose members are linked all with all. Of a class only the earliest group counts that a member
    is in, so rows stream in order beside one group per class and the links of a unit.
    """
    fits, rest = in_units(links, unit_links)
    near = fits.groupBy("unit", F.col("id").alias("class")).agg(F.collect_list("to").alias("near"))
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    heads = near.select("unit", F.lit(False).alias("row"), none(rows, "at"), none(rows, "id"), "class", "near")
    all_ = heads.unionByName(rows.join(near.select("unit", "class"), "class").select("unit", F.lit(True).alias("row"), "at", "id", "class", none(near, "near")))

    def run(batches):
        unit, linked, group, n = None, {}, {}, 0
        for batch in batches:
            out = []
            for u, row, i, c, to in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if u != unit:
                    unit, linked, group, n = u, {}, {}, 0
                if not row:
                    linked[c] = to
                    continue
                best = min((group[t] for t in linked[c] if t in group), default=None)
                if best is None:  # groups are numbered as they are founded
                    best, n = (n, i), n + 1
                group[c] = min(group.get(c, best), best)
                out.append((i, best[1]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    ids = rows.select("id", F.col("id").alias("first")).schema
    schema = to_arrow_schema(ids)
    streamed = all_.repartition("unit").sortWithinPartitions("unit", "row", "at").select("unit", "row", "id", "class", "near")
    return streamed.mapInArrow(run, f"id {kind}, first {kind}"), rest


def independent(links: DataFrame, kind: str, unit_links: int = UNIT_LINKS) -> tuple[DataFrame, DataFrame | None]:
    """((id, leads), links left over): whether none of an id's earlier links leads; ids outside lead always."""

    def decide(known, i, earlier, outside):
        known[i] = not any(off or known[e] for e, off in zip(earlier, outside))
        return known[i]

    fits, rest = in_units(links, unit_links)
    return _streamed(fits, decide, f"id {kind}, leads boolean"), rest
