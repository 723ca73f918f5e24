"""N-gram Jaccard join with Bayesian candidate pruning.

1. Every text gets a MinHash signature of its set of five-word shingles. Equal texts form a class; from
   here on classes stand for their members.
2. Thirty bands of four values propose candidates; a pair at similarity 0.8 misses all of them with
   probability 1.4e-7. Buckets of one class go. Larger buckets are cut into blocks, and each pair of
   blocks is a unit of work of bounded size; a pair of classes counts in the first band it shares only.
3. A unit compares MinHash values of its pairs a dozen at a time. After n values with m equal, the
   similarity's posterior under a uniform prior is Beta(m + 1, n - m + 1), and a pair goes once
   P(similarity >= threshold) = P(Bin(n + 1, threshold) <= m) is below the tolerance.
4. Units that keep a pair get the shingle sets of just the classes involved and verify every kept pair
   exactly. They return link counts per class and a spanning forest of the links, never the pairs.
5. Components of the forests are the near-duplicate groups.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import each_slice, mix64, ngram_hashes, one_text_each, possible_rows, stored, text_or_empty, tidy, word_hashes, words
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 4
HASHES = BANDS * ROWS
TOLERANCE = 1e-6
BLOCK = 512
_CHUNK = 12
_MULTIPLIER = (mix64(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (mix64(np.arange(1001, HASHES + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def shingles(data: np.ndarray, off: np.ndarray, k: int = SHINGLE):
    """Per text the sorted distinct hashes of its k-word shingles; a text of fewer words is one shingle."""
    starts, ends, first = words(data, off)
    h = word_hashes(data, starts, ends)
    grams = ngram_hashes(h, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            yield ngram_hashes(h[a:b], b - a)
        else:
            yield h[:0]


def signature(own: np.ndarray) -> np.ndarray:
    """HASHES values of 16 bits, the upper halves of the minima under multiply-add permutations."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (own >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(short), 4096):
        part = short[a : a + 4096, None]
        np.minimum(low, (part * _MULTIPLIER + _SHIFT).min(axis=0), out=low)
    # Minima of a set of n lie near 2**32 / n: mixing spreads them over all sixteen bits.
    return (mix64(low.astype(np.uint64) + np.uint64(1)) >> np.uint64(48)).astype("<u2")


def _sign(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int32()), ("sig", pa.binary())])
    for batch in batches:
        for lo, hi, data, off in each_slice(batch):
            sets = list(shingles(data, off))
            sigs = [signature(s).tobytes() if len(s) else None for s in sets]
            yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), batch.column("key").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int32()), pa.array(sigs, pa.binary())], schema=schema)


def _shingle_sets(batches):
    schema = pa.schema([("rep", pa.int64()), ("shingles", pa.binary())])
    for batch in batches:
        for lo, hi, data, off in each_slice(batch):
            yield pa.record_batch([batch.column("rep").slice(lo, hi - lo), pa.array([s.tobytes() for s in shingles(data, off)], pa.binary())], schema=schema)


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """After n values: the fewest equal ones with which a pair stays."""
    out = {}
    for n in range(_CHUNK, HASHES + 1, _CHUNK):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def surviving_pairs(sig: np.ndarray, band: np.ndarray, unit_end: np.ndarray, side: np.ndarray, cross: np.ndarray, need: dict[int, int]):
    """Chunks of (left, right) places of pairs that survive the pruning.

    Rows are sorted by unit; unit_end has each row's end of unit. Where ``cross`` holds only pairs of
    different ``side`` count. Pairs that share a band before their unit's own are another unit's.
    """
    n = unit_end - np.arange(len(unit_end)) - 1
    lo = 0
    total = np.concatenate([[0], np.cumsum(n)])
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + 400_000, "right")) - 1)
        count = n[lo:hi]
        left = np.repeat(np.arange(lo, hi), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(total[lo:hi] - total[lo], count)
        lo = hi
        if not len(left):
            continue
        keep = ~cross[left] | (side[left] != side[right])
        left, right = left[keep], right[keep]
        equal = np.zeros(len(left), np.int32)
        for done in range(0, HASHES, _CHUNK):
            same = sig[left, done : done + _CHUNK] == sig[right, done : done + _CHUNK]
            equal += same.sum(axis=1, dtype=np.int32)
            shared = same.reshape(len(left), -1, ROWS).all(axis=2)
            earlier = (shared & (np.arange(done // ROWS, (done + _CHUNK) // ROWS) < band[left, None])).any(axis=1)
            keep = (equal >= need[done + _CHUNK]) & ~earlier
            left, right, equal = left[keep], right[keep], equal[keep]
            if not len(left):
                break
        if len(left):
            yield left, right


def _units(batches, columns: tuple[str, ...]):
    """Whole units of rows sorted by (bucket, low, high), many at a time: (columns, each row's end of unit)."""
    held = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        key = np.stack([held.column(c).to_numpy() for c in ("bucket", "low", "high")])
        change = np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1
        if not len(change):
            continue
        cut = int(change[-1])
        yield _unit_columns(held.slice(0, cut), change[:-1], columns)
        held = held.slice(cut).combine_chunks()
    if held is not None and len(held):
        key = np.stack([held.column(c).to_numpy() for c in ("bucket", "low", "high")])
        yield _unit_columns(held, np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1, columns)


def _unit_columns(rows: pa.Table, change: np.ndarray, columns: tuple[str, ...]):
    borders = np.concatenate([[0], change, [len(rows)]]).astype(np.int64)
    rows = rows.combine_chunks()
    out = {c: rows.column(c).to_numpy() for c in columns}
    out["sig"] = np.frombuffer(b"".join(rows.column("sig").to_pylist()), "<u2").reshape(-1, HASHES)
    return rows, out, borders, np.repeat(borders[1:], np.diff(borders))


_UNIT = ("bucket", "low", "high", "band", "side", "rep")


def _candidates(need: dict[int, int]):
    """Tasks: units -> their rows that keep a pair."""
    schema = pa.schema([("bucket", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("band", pa.int32()), ("side", pa.int32()), ("rep", pa.int64())])

    def run(batches):
        for rows, c, _, end in _units(batches, _UNIT):
            used = np.zeros(len(rows), bool)
            for left, right in surviving_pairs(c["sig"], c["band"], end, c["side"], c["low"] != c["high"], need):
                used[left] = used[right] = True
            at = pa.array(np.flatnonzero(used))
            yield pa.record_batch([rows.column(f.name).take(at).combine_chunks() for f in schema], schema=schema)

    return run


def _verify(need: dict[int, int], threshold: float):
    """Tasks: units with shingle sets -> (a, b, texts, docs): link counts have b null, forest edges no counts."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("texts", pa.int64()), ("docs", pa.int64())])

    def run(batches):
        for rows, c, borders, end in _units(batches, (*_UNIT, "copies")):
            raw = rows.column("shingles")
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in raw]
            size = np.array([len(s) for s in sets], np.int64)
            linked_a, linked_b = [], []
            for left, right in surviving_pairs(c["sig"], c["band"], end, c["side"], c["low"] != c["high"], need):
                common = _intersections(sets, left, right)
                near = common >= np.ceil(threshold * (size[left] + size[right] - common) - 1e-9)
                linked_a.append(left[near])
                linked_b.append(right[near])
            if not linked_a:
                continue
            a, b = np.concatenate(linked_a), np.concatenate(linked_b)
            if not len(a):
                continue
            copies = c["copies"]
            texts = np.bincount(a, minlength=len(size)) + np.bincount(b, minlength=len(size))
            docs = np.bincount(a, copies[b], len(size)) + np.bincount(b, copies[a], len(size))
            has = np.flatnonzero(texts)
            root = _roots(a, b, len(size))
            tied = np.flatnonzero(root != np.arange(len(size)))
            rep = c["rep"]
            yield pa.record_batch(
                [
                    np.concatenate([rep[has], rep[tied]]),
                    pa.array(np.concatenate([np.zeros(len(has), np.int64), rep[root[tied]]]), mask=np.arange(len(has) + len(tied)) < len(has)),
                    pa.array(np.concatenate([texts[has], np.zeros(len(tied), np.int64)])),
                    pa.array(np.concatenate([docs[has].astype(np.int64), np.zeros(len(tied), np.int64)])),
                ],
                schema=schema,
            )

    return run


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets: by products of 0/1 columns where pairs are many."""
    used = np.unique(np.concatenate([left, right]))
    if len(left) < 8 * len(used):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left.tolist(), right.tolist())], np.int64)
    out = np.zeros(len(left), np.int64)
    sizes = np.array([len(sets[i]) for i in used])
    values, column = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
    row = np.repeat(np.arange(len(used)), sizes)
    shared = np.bincount(column, minlength=len(values)) > 1
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    sort = np.argsort(column, kind="stable")
    row, column = row[sort], column[sort]
    i, j = np.searchsorted(used, left), np.searchsorted(used, right)
    width = max(64, 8_000_000 // len(used))
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        dense = np.zeros((len(used), width), np.float32)
        dense[row[a:b], column[a:b] - low] = 1
        for at in range(0, len(used), 512):  # a strip of the product at a time
            strip = dense[at : at + 512] @ dense.T
            own = np.flatnonzero((i >= at) & (i < at + 512))
            out[own] += strip[i[own] - at, j[own]].astype(np.int64)
    return out


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest place of each place's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: class_id, rep, n_links, n_text_links.

    rep is the smallest id among equal texts, class_id the smallest rep of all texts tied by links
    (Jaccard of five-word shingle sets >= threshold). n_links counts linked documents, equal texts
    included; n_text_links counts linked different texts. A text of fewer than five words is one shingle.
    Null or wordless texts link to nothing and are classes of their own. Rows without an id are left out;
    rows that share an id are one document, read as the least of their texts, and keep a row each.
    """
    need = least_matches(threshold, tolerance)
    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = one_text_each(rows)
    signed = stored(texts.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary")))).mapInArrow(tidy(_sign), "doc_id long, key binary, n int, sig binary"), "signatures")
    worded = signed.where("n > 0")
    classes = stored(worded.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig")), "text-classes")
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(b, _band_bytes(b)).alias("bucket"))))
    entries = classes.select("rep", band.alias("e")).select("rep", "e.band", "e.bucket")
    shared = entries.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    met = entries.join(shared, "bucket")
    blocks = F.ceil(F.col("m") / block).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("bucket", "band", "rep", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))
    sigs = classes.select("rep", "sig", "copies")
    unit = ["bucket", "low", "high"]
    found = _by_unit(met.join(sigs.select("rep", "sig"), "rep"), unit).mapInArrow(tidy(_candidates(need)), "bucket long, low int, high int, band int, side int, rep long")
    found = stored(found, "candidates")
    involved = found.select("rep").distinct()
    some = possible_rows(texts, involved.select(F.col("rep").alias("doc_id"))).withColumnRenamed("doc_id", "rep")
    sets = some.join(involved, "rep", "left_semi").mapInArrow(tidy(_shingle_sets), "rep long, shingles binary")
    checked = _by_unit(found.join(sigs, "rep").join(sets, "rep"), unit).mapInArrow(tidy(_verify(need, threshold)), "a long, b long, texts long, docs long")
    checked = stored(checked, "links")
    counts = checked.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    groups = components(checked.where("b IS NOT NULL").select("a", "b"), "link-components").select(F.col("node").alias("rep"), F.col("root").alias("class_id"))
    told = classes.select("key", "rep", "copies").join(counts, "rep", "left").join(groups, "rep", "left")
    ids = signed.select("doc_id", F.when(F.col("n") > 0, F.col("key")).alias("key"))
    out = ids.join(told, "key", "left")
    if texts is not rows:
        out = rows.select("doc_id").join(out, "doc_id")
    return out.select(
        "doc_id",
        F.coalesce("class_id", "rep", "doc_id").alias("class_id"),
        F.coalesce("rep", "doc_id").alias("rep"),
        (F.coalesce("docs", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
    )


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of docs less those whose class has a smaller id; of rows that share an id that with the least text stays.

    A null text counts as an empty one, as where classes are judged; rows alike in id and text keep the one that is least in
    its other columns. Only rows that may go, or share an id, are shuffled. Rows without an id all stay. Other columns are
    kept, whatever their names; an empty table gives no rows.
    """
    out = stored(groups.where("doc_id <> class_id").select("doc_id").distinct(), "near-copies")
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    touched = stored(out.unionByName(repeated).distinct(), "near-copies-or-repeated")
    sortable = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    place = next(c for c in (f"place{i}" for i in range(len(docs.columns) + 1)) if c not in docs.columns)
    least = F.row_number().over(W.partitionBy("doc_id").orderBy(text_or_empty(), *sortable))
    first = possible_rows(docs, touched).withColumn(place, least).where((F.col(place) == 1) | F.col("doc_id").isNull())
    some = first.join(out, "doc_id", "left_anti").select(*docs.columns)
    return possible_rows(docs, touched, wanted=False).unionByName(some)


def _band_bytes(b):
    return F.substring(F.col("sig"), b * (2 * ROWS) + 1, F.lit(2 * ROWS))


def _by_unit(rows: DataFrame, unit: list[str]) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *unit).sortWithinPartitions(*unit)
