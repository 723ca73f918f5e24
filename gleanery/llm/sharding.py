"""Sharding by minimax contiguous partition.

Atomic groups (equal texts) are ordered by a 64-bit key of the text. The smallest capacity for
which a greedy sweep over the ordered group sizes needs no more shards than given is found by
bisection, and the cuts of that sweep are the shards' borders. Main path: DataFrame functions only.

The sweep never sees the groups themselves. It walks sums over key prefixes (at most 4,096 at
first) and asks Spark for the 256 children of those prefixes alone in which a cut falls, so what
comes to the driver depends on the number of shards and not on the corpus.

A group larger than an equal share can't share fairly: each such group has a shard of its own and
the rest is partitioned over the shards left (there are fewer such groups than shards).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_rank, stored, text_or_empty

ROOT_BITS, STEP_BITS, WAYS = 12, 8, 7
#: Prefixes of so many bits are summed once, so that only deeper steps read the groups (at most 2**28 rows).
DEEP_BITS = 28


class _Tree:
    """Sums of group sizes by key prefix, fetched level by level where a cut falls."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        deep = groups.groupBy(F.shiftright("key", 64 - DEEP_BITS).alias("prefix"))
        self.deep = stored(deep.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("key").alias("low")), "shard-prefixes")
        self.root = self._fetch(None, 0, ROOT_BITS)
        self.children: dict[tuple[int, int], list] = {}

    def _fetch(self, prefixes, bits: int, to_bits: int) -> list:
        if to_bits <= DEEP_BITS:
            g, key, width, n, low = self.deep, F.col("prefix"), DEEP_BITS, F.sum("n"), F.min("low")
        else:
            g, key, width, n, low = self.groups, F.col("key"), 64, F.count("*"), F.min("key")
        short = lambda to: F.shiftright(key, width - to) if to < width else key
        if prefixes is not None:
            g = g.where(short(bits).isin(prefixes))
        rows = g.groupBy(short(to_bits).alias("at")).agg(F.sum("bytes").alias("bytes"), n.alias("n"), low.alias("low")).collect()
        return sorted((r.at, to_bits, r.bytes, r.n, r.low) for r in rows)

    def open(self, nodes: set) -> None:
        for bits in {n[1] for n in nodes}:
            at = [n[0] for n in nodes if n[1] == bits]
            to = min(64, bits + STEP_BITS)
            got = self._fetch(at, bits, to)
            for p in at:
                self.children[p, bits] = [c for c in got if c[0] >> (to - bits) == p]

    def sweep(self, capacity: int) -> tuple[list[int], set]:
        """Greedy cuts at this capacity, and the closed nodes in which a cut falls (their cuts are guesses)."""
        cuts: list[int] = []
        closed: set = set()
        load = 0
        stack = list(reversed(self.root))
        while stack:
            node = stack.pop()
            prefix, bits, size, n, low = node
            if load + size <= capacity:
                load += size
            elif n == 1:
                cuts.append(low)
                load = size
            elif (prefix, bits) in self.children:
                stack.extend(reversed(self.children[prefix, bits]))
            else:
                closed.add((prefix, bits))
                over = load + size
                while over > capacity:
                    over -= capacity
                    cuts.append(low)
                load = over
        return cuts, closed


def _minimax_cuts(groups: DataFrame, shards: int, total: int, largest: int) -> tuple[list[int], int]:
    """First keys of the shards after the first, and the capacity."""
    tree = _Tree(groups)

    def exact(capacities: list[int]) -> dict[int, list[int]]:
        while True:
            swept = {c: tree.sweep(c) for c in capacities}
            closed = set().union(*(x[1] for x in swept.values()))
            if not closed:
                return {c: x[0] for c, x in swept.items()}
            tree.open(closed)

    low = max(-(-total // shards), largest)  # no capacity below can do
    high = -(-total // shards) + largest  # a sweep leaves each shard but the last fuller than the mean
    while low < high:
        tried = sorted({low + (high - low) * i // (WAYS + 1) for i in range(WAYS + 1)})
        fits = {c: len(cuts) < shards for c, cuts in exact(tried).items()}
        high = min([high, *(c for c, ok in fits.items() if ok)])
        low = max([low, *(c + 1 for c, ok in fits.items() if not ok)])
    return exact([high])[high], high


def shard_documents(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """Put every row into a shard so that the largest shard is as small as contiguous cuts allow.

    Returns doc_id, size (UTF-8 bytes of the text plus ``overhead``), text_crc32, shard, slot (gapless
    from 0 in each shard). Equal texts share a shard; a null text is an empty text. Repeated ids keep a
    row each. Fewer groups than shards leave shards empty; an empty table gives no rows. Other columns
    of docs are ignored, whatever their names.
    """
    sized = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text_or_empty(text)) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"),
            F.xxhash64(text_or_empty(text)).alias("key"),
        ),
        "shard-sizes",
    )
    groups = stored(sized.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    heavy = groups.orderBy(F.desc("bytes"), "key").limit(shards).collect()
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    own: list[int] = []
    left = total
    for row in heavy:
        if len(own) < shards - 1 and row.bytes * (shards - len(own)) > left:
            own.append(row.key)
            left -= row.bytes
        else:
            break
    rest = groups.where(~F.col("key").isin(own)) if own else groups
    cuts: list[int] = []
    if left:
        cuts, _ = _minimax_cuts(rest, shards - len(own), left, heavy[len(own)].bytes)
    shard = F.lit(0)
    for c in cuts:
        shard = shard + F.when(F.col("key") >= F.lit(c), 1).otherwise(0)
    for i, key in enumerate(own):
        shard = F.when(F.col("key") == F.lit(key), F.lit(shards - 1 - i)).otherwise(shard)
    placed = sized.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"))
    return salted_rank(placed, ["shard"], ["doc_id"], ["doc_id"], 64, "slot")
