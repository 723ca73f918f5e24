"""Pairs of texts that may reach a floor of the token set ratio, without loss and without a row per pair.

Texts of a bucket meet in blocks. For a pair of blocks one matrix product over their tokens gives how much text each two
share in whole tokens, which settles two of the ratio's three parts exactly; the third, the likeness of what they don't share,
is bounded by the letters that both hold at most. Only pairs whose bound reaches the floor leave the task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut

#: Texts of a block; a task holds two blocks and their matrix at a time.
BLOCK = 512
#: Buckets of at most so many different texts on the one side pair natively.
FEW = 64
_LETTERS = 32


def bounds(a: list[str], b: list[str]) -> np.ndarray:
    """Upper bounds of the token set ratio of every two texts (0 where one has no token)."""
    tokens: dict[str, int] = {}
    sets = [sorted({t for t in x.split()}) for x in [*a, *b]]
    for own in sets:
        for t in own:
            tokens.setdefault(t, len(tokens))
    held = np.zeros((len(sets), len(tokens) or 1), np.float32)
    letters = np.zeros((len(sets), _LETTERS), np.float32)
    for i, own in enumerate(sets):
        held[i, [tokens[t] for t in own]] = 1
        # Letters that share a slot only make texts look more alike.
        for c in "".join(own):
            letters[i, ord(c) % _LETTERS] += 1
    size = np.array([len(t) for t in tokens] or [0], np.float32)
    n = np.array([len(x) for x in sets], np.float32)
    whole = held @ size + np.maximum(n - 1, 0)  # length of the sorted tokens, joined
    u, v = slice(0, len(a)), slice(len(a), None)
    count = held[u] @ held[v].T
    shared = (held[u] * size) @ held[v].T + np.maximum(count - 1, 0)
    gap = (count > 0).astype(np.float32)
    left = np.maximum(whole[u][:, None] - shared - gap * (n[u][:, None] > count), 0)
    right = np.maximum(whole[v][None, :] - shared - gap * (n[v][None, :] > count), 0)
    common = np.zeros_like(shared)
    for k in range(_LETTERS):
        common += np.minimum(letters[u, k][:, None], letters[v, k][None, :])
    apart = letters[u].sum(1)[:, None] + letters[v].sum(1)[None, :] - 2 * common
    best = 100 * (1 - apart / np.maximum(2 * (shared + gap) + left + right, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        for side in (left, right):
            part = np.where(side == 0, 100, 100 * (1 - (gap + side) / np.maximum(2 * shared + gap + side, 1)))
            best = np.where(count > 0, np.maximum(best, part), best)
    return np.where((n[u][:, None] > 0) & (n[v][None, :] > 0), best, 0)


def _met(floor: float):
    def run(frames):
        at, sides = None, ([], [])

        def pairs():
            if sides[0] and sides[1]:
                i, j = np.nonzero(bounds(*sides) >= floor - 1e-3)
                yield pd.DataFrame({"_bucket": at[0], "_ta": [sides[0][x] for x in i], "_tb": [sides[1][x] for x in j]})

        for frame in frames:
            for bucket, unit, side, text in zip(frame["_bucket"].tolist(), frame["unit"].tolist(), frame["side"].tolist(), frame["text"].tolist()):
                if (bucket, unit) != at:
                    if at:
                        yield from pairs()
                    at, sides = (bucket, unit), ([], [])
                sides[side].append(text)
        if at:
            yield from pairs()

    return run


def pairs_above(left: DataFrame, right: DataFrame, floor: float, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """(_bucket, _ta, _tb): every pair of texts of a bucket that may reach the floor, and few others.

    left(_bucket, _ta) and right(_bucket, _tb) hold different texts; null buckets pair with nothing.
    """
    kind = dict(left.dtypes)["_bucket"]
    counts = lambda df, out: df.groupBy("_bucket").agg(F.count("*").alias(out))
    sizes = cut(counts(left, "n").join(counts(right, "m"), "_bucket"))
    small = (F.col("n") <= few) | (F.col("m") <= few)
    native = left.join(sizes.where(small).select("_bucket"), "_bucket").join(right, "_bucket").select("_bucket", "_ta", "_tb")
    if sizes.where(~small).isEmpty():
        return native
    large = sizes.where(~small).select("_bucket", F.ceil(F.col("n") / block).cast("int").alias("rows"), F.ceil(F.col("m") / block).cast("int").alias("columns"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    one = left.join(large, "_bucket").select("_bucket", deal("_ta", "rows").alias("i"), every("columns").alias("j"), F.lit(0).alias("side"), F.col("_ta").alias("text"))
    other = right.join(large, "_bucket").select("_bucket", every("rows").alias("i"), deal("_tb", "columns").alias("j"), F.lit(1).alias("side"), F.col("_tb").alias("text"))
    blocks = one.unionByName(other).withColumn("unit", F.concat_ws(":", "i", "j")).repartition("_bucket", "unit").sortWithinPartitions("_bucket", "unit", "side")
    found = blocks.select("_bucket", "unit", "side", "text").mapInPandas(_met(floor), f"_bucket {kind}, _ta string, _tb string")
    return native.unionByName(found)
