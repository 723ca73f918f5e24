"""Token similarity: the set and sort ratios of public fuzzy-matching packages, 0 to 100.

Token sets are split, intersected and joined by Spark; only the length of a longest common subsequence
runs in an Arrow UDF (bit-parallel, Hyyro 2004).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def _lcs(a: str | None, b: str | None) -> int:
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for c in a:
        u = row & places.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return len(b) - row.bit_count()


@F.pandas_udf(IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_lcs(x, y) for x, y in zip(a, b)], dtype="int32")


def _tokens(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda x: x != "")))


def token_set_ratio(a: Column, b: Column) -> Column:
    """100 where one token set holds the other; 0 where either is empty."""
    ta, tb = _tokens(a), _tokens(b)
    shared = F.array_join(F.array_sort(F.array_intersect(ta, tb)), " ")
    da, db = F.array_join(F.array_sort(F.array_except(ta, tb)), " "), F.array_join(F.array_sort(F.array_except(tb, ta)), " ")
    s, la, lb = F.length(shared), F.length(da), F.length(db)
    gap = F.when(s > 0, 1).otherwise(0)
    total = 2 * (s + gap) + la + lb
    distance = la + lb - 2 * lcs_length(da, db)
    r = 100 * (1 - distance / F.greatest(total, F.lit(1)))
    best = F.greatest(r, 100 * (1 - (gap + la) / (2 * s + gap + la)), 100 * (1 - (gap + lb) / (2 * s + gap + lb)))
    return F.when((F.size(ta) == 0) | (F.size(tb) == 0), 0.0).when((s > 0) & ((la == 0) | (lb == 0)), 100.0).when(s == 0, r).otherwise(best)


def sorted_tokens(c: Column) -> Column:
    """The tokens of a text in order, joined: texts with equal ones have a sort ratio of 100, and no others have."""
    return F.array_join(F.array_sort(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda x: x != "")), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    sa, sb = sorted_tokens(a), sorted_tokens(b)
    n = F.length(sa) + F.length(sb)
    return F.when(n == 0, 0.0).otherwise(200.0 * lcs_length(sa, sb) / n)
