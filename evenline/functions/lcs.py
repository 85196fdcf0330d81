"""Longest common subsequence of two token arrays (ROUGE-L, A17).

Spark SQL has no LCS, and an O(n*m) table per row is out of reach for texts of
tens of thousands of tokens. This is the bit-parallel LCS length of Allison &
Dix (1986) / Hyyro (2004): one machine-word pass per token of the second
sequence over a bit-vector as long as the first, so O(n*m/64) per row, exact,
on whole texts. It runs in an Arrow-batched pandas UDF (a small per-row helper;
Spark partitions the rows).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a, b) -> int:
    """Exact LCS length of two sequences of hashable items."""
    if a is None or b is None:
        return None
    if len(a) < len(b):
        a, b = b, a
    m = len(a)
    if m == 0 or len(b) == 0:
        return 0
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << m) - 1
    v = full
    for y in b:
        u = v & masks.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return m - bin(v).count("1")


def lcs_dp(a, b) -> int:
    """Reference O(n*m) dynamic programme (tests only)."""
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


@F.pandas_udf(T.LongType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x, y) for x, y in zip(a, b)], dtype="Int64")


def lcs(a: Column, b: Column) -> Column:
    from evenline.session import ship_package
    ship_package()
    return lcs_udf(a, b)
