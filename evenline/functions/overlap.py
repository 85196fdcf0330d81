"""Clipped n-gram overlap of two token arrays, per row (ROUGE-N, A16/A28).

Tokens come from the JVM (``functions.text.tokens``); the per-row count
intersection runs in an Arrow-batched pandas UDF. Measured at sf0.1 this is
several times faster than Spark's interpreted higher-order functions
(sort + aggregate) and, unlike explode + group-by, shuffles nothing: every
group lives inside one row. Whole arrays, no cap.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def grams(toks, n: int):
    if n == 1:
        return list(toks)
    return list(zip(*[toks[i:] for i in range(n)]))


def clipped_overlap(a, b, n: int = 1):
    """sum over distinct n-grams g of min(count_a(g), count_b(g)); None if either is None."""
    if a is None or b is None:
        return None
    ca, cb = Counter(grams(a, n)), Counter(grams(b, n))
    if len(ca) > len(cb):
        ca, cb = cb, ca
    return sum(min(c, cb[g]) for g, c in ca.items() if g in cb)


def _udf(n: int):
    @F.pandas_udf(T.LongType())
    def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([clipped_overlap(x, y, n) for x, y in zip(a, b)], dtype="Int64")
    return overlap


_UDFS: dict[int, object] = {}


def ngram_overlap(a: Column | str, b: Column | str, n: int = 1) -> Column:
    from evenline.session import ship_package
    ship_package()
    if n not in _UDFS:
        _UDFS[n] = _udf(n)
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return _UDFS[n](a, b)


def gram_count(toks: Column | str, n: int) -> Column:
    """Number of n-grams of a token array (null for null)."""
    t = F.col(toks) if isinstance(toks, str) else toks
    return F.greatest(F.size(t) - F.lit(n - 1), F.lit(0))


_DIFF_TYPE = T.ArrayType(T.StructType([T.StructField("term", T.StringType()),
                                       T.StructField("n", T.LongType())]))


def counted_difference(a, b):
    """Multiset a - b as sorted (term, count) pairs with count > 0; None if a is None."""
    if a is None:
        return None
    d = Counter(a)
    if b is not None:
        d.subtract(Counter(b))
    return [{"term": t, "n": int(n)} for t, n in sorted(d.items()) if n > 0]


@F.pandas_udf(_DIFF_TYPE)
def _difference_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([counted_difference(x, y) for x, y in zip(a, b)])


def multiset_difference(a: Column | str, b: Column | str) -> Column:
    """Per row: ``array<struct<term, n>>`` of tokens in ``a`` more often than in ``b``."""
    from evenline.session import ship_package
    ship_package()
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return _difference_udf(a, b)
