"""Column expressions over text. All of them are built-in Spark SQL functions,
so they run JVM-side inside the row; nothing here ships rows to Python.

Fixed values (must stay exactly as written for results to match the specs):
  token pattern     \\p{L}+                 (letters only, lower-cased)
  segment pattern   \\p{L}+|[^\\p{L}]+       (alternating word / non-word runs)
  sentinel          U+E000                 (private-use character)
  sentinel removal  U+E000 followed by at most one space or tab
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"\p{L}+"
SEGMENT_PATTERN = r"\p{L}+|[^\p{L}]+"
SENTINEL = "\ue000"
SENTINEL_GAP_PATTERN = SENTINEL + "[ \t]?"

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: ColumnOrName) -> Column:
    """Lower-cased letter runs, in order, with repeats."""
    return F.transform(F.regexp_extract_all(_c(text), F.lit(TOKEN_PATTERN), 0), lambda w: F.lower(w))


def distinct_tokens(text: ColumnOrName) -> Column:
    # words are lower-cased once each; the order of first occurrence is that of ``tokens``
    words = F.array_distinct(F.regexp_extract_all(_c(text), F.lit(TOKEN_PATTERN), 0))
    return F.array_distinct(F.transform(words, lambda w: F.lower(w)))


def segments(text: ColumnOrName) -> Column:
    """Alternating word / non-word runs; concatenated they give back the text."""
    return F.regexp_extract_all(_c(text), F.lit(SEGMENT_PATTERN), 0)


def is_blank(text: ColumnOrName) -> Column:
    c = _c(text)
    return c.isNull() | (F.trim(c) == F.lit(""))


def has_sentinel(text: ColumnOrName) -> Column:
    return F.instr(_c(text), SENTINEL) > 0


def rewrite(text: ColumnOrName, is_loaded: Callable[[Column], Column]) -> Column:
    """Delete every word segment ``s`` with ``is_loaded(s)`` true, plus one
    following space or tab. Null for null input and for input that already
    holds the sentinel (rejected). No re-capitalisation.

    Segments alternate word / non-word runs, so a term never matches inside a
    longer word. Loaded segments become the sentinel, the array is joined back,
    and one regex pass removes sentinel + gap.
    """
    c = _c(text)
    marked = F.regexp_replace(
        F.array_join(F.transform(segments(c),
                                 lambda s: F.when(is_loaded(s), F.lit(SENTINEL)).otherwise(s)), ""),
        F.lit(SENTINEL_GAP_PATTERN), F.lit(""))
    return F.when(c.isNull() | has_sentinel(c), F.lit(None).cast("string")).otherwise(marked)


def rewrite_with_terms(text: ColumnOrName, terms: Sequence[str]) -> Column:
    """Rewrite with a driver-side term list whose size the caller has bounded;
    Spark turns the ``IN`` list into a hash set (InSet): O(1) per segment."""
    terms = sorted(set(terms))
    if not terms:
        c = _c(text)
        return F.when(c.isNull() | has_sentinel(c), F.lit(None).cast("string")).otherwise(c)
    return rewrite(text, lambda s: F.lower(s).isin(terms))


def rewrite_with_tiers(text: ColumnOrName, key: ColumnOrName, tiers: dict[str, Sequence[str]]) -> Column:
    """Rewrite where the term set depends on a per-row key (language, policy
    tier): ``tiers`` maps key value to its bounded term list."""
    k = _c(key)
    tiers = {v: sorted(set(t)) for v, t in tiers.items() if t}
    if not tiers:
        return rewrite_with_terms(text, [])

    def hit(s: Column) -> Column:
        e = F.lit(False)
        for v, t in sorted(tiers.items()):
            e = e | ((k == F.lit(v)) & F.lower(s).isin(t))
        return e
    return rewrite(text, hit)


def rewrite_with_flags(text: ColumnOrName, hits: ColumnOrName) -> Column:
    """Rewrite with this row's loaded terms given as an array column (the join
    path used when a lexicon is too large to inline)."""
    h = F.coalesce(_c(hits), F.array().cast("array<string>"))
    return rewrite(text, lambda s: F.array_contains(h, F.lower(s)))


def concat_fields(*cols: ColumnOrName, sep: str = " ") -> Column:
    """Join fields with ``sep``, skipping null and blank ones (trimmed)."""
    parts = [F.nullif(F.trim(_c(c)), F.lit("")) for c in cols]
    return F.nullif(F.concat_ws(sep, *parts), F.lit(""))


def hash_bucket(key: ColumnOrName, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the first 32 bits of md5(key);
    independent of partitioning, so a split is stable under repartition."""
    return (F.conv(F.substring(F.md5(_c(key)), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
