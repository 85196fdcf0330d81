"""Operator 3, mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words. Sources, by code point with null last,
weigh ``weights`` in turn and share all words; no target passes ``max_repeat``
times its source's words, and what a stopped source leaves is shared again.

A source takes each document ``target // size`` whole times. What is left of the
budget is met exactly or as nearly as lengths allow: documents are counted by
exact length, every length gives its proportional share, and a bounded-knapsack
dynamic programme over the lengths left closes the remaining gap. Which
documents of a length are taken follows a seeded hash of their ids, so reruns agree.

The plan needs one row per (source, length) - not per document - in a task per
source. Selection inside a length is cut over ``BUCKETS`` hash ranges: only the
one range where the count falls is ranked, so a length that a third of all
documents share is no single task.

Null and blank texts have size 0 and add no word; null sources are one
source; repeated rows count as documents of their own (equal rows are
interchangeable). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evenline.llm.spool import spool
from evenline.session import ship_package

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BUDGET = 1 << 15   # words that the dynamic programme settles; the rest is proportional
BUCKETS = 1024
SEED = 11


def n_words(text: Column) -> Column:
    """Number of runs outside ``\\x20`` and ``\\x09-\\x0D``; null gives 0."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int") -
            ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def source_targets(by_source: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: weighted
    shares of the total, stopped at ``max_repeat`` times the size, the excess
    reshared. Water-filling in closed form: by size per weight, a source is
    stopped as long as its bound is under its share of what is left."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    bound = F.col("source_size") * max_repeat
    d = by_source.withColumn("w", w).withColumn("bound", bound)
    every = W.orderBy(F.col("bound") / F.col("w"), F.col("source").asc_nulls_last())
    before = every.rowsBetween(W.unboundedPreceding, -1)
    after = every.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    d = d.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0))) / F.sum("w").over(after))
    open_ = F.when(F.col("bound") > F.col("level") * F.col("w"), F.col("level"))
    d = d.withColumn("level", F.first(open_, ignorenulls=True).over(whole))
    return d.select("source", "source_size", F.coalesce(F.least(F.col("level") * F.col("w"), F.col("bound").cast("double")), F.col("bound").cast("double")).alias("target"))


def nearest_subset(sizes: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each size to take so that the sum is as near ``budget`` as
    can be (the smaller sum on a tie): bounded knapsack on a bitset of reachable
    sums, counts in binary pieces, sizes from the largest. It stops as soon as
    the best sum that the sizes' divisor allows is reachable."""
    took = [0] * len(sizes)
    live = [k for k in range(len(sizes)) if sizes[k] > 0 and counts[k] > 0]
    if not live or budget <= 0:
        return took
    top = budget + min(budget, max(sizes[k] for k in live))  # a sum further off loses to taking nothing
    g = 0
    for k in live:
        g = gcd(g, sizes[k])
    low = budget // g * g
    ideal = low if budget - low <= low + g - budget else low + g
    mask = (1 << (top + 1)) - 1
    reach, layers = 1, []
    for k in sorted(live, key=lambda k: -sizes[k]):
        left, piece = min(counts[k], top // sizes[k]), 1
        while left > 0:
            p = min(piece, left)
            layers.append((reach, k, p))
            reach |= (reach << (p * sizes[k])) & mask
            left, piece = left - p, piece * 2
        if reach >> ideal & 1:
            break
    at = min((s for s in range(top + 1) if reach >> s & 1), key=lambda s: (abs(s - budget), s)) if not reach >> ideal & 1 else ideal
    for before, k, p in reversed(layers):
        if not before >> at & 1:
            took[k] += p
            at -= p * sizes[k]
    return took


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each size for a budget below all words."""
    total = int(sum(int(s) * int(c) for s, c in zip(sizes, counts)))
    if total <= 0 or budget <= 0:
        return np.zeros(len(sizes), np.int64)
    # a budget within the programme's reach is its alone; a larger one is first met in proportion
    take = np.array([int(c) * budget // total if budget > BUDGET else 0 for c in counts], np.int64)
    left = counts - take
    rest = budget - int(sum(int(s) * int(c) for s, c in zip(sizes, take)))
    for k in np.argsort(-sizes, kind="stable"):
        if rest <= BUDGET:
            break
        n = min(int(left[k]), (rest - BUDGET) // max(1, int(sizes[k]))) if sizes[k] > 0 else 0
        take[k] += n
        left[k] -= n
        rest -= n * int(sizes[k])
    return take + np.array(nearest_subset([int(x) for x in sizes], [int(x) for x in left], rest), np.int64)


def _plan(pdf):
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    full = min(MAX_REPEAT, int(target // size)) if size else 0
    budget = min(round(target) - full * size, size)
    pdf = pdf.sort_values("size", kind="stable")
    sizes, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    pdf["full"] = full
    pdf["extra"] = fit_counts(sizes, counts, budget) if full < MAX_REPEAT else 0
    return pdf[["source", "size", "n", "source_size", "target", "full", "extra"]]


def _same(a: str, b: str, *cols: str) -> Column:
    on = F.lit(True)
    for c in cols:
        on = on & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return on


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``_row`` (all columns of ``docs`` as one) and what selection needs of them: ``_source, _size, _h, _bucket``, and
    ``_doc, _tie`` to tell rows of one id and size apart. Columns of ``docs`` can have any names."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_doc"), F.col("source").cast("string").alias("_source"),
                       n_words(F.col("text")).alias("_size"), F.xxhash64("text", *plain).alias("_tie"))
    return rows.withColumn("_h", F.xxhash64(F.lit(seed), "_doc", "_size")).withColumn("_bucket", F.pmod("_h", F.lit(BUCKETS)).cast("int"))


def _plan_cells(keyed: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Per (source, size, bucket): whole copies ``full`` of every document, and how many of its ``n`` documents ``k`` are taken once more."""
    cells = spool(keyed.groupBy("_source", "_size", "_bucket").agg(F.count("*").alias("n")), "lengths")
    lengths = cells.groupBy("_source", "_size").agg(F.sum("n").alias("n")).withColumnsRenamed({"_source": "source", "_size": "size"})
    targets = spool(source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights), "targets")
    given = lengths.alias("l").join(targets.alias("t"), _same("l", "t", "source")).select("l.source", "l.size", "l.n", "t.source_size", "t.target")
    plan = spool(given.groupBy("source").applyInPandas(_plan, "source string, size long, n long, source_size long, target double, full int, extra long"), "plan")
    part = cells.alias("c").join(plan.withColumnsRenamed({"source": "_source", "size": "_size"}).alias("p"), _same("c", "p", "_source", "_size"))
    part = part.select("c._source", "c._size", "c._bucket", "c.n", "p.extra", "p.full", "p.source_size", "p.target")
    upto = W.partitionBy("_source", "_size").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return part.withColumn("k", F.greatest(F.lit(0), F.least("n", F.col("extra") - F.coalesce(F.sum("n").over(upto), F.lit(0)))))


def _select(keyed: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows of ``keyed`` with ``_copies``, their copies in the mix; only ranges that the count cuts are ranked."""
    rows = keyed.alias("d").join(cells.alias("p"), _same("d", "p", "_source", "_size", "_bucket")).select(
        "d.*", *[F.col(f"p.{c}").alias(f"_{c}") for c in ("source_size", "target", "full", "k", "n")])
    whole = rows.where("_k = 0 or _k = _n").withColumn("_copies", F.col("_full") + (F.col("_k") > 0).cast("int"))
    rank = F.row_number().over(W.partitionBy("_source", "_size", "_bucket").orderBy("_h", "_doc", "_tie"))
    cut = rows.where("_k > 0 and _k < _n").withColumn("_copies", F.col("_full") + (rank <= F.col("_k")).cast("int"))
    return whole.unionByName(cut)


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per row of ``docs`` (``doc_id, text, source``);
    ``taken`` is ``size`` times the document's copies in the mix."""
    ship_package(docs.sparkSession)
    keyed = spool(_keyed(docs.select("doc_id", "source", "text"), seed).drop("_row"), "sizes")
    return _select(keyed, _plan_cells(keyed, weights)).select(F.col("_doc").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                                                              F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, as often as they are taken."""
    ship_package(docs.sparkSession)
    keyed = spool(_keyed(docs, seed).select("_source", "_size", "_bucket"), "sizes")
    out = _select(_keyed(docs, seed), _plan_cells(keyed, weights)).where("_copies > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
