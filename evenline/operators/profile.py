"""Per-user bias profiles and personalised rewriting.

Reads are joined to per-document axis values (equi-join on the document id;
AQE splits a hot document). The profile is a two-phase aggregate per user, so a
user with a third of all reads still shuffles one partial row per partition.

The point-in-time value (mean over a user's earlier reads) is a running
aggregate. A plain window partitioned by user would put a hot user's reads in
one task, so the prefix is split into time chunks: per-chunk totals (small),
an exclusive running sum over chunks per user, and a running sum within each
(user, chunk) partition, added together. The within-chunk window and the join
to the chunk offsets share the (user, chunk) partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = ("truth_probability", "emotional_intensity", "bias_degree")


def link_reads(events: DataFrame, n_docs: int, event_key: str = "event_id") -> DataFrame:
    """Synthetic read -> document link of the test data: ``doc_id = event_id % n_docs``."""
    return events.withColumn("doc_id", F.pmod(F.col(event_key), F.lit(n_docs)))


def user_bias_profile(reads: DataFrame, doc_values: DataFrame, user: str = "user_id",
                      values: Sequence[str] = AXES) -> DataFrame:
    """``(user, n_reads, {value}_mean...)`` over all reads of each user.
    Reads of documents without values count as reads and enter no mean."""
    j = reads.join(doc_values, "doc_id", "left")
    return j.groupBy(user).agg(F.count(F.lit(1)).alias("n_reads"),
                               *[F.round(F.avg(v), 4).alias(f"{v}_mean") for v in values])


def prior_means(reads: DataFrame, doc_values: DataFrame, user: str = "user_id",
                order: Sequence[str] = ("ts", "event_id"), values: Sequence[str] = AXES,
                chunk: Column | None = None) -> DataFrame:
    """A33 point in time: for each read, the count and mean of each value over
    the same user's reads strictly before it in ``order``. Reads of documents
    without values count as reads and enter no mean.

    ``chunk`` (default: the minute of the first order column) must be monotone
    in ``order``; it bounds the rows any one window task sees, so it should be
    shorter than a user's densest burst.
    """
    j = reads.join(doc_values, "doc_id", "left")
    ch = chunk if chunk is not None else F.date_trunc("minute", F.col(order[0]))
    j = j.withColumn("_chunk", ch)
    totals = j.groupBy(user, "_chunk").agg(F.count(F.lit(1)).alias("_cn"),
                                           *[F.sum(v).alias(f"_cs_{v}") for v in values],
                                           *[F.count(v).alias(f"_ck_{v}") for v in values])
    before_chunk = Window.partitionBy(user).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(user, "_chunk",
                            F.coalesce(F.sum("_cn").over(before_chunk), F.lit(0)).alias("_on"),
                            *[F.sum(f"_cs_{v}").over(before_chunk).alias(f"_os_{v}") for v in values],
                            *[F.sum(f"_ck_{v}").over(before_chunk).alias(f"_ok_{v}") for v in values])
    within = (Window.partitionBy(user, "_chunk").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    j = j.select("*", F.count(F.lit(1)).over(within).alias("_wn"),
                 *[F.sum(v).over(within).alias(f"_ws_{v}") for v in values],
                 *[F.count(v).over(within).alias(f"_wk_{v}") for v in values])
    # null-safe: reads without a user are one user's, reads without a time one chunk (before all others)
    offsets = offsets.withColumnsRenamed({user: "_user", "_chunk": "_at"})
    j = j.join(offsets, F.col(user).eqNullSafe(F.col("_user")) & F.col("_chunk").eqNullSafe(F.col("_at")), "inner").drop("_user", "_at")
    n = F.col("_on") + F.col("_wn")
    out = j.withColumn("prior_reads", n)
    for v in values:
        s = F.coalesce(F.col(f"_os_{v}"), F.lit(0.0)) + F.coalesce(F.col(f"_ws_{v}"), F.lit(0.0))
        k = F.coalesce(F.col(f"_ok_{v}"), F.lit(0)) + F.col(f"_wk_{v}")
        out = out.withColumn(f"prior_{v}_mean", F.round(F.when(k > 0, s / k), 4))
    return out.drop("_chunk", "_on", "_wn", *[f"_{x}_{v}" for v in values for x in ("os", "ws", "ok", "wk")])


def policy_tier(prior_col: str, threshold: float = 0.5) -> Column:
    """A34 policy: readers whose earlier reads averaged at least ``threshold``
    emotional intensity get the strong rewrite; others (and first reads) the mild one."""
    return F.when(F.col(prior_col) >= F.lit(threshold), F.lit("strong")).otherwise(F.lit("mild"))
