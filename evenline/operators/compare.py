"""Verification and comparison.

The reference scores the rewrite again and compares; the radar chart shows
three axes. Axis values use one fixed class per axis (gap G4), because the top
label can flip between the two texts:

  truth_probability    P(truth = positive class)
  emotional_intensity  P(sentiment = positive class)
  bias_degree          top-class probability of the bias model (how strongly
                       the text leans to any class)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import tokens
from evenline.operators.metrics import token_jaccard, with_rouge
from evenline.operators.naive_bayes import NBModel, class_probability, nb_scores

# Fixed axis names, in chart order.
AXES = ("truth_probability", "emotional_intensity", "bias_degree")
PHASES = ("before", "after")


def rescore(df: DataFrame, models: Sequence[NBModel], key: str, before: str = "text",
            after: str = "neutral", carry: Sequence[str] = ()) -> DataFrame:
    """Every model on the original and on the rewrite, in one pass
    (one explode, one join, one aggregate per key). Only rows the rewrite
    changed explode the rewrite; the others reuse the original's sums."""
    return nb_scores(df, key, {"before": before, "after": after}, models, carry,
                     reuse={"after": "before"})


def axis_values(df: DataFrame, models: dict[str, NBModel], phase: str, positive: str = "1") -> DataFrame:
    """Adds ``{phase}_{axis}`` for the three axes from ``{phase}_{task}_*`` columns."""
    t, s = models["truth"], models["sentiment"]
    return (df.withColumn(f"{phase}_truth_probability", class_probability(f"{phase}_truth", t.classes, positive))
              .withColumn(f"{phase}_emotional_intensity",
                          class_probability(f"{phase}_sentiment", s.classes, positive))
              .withColumn(f"{phase}_bias_degree", F.col(f"{phase}_bias_conf")))


def compare_before_after(scored: DataFrame, models: dict[str, NBModel], key: str,
                         tasks: Sequence[str] = ("truth", "sentiment", "bias"),
                         carry: Sequence[str] = ()) -> DataFrame:
    """A26 on a rescored frame: labels before/after, flip flag and the delta of
    each axis value (after - before)."""
    df = axis_values(axis_values(scored, models, "before"), models, "after")
    cols = [F.col(key)] + [F.col(c) for c in carry]
    for t in tasks:
        b, a = F.col(f"before_{t}_label"), F.col(f"after_{t}_label")
        cols += [b.alias(f"{t}_before"), a.alias(f"{t}_after"),
                 F.when(b.isNotNull() & a.isNotNull(), b != a).alias(f"{t}_flip")]
    for ax in AXES:
        cols += [F.col(f"before_{ax}"), F.col(f"after_{ax}"),
                 (F.col(f"after_{ax}") - F.col(f"before_{ax}")).alias(f"{ax}_delta")]
    return df.select(*cols)


def compare_tables(before: DataFrame, after: DataFrame, key: str, tasks: Sequence[str]) -> DataFrame:
    """A26 for results produced elsewhere (an external model): an inner
    equi-join on the key of two ``(key, {task}_label, {task}_conf)`` tables."""
    b = before.select(key, *[F.col(f"{t}_{x}").alias(f"b_{t}_{x}") for t in tasks for x in ("label", "conf")])
    a = after.select(key, *[F.col(f"{t}_{x}").alias(f"a_{t}_{x}") for t in tasks for x in ("label", "conf")])
    j = b.join(a, key, "inner")
    cols = [F.col(key)]
    for t in tasks:
        cols += [F.col(f"b_{t}_label").alias(f"{t}_before"), F.col(f"a_{t}_label").alias(f"{t}_after"),
                 (F.col(f"b_{t}_label") != F.col(f"a_{t}_label")).alias(f"{t}_flip")]
    return j.select(*cols)


def meaning_preserved(df: DataFrame, key: str, before: str = "text", after: str = "neutral",
                      min_f1: float = 0.8) -> DataFrame:
    """ROUGE-1 F1 of rewrite against original (whole texts) against a
    threshold, with token Jaccard beside it. All in the row: no shuffle."""
    base = df.select(key, tokens(before).alias("_b"), tokens(after).alias("_a"))
    base = with_rouge(base, "_b", "_a", "rouge1")
    base = base.withColumn("jaccard", F.round(token_jaccard("_b", "_a"), 4))
    return base.select(key, "rouge1_f1", "jaccard",
                       F.when(F.col("rouge1_f1").isNotNull(), F.col("rouge1_f1") >= F.lit(min_f1))
                        .alias("preserved"))


def radar_rows(compared: DataFrame, key: str) -> DataFrame:
    """Long rows ``(key, phase, axis, value)`` ready for a radar chart."""
    ids = [key]
    vals = [f"{p}_{a}" for p in PHASES for a in AXES]
    long = compared.unpivot(ids, vals, "name", "value")
    return long.select(key, F.substring_index("name", "_", 1).alias("phase"),
                       F.expr("substr(name, instr(name, '_') + 1)").alias("axis"),
                       F.round("value", 4).alias("value"))


def effect_summary(compared: DataFrame, changed: str, by: Sequence[str],
                   tasks: Sequence[str] = ("truth", "sentiment", "bias")) -> DataFrame:
    """Effect over a corpus, overall and per group (ROLLUP over ``by``):
    rows, rows changed, mean delta per axis, flip rate per task."""
    aggs = [F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(changed)).alias("n_changed"),
            F.round(F.avg(F.col(changed).cast("double")), 4).alias("share_changed")]
    aggs += [F.round(F.avg(f"{ax}_delta"), 4).alias(f"{ax}_delta_mean") for ax in AXES]
    aggs += [F.round(F.avg(F.col(f"{t}_flip").cast("double")), 4).alias(f"{t}_flip_rate") for t in tasks]
    return compared.rollup(*by).agg(*aggs)




def effect_quantiles(compared: DataFrame, by: Sequence[str], quantiles: Sequence[float] = (0.1, 0.5, 0.9), size: int = 4096) -> DataFrame:
    """Quantiles of each axis' delta, overall and per group (ROLLUP over ``by``): ``by..., axis, n, p10, p50, p90``.

    One KLL sketch a group and axis, filled map-side and merged, so a group of any size shuffles a sketch a partition.
    Groups of at most ``size`` values are exact; in larger ones a quantile's rank is off by a share of some ``1 / size``
    (about 0.05 % at 4,096). The quantile is the least value with at least that share of the values up to it."""
    sketches = compared.rollup(*by).agg(*[F.kll_sketch_agg_double(F.col(f"{ax}_delta"), F.lit(size)).alias(ax) for ax in AXES])
    long = sketches.select(*by, F.explode(F.array(*[F.struct(F.lit(ax).alias("axis"), F.col(ax).alias("k")) for ax in AXES])).alias("s")).select(*by, "s.axis", "s.k")
    n = F.kll_sketch_get_n_double("k")
    return long.select(*by, "axis", n.alias("n"), *[(F.round(F.when(n > 0, F.kll_sketch_get_quantile_double("k", F.lit(float(q)))), 4) + 0.0).alias(f"p{round(100 * q)}") for q in quantiles])
