"""Evaluation (A14-A17, D2). Aggregates are two-phase (partial map-side), and
per-row text metrics keep whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.functions.overlap import gram_count, ngram_overlap
from evenline.functions.text import tokens

EPS = 1e-15


def accuracy(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, correct, accuracy)`` over rows with a label and a prediction."""
    ok = df.where(F.col(label).isNotNull() & F.col(pred).isNotNull())
    return (ok.groupBy(*by)
              .agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.col(label) == F.col(pred)).alias("correct"))
              .withColumn("accuracy", F.round(F.col("correct") / F.col("n"), 4)))


def confusion(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """``(by..., label, pred, n)``."""
    ok = df.where(F.col(label).isNotNull() & F.col(pred).isNotNull())
    return ok.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 per class from a confusion table."""
    tp = conf.where(F.col("label") == F.col("pred")).groupBy(*by, F.col("label").alias("cls")).agg(
        F.sum("n").alias("tp"))
    actual = conf.groupBy(*by, F.col("label").alias("cls")).agg(F.sum("n").alias("actual"))
    predicted = conf.groupBy(*by, F.col("pred").alias("cls")).agg(F.sum("n").alias("predicted"))
    keys = list(by) + ["cls"]
    t = actual.join(predicted, keys, "full_outer").join(tp, keys, "left").fillna(0, ["tp", "actual", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted"))
    r = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual"))
    f1 = F.when(F.col("actual") + F.col("predicted") > 0, 2 * F.col("tp") / (F.col("actual") + F.col("predicted")))
    return t.select(*keys, "tp", "actual", "predicted", F.round(p, 4).alias("precision"),
                    F.round(r, 4).alias("recall"), F.round(f1, 4).alias("f1"))


def majority_baseline(train: DataFrame, test: DataFrame, label: str = "label",
                      by: Sequence[str] = ()) -> DataFrame:
    """Accuracy of always predicting the most frequent train label
    (ties to the smaller label)."""
    from pyspark.sql import Window
    counts = train.where(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count(F.lit(1)).alias("c"))
    t = test.where(F.col(label).isNotNull())
    if by:  # one label per group, joined on: any number of groups
        w = Window.partitionBy(*by).orderBy(F.col("c").desc(), F.col(label).asc())
        top = counts.withColumn("_r", F.row_number().over(w)).where("_r = 1")
        t = t.join(top.select(*by, F.col(label).alias("_major")), list(by), "left")
        major = F.col("_major")
    else:
        first = counts.orderBy(F.col("c").desc(), F.col(label).asc()).first()
        major = F.lit(first[label]) if first else F.lit(None).cast("string")
    return t.groupBy(*by).agg(F.round(F.avg((F.col(label) == major).cast("double")), 4).alias("majority_accuracy"))


def log_loss(df: DataFrame, label: str, probs: str, classes: Sequence[str], eps: float = EPS,
             by: Sequence[str] = ()) -> DataFrame:
    """Mean ``-ln(max(p[label], eps))`` over rows with a label and scores;
    a label the model never saw has probability 0 and costs ``-ln(eps)``."""
    cls = F.array(*[F.lit(c) for c in classes])
    pos = F.array_position(cls, F.col(label)).cast("int")
    p = F.when(pos > 0, F.element_at(F.col(probs), F.greatest(pos, F.lit(1)))).otherwise(F.lit(0.0))
    ok = df.where(F.col(label).isNotNull() & F.col(probs).isNotNull())
    return ok.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                               F.round(F.avg(-F.log(F.greatest(p, F.lit(eps)))), 4).alias("log_loss"))


def accuracy_and_loss(df: DataFrame, label: str, pred: str, probs: str, classes: Sequence[str],
                      eps: float = EPS, by: Sequence[str] = ()) -> DataFrame:
    """A14 and A15 in one aggregate: ``(by..., n, correct, accuracy, log_loss)``;
    an unseen label counts as wrong."""
    cls = F.array(*[F.lit(c) for c in classes])
    pos = F.array_position(cls, F.col(label)).cast("int")
    ok = df.where(F.col(label).isNotNull() & F.col(pred).isNotNull())
    p = F.when(pos > 0, F.element_at(F.col(probs), F.greatest(pos, F.lit(1)))).otherwise(F.lit(0.0))
    return (ok.groupBy(*by)
              .agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.col(label) == F.col(pred)).alias("correct"),
                   F.round(F.avg(-F.log(F.greatest(p, F.lit(eps)))), 4).alias("log_loss"))
              .withColumn("accuracy", F.round(F.col("correct") / F.col("n"), 4)))


def evaluate_long(scored: DataFrame, specs: Sequence[tuple], eps: float = EPS) -> DataFrame:
    """A14 and A15 of many models in one aggregate over one scored frame.

    ``specs`` are ``(task, variant, label column, model name, classes)``; each
    row becomes a small array of (task, variant, label, prediction, p of the
    label), exploded and grouped once: ``(task, variant, n, correct, accuracy, log_loss)``."""
    items = []
    for task, variant, label, name, classes in specs:
        lab = F.col(label).cast("string")
        pos = F.array_position(F.array(*[F.lit(c) for c in classes]), lab).cast("int")
        p = F.when(pos > 0, F.element_at(F.col(f"{name}_probs"), F.greatest(pos, F.lit(1)))).otherwise(F.lit(0.0))
        items.append(F.when(lab.isNotNull() & F.col(f"{name}_label").isNotNull(), F.struct(
            F.lit(task).alias("task"), F.lit(variant).cast("string").alias("variant"), lab.alias("label"),
            F.col(f"{name}_label").alias("pred"), p.alias("p"))))
    rows = scored.select(F.explode(F.array(*items)).alias("e")).where("e is not null").select("e.*")
    return (rows.groupBy("task", "variant")
                .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("pred")).alias("correct"),
                     F.round(F.avg(-F.log(F.greatest("p", F.lit(eps)))), 4).alias("log_loss"))
                .withColumn("accuracy", F.round(F.col("correct") / F.col("n"), 4)))


def f1_from(overlap: Column, n_ref: Column, n_hyp: Column) -> Column:
    """F1 = 2 * overlap / (|ref| + |hyp|); null when both are empty."""
    return F.when(n_ref + n_hyp > 0, F.lit(2.0) * overlap / (n_ref + n_hyp))


def rouge_n(df: DataFrame, key: str, ref: str, hyp: str, n: int = 1) -> DataFrame:
    """Clipped n-gram overlap, precision, recall and F1 per row, whole texts.

    A projection: tokens in the JVM, the per-row count intersection in an
    Arrow-batched pandas UDF, so no gram is exploded or shuffled.
    """
    base = df.select(key, tokens(ref).alias("_rt"), tokens(hyp).alias("_ht"))
    return with_rouge(base, "_rt", "_ht", f"rouge{n}", n).select(
        key, *[f"rouge{n}_{x}" for x in ("overlap", "p", "r", "f1")])


def with_rouge(df: DataFrame, ref_toks: str, hyp_toks: str, prefix: str, n: int = 1) -> DataFrame:
    """Adds ``{prefix}_overlap, _p, _r, _f1`` from two token arrays (null if either is null)."""
    ov = f"{prefix}_overlap"
    nr, nh = gram_count(ref_toks, n), gram_count(hyp_toks, n)
    # equal token lists overlap in every gram: only the others go to Python
    same = F.col(ref_toks).eqNullSafe(F.col(hyp_toks))
    none = F.lit(None).cast("array<string>")
    df = df.withColumn("_sr", F.when(~same, F.col(ref_toks)).otherwise(none)).withColumn("_sh", F.when(~same, F.col(hyp_toks)).otherwise(none))
    df = df.withColumn(ov, F.when(same, nr).otherwise(ngram_overlap("_sr", "_sh", n))).drop("_sr", "_sh")
    o = F.col(ov)
    return (df.withColumn(f"{prefix}_p", F.round(F.when(nh > 0, o / nh), 4))
              .withColumn(f"{prefix}_r", F.round(F.when(nr > 0, o / nr), 4))
              .withColumn(f"{prefix}_f1", F.round(f1_from(o, nr, nh), 4)))


def token_jaccard(a: str, b: str) -> Column:
    """|set(a) & set(b)| / |set(a) | set(b)| (hash-based set ops in the row)."""
    u = F.size(F.array_union(F.col(a), F.col(b)))
    return F.when(u > 0, F.size(F.array_intersect(F.col(a), F.col(b))) / u)


def rouge_l(df: DataFrame, key: str, ref: str, hyp: str) -> DataFrame:
    """LCS-based precision, recall and F1 per row on whole token arrays
    (exact bit-parallel LCS in an Arrow-batched pandas UDF; no token cap)."""
    from evenline.functions.lcs import lcs
    base = df.select(key, tokens(ref).alias("_r"), tokens(hyp).alias("_h"))
    same = F.col("_r").eqNullSafe(F.col("_h"))
    none = F.lit(None).cast("array<string>")
    base = base.withColumn("lcs", F.when(same, F.size("_r").cast("long")).otherwise(
        lcs(F.when(~same, F.col("_r")).otherwise(none), F.when(~same, F.col("_h")).otherwise(none))))
    base = base.withColumn("lcs", F.when(F.col("_r").isNotNull(), F.col("lcs")))
    nr, nh, o = F.size("_r"), F.size("_h"), F.col("lcs")
    return base.select(key, "lcs",
                       F.round(F.when(nh > 0, o / nh), 4).alias("rougeL_p"),
                       F.round(F.when(nr > 0, o / nr), 4).alias("rougeL_r"),
                       F.round(f1_from(o, nr, nh), 4).alias("rougeL_f1"))


# P(Poisson(1) <= k) for k = 0, 1, ...; a replicate's weight of a row is the number of them at or below
# a uniform value from md5("<id>:<replicate>").
POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119)


def metric_intervals(values: DataFrame, key: str, value: str, by: Sequence[str] = (), replicates: int = 100, level: float = 0.95) -> DataFrame:
    """Bootstrap intervals of a mean in one pass: ``by..., n, estimate, low, high`` for rows with a ``value``.

    In each of ``replicates`` samples a row counts Poisson(1) times, by a hash of its key and the replicate: no sample
    is drawn or shuffled, any row's weights can be made anywhere, and reruns agree. Every replicate is a weighted
    sum and a sum of weights, added up map-side. ``low`` and ``high`` are the replicates' means at the ends of the
    ``level`` interval (the k-th smallest and largest, ``k = ceil(replicates * (1 - level) / 2)``)."""
    rows = values.where(F.col(value).isNotNull()).select(*by, F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_k"), F.col(value).cast("double").alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_b"))
    u = F.conv(F.substring(F.md5(F.concat_ws(":", "_k", F.col("_b").cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    w = sum(((u >= F.lit(p)).cast("int") for p in POISSON[1:]), (u >= F.lit(POISSON[0])).cast("int"))
    sums = rows.select(*by, "_v", "_b", w.alias("_w")).groupBy(*by, "_b").agg(F.sum(F.col("_w") * F.col("_v")).alias("s"), F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n"), F.avg("_v").alias("m"))
    means = F.array_sort(F.collect_list(F.when(F.col("w") > 0, F.col("s") / F.col("w"))))  # one per replicate
    out = sums.groupBy(*by).agg(F.max("n").alias("n"), F.max("m").alias("m"), means.alias("a"))
    k = F.greatest(F.lit(1), F.ceil(F.size("a") * F.lit((1 - level) / 2) - 1e-9).cast("int"))
    return out.select(*by, "n", F.round("m", 4).alias("estimate"), F.round(F.get("a", k - 1), 4).alias("low"), F.round(F.get("a", F.size("a") - k), 4).alias("high"))
