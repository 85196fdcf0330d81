"""Model comparison, selection and staged training.

The reference compares two encoders per task and keeps the lighter one when
accuracy is close ("training speed and lightness"). Here each candidate is a
Spark job; the driver loops over a fixed, small candidate list and unions the
one-row records. Selection is a window over the record table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenline.operators import metrics
from evenline.operators.naive_bayes import fit_nb_variants, nb_scores
from evenline.operators.splits import share_below

RECORD_SCHEMA = ("task string, model string, n_train long, n_test long, accuracy double, "
                 "n_params long, fit_seconds double")


def evaluate(spark: SparkSession, task: str, train: DataFrame, test: DataFrame, key: str,
             candidates: Sequence[tuple[str, Callable]]) -> DataFrame:
    """One record per candidate: accuracy on ``test``, parameter count and
    wall-clock fit + evaluation seconds (measured, so not reproducible)."""
    n_train = train.count()
    n_test = test.where(F.col("label").isNotNull()).count()
    recs = []
    for name, run in candidates:
        t0 = time.time()
        acc_df, n_params = run(train, test)
        row = acc_df.first()
        acc = row["accuracy"] if "accuracy" in acc_df.columns else row["majority_accuracy"]
        recs.append((task, name, n_train, n_test, float(acc) if acc is not None else None,
                     int(n_params), round(time.time() - t0, 3)))
    return spark.createDataFrame(recs, RECORD_SCHEMA)


def select_model(records: DataFrame, metric: str = "accuracy", tolerance: float = 0.01,
                 cost: str = "n_params") -> DataFrame:
    """Per task keep candidates within ``tolerance`` of the best metric,
    then the cheapest (ties by model name)."""
    best = F.max(metric).over(Window.partitionBy("task"))
    near = records.withColumn("_best", best).where(F.col(metric) >= F.col("_best") - F.lit(tolerance))
    w = Window.partitionBy("task").orderBy(F.col(cost).asc(), F.col("model").asc())
    return near.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_best")


def staged_fit(train: DataFrame, test: DataFrame, key: str, task: str,
               fractions: Sequence[float] = (0.1, 0.5, 1.0), min_df: int = 5) -> DataFrame:
    """Fit on nested shares of the train rows (the 1K/5K/10K ladder is
    shares 0.1/0.5/1.0) and report size, accuracy and log loss per stage.

    One task of :func:`staged_fit_tasks`: one aggregation, one scoring pass."""
    return staged_fit_tasks(train, test, key, {task: "label"}, fractions, min_df)


def staged_rewriter(train: DataFrame, test: DataFrame, key: str, label: str = "label",
                    positive: str = "1", fractions: Sequence[float] = (0.1, 0.5, 1.0),
                    min_df: int = 8, min_share: float = 0.95) -> DataFrame:
    """A13 for the rewriter (the reference's stepwise 1K/5K/10K training): per
    nested train share, learn the lexicon (A24), rewrite every held-out row
    (A23) and report lexicon size, rows changed, positive rows changed and mean
    ROUGE-1 F1 of rewrite against original (A16).

    The lexicons of all stages come from one conditional-count aggregate over
    one explode; the held-out rows are read once, every row's rewrites become a
    small array, exploded and grouped by stage."""
    from evenline.functions.text import distinct_tokens, tokens
    from evenline.operators.metrics import with_rouge
    from evenline.operators.rewrite import neutral_rewrite
    from evenline.session import ensure_checkpoint_dir
    fr = sorted(fractions)
    k = range(len(fr))
    docs = train.where(F.col("text").isNotNull() & F.col(label).isNotNull()).select(
        (F.col(label).cast("string") == F.lit(positive)).alias("_pos"), *[share_below(F.col("text"), f).alias(f"_in{i}") for i, f in enumerate(fr)],
        F.explode(distinct_tokens("text")).alias("term"))
    counts = docs.groupBy("term").agg(*[F.count_if(F.col(f"_in{i}")).alias(f"df{i}") for i in k],
                                      *[F.count_if(F.col(f"_in{i}") & F.col("_pos")).alias(f"pos{i}") for i in k])
    bp = int(round(min_share * 10000))

    def loaded(i: int):
        return (F.col(f"df{i}") >= min_df) & (F.col(f"pos{i}") * 10000 >= F.lit(bp) * F.col(f"df{i}"))
    some = loaded(0)
    for i in k:
        some = some | loaded(i)
    ensure_checkpoint_dir(train.sparkSession)
    lexicon = counts.where(some).select("term", *[loaded(i).alias(f"_l{i}") for i in k]).checkpoint(eager=True)
    n_terms = lexicon.agg(*[F.count_if(F.col(f"_l{i}")).alias(f"n{i}") for i in k]).first()
    rows = test
    for i in k:
        rows = neutral_rewrite(rows, lexicon.where(f"_l{i}").select("term"), "text", f"_n{i}", key=key)
    stages = F.array(*[F.struct(F.lit(float(f)).alias("stage"), F.lit(int(n_terms[f"n{i}"])).cast("bigint").alias("n_terms"), F.col(f"_n{i}").alias("n"))
                       for i, f in enumerate(fr)])
    t = rows.select(label, "text", F.explode(stages).alias("s")).select(
        label, "s.stage", "s.n_terms", (~F.col("s.n").eqNullSafe(F.col("text"))).alias("_ch"), tokens("text").alias("_a"), tokens("s.n").alias("_b"))
    hit = F.col(label) == F.lit(positive)
    return with_rouge(t, "_a", "_b", "r1", 1).groupBy("stage", "n_terms").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_ch")).alias("n_changed"), F.count_if(hit).alias("n_positive"),
        F.count_if(F.col("_ch") & hit).alias("n_positive_changed"), F.round(F.avg("r1_f1"), 4).alias("rouge1_f1_mean"))


def staged_fit_tasks(train: DataFrame, test: DataFrame, key: str, labels: dict[str, str],
                     fractions: Sequence[float] = (0.1, 0.5, 1.0), min_df: int = 5) -> DataFrame:
    """A13 for several tasks over the same documents (``labels`` maps task to
    its label column): every (task, stage) model comes from one aggregation and
    one scoring pass; each is evaluated on the rows that carry its label."""
    fr = sorted(fractions)
    variants = [(f"{t}_s{int(round(f * 1000))}", share_below(F.col("text"), f), min_df, lab)
                for t, lab in labels.items() for f in fr]
    ms = fit_nb_variants(train, variants)
    lab_cols = sorted(set(labels.values()))
    s = nb_scores(test.select(key, "text", *[F.col(c).cast("string").alias(c) for c in lab_cols]),
                  key, {"": "text"}, list(ms.values()), carry=lab_cols)
    specs = [(t, f"{t}_s{int(round(f * 1000))}", lab, f"{t}_s{int(round(f * 1000))}", ms[f"{t}_s{int(round(f * 1000))}"].classes)
             for t, lab in labels.items() for f in fr]
    ev = metrics.evaluate_long(s, specs)
    known = F.create_map(*[x for t in labels for f in fr for x in (F.lit(f"{t}_s{int(round(f * 1000))}"), F.struct(
        F.lit(float(f)).alias("stage"), F.lit(ms[f"{t}_s{int(round(f * 1000))}"].n_train).cast("bigint").alias("n_train")))])
    return ev.withColumn("_v", F.element_at(known, F.col("variant"))).select(
        "task", F.col("_v.stage").alias("stage"), F.col("_v.n_train").alias("n_train"), "n", "accuracy", "log_loss")


def nb_candidates(train: DataFrame, test: DataFrame, key: str, labels: dict[str, str],
                  min_dfs: Sequence[int] = (5, 3)) -> DataFrame:
    """A11/A12 records for naive Bayes candidates of several tasks: all
    (task, min_df) models from one aggregation and one scoring pass;
    ``(task, model, accuracy, n_params)``."""
    variants = [(f"{t}_nb_df{md}", None, md, lab) for t, lab in labels.items() for md in min_dfs]
    ms = fit_nb_variants(train, variants)
    lab_cols = sorted(set(labels.values()))
    s = nb_scores(test.select(key, "text", *[F.col(c).cast("string").alias(c) for c in lab_cols]),
                  key, {"": "text"}, list(ms.values()), carry=lab_cols)
    ev = metrics.evaluate_long(s, [(t, f"nb_df{md}", lab, f"{t}_nb_df{md}", ms[f"{t}_nb_df{md}"].classes) for t, lab in labels.items() for md in min_dfs])
    params = F.create_map(*[x for t in labels for md in min_dfs for x in (F.lit(f"{t}_nb_df{md}"), F.lit(ms[f"{t}_nb_df{md}"].n_params).cast("bigint"))])
    return ev.select("task", F.col("variant").alias("model"), "accuracy", F.element_at(params, F.concat_ws("_", "task", "variant")).alias("n_params"))
