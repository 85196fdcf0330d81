"""Cross-validation, paired comparison and decision thresholds.

*Folds by subtraction.* A fold's model is the counts of all rows less those of the fold,
so the models of all folds, tasks and ``min_df`` candidates come from one aggregate of
(term, fold, class) counts. Every row is then scored once, by the models of the other
folds, in one join on (fold, term).

*McNemar's test* compares two candidates on the same rows by the rows that only one of
them has right. *Thresholds* come from a histogram of scores: bins are counts, so
histograms of parts of the data add up, and one pass gives the ROC curve, the area under
it and the cut with the best accuracy.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenline.functions.text import distinct_tokens, is_blank
from evenline.guards import KEY_BYTES, MAX_BROADCAST_BYTES, MAX_CLASSES, bounded_collect
from evenline.operators.naive_bayes import ALPHA, summed
from evenline.session import ensure_checkpoint_dir, written

FOLDS = 5
MIN_DFS = (5, 3)
MAJORITY = "majority"
# Fixed value: the 95 % point of chi-square with one degree of freedom.
CHI2_95 = 3.841459
BIN = 0.25       # width of a score bin, in logits
EDGE = 400       # bins to either side of 0; scores beyond them fall in the last ones


def _weight(n: Column, total: float) -> Column:
    return F.log((n + F.lit(ALPHA)) / F.lit(total))


def fold_predictions(train: DataFrame, labels: Mapping[str, str], fold: Column, folds: int = FOLDS, min_dfs: Sequence[int] = MIN_DFS, text: str = "text",
                     max_broadcast: int = MAX_BROADCAST_BYTES, row: str | None = None) -> tuple[DataFrame, dict[tuple[str, str], int]]:
    """``task, model, fold, label, pred`` per labelled row, task and candidate (``nb_df{min_df}`` and ``majority``), each
    predicted by a model that has not seen the row's fold; and the parameters of every candidate on all rows.

    ``fold`` is a whole number in ``[0, folds)``, equal for equal texts; blank texts and null labels take no part. With
    ``row``, a column of a written table that tells its rows apart, ``text`` holds the distinct tokens (null for a blank
    text) and the rows are not written again."""
    tasks = list(labels)
    ys = [F.col(labels[t]).cast("string").alias(f"y{j}") for j, t in enumerate(tasks)]
    if row is None:  # read for the counts and for the scores: tokens are found once, row numbers stay
        rows = written(train.where(~is_blank(text)).select(F.monotonically_increasing_id().alias("row"), fold.cast("int").alias("fold"), distinct_tokens(text).alias("t"), *ys), "fold-rows")
    else:
        rows = train.where(F.col(text).isNotNull()).select(F.col(row).alias("row"), fold.cast("int").alias("fold"), F.col(text).alias("t"), *ys)
    pairs = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"y{j}").alias("y")) for j in range(len(tasks))]))
    got = bounded_collect(rows.select("fold", pairs.alias("e")).where("e.y is not null").groupBy("fold", "e.j", "e.y").count(), MAX_CLASSES * folds * len(tasks))
    if got is None:
        raise ValueError(f"more than {MAX_CLASSES} classes a task")
    sizes = {(r["j"], r["y"], r["fold"]): r["count"] for r in got}
    classes = [sorted({y for k, y, _ in sizes if k == j}) for j in range(len(tasks))]
    cells = [(j, c) for j in range(len(tasks)) for c in range(len(classes[j]))]

    def name(j: int, c: int) -> str:
        return f"n{j}_{c}"
    here = [F.count_if((F.col("fold") == f) & (F.col(f"y{j}") == F.lit(classes[j][c]))).alias(f"{name(j, c)}_{f}") for f in range(folds) for j, c in cells]
    counts = rows.select("*", F.explode("t").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"), *here).where(F.col("df") >= min(min_dfs))
    ensure_checkpoint_dir(train.sparkSession)
    counts = counts.checkpoint(eager=True)
    # per fold the counts of all other folds; the last "fold" is none, for the model on all rows
    whole = {jc: sum((F.col(f"{name(*jc)}_{f}") for f in range(1, folds)), F.col(f"{name(*jc)}_0")) for jc in cells}
    others = F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), *[(whole[jc] - F.col(f"{name(*jc)}_{f}") if f < folds else whole[jc]).alias(name(*jc)) for jc in cells]) for f in range(folds + 1)]))
    left = counts.select("term", others.alias("o")).select("term", "o.*")
    df = {j: sum((F.col(name(j, c)) for c in range(1, len(classes[j]))), F.col(name(j, 0))) for j in range(len(tasks)) if classes[j]}
    kept = {(j, m): df[j] >= m for j in df for m in min_dfs}
    aggs = [F.count_if(kept[j, m]).alias(f"v{j}_{m}") for j, m in kept] + [F.coalesce(F.sum(F.when(kept[j, m], F.col(name(j, c)))), F.lit(0)).alias(f"t{j}_{m}_{c}") for j, m in kept for c in range(len(classes[j]))]
    totals = {r["fold"]: r for r in left.groupBy("fold").agg(*aggs).collect()}  # folds + 1 rows

    def by_fold(values: dict[int, float]) -> Column:
        out = F.lit(None).cast("double")
        for f, v in values.items():
            out = F.when(F.col("fold") == f, F.lit(float(v))).otherwise(out)
        return out
    cols, params = [], {}
    for j, m in kept:
        for c in range(len(classes[j])):
            total = by_fold({f: r[f"t{j}_{m}_{c}"] + ALPHA * r[f"v{j}_{m}"] for f, r in totals.items()})
            cols.append(F.when(kept[j, m], F.log((F.col(name(j, c)) + F.lit(ALPHA)) / total)).alias(f"w{j}_{m}_{c}"))
        params[tasks[j], f"nb_df{m}"] = (totals[folds][f"v{j}_{m}"] + 1) * len(classes[j]) if folds in totals else len(classes[j])
    weights = left.where(F.col("fold") < folds).select("fold", "term", *cols)
    n_rows = sum(max(r[f"v{j}_{m}"] for j, m in kept) for f, r in totals.items() if f < folds)
    names = [f"w{j}_{m}_{c}" for j, m in kept for c in range(len(classes[j]))]
    ys = [f"y{j}" for j in range(len(tasks))]
    # ``fold`` is a key of the weights and not dropped with the carried columns, so a row of it comes back under its own name
    rows = rows.withColumn("own", F.col("fold"))
    sums = summed(rows, "row", ("own", *ys), lambda d, explode: d.select("row", "own", *ys, "fold", explode("t").alias("term")), ["fold", "term"], weights, names,
                  {n: F.sum(n) for n in names}, n_rows, 8 * len(names) + 2 * KEY_BYTES, max_broadcast, fixed=True).withColumnRenamed("own", "fold")

    items = []
    for j, t in enumerate(tasks):
        if not classes[j]:
            continue
        size = {f: [sum(n for (k, y, g), n in sizes.items() if k == j and y == c and g != f) for c in classes[j]] for f in range(folds)}
        array = F.array(*[F.lit(c) for c in classes[j]])
        major = F.lit(None).cast("string")
        for f, s in size.items():
            major = F.when(F.col("fold") == f, F.lit(classes[j][s.index(max(s))])).otherwise(major)
        params[t, MAJORITY] = 1
        items.append((t, MAJORITY, f"y{j}", major))
        for m in min_dfs:
            logp = F.array(*[by_fold({f: math.log(s[c] / sum(s)) if s[c] else -math.inf for f, s in size.items() if sum(s)}) + F.col(f"w{j}_{m}_{c}") for c in range(len(classes[j]))])
            items.append((t, f"nb_df{m}", f"y{j}", F.element_at(array, F.array_position(logp, F.array_max(logp)).cast("int"))))
    long = F.explode(F.array(*[F.struct(F.lit(t).alias("task"), F.lit(model).alias("model"), F.col("fold").alias("fold"), F.col(y).alias("label"), pred.alias("pred")) for t, model, y, pred in items]))
    return sums.select("row", long.alias("e")).select("row", "e.*").where("label is not null"), params


def cross_validated(predictions: DataFrame, params: Mapping[tuple[str, str], int]) -> DataFrame:
    """``task, model, n, correct, accuracy, n_params`` over all folds; a prediction that no model could make is wrong."""
    known = F.create_map(*[x for (t, m), n in params.items() for x in (F.lit(f"{t}/{m}"), F.lit(int(n)).cast("bigint"))])
    return (predictions.groupBy("task", "model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("pred")).alias("correct"))
            .select("task", "model", "n", "correct", F.round(F.col("correct") / F.col("n"), 4).alias("accuracy"), F.element_at(known, F.concat_ws("/", "task", "model")).alias("n_params")))


def mcnemar(predictions: DataFrame) -> DataFrame:
    """``task, model_a, model_b, a_only, b_only, statistic, significant`` for every pair of candidates (``model_a``
    before ``model_b``): rows that only one has right, and McNemar's chi-square with continuity correction."""
    right = F.coalesce(F.col("label") == F.col("pred"), F.lit(False))
    # a row's few candidates are one array; its pairs are made there
    per_row = predictions.groupBy("row", "task").agg(F.array_sort(F.collect_list(F.struct("model", right.alias("ok")))).alias("m"))
    pairs = F.explode(F.flatten(F.transform("m", lambda a: F.transform(F.filter("m", lambda b: b["model"] > a["model"]), lambda b: F.struct(
        a["model"].alias("model_a"), b["model"].alias("model_b"), a["ok"].alias("a"), b["ok"].alias("b"))))))
    out = per_row.select("task", pairs.alias("p")).groupBy("task", "p.model_a", "p.model_b").agg(F.count_if(F.expr("p.a and not p.b")).alias("a_only"), F.count_if(F.expr("p.b and not p.a")).alias("b_only"))
    diff = F.greatest(F.abs(F.col("a_only") - F.col("b_only")) - 1, F.lit(0))
    stat = F.when(F.col("a_only") + F.col("b_only") > 0, diff * diff / (F.col("a_only") + F.col("b_only"))).otherwise(F.lit(0.0))
    return out.withColumn("statistic", F.round(stat, 4)).withColumn("significant", stat > F.lit(CHI2_95))


def paired_choice(records: DataFrame, tests: DataFrame) -> DataFrame:
    """``task, model, accuracy, n_params`` of the chosen candidate: the cheapest that the most accurate one does
    not beat significantly (ties: the smaller name)."""
    w = Window.partitionBy("task").orderBy(F.desc("correct"), "n_params", "model")
    best = records.withColumn("r", F.row_number().over(w)).where("r = 1").select("task", F.col("model").alias("best"))
    beaten = tests.where("significant").select("task", F.explode(F.array(F.struct(F.col("model_a").alias("model"), F.col("model_b").alias("other")),
                                                                         F.struct(F.col("model_b").alias("model"), F.col("model_a").alias("other")))).alias("p")).select("task", "p.*")
    beaten = beaten.join(best.withColumnRenamed("best", "other"), ["task", "other"]).select("task", "model")
    near = records.join(beaten, ["task", "model"], "left_anti")
    cheap = Window.partitionBy("task").orderBy("n_params", "model")
    return near.withColumn("r", F.row_number().over(cheap)).where("r = 1").select("task", "model", "accuracy", "n_params")


def score_histogram(scored: DataFrame, specs: Sequence[tuple[str, str, str, str]], split: str = "split", width: float = BIN, edge: int = EDGE) -> DataFrame:
    """``task, split, bin, pos, neg``: counts of positive and negative rows per bin of the score; bin ``b`` holds scores
    in ``[b, b + 1) * width``. ``specs``: task, label column, positive label, score column. At most ``2 * edge + 1`` bins
    a task and split, and histograms of parts of the rows add up."""
    items = [F.when(F.col(lab).isNotNull() & F.col(s).isNotNull(), F.struct(F.lit(t).alias("task"), (F.col(lab).cast("string") == F.lit(pos)).alias("y"), F.col(s).alias("s"))) for t, lab, pos, s in specs]
    rows = scored.select(F.col(split).alias("split"), F.explode(F.array(*items)).alias("e")).where("e is not null").select("split", "e.*")
    bin_ = F.greatest(F.lit(-edge), F.least(F.lit(edge), F.floor(F.round(F.col("s"), 9) / F.lit(width)))).cast("int")
    return rows.groupBy("task", "split", bin_.alias("bin")).agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))


def roc_curve(histogram: DataFrame) -> DataFrame:
    """``task, split, bin, tp, fp, n_pos, n_neg``: rows at or above each bin, from the highest bin down."""
    down = Window.partitionBy("task", "split").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a few hundred bins
    all_ = Window.partitionBy("task", "split")
    return histogram.select("task", "split", "bin", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), F.sum("pos").over(all_).alias("n_pos"), F.sum("neg").over(all_).alias("n_neg"),
                            "pos", "neg")


def threshold_report(histogram: DataFrame, fit: str = "validation", held: str = "test", width: float = BIN) -> DataFrame:
    """Per task: the area under the ROC curve on ``held`` (rows of one bin count half; null without rows of both kinds), the score at and above which a row
    is called positive (best accuracy on ``fit``; the higher cut on a tie), the accuracy of that cut and of calling
    everything by the majority of ``fit``, both on ``held``, and whether the cut reaches it."""
    roc = roc_curve(histogram)
    area = roc.where(F.col("split") == held).groupBy("task").agg(
        F.round(F.try_divide(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)), F.max("n_pos") * F.max("n_neg")), 4).alias("auc"), F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"))
    # calling nothing positive is a cut too: above every bin
    cuts = roc.where(F.col("split") == fit).select("task", "bin", (F.col("tp") + F.col("n_neg") - F.col("fp")).alias("right"))
    none = roc.where(F.col("split") == fit).groupBy("task").agg((F.max("bin") + 1).alias("bin"), F.max("n_neg").alias("right"))
    best = cuts.unionByName(none).groupBy("task").agg(F.max(F.struct("right", "bin")).alias("b")).select("task", F.col("b.bin").alias("cut"))
    major = histogram.where(F.col("split") == fit).groupBy("task").agg((F.sum("pos") > F.sum("neg")).alias("major"))
    on = histogram.where(F.col("split") == held).join(F.broadcast(best), "task").join(F.broadcast(major), "task")  # a row a task each
    right = F.sum(F.when(F.col("bin") >= F.col("cut"), F.col("pos")).otherwise(F.col("neg")))
    always = F.sum(F.when(F.col("major"), F.col("pos")).otherwise(F.col("neg")))
    n = F.sum(F.col("pos") + F.col("neg"))
    out = on.groupBy("task", "cut").agg(n.alias("n"), right.alias("right"), always.alias("always"))
    return out.join(area, "task").select("task", (F.col("cut") * width).alias("threshold"), "auc", "n", F.round(F.col("right") / F.col("n"), 4).alias("accuracy"),
                                         F.round(F.col("always") / F.col("n"), 4).alias("majority_accuracy"), (F.col("right") >= F.col("always")).alias("reaches_majority"))
