"""Calibrated confidence: a temperature per model by grid search on validation
log loss, and reliability bins. Every (model, temperature) is evaluated from one
scored frame in one explode and one grouped aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenline.operators.metrics import EPS

TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
SATURATED = 0.9999


def tempered(scored: DataFrame, specs: Sequence[tuple], split: str = "split",
             temperatures: Sequence[float] = TEMPERATURES) -> DataFrame:
    """``task, split, temperature, hit, p, conf`` per labelled row and grid value.
    ``specs`` are ``(task, label column, model name, classes)``; ``p`` is the label's probability."""
    items = []
    for task, label, name, classes in specs:
        lab = F.col(label).cast("string")
        at = F.array_position(F.array(*[F.lit(c) for c in classes]), lab).cast("int")
        items.append(F.when(lab.isNotNull() & F.col(f"{name}_logp").isNotNull(), F.struct(
            F.lit(task).alias("task"), at.alias("at"), F.col(f"{name}_logp").alias("lp"))))
    rows = (scored.select(F.col(split).alias("split"), F.explode(F.array(*items)).alias("e")).where("e is not null")
                  .select("split", "e.*", F.explode(F.array(*[F.lit(float(t)) for t in temperatures])).alias("temperature")))
    e = F.transform("lp", lambda x: F.exp((x - F.array_max("lp")) / F.col("temperature")))
    rows = rows.withColumn("_e", e).withColumn("_z", F.aggregate("_e", F.lit(0.0), lambda a, b: a + b))
    top = F.array_position("lp", F.array_max("lp")).cast("int")
    p = F.when(F.col("at") > 0, F.element_at("_e", F.greatest("at", F.lit(1))) / F.col("_z")).otherwise(F.lit(0.0))
    return rows.select("task", "split", "temperature", (top == F.col("at")).alias("hit"), p.alias("p"), (F.lit(1.0) / F.col("_z")).alias("conf"))


def fit_temperature(rows: DataFrame, validation: str = "validation", eps: float = EPS) -> DataFrame:
    """``task, temperature``: the grid value with the least validation log loss (the smaller on a tie)."""
    loss = rows.where(F.col("split") == validation).groupBy("task", "temperature").agg(
        F.avg(-F.log(F.greatest("p", F.lit(eps)))).alias("loss"))
    w = Window.partitionBy("task").orderBy("loss", "temperature")
    return loss.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("task", "temperature")


def calibration_report(rows: DataFrame, chosen: DataFrame, held: str = "test", eps: float = EPS) -> DataFrame:
    """Per task: the temperature, held-out log loss and the share of saturated confidences before and after."""
    on = rows.where(F.col("split") == held).join(F.broadcast(chosen.withColumnRenamed("temperature", "t")), "task")
    loss = -F.log(F.greatest("p", F.lit(eps)))
    full = (F.col("conf") >= SATURATED).cast("double")

    def mean(x, at):
        return F.round(F.avg(F.when(F.col("temperature") == at, x)), 4)
    return on.groupBy("task", F.col("t").alias("temperature")).agg(
        F.count_if(F.col("temperature") == 1.0).alias("n"), mean(loss, F.lit(1.0)).alias("log_loss_before"), mean(loss, F.col("t")).alias("log_loss_after"),
        mean(full, F.lit(1.0)).alias("saturated_before"), mean(full, F.col("t")).alias("saturated_after"))


def reliability(rows: DataFrame, chosen: DataFrame, held: str = "test", bins: int = 10) -> DataFrame:
    """Per task and confidence bin at the chosen temperature: rows, accuracy and mean confidence."""
    on = rows.where(F.col("split") == held).join(F.broadcast(chosen), ["task", "temperature"])
    b = F.least(F.floor(F.round("conf", 9) * bins), F.lit(bins - 1)).cast("int")
    return on.groupBy("task", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("hit").cast("double")), 4).alias("accuracy"),
                                                  F.round(F.avg("conf"), 4).alias("confidence"))


# --- isotonic calibration over mergeable bins ------------------------------------

PSEUDO = 0.5  # rows of either outcome added to every pooled block, so that no probability is 0 or 1


def pool_adjacent(bins: Sequence[tuple[int, int, int]]) -> list[tuple[int, float]]:
    """``(first bin, probability)`` steps of the non-decreasing fit to ``(bin, positives, negatives)`` in order of bins:
    neighbours whose shares fall are pooled. A block's probability counts ``PSEUDO`` more rows of either outcome; a
    later block is never below an earlier one."""
    blocks: list[list] = []
    for b, pos, neg in sorted(bins):
        if pos + neg == 0:
            continue
        blocks.append([b, pos, pos + neg])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, p, n = blocks.pop()
            blocks[-1][1] += p
            blocks[-1][2] += n
    out, top = [], 0.0
    for b, p, n in blocks:
        top = max(top, (p + PSEUDO) / (n + 2 * PSEUDO))
        out.append((b, top))
    return out


def fit_isotonic(histogram: DataFrame, split: str = "validation", edge: int = 400) -> dict[str, list[float]]:
    """Per task a probability for every bin from ``-edge`` to ``edge`` of :func:`evenline.operators.validation.score_histogram`,
    fitted on one split. Bins below the first one with rows take its value, others that of the step they lie on. At most
    ``2 * edge + 1`` rows a task reach the driver."""
    rows: dict[str, list] = {}
    for r in histogram.where(F.col("split") == split).collect():
        rows.setdefault(r["task"], []).append((r["bin"], r["pos"], r["neg"]))
    out = {}
    for task, bins in rows.items():
        steps = pool_adjacent(bins)
        values, k = [], 0
        for b in range(-edge, edge + 1):
            while k + 1 < len(steps) and steps[k + 1][0] <= b:
                k += 1
            values.append(steps[k][1])
        out[task] = values
    return out


def calibrated(score: Column, values: Sequence[float], width: float, edge: int = 400) -> Column:
    """The fitted probability of a score, looked up in the row."""
    at = F.greatest(F.lit(-edge), F.least(F.lit(edge), F.floor(F.round(score, 9) / F.lit(width)))).cast("int")
    table = F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")
    return F.when(score.isNotNull(), F.get(table, at + edge))


def margin(logp: str) -> Column:
    """How far the best class lies above the second."""
    s = F.sort_array(F.col(logp), asc=False)
    return F.when(F.size(s) > 1, F.get(s, F.lit(0)) - F.get(s, F.lit(1)))
