"""Batch job: neutralize a corpus end to end and write the results.

    spark-submit --py-files evenline.zip -m evenline.jobs \\
        --docs s3://.../documents --labels s3://.../labels --out s3://.../neutralized \\
        --task truth=quality:1 --task sentiment=toxic:1 --task bias=lang

Reads documents ``(id, text[, group])`` and labels ``(id, label columns)``,
splits on the text (D1), learns the loaded-term lexicon (A24) and the task
models (A8-A10) on the train split in one pass, rewrites every document (A23),
scores both texts in one pass (A25) and writes once
``per_document`` (labels, confidences and axis values of both texts, A26). All
other outputs are read from that table: ``prompts`` (A22), ``rewrites``,
``removed_terms`` (A27), ``radar`` (A29), ``rouge`` (A16, A17) and ``summary``
(A30). Every run writes a folder of its own under ``out`` and names it in
``out/latest``, so a rerun leaves no stale group behind. Models and lexicon are
checkpointed to ``spark.checkpoint.dir``, which must name shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenline.operators import compare as cmp
from evenline.operators import metrics
from evenline.operators import rewrite as rw
from evenline.operators import scoring as sc
from evenline.operators.lexicon import learn_loaded_terms
from evenline.operators.inline import score_rows
from evenline.operators.naive_bayes import ModelSet, class_probability, fit_nb_variants
from evenline.operators.splits import holdout_split
from evenline.session import ensure_checkpoint_dir
from evenline.sources.sink import write_results

MIN_DF = 5


def neutralize(spark: SparkSession, docs: DataFrame, labels: DataFrame, out: str, key: str = "doc_id",
               text: str = "text", group: str = "lang", label: str = "label", positive: str = "1",
               tasks: Mapping[str, tuple[str, str | None]] | None = None, lexicon_task: str | None = None) -> dict:
    """``tasks`` maps a task name to ``(label column, positive class)``; a task
    without a positive class is described by its top confidence (a degree, as
    for bias). The default is the single task ``sentiment`` on ``label``. A label
    column that ``labels`` lacks is taken from ``docs``."""
    ensure_checkpoint_dir(spark)
    tasks = dict(tasks or {"sentiment": (label, positive)})
    lexicon_task = lexicon_task or ("sentiment" if "sentiment" in tasks else next(iter(tasks)))
    own = [c for c, _ in tasks.values() if c not in labels.columns]
    given = sorted({c for c, _ in tasks.values()} - set(own))
    d = holdout_split(docs.select(key, text, group, *[c for c in own if c != group]), text, (("train", 80), ("test", 20)))
    lab = d.join(labels.select(key, *[F.col(c).cast("string").alias(f"_y_{c}") for c in given]), key, "left")
    lab = lab.withColumns({f"_y_{c}": F.col(c).cast("string") for c in own})
    train = lab.where(F.col("split") == "train")
    lex_col, lex_pos = tasks[lexicon_task]
    lexicon = learn_loaded_terms(train.where(F.col(f"_y_{lex_col}").isNotNull()), text, f"_y_{lex_col}", lex_pos or positive).checkpoint(eager=True)
    fitted = fit_nb_variants(train, [(t, None, MIN_DF, f"_y_{c}") for t, (c, _) in tasks.items()], text)
    models = ModelSet(fitted[t] for t in tasks)

    def value(phase: str, t: str):
        pos = tasks[t][1]
        return class_probability(f"{phase}_{t}", fitted[t].classes, pos) if pos is not None else F.col(f"{phase}_{t}_conf")
    r = (rw.neutral_rewrite(d.select(key, text, group, "split"), lexicon, text, "neutral", key=key)
           .withColumn("changed", ~F.col("neutral").eqNullSafe(F.col(text))))
    # scored in the row, or by narrow rows joined back: no text is a key of an explode, an aggregate or a join
    s = score_rows(r, {"before": text, "after": "neutral"}, models, reuse={"after": "before"})
    cols = [key, group, "split", "changed", text, "neutral"]
    for t in tasks:
        for phase in cmp.PHASES:
            cols += [F.col(f"{phase}_{t}_label").alias(f"{t}_{phase}"), F.col(f"{phase}_{t}_conf").alias(f"{t}_conf_{phase}"), value(phase, t).alias(f"{t}_value_{phase}")]
    run = f"{out.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    rows = s.select(*cols)
    write_results(rows, f"{run}/per_document", (group,))
    done = spark.read.schema(rows.schema).parquet(f"{run}/per_document")

    shown = done.select(key, text, *[F.col(f"{t}_before").alias(f"{t}_label") for t in tasks], *[F.col(f"{t}_conf_before").alias(f"{t}_conf") for t in tasks])
    parts = [F.concat(F.lit(f"{t}: "), F.col(f"{t}_fmt")) for t in tasks]
    prompts = sc.format_confidence(shown, list(tasks), near_neutral={"bias": sc.TAU_NEAR})
    whole = F.lit(True)
    for t in tasks:
        whole = whole & F.col(f"{t}_fmt").isNotNull()
    prompts.select(key, F.when(whole & F.col(text).isNotNull(), F.concat_ws(" | ", F.lit("neutralize"), *parts, F.concat(F.lit("headline: "), F.col(text)))).alias("prompt")
                   ).write.parquet(f"{run}/prompts")
    changed = done.where("changed")
    write_results(changed.select(key, group, "neutral"), f"{run}/rewrites", (group,))
    rw.removed_summary(rw.removed_terms(changed, key, text, "neutral"), key).write.parquet(f"{run}/removed_terms")
    vals = [f"{t}_value_{p}" for p in cmp.PHASES for t in tasks]
    radar = done.unpivot([key], vals, "name", "value")
    radar.select(key, F.regexp_extract("name", "_value_(.*)$", 1).alias("phase"), F.regexp_extract("name", "^(.*)_value_", 1).alias("axis"),
                 F.round("value", 4).alias("value")).write.parquet(f"{run}/radar")
    r1 = metrics.rouge_n(changed, key, text, "neutral", 1)
    r1.join(metrics.rouge_l(changed, key, text, "neutral"), key).write.parquet(f"{run}/rouge")
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if("changed").alias("n_changed"), F.round(F.avg(F.col("changed").cast("double")), 4).alias("share_changed")]
    for t in tasks:
        flip = F.col(f"{t}_before") != F.col(f"{t}_after")
        aggs += [F.round(F.avg(F.col(f"{t}_value_after") - F.col(f"{t}_value_before")), 4).alias(f"{t}_delta_mean"),
                 F.round(F.avg(flip.cast("double")), 4).alias(f"{t}_flip_rate")]
    done.rollup("split", group).agg(*aggs).write.parquet(f"{run}/summary")
    spark.createDataFrame([(run,)], "path string").write.mode("overwrite").parquet(f"{out.rstrip('/')}/latest")
    return {"path": run, "lexicon_terms": lexicon.count(), "model_terms": {t: fitted[t].n_terms for t in tasks}}


def _task(spec: str) -> tuple[str, tuple[str, str | None]]:
    name, _, rest = spec.partition("=")
    col, _, pos = rest.partition(":")
    return name, (col, pos or None)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--docs", required=True)
    ap.add_argument("--labels", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--key", default="doc_id")
    ap.add_argument("--text", default="text")
    ap.add_argument("--group", default="lang")
    ap.add_argument("--label", default="label")
    ap.add_argument("--positive", default="1")
    ap.add_argument("--task", action="append", type=_task, help="name=label column[:positive class]")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("evenline-neutralize").getOrCreate()
    info = neutralize(spark, spark.read.parquet(a.docs), spark.read.parquet(a.labels), a.out,
                      a.key, a.text, a.group, a.label, a.positive, dict(a.task) if a.task else None)
    print(info)


if __name__ == "__main__":
    main()
