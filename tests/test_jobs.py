"""The end-to-end job: outputs exist, agree with the registered queries, and
take the class by name whatever its place."""

import pytest
from pyspark.sql import functions as F

from evenline.jobs import neutralize
from evenline.plans import QUERIES

SF = "/root/testdata/sf0.01"   # enough labels for a non-empty lexicon


def test_three_task_job(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    tasks = {"truth": ("quality", "1"), "sentiment": ("toxic", "1"), "bias": ("lang", None)}
    info = neutralize(spark, docs, labels, str(tmp_path / "out"), tasks=tasks)
    out = info["path"]
    assert spark.read.parquet(str(tmp_path / "out" / "latest")).first().path == out
    per_doc = spark.read.parquet(f"{out}/per_document")
    n = docs.count()
    assert per_doc.count() == n and "lang" in per_doc.columns
    q = QUERIES["neutral_rewrite"](spark, SF)
    rewrites = spark.read.schema("doc_id long, neutral string, lang string").parquet(f"{out}/rewrites").select("doc_id", "neutral")
    want = q.where("changed").select("doc_id", "neutral")
    assert rewrites.count() == want.count() > 0 and rewrites.exceptAll(want).count() == 0
    got = {(r.split, r.lang): r for r in spark.read.parquet(f"{out}/summary").collect()}
    axes = {"truth": "truth_probability", "sentiment": "emotional_intensity", "bias": "bias_degree"}
    for r in QUERIES["effect_summary"](spark, SF).collect():
        g = got[r.split, r.lang]
        assert (g.n, g.n_changed, g.share_changed) == (r.n, r.n_changed, r.share_changed)
        for t, ax in axes.items():
            assert abs(g[f"{t}_delta_mean"] - r[f"{ax}_delta_mean"]) < 1e-9 and g[f"{t}_flip_rate"] == r[f"{t}_flip_rate"]
    assert spark.read.parquet(f"{out}/radar").count() == 6 * n
    assert spark.read.parquet(f"{out}/prompts").where("prompt is not null").count() == per_doc.where("truth_before is not null").count()
    assert spark.read.parquet(f"{out}/rouge").count() == rewrites.count()


@pytest.mark.parametrize("classes", [("negative", "neutral"), ("calm", "negative", "neutral"), ("a", "b", "negative")])
def test_positive_class_by_name(spark, tmp_path, classes):
    rows = [(i, f"{c} {c}word text {i}", "en", c) for i in range(400) for c in [classes[i % len(classes)]]]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, label string")
    info = neutralize(spark, d.drop("label"), d.select("doc_id", "label"), str(tmp_path / "o"), positive="negative")
    got = spark.read.parquet(info["path"] + "/per_document").join(d.select("doc_id", "label"), "doc_id")
    by = {r.label: r.v for r in got.groupBy("label").agg(F.avg("sentiment_value_before").alias("v")).collect()}
    assert by["negative"] > 0.9 and all(v < 0.1 for c, v in by.items() if c != "negative")


def test_rerun_leaves_no_stale_group(spark, tmp_path):
    from evenline.sources.sink import write_results
    d = spark.createDataFrame([(1, "en"), (2, "fr")], "id long, lang string")
    write_results(d, str(tmp_path / "s"))
    write_results(d.where("lang = 'en'"), str(tmp_path / "s"))
    assert [r.id for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [1]
