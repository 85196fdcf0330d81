"""A12 on a fixed record table, and the logistic-regression candidate (A8-A10 lr)."""

from pyspark.sql import functions as F

from evenline.operators.metrics import accuracy, majority_baseline
from evenline.operators.mllib import fit_lr, lr_scores
from evenline.operators.selection import RECORD_SCHEMA, select_model
from evenline.plans.context import Context


def test_select_model_fixed_records(spark):
    recs = spark.createDataFrame([
        ("truth", "bert", 100, 20, 0.860, 110_000_000, 50.0),
        ("truth", "distil", 100, 20, 0.855, 66_000_000, 20.0),     # within 0.01 and lighter: chosen
        ("truth", "tiny", 100, 20, 0.700, 1_000, 1.0),             # light but too inaccurate
        ("sentiment", "deberta", 100, 20, 0.72, 184_000_000, 80.0),
        ("sentiment", "distil", 100, 20, 0.69, 66_000_000, 20.0),  # 0.03 behind: not chosen
        ("bias", "a", 100, 20, 0.63, 10, 1.0),
        ("bias", "b", 100, 20, 0.63, 10, 1.0),                     # tie on cost: name decides
    ], RECORD_SCHEMA)
    got = {r.task: r.model for r in select_model(recs, "accuracy", 0.01, "n_params").collect()}
    assert got == {"truth": "distil", "sentiment": "deberta", "bias": "a"}


def test_logistic_regression_candidate(spark):
    c = Context.get(spark, "/root/testdata/sf0.001")
    bias = c.task("bias")
    train, test = bias.where(F.col("split") == "train"), bias.where(F.col("split") == "test")
    m = fit_lr(train, "bias_lr", max_iter=20)
    s = lr_scores(test, m, "text", keep=("example_id", "label"))
    row = accuracy(s, "label", "bias_lr_label").first()
    base = majority_baseline(train, test).first().majority_accuracy
    assert m.classes == ["de", "en", "es", "fr"] and row.n == test.count()
    assert row.accuracy > base                     # language is easy to tell from the text
    assert s.where(F.abs(F.aggregate("bias_lr_probs", F.lit(0.0), lambda a, b: a + b) - 1) > 1e-9).count() == 0


def test_refitted_models_never_score_with_other_weights(spark):
    """Weights belong to their model set: alternating label sets, 200 refits."""
    from evenline.operators.naive_bayes import ModelSet, NBModel, nb_scores
    rows = spark.createDataFrame([(1, "good good"), (2, "bad")], "id long, text string").cache()
    w = {flip: spark.createDataFrame([("good", -1.0, 1.0), ("bad", 1.0, -1.0)] if flip else [("good", 1.0, -1.0), ("bad", -1.0, 1.0)],
                                     "term string, w0 double, w1 double") for flip in (False, True)}
    for k in range(200):
        flip = k % 3 == 0
        m = NBModel("m", ["0", "1"], [-0.7, -0.7], w[flip].select("*"), 2, 2)
        s = nb_scores(rows, "id", {"": "text"}, ModelSet([m]) if k % 2 else [m])
        assert {r.id: r.m_label for r in s.collect()} == ({1: "1", 2: "0"} if flip else {1: "0", 2: "1"})


def test_rows_that_share_a_key_stay_apart(spark):
    from evenline.operators.naive_bayes import NBModel, nb_scores
    rows = spark.createDataFrame([(1, "good good"), (1, "bad"), (1, "bad")], "id long, text string")
    w = spark.createDataFrame([("good", -1.0, 1.0), ("bad", 1.0, -1.0)], "term string, w0 double, w1 double")
    m = NBModel("m", ["0", "1"], [-0.7, -0.7], w, 2, 2)
    for limit in (0, 1 << 30):
        got = sorted(r.m_label for r in nb_scores(rows, "id", {"": "text"}, [m], max_broadcast=limit).collect())
        assert got == ["0", "0", "1"]
