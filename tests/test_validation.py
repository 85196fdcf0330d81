"""Cross-validation by subtracted counts against models fitted on each fold's complement; McNemar, the paired choice and
thresholds against plain versions."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenline.operators import validation as V
from evenline.operators.naive_bayes import ModelSet, fit_nb, nb_scores
from evenline.plans import QUERIES

SF = "/root/testdata/sf0.01"


def corpus(seed=3, n=120):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = rnd.choice(["0", "1", "1", None])
        words = ["good", "sun", "day"] if y == "1" else ["bad", "rain", "day"]
        t = " ".join(rnd.choice(words + ["the", "a", f"w{rnd.randrange(9)}"[:1] + "x" * rnd.randrange(4)]) for _ in range(rnd.choice([0, 2, 5, 9])))
        rows.append((i % 40 if i % 7 else None, rnd.choice([t, t, t, None, " "]), y, rnd.choice(["de", "en", "fr"]), i % 3))
    return rows


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(corpus(), "doc_id int, text string, y string, lang string, fold int")


@pytest.mark.parametrize("max_broadcast", [1 << 28, 0])
def test_folds_equal_models_of_their_complement(spark, small, max_broadcast):
    got, params = V.fold_predictions(small, {"one": "y", "two": "lang"}, F.col("fold"), 3, (2, 4), max_broadcast=max_broadcast)
    got = got.collect()
    for task, col in (("one", "y"), ("two", "lang")):
        for m in (2, 4):
            for f in range(3):
                model = fit_nb(small.where(f"fold <> {f}"), "m", label_col=col, min_df=m)
                want = nb_scores(small.where(f"fold = {f} and {col} is not null").withColumnRenamed(col, "c"), "doc_id", {"": "text"}, ModelSet([model]), carry=["c"])
                want = Counter((r["c"], r["m_label"]) for r in want.collect() if r["m_label"] is not None)
                assert Counter((r["label"], r["pred"]) for r in got if (r["task"], r["model"], r["fold"]) == (task, f"nb_df{m}", f)) == want
            whole = fit_nb(small, "m", label_col=col, min_df=m)
            assert params[task, f"nb_df{m}"] == whole.n_params
    rows = [r for r in corpus() if r[1] and r[1].strip(" ") and r[2] is not None]
    for f in range(3):
        n = Counter(r[2] for r in rows if r[4] != f)
        assert {r["pred"] for r in got if (r["task"], r["model"], r["fold"]) == ("one", "majority", f)} == {min(n, key=lambda y: (-n[y], y))}


def test_mcnemar_and_choice(spark):
    rnd, rows = random.Random(4), []
    for i in range(300):
        for model, p in (("a", 0.9), ("b", 0.88), ("c", 0.4)):
            rows.append((i, "t", model, 0, "1", "1" if rnd.random() < p else rnd.choice(["0", None])))
    pred = spark.createDataFrame(rows, "row long, task string, model string, fold int, label string, pred string")
    ok = {(r[0], r[2]): r[4] == r[5] for r in rows}
    got = {(r["model_a"], r["model_b"]): r for r in V.mcnemar(pred).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    for (a, b), r in got.items():
        x, y = sum(ok[i, a] and not ok[i, b] for i in range(300)), sum(ok[i, b] and not ok[i, a] for i in range(300))
        stat = max(abs(x - y) - 1, 0) ** 2 / (x + y) if x + y else 0
        assert (r["a_only"], r["b_only"]) == (x, y) and abs(r["statistic"] - stat) < 1e-3 and r["significant"] == (stat > V.CHI2_95)
    records = V.cross_validated(pred, {("t", "a"): 900, ("t", "b"): 50, ("t", "c"): 1})
    chosen = V.paired_choice(records, V.mcnemar(pred)).collect()
    assert [r["model"] for r in chosen] == ["b"], "cheaper than a and not worse by the test; c is beaten"


def test_thresholds_against_every_cut(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["validation", "test", "train"]), str(int(rnd.random() < 0.3)), rnd.gauss(0, 3)) for _ in range(600)] + [("test", "1", 1e9), ("test", "0", -1e9), ("test", None, 1.0), ("validation", "1", None)]
    rows = [(s, y, None if x is None else x + 2 * (y == "1")) for s, y, x in rows]
    df = spark.createDataFrame(rows, "split string, y string, s double")
    h = V.score_histogram(df, [("t", "y", "1", "s")])
    got = V.threshold_report(h).collect()[0]

    def bins(split):
        return [(max(-400, min(400, math.floor(round(x, 9) / 0.25))), y == "1") for s, y, x in rows if s == split and y is not None and x is not None]
    fit, held = bins("validation"), bins("test")
    cuts = sorted({b for b, _ in fit} | {max(b for b, _ in fit) + 1})
    best = max(cuts, key=lambda c: (sum((b >= c) == y for b, y in fit), c))
    assert got["threshold"] == best * 0.25 and got["n"] == len(held)
    assert abs(got["accuracy"] - sum((b >= best) == y for b, y in held) / len(held)) < 1e-4
    pos, neg = [b for b, y in held if y], [b for b, y in held if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(got["auc"] - auc) < 1e-4
    parts = V.score_histogram(df.where("s > 0"), [("t", "y", "1", "s")]).unionByName(V.score_histogram(df.where("s <= 0"), [("t", "y", "1", "s")]))
    merged = parts.groupBy("task", "split", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    assert merged.exceptAll(h).count() == 0 and h.exceptAll(merged).count() == 0, "histograms of parts add up"


def test_thresholds_without_positives(spark):
    df = spark.createDataFrame([("validation", "0", 1.0), ("test", "0", 2.0), ("test", "0", -1.0)], "split string, y string, s double")
    r = V.threshold_report(V.score_histogram(df, [("t", "y", "1", "s")])).first()
    assert r["auc"] is None and (r["n"], r["majority_accuracy"]) == (2, 1.0)


def test_chosen_models_are_the_chosen(spark):
    from evenline.plans.context import Context
    c = Context.get(spark, SF)
    assert set(c.chosen) == {"truth", "sentiment", "bias"} and all(re.fullmatch("majority|nb_df[35]", m) for m in c.chosen.values())
    best = {r["task"]: r["correct"] for r in QUERIES["cross_validated"](spark, SF).groupBy("task").agg(F.max("correct").alias("correct")).collect()}
    records = {(r["task"], r["model"]): r for r in QUERIES["cross_validated"](spark, SF).collect()}
    tests = {(r["task"], r["model_a"], r["model_b"]): r["significant"] for r in QUERIES["mcnemar"](spark, SF).collect()}
    for t, m in c.chosen.items():
        top = [k for k, r in records.items() if k[0] == t and r["correct"] == best[t]]
        assert (t, m) in top or not all(tests[(t, *sorted((m, k[1])))] for k in top), "never a model that the best one beats"
