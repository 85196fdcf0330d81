"""Models too large to broadcast or to carry in the plan: frequent terms are summed where the row is, only tokens of rare
terms move, and a model of many terms never reaches the driver."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenline.functions.text import distinct_tokens
from evenline.operators import inline as I
from evenline.operators import naive_bayes as N
from evenline.operators import validation as V

ROWS = [(i, "the a " + " ".join(f"w{'abcdefgh'[i * k % 8]}{'xyz'[k]}" for k in range(3)) + (" rare" if i % 20 == 0 else ""), "1" if i % 3 else "0", i % 3) for i in range(120)]
ODD = [(None, None, "1", 0), (None, " ", "0", 1), (7, "123", "1", 2), (7, "the unseen", "0", 0)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(ROWS + ODD, "doc_id int, text string, y string, fold int")


def test_frequent_part_takes_the_most_frequent_terms(spark):
    w = spark.createDataFrame([(f"t{n}", math.log(n / 100), None if n % 2 else math.log(n / 200)) for n in range(1, 101)] + [("none", None, None)], "term string, w0 double, w1 double")
    most, rest = N.frequent_part(w, ["w0", "w1"], 100, 10)
    assert {r["term"] for r in most.collect()} == {f"t{n}" for n in range(91, 101)}
    assert {r["term"] for r in rest.collect()} == {f"t{n}" for n in range(1, 91)}


def test_rare_terms_alone_are_shuffled(spark, texts):
    models = N.ModelSet([N.fit_nb(texts, "m", label_col="y", min_df=2)])
    want = N.nb_scores(texts, "doc_id", {"": "text"}, models)
    got = N.nb_scores(texts, "doc_id", {"": "text"}, models, max_broadcast=8 * models.row_bytes)

    def rows(d):
        return Counter(repr((r["doc_id"], r["m_label"], r["m_conf"] and round(r["m_conf"], 9))) for r in d.collect())
    assert rows(got) == rows(want) and len(ROWS) + len(ODD) == got.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "ShuffledHashJoin" in plan.split("Initial Plan")[-1]


def test_folds_with_part_of_the_weights_broadcast(spark, texts):
    a, pa = V.fold_predictions(texts, {"one": "y"}, F.col("fold"), 3, (2, 4))
    b, pb = V.fold_predictions(texts, {"one": "y"}, F.col("fold"), 3, (2, 4), max_broadcast=20 * (8 * 4 + 128))
    cols = ["task", "model", "fold", "label", "pred"]
    assert pa == pb and Counter(a.select(*cols).collect()) == Counter(b.select(*cols).collect())
    assert "LeftAnti" in b._jdf.queryExecution().executedPlan().toString()


def test_tokenised_columns_give_the_same_model_and_scores(spark, texts):
    t = texts.withColumn("t", F.when(F.trim("text") != "", distinct_tokens("text")))
    a, b = N.fit_nb(t, "m", label_col="y", min_df=2), N.fit_nb(t, "m", text_col="t", label_col="y", min_df=2, tokenised=True)
    assert (a.n_terms, a.class_counts, a.priors) == (b.n_terms, b.class_counts, b.priors)
    x, y = (N.nb_scores(t, "doc_id", {"": c}, N.ModelSet([m]), tokenised=c == "t") for c, m in (("text", a), ("t", b)))
    key = ["doc_id", "m_label", F.round("m_conf", 9)]
    assert Counter(x.select(*key).collect()) == Counter(y.select(*key).collect())


def test_models_of_many_terms_stay_off_the_driver():
    # 300,000 terms of two classes were taken into the plan; there is no table here that could be read
    assert I.inline_models(N.ModelSet([N.NBModel("m", ["0", "1"], [0.0, 0.0], None, 300_000, 1)])) is None
    assert I.inline_models(N.ModelSet([N.NBModel("m", ["0", "1"], [0.0, 0.0], None, 80_000, 1)]), texts=2) is None


@pytest.fixture(scope="module")
def terms(spark, texts):
    from evenline.session import written
    t = F.when(F.trim("text") != "", distinct_tokens("text")).alias("t")
    return written(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "y", "fold", t), "test-terms")


@pytest.mark.parametrize("most", [0, I.MAX_NUMBERS])
def test_written_terms_score_like_texts_and_are_not_written_again(spark, texts, terms, most):
    models = N.ModelSet([N.fit_nb(texts, "m", label_col="y", min_df=2)])
    got = I.score_rows(terms, {"": "t"}, models, most=most, row="row")
    want = I.score_rows(texts, {"": "text"}, models)
    key = ["doc_id", "m_label", F.round("m_conf", 9)]
    assert Counter(got.select(*key).collect()) == Counter(want.select(*key).collect())
    read = {f.rsplit("/", 2)[1] for f in got.inputFiles()}
    assert len(read) == 1 and read.pop().startswith("test-terms")


def test_folds_of_written_terms(spark, texts, terms):
    a, pa = V.fold_predictions(texts, {"one": "y"}, F.col("fold"), 3, (2, 4))
    b, pb = V.fold_predictions(terms, {"one": "y"}, F.col("fold"), 3, (2, 4), text="t", row="row")
    cols = ["task", "model", "fold", "label", "pred"]
    assert pa == pb and Counter(a.select(*cols).collect()) == Counter(b.select(*cols).collect())


def test_chosen_scores_read_the_texts_once(spark):
    from conftest import SF_SMALL
    from evenline.plans.context import Context
    from evenline.plans.queries import QUERIES
    c = Context.get(spark, SF_SMALL)
    read = QUERIES["chosen_scores"](spark, SF_SMALL).inputFiles()
    assert read and not [f for f in read if "documents.parquet" in f], "scored from the written terms"
    assert c.doc_terms.columns == ["row", "doc_id", "terms"]
