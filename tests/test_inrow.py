"""Scoring in the row: hashed slots against a plain version, exact inline weights
against the join, both ways of ``score_rows`` with repeated keys, nulls and clashing names."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenline.operators import hashed as H
from evenline.operators import inline as I
from evenline.operators.naive_bayes import ModelSet, fit_nb, nb_scores
from evenline.plans import QUERIES
from evenline.plans.context import Context

SF = "/root/testdata/sf0.01"
TRAIN = [("good calm day", "1", "a"), ("good good sun", "1", "b"), ("bad day rain", "0", "a"), ("Bad! rain", "0", None), ("calm", None, "c"),
         ("", "1", "a"), (None, "0", "b"), ("the sun and the rain", "1", "c")] * 3


def terms(text):
    return {int(hashlib.md5(w.lower().encode()).hexdigest()[:9], 16) for w in re.findall("[^\\W\\d_]+", text)}


def plain_hashed(train, col, text, bits, min_df):
    rows = [(terms(t), r[col]) for r in train if (t := r[0]) and t.strip(" ")]
    df = Counter(k for ks, _ in rows for k in ks)
    slots = {}
    for k, n in df.items():
        if n >= min_df:
            s = k >> (36 - bits)
            slots[s] = min(slots.get(s, (0, 0)), (-n, k)) if s in slots else (-n, k)
    slots = {k for _, k in slots.values()}
    classes = sorted({y for _, y in rows if y is not None})
    n = defaultdict(Counter)
    for ks, y in rows:
        if y is not None:
            for k in ks & slots:
                n[k][y] += 1
    kept = [k for k in n if sum(n[k].values()) >= min_df]
    total = {c: sum(n[k][c] for k in kept) + len(kept) for c in classes}
    size = Counter(y for _, y in rows if y is not None)
    score = {}
    for c in classes:
        score[c] = round(1e6 * math.log(size[c] / size[classes[0]]))
        for k in terms(text) & set(kept):
            score[c] += round(1e6 * (math.log((n[k][c] + 1) / total[c]) - math.log((n[k][classes[0]] + 1) / total[classes[0]])))
    best = max(classes, key=lambda c: (score[c], [-ord(x) for x in c]))
    return best, 1 / sum(math.exp((s - score[best]) / 1e6) for s in score.values())


@pytest.mark.parametrize("bits", [3, 17])
def test_hashed_scores_equal_a_plain_version(spark, bits):
    train = spark.createDataFrame(TRAIN, "text string, y string, z string")
    scorer = H.fit_hashed(train, {"one": "y", "two": "z"}, bits=bits, min_df=3)
    texts = ["good day", "bad rain RAIN", "unknown", "sun and rain", "good bad calm", "", "  ", None, "word " * 5000 + "good"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "id int, text string, _slots int")
    got = {r["id"]: r for r in H.score_hashed(df, scorer).collect()}
    assert all(r["_slots"] == 7 for r in got.values()), "a column of the input keeps its name and values"
    for i, t in enumerate(texts):
        for name, col in (("one", 1), ("two", 2)):
            if not (t or "").strip():
                assert got[i][f"{name}_label"] is None and got[i][f"{name}_conf"] is None
                continue
            label, conf = plain_hashed(TRAIN, col, t, bits, 3)
            assert got[i][f"{name}_label"] == label and abs(got[i][f"{name}_conf"] - conf) < 1e-9
            assert abs(sum(got[i][f"{name}_probs"]) - 1) < 1e-9


def test_hashed_names_must_be_free(spark):
    scorer = H.fit_hashed(spark.createDataFrame(TRAIN, "text string, y string, z string"), {"one": "y"}, min_df=1)
    with pytest.raises(ValueError, match="one_conf"):
        H.score_hashed(spark.createDataFrame([("a", 1.0)], "text string, one_conf double"), scorer)


def test_hashed_accuracy_within_a_point_of_the_exact_model(spark):
    exact = {r["task"]: r["accuracy"] for r in QUERIES["accuracy"](spark, SF).collect()}
    got = {r["task"]: r["accuracy"] for r in QUERIES["hashed_accuracy"](spark, SF).collect()}
    assert set(got) == set(exact) and all(got[t] >= exact[t] - 0.01 for t in exact), (got, exact)


def test_hashed_scores_run_on_a_stream(spark, tmp_path):
    from evenline.operators.rewrite import neutral_rewrite
    from evenline.streaming.live import table_stream
    c = Context.get(spark, SF)
    rows = table_stream(spark, SF, "documents", c.table("documents").schema).select("doc_id", "text")
    out = H.rescore_hashed(neutral_rewrite(rows, c.lexicon_terms, "text", "neutral"), c.hashed_scorer).select("doc_id", "before_sentiment_label", "after_sentiment_label")
    q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = H.rescore_hashed(neutral_rewrite(c.docs.select("doc_id", "text"), c.lexicon_terms, "text", "neutral"), c.hashed_scorer).select(*got.columns)
    assert got.count() == 1000 and got.exceptAll(want).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, (1 << 60) - 1), max_size=300))
def test_every_key_sits_in_one_of_its_two_slots(keys):
    keys = list(keys)
    slots = I.place(keys)
    mask = len(slots) - 1
    for n, k in enumerate(keys):
        assert n in (slots[k & mask], slots[k >> I.SECOND & mask])
    assert sorted(s for s in slots if s >= 0) == list(range(len(keys)))


ROWS = [(1, "good calm day", "x"), (1, "bad rain", "x"), (1, "good calm day", "x"), (None, "rain", None), (2, None, "a"), (3, "", "b"), (4, " ", None), (5, "sun " * 3000, "good sun")]


@pytest.mark.parametrize("most", [I.MAX_NUMBERS, 0])
def test_both_ways_of_scoring_rows_equal_the_join(spark, most):
    train = spark.createDataFrame(TRAIN, "text string, y string, z string")
    models = ModelSet([fit_nb(train, "one", label_col="y", min_df=2), fit_nb(train, "two", label_col="z", min_df=2)])
    df = spark.createDataFrame([(*r, 5) for r in ROWS], "id int, text string, neutral string, _row int")
    cols = [f"{p}_{m}_{x}" for p in ("b", "a") for m in ("one", "two") for x in ("label", "conf")]
    got = I.score_rows(df, {"b": "text", "a": "neutral"}, models, reuse={"a": "b"}, most=most)
    assert got.columns[:4] == df.columns and got.where("_row = 5").count() == len(ROWS)

    def rows(d):
        return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in d.select("id", *cols).collect())
    assert rows(got) == rows(nb_scores(df, "id", {"b": "text", "a": "neutral"}, models))


def test_inline_needs_free_names(spark):
    models = ModelSet([fit_nb(spark.createDataFrame(TRAIN, "text string, y string, z string"), "one", label_col="y", min_df=2)])
    with pytest.raises(ValueError, match="one_label"):
        I.score_rows(spark.createDataFrame([("a", "b")], "text string, one_label string"), {"": "text"}, models)


def test_the_job_carries_no_text_in_keys(spark):
    """Exact scores in the row need no exchange, so no key can hold a text."""
    c = Context.get(spark, SF)
    p = I.score_rows(c.docs.withColumn("neutral", F.upper("text")), {"before": "text", "after": "neutral"}, c.model_set, reuse={"after": "before"})
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Generate|Aggregate|Join", plan)
