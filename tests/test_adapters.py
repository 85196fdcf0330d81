"""External model adapters, with small stand-in models (the real transformer
weights are the user's): batching, contract and null handling."""

import numpy as np

from evenline.operators.adapters import external_classifier, score_external, seq2seq_rewrite, seq2seq_rewriter
from evenline.operators.compare import compare_tables


def test_external_classifier_and_rewriter(spark):
    # stand-in models defined here so they are shipped to the workers by value
    def _make_classifier():
        def predict(texts):
            neg = np.array([1.0 if "useless" in t.lower() else 0.0 for t in texts])
            return np.stack([0.2 + 0.6 * (1 - neg), 0.8 - 0.6 * (1 - neg)], axis=1)
        return predict

    def _make_rewriter():
        def generate(prompts):
            return [p.split("headline: ", 1)[-1].replace("useless ", "") for p in prompts]
        return generate

    rows = [(1, "A useless law"), (2, "A fine law"), (3, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    clf = external_classifier(_make_classifier, ["Neutral", "Negative"], batch_size=2)
    s = score_external(df, "text", "sentiment", clf, ["Neutral", "Negative"])
    got = {r.id: (r.sentiment_label, None if r.sentiment_conf is None else round(r.sentiment_conf, 3))
           for r in s.collect()}
    assert got == {1: ("Negative", 0.8), 2: ("Neutral", 0.8), 3: (None, None)}
    p = s.selectExpr("id", "text", "CASE WHEN text IS NULL THEN NULL ELSE concat('neutralize | headline: ', text) END AS prompt")
    r = seq2seq_rewrite(p, "prompt", seq2seq_rewriter(_make_rewriter, batch_size=2), "neutral")
    assert {x.id: x.neutral for x in r.collect()} == {1: "A law", 2: "A fine law", 3: None}
    after = score_external(r, "neutral", "sentiment", clf, ["Neutral", "Negative"])
    cmp = compare_tables(s, after, "id", ["sentiment"]).where("id = 1").first()
    assert (cmp.sentiment_before, cmp.sentiment_after, cmp.sentiment_flip) == ("Negative", "Neutral", True)
