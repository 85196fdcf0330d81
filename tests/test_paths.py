"""Every plan choice taken on a size check gives the same rows as the other."""

from pyspark.sql import functions as F

from evenline.operators.naive_bayes import nb_scores
from evenline.operators.rewrite import neutral_rewrite
from evenline.plans.context import Context

SF = "/root/testdata/sf0.001"


def test_rewrite_inline_equals_join(spark):
    c = Context.get(spark, SF)
    lex = spark.createDataFrame([(t,) for t in ["the", "und", "le", "el", "ouè", "greedy"]], "term string")
    a = neutral_rewrite(c.docs, lex, "text", "n", key="doc_id").select("doc_id", "n")
    b = neutral_rewrite(c.docs, lex, "text", "n", key="doc_id", max_inline=2).select("doc_id", "n")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.join(c.docs, "doc_id").where("n != text").count() > 100   # the terms are common words


def test_rewrite_per_language_join_path(spark):
    c = Context.get(spark, SF)
    lex = spark.createDataFrame([("en", "the"), ("fr", "le"), ("de", "und")], "lang string, term string")
    a = neutral_rewrite(c.docs, lex, "text", "n", key="doc_id", by="lang").select("doc_id", "n")
    b = neutral_rewrite(c.docs, lex, "text", "n", key="doc_id", by="lang", max_inline=1).select("doc_id", "n")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scoring_broadcast_equals_salted(spark):
    c = Context.get(spark, SF)
    ms = [c.models[t] for t in ("truth", "sentiment", "bias")]
    a = nb_scores(c.docs, "doc_id", {"": "text"}, ms)
    b = nb_scores(c.docs, "doc_id", {"": "text"}, ms, max_broadcast=0, salt_buckets=5)
    cols = ["doc_id"] + [F.round(f"{t}_conf", 9).alias(t) for t in ("truth", "sentiment", "bias")] + \
        [f"{t}_label" for t in ("truth", "sentiment", "bias")]
    x, y = a.select(*cols), b.select(*cols)
    assert x.count() == 200 and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_broadcast_plan_has_no_shuffle_of_tokens(spark):
    c = Context.get(spark, SF)
    s = nb_scores(c.docs, "doc_id", {"": "text"}, [c.models["truth"]])
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_large_lexicon_needs_no_unique_key(spark):
    rows = spark.createDataFrame([(1, "the cat the end"), (1, "a cat"), (1, "the cat the end"), (2, None), (3, "")], "id long, text string")
    lex = spark.createDataFrame([("the",), ("cat",)], "term string")
    got = sorted((r.id, r.text or "", r.n) for r in neutral_rewrite(rows, lex, "text", "n", max_inline=0).collect())
    want = sorted((r.id, r.text or "", r.n) for r in neutral_rewrite(rows, lex, "text", "n").collect())
    assert got == want and len(got) == 5


def test_stream_plan_with_a_lexicon_beyond_the_limit(spark, monkeypatch):
    from evenline.operators import rewrite as rw
    from evenline.plans.queries import stream_process
    c = Context.get(spark, SF)
    want = stream_process(c)(c.table("documents"))
    real = rw.neutral_rewrite
    monkeypatch.setattr(rw, "neutral_rewrite", lambda df, lex, *a, **k: real(df, c.loaded_terms, *a, **{**k, "max_inline": 0}))
    got = stream_process(c)(c.table("documents"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_unseen_labels_cost_and_count(spark):
    from evenline.operators import metrics
    d = spark.createDataFrame([("a", "a", [0.9, 0.1]), ("z", "b", [0.2, 0.8])], "label string, pred string, probs array<double>")
    r = metrics.accuracy_and_loss(d, "label", "pred", "probs", ["a", "b"]).first()
    assert (r.n, r.accuracy) == (2, 0.5) and r.log_loss > 17
    assert metrics.log_loss(d, "label", "probs", ["a", "b"]).first().n == 2


def test_majority_baseline_of_many_groups(spark):
    from evenline.operators.metrics import majority_baseline
    d = spark.range(6000).selectExpr("id % 2000 AS g", "CAST(id % 3 AS STRING) AS label")
    assert majority_baseline(d, d, "label", by=["g"]).count() == 2000


def test_reads_of_unscored_documents_count(spark):
    from evenline.operators.profile import prior_means, user_bias_profile
    reads = spark.createDataFrame([(1, 1, 7, 0), (2, 2, 7, 1), (3, 3, 7, 0)], "event_id long, t long, user_id long, doc_id long").withColumn("ts", F.timestamp_seconds("t"))
    dv = spark.createDataFrame([(0, 0.5)], "doc_id long, x double")
    assert tuple(user_bias_profile(reads, dv, "user_id", ("x",)).first()) == (7, 3, 0.5)
    got = {r.event_id: (r.prior_reads, r.prior_x_mean) for r in prior_means(reads, dv, "user_id", ("ts", "event_id"), ("x",)).collect()}
    assert got == {1: (0, None), 2: (1, 0.5), 3: (2, 0.5)}


def test_grouped_scores_broadcast_equals_salted(spark):
    from evenline.operators.naive_bayes import fit_nb_grouped, nb_scores_grouped
    c = Context.get(spark, SF)
    m = fit_nb_grouped(c.task("sentiment").where("split = 'train'"), "lang")
    cols = ["doc_id", "lang", "s_label", F.round("s_conf", 9).alias("c")]
    x = nb_scores_grouped(c.docs, "doc_id", "lang", m, "s").select(*cols)
    y = nb_scores_grouped(c.docs, "doc_id", "lang", m, "s", max_broadcast=0, salt_buckets=3).select(*cols)
    assert x.count() == 200 and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_table_stream_reads_directories_by_any_path(spark, tmp_path):
    import pytest
    from evenline.streaming.live import run_foreach_batch, table_stream
    d = spark.read.parquet(f"{SF}/labels.parquet")
    d.repartition(3).write.parquet(str(tmp_path / "labels.parquet"))
    s = table_stream(spark, f"file://{tmp_path}", "labels", d.schema)
    run_foreach_batch(s, lambda b, _: b, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == d.count()
    with pytest.raises(FileNotFoundError):
        table_stream(spark, str(tmp_path), "missing", d.schema)
