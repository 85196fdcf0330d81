"""Plan shape guards: what the README claims about shuffles, joins and
pushdown, checked on the physical plans of the registered queries."""

import re

import pytest


from evenline.plans import QUERIES

SF = "/root/testdata/sf0.001"
MAP_ONLY = ["english_only", "holdout_split", "neutral_rewrite", "rouge1", "rouge2", "rouge_l",
            "meaning_preserved", "concat_fields", "multilingual", "build_prompt", "hashed_scores", "hashed_prompt"]
ONE_SHUFFLE = ["score_truth", "score_sentiment", "score_bias", "analyse", "format_confidence",
               "before_after", "radar_rows"]
SKIP = {"stream_neutralize", "stream_windows", "profile_stream", "live_reads"}   # driver loops / streams


def _plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SKIP])
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", MAP_ONLY)
def test_map_only(spark, name):
    p = _plan(spark, name)
    assert "Exchange" not in p, p


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_scoring_has_one_shuffle_and_broadcast_weights(spark, name):
    p = _plan(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1, p
    assert "BroadcastHashJoin" in p


def test_stream_scores_in_the_row(spark):
    """No exchange, explode or aggregate at all: neither text is a key of anything."""
    from evenline.plans.context import Context
    from evenline.plans.queries import stream_process
    c = Context.get(spark, SF)
    p = stream_process(c)(c.table("documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Generate|Aggregate|Join", p)


def test_filter_and_columns_reach_the_scan(spark):
    df = QUERIES["english_only"](spark, SF)
    s = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(lang,en)" in s
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in s


@pytest.mark.parametrize("name", ["staged_fit", "select_model", "log_loss"])
def test_evaluation_explodes_tokens_once(spark, name):
    """Many models on one text: one token explode, whatever their number (the
    other explodes unfold a handful of result structs)."""
    p = _plan(spark, name)
    assert len(re.findall(r"Generate explode\(_all", p)) == 1, p
