"""The reference's one worked example and the hand-made edge rows (FIXTURES.md)."""

from pyspark.sql import functions as F

from evenline.functions.lcs import lcs_length
from evenline.functions.text import SENTINEL, concat_fields, rewrite_with_terms, tokens
from evenline.operators import metrics
from evenline.operators.compare import meaning_preserved
from evenline.operators.rewrite import neutral_rewrite, removed_summary, removed_terms
from evenline.operators.scoring import confidence_text

ORIGINAL = "The greedy politicians passed another useless law to affect hardworking citizens."
NEUTRAL = "The politicians passed another law to affect hardworking citizens."
LEX = ["greedy", "useless"]


def test_golden_rewrite(spark):
    df = spark.createDataFrame([(1, ORIGINAL)], "id long, text string")
    out = neutral_rewrite(df, LEX, "text", "neutral").first()
    assert out.neutral == NEUTRAL


def test_golden_removed_and_tokens(spark):
    df = spark.createDataFrame([(1, ORIGINAL, NEUTRAL)], "id long, text string, neutral string")
    rem = {r.term: r.removed for r in removed_terms(df, "id").collect()}
    assert rem == {"greedy": 1, "useless": 1}
    s = {r.term: (r.n_docs, r.n_removed) for r in removed_summary(removed_terms(df, "id"), "id").collect()}
    assert s == {"greedy": (1, 1), "useless": (1, 1)}
    t = df.select(F.size(tokens("text")).alias("a"), F.size(tokens("neutral")).alias("b")).first()
    assert (t.a, t.b) == (11, 9)


def test_golden_rouge(spark):
    df = spark.createDataFrame([(1, ORIGINAL, NEUTRAL)], "id long, text string, neutral string")
    r1 = metrics.rouge_n(df, "id", "text", "neutral", 1).first()
    assert (r1.rouge1_overlap, r1.rouge1_p, r1.rouge1_r, r1.rouge1_f1) == (9, 1.0, round(9 / 11, 4), 0.9)
    r2 = metrics.rouge_n(df, "id", "text", "neutral", 2).first()
    assert (r2.rouge2_overlap, r2.rouge2_p, r2.rouge2_r, r2.rouge2_f1) == (6, 0.75, 0.6, 0.6667)
    rl = metrics.rouge_l(df, "id", "text", "neutral").first()
    assert (rl.lcs, rl.rougeL_f1) == (9, 0.9)
    mp = meaning_preserved(df, "id", "text", "neutral", 0.8).first()
    assert mp.rouge1_f1 == 0.9 and mp.preserved
    assert lcs_length(ORIGINAL.lower().split(), NEUTRAL.lower().split()) == 9


def test_format_confidence(spark):
    df = spark.createDataFrame([("False", 0.971), ("Negative", 0.997), ("Left", 0.874), (None, 0.5)],
                               "l string, p double")
    got = [r.f for r in df.select(confidence_text(F.col("l"), F.col("p")).alias("f")).collect()]
    assert got == ["False (97.1%)", "Negative (99.7%)", "Left (87.4%)", None]


EDGE = [
    (1, None, ["greedy"], None),
    (2, "   ", ["greedy"], "   "),
    (3, "Useless", ["useless"], ""),
    (4, "what a loser.", ["loser"], "what a ."),
    (5, "Greedy men left", ["greedy"], "men left"),
    (6, "uselessness", ["useless"], "uselessness"),
    (7, "GREEDY men", ["greedy"], "men"),
    (8, "das achlichä wort", ["achlichä"], "das wort"),
    (9, "stupid stupid law", ["stupid"], "law"),
    (10, "bad" + SENTINEL + " x", ["bad"], None),
]


def test_edge_rows(spark):
    for i, text, lex, expected in EDGE:
        df = spark.createDataFrame([(i, text)], "id long, text string")
        got = df.select(rewrite_with_terms("text", lex).alias("n")).first().n
        assert got == expected, (i, text, got)


def test_concat_missing_heading(spark):
    df = spark.createDataFrame([("A", None, "B"), ("A", "  ", "B"), (None, None, None)],
                               "title string, heading string, body string")
    got = [r.t for r in df.select(concat_fields("title", "heading", "body").alias("t")).collect()]
    assert got == ["A B", "A B", None]


def test_tie_goes_to_lower_class(spark):
    from evenline.operators.naive_bayes import finish
    df = spark.createDataFrame([([0.0, 0.0],), ([-1.0, -1.0],)], "x_logp array<double>")
    r = finish(df, "x", ["a", "b"]).collect()
    assert [x.x_label for x in r] == ["a", "a"] and all(abs(x.x_conf - 0.5) < 1e-12 for x in r)


def test_blank_text_is_not_scored(spark):
    from evenline.operators.naive_bayes import nb_scores
    from evenline.plans.context import Context
    c = Context.get(spark, "/root/testdata/sf0.001")
    df = spark.createDataFrame([(1, None), (2, "   "), (3, "...")], "doc_id long, text string")
    r = {x.doc_id: x for x in nb_scores(df, "doc_id", {"": "text"}, [c.models["truth"]]).collect()}
    assert r[1].truth_label is None and r[1].truth_conf is None
    assert r[2].truth_label is None and r[2].truth_conf is None
    assert r[3].truth_label is not None                       # no tokens: the prior decides
