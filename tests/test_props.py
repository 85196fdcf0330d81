"""Properties, checked in batch on many generated rows against brute force."""

import random

import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenline.functions.lcs import lcs_dp, lcs_length
from evenline.functions.overlap import ngram_overlap
from evenline.functions.text import SENTINEL, rewrite_with_terms, tokens
from evenline.operators.splits import holdout_split, staged_fractions, staged_subsets

WORDS = ["greedy", "useless", "law", "Men", "STUPID", "stupid", "das", "wört", "a", "the", "uselessness"]
SEPS = [" ", "  ", ", ", ".\n", "\t", "-", " (", ") "]
LEX = ["greedy", "useless", "stupid"]
TOK = regex.compile(r"\p{L}+")


def gen_texts(n, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = rnd.randint(0, 12)
        s = rnd.choice(["", " ", "."])
        for _ in range(k):
            s += rnd.choice(WORDS) + rnd.choice(SEPS)
        out.append((i, s))
    return out


def py_rewrite(text, lex):
    segs = regex.findall(r"\p{L}+|[^\p{L}]+", text)
    marked = "".join(SENTINEL if s.lower() in lex else s for s in segs)
    return regex.sub(SENTINEL + "[ \t]?", "", marked)


def test_rewrite_matches_reference_and_properties(spark):
    rows = gen_texts(400)
    df = spark.createDataFrame(rows, "id long, text string")
    out = df.select("id", "text", rewrite_with_terms("text", LEX).alias("n"))
    out = out.select("id", "text", "n", rewrite_with_terms("n", LEX).alias("n2"), tokens("n").alias("t"))
    for r in out.collect():
        assert r.n == py_rewrite(r.text, set(LEX))
        assert r.n2 == r.n                                  # idempotent
        assert not set(r.t) & set(LEX)                      # no lexicon term survives
        if not {w.lower() for w in TOK.findall(r.text)} & set(LEX):
            assert r.n == r.text                            # untouched byte for byte


def _greedy_overlap(a, b, n):
    ga = [tuple(a[i:i + n]) for i in range(len(a) - n + 1)]
    gb = [tuple(b[i:i + n]) for i in range(len(b) - n + 1)]
    hits = 0
    for g in ga:
        if g in gb:
            gb.remove(g)
            hits += 1
    return hits


def test_ngram_overlap_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        a = [rnd.choice("abcde") for _ in range(rnd.randint(0, 15))]
        b = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 15))]
        rows.append((i, a, b))
    rows.append((300, None, ["a"]))
    df = spark.createDataFrame(rows, "id long, a array<string>, b array<string>")
    out = df.select("a", "b", *[ngram_overlap("a", "b", n).alias(f"o{n}") for n in (1, 2, 3)]).collect()
    for r in out:
        if r.a is None:
            assert r.o1 is None
            continue
        assert (r.o1, r.o2, r.o3) == tuple(_greedy_overlap(r.a, r.b, n) for n in (1, 2, 3))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40))
def test_lcs_bitparallel_equals_dp(a, b):
    assert lcs_length(a, b) == lcs_dp(a, b)


def test_lcs_long_texts():
    rnd = random.Random(1)
    a = [rnd.choice("abcdefgh") for _ in range(3000)]
    b = [x for x in a if rnd.random() < 0.9]
    assert lcs_length(a, b) == len(b)


def test_split_disjoint_complete_and_partition_invariant(spark):
    df = spark.createDataFrame(gen_texts(500, seed=11), "id long, text string")
    a = {r.id: r.split for r in holdout_split(df).collect()}
    b = {r.id: r.split for r in holdout_split(df.repartition(7)).collect()}
    assert a == b and len(a) == 500
    assert set(a.values()) <= {"train", "validation", "test"}
    by_text = {}
    for i, t in gen_texts(500, seed=11):
        by_text.setdefault(t, set()).add(a[i])
    assert all(len(v) == 1 for v in by_text.values())       # exact copies share a split


def test_staged_subsets_nested(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "example_id long, text string")
    s = staged_subsets(df, (50, 100, 200), "text", "example_id").collect()
    sets = {k: {r.example_id for r in s if r.stage == k} for k in (50, 100, 200)}
    assert [len(sets[k]) for k in (50, 100, 200)] == [50, 100, 200]
    assert sets[50] <= sets[100] <= sets[200]
    f = staged_fractions(df, (0.1, 0.5, 1.0), "text").collect()
    fs = {k: {r.example_id for r in f if r.stage == k} for k in (0.1, 0.5, 1.0)}
    assert fs[0.1] <= fs[0.5] <= fs[1.0] and len(fs[1.0]) == 300


def test_probabilities_sum_to_one(spark):
    import __spark_entry__ as E
    df = E.queries()["analyse"](spark, "/root/testdata/sf0.001")
    from evenline.plans.queries import analysed
    a = analysed(spark, "/root/testdata/sf0.001")
    bad = a.where(F.abs(F.aggregate("bias_probs", F.lit(0.0), lambda x, y: x + y) - 1) > 1e-9).count()
    assert bad == 0 and df.count() == 200


def test_multiset_difference_brute_force(spark):
    from evenline.functions.overlap import multiset_difference
    rnd = random.Random(5)
    rows = [(i, [rnd.choice("abcd") for _ in range(rnd.randint(0, 12))],
             [rnd.choice("abcde") for _ in range(rnd.randint(0, 12))]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a array<string>, b array<string>")
    for r in df.select("a", "b", multiset_difference("a", "b").alias("d")).collect():
        rest = list(r.a)
        for x in r.b:
            if x in rest:
                rest.remove(x)
        want = sorted((t, rest.count(t)) for t in set(rest))
        assert [(x.term, x.n) for x in r.d] == want


def test_ready_made_split_is_kept(spark):
    df = spark.createDataFrame([(1, "a", "validation"), (2, "b", None)], "id long, text string, split string")
    out = {r.id: r.split for r in holdout_split(df, keep_existing=True).collect()}
    fresh = {r.id: r.split for r in holdout_split(df.drop("split")).collect()}
    assert out[1] == "validation" and out[2] == fresh[2]


def test_staged_subsets_prefix_path_is_exact(spark):
    import hashlib
    rows = [(i, f"headline number {i % 1700}") for i in range(2000)]     # exact copies too
    df = spark.createDataFrame(rows, "example_id long, text string")
    want = sorted(rows, key=lambda r: (hashlib.md5(r[1].encode()).hexdigest(), r[0]))
    for over in (2.0, 0.5):                                             # 0.5 forces the retry
        got = staged_subsets(df, (5, 10, 20), "text", "example_id", oversample=over).collect()
        for k in (5, 10, 20):
            assert {r.example_id for r in got if r.stage == k} == {r[0] for r in want[:k]}
