"""Exact split sizes, quantile sketches and bootstrap intervals against plain versions."""

import hashlib
import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenline.operators import compare as cmp
from evenline.operators import metrics
from evenline.operators.splits import exact_sizes, exact_split


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=2), st.integers(0, 40), min_size=1, max_size=6), st.lists(st.integers(0, 100), min_size=0, max_size=3), st.randoms())
def test_sizes_add_up_both_ways(counts, cuts, rnd):
    total = sum(counts.values())
    at = sorted(min(c, total) for c in cuts)
    sizes = [b - a for a, b in zip([0, *at], [*at, total])]
    plan = exact_sizes(counts, sizes)
    assert [sum(p.values()) for p in plan] == sizes
    assert all(sum(p[y] for p in plan) == n for y, n in counts.items())
    assert all(p[y] >= 0 and abs(sum(q[y] for q in plan[:k + 1]) - counts[y] * sum(sizes[:k + 1]) / max(total, 1)) <= len(counts) for k, p in enumerate(plan) for y in counts)


def table(n=400, seed=1):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["copy", f"text {i}", None, ""]), rnd.choice(["a", "a", "a", "b", None])) for i in range(n)]


@pytest.mark.parametrize("sizes", [{"train": 317, "validation": 40, "test": 43}, {"train": 0.8, "validation": 0.1, "test": 0.1}, {"all": 400}, {"none": 0, "all": 400}])
@pytest.mark.parametrize("label", [None, "y"])
def test_counts_are_exact_whatever_the_partitions(spark, sizes, label):
    rows = table()
    out = {}
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, y string").repartition(parts)
        got = exact_split(df, sizes, label=label).collect()
        out[parts] = {r["doc_id"]: r["split"] for r in got}
        n = Counter(r["split"] for r in got)
        want = {k: v if isinstance(v, int) else round(v * 400) for k, v in sizes.items()}
        assert n == {k: v for k, v in want.items() if v}
        if label:
            by = Counter((r["split"], r["y"]) for r in got)
            for y in ("a", "b", None):
                total = sum(r[2] == y for r in rows)
                assert all(abs(by[k, y] - total * v / 400) < 2 for k, v in want.items())
    assert out[1] == out[5]
    if label is None:  # stretches of the order by (md5(text), md5(id))
        order = sorted(rows, key=lambda r: md5(r[1] or "") + md5(str(r[0])))
        seen = [out[1][r[0]] for r in order]
        assert seen == sorted(seen, key=list(sizes).index)


def test_a_hot_text_is_cut_by_id(spark):
    """All rows hold one text: the cut falls inside the digits of the ids' md5."""
    df = spark.createDataFrame([(i, "same") for i in range(5000)], "doc_id long, text string")
    n = Counter(r["split"] for r in exact_split(df, {"train": 4001, "test": 999}).collect())
    assert n == {"train": 4001, "test": 999}


def test_repeated_rows_stay_together_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "x")] * 10 + [(2, "y")] * 10, "doc_id long, text string")
    got = exact_split(df, {"a": 5, "b": 15}).groupBy("doc_id").agg(F.count_distinct("split").alias("n")).collect()
    assert all(r["n"] == 1 for r in got)
    assert exact_split(df.limit(0), {"a": 0.5, "b": 0.5}).count() == 0
    with pytest.raises(ValueError, match="add up"):
        exact_split(df, {"a": 3, "b": 4})


def compared_rows(seed, n):
    rnd = random.Random(seed)
    return [(rnd.choice(["en", "de", None]), *[rnd.choice([None, rnd.gauss(0, 1), 0.0]) if k else rnd.gauss(0, 1) for k in range(3)]) for _ in range(n)]


def test_quantiles_exact_below_the_sketch_size_and_close_above(spark):
    cols = ", ".join(f"{ax}_delta double" for ax in cmp.AXES)
    for n, size, slack in ((900, 4096, 0), (30_000, 256, 0.02)):
        rows = compared_rows(2, n)
        got = cmp.effect_quantiles(spark.createDataFrame(rows, f"lang string, {cols}").repartition(7), ["lang"], size=size).collect()
        overall = [r for r in got if r["lang"] is None and r["n"] >= sum(x[1 + cmp.AXES.index(r["axis"])] is not None for x in rows)]
        assert {r["axis"] for r in overall} == set(cmp.AXES)
        for r in overall:
            xs = sorted(x[1 + cmp.AXES.index(r["axis"])] for x in rows if x[1 + cmp.AXES.index(r["axis"])] is not None)
            assert r["n"] == len(xs)
            for q in (0.1, 0.5, 0.9):
                lo, hi = (xs[min(len(xs) - 1, max(0, math.ceil((q + d) * len(xs) - 1e-9) - 1))] for d in (-slack, slack))
                assert round(lo, 4) - 1e-9 <= r[f"p{round(100 * q)}"] <= round(hi, 4) + 1e-9
    nothing = cmp.effect_quantiles(spark.createDataFrame([("en", None, None, None)], f"lang string, {cols}"), ["lang"]).collect()
    assert all(r["n"] == 0 and r["p50"] is None for r in nothing)


def plain_interval(rows, replicates=100):
    means = []
    for b in range(replicates):
        s = w = 0
        for k, v in rows:
            if v is not None:
                u = int(md5(f"{'' if k is None else k}:{b}")[:8], 16) / 4294967296.0
                n = sum(u >= p for p in metrics.POISSON)
                s, w = s + n * v, w + n
        if w:
            means.append(s / w)
    means.sort()
    k = max(1, math.ceil(len(means) * 0.025 - 1e-9))
    return means[k - 1], means[-k]


def test_intervals_equal_a_plain_bootstrap_and_cover_the_mean(spark):
    rnd = random.Random(3)
    rows = [(i, float(rnd.random() < 0.7)) for i in range(300)] + [(7, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "id long, v double")
    r = metrics.metric_intervals(df.repartition(5), "id", "v").first()
    low, high = plain_interval(rows)
    assert (r["n"], r["low"], r["high"]) == (301, round(low, 4), round(high, 4))
    assert r["low"] < r["estimate"] < r["high"] and abs((r["high"] - r["low"]) - 2 * 1.96 * math.sqrt(0.7 * 0.3 / 301)) < 0.03
    assert metrics.metric_intervals(df.where("v is null"), "id", "v", ["id"]).count() == 0
