"""Operator 13 against plain versions: words, near words by comparison of all pairs, forms and roots."""

import random
import re
import zlib
from collections import Counter

import pytest

from evenline.llm import queries as Q
from evenline.llm import variants as V


def plain_words(rows, least=3):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            c[run if h % 97 else run[:k] + run[k + 1:]] += 1
    return {w: n for w, n in c.items() if n >= least and len(w) >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def plain_near(n):
    out = {}
    for a in n:
        s = [b for b in n if one_edit(a, b)]
        if s:
            best = min(s, key=lambda b: (-n[b], b))
            out[a] = (len(s), n[best], best)
    return out


def plain_forms(n):
    near, out = plain_near(n), {}
    form = {w: near[w][2] if w in near and near[w][1] >= 2 * n[w] else None for w in n}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], near.get(w, (0,))[0], n.get(form[w]))
    return out


def got_forms(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def misspelt(seed):
    rnd = random.Random(seed)
    good = ["".join(rnd.choice("abdeilnorstéß") for _ in range(rnd.choice([5, 6, 9, 13]))) for _ in range(40)]
    rows = []
    for i in range(150):
        out = []
        for _ in range(60):
            w = rnd.choice(good[:rnd.choice([3, 12, 40])])
            if rnd.random() < 0.3:
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abeé") + w[k:], w[:k] + rnd.choice("ax") + w[k + 1:]])
            out.append(rnd.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, rnd.choice([" ", ", ", "1"]).join(out)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_forms_and_roots_of_misspelt_text(spark, seed):
    rows = misspelt(seed)
    rows += [(None, "Straße strasse " * 4), (7, None), (8, ""), (9, "ÀÉcole ×÷×÷× " * 3), (9, "ÀÉcole " * 3), (10, "x" * 70_000 + " " + "x" * 69_999)] * 3
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    want = plain_forms(plain_words(rows))
    got = got_forms(V.spelling_forms(docs))
    assert got == want
    assert sum(f is not None for f, *_ in want.values()) > 20 and any(r != w and r != f for w, (f, r, *_) in want.items())


@pytest.mark.parametrize("hot, shard", [(V.HOT, V.SHARD), (20, 64), (3, 7)])
def test_near_words_do_not_depend_on_shards(spark, hot, shard):
    rnd = random.Random(5)
    n = {"".join(rnd.choice("abé") for _ in range(rnd.choice([5, 6, 7, 8]))): rnd.randint(3, 5) for _ in range(400)}
    n |= {"x" * 300: 3, "x" * 299 + "y": 4, "x" * 301: 4, "same" + "q" * 5000: 3, "same" + "q" * 5001: 3}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in V.near_words(words, hot, shard).collect()}
    assert got == plain_near(n)


@pytest.mark.parametrize("block, cells", [(7, 1 << 25), (64, 600), (1000, 1)])
def test_blocks_of_any_size_find_the_same(monkeypatch, block, cells):
    """Also without a table of bitsets, when positions and letters are too many for one."""
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "CELLS", cells)
    rnd = random.Random(6)
    n = {"".join(rnd.choice("ab") for _ in range(rnd.choice([5, 6, 7, 80]))): rnd.randint(3, 5) for _ in range(150)}
    blocks, want = V.cut_blocks(n), plain_near(n)
    for w in n:
        found = [x for side in (V.FRONT, V.BACK) for x in V.nearest(blocks, [w], side)]
        assert sum(x[1] for x in found) == want.get(w, (0,))[0]
        assert not found or min((-x[2], x[3]) for x in found) == (-want[w][1], want[w][2])


def test_query_over_whole_tables(spark, tables, odd_tables, empty_tables):
    assert got_forms(Q.op13_spelling_variants(spark, tables[0])) == plain_forms(plain_words([r[:2] for r in tables[1]]))
    assert Q.op13_spelling_variants(spark, odd_tables).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Q.op13_spelling_variants(spark, empty_tables).count() == 0
