"""Every registered operator query against a brute-force version on the fixture tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest

from evenline.llm import queries as Q


def collect(spark, tables, name):
    return {r["doc_id"]: r for r in Q.QUERIES[name](spark, tables[0]).collect()}


def test_op1_scores_whole_texts_and_separates(spark, tables):
    got = collect(spark, tables, "op1_toxicity")
    labels = {i: y for i, _, y in tables[2]}
    assert set(got) == {r[0] for r in tables[1]}
    assert all(got[i]["held_out"] == (brute.remainder(i, 3) == 1) and 0 <= got[i]["score"] <= 1 and got[i]["predicted"] == int(got[i]["score"] >= 0.7) for i in got)
    held = [(got[i]["score"], y) for i, y in labels.items() if got[i]["held_out"]]
    assert min(s for s, y in held if y) > max(s for s, y in held if not y)
    assert got[400]["score"] == got[401]["score"] == got[402]["score"] == 0


def test_op1_finds_the_offending_sentence(spark, tables):
    rows = dict((r[0], r[1]) for r in tables[1])
    got = collect(spark, tables, "op1_toxicity")
    for i, _, y in tables[2]:
        if y and got[i]["predicted"]:
            w = got[i]["worst"]
            sentence = rows[i].encode()[w["start"]:w["start"] + w["length"]].decode()
            assert any(x in sentence for x in ("idiot", "scum", "moron", "trash", "loser"))


def test_op1_bounded_sample_keeps_the_share_of_positives(spark):
    """A mark that half of its holders are toxic with scores about a half, also from a sample with more positives than there are."""
    from evenline.llm.toxicity import fit_toxicity, score_toxicity
    rows = [(i, "bad" if i % 10 < 2 else "good", int(i % 10 == 0)) for i in range(2000)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    for most in (200, 8000):
        got = {r["doc_id"]: r["score"] for r in score_toxicity(docs.where("doc_id < 3"), fit_toxicity(docs, labels, most)).collect()}
        assert 0.4 < got[0] < 0.62 and got[2] < 0.05, (most, got)


def test_op2_copies_and_reparameterised_items(spark, tables):
    got = {(r["doc_id"], r["item_id"]): r for r in Q.op2_decontamination(spark, tables[0]).collect()}
    copies = {r[0] for r in tables[1] if "seven lamps over the long wet bridge so" in (r[1] or "") and r[0] < 150}
    assert {d for d, _ in got} == copies | {413}, "414 renames 12 to a value that another slot holds"
    assert all((d, k) in got for d in copies for k in (0, 5))
    assert {got[d, 0]["kind"] for d in copies} == {"copy"} and got[413, 0]["kind"] == "reparameterised" and got[413, 0]["changed"] == 3, "Marta opens the item, and is a name all the same"


def test_op2_occurrences_are_judged_alone(spark):
    from evenline.llm.templates import find_contamination
    one = "while the old baker counts 12 loaves of dark bread her sister carries 30 jars over the narrow wooden bridge"
    two = "in the morning she sold 48 clips to her friends in spring and then she sold 24 clips to her friends in autumn"
    other, third = one.replace("12", "47"), one.replace("12", "52").replace("30", "61")
    docs = [(1, f"{one} so {other}"), (2, f"{other} so {third}"), (3, f"they say {two} again"), (4, two.replace("48", "90").replace("24", "91")), (5, one.replace("12", "30")),
            (6, one), (6, other), (7, " ".join(one.split()[:10]) + " and then for a long while nothing but rain fell here " + " ".join(one.split()[9:]))]
    got = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, one), (2, two)], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["changed"], r["kind"]) for r in got) == [
        (1, 1, 0, "copy"), (2, 1, 1, "reparameterised"), (3, 2, 0, "copy"), (4, 2, 2, "reparameterised"), (6, 1, 0, "copy"), (7, 1, 0, "copy")]


def test_op3_budgets(spark, tables):
    got = collect(spark, tables, "op3_mixing")
    sizes, rows = defaultdict(int), {r[0]: r for r in tables[1]}
    for r in tables[1]:
        assert got[r[0]]["size"] == len(brute.words(r[1]))
        sizes[r[3]] += got[r[0]]["size"]
    want, taken = brute.targets(sizes), defaultdict(int)
    for i, r in got.items():
        s = rows[i][3]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    lens = {s: [got[i]["size"] for i in got if rows[i][3] == s] for s in sizes}
    assert all(abs(taken[s] - want[s]) <= brute.slack(lens[s], want[s]) for s in sizes), (dict(taken), want)
    assert {i: r["taken"] for i, r in got.items()} == {i: r["taken"] for i, r in collect(spark, tables, "op3_mixing").items()}


def test_op4_equals_full_encoding(spark, tables):
    import tiktoken
    from evenline.llm.recount import counter
    enc = counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encoding
    assert isinstance(enc, tiktoken.Encoding)
    got = collect(spark, tables, "op4_edit_aware_counts")
    edits = spark.read.parquet(tables[0] + "/documents.parquet").select("doc_id", "text", Q._edits().alias("edits")).collect()
    for r in edits:
        if r["doc_id"] == 407:  # one 70,000-letter pre-token: quadratic in the tokenizer itself, checked by length only
            continue
        t, g = r["text"] or "", got[r["doc_id"]]
        assert (g["n_chars"], g["n_tokens"]) == (len(t), len(enc.encode_ordinary(t)))
        for e in r["edits"]:
            a = min(e["start"], len(t))
            t = t[:a] + e["new"] + t[max(a, min(e["end"], len(t))):]
        assert (g["edited_chars"], g["edited_tokens"]) == (len(t), len(enc.encode_ordinary(t)))


def test_op5_round_trip(spark, tables):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, at = collect(spark, tables, "op5_token_output"), 0
    for i, t in sorted((r[0], r[1] or "") for r in tables[1]):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        at += len(ids)


def test_op6_edits_and_neighbours(spark, tables):
    from evenline.llm.iblt import digests
    got = collect(spark, tables, "op6_fingerprints")
    rows = sorted(((r[0], r[1] or "") for r in tables[1]), reverse=True)

    def alike(x, y):
        a, b = set(digests(x).tolist()), set(digests(y).tolist())
        return len(a & b) / len(a | b) if a | b else 1.0
    prints = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        c = len(t) // 3
        edited = t[:len(t) - c] + after[:c]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert math.isclose(r["near_edited"], alike(t, edited)) and math.isclose(r["near_next"], alike(t, after))
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]


def test_op7_counts_base_and_held_out(spark, tables):
    got = collect(spark, tables, "op7_lattice_likelihood")
    c = Counter()
    for r in tables[1]:
        if brute.remainder(r[0], 7) != 2:
            c.update(brute.lower(r[1]) + ["end"])
    n, v = sum(c.values()), len(c)
    for r in tables[1]:
        w, g = brute.lower(r[1]) + ["end"], got[r[0]]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (brute.remainder(r[0], 7) == 2, len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(g["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert g["score"] < 0 and math.isfinite(g["score"])
    assert got[400]["score"] == got[401]["score"] == got[402]["score"]


def test_op8_components(spark, tables):
    got = collect(spark, tables, "op8_ngram_jaccard_join")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute.components(tables[1])


@pytest.mark.parametrize("percent, n", [(75, 7), (90, 13)])
def test_op8_short_text_inside_a_longer_one(spark, percent, n):
    """The shorter set may miss no shingle, but the longer one holds one more."""
    from evenline.llm.setjoin import jaccard_components
    w = [f"w{k}" for k in range(n + 1)]
    rows = [(1, " ".join(w[:n])), (2, " ".join(w)), (3, " ".join(w[:n - 1])), (4, "a b c d e f g"), (5, "x y z")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


@pytest.mark.parametrize("crowd, entries", [(256, 1 << 18), (0, 1 << 18), (3, 40)])
def test_op8_borderline_copies_beside_a_group(spark, monkeypatch, crowd, entries):
    """Copies of one text with edits around the limit: some link with a few members alone, some with none. Members
    are met by joined lists, in blocks, and in blocks of a few entries."""
    import random

    from evenline.llm import setjoin
    monkeypatch.setattr(setjoin, "CROWD", crowd)
    monkeypatch.setattr(setjoin, "BLOCK_ENTRIES", entries)
    rnd, rows = random.Random(8), []
    for g, n in enumerate((150, 40)):
        base = [f"g{g}w{k}" for k in range(n)]
        for i in range(70):
            w = list(base)
            for e in range(rnd.choice([1, 2, 2, 3, 3, 4, 4, 5]) if n > 50 else rnd.choice([0, 1, 1, 2])):
                w[rnd.randrange(n)] = f"x{g}-{i}-{e}"
            rows.append((1000 * g + i, " ".join(w)))
    rnd.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.components(rows)
    assert got == want and 3 < len({c for _, c in want.values()}) < 130


def test_op8_other_text_of_an_id_that_holds_a_copy(spark):
    from evenline.llm.setjoin import jaccard_components
    a, b = ([f"{x}{k}" for k in range(30)] for x in "ab")
    rows = [(1, " ".join(a)), (5, " ".join(a)), (5, " ".join(b)), (7, " ".join([*b, "more"])), (8, " ".join(a)), (9, "c d e f g h")]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == [(1, 26, 1), (5, 26, 1), (5, 26, 5), (7, 27, 5), (8, 26, 1), (9, 2, 9)]


def test_op9_held_out_accuracy(spark, tables):
    got = collect(spark, tables, "op9_language_id")
    rows = {r[0]: r for r in tables[1]}
    for i in (400, 401, 402, 406):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    held = [i for i, r in got.items() if r["held_out"] and i < 400 and len(rows[i][1]) > 40]
    assert sum(got[i]["lang_pred"] == rows[i][2] for i in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_op10_removes_later_windows(spark, tables):
    got = collect(spark, tables, "op10_substring_dedup")
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == brute.removed(tables[1])


def test_op10_same_without_the_broadcast_sketch(spark, tables):
    from evenline.llm.repeats import remove_repeats
    docs = spark.read.parquet(tables[0] + "/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in remove_repeats(docs, max_sketch_bytes=0).collect()}
    assert got == brute.removed(tables[1])


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_op10_texts_that_share_an_id(spark, limit):
    import random

    from conftest import prose
    from evenline.llm.repeats import remove_repeats
    rnd = random.Random(8)
    a, b, c = (prose(rnd, "en", 60) for _ in range(3))
    rows = [(1, a), (1, b), (1, b + " " + a), (2, a + " x y z " + c), (2, a), (2, a), (3, c), (None, c), (4, None)]
    got = sorted((r["doc_id"] or 99, r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), max_sketch_bytes=limit).collect())
    seen, want, done = set(), [], {}
    order = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], hashlib.md5((r[1] or "").encode()).hexdigest()))
    for i, t in order:
        w = brute.words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            if key in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(key)
        done[i, t] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    for i, t in rows:
        want.append((i or 99, *(done[i, t] if i else (len(brute.words(t)), 0, " ".join(t.split())))))
    assert got == sorted(want)


def test_every_query_counts_its_rows(spark, odd_tables):
    """Null ids, repeated ids and rows: one result row each, none lost."""
    for name in ("op1_toxicity", "op3_mixing", "op4_edit_aware_counts", "op5_token_output", "op6_fingerprints", "op7_lattice_likelihood", "op8_ngram_jaccard_join", "op9_language_id", "op10_substring_dedup"):
        rows = Q.QUERIES[name](spark, odd_tables).collect()
        assert len(rows) == 7, name
        assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == [1, 1, 1, 2, 3, None, None], name
    assert Q.op2_decontamination(spark, odd_tables).count() == 0


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_empty_tables(spark, empty_tables, name):
    assert Q.QUERIES[name](spark, empty_tables).collect() == []


def test_op7_frequent_words_are_bounded_at_any_count(spark):
    """Words more frequent than a million: never more than ``most`` pass, and as many as that allows."""
    from pyspark.sql import functions as F

    from evenline.llm.likelihood import _threshold
    for counts in ([2_000_000] * 50, [1, 1, 2, 3, 3, 7], [5_000_000 + k * 977 for k in range(60)] + [1] * 30, [10**12, 10**12 + 1, 3], []):
        words = spark.createDataFrame([(n,) for n in counts], "n long")
        for most in (0, 1, 3, 10, 55, 100):
            t = _threshold(words, most, 16)
            fit = [c for c in sorted(set(counts)) if sum(n >= c for n in counts) <= most]
            assert words.where(F.col("n") >= t).count() == (sum(n >= fit[0] for n in counts) if fit else 0) <= most


def test_pipeline_stages_keep_columns_of_any_name(spark, tables):
    """Columns named as the operators' own come through with their values."""
    import corpus_pipeline as P
    from pyspark.sql import functions as F
    path = tables[0]
    docs = spark.read.parquet(path + "/documents.parquet")
    odd = ["_size", "_n", "_nth", "_row", "_h", "_source", "_copies", "_copy", "_bucket", "_k", "_full", "_target", "_tie", "_doc", "row", "id", "tie", "nth", "gone", "a.b", "key"]
    docs = docs.select("*", *[(F.lit(k * 100_000) + F.coalesce("doc_id", F.lit(0))).alias(c) for k, c in enumerate(odd)])
    docs = docs.unionByName(docs.where("doc_id in (3, 7)").withColumn("text", F.concat("text", F.lit(" other end"))))  # ids of two texts
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        for r in out.select("doc_id", *[F.col(f"`{c}`") for c in odd]).collect():
            assert [r[c] for c in odd] == [k * 100_000 + (r["doc_id"] or 0) for k in range(len(odd))]


def test_op3_ties_do_not_depend_on_the_order_of_rows(spark):
    """Rows that share id and size, and differ in text: any shuffle of the table gives one mix."""
    from evenline.llm.mixing import mixed_documents
    rows = [(1, f"word{k} and two more", "a", k) for k in range(40)] + [(2, "x " * k, "b", k) for k in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    got = [sorted(map(repr, mixed_documents(docs.repartition(n, "extra")).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) < 48
