"""The data structures and helpers under the operators."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evenline.llm import iblt, mixing, pieces, recount, repeats, setjoin, toxicity, wavelet, words

TEXT = st.text(alphabet="ab \t\n\x0b\x1c éZ日.", max_size=60)


@given(st.lists(TEXT, max_size=12), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_blocks_split_as_bytes_do(texts, size):
    got, per = [], []
    for b in words.blocks(pa.array(texts, pa.string()), block_bytes=size):
        got += b.words()
        per += b.n_words.tolist()
        assert [x for k in range(b.n_docs) for x in [k] * int(b.n_words[k])] == b.doc.tolist()
    assert got == [w for t in texts for w in brute.words(t)]
    assert per == [len(brute.words(t)) for t in texts]


@given(st.lists(TEXT, max_size=12))
@settings(max_examples=40, deadline=None)
def test_hashes_depend_on_the_word_alone(texts):
    seen = {}
    for size in (1, 1 << 20):
        for b in words.blocks(pa.array(texts, pa.string()), block_bytes=size):
            for w, h in zip(b.words(), b.hashes().tolist()):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_rolling_and_sliding_min():
    x = np.random.default_rng(0).integers(0, 1 << 62, 50).astype(np.uint64)
    r = words.rolling(x, 5, 0xD1342543DE82EF95)
    assert len(r) == 46 and r[3] == words.rolling(x[3:8], 5, 0xD1342543DE82EF95)[0]
    assert (words.sliding_min(x, 11) == [x[k:k + 11].min() for k in range(40)]).all()


def test_merged_sketch_never_underestimates():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 90))) for _ in range(60)]
    texts += texts[:10] + ["p q r s t " * 12]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    bits = repeats.sketch_bits(0)
    seen = np.zeros((repeats.ROWS, 1 << bits), np.int64)
    for half in (batch.slice(0, 30), batch.slice(30)):  # two tasks
        for out in repeats._partial_sketch(20, 10, bits)([half]):
            for r, s, raw in zip(*(out.column(c).to_pylist() for c in ("row", "shard", "cells"))):
                c = np.frombuffer(raw, "<u4")
                np.add.at(seen[r], (c & 0xFFFFF).astype(np.int64) + (s << 20), 1 + (c >> 31).astype(np.int64))
    count = {}
    where = {}
    for b in words.blocks(pa.array(texts)):
        i, s, n, a = repeats._anchors(b, b.hashes(), 20, 10)
        w = b.words()
        for x, y, z in zip(s, n, a):
            for k in i[x:x + y]:
                key = tuple(w[k:k + 20])
                count[key] = count.get(key, 0) + 1
                where[key] = np.uint64(z)
    for key, n in count.items():
        estimate = min(seen[r][int(repeats._cells(np.array([where[key]]), r, bits)[0])] for r in range(repeats.ROWS))
        assert estimate >= min(n, 2)


@given(st.lists(st.integers(0, 49407), max_size=300))
@settings(max_examples=40, deadline=None)
def test_wavelet_matrix(ids):
    x = np.array(ids, np.int64)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(x).to_bytes())
    assert (m.decode() == x).all()
    assert (m.access(np.arange(len(x))) == x).all() if len(x) else True
    for t in [*ids[:5], 0, 49407]:
        assert m.count(t) == (x == t).sum() and m.count(t, len(x) // 2) == (x[:len(x) // 2] == t).sum()
        assert (m.occurrences(t) == np.flatnonzero(x == t)).all()
    assert m.count(1 << 20) == 0


def test_wavelet_rejects_cut_files():
    raw = wavelet.WaveletMatrix.build(np.arange(100)).to_bytes()
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix.from_bytes(raw[:-1])


def test_find_token_from_files(spark, tmp_path):
    docs = spark.createDataFrame([(k, "the idiot of the house") for k in range(5)], "doc_id long, text string")
    out = str(tmp_path / "tokens")
    wavelet.write_tokens(docs, out, public_tokenizers.path("word_bpe_49k.json"))
    from tokenizers import Tokenizer
    the = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("the", add_special_tokens=False).ids[0]
    assert sum(r["n"] for r in wavelet.find_token(spark, out, the).collect()) == 10


@given(st.sets(st.integers(1, 1 << 60), max_size=80), st.sets(st.integers(1, 1 << 60), max_size=80), st.sets(st.integers(1, 1 << 60), max_size=80))
@settings(max_examples=60, deadline=None)
def test_sketch_difference_recovers_both_sides(a, b, both):
    x, y = np.array(sorted(a | both), np.uint64), np.array(sorted(b | both), np.uint64)
    plus, minus, _ = iblt.difference(x, y)
    assert set(plus.tolist()) == (a | both) - (b | both) and set(minus.tolist()) == (b | both) - (a | both)


def test_repeated_paragraphs_stay_apart():
    assert len(set(iblt.digests("x\nx\nx").tolist())) == 3
    assert iblt.likeness(iblt.digests("x\nx"), iblt.digests("x")) == 0.5


@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 6)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 200))
@settings(max_examples=60, deadline=None)
def test_nearest_subset_is_optimal(items, budget):
    sums = {0}
    for s, c in items:
        sums = {x + s * k for x in sums for k in range(c + 1)}
    took = mixing.nearest_subset([s for s, _ in items], [c for _, c in items], budget)
    assert all(0 <= t <= c for t, (_, c) in zip(took, items))
    got = sum(t * s for t, (s, _) in zip(took, items))
    assert abs(got - budget) == min(abs(x - budget) for x in sums)


def test_fit_counts_hits_large_budgets():
    rnd = np.random.default_rng(2)
    sizes, counts = np.arange(1, 3000), rnd.integers(0, 2000, 2999)
    total = int((sizes * counts).sum())
    for budget in (1, total // 3, total // 2 + 1, total - 1):
        took = mixing.fit_counts(sizes, counts, budget)
        assert (took >= 0).all() and (took <= counts).all() and int((took * sizes).sum()) == budget


PIECES = pieces.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_lattice_forward_and_expected_counts():
    names, w = PIECES
    w = w - np.logaddexp.reduce(w)
    lattice, table = pieces.Lattice(names, w), dict(zip(names, w))

    def paths(x, at=0):
        if at == len(x):
            yield 0.0, []
        for end in range(at + 1, len(x) + 1):
            if x[at:end] in table:
                for p, rest in paths(x, end):
                    yield table[x[at:end]] + p, [x[at:end], *rest]
    ws = [b"the", b"erwhou", "éau".encode(), b"\xff", b"."]
    got = lattice.log_probability(ws)[:, 0]
    uses = lattice.expected_counts(ws, np.array([3.0, 1, 1, 1, 1]))[:, 0]
    want = np.zeros(len(names))
    for x, g, n in zip(ws, got, [3.0, 1, 1, 1, 1]):
        every = list(paths(b" " + x))
        total = np.logaddexp.reduce([p for p, _ in every])
        assert abs(total - g) < 1e-9
        for p, parts in every:
            for q in parts:
                want[names.index(q)] += n * np.exp(p - total)
    assert np.abs(uses - want).max() < 1e-9
    long = b"ab" * 500
    assert np.isfinite(lattice.log_probability([long])).all()


def test_lattice_long_words_keep_every_segmentation():
    names, w = PIECES
    assert any(len(x) > 16 and x[:1] != b" " for x in names), "longer pieces inside a word"
    w = w - np.logaddexp.reduce(w)
    lattice, table, m = pieces.Lattice(names, w), dict(zip(names, w)), max(map(len, names))
    at = {x: k for k, x in enumerate(names)}
    inner = [x for x in names if len(x) > 16 and x[:1] != b" "]
    ws = ["日本語のテキスト中文".encode() * 9, b"https://example.org/the/erwhou" * 20, b"x" * 62 + "éau".encode(), b"a" * 63, b"a" * 64, b"ab" + inner[0] + b"c", b"the" * 400, "я".encode() * 32]
    counts = np.array([[3.0, 1], [1, 0], [1, 2], [1, 1], [1, 5], [2, 1], [0, 4], [1, 1]])
    got, uses, want = lattice.log_probability(ws)[:, 0], lattice.expected_counts(ws, counts), np.zeros((len(names), 2))
    for x, g, n in zip(ws, got, counts):
        x = b" " + x
        arcs = [(i, j, x[i:j]) for j in range(1, len(x) + 1) for i in range(max(0, j - m), j) if x[i:j] in table]
        a, b = np.full(len(x) + 1, -np.inf), np.full(len(x) + 1, -np.inf)
        a[0] = b[-1] = 0
        for i, j, q in arcs:
            a[j] = np.logaddexp(a[j], a[i] + table[q])
        for i, j, q in reversed(arcs):
            b[i] = np.logaddexp(b[i], table[q] + b[j])
        assert abs(a[-1] - g) < 1e-8 and abs(b[0] - g) < 1e-8
        for i, j, q in arcs:
            want[at[q]] += n * np.exp(a[i] + table[q] + b[j] - a[-1])
    assert np.abs(uses - want).max() < 1e-7


def test_hash_table_finds_shared_slots():
    keys = np.arange(1, 4000, dtype=np.uint64)  # all in one slot
    t = pieces.HashTable(keys)
    assert (t.find(np.array([1, 17, 3999, 4000, 1 << 63], np.uint64)) == [0, 16, 3998, -1, -1]).all()


COUNTER = recount.PieceCounter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
ODD = st.text(alphabet="ab c  \n\t'sre12.,!é日 ", max_size=40)


@given(st.lists(ODD, max_size=30), st.lists(st.tuples(st.integers(0, 900), st.integers(0, 60), ODD), max_size=6))
@settings(max_examples=150, deadline=None)
def test_edits_keep_counts_and_pre_tokens(parts, edits):
    t = "".join(parts)
    c = recount.CountedText(t, COUNTER)
    for a, n, new in edits:
        a = min(a, len(t))
        c.replace(a, a + n, new)
        t = t[:a] + new + t[a + n:]
        assert c.text() == t and c.n_tokens == len(COUNTER.encoding.encode_ordinary(t))
        assert [p for leaf, _ in c.leaves for p in leaf] == COUNTER.find(t)
        assert c.tokens_before(len(c.leaves) - 1) == sum(sum(n) for _, n in c.leaves[:-1])


def test_an_edit_touches_a_small_region():
    t = "some words of a long text " * 4000
    c = recount.CountedText(t, COUNTER)
    assert c.replace(50_000, 50_010, "other") < 200


def test_boundary_follows_cost():
    assert setjoin.choose_boundary({20: 1000}, 0.0) < 20 <= setjoin.choose_boundary({20: 1000}, 1e6)


@pytest.mark.parametrize("boundary", [0, 6, 60, 10_000])
def test_heavy_and_light_agree(spark, tables, monkeypatch, boundary):
    monkeypatch.setattr(setjoin, "choose_boundary", lambda *a: boundary)
    rows = [r for r in tables[1] if r[1] is None or len(r[1]) < 2000]
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.jaccard_components(docs).collect()}
    assert got == brute.components(rows)


def test_noisy_or_learns_from_documents_alone():
    rnd = np.random.default_rng(0)
    feats, sent, sent_doc, y = [], [], [], []
    n = 0
    for d in range(400):
        bad = d % 4 == 0
        for s in range(5):
            f = rnd.integers(1000, 1200, (6, 3))
            if bad and s == 2:
                f[0] = 7
            feats.append(f)
            sent += [n] * 6
            sent_doc.append(d)
            n += 1
        y.append(float(bad))
    w, b = toxicity.fit_bags(np.concatenate(feats).astype(np.int32), np.array(sent), np.array(sent_doc), np.array(y))
    assert w[7] > 1 and b + 3 * w[7] > 0 > b


@pytest.mark.parametrize("cache", [1 << 26, 100_000])
def test_word_encoder_equals_the_tokenizer(monkeypatch, cache):
    """Special tokens, marks, composed letters and a cache that is dropped: ids are those of the whole text."""
    from tokenizers import Tokenizer
    monkeypatch.setattr(wavelet, "CACHE_BYTES", cache)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, enc, rnd = Tokenizer.from_file(path), wavelet.WordEncoder(path, 2), random.Random(1)
    letters = "aZé É.,!?'sß İΣς\u0301\x01<|>endoftext\n\t0１"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(2000)]
    texts += ["".join(rnd.choice(["th", "sh", "er", "on", " ", " ", ". "]) for _ in range(400)) + rnd.choice(["", " <|endoftext|>.", " <|ENDOFTEXT|>"]) for _ in range(300)]
    texts += ["it's <|endoftext|>. A<|endoftext|>b", "é.", "Straße! ÄÖ.", "a..b..", "...", "x" * 5000 + ".", None, ""]
    for block in words.blocks(pa.array(texts, pa.string()), block_bytes=1 << 14):
        ids, n = enc.encode(block)
        assert len(n) == block.n_docs
        for t, end, k in zip(texts[block.first:], np.cumsum(n).tolist(), n.tolist()):
            assert ids[end - k:end].tolist() == tok.encode(t or "", add_special_tokens=False).ids + [2]
