"""Operator 9, language identification by rank-order n-gram profiles.

Texts become lower-case letters with every run of other characters as one space.
A profile is the ``top`` most frequent 1- to 3-grams in descending order (ties
by code point). A document's own profile is compared with each language's by the
out-of-place distance: the sum of rank differences, ``top`` for an absent
n-gram. The nearest language wins, the first in code-point order on a tie;
``score`` is its share of all languages' closeness.

Language profiles are fitted on about ``per_language`` labelled documents a
language (a documented bound: ids whose seeded hash lies under the share);
every document is scored on its whole text in a map. Profiles are broadcast:
``top`` rows a language.

A null text, or one without a letter, is ``und`` with score 0; with no labelled
row every text is ``und``. Repeated rows repeat their result; null ids are kept.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evenline.session import ship_package

TOP = 300
GRAM = 3
PER_LANGUAGE = 600
BLOCK_CHARS = 1 << 20
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point -> lower-case letter, or 0."""
    if not _FOLD:
        t = np.zeros(sys.maxunicode + 1, np.uint32)
        for c in range(sys.maxunicode + 1):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(t)
    return _FOLD[0]


def _rank_blocks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of texts ``first, n, letters, doc, gram, count``: the n-grams of
    every document, most frequent first. A gram is up to three 21-bit symbols."""
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= BLOCK_CHARS):
            size += len(texts[b]) + 1
            b += 1
        cps = np.frombuffer("\n".join(texts[a:b]).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = _fold()[cps]
        n = b - a
        end = np.cumsum([len(t) + 1 for t in texts[a:b]])
        doc = np.repeat(np.arange(n), np.diff(np.concatenate(([0], end))))[:len(letters)]
        has = np.bincount(doc, letters > 0, n).astype(np.int64)
        # one space between words, none where a document has only a gap
        gap = letters == 0
        keep = ~gap | np.concatenate(([True], ~gap[:-1] | (doc[1:] != doc[:-1])))[:len(gap)]
        letters, doc = letters[keep], doc[keep]
        names, code = np.unique(letters, return_inverse=True)
        if len(names) and names[0]:
            code = code + 1
            names = np.concatenate(([0], names))
        code = code.astype(np.uint64)  # 0 is the space
        bits = max(1, int(len(names)).bit_length())
        keys = []
        for k in range(1, GRAM + 1):
            m = len(code) - k + 1
            if m <= 0:
                continue
            g = np.zeros(m, np.uint64)
            for j in range(k):
                g = (g << np.uint64(bits)) | (code[j:j + m] + np.uint64(1))
            ok = doc[:m] == doc[k - 1:]
            if k == 1:
                ok &= code > 0
            keys.append((doc[:m][ok], g[ok]))
        gram_bits = bits * GRAM
        d = np.concatenate([x for x, _ in keys]) if keys else np.zeros(0, np.int64)
        g = np.concatenate([x for _, x in keys]) if keys else np.zeros(0, np.uint64)
        if gram_bits + n.bit_length() <= 64:
            both = np.sort((d.astype(np.uint64) << np.uint64(gram_bits)) | g)
            first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(both)))
            both = both[first]
            d, g = (both >> np.uint64(gram_bits)).astype(np.int64), both & np.uint64((1 << gram_bits) - 1)
        else:
            o = np.lexsort((g, d))
            d, g = d[o], g[o]
            first = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])))) if len(g) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(g)))
            d, g = d[first], g[first]
        yield a, n, has, d, _decode(g, bits, names), count
        a = b


def _decode(g: np.ndarray, bits: int, names: np.ndarray) -> np.ndarray:
    """Block codes to grams that do not depend on the block: 21 bits a symbol, 1 for the space."""
    out = np.zeros(len(g), np.uint64)
    for j in reversed(range(GRAM)):
        c = (g >> np.uint64(bits * j)) & np.uint64((1 << bits) - 1)
        cp = names[np.maximum(c, 1).astype(np.int64) - 1].astype(np.uint64)
        out = (out << np.uint64(21)) | np.where(c > 0, cp + np.uint64(1), np.uint64(0))
    return out


def _top(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc, gram, rank`` of each document's first ``top`` grams (already by gram inside a document)."""
    peak = int(count.max()) if len(count) else 0
    cut = np.zeros(n, np.int64)
    width = int(np.bincount(doc, minlength=n).max()) if len(doc) else 0
    lead = np.searchsorted(doc, np.arange(n), "left")
    inner = np.arange(len(doc)) - lead[doc]
    pb, wb = max(1, peak.bit_length()), max(1, width.bit_length())
    if pb + wb + n.bit_length() <= 63:
        key = np.sort((doc << (pb + wb)) | ((peak - count) << wb) | inner)
        doc, inner = key >> (pb + wb), key & ((1 << wb) - 1)
        gram = gram[lead[doc] + inner]
    else:
        o = np.lexsort((inner, -count, doc))
        doc, gram = doc[o], gram[o]
    rank = np.arange(len(doc)) - lead[doc]
    ok = rank < top
    return doc[ok], gram[ok], rank[ok]


def fit_profiles(docs: DataFrame, per_language: int = PER_LANGUAGE, top: int = TOP, seed: int = 23) -> DataFrame:
    """``lang, gram, rank`` from ``docs`` (``doc_id, text, lang``), restricted to training rows by the caller."""
    ship_package(docs.sparkSession)
    known = docs.where("lang is not null and text is not null")
    size = known.groupBy("lang").agg(F.count("*").alias("n"))
    unit = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    picked = known.join(F.broadcast(size), "lang").where(unit < F.lit(float(per_language)) / F.col("n")).select("lang", "text")

    def grams(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, _, _, d, g, c in _rank_blocks(batch.column("text").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(langs[first + d].tolist(), pa.string()), pa.array(g.astype(np.int64)), pa.array(c.astype(np.int64))], ["lang", "gram", "n"])
    counted = picked.mapInArrow(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counted.withColumn("rank", rank - 1).where(F.col("rank") < top).select("lang", "gram", "rank")


def predict_language(docs: DataFrame, profiles: DataFrame, top: int = TOP) -> DataFrame:
    """``doc_id, lang_pred, score`` per row of ``docs`` (``doc_id, text``)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = profiles.collect()  # at most ``top`` a language
    langs = sorted({r["lang"] for r in rows})
    names = np.unique(np.array([r["gram"] for r in rows], np.uint64))
    ranks = np.full((len(langs), len(names) + 1), -1, np.int64)
    for r in rows:
        ranks[langs.index(r["lang"]), np.searchsorted(names, np.uint64(r["gram"]))] = r["rank"]
    held = spark.sparkContext.broadcast((langs, names, ranks))

    def run(batches):
        langs, names, ranks = held.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            pred, score = [], []
            for _, n, has, d, g, c in _rank_blocks(texts):
                if not langs:
                    pred += ["und"] * n
                    score += [0.0] * n
                    continue
                d, g, r = _top(d, g, c, n, top)
                at = np.minimum(np.searchsorted(names, g), len(names) - 1)
                at = np.where(names[at] == g, at, len(names))
                far = np.stack([np.bincount(d, np.where(x[at] >= 0, np.abs(x[at] - r), top), n) for x in ranks], 1)
                near = 1 - far / np.maximum(1, top * np.bincount(d, minlength=n))[:, None]
                best = far.argmin(1)
                share = near[np.arange(n), best] / np.maximum(near.sum(1), 1e-12)
                for k in range(n):
                    pred.append(langs[best[k]] if has[k] else "und")
                    score.append(float(min(1.0, share[k])) if has[k] else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
