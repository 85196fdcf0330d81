"""Operator 1, toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its
hashed features (every token, its first four and first five bytes); the document's is the noisy-or
``1 - prod(1 - p_s)``, fitted to document labels alone by Adam on the noisy-or
likelihood. The same weights then point at the offending sentences.

Fitting uses at most ``sample_rows`` labelled documents (a documented bound: the
smallest seeded hashes of their ids, half of the places kept for positives),
gathered in one task. The likelihood weighs each class by its share of all
training labels over its share of the sample, so a score means the same at every
size. Features enter the model if ``min_df`` sampled documents
hold them and their chi-square against the label reaches ``min_chi2``. Scoring
is a map over whole texts with the weights broadcast (``4 * 2 ** DIM_BITS`` bytes).

Null and blank texts have no sentence and score 0. Rows are scored one by one,
so repeated rows repeat their score; null ids are kept. Without a positive
training row every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.llm.words import blocks
from evenline.session import ship_package

SAMPLE_ROWS = 8_000
CHUNK = 1 << 19   # tokens that screening looks at at once
DIM_BITS = 20
MIN_DF = 4
MIN_CHI2 = 12.0
STEPS = 300
RATE = 0.1
L2 = 3e-5
_SPLIT = np.ones(256, bool)
_SPLIT[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


@dataclass
class ToxicityModel:
    weights: np.ndarray  # float32 per hashed feature
    bias: float
    n_sampled: int


def _bags(col, lower_split=_SPLIT):
    """Per block: the block, hashed features of every token (3 columns), and each token's sentence with the sentences' documents."""
    for b in blocks(col, lower=True, space=lower_split):
        n = len(b.start)
        keys = [b.hashes(1), b.hashes(2, np.minimum(b.end, b.start + 4)), b.hashes(3, np.minimum(b.end, b.start + 5))]
        feats = np.stack([(k >> np.uint64(64 - DIM_BITS)).astype(np.int32) for k in keys], 1) if n else np.zeros((0, 3), np.int32)
        marks = np.concatenate(([0], np.cumsum(_END[b.data])))
        at = marks[b.start] if n else np.zeros(0, np.int64)
        new = np.concatenate(([True], (at[1:] != at[:-1]) | (b.doc[1:] != b.doc[:-1]))) if n else np.zeros(0, bool)
        yield b, feats, np.cumsum(new) - 1, b.doc[new]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def fit_bags(feats: np.ndarray, sent: np.ndarray, sent_doc: np.ndarray, y: np.ndarray, weights: tuple[float, float] = (1.0, 1.0)) -> tuple[np.ndarray, float]:
    """Noisy-or maximum likelihood, documents weighed by ``weights`` of their class (negative, positive). ``feats`` (tokens x 3) belong to sentence ``sent``; sentence ``s`` to document ``sent_doc[s]``."""
    dim, n = 1 << DIM_BITS, len(y)
    w = np.zeros(dim, np.float32)
    if not y.any() or not len(feats):
        return w, -np.inf
    doc = sent_doc[sent]
    a, df = np.zeros(dim), np.zeros(dim, np.int64)
    lo = 0
    while lo < len(doc):  # whole documents at a time
        hi = int(np.searchsorted(doc, doc[min(lo + CHUNK, len(doc)) - 1], "right"))
        pair = np.unique(np.repeat(doc[lo:hi].astype(np.int64), 3) << DIM_BITS | feats[lo:hi].ravel())
        f = pair & (dim - 1)
        a += np.bincount(f, y[pair >> DIM_BITS], dim)
        df += np.bincount(f, minlength=dim)
        lo = hi
    pos = y.sum()
    e = df * pos / n
    chi2 = np.where(df > 0, (a - e) ** 2 * n / np.maximum(e * (n - df) * (1 - pos / n) / 1.0, 1e-9), 0) if pos < n else np.zeros(dim)
    keep = (df >= MIN_DF) & (chi2 >= MIN_CHI2)
    at = np.flatnonzero(keep[feats].ravel())
    names, col = np.unique(feats.ravel()[at], return_inverse=True)
    row = sent[at // 3]
    n_sent = len(sent_doc)
    theta = np.zeros(len(names) + 1)
    share = np.where(y > 0, weights[1], weights[0])
    theta[-1] = -np.log(max(1.0, share[sent_doc].sum() / max(1.0, pos * weights[1]))) - 1
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(row, theta[col], n_sent)
        total = np.bincount(sent_doc, _softplus(z), n)
        slope = np.where(y > 0, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-12), 1.0) * share / n
        gz = slope[sent_doc] / (1 + np.exp(np.minimum(-z, 50)))
        g = np.append(np.bincount(col, gz[row], len(names)) + L2 * theta[:-1], gz.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    w[names] = theta[:-1]
    return w, float(theta[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 17) -> ToxicityModel:
    """Fit on ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``), both restricted to training rows by the caller."""
    ship_package(docs.sparkSession)
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("_h", F.xxhash64(F.lit(seed), "doc_id"))
    every = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    half = sample_rows // 2
    picked = [r for y in (0, 1) for r in known.where(F.col("toxic") == y).orderBy("_h", "doc_id").limit(half).select("doc_id", "toxic").collect()]
    if not any(r["toxic"] for r in picked):
        return ToxicityModel(np.zeros(1 << DIM_BITS, np.float32), -np.inf, len(picked))
    took = {y: sum(r["toxic"] == y for r in picked) for y in every}
    weights = tuple(every[y] / sum(every.values()) * len(picked) / took[y] if took.get(y) else 1.0 for y in (0, 1))
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in picked], "doc_id long, toxic int")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("toxic", "doc_id", "text")

    def fit(batches):
        feats, sents, sent_docs, ys, n_sent, n_doc = [], [], [], [], 0, 0
        for batch in batches:
            ys.append(batch.column("toxic").to_numpy())
            for b, f, s, d in _bags(batch.column("text")):
                feats.append(f)
                sents.append((s + n_sent).astype(np.int32))
                sent_docs.append((d + n_doc + b.first).astype(np.int32))
                n_sent += len(d)
            n_doc += len(batch)
        w, bias = fit_bags(np.concatenate(feats), np.concatenate(sents), np.concatenate(sent_docs), np.concatenate(ys).astype(np.float64), weights) if feats else (np.zeros(1 << DIM_BITS, np.float32), -np.inf)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at].astype(float), bias))], ["feature", "weight"])

    out = rows.repartition(1).sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(fit, "feature long, weight double").collect()
    w = np.zeros(1 << DIM_BITS, np.float32)
    bias = -np.inf
    for r in out:
        if r["feature"] < 0:
            bias = r["weight"]
        else:
            w[r["feature"]] = r["weight"]
    return ToxicityModel(w, bias, len(picked))


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float) -> DataFrame:
    """Rows of ``docs`` that score under ``threshold``, with all their columns; a map without a join."""
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast((model.weights, model.bias))
    names, text = docs.columns, docs.columns.index("text")

    def run(batches):
        w, bias = held.value
        for batch in batches:
            keep = []
            for b, f, s, d in _bags(batch.column(text)):
                soft = _softplus(bias + np.bincount(s, w[f].sum(1), len(d))) if np.isfinite(bias) and len(d) else np.zeros(len(d))
                keep.append(-np.expm1(-np.bincount(d, soft, b.n_docs)) < threshold)
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))
    numbered = docs.toDF(*[f"c{k}" for k in range(len(names))])  # any name can then come through, dots included
    return numbered.mapInArrow(run, numbered.schema).toDF(*names)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, n_sentences, worst`` per row; ``worst`` is the offending sentence's
    ``(start, length, p)`` in bytes of the text, null without sentences."""
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast((model.weights, model.bias))
    worst_t = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("p", pa.float64())])

    def run(batches):
        w, bias = held.value
        for batch in batches:
            score, n_sent, worst = [], [], []
            for b, f, s, d in _bags(batch.column("text")):
                z = bias + np.bincount(s, w[f].sum(1), len(d)) if len(d) else np.zeros(0)
                soft = _softplus(z) if np.isfinite(bias) else np.zeros(len(d))
                score.append(-np.expm1(-np.bincount(d, soft, b.n_docs)))
                n = np.bincount(d, minlength=b.n_docs)
                n_sent.append(n)
                lead = np.cumsum(n) - n
                first = np.searchsorted(s, np.arange(len(d)), "left")
                last = np.searchsorted(s, np.arange(len(d)), "right") - 1
                for k in range(b.n_docs):
                    if not n[k]:
                        worst.append(None)
                        continue
                    j = lead[k] + int(np.argmax(z[lead[k]:lead[k] + n[k]]))
                    lo, hi = int(b.start[first[j]]), int(b.end[last[j]])
                    worst.append({"start": lo - int(b.offsets[k]), "length": hi - lo, "p": float(-np.expm1(-soft[j]))})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(score) if score else np.zeros(0)), pa.array(np.concatenate(n_sent) if n_sent else np.zeros(0, np.int64)),
                                              pa.array(worst, worst_t)], ["doc_id", "score", "n_sentences", "worst"])
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, score double, n_sentences long, worst struct<start: long, length: long, p: double>")
