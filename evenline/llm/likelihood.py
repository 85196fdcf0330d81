"""Operator 7, language-model scoring by subword lattice likelihood.

A word's probability sums over all its segmentations into pieces of an existing
vocabulary (log-space forward recursion, ``pieces.Lattice``). The vocabulary's
scores are the first weights; frequent training words (at most ``MAX_ARCS``)
join it as pieces that may only start a word. ``EM_STEPS`` rounds of
expectation-maximisation over all distinct training words re-estimate the
weights; the last round splits them by the class of the training text (its
language, at most ``MAX_CLASSES``; the rest is one class). Every training word
also adds one arc over the whole word, weighed by its counts. A text's
probability is marginal over classes too, whose priors are their shares of the
training documents:

    P(text) = sum_k prior_k prod_w ((1 - g) (A c_k(w)/N_k + (1 - A) c(w)/N) + g lattice_k(w))

with one end after the words, counted as a token, and ``g`` the share of
training tokens seen once (Good and Turing's mass of unseen words).
``base_score`` is the add-one unigram score. Neither class nor any column but
the text enters a score.

At scale: word counts are one aggregate of distinct words per block; lattice
probabilities are computed once per distinct word. The most frequent words (at
most ``MAX_FREQUENT``, by a count threshold) are broadcast and summed in the
map; only rarer occurrences are shuffled to the word table.

Null and blank texts hold the end alone. Repeated rows are counted and scored
each; null ids are kept. Without training rows every word has its lattice
probability under the vocabulary's own scores, and N is 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.llm.pieces import LONG, HashTable, Lattice, load_pieces
from evenline.llm.spool import spool
from evenline.llm.words import blocks
from evenline.session import ship_package

A = 0.9
UNSEEN = (1e-4, 0.5)  # bounds of g
EM_STEPS = 2
MAX_ARCS = 60_000
MIN_ARC = 5           # occurrences from which a word may be a piece; pieces learn from the rarer ones
PRIOR_USES = 200.0    # weight of the shared distribution in a class's piece weights
MAX_CLASSES = 8
MAX_FREQUENT = 160_000
SMOOTH = 0.01   # pseudo-uses of a piece


def _count_words(n_classes: int):
    """``word`` and its occurrences per class; class -1 (not for training) counts nothing."""
    def run(batches):
        for batch in batches:
            classes = batch.column("class").to_numpy()
            for b in blocks(batch.column("text"), lower=True):
                h = b.hashes()
                if not len(h):
                    continue
                _, first, inv = np.unique(h, return_index=True, return_inverse=True)
                k = classes[b.first + b.doc]
                use = k >= 0
                table = np.bincount(inv[use] * n_classes + k[use], minlength=len(first) * n_classes).reshape(-1, n_classes)
                raw = b.data.tobytes()
                words = [raw[s:e] for s, e in zip(b.start[first].tolist(), b.end[first].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary())] + [pa.array(table[:, c]) for c in range(n_classes)], ["word"] + [f"c{c}" for c in range(n_classes)])
    return run


def _gather(batches, rows: int = 60_000):
    """Batches joined to about ``rows`` rows: words of one length are one matrix, so few rows waste it."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _expect(held, columns: list[str]):
    def run(batches):
        names, weights = held.value
        lattice, total = Lattice(names, weights), np.zeros((len(names), len(columns)))
        for batch in _gather(batches):
            total += lattice.expected_counts(batch.column("word").to_pylist(), np.stack([batch.column(c).to_numpy() for c in columns], 1))
        at, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(c), pa.array(total[at, c])], ["piece", "class", "uses"])
    return run


def _lattice_of(held, n_classes: int):
    def run(batches):
        names, weights = held.value
        lattice = Lattice(names, weights)
        for batch in _gather(batches):
            p = lattice.log_probability(batch.column("word").to_pylist())
            p = np.broadcast_to(p, (len(p), n_classes))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(np.ascontiguousarray(p[:, k])) for k in range(n_classes)]], [*batch.schema.names, *[f"l{k}" for k in range(n_classes)]])
    return run


def _threshold(words: DataFrame, most: int, steps: int = 4096) -> int:
    """The least count whose words, with all more frequent ones, are ``most`` at most: the range of counts is cut into
    ``steps`` parts, and the part in which the words become too many is cut again."""
    low, high = 1, (words.agg(F.max("n")).first()[0] or 0) + 1
    have = 0  # words with a count of `high` and more
    while low < high:
        step = -(-(high - low) // steps)
        part = F.floor((F.col("n") - low) / step).cast("long")
        sizes = {r["b"]: r["c"] for r in words.where((F.col("n") >= low) & (F.col("n") < high)).groupBy(part.alias("b")).agg(F.count("*").alias("c")).collect()}
        for b in sorted(sizes, reverse=True):
            if have + sizes[b] > most:
                break
            have += sizes[b]
        else:
            return low
        low, high = low + b * step, min(high, low + (b + 1) * step)
        if step == 1:
            return high
    return low


def _frequent_pass(held, n_classes: int):
    """Per document the sums over frequent words (and the end), and a row for every rarer word."""
    def run(batches):
        import pyspark
        keys, logs, base, end_logs, end_base, end_known = held.value
        table = HashTable(keys)
        task, serial = pyspark.TaskContext.get().partitionId(), 0
        names = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "logs", "word"]
        for batch in batches:
            for b in blocks(batch.column("text"), lower=True):
                at = table.find(b.hashes())
                hit = np.flatnonzero(at >= 0)
                d, w, n = b.doc[hit], at[hit], b.n_docs
                sums = [np.bincount(d, logs[w, k], n) + end_logs[k] for k in range(n_classes)]
                known = np.bincount(d, minlength=n) + int(end_known)
                rid = (task << 36) + serial + np.arange(n)
                serial += n
                yield pa.RecordBatch.from_arrays([pa.array(rid), batch.column("doc_id").slice(b.first, n), batch.column("held_out").slice(b.first, n), pa.array(b.n_words + 1), pa.array(known),
                                                  pa.array(np.bincount(d, base[w], n) + end_base), pa.array(np.stack(sums, 1).tolist(), pa.list_(pa.float64())), pa.nulls(n, pa.binary())], names)
                rare = np.flatnonzero(at < 0)
                raw, m = b.data.tobytes(), len(rare)
                if m:
                    words = [raw[s:e] for s, e in zip(b.start[rare].tolist(), b.end[rare].tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(rid[b.doc[rare]]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()),
                                                      pa.nulls(m, pa.list_(pa.float64())), pa.array(words, pa.binary())], names)
    return run


def score_texts(docs: DataFrame, train: Column, model_file: str, class_col: str = "lang", em_steps: int = EM_STEPS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of
    ``docs`` (``doc_id, text`` and ``class_col``); rows where ``train`` is true are learned from."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.col(class_col).cast("string").alias("cls"), F.coalesce(train, F.lit(False)).alias("train"))
    top = docs.where("train").groupBy("cls").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cls").limit(MAX_CLASSES - 1).collect()
    n_train = docs.where("train").count()
    classes = [r["cls"] for r in top]
    sizes = [r["n"] for r in top]
    if n_train > sum(sizes) or not sizes:
        sizes.append(n_train - sum(sizes))
    k_all = len(sizes)
    which = F.lit(k_all - 1)
    for k, c in enumerate(classes):
        which = F.when(F.col("cls").eqNullSafe(F.lit(c)), k).otherwise(which)
    which = F.when(F.col("train"), which).otherwise(-1)
    cs = [f"c{k}" for k in range(k_all)]
    counted = docs.select("text", which.cast("long").alias("class")).mapInArrow(_count_words(k_all), "word binary, " + ", ".join(f"{c} long" for c in cs))
    counted = spool(counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in cs]).withColumn("n", sum((F.col(c) for c in cs[1:]), F.col(cs[0]))), "counts")
    totals = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cs], F.count_if(F.col("n") > 0).alias("v"), F.count_if(F.col("n") == 1).alias("v1")).first()
    tokens = [int(totals[c]) + sizes[k] for k, c in enumerate(cs)]
    n_all = sum(tokens)
    v_all = int(totals["v"]) + (n_train > 0)

    names, weights = load_pieces(model_file)
    weights = weights - np.logaddexp.reduce(weights)
    if n_all:
        arcs = counted.where((F.col("n") >= max(MIN_ARC, _threshold(counted, MAX_ARCS))) & (F.length("word") < LONG)).select("word", "n").toPandas()  # at most MAX_ARCS rows
        have = set(names)
        arcs = sorted((b" " + bytes(w), n) for w, n in zip(arcs["word"], arcs["n"]) if b" " + bytes(w) not in have)
        names = names + [w for w, _ in arcs]
        weights = np.concatenate((weights, np.log(np.array([n for _, n in arcs], float) / n_all)))
        weights = weights - np.logaddexp.reduce(weights)
    for step in range(em_steps if n_all else 0):
        columns = ["n"] if step + 1 < em_steps else cs
        uses = counted.where("n > 0").mapInArrow(_expect(spark.sparkContext.broadcast((names, weights)), columns), "piece long, class long, uses double")
        total = np.zeros((len(names), len(columns)))
        for r in uses.groupBy("piece", "class").agg(F.sum("uses").alias("uses")).collect():  # a row a piece and class at most
            total[r["piece"], r["class"]] = r["uses"]
        shared = total.sum(1) + SMOOTH
        shared /= shared.sum()
        total += PRIOR_USES * shared[:, None]
        weights = np.log(shared if len(columns) == 1 else total / total.sum(0))
    lattice = counted.mapInArrow(_lattice_of(spark.sparkContext.broadcast((names, weights)), k_all),
                                 "word binary, " + ", ".join(f"{c} long" for c in cs) + ", n long, " + ", ".join(f"l{k} double" for k in range(k_all)))
    log10 = math.log(10)
    g = min(max(int(totals["v1"]) / n_all, UNSEEN[0]), UNSEEN[1]) if n_all else 1.0
    a, b = (1 - g) * A, (1 - g) * (1 - A)

    def mixed(k: int) -> Column:
        rest = F.lit(math.log(g)) + F.col(f"l{k}")
        p = F.lit(0.0)
        if n_all:
            p = F.lit(b) * F.col("n") / F.lit(float(n_all)) + (F.lit(a) * F.col(cs[k]) / F.lit(float(tokens[k])) if tokens[k] else F.lit(0.0))
        # log(p + exp(rest)) without leaving log space when the whole-word arc is absent
        return F.when(p > 0, F.log(p) + F.log1p(F.exp(rest - F.log(p)))).otherwise(rest) / F.lit(log10)
    base = F.log10((F.col("n") + F.lit(1.0)) / F.lit(float(n_all + v_all + 1)))
    words = spool(lattice.select("word", "n", (F.col("n") > 0).cast("long").alias("known"), base.alias("base"), *[mixed(k).alias(f"p{k}") for k in range(k_all)]), "words")

    least = _threshold(words, MAX_FREQUENT)
    frequent = words.where(F.col("n") >= least).toPandas()  # at most MAX_FREQUENT rows
    if len(frequent):
        one = list(blocks(pa.array([b"\n".join(bytes(w) for w in frequent["word"])], pa.binary())))
        keys = one[0].hashes()
    else:
        keys = np.zeros(0, np.uint64)
    logs = frequent[[f"p{k}" for k in range(k_all)]].to_numpy(float).reshape(-1, k_all)
    end_share = [(a * (sizes[k] / tokens[k]) if tokens[k] else 0.0) + b * (n_train / n_all if n_all else 0.0) for k in range(k_all)]
    end_logs = [math.log10(max(p + (g if not n_all else 0.0), 1e-300)) for p in end_share]
    end_base = math.log10((n_train + 1) / (n_all + v_all + 1))
    held = spark.sparkContext.broadcast((keys, logs, frequent["base"].to_numpy(float), end_logs, end_base, n_train > 0))
    del frequent, keys, logs
    first = spool(docs.select("doc_id", "text", (~F.col("train")).alias("held_out")).mapInArrow(
        _frequent_pass(held, k_all), "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, logs array<double>, word binary"), "scored")
    rare = first.where("word is not null").select("rid", "word").join(words.where(F.col("n") < least), "word")
    rare = rare.groupBy("rid").agg(F.sum("known").alias("known"), F.sum("base").alias("more_base"), *[F.sum(f"p{k}").alias(f"s{k}") for k in range(k_all)])
    out = first.where("word is null").join(rare, "rid", "left")
    total_prior = sum(sizes)
    logs_k = [F.col("logs")[k] + F.coalesce(f"s{k}", F.lit(0.0)) + F.lit(math.log10(sizes[k] / total_prior)) for k in range(k_all) if total_prior and sizes[k]]
    if not logs_k:
        logs_k = [F.col("logs")[0] + F.coalesce("s0", F.lit(0.0))]
    peak = F.greatest(*logs_k) if len(logs_k) > 1 else logs_k[0]
    score = peak + F.log10(sum((F.pow(F.lit(10.0), x - peak) for x in logs_k[1:]), F.pow(F.lit(10.0), logs_k[0] - peak)))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), score.alias("score"))
