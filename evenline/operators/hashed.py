"""Scoring without a join (A18, A19, A25): hashed class weights inside the row.

A term is the first ``KEY_BITS`` bits of its md5, its bucket the first ``bits`` of those.
Each bucket keeps its most frequent training term, so a scorer is a fixed number of
slots, whatever the vocabulary: an array of term keys and, per task and class, one of
weights. Their size is known before any data is read. The arrays travel in the plan as
literals, and a row's score is the sum of the weights of its distinct terms that have a
slot. Scoring therefore adds columns in a map: no explode, no join, no shuffle, and the
text stays where it is. It runs the same on a stream.

The model is naive Bayes on term presence, as :mod:`evenline.operators.naive_bayes`,
over the terms with a slot and a document frequency of at least ``min_df`` among the
task's rows. Weights are differences from the first class in millionths, as whole
numbers, so sums do not depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import distinct_tokens, is_blank
from evenline.guards import MAX_CLASSES, bounded_collect

# Nine hex digits of md5 a term, weights in millionths.
KEY_DIGITS = 9
KEY_BITS = 4 * KEY_DIGITS
UNIT = 1_000_000
BITS = 17
MIN_DF = 5
MAX_SLOTS = 1 << 22  # longs of all arrays: 32 MB


def term_keys(text: str) -> Column:
    """Keys of the distinct terms of a text; none for null and blank texts."""
    # hashed once per distinct word: the hash costs more than finding the word
    keys = F.transform(distinct_tokens(text), lambda w: F.conv(F.substring(F.md5(w), 1, KEY_DIGITS), 16, 10).cast("bigint"))
    return F.coalesce(F.array_distinct(keys), F.array().cast("array<bigint>"))


@dataclass
class HashedModel:
    """One task: ``priors`` in millionths (0 for the first class), and per further class a weight per slot."""
    name: str
    classes: list[str]
    priors: list[int]
    weights: list[list[int]]
    n_terms: int
    n_train: int


@dataclass
class HashedScorer:
    """Models over the same slots; ``keys`` has the key of each slot's term, -1 for an empty slot."""
    bits: int
    keys: list[int]
    models: list[HashedModel]


def _millionths(x: float) -> int:
    return int(math.floor(abs(x) * UNIT + 0.5)) * (1 if x >= 0 else -1)


def _slot(key: Column, bits: int) -> Column:
    return F.shiftright(key, KEY_BITS - bits).cast("int")


def fit_hashed(train: DataFrame, labels: Mapping[str, str], text: str = "text", bits: int = BITS, min_df: int = MIN_DF,
               max_classes: int = MAX_CLASSES) -> HashedScorer:
    """A model per task over the rows of ``train`` that carry its label (``labels``: task to label column).

    One aggregate counts the documents of every (term, task, class), a second keeps each slot's most frequent
    term (the smallest key on a tie): at most ``2 ** bits`` rows reach the driver. Blank texts train nothing."""
    tasks = list(labels)
    rows = train.where(~is_blank(text)).select(term_keys(text).alias("k"), *[F.col(labels[t]).cast("string").alias(f"y{j}") for j, t in enumerate(tasks)])
    pairs = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"y{j}").alias("y")) for j in range(len(tasks))]))
    got = bounded_collect(rows.select(pairs.alias("e")).where("e.y is not null").groupBy("e.j", "e.y").count(), max_classes * len(tasks))
    if got is None:
        raise ValueError(f"more than {max_classes} classes a task")
    sizes = [{r["y"]: r["count"] for r in got if r["j"] == j} for j in range(len(tasks))]
    classes = [sorted(s) for s in sizes]
    for t, c in zip(tasks, classes):
        if not c:
            raise ValueError(f"task {t} has no labelled rows")
    if (1 + sum(len(c) - 1 for c in classes)) << bits > MAX_SLOTS:
        raise ValueError(f"{sum(map(len, classes))} classes by {1 << bits} slots are more than {MAX_SLOTS} numbers; take fewer bits")
    names = [f"n{j}_{i}" for j in range(len(tasks)) for i in range(len(classes[j]))]
    counts = rows.select("*", F.explode("k").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("df"), *[
        F.count_if(F.col(f"y{j}") == F.lit(c)).alias(f"n{j}_{i}") for j in range(len(tasks)) for i, c in enumerate(classes[j])]).where(F.col("df") >= min_df)
    best = F.max(F.struct("df", (-F.col("key")).alias("k"), *names)).alias("t")
    slots = counts.groupBy(_slot(F.col("key"), bits).alias("slot")).agg(best).select("slot", (-F.col("t.k")).alias("key"), *[f"t.{n}" for n in names]).collect()
    keys = [-1] * (1 << bits)
    for r in slots:
        keys[r["slot"]] = r["key"]
    models = []
    for j, t in enumerate(tasks):
        n = range(len(classes[j]))
        kept = [(r["slot"], [r[f"n{j}_{i}"] for i in n]) for r in slots]
        kept = [(s, c) for s, c in kept if sum(c) >= min_df]
        total = [sum(c[i] for _, c in kept) + len(kept) for i in n]
        weights = [[0] * (1 << bits) for _ in n[1:]]
        for s, c in kept:
            first = math.log((c[0] + 1) / total[0])
            for i in n[1:]:
                weights[i - 1][s] = _millionths(math.log((c[i] + 1) / total[i]) - first)
        size = [sizes[j][c] for c in classes[j]]
        models.append(HashedModel(t, classes[j], [_millionths(math.log(s / size[0])) for s in size], weights, len(kept), sum(size)))
    return HashedScorer(bits, keys, models)


def _literal(values: list[int]) -> Column:
    """An array literal; the optimizer folds the split and the cast once, on the driver."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def score_hashed(df: DataFrame, scorer: HashedScorer, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with, per model, ``{prefix}{name}_label``, ``_conf``, ``_probs`` and, for two classes, ``_s`` (the logit of
    the second class). A map over the rows: all columns stay; the added names must be free. Null or blank texts get
    nulls. Ties go to the first class."""
    models, taken = scorer.models, set(df.columns)
    added = [f"{prefix}{m.name}_{x}" for m in models for x in ("label", "conf", "probs", *(["s"] if len(m.classes) == 2 else []))]
    if clash := taken & set(added):
        raise ValueError(f"columns {sorted(clash)} exist already; choose another prefix")

    def free(name: str) -> str:
        while name in taken:
            name += "_"
        return name
    slots, logits = free("_slots"), {m.name: free(f"_{m.name}_logits") for m in models}
    known = F.filter(term_keys(text), _has_slot(_literal(scorer.keys), scorer.bits))
    out = df.select("*", F.transform(known, lambda k: _slot(k, scorer.bits)).alias(slots))
    out = out.select("*", *[F.when(~is_blank(text), F.array(F.lit(m.priors[0]).cast("bigint"), *[
        F.aggregate(slots, F.lit(p).cast("bigint"), _add(_literal(w))) for p, w in zip(m.priors[1:], m.weights)])).alias(logits[m.name]) for m in models])
    cols = []
    for m in models:
        name, x = f"{prefix}{m.name}", F.col(logits[m.name])
        top = F.array_max(x)
        total = F.aggregate(x, F.lit(0.0), _add_exp(top))
        cols += [F.when(x.isNotNull(), F.element_at(F.array(*map(F.lit, m.classes)), F.array_position(x, top).cast("int"))).alias(f"{name}_label"),
                 (1.0 / total).alias(f"{name}_conf"), F.transform(x, _share(top, total)).alias(f"{name}_probs")]
        if len(m.classes) == 2:
            cols.append((F.element_at(x, 2) / UNIT).alias(f"{name}_s"))
    return out.select(*df.columns, *cols)


# lambdas of one or two arguments alone: a default argument would be taken for the element's index

def _has_slot(keys: Column, bits: int):
    return lambda k: F.get(keys, _slot(k, bits)) == k


def _add(weights: Column):
    return lambda s, b: s + F.get(weights, b)


def _add_exp(top: Column):
    return lambda s, v: s + F.exp((v - top) / UNIT)


def _share(top: Column, total: Column):
    return lambda v: F.exp((v - top) / UNIT) / total


def rescore_hashed(df: DataFrame, scorer: HashedScorer, before: str = "text", after: str = "neutral") -> DataFrame:
    """A25 in a map: every model on the original (``before_*``) and on the rewrite (``after_*``)."""
    return score_hashed(score_hashed(df, scorer, before, "before_"), scorer, after, "after_")
