"""Exact naive Bayes scores in the row (A18, A19, A25): the weights of a bounded
model travel in the plan, so scoring is a map that keeps the text in its row.

Terms are found by two-choice hashing: a term's key is the first 60 bits of its md5,
and it sits in one of the two slots that its key names, so a look-up reads at most two
array cells. :func:`score_rows` takes this way for models of at most ``MAX_NUMBERS``
weights and slots and otherwise scores narrow rows by :func:`evenline.operators.naive_bayes.nb_scores`
and joins the results back by a row number, so that in neither way a text is a key of
an explode, an aggregate or a join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import distinct_tokens, is_blank
from evenline.operators.naive_bayes import ModelSet, finish, nb_scores
from evenline.session import ensure_checkpoint_dir

# Fifteen hex digits of md5 a term; bits of a key that name its two slots.
KEY_DIGITS = 15
SECOND = 30
MAX_NUMBERS = 1 << 20  # weights of all classes and slots, for every text: they are boxed in the plan, some 30 bytes each on the driver and in every task
SLOTS = 8              # numbers of the slots of a term: two arrays of at most five slots a term, most often fewer


@dataclass
class InlineModels:
    """``keys`` and ``index`` per slot (-1: empty); ``weights`` per model and class, one per term."""
    keys: list[int]
    index: list[int]
    weights: list[list[list[float]]]


def place(keys: list[int]) -> list[int]:
    """Slots of distinct keys, each in one of its two places: a key that finds its place taken moves the other one on."""
    size = 16
    while size < 2.5 * len(keys):
        size *= 2
    while True:
        slots = [-1] * size
        for n in range(len(keys)):
            k, last = n, -1
            for _ in range(500):
                two = (keys[k] & (size - 1), keys[k] >> SECOND & (size - 1))
                at = next((s for s in two if slots[s] < 0), two[0] if two[0] != last else two[1])
                slots[at], k, last = k, slots[at], at
                if k < 0:
                    break
            else:
                break
        else:
            return slots
        size *= 2


def inline_models(models: ModelSet, most: int = MAX_NUMBERS, texts: int = 1) -> InlineModels | None:
    """The weights of ``models`` for :func:`inline_scores`, or None if these and their slots, once per text, are more
    than ``most`` numbers (counted before anything reaches the driver)."""
    classes = sum(m.k for m in models)
    if sum(m.n_terms for m in models) * (classes + SLOTS) * texts > most:
        return None
    cached = getattr(models, "_inline", None)
    if cached is None:
        key = F.conv(F.substring(F.md5("term"), 1, KEY_DIGITS), 16, 10).cast("bigint")
        cols = [f"_m{j}_w{c}" for j, m in enumerate(models) for c in range(m.k)]
        w = models.weights if len(models) > 1 else models.weights.select("term", *[F.col(c) for c in cols])
        rows = w.select(key.alias("key"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in cols]).toPandas()
        slots = place(rows["key"].tolist())
        keys = rows["key"].tolist()
        cached = InlineModels([keys[n] if n >= 0 else -1 for n in slots], slots, [[rows[f"_m{j}_w{c}"].tolist() for c in range(m.k)] for j, m in enumerate(models)])
        models._inline = cached
    return cached


def _literal(values: list, kind: str) -> Column:
    """An array literal; the optimizer folds the split and the cast once, on the driver."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _find(im: InlineModels):
    keys, index, mask = _literal(im.keys, "bigint"), _literal(im.index, "int"), len(im.keys) - 1

    def find(k: Column) -> Column:
        one, two = k.bitwiseAND(F.lit(mask)).cast("int"), F.shiftright(k, SECOND).bitwiseAND(F.lit(mask)).cast("int")
        return F.when(F.get(keys, one) == k, F.get(index, one)).when(F.get(keys, two) == k, F.get(index, two))
    return find


def _add(weights: Column):
    return lambda s, i: s + F.get(weights, i)


def _free(taken: set[str], name: str) -> str:
    while name in taken:
        name += "_"
    taken.add(name)
    return name


def inline_scores(df: DataFrame, texts: Mapping[str, str], models: ModelSet, im: InlineModels, reuse: Mapping[str, str] | None = None, tokenised: bool = False) -> DataFrame:
    """``df`` with the columns of ``nb_scores`` (``{tag_}{model}_logp, _probs, _label, _conf, _s``) for every text of
    ``texts`` (tag to column); a map that keeps all columns, whose added names must be free. ``reuse`` names tags whose
    text often equals an earlier tag's. With ``tokenised`` the columns of ``texts`` hold the distinct tokens (null for a
    blank text)."""
    taken, reuse = set(df.columns), dict(reuse or {})
    prefixes = {(t, m.name): f"{t}_{m.name}" if t else m.name for t in texts for m in models}
    if clash := taken & {f"{p}_{x}" for p in prefixes.values() for x in ("logp", "probs", "label", "conf", "s")}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    terms, find = {}, _find(im)
    out = df
    for t, text in texts.items():
        keys = F.array_distinct(F.transform(F.col(text) if tokenised else distinct_tokens(text), lambda w: F.conv(F.substring(F.md5(w), 1, KEY_DIGITS), 16, 10).cast("bigint")))
        known = F.filter(F.transform(keys, find), lambda i: i.isNotNull())
        if t in reuse:
            known = F.when(F.col(text).eqNullSafe(F.col(texts[reuse[t]])), F.col(terms[reuse[t]])).otherwise(known)
        terms[t] = _free(taken, f"_terms_{t}")
        out = out.withColumn(terms[t], known)
    logps = []
    for t, text in texts.items():
        for j, m in enumerate(models):
            sums = [F.aggregate(terms[t], F.lit(0.0), _add(_literal(im.weights[j][c], "double"))) for c in range(m.k)]
            logp = F.array(*[F.lit(float(p)) + s for p, s in zip(m.priors, sums)])
            logps.append(F.when(F.col(text).isNotNull() if tokenised else ~is_blank(text), logp).alias(f"{prefixes[t, m.name]}_logp"))
    out = out.select("*", *logps).drop(*terms.values())
    for t in texts:
        for m in models:
            out = finish(out, prefixes[t, m.name], m.classes, m.temperature)
    return out


def score_rows(df: DataFrame, texts: Mapping[str, str], models: ModelSet, reuse: Mapping[str, str] | None = None, most: int = MAX_NUMBERS, row: str | None = None) -> DataFrame:
    """Every row of ``df`` with the scores of ``models`` on its texts, all columns kept: in the row if the weights are at
    most ``most``, else by narrow rows joined back on a row number that is written with the rows first. With ``row``, a
    column of a written table that tells its rows apart, ``texts`` hold the distinct tokens (null for a blank text), and
    the rows are joined back on it without being written again."""
    im = inline_models(models, most, len(texts))
    if im is not None:
        return inline_scores(df, texts, models, im, reuse, tokenised=row is not None)
    if row is not None:
        scored = nb_scores(df.select(row, *dict.fromkeys(texts.values())), row, dict(texts), models, reuse=reuse, tokenised=True, fixed=True)
        return df.join(scored, row, "left")
    taken = set(df.columns)
    rid = _free(taken, "_row")
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.withColumn(rid, F.monotonically_increasing_id()).checkpoint(eager=True)
    scored = nb_scores(rows.select(rid, *dict.fromkeys(texts.values())), rid, dict(texts), models, reuse=reuse)
    return rows.join(scored, rid, "left").drop(rid)
