"""Multinomial naive Bayes on binary term presence (A8-A10 ``nb``, A18).

The reference fine-tunes transformers; those weights are not available, so the
shipped classifier is one a Spark job can train and score over any volume:

    logp(c | doc) = ln(N_c / N) + sum over distinct kept terms t in doc of
                    ln((n_{c,t} + alpha) / (T_c + alpha * V))

with ``n_{c,t}`` the train documents of class c holding t, ``V`` the kept
terms (document frequency >= ``min_df``) and ``T_c = sum_t n_{c,t}`` over kept
terms. Label = argmax (ties to the lower class index); probabilities = softmax
of ``logp / temperature``.

Training is two hash aggregates (class counts; per-term counts by class with a
map-side partial aggregate, so hot terms shuffle one row per partition). The
per-term counts are checkpointed to the shared checkpoint folder: the model is
computed once, survives executor loss, and has a known size before anyone
decides to broadcast it.

Scoring explodes each row's distinct tokens once for all texts and models,
joins the weights, and sums per row key (:func:`summed`). Weights are broadcast
when the checked row count is under ``max_broadcast``; beyond that the most
frequent terms are, which most tokens are and which are summed where the row is,
and only tokens of rare terms are shuffled to their weights. A rare term has few
tokens, so no task is hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import distinct_tokens, is_blank
from evenline.guards import KEY_BYTES, MAX_BROADCAST_BYTES, MAX_CLASSES, bounded_collect
from evenline.session import ensure_checkpoint_dir, written

MIN_DF = 5
ALPHA = 1.0
SALT_BUCKETS = 1  # parts that the tokens of a rare term are dealt to, each with its own copy of the weights


def frequent_part(weights: DataFrame, cols: Sequence[str], n_weights: int, most: int) -> tuple[DataFrame, DataFrame]:
    """``weights`` (logs of relative frequencies) in two parts: about ``most`` rows of the terms that are the most
    frequent in some class, and the others. Written first: their expressions would be planned again in every filter."""
    top = F.greatest(*cols) if len(cols) > 1 else F.col(cols[0])
    weights = written(weights.withColumn("_top", top), "weights")
    at = weights.agg(F.percentile_approx("_top", max(0.0, 1 - most / n_weights)).alias("at")).first()["at"]
    at = math.inf if at is None else float(at)
    return weights.where(F.col("_top") > F.lit(at)).drop("_top"), weights.where(F.col("_top") <= F.lit(at)).drop("_top")


def summed(rows: DataFrame, key: str, carry: Sequence[str], spread: Callable[[DataFrame, Callable], DataFrame], on: Sequence[str], weights: DataFrame,
           cols: Sequence[str], aggs: Mapping[str, Column], n_weights: int, row_bytes: int, max_broadcast: int = MAX_BROADCAST_BYTES,
           salt_buckets: int = SALT_BUCKETS, fixed: bool = False) -> DataFrame:
    """``key``, ``carry`` and the sums ``aggs`` (0 without terms) per row of ``rows``, over the ``weights`` of its terms.

    ``spread`` makes a row per term, with the columns ``on``, by the given explode function; ``n_weights`` bounds the rows
    of ``weights``, of ``row_bytes`` each. If they are more than ``max_broadcast``, half of that goes to the most frequent
    terms; unless its keys are ``fixed``, ``rows`` is written first, so that both parts see the same ones."""
    if n_weights * row_bytes <= max_broadcast:
        return spread(rows, F.explode_outer).join(F.broadcast(weights), on, "left").groupBy(key, *carry).agg(*[F.coalesce(a, F.lit(0.0)).alias(n) for n, a in aggs.items()])
    rows = rows if fixed else written(rows, "terms")
    frequent, rare = frequent_part(weights, cols, n_weights, max_broadcast // 2 // row_bytes)
    sums = spread(rows, F.explode_outer).join(F.broadcast(frequent), on, "left").groupBy(key, *carry).agg(*[F.coalesce(a, F.lit(0.0)).alias(n) for n, a in aggs.items()])
    others = spread(rows, F.explode).join(F.broadcast(frequent.select(*on)), on, "left_anti").drop(*carry)
    if salt_buckets > 1:
        on = [*on, "_salt"]
        others = others.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salt_buckets)).cast("int"))
        rare = rare.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    more = others.join(rare.hint("shuffle_hash"), on).groupBy(key).agg(*[F.coalesce(a, F.lit(0.0)).alias(f"{n}_rare") for n, a in aggs.items()])
    return sums.join(more, key, "left").select(key, *carry, *[(F.col(n) + F.coalesce(f"{n}_rare", F.lit(0.0))).alias(n) for n in aggs])


@dataclass
class NBModel:
    name: str
    classes: list[str]
    priors: list[float]
    weights: DataFrame          # term, w0 .. w{K-1}
    n_terms: int
    n_train: int
    class_counts: list[int] = field(default_factory=list)
    temperature: float = 1.0

    @property
    def k(self) -> int:
        return len(self.classes)

    @property
    def n_params(self) -> int:
        return self.n_terms * self.k + self.k


def fit_nb(train: DataFrame, name: str, text_col: str = "text", label_col: str = "label",
           min_df: int = MIN_DF, alpha: float = ALPHA, temperature: float = 1.0,
           max_classes: int = MAX_CLASSES, tokenised: bool = False) -> NBModel:
    """Fit on ``train`` (already restricted to the training split)."""
    return fit_nb_variants(train, [(name, None, min_df)], text_col, label_col, alpha, temperature,
                           max_classes, tokenised)[name]


def _any(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def fit_nb_variants(train: DataFrame, variants: Sequence[tuple],
                    text_col: str = "text", label_col: str = "label", alpha: float = ALPHA,
                    temperature: float = 1.0, max_classes: int = MAX_CLASSES, tokenised: bool = False) -> dict[str, NBModel]:
    """Several models from one pass over ``train``: each variant is
    ``(name, row subset or None for all rows, min_df[, label column])``.

    The text is tokenized and exploded once; per-term counts of every
    (variant, class) come from one hash aggregate of conditional counts (no
    explode per variant), checkpointed once. Each variant then keeps its own
    terms (``df >= min_df`` among its rows). Nested training shares (A13),
    ``min_df`` candidates (A12) and the three task models (different label
    columns over the same documents) each cost one aggregation, not one per model.
    A variant's classes are its label's values over all train rows; a class
    absent from its subset gets a -inf prior (probability 0). With ``tokenised``
    the text column holds the distinct tokens instead (null for a blank text).
    """
    specs = []
    for v in variants:
        name, sub, md = v[0], v[1], v[2]
        lab = v[3] if len(v) > 3 else label_col
        specs.append((name, F.lit(True) if sub is None else sub, md, lab))
    nv = len(specs)
    blank = F.col(text_col).isNull() if tokenised else is_blank(text_col)
    ok = [(~blank & F.col(lab).isNotNull()) for _, _, _, lab in specs]
    docs = (train.where(_any(ok))
                 .select((F.col(text_col) if tokenised else distinct_tokens(text_col)).alias("_t"),
                         *[F.col(lab).cast("string").alias(f"_y{v}") for v, (_, _, _, lab) in enumerate(specs)],
                         *[o.alias(f"_ok{v}") for v, o in enumerate(ok)],
                         *[(o & sub).alias(f"_in{v}") for v, (o, (_, sub, _, _)) in enumerate(zip(ok, specs))]))
    pairs = F.array(*[F.when(F.col(f"_ok{v}"), F.struct(F.lit(v).alias("v"), F.col(f"_y{v}").alias("y"),
                                                        F.col(f"_in{v}").alias("i")))
                      for v in range(nv)])
    cc = (docs.select(F.explode(pairs).alias("e")).where(F.col("e").isNotNull())
              .groupBy("e.v", "e.y").agg(F.count_if(F.col("e.i")).alias("n")))
    rows = bounded_collect(cc, max_classes * nv)
    if rows is None:
        raise ValueError(f"more than {max_classes} classes per variant")
    counts_by: list[dict[str, int]] = [{} for _ in range(nv)]
    for r in rows:
        counts_by[r["v"]][r["y"]] = int(r["n"])
    classes = [sorted(cb) for cb in counts_by]
    for (name, *_), cl in zip(specs, classes):
        if not cl:
            raise ValueError(f"variant {name} has an empty training set")
    aggs = []
    for v in range(nv):
        aggs.append(F.count_if(F.col(f"_in{v}")).alias(f"df_{v}"))
        aggs += [F.count_if(F.col(f"_in{v}") & (F.col(f"_y{v}") == F.lit(c))).alias(f"n_{v}_{i}")
                 for i, c in enumerate(classes[v])]
    low = min(md for _, _, md, _ in specs)
    ensure_checkpoint_dir(train.sparkSession)
    counts = (docs.select(*[f"_y{v}" for v in range(nv)], *[f"_in{v}" for v in range(nv)],
                          F.explode("_t").alias("term"))
                  .groupBy("term").agg(*aggs)
                  .where(_any([F.col(f"df_{v}") >= low for v in range(nv)]))
                  .checkpoint(eager=True))
    tot_aggs = []
    for v, (_, _, md, _) in enumerate(specs):
        keep = F.col(f"df_{v}") >= md
        tot_aggs.append(F.count_if(keep).alias(f"v{v}"))
        tot_aggs += [F.coalesce(F.sum(F.when(keep, F.col(f"n_{v}_{i}"))), F.lit(0)).alias(f"t_{v}_{i}")
                     for i in range(len(classes[v]))]
    tot = counts.agg(*tot_aggs).first()
    models = {}
    for v, (name, _, md, _) in enumerate(specs):
        nc = [counts_by[v][c] for c in classes[v]]
        n = sum(nc)
        if n == 0:
            raise ValueError(f"variant {name} has no training rows")
        vv = int(tot[f"v{v}"])
        weights = counts.where(F.col(f"df_{v}") >= md).select("term", *[
            F.log((F.col(f"n_{v}_{i}") + F.lit(alpha)) / F.lit(float(tot[f"t_{v}_{i}"]) + alpha * vv)).alias(f"w{i}")
            for i in range(len(classes[v]))])
        # a class absent from this subset keeps probability 0 through a -inf prior
        priors = [math.log(k / n) if k > 0 else float("-inf") for k in nc]
        models[name] = NBModel(name, classes[v], priors, weights, vv, n, nc, temperature)
    return models


class ModelSet(Sequence):
    """Models that are scored together, with their combined weights table.

    The table (one row per term, every model's class weights side by side as
    ``_m{j}_w{c}``) is built once per set by full outer joins on the term and
    checkpointed. It belongs to this object: it lives as long as the set and is
    never shared with other models.
    """

    def __init__(self, models: Iterable[NBModel]):
        self.models = list(models)
        self._weights: DataFrame | None = None

    def __len__(self) -> int:
        return len(self.models)

    def __getitem__(self, i):
        return self.models[i]

    @property
    def weights(self) -> DataFrame:
        if self._weights is None:
            w = None
            for j, m in enumerate(self.models):
                mw = m.weights.select("term", *[F.col(f"w{c}").alias(f"_m{j}_w{c}") for c in range(m.k)])
                w = mw if w is None else w.join(mw, "term", "full_outer")
            if len(self.models) > 1:
                ensure_checkpoint_dir(w.sparkSession)
                w = w.checkpoint(eager=True)
            self._weights = w
        return self._weights

    @property
    def row_bytes(self) -> int:
        return 8 * sum(m.k for m in self.models) + KEY_BYTES

    @property
    def broadcast_bytes(self) -> int:
        """Upper estimate of the table in memory: rows times columns and key."""
        return sum(m.n_terms for m in self.models) * self.row_bytes


@dataclass
class GroupedNB:
    """A model per group (language) over one class list, keyed by (group, term)."""
    classes: list[str]
    priors: DataFrame     # _g, lp0 .. ; null where the group has no row of the class
    weights: DataFrame    # _g, term, w0 ..
    n_weights: int

    @property
    def broadcast_bytes(self) -> int:
        return self.n_weights * (8 * len(self.classes) + 2 * KEY_BYTES)


def fit_nb_grouped(train: DataFrame, group: str, text_col: str = "text", label_col: str = "label",
                   min_df: int = MIN_DF, alpha: float = ALPHA, max_classes: int = MAX_CLASSES) -> GroupedNB:
    """Naive Bayes per value of ``group``, any number of groups, from one
    aggregation over (group, term). Rows without text, label or group train nothing."""
    docs = train.where(~is_blank(text_col) & F.col(label_col).isNotNull() & F.col(group).isNotNull()).select(
        F.col(group).alias("_g"), F.col(label_col).cast("string").alias("_y"), distinct_tokens(text_col).alias("_t"))
    rows = bounded_collect(docs.select("_y").distinct(), max_classes)
    if rows is None:
        raise ValueError(f"more than {max_classes} classes")
    classes = sorted(r["_y"] for r in rows)

    def per_class(prefix: str) -> list[Column]:
        return [F.count_if(F.col("_y") == F.lit(c)).alias(f"{prefix}{i}") for i, c in enumerate(classes)]
    k = range(len(classes))
    priors = docs.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), *per_class("n")).select(
        "_g", *[F.when(F.col(f"n{i}") > 0, F.log(F.col(f"n{i}") / F.col("n"))).alias(f"lp{i}") for i in k])
    ensure_checkpoint_dir(train.sparkSession)
    counts = (docs.select("_g", "_y", F.explode("_t").alias("term")).groupBy("_g", "term")
                  .agg(F.count(F.lit(1)).alias("df"), *per_class("n")).where(F.col("df") >= min_df).checkpoint(eager=True))
    total = counts.groupBy("_g").agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"n{i}").alias(f"t{i}") for i in k])
    weights = counts.join(total, "_g").select("_g", "term", *[
        F.log((F.col(f"n{i}") + F.lit(alpha)) / (F.col(f"t{i}") + F.lit(alpha) * F.col("v"))).alias(f"w{i}") for i in k])
    return GroupedNB(classes, priors.checkpoint(eager=True), weights, counts.count())


def nb_scores_grouped(df: DataFrame, key: str, group: str, model: GroupedNB, name: str, text_col: str = "text",
                      max_broadcast: int = MAX_BROADCAST_BYTES, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Every row by its own group's model: one explode, one equi-join on
    (group, term), one aggregate, whatever the number of groups. Blank texts and
    rows of a group without a model get nulls."""
    rows = df.select(F.monotonically_increasing_id().alias("_rid"), key, group, is_blank(text_col).alias("_blank"), distinct_tokens(text_col).alias("_t"))

    def spread(rows: DataFrame, explode: Callable) -> DataFrame:
        return rows.select("_rid", key, group, "_blank", F.col(group).alias("_g"), explode("_t").alias("term"))
    k = range(len(model.classes))
    g = summed(rows, "_rid", (key, group, "_blank"), spread, ["_g", "term"], model.weights, [f"w{i}" for i in k], {f"_s{i}": F.sum(f"w{i}") for i in k},
               model.n_weights, 8 * len(model.classes) + 2 * KEY_BYTES, max_broadcast, salt_buckets)
    g = g.join(model.priors.withColumn("_has", F.lit(True)), F.col(group) == F.col("_g"), "left")
    logp = F.array(*[F.when(F.col(f"lp{i}").isNotNull(), F.col(f"lp{i}") + F.col(f"_s{i}")).otherwise(F.lit(float("-inf"))) for i in k])
    out = g.select(key, group, F.when(~F.col("_blank") & F.col("_has"), logp).alias(f"{name}_logp"))
    return finish(out, name, model.classes)


def nb_scores(df: DataFrame, key: str, texts: Mapping[str, str], models: Sequence[NBModel],
              carry: Sequence[str] = (), max_broadcast: int = MAX_BROADCAST_BYTES,
              salt_buckets: int = SALT_BUCKETS, reuse: Mapping[str, str] | None = None, tokenised: bool = False, fixed: bool = False) -> DataFrame:
    """Scores of every model on every text column, one row per input row.

    Rows are told apart by an id made before the explode, so rows that share a
    key stay apart. Pass a :class:`ModelSet` to score often with the same models.

    ``texts`` maps an output tag to a text column (tag ``""`` for a single
    text); ``carry`` are small columns that depend on the key only (kept as
    extra grouping keys, never the text itself). For each (tag, model) the
    output has ``{tag_}{model}_logp`` (array<double>, class order of the model),
    ``_probs``, ``_label``, ``_conf`` and, for two classes, ``_s`` (the logit of
    the second class). Null or blank text gives nulls.

    ``reuse`` maps a tag to an earlier tag whose text is often identical (the
    rewrite to its original): rows where the two texts are equal do not explode
    the second text again and take the first text's sums.

    With ``tokenised`` the columns of ``texts`` hold the distinct tokens instead (null for a blank text). With ``fixed``
    no two rows share a key and ``df`` is a written table: no id is made and its rows are not written again.
    """
    models = models if isinstance(models, ModelSet) else ModelSet(models)
    tags = list(texts)
    reuse = dict(reuse or {})

    def same(i: int) -> Column | None:
        t = tags[i]
        if t not in reuse:
            return None
        return F.col(texts[t]).eqNullSafe(F.col(texts[reuse[t]]))

    def toks(i: int) -> Column:
        e = same(i)
        d = F.coalesce(F.col(texts[tags[i]]) if tokenised else distinct_tokens(texts[tags[i]]), F.array().cast("array<string>"))  # a null text takes none of the others' tokens
        return d if e is None else F.when(e, F.array().cast("array<string>")).otherwise(d)

    def tag(i: int):
        # a one-argument lambda: PySpark passes (element, index) to two-argument ones
        return lambda w: F.struct(F.lit(i).alias("src"), w.alias("term"))
    tagged = F.concat(*[F.transform(toks(i), tag(i)) for i in range(len(tags))])
    blanks = [(F.col(texts[t]).isNull() if tokenised else is_blank(texts[t])).alias(f"_blank{i}") for i, t in enumerate(tags)]
    sames = [(same(i) if same(i) is not None else F.lit(False)).alias(f"_same{i}") for i in range(len(tags))]
    flags = [f"_blank{i}" for i in range(len(tags))] + [f"_same{i}" for i in range(len(tags))]
    rows = df.select((F.col(key) if fixed else F.monotonically_increasing_id()).alias("_rid"), key, *carry, *blanks, *sames, tagged.alias("_all"))

    def spread(rows: DataFrame, explode: Callable) -> DataFrame:
        return (rows.select("_rid", key, *carry, *flags, explode("_all").alias("_x"))
                    .select("_rid", key, *carry, *flags, "_x.src", "_x.term"))
    aggs = {f"_s{i}_{j}_{c}": F.sum(F.when(F.col("src") == i, F.col(f"_m{j}_w{c}"))) for i in range(len(tags)) for j, m in enumerate(models) for c in range(m.k)}
    g = summed(rows, "_rid", (key, *carry, *flags), spread, ["term"], models.weights, [f"_m{j}_w{c}" for j, m in enumerate(models) for c in range(m.k)], aggs,
               sum(m.n_terms for m in models), models.row_bytes, max_broadcast, salt_buckets, fixed)
    out_cols: list[Column] = [F.col(key)] + [F.col(c) for c in carry]
    for i, t in enumerate(tags):
        for j, m in enumerate(models):
            p = f"{t}_{m.name}" if t else m.name
            src = tags.index(reuse[t]) if t in reuse else i

            def sums(k: int, c: int, j: int = j) -> Column:
                return F.col(f"_s{k}_{j}_{c}")
            logp = F.array(*[F.lit(m.priors[c]) + (sums(i, c) if src == i else
                                                   F.when(F.col(f"_same{i}"), sums(src, c)).otherwise(sums(i, c)))
                             for c in range(m.k)])
            out_cols.append(F.when(~F.col(f"_blank{i}"), logp).alias(f"{p}_logp"))
    scored = g.select(*out_cols)
    for t in tags:
        for m in models:
            scored = finish(scored, f"{t}_{m.name}" if t else m.name, m.classes, m.temperature)
    return scored


def finish(df: DataFrame, prefix: str, classes: Sequence[str], temperature: float = 1.0) -> DataFrame:
    """From ``{prefix}_logp``: probabilities, label (argmax, ties to the lower
    class index), top confidence and, for two classes, the logit ``_s``."""
    lp = F.col(f"{prefix}_logp")
    cls = F.array(*[F.lit(c) for c in classes])
    df = df.withColumn(f"_{prefix}_e", F.transform(
        lp, lambda x: F.exp((x - F.array_max(lp)) / F.lit(float(temperature)))))
    e = F.col(f"_{prefix}_e")
    df = df.withColumn(f"{prefix}_probs", F.transform(
        e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))
    df = (df.withColumn(f"{prefix}_label", F.when(lp.isNotNull(), F.element_at(
                cls, F.array_position(lp, F.array_max(lp)).cast("int"))))
            .withColumn(f"{prefix}_conf", F.array_max(F.col(f"{prefix}_probs"))))
    if len(classes) == 2:
        df = df.withColumn(f"{prefix}_s", F.element_at(lp, 2) - F.element_at(lp, 1))
    return df.drop(f"_{prefix}_e")


def class_probability(prefix: str, classes: Sequence[str], cls: str) -> Column:
    """Probability of one fixed class (G4: deltas use a fixed class per axis)."""
    return F.element_at(F.col(f"{prefix}_probs"), list(classes).index(cls) + 1)
