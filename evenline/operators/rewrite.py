"""Prompt, rewrite and removed terms.

The shipped rewriter deletes loaded words (learned by
:func:`evenline.operators.lexicon.learn_loaded_terms`). It handles modifiers
("greedy", "useless") but is not paraphrase: deleting a loaded noun can break
grammar. A user's sequence-to-sequence model plugs in through
:func:`evenline.operators.adapters.seq2seq_rewrite` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import (distinct_tokens, rewrite_with_flags, rewrite_with_terms,
                                     rewrite_with_tiers, tokens)
from evenline.functions.overlap import multiset_difference
from evenline.guards import MAX_INLINE_TERMS, bounded_collect

# Fixed value (ours; the reference's prompt structure is blank, gap G1).
TERM_SALTS = 16
PROMPT_TEMPLATE = "neutralize | truth: %s | sentiment: %s | bias: %s | headline: %s"


def build_prompt(df: DataFrame, text_col: str = "text", truth: str = "truth_fmt",
                 sentiment: str = "sentiment_fmt", bias: str = "bias_fmt",
                 template: str = PROMPT_TEMPLATE, out: str = "prompt") -> DataFrame:
    """Labels + confidences (already formatted by A21) with the headline;
    null when any part is missing (never the text "null")."""
    parts = [F.col(truth), F.col(sentiment), F.col(bias), F.col(text_col)]
    missing = parts[0].isNull() | parts[1].isNull() | parts[2].isNull() | parts[3].isNull()
    return df.withColumn(out, F.when(~missing, F.format_string(template, *parts)))


def neutral_rewrite(df: DataFrame, lexicon: DataFrame | Sequence[str], text_col: str = "text",
                    out: str = "neutral", key: str | None = None, by: str | None = None,
                    max_inline: int = MAX_INLINE_TERMS) -> DataFrame:
    """A23 (lexicon rewriter) and A31 when ``by`` names a per-row column
    (language) and ``lexicon`` has that column too.

    Plan choice, on a checked size:

    * lexicon of at most ``max_inline`` terms: collected (bounded) and inlined
      as a hash set inside the row expression. The documents are never
      shuffled: a map-only projection, whatever their volume.
    * larger lexicon: the distinct tokens of each distinct text are joined to
      the lexicon (equi-join on term, salted by the text's hash so that a hot
      term is many tasks), the hits gathered per text hash and joined back.
      Rows need no key; equal texts share their hits.

    ``key`` is accepted for callers that pass one; neither path needs it.
    """
    if not isinstance(lexicon, DataFrame):
        if by is not None:
            raise ValueError("a per-row lexicon needs a DataFrame with the `by` column")
        return df.withColumn(out, rewrite_with_terms(text_col, list(lexicon)))
    cols = ["term"] + ([by] if by else [])
    rows = bounded_collect(lexicon.select(*cols).distinct(), max_inline)
    if rows is not None:
        if by is None:
            return df.withColumn(out, rewrite_with_terms(text_col, [r.term for r in rows]))
        tiers: dict[str, list[str]] = {}
        for r in rows:
            tiers.setdefault(r[by], []).append(r.term)
        return df.withColumn(out, rewrite_with_tiers(text_col, by, tiers))
    return _rewrite_by_join(df, lexicon.select(*cols).distinct(), text_col, out, by)


def _rewrite_by_join(df: DataFrame, lexicon: DataFrame, text_col: str, out: str, by: str | None,
                     salts: int = TERM_SALTS) -> DataFrame:
    keyed = df.withColumn("_tk", F.md5(F.col(text_col)))
    on = ["_tk"] + ([by] if by else [])
    toks = (keyed.select(*on, F.explode(distinct_tokens(text_col)).alias("term"))
                 .withColumn("_salt", F.pmod(F.hash("_tk"), F.lit(salts))))
    salted = lexicon.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = (toks.join(salted, ["term", "_salt"] + ([by] if by else []), "inner")
                .groupBy(*on).agg(F.collect_set("term").alias("_hits")))
    return (keyed.join(hits, on, "left")
                 .withColumn(out, rewrite_with_flags(text_col, "_hits"))
                 .select(*df.columns, out))


def removed_terms(df: DataFrame, key: str, before: str = "text", after: str = "neutral") -> DataFrame:
    """A27 per row: ``(key, term, removed)``, the multiset difference
    tokens(before) - tokens(after) with positive counts only.

    Rows whose two texts are equal are skipped first. The difference is
    computed inside each row (tokens in the JVM, counts in an Arrow-batched
    pandas UDF), so only removed terms are exploded and nothing is shuffled
    per (row, term); the corpus summary is then one two-phase aggregate.
    """
    changed = df.where(~F.col(before).eqNullSafe(F.col(after)) & F.col(before).isNotNull())
    diff = multiset_difference(tokens(before), tokens(after))
    return (changed.select(key, F.explode(diff).alias("x"))
                   .select(key, F.col("x.term").alias("term"), F.col("x.n").alias("removed")))


def removed_summary(removed: DataFrame, key: str) -> DataFrame:
    """Corpus view of A27: ``(term, n_docs, n_removed)``."""
    return removed.groupBy("term").agg(F.count(F.col(key)).alias("n_docs"),
                                       F.sum("removed").alias("n_removed"))
