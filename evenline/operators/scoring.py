"""Batch scoring contract.

``analyse`` (A19) runs all task models in one pass over the text (one explode,
one join, one aggregate) rather than three scorings joined on the id.
``label_confidence`` (A20) narrows the result to what the rewriter receives.
``format_confidence`` (A21) renders ``False (97.1%)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.operators.filters import map_labels
from evenline.operators.naive_bayes import NBModel, nb_scores

# Fixed display text: label, space, confidence in percent with one decimal.
CONFIDENCE_FORMAT = "%s (%.1f%%)"
NEAR_NEUTRAL = "Near-neutral"
TAU_NEAR = 0.55


def score(df: DataFrame, model: NBModel, key: str, text_col: str = "text",
          carry: Sequence[str] = (), tokenised: bool = False) -> DataFrame:
    """Label + confidence (+ class probabilities) of one model per row."""
    return nb_scores(df, key, {"": text_col}, [model], carry, tokenised=tokenised)


def analyse(df: DataFrame, models: Sequence[NBModel], key: str, text_col: str = "text",
            carry: Sequence[str] = ()) -> DataFrame:
    """Every model's result on one row per ``key``."""
    return nb_scores(df, key, {"": text_col}, models, carry)


def label_confidence(df: DataFrame, key: str, tasks: Sequence[str]) -> DataFrame:
    """Only label and top probability per task go downstream."""
    cols = [key]
    for t in tasks:
        cols += [f"{t}_label", f"{t}_conf"]
    return df.select(*cols)


def confidence_text(label: Column, conf: Column) -> Column:
    """``label (NN.N%)``; the percentage is rounded half-up to one decimal first,
    so the text does not depend on the formatter's own rounding rule."""
    return F.when(label.isNull() | conf.isNull(), F.lit(None).cast("string")).otherwise(
        F.format_string(CONFIDENCE_FORMAT, label, F.round(conf * 100.0, 1)))


def format_confidence(df: DataFrame, tasks: Sequence[str],
                      display: Mapping[str, Mapping[str, str]] | None = None,
                      near_neutral: Mapping[str, float] | None = None, strict: bool = True) -> DataFrame:
    """A21 (with A4): ``{task}_fmt`` for each task, labels mapped to display
    names when ``display[task]`` is given. With ``strict`` an unmapped code
    fails the job, as in :func:`evenline.operators.filters.map_labels`; without
    it, it gives null. A task in ``near_neutral`` shows ``Near-neutral`` where
    its confidence is below the given threshold."""
    display, near = display or {}, near_neutral or {}
    for t in tasks:
        shown = f"_{t}_shown"
        df = df.withColumn(shown, F.col(f"{t}_label"))
        if display.get(t):
            df = map_labels(df, shown, display[t], strict=strict)
        lab, conf = F.col(shown), F.col(f"{t}_conf")
        if t in near:
            lab = F.when(lab.isNotNull() & (conf < F.lit(float(near[t]))), F.lit(NEAR_NEUTRAL)).otherwise(lab)
        df = df.withColumn(f"{t}_fmt", confidence_text(lab, conf)).drop(shown)
    return df
