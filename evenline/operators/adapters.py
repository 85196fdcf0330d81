"""Adapters for user-supplied models (A18 external scoring, A23 ``model``
rewriter): a transformer classifier or a sequence-to-sequence rewriter the user
loads in their own function.

Both use ``pyspark.ml.functions.predict_batch_udf``: the model is built once
per Python worker by ``make_fn`` and fed Arrow batches of ``batch_size`` rows,
so inference is batched and the weights are never shipped from the driver.
The label, confidence and display contract is the same as for the shipped
naive Bayes models (``{name}_probs``, ``_label``, ``_conf``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def external_classifier(make_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
                        classes: Sequence[str], batch_size: int = 64) -> Callable[[Column], Column]:
    """``make_fn()`` returns ``predict(texts) -> probs`` with ``probs`` of
    shape (n, len(classes)) in the order of ``classes``."""
    from evenline.session import ship_package
    ship_package()
    k = len(classes)

    def factory():
        predict = make_fn()

        def run(texts: np.ndarray) -> np.ndarray:
            p = np.asarray(predict(texts), dtype="float64")
            if p.ndim != 2 or p.shape[1] != k:
                raise ValueError(f"classifier returned shape {p.shape}, expected (n, {k})")
            return p
        return run
    return predict_batch_udf(factory, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)


def score_external(df: DataFrame, text_col: str, name: str, classifier: Callable[[Column], Column],
                   classes: Sequence[str]) -> DataFrame:
    """A18 with an external model: ``{name}_probs, _label, _conf`` (null or
    blank text is not sent to the model and gives nulls)."""
    from evenline.functions.text import is_blank
    cls = F.array(*[F.lit(c) for c in classes])
    probs = F.when(~is_blank(text_col), classifier(F.coalesce(F.col(text_col), F.lit(""))))
    df = df.withColumn(f"{name}_probs", probs)
    p = F.col(f"{name}_probs")
    return (df.withColumn(f"{name}_label", F.when(p.isNotNull(), F.element_at(
                cls, F.array_position(p, F.array_max(p)).cast("int"))))
              .withColumn(f"{name}_conf", F.array_max(p)))


def seq2seq_rewriter(make_fn: Callable[[], Callable[[np.ndarray], Sequence[str]]],
                     batch_size: int = 16) -> Callable[[Column], Column]:
    """``make_fn()`` returns ``generate(prompts) -> texts`` (one output per
    prompt), e.g. a fine-tuned T5 fed the A22 prompt."""
    from evenline.session import ship_package
    ship_package()

    def factory():
        generate = make_fn()

        def run(prompts: np.ndarray) -> np.ndarray:
            out = list(generate(prompts))
            if len(out) != len(prompts):
                raise ValueError("rewriter returned a different number of texts")
            return np.asarray(out, dtype=object)
        return run
    return predict_batch_udf(factory, return_type=T.StringType(), batch_size=batch_size)


def seq2seq_rewrite(df: DataFrame, prompt_col: str, rewriter: Callable[[Column], Column],
                    out: str = "neutral") -> DataFrame:
    """A23 ``model``: rewrite from the prompt (null prompt gives null; the
    model may still see an empty string for it, since Spark evaluates a Python
    UDF on the whole batch before the surrounding CASE)."""
    return df.withColumn(out, F.when(F.col(prompt_col).isNotNull(),
                                     rewriter(F.coalesce(F.col(prompt_col), F.lit("")))))
