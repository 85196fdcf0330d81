"""Logistic regression candidate (A8-A10 ``lr``) with Spark MLlib.

Features are hashed (``HashingTF``, binary presence): no vocabulary is
gathered on the driver, so the feature space does not grow with the corpus.
Training is MLlib's distributed optimiser (one tree aggregate of the gradient
per iteration); scoring is ``model.transform``, a per-row projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import TOKEN_PATTERN
from evenline.guards import MAX_CLASSES, bounded_collect

NUM_FEATURES = 1 << 16  # hashed feature space; a parameter of fit_lr


@dataclass
class LRModel:
    name: str
    classes: list[str]
    pipeline: PipelineModel
    num_features: int

    @property
    def n_params(self) -> int:
        k = 1 if len(self.classes) == 2 else len(self.classes)
        return self.num_features * k + k


def fit_lr(train: DataFrame, name: str, text_col: str = "text", label_col: str = "label",
           reg: float = 0.02, elastic_net: float = 1.0, max_iter: int = 100,
           num_features: int = NUM_FEATURES) -> LRModel:
    data = train.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    rows = bounded_collect(data.select(F.col(label_col).cast("string").alias("y")).distinct(), MAX_CLASSES)
    if rows is None:
        raise ValueError("too many classes")
    classes = sorted(r.y for r in rows)
    cls = F.array(*[F.lit(c) for c in classes])
    data = data.select(F.col(text_col).alias("_text"),
                       (F.array_position(cls, F.col(label_col).cast("string")) - 1).cast("double").alias("_y"))
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="_text", outputCol="_tok", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_f", numFeatures=num_features, binary=True),
        LogisticRegression(featuresCol="_f", labelCol="_y", regParam=reg, elasticNetParam=elastic_net,
                           maxIter=max_iter, family="multinomial" if len(classes) > 2 else "binomial"),
    ])
    return LRModel(name, classes, pipe.fit(data), num_features)


def lr_scores(df: DataFrame, model: LRModel, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep..., {name}_probs, {name}_label, {name}_conf`` per row."""
    p = model.name
    cls = F.array(*[F.lit(c) for c in model.classes])
    out = model.pipeline.transform(df.select(*keep, F.col(text_col).alias("_text")))
    probs = vector_to_array(F.col("probability"))
    return out.select(*keep, probs.alias(f"{p}_probs")).select(
        *keep, f"{p}_probs",
        F.when(F.col(f"{p}_probs").isNotNull(), F.element_at(
            cls, F.array_position(F.col(f"{p}_probs"), F.array_max(f"{p}_probs")).cast("int"))).alias(f"{p}_label"),
        F.array_max(f"{p}_probs").alias(f"{p}_conf"))
