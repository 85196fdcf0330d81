"""Learning the loaded-term lexicon from labelled rows (A24, and A31 per language).

A term is *loaded* when it occurs in at least ``min_df`` labelled documents and
at least ``min_share`` of those carry the positive label. Document frequency
counts a term once per document (``array_distinct`` inside the row), then a
two-phase hash aggregate by term: the partial aggregate runs map-side, so even a
term present in a third of all documents shuffles one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import distinct_tokens

# Fixed defaults: learned on the train split only.
MIN_DF = 8
MIN_SHARE = 0.95


def learn_loaded_terms(labelled: DataFrame, text_col: str = "text", label_col: str = "label",
                       positive: str = "1", min_df: int = MIN_DF, min_share: float = MIN_SHARE,
                       by: Sequence[str] = ()) -> DataFrame:
    """``(by..., term, df, pos, share)`` for every loaded term."""
    docs = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    ex = docs.select(*by, (F.col(label_col).cast("string") == F.lit(positive)).alias("_pos"),
                     F.explode(distinct_tokens(text_col)).alias("term"))
    agg = ex.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("df"),
                                       F.count_if(F.col("_pos")).alias("pos"))
    # share test in integers (basis points) so every engine decides it exactly
    bp = int(round(min_share * 10000))
    return (agg.where((F.col("df") >= min_df) & (F.col("pos") * 10000 >= F.lit(bp) * F.col("df")))
               .withColumn("share", F.round(F.col("pos") / F.col("df"), 4)))
