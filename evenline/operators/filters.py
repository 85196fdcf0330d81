"""Projections and filters (A2-A4). Plain column expressions: filters on
source columns reach the Parquet scan as PushedFilters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import concat_fields as _concat


def english_only(df: DataFrame, lang_col: str = "lang", lang: str = "en") -> DataFrame:
    """A2: keep rows in one language (pushed down to the scan)."""
    return df.where(F.col(lang_col) == F.lit(lang))


def concat_fields(df: DataFrame, cols: Sequence[str] = ("title", "heading", "body"),
                  sep: str = " ", out: str = "text") -> DataFrame:
    """A3: one model input from several fields, skipping null or blank ones."""
    return df.withColumn(out, _concat(*cols, sep=sep))


def map_labels(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None,
               strict: bool = True) -> DataFrame:
    """A4: raw label code to display label. With ``strict`` an unmapped non-null
    code fails the job (``raise_error``) instead of passing silently."""
    if not mapping:
        raise ValueError("empty label mapping")
    src = F.col(col).cast("string")
    e = None
    for k, v in mapping.items():
        e = (F.when(src == F.lit(str(k)), F.lit(v)) if e is None
             else e.when(src == F.lit(str(k)), F.lit(v)))
    fallback = (F.when(src.isNull(), F.lit(None).cast("string"))
                .otherwise(F.raise_error(F.concat(F.lit(f"unmapped label in {col}: "), src)))
                if strict else F.lit(None).cast("string"))
    return df.withColumn(out or col, e.otherwise(fallback))
