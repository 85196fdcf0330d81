"""Readers for labelled corpora and for the test tables (A1).

Every reader declares its columns, so Parquet scans read only those columns and
filters written later reach the scan (PushedFilters)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenline.functions.text import concat_fields

# The canonical labelled-corpus schema every task works on.
CORPUS_COLUMNS = ("example_id", "text", "label", "split")
ARTICLE_COLUMNS = ("example_id", "title", "heading", "body", "label", "split")

TASKS = ("truth", "sentiment", "bias")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_corpus(spark: SparkSession, path: str, mapping: Mapping[str, str] | None = None,
                fmt: str = "parquet", options: Mapping[str, str] | None = None,
                text_fields: tuple[str, ...] | None = None) -> DataFrame:
    """Load one labelled corpus to ``(example_id, text, label, split)``.

    ``mapping`` renames source columns to the canonical names (``{"id":
    "example_id", "headline": "text", ...}``); a missing ``split`` column gives
    null (assign one with :func:`evenline.operators.splits.holdout_split`).
    ``text_fields`` builds ``text`` from several columns (title + heading + body),
    skipping null or blank ones. Extra columns are dropped, so the scan is pruned.
    """
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    mapping = dict(mapping or {})
    cols: dict[str, Column] = {}
    inv = {v: k for k, v in mapping.items()}
    for canon in CORPUS_COLUMNS:
        src = inv.get(canon, canon)
        if canon == "text" and text_fields:
            cols[canon] = concat_fields(*[inv.get(f, f) for f in text_fields])
        elif src in df.columns:
            cols[canon] = F.col(src)
        elif canon == "split":
            cols[canon] = F.lit(None).cast("string")
        else:
            raise ValueError(f"corpus at {path} has no column for {canon!r} (looked for {src!r})")
    return df.select(cols["example_id"].cast("string").alias("example_id"),
                     cols["text"].cast("string").alias("text"),
                     cols["label"].cast("string").alias("label"),
                     cols["split"].cast("string").alias("split"))


# --- binding of the driver's synthetic tables (proxy roles, see README) -------

PROXY_LABELS = {
    # task -> (table, column). These are proxies: `quality` is text quality,
    # `toxic` is hostile tone, `lang` only exercises the multi-class path.
    "truth": ("labels", "quality"),
    "sentiment": ("labels", "toxic"),
    "bias": ("documents", "lang"),
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their proxy labels: ``doc_id, text, lang, quality, toxic``.

    ``labels`` is one row per document id (its key), so the inner join keeps one
    row per labelled document; Spark plans it as a broadcast hash join only when
    the labels side is under the broadcast threshold, else sort-merge.
    """
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "inner")

