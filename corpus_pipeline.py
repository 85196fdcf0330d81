"""A training-data pipeline over ``documents``: toxic documents go, one document
of each near-duplicate group stays, benchmark leaks go, sources are mixed to
their weights, and token ids are written and described.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written and read again as the next one's
``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenline.llm.mixing import mixed_documents
from evenline.llm.queries import THRESHOLD, training_rows
from evenline.llm.setjoin import keep_one_of_each
from evenline.llm.spool import spool
from evenline.llm.templates import drop_contaminated
from evenline.llm.toxicity import fit_toxicity, keep_clean
from evenline.llm.wavelet import read_tokens, write_tokens
from evenline.session import scratch_path
from evenline.sources.corpus import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    train = training_rows()
    model = fit_toxicity(docs.select("doc_id", "text").where(train), table(spark, sf_dir, "labels").select("doc_id", "toxic").where(train))
    return keep_clean(docs, model, THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    write_tokens(docs.select("doc_id", "text"), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, out)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("token_output", token_output)]

#: The toxicity model is no SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spool(stage(spark, docs, sf_dir), name)
    return docs
