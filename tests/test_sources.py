"""A1 corpus loading with a column mapping and multi-field text; A4 strict label mapping."""

import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evenline.operators.filters import map_labels
from evenline.sources.corpus import load_corpus


def test_load_corpus_mapping_and_fields(spark):
    d = tempfile.mkdtemp(prefix="evenline-corpus-")
    rows = [(1, "A", None, "B", "left"), (2, "C", "D", "  ", "right")]
    spark.createDataFrame(rows, "id long, title string, heading string, body string, y string") \
        .write.parquet(f"{d}/bias")
    df = load_corpus(spark, f"{d}/bias", {"id": "example_id", "y": "label"},
                     text_fields=("title", "heading", "body"))
    assert df.columns == ["example_id", "text", "label", "split"]
    got = sorted((r.example_id, r.text, r.label, r.split) for r in df.collect())
    assert got == [("1", "A B", "left", None), ("2", "C D", "right", None)]
    spark.createDataFrame([(1, "x", "0", "train")], "example_id long, text string, label string, split string") \
        .write.option("header", True).csv(f"{d}/csv")
    c = load_corpus(spark, f"{d}/csv", fmt="csv", options={"header": "true"}).first()
    assert (c.example_id, c.text, c.label, c.split) == ("1", "x", "0", "train")
    with pytest.raises(ValueError):
        load_corpus(spark, f"{d}/bias", {"id": "example_id"})   # no label column


def test_map_labels_strict(spark):
    df = spark.createDataFrame([("0",), ("1",), (None,)], "q string")
    out = map_labels(df, "q", {"0": "False", "1": "Truthful"}, "shown").collect()
    assert [r.shown for r in out] == ["False", "Truthful", None]
    bad = spark.createDataFrame([("2",)], "q string")
    with pytest.raises(PySparkException):
        map_labels(bad, "q", {"0": "False"}).collect()
    lax = map_labels(bad, "q", {"0": "False"}, "shown", strict=False).first()
    assert lax.shown is None
    assert df.select(F.count("q")).first()[0] == 2
