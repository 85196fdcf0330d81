"""The stream's collected output equals the batch plan, for one and four
micro-batches, and after a restart from the checkpoint."""

import tempfile

from pyspark.sql import functions as F

from evenline.plans.context import Context
from evenline.plans.queries import stream_process
from evenline.streaming.live import file_stream, run_foreach_batch

SF = "/root/testdata/sf0.001"


def _parts(spark, n):
    d = tempfile.mkdtemp(prefix="evenline-src-")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i in range(n):
        docs.where(F.pmod("doc_id", F.lit(n)) == i).coalesce(1).write.parquet(f"{d}/part{i}")
    return d, docs.schema


def _batch(spark):
    c = Context.get(spark, SF)
    return stream_process(c)(c.table("documents"))


def _run(spark, src, schema, sink, ckpt, max_files):
    c = Context.get(spark, SF)
    s = file_stream(spark, src + "/*", "*.parquet", schema, max_files_per_trigger=max_files)
    run_foreach_batch(s, lambda df, _: stream_process(c)(df), sink, ckpt, ["lang"])
    return spark.read.parquet(sink).select("doc_id", "lang", "neutral", "changed",
                                           "sentiment_before", "sentiment_after")


def test_stream_equals_batch_one_and_four_batches(spark):
    batch = _batch(spark).select("doc_id", "lang", "neutral", "changed", "sentiment_before", "sentiment_after")
    for n in (1, 4):
        src, schema = _parts(spark, n)
        tmp = tempfile.mkdtemp(prefix="evenline-run-")
        out = _run(spark, src, schema, f"{tmp}/sink", f"{tmp}/ckpt", 1)
        assert spark.read.parquet(f"{tmp}/sink").select("batch_id").distinct().count() == n
        assert out.count() == 200
        assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_stream_restart_after_a_killed_batch(spark):
    """The third micro-batch dies midway; a restart replays it and goes on."""
    import pytest
    src, schema = _parts(spark, 4)
    tmp = tempfile.mkdtemp(prefix="evenline-run-")
    c = Context.get(spark, SF)

    def dying(df, batch_id):
        out = stream_process(c)(df)
        if batch_id == 2:
            out.write.mode("overwrite").parquet(f"{tmp}/sink/batch_id=2")   # half done: written, never committed
            raise RuntimeError("killed")
        return out
    s = file_stream(spark, src + "/*", "*.parquet", schema, max_files_per_trigger=1)
    with pytest.raises(Exception):
        run_foreach_batch(s, dying, f"{tmp}/sink", f"{tmp}/ckpt", ["lang"])
    out = _run(spark, src, schema, f"{tmp}/sink", f"{tmp}/ckpt", 1)
    batch = _batch(spark).select("doc_id", "lang", "neutral", "changed", "sentiment_before", "sentiment_after")
    assert out.count() == 200 and out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0
