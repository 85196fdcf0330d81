"""A hot user (a third of all reads) through the chunked running prefix, and
the late-data rule of FIXTURES.md: 2 h behind a 1 h watermark is dropped in
append mode, kept by foreachBatch."""

import datetime as dt
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from evenline.operators.profile import prior_means
from evenline.streaming.live import file_stream, run_append, run_foreach_batch, windowed_scores


def test_prior_means_hot_user_equals_plain_window(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts", "user_id")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    ev = ev.withColumn("doc_id", F.col("event_id") % 50)
    # integer values: sums are exact in any order, so both sides round the same mean
    dv = spark.range(50).select(F.col("id").alias("doc_id"), F.col("id").cast("double").alias("x"))
    got = prior_means(ev, dv, "user_id", ("ts", "event_id"), ("x",))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = ev.join(dv, "doc_id").select("event_id", F.count(F.lit(1)).over(w).alias("prior_reads"),
                                        F.round(F.avg("x").over(w), 4).alias("prior_x_mean"))
    g = got.select("event_id", "prior_reads", "prior_x_mean")
    assert got.where("user_id = 0").count() > 3000
    assert g.exceptAll(want).count() == 0 and want.exceptAll(g).count() == 0


def test_late_event_dropped_in_append_kept_by_foreach_batch(spark):
    d = tempfile.mkdtemp(prefix="evenline-late-")
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    # With chained stateful operators (dedup, then aggregate) Spark judges
    # lateness against the watermark of the previous micro-batch, so the late
    # row arrives two batches after the one that moved the watermark to 11:00.
    batches = [
        [(1, base), (2, base + dt.timedelta(hours=1)), (3, base + dt.timedelta(hours=2))],   # max 12:00
        [(6, base + dt.timedelta(hours=2, minutes=30))],                                      # on time
        [(4, base - dt.timedelta(minutes=30))],                                               # 09:30: late
        [(5, base + dt.timedelta(hours=6))],                                                  # closes windows
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long"
    for i, rows in enumerate(batches):
        spark.createDataFrame([(e, t, 7) for e, t in rows], schema).coalesce(1).write.parquet(f"{d}/src/b{i}")
    dv = spark.createDataFrame([(0, 0.5)], "doc_id long, emotional_intensity double")

    def reads():
        s = file_stream(spark, f"{d}/src/*", "*.parquet", spark.read.parquet(f"{d}/src/b0").schema, 1)
        return s.withColumn("doc_id", F.lit(0).cast("long"))

    agg = windowed_scores(reads(), dv, window="1 hour", watermark="1 hour")
    out = run_append(agg, spark, f"{d}/agg", f"{d}/agg_ckpt")
    starts = {r.window_start: r.n for r in out.collect()}
    assert "2024-01-01 09:00:00" not in starts                    # the late row is dropped
    assert starts.get("2024-01-01 10:00:00") == 1 and starts.get("2024-01-01 12:00:00") == 2

    run_foreach_batch(reads(), lambda b, _: b, f"{d}/raw", f"{d}/raw_ckpt")
    kept = {r.event_id for r in spark.read.parquet(f"{d}/raw").collect()}
    assert kept == {1, 2, 3, 4, 5, 6}                              # foreachBatch keeps it
