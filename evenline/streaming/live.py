"""Structured Streaming variants.

``neutralize_stream`` runs the batch rewrite + rescore unchanged inside
``foreachBatch``: each micro-batch is a plain batch DataFrame, so the explode /
join / aggregate of scoring is not stateful across batches. Output goes to
``<sink>/batch_id=<id>/`` with overwrite, so a batch replayed after a failure
replaces its own output (idempotent sink); offsets and commits live in the
checkpoint folder, so a restarted query resumes where it stopped.

``windowed_scores`` is the live view (D4): reads joined to document scores
(stream-static equi-join), de-duplicated within the watermark (D3), and
aggregated per event-time window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evenline.session import scratch_path


def file_stream(spark: SparkSession, folder: str, file_glob: str, schema: StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream over ``folder`` restricted to files matching
    ``file_glob`` (new files arriving there become new micro-batches)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(folder)


def table_stream(spark: SparkSession, folder: str, name: str, schema: StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream a table stored as ``folder/name.parquet``: one file (a glob
    filter over the folder) or a directory of part files. The path's own file
    system says which, whatever its scheme; a missing table is an error."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isDirectory():
        return file_stream(spark, path, "*.parquet", schema, max_files_per_trigger)
    return file_stream(spark, folder, f"{name}.parquet", schema, max_files_per_trigger)


def run_foreach_batch(stream: DataFrame, process: Callable[[DataFrame, int], DataFrame],
                      sink: str, checkpoint: str, partition_by: Sequence[str] = (),
                      available_now: bool = True, timeout_s: float | None = None):
    """Run ``process`` on every micro-batch and write its result to
    ``sink/batch_id=<id>`` (overwrite, so replays are idempotent; D5 partitions
    by ``partition_by``). With ``available_now`` the query drains what is there
    and stops."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        out = process(batch, batch_id)
        w = out.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    ws = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    ws = ws.trigger(availableNow=True) if available_now else ws.trigger(processingTime="10 seconds")
    q = ws.start()
    if available_now:
        q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    return q


def neutralize_stream(spark: SparkSession, stream: DataFrame,
                      process: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = (),
                      sink: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Live neutralization. ``process`` is the batch plan (rewrite +
    rescore); returns the sink read back as a batch DataFrame."""
    sink = sink or scratch_path(spark, "stream-sink")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    run_foreach_batch(stream, lambda df, _: process(df), sink, checkpoint, partition_by)
    return spark.read.parquet(sink)


def windowed_scores(reads: DataFrame, doc_values: DataFrame, ts: str = "ts", key: str = "event_id",
                    doc_key: str = "doc_id", window: str = "1 day", watermark: str = "1 hour",
                    values: Sequence[str] = ("emotional_intensity",)) -> DataFrame:
    """D3 + D4 on a stream of reads: event time from ``ts`` (cast to timestamp;
    the watermark rejects timestamp_ntz), replays dropped within the
    watermark, then per-window read count and mean value of each axis."""
    r = (reads.withColumn(ts, F.col(ts).cast("timestamp"))
              .withWatermark(ts, watermark)
              .dropDuplicatesWithinWatermark([key]))
    j = r.join(doc_values, doc_key, "left")  # a read without values counts, and enters no mean
    return (j.groupBy(F.window(ts, window).alias("w"))
             .agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"{v}_mean") for v in values])
             .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n",
                     *[F.round(f"{v}_mean", 4).alias(f"{v}_mean") for v in values]))


def run_complete(stream_agg: DataFrame, spark: SparkSession, sink: str | None = None,
                 checkpoint: str | None = None) -> DataFrame:
    """Drive an aggregating stream in complete mode; every micro-batch
    overwrites the sink with the full result table, and the last one is
    returned."""
    sink = sink or scratch_path(spark, "stream-agg")
    checkpoint = checkpoint or scratch_path(spark, "stream-agg-ckpt")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/latest")

    q = (stream_agg.writeStream.outputMode("complete").foreachBatch(handle)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{sink}/latest")


def run_append(stream_agg: DataFrame, spark: SparkSession, sink: str | None = None,
               checkpoint: str | None = None) -> DataFrame:
    """Drive an aggregating stream in append mode: a window is written once,
    when the watermark passes its end; rows later than the watermark are
    dropped by the aggregate. Returns everything written."""
    sink = sink or scratch_path(spark, "stream-append")
    checkpoint = checkpoint or scratch_path(spark, "stream-append-ckpt")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (stream_agg.writeStream.outputMode("append").foreachBatch(handle)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
