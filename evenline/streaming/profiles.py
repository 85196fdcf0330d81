"""Live reading profiles (A33) and live scored reads (A32, D4) as stateful streams.

``profile_stream`` keeps per user the number of reads and the sum and count of every
value, and gives each read the means over that user's reads before it: the point-in-time
view of :func:`evenline.operators.profile.prior_means`, made as the reads arrive. The
state is a fixed few numbers a user, however long a history is; a state store on disk
(RocksDB, see ``recommended_conf``) keeps users off the heap. One micro-batch holds what
a trigger reads (``max_files_per_trigger``), so that also bounds the reads of one user
that a task sorts, at some 50 bytes each.

``live_reads`` joins two streams, scored headlines and reads, within a time after
publication. Watermarks on both let each side forget rows that can no longer match.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenline.operators.profile import AXES
from evenline.session import scratch_path, ship_package


def _sorted(rows: pd.DataFrame, order: list[str]) -> pd.DataFrame:
    """``rows`` by ``order``, nulls first, stable; plain times and whole numbers without pandas' sort, which costs more
    than a short history's sums."""
    if len(rows) < 2:
        return rows
    if all(rows[c].dtype.kind in "iMb" for c in order):
        # a null time is the smallest number
        keys = [x.view("int64") if x.dtype.kind == "M" else x for x in (rows[c].to_numpy() for c in reversed(order))]
        at = np.lexsort(keys)
        return rows if (at[1:] > at[:-1]).all() else rows.take(at)
    return rows.sort_values(order, na_position="first", kind="stable")


def _profile(order: list[str], values: list[str], names: list[str], idle_ms: int | None) -> Callable:
    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        had = state.get if state.exists else (0, *([0.0, 0] * len(values)))
        parts = list(batches)
        rows = _sorted(parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True), order)
        size = len(rows)
        now, means = [had[0] + size], np.full((size, len(values)), np.nan)
        for k, v in enumerate(values):
            x = rows[v].to_numpy("float64", na_value=np.nan)
            known = ~np.isnan(x)
            total = np.concatenate(([had[1 + 2 * k]], had[1 + 2 * k] + np.cumsum(np.where(known, x, 0.0))))
            count = np.concatenate(([had[2 + 2 * k]], had[2 + 2 * k] + np.cumsum(known)))
            np.divide(total[:-1], count[:-1], out=means[:, k], where=count[:-1] > 0)
            now += [float(total[-1]), int(count[-1])]
        state.update(tuple(now))
        out = rows[names].assign(prior_reads=had[0] + np.arange(size), **{f"prior_{v}_mean": means[:, k] for k, v in enumerate(values)})
        out.index = pd.RangeIndex(size)
        if idle_ms is not None:
            last = rows[order[0]].max()
            floor = state.getCurrentWatermarkMs()
            state.setTimeoutTimestamp(max(floor + 1, (0 if pd.isna(last) else int(last.timestamp() * 1000)) + idle_ms))
        yield out
    return run


def profile_stream(reads: DataFrame, doc_values: DataFrame, user: str = "user_id", order: Sequence[str] = ("ts", "event_id"),
                   values: Sequence[str] = AXES, watermark: str = "1 hour", idle: str | None = None) -> DataFrame:
    """Streaming ``reads`` (``user``, ``doc_id`` and the ``order`` columns, the first a time; other columns stay) with
    ``prior_reads`` and ``prior_{value}_mean`` over the user's earlier reads.

    Earlier means: read in an earlier micro-batch, or before it by ``order`` in the same one; a late read counts from
    when it arrives. Reads of documents without values (or that do not exist) count and enter no mean; null users are a
    user, null times come first. With ``idle`` (such as ``30 days``) a user without a read for so long, by event time,
    is forgotten and starts anew."""
    ship_package(reads.sparkSession)
    order, values = list(order), list(values)
    rows = reads.withColumn(order[0], F.col(order[0]).cast("timestamp")).join(doc_values.select("doc_id", *values), "doc_id", "left")
    idle_ms, timeout = None, "NoTimeout"
    if idle is not None:
        idle_ms, timeout = int(pd.Timedelta(idle).total_seconds() * 1000), "EventTimeTimeout"
        rows = rows.withWatermark(order[0], watermark)
    names = [c for c in rows.columns if c not in values]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names)
    state = "n long, " + ", ".join(f"s{k} double, c{k} long" for k in range(len(values)))
    out = f"{kept}, prior_reads long, " + ", ".join(f"prior_{v}_mean double" for v in values)
    return rows.groupBy(user).applyInPandasWithState(_profile(order, values, names, idle_ms), out, state, "append", timeout)


def live_reads(headlines: DataFrame, reads: DataFrame, published: str = "published", ts: str = "ts", within: str = "7 days",
               watermark: str = "1 hour", key: str = "doc_id") -> DataFrame:
    """Reads joined to the headline they show, if read at most ``within`` after its publication: two streams, an
    interval join on ``key``. ``headlines`` and ``reads`` share no other column name. A row that comes more than
    ``watermark`` behind its own side is late and may be dropped; see :func:`run_stream`."""
    h = headlines.withColumn(published, F.col(published).cast("timestamp")).withWatermark(published, watermark).withColumnRenamed(key, f"{key}_published")
    r = reads.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    on = (F.col(key) == F.col(f"{key}_published")) & (F.col(ts) >= F.col(published)) & (F.col(ts) <= F.col(published) + F.expr(f"INTERVAL {within}"))
    return r.join(h, on, "inner").drop(f"{key}_published")


def run_stream(stream: DataFrame, spark: SparkSession, sink: str | None = None, checkpoint: str | None = None,
               process: Callable[[DataFrame, int], DataFrame] | None = None) -> tuple[DataFrame, int]:
    """Drive an appending stateful stream until its input is drained; every micro-batch replaces its own
    ``sink/batch_id=N``, so a batch that is run again after a failure leaves no second copy. Returns what was written
    and how many rows state operators dropped as late."""
    sink = sink or scratch_path(spark, "stream-rows")
    checkpoint = checkpoint or scratch_path(spark, "stream-rows-ckpt")

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = process(batch, batch_id) if process else batch
        rows.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    q = (stream.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    late = sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
    return spark.read.schema(stream.schema).parquet(sink), late
