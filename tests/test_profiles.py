"""A33 live and the join of two streams: equal to the batch plans for one and four
micro-batches and after a killed batch; null keys, idle users and late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from evenline.operators.profile import AXES, prior_means
from evenline.plans.context import Context
from evenline.plans.queries import doc_values, reads
from evenline.streaming.live import file_stream
from evenline.streaming.profiles import live_reads, profile_stream, run_stream

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)
COLS = ["event_id", "user_id", "doc_id", "prior_reads", *[f"prior_{v}_mean" for v in AXES]]


def split_by_time(df, ts, n, out):
    """``n`` files, each with the rows of a later stretch of time."""
    lo, hi = df.agg(F.min(F.unix_micros(F.col(ts).cast("timestamp"))), F.max(F.unix_micros(F.col(ts).cast("timestamp")))).first()
    part = F.least(F.floor((F.unix_micros(F.col(ts).cast("timestamp")) - lo) / max(1, (hi - lo + 1) / n)), F.lit(n - 1))
    for k in range(n):
        df.where(part == k).coalesce(1).write.parquet(f"{out}/part{k}")
    return file_stream(df.sparkSession, f"{out}/*", "*.parquet", df.schema, max_files_per_trigger=1)


def rounded(df):
    return df.select(*COLS[:4], *[F.round(c, 4).alias(c) for c in COLS[4:]])


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("n", [1, 4])
def test_profile_stream_equals_history(spark, tmp_path, n):
    c = Context.get(spark, SF)
    want = prior_means(reads(c), doc_values(c)).select(*COLS)
    stream = split_by_time(reads(c), "ts", n, tmp_path / "in")
    got, _ = run_stream(profile_stream(stream, doc_values(c)), spark, str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    assert same(rounded(got), want)
    assert spark.read.parquet(str(tmp_path / "sink")).select("batch_id").distinct().count() == n


def test_profile_stream_after_a_killed_batch(spark, tmp_path):
    c = Context.get(spark, SF)
    want = prior_means(reads(c), doc_values(c)).select(*COLS)
    stream = split_by_time(reads(c), "ts", 4, tmp_path / "in")
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")

    def dying(batch, batch_id):
        if batch_id == 2:
            batch.write.mode("overwrite").parquet(f"{sink}/batch_id=2")  # written, never committed
            raise RuntimeError("killed")
        return batch
    with pytest.raises(Exception):
        run_stream(profile_stream(stream, doc_values(c)), spark, sink, ckpt, dying)
    got, _ = run_stream(profile_stream(stream, doc_values(c)), spark, sink, ckpt)
    assert same(rounded(got), want)


ODD = [(1, 1, 0, 1), (2, 1, 5, 1), (3, None, 1, 2), (4, None, 2, 1), (5, 1, None, 2), (6, 1, 5, 9), (7, 2, 3, None), (8, None, None, 2), (9, 1, 5, 2)]


def odd_reads(spark):
    rows = [(e, u, None if t is None else T0 + dt.timedelta(minutes=t), d) for e, u, t, d in ODD]
    values = spark.createDataFrame([(1, 0.2, 0.4, 0.6), (2, 0.8, None, 0.9)], "doc_id long, truth_probability double, emotional_intensity double, bias_degree double")
    return spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, doc_id long"), values


def plain_history():
    values, out = {1: (0.2, 0.4, 0.6), 2: (0.8, None, 0.9)}, set()
    for e, u, t, d in ODD:
        before = [x for x in ODD if x[1] == u and (x[2] is not None, x[2] or 0, x[0]) < (t is not None, t or 0, e)]
        means = []
        for k in range(3):
            xs = [values[x[3]][k] for x in before if x[3] in values and values[x[3]][k] is not None]
            means.append(round(sum(xs) / len(xs), 4) if xs else None)
        out.add((e, u, d, len(before), *means))
    return out


def test_null_users_and_times_are_kept(spark, tmp_path):
    r, values = odd_reads(spark)
    assert {tuple(x) for x in prior_means(r, values).select(*COLS).collect()} == plain_history()
    r.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), "*.parquet", r.schema)
    got, _ = run_stream(profile_stream(stream, values), spark)
    assert {tuple(x) for x in rounded(got).collect()} == plain_history()


def test_idle_users_are_forgotten(spark, tmp_path):
    day = dt.timedelta(days=1)
    batches = [[(1, 1, T0, 1), (2, 2, T0, 1)], [(3, 2, T0 + day, 1)], [(4, 3, T0 + 40 * day, 1)], [(5, 3, T0 + 80 * day, 1)], [(6, 1, T0 + 81 * day, 1), (7, 3, T0 + 81 * day, 1)]]
    _, values = odd_reads(spark)
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, doc_id long").coalesce(1).write.parquet(str(tmp_path / f"in/part{k}"))
        stream = file_stream(spark, str(tmp_path / "in/*"), "*.parquet", spark.read.parquet(str(tmp_path / "in/part0")).schema, max_files_per_trigger=1)
        got, _ = run_stream(profile_stream(stream, values, idle="30 days"), spark, str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    prior = {r["event_id"]: r["prior_reads"] for r in got.collect()}
    assert prior[3] == 1 and prior[6] == 0, "user 1 was idle for 81 days"
    assert prior[7] >= 1 and sorted(prior) == [1, 2, 3, 4, 5, 6, 7]


HEADS = [(1, 0, "a"), (2, 60, "b"), (3, 600, "c"), (4, 1300, "d")]
READS = [(1, 1, 5), (2, 1, 100), (3, 2, 30), (4, 2, 70), (5, 3, 700), (6, 9, 800), (7, 1, 1200), (8, 4, 1400), (9, 3, 1400)]


def frames(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    h = spark.createDataFrame([(d, at(m), x) for d, m, x in HEADS], "doc_id long, published timestamp, label string")
    r = spark.createDataFrame([(e, d, at(m)) for e, d, m in READS], "event_id long, doc_id long, ts timestamp")
    return h, r


def plain_reads(within=120):
    return {(e, d, x) for e, d, m in READS for k, p, x in HEADS if k == d and p <= m <= p + within}


@pytest.mark.parametrize("n", [1, 4])
def test_two_streams_equal_the_batch_join(spark, tmp_path, n):
    h, r = frames(spark)
    hs, rs = split_by_time(h, "published", n, tmp_path / "h"), split_by_time(r, "ts", n, tmp_path / "r")
    got, late = run_stream(live_reads(hs, rs, within="2 hours"), spark, str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    assert {(x["event_id"], x["doc_id"], x["label"]) for x in got.collect()} == plain_reads() and late == 0


def test_late_reads_are_counted_and_a_killed_batch_is_run_again(spark, tmp_path):
    h, r = frames(spark)
    late_read = spark.createDataFrame([(99, 1, T0 + dt.timedelta(minutes=10))], r.schema)
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    h.coalesce(1).write.parquet(str(tmp_path / "h/part0"))
    r.coalesce(1).write.parquet(str(tmp_path / "r/part0"))
    hs = file_stream(spark, str(tmp_path / "h/*"), "*.parquet", h.schema, 1)
    rs = file_stream(spark, str(tmp_path / "r/*"), "*.parquet", r.schema, 1)

    def dying(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        raise RuntimeError("killed")
    with pytest.raises(Exception):
        run_stream(live_reads(hs, rs, within="2 hours"), spark, sink, ckpt, dying)
    got, late = run_stream(live_reads(hs, rs, within="2 hours"), spark, sink, ckpt)
    assert {(x["event_id"], x["doc_id"], x["label"]) for x in got.collect()} == plain_reads() and late == 0
    late_read.coalesce(1).write.parquet(str(tmp_path / "r/part1"))  # 22 hours behind both watermarks
    got, late = run_stream(live_reads(hs, rs, within="2 hours"), spark, sink, ckpt)
    assert late == 1 and {(x["event_id"], x["doc_id"], x["label"]) for x in got.collect()} == plain_reads()
