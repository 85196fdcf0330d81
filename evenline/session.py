"""Session helpers: building a local session for tests/bench, and locating the
shared checkpoint folder a cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "evenline", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster to be:
    AQE on (coalescing, skew join), UI off, UTC, Arrow for pandas exchange."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("EVENLINE_DRIVER_MEMORY", "12g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster it must come from ``spark.checkpoint.dir`` (a shared file
    system); the library never invents a machine-local folder there. Only a
    local-mode session without the setting (tests, bench) gets a fresh folder
    under the system temp directory.
    """
    sc = spark.sparkContext
    d = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not d and not sc._jsc.sc().getCheckpointDir().isEmpty():
        d = sc._jsc.sc().getCheckpointDir().get()  # set by the application itself
    if not d:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="evenline-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream state, sinks)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as rows written once to the shared checkpoint folder (Parquet: compressed, read by column), so that row
    numbers made in it stay the same wherever it is read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``evenline`` importable on executors (Python UDF workers), once per
    SparkContext: the package is zipped into the shared checkpoint folder and
    added with ``addPyFile``, which works the same on a cluster and locally."""
    import shutil
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    bound_arrow_batches(spark)
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = scratch_path(spark, "pyfiles")
    local = base[len("file:"):] if base.startswith("file:") else base
    if "://" in local:
        # remote shared storage: stage the zip locally, then copy with Hadoop FS
        stage = tempfile.mkdtemp(prefix="evenline-zip-")
        z = shutil.make_archive(os.path.join(stage, "evenline"), "zip", os.path.dirname(pkg), "evenline")
        jvm = sc._jvm
        dst = jvm.org.apache.hadoop.fs.Path(f"{base}/evenline.zip")
        fs = dst.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.copyFromLocalFile(jvm.org.apache.hadoop.fs.Path(z), dst)
        sc.addPyFile(f"{base}/evenline.zip")
    else:
        os.makedirs(local, exist_ok=True)
        z = shutil.make_archive(os.path.join(local, "evenline"), "zip", os.path.dirname(pkg), "evenline")
        sc.addPyFile(z)
    _SHIPPED.add(sc.applicationId)


ARROW_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ARROW_BATCH = 1024


def bound_arrow_batches(spark: SparkSession, rows: int = TEXT_ARROW_BATCH) -> None:
    """Whole documents reach 20,000 words; Spark's default Arrow batch of
    10,000 rows could then hold a gigabyte of token arrays in one Python
    worker. Bound it for the text UDFs unless the session set its own value."""
    cur = spark.conf.get(ARROW_BATCH_CONF, None)
    if cur is None or cur == "10000":
        spark.conf.set(ARROW_BATCH_CONF, str(rows))


def recommended_conf(shuffle_bytes: int, executors: int, cores_per_executor: int,
                     partition_bytes: int = 256 << 20, split_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a cluster run. Shuffle partitions are sized from the bytes
    the largest shuffle carries (not the input: here the heavy shuffles move
    per-document sums, far smaller than the text), clamped to 2-20 per task
    slot so map x reduce blocks stay manageable; AQE coalesces small partitions
    and splits skewed ones at run time. Scans split at ``split_bytes``; Arrow
    batches are bounded for long texts."""
    slots = executors * cores_per_executor
    parts = min(max(2 * slots, -(-shuffle_bytes // partition_bytes)), 20 * slots)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        ARROW_BATCH_CONF: str(TEXT_ARROW_BATCH),
        # event ids of the dedup and open windows live on disk, not on the executor's heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
