"""Spark session helpers.

Settings that matter at scale are set here once: AQE (runtime coalescing,
skew-join splitting, SMJ->BHJ conversion from real shuffle sizes), UTC as
the session zone (every event time in the model is an instant), and no UI
server. A cluster's own settings always win: the builder only fills in
values the deployment left unset.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Defaults applied only when the deployment does not set them.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs an extra shuffle
    # (e.g. a join on product_id feeding an aggregate keyed by product_id).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Parquet footers are written with min/max stats; keep pushdown on.
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # A task writing at most two partitions (an SCD2 publish: history + live
    # set) keeps both files open instead of sorting all its rows by
    # partition first; each open writer buffers up to one row group, so the
    # number stays small, and a task with more partitions falls back to sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    # Shuffle partitions AQE aims for after coalescing, and the most a scan
    # split reads: both well inside an executor's memory share per task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Rows a Python worker gets at once: whole texts of many kB stay far below
    # what an executor leaves to its workers.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Least shuffle partitions per core (see size_shuffle_partitions).
MIN_PARTITIONS_PER_CORE = 2


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tierline", driver_memory: str | None = None) -> SparkSession:
    """Return the active session, or build one for local use.

    ``shuffle_partitions`` is a starting point only; AQE coalesces small
    partitions at runtime, so on a cluster set it high (several per core)
    and let AQE shrink it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # Local mode runs every task inside the driver JVM.
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to a session built elsewhere (e.g. by a scheduler).

    The session time zone is always UTC: every instant in the model is
    defined in UTC (as the reference's ingest does), and the day arithmetic
    and text encodings depend on it. The other runtime defaults are filled in
    only where the deployment's Spark conf leaves them unset. Static settings
    (the UI) cannot change on a running session and are left alone.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    conf = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not conf.contains(key) and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (filesystem metadata; no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(conf)
        if fs.exists(hpath):
            total += fs.getContentSummary(hpath).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, total_bytes: int) -> int:
    """Size the shuffle partition count to the data, unless the deployment set it.

    One partition per advisory size (128 MB) of input, at least two per core,
    at every size of input; AQE then coalesces small partitions and splits
    skewed ones from the measured map output. A value set explicitly in the Spark conf
    (cluster defaults, tests, the bench) wins.
    """
    conf = spark.sparkContext.getConf()
    if conf.contains("spark.sql.shuffle.partitions"):
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    advisory = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m"))
    n = shuffle_partitions_for(total_bytes, spark.sparkContext.defaultParallelism, advisory)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def shuffle_partitions_for(total_bytes: int, cores: int, advisory_bytes: int) -> int:
    """ceil(total / advisory), at least two per core."""
    wanted = -(-total_bytes // advisory_bytes)
    return max(MIN_PARTITIONS_PER_CORE * cores, wanted)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared filesystem (HDFS/object store) so a
    lost executor does not lose cut lineage. Only when the setting is absent
    (tests, laptops) do we create a scratch folder of our own, and only on a
    local master: executors elsewhere could not see it.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tierline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession, name: str) -> str:
    """A per-run folder under the shared checkpoint root (never a local tmp on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    n = 0
    while True:
        n += 1
        yield n


_counter = _count()
