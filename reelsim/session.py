"""Session set-up and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions at runtime, and splits skewed join partitions (a hot
# term or a hot genre can hold a third of all postings).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "reelsim", driver_memory: str = "16g") -> SparkSession:
    """Local session for tests, bench and scripts (UI off, no server)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); a cluster session without one is an error.  Only a
    local session without one (tests) gets a scratch folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            # a machine-local folder is not shared by the executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, NFS)")
        d = tempfile.mkdtemp(prefix="reelsim-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    sub = os.path.join(base, f"{name}-{os.getpid()}-{next(_counter)}")
    return sub


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


# Bytes that a task reads of a stored table or a shuffle while a model is
# fitted, and of an Arrow batch: a row of text grows about tenfold when its
# terms are counted, and a task's share must not grow with the input.
TASK_BYTES, BATCH_BYTES = 32 << 20, 16 << 20


@contextmanager
def bounded_tasks(spark: SparkSession):
    """Tasks of at most ``TASK_BYTES`` for the writes in this block; settings
    that the session has lower stay, and all are as before afterwards."""
    bounds = {"spark.sql.files.maxPartitionBytes": TASK_BYTES, "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
              "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    held = {k: to_bytes(spark.conf.get(k)) for k in bounds}
    with _settings(spark, {k: min(held[k], most) if held[k] > 0 else most for k, most in bounds.items()}):
        yield


def cache_small(df: DataFrame) -> DataFrame:
    """Keep a small per-request table (resolved queries) in memory for the
    several reads that follow; lost blocks are recomputed from lineage."""
    df = df.persist()
    df.count()
    return df


def store_table(df: DataFrame, name: str = "table", folders: tuple[str, ...] = ()) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.  Unlike an RDD checkpoint the
    stored table is columnar: later scans read only the columns they use
    and get filter pushdown.  ``folders`` are partition columns; up to
    ``OPEN_FILES`` of them are written side by side, without a sort.  The
    write's own shuffle files go when it ends."""
    path = scratch_path(df.sparkSession, name)
    values = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    with _settings(df.sparkSession, values | ({"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES} if folders else {})):
        df.write.mode("overwrite").partitionBy(*folders).parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._stored_path = path
    _stored.append(path)
    return out


# Files that a task writes at a time; with more, its rows are sorted first.
OPEN_FILES = 128


@contextmanager
def _settings(spark: SparkSession, values: dict):
    """``values`` hold in this block, and what was there before afterwards."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# Paths of tables stored by this process and not yet deleted.
_stored: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in _stored:
        _stored.remove(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table of :func:`store_table`; nothing may read it any more."""
    _delete(df.sparkSession, df._stored_path)


def release_tables(spark: SparkSession) -> int:
    """Delete every table that :func:`store_table` has left in the shared
    folder: models not saved, indexes, numbered sources, lines of CSV files.
    Call it when all results are written; nothing that reads them works
    afterwards.  Returns how many there were."""
    paths = list(_stored)
    for path in paths:
        _delete(spark, path)
    return len(paths)
