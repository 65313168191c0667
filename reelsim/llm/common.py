"""Readers, shared scratch tables and the split join for hot keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsim.session import checkpoint_dir

# Keys that hold more than this share of all rows (and more than HOT_ROWS
# rows) are hot; at most 1 / HOT_SHARE keys can be, which bounds what the
# split join broadcasts.
HOT_SHARE = 1e-5
HOT_ROWS = 1000

# Spark's own switch: the shuffle files of an execution go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Bytes of an Arrow batch that a task gets at once, where the session does
# not set its own bound; a longer row still travels whole.
BATCH_BYTES = 16 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_STORED: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python tasks by bytes, not by rows alone.
    A bound that the session was given stays."""
    default = spark._jvm.org.apache.spark.sql.internal.SQLConf().getConfString(BATCH_SETTING)
    if spark.conf.get(BATCH_SETTING) == default:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def trimmed(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` of a ``mapInArrow``; when it ends, the reused worker process
    hands its free memory back, which it would else keep until its executor
    ends."""
    def run(batches: Iterator) -> Iterator:
        import ctypes

        import pyarrow as pa
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):             # another C library
                pass
    return run


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, remembered for
    :func:`release`."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared checkpoint folder
    and read it back (columnar, readable after any executor is lost).  The
    write's shuffle files go once it has ended; otherwise they would stay as
    long as the caller holds ``df``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    bound_batches(spark)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(schema).parquet(path)
    out._stored_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop(*stored: DataFrame) -> None:
    """Delete tables of :func:`store` once what was made from them is
    stored itself."""
    for df in stored:
        _STORED[df.sparkSession.sparkContext.applicationId].remove(df._stored_path)
        _delete(df.sparkSession, df._stored_path)


def stored(spark: SparkSession) -> list[str]:
    """The folders that :func:`scratch_path` gave out and that are still
    there."""
    return list(_STORED.get(spark.sparkContext.applicationId, []))


def forget(spark: SparkSession, paths: list[str], keep: DataFrame) -> None:
    """Delete these folders, but for the one of the stored table ``keep``."""
    for path in paths:
        if path != keep._stored_path:
            _STORED[spark.sparkContext.applicationId].remove(path)
            _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete every folder that :func:`scratch_path` gave out in this
    session.  Call it once the results that read them are written."""
    for path in _STORED.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def with_fields(schema: T.StructType, **kinds: T.DataType) -> T.StructType:
    """A schema with more fields at its end."""
    return T.StructType([*schema.fields, *(T.StructField(k, v) for k, v in kinds.items())])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_limit(total: int) -> int:
    """Rows of a key above which it counts as hot (see HOT_SHARE)."""
    return max(HOT_ROWS, int(total * HOT_SHARE))


def split_join(left: DataFrame, right: DataFrame, key: str, count: str, total: int,
               how: str, spread: Column) -> DataFrame:
    """Equi-join of ``left`` with ``right`` (one row per ``key``, whose
    ``count`` says how many left rows hold the key) without a hot task.

    Hot keys (above :func:`hot_limit` of ``total`` left rows, so at most
    ``1 / HOT_SHARE`` rows) are broadcast; every other key is shuffled.
    Left rows of hot keys, and those without a key, shuffle on ``spread``
    instead of the key.
    ``how`` is ``inner`` or ``left``; right columns other than the key
    come out under their own names.
    """
    cols = [c for c in right.columns if c != key]
    limit = hot_limit(total)
    hot = right.filter(F.col(count) > limit)
    hot = hot.select(F.col(key).alias("_hk"), F.struct(*cols).alias("_hot"))
    cold = right.filter(F.col(count) <= limit)
    # a second join key, computed from the key on both sides: a constant one
    # would be folded away, and rows dealt by the key alone
    cold = cold.select(F.xxhash64(key).alias("_s"), F.col(key).alias("_ck"), F.struct(*cols).alias("_cold"))
    j = left.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    # rows already answered, or without a key, meet no cold row: any salt will do
    j = j.withColumn("_ls", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), spread).otherwise(F.xxhash64(key)))
    j = j.join(cold, (F.col(key) == F.col("_ck")) & (F.col("_ls") == F.col("_s")), "left")
    j = j.withColumn("_r", F.coalesce("_hot", "_cold"))
    if how == "inner":
        j = j.filter(F.col("_r").isNotNull())
    return j.select(*left.columns, *[F.col(f"_r.{c}").alias(c) for c in cols])
