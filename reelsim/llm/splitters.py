"""Sharding by sampled splitters.

Records are ordered by ``(hash of text, doc_id, number of the row)``, so equal
texts lie next to each other (a shard's border may fall between them) and no
two keys are equal.  The rows are stored once, which fixes their numbers.  A size-weighted sample of keys gives quantile splitters, which
cut the order into ranges.  The bytes of every range are counted exactly; a
range over ``OVERFULL`` times its share is sampled again and subdivided.  The
ranges that hold a shard's border are then ordered to find the border's exact
key, which becomes a splitter too.  So every range lies in one shard, and one
shuffle by range places the records: law ``bytes``, sizes equal but for a
record at either border.

Defined results: a null text counts no bytes (size 16, crc32 0) and is hashed
like an empty one; null doc_ids come first among equal texts; rows that
repeat text and id lie next to each other, cut like any others; an empty table gives
an empty result.  Columns named in ``keep`` are carried along; a column of
``keep`` named like an output is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsim.llm.common import shuffle_partitions, store, trimmed, with_fields

OVERHEAD = 16
OVERFULL = 2.0
# Keys drawn for a range: the driver sees that many times the ranges.
SAMPLE = 20

Key = tuple[int, int, int]
KEY = ("_k1", "_k2", "_k3")


def key_columns() -> tuple[Column, Column, Column]:
    """Hash of the text, id, and a number that tells equal rows apart (fixed
    once the rows are stored)."""
    return (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_k1"),
            F.coalesce(F.col("doc_id"), F.lit(-1 << 63)).alias("_k2"),
            F.monotonically_increasing_id().alias("_k3"))


def size_column() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size")


def _clock() -> Column:
    """Exponential clock of a record: those that ring first are a sample
    without replacement by size.  Its ``u`` is a hash of the key."""
    u = (F.pmod(F.xxhash64(*KEY, F.lit(17)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    return (-F.log(u) / F.col("size")).alias("_c")


def weighted_sample(rows: DataFrame, k: int) -> list[Key]:
    """``k`` keys drawn by size, ascending."""
    got = rows.select(*KEY, _clock()).orderBy("_c", *KEY).limit(k).collect()
    return sorted(tuple(r[x] for x in KEY) for r in got)


def weighted_samples(parts: DataFrame, ranges: list[int], k: int) -> dict[int, list[Key]]:
    """``k`` keys of each of some ranges, drawn in one job."""
    w = Window.partitionBy("_range").orderBy("_c", *KEY)
    rows = parts.filter(F.col("_range").isin(ranges)).select("_range", *KEY, _clock())
    out: dict[int, list[Key]] = {x: [] for x in ranges}
    for r in rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).collect():
        out[r["_range"]].append(tuple(r[x] for x in KEY))
    return {x: sorted(keys) for x, keys in out.items()}


def quantiles(keys: list[Key], parts: int) -> list[Key]:
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def with_range(df: DataFrame, splitters: list[Key]) -> DataFrame:
    """Adds ``_range``: how many splitters are at or below the key."""
    cuts = [np.array([x[i] for x in splitters], np.int64) for i in range(3)]
    schema = with_fields(df.schema, _range=T.IntegerType())
    at = [df.columns.index(x) for x in KEY]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # splitters come first, so they precede rows of the same key
            k1, k2, k3 = (np.concatenate((c, batch.column(x).to_numpy())) for c, x in zip(cuts, at))
            order = np.lexsort((k3, k2, k1))
            out = np.empty(len(order), np.int32)
            out[order] = np.cumsum(order < len(splitters))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out[len(splitters):])], [*batch.schema.names, "_range"])

    return df.mapInArrow(trimmed(work), schema)


def exact_splitters(keys: DataFrame, shards: int, ranges: int) -> tuple[list[Key], list[tuple[int, int, int]]]:
    """Splitters, and for each range ``(shard, rows before it in the shard,
    rows)``.  ``keys`` holds ``_k1, _k2, _k3, size``; the driver sees samples
    and one row per range.  Overfull ranges of several rows are subdivided
    until there are none: keys are distinct, so every round makes progress."""
    total = keys.agg(F.sum("size").alias("s")).first()["s"] or 0
    splitters = quantiles(weighted_sample(keys, SAMPLE * ranges), ranges)
    while True:
        parts = with_range(keys, splitters)
        got = parts.groupBy("_range").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
        weight = {r["_range"]: r["s"] for r in got}
        over = [r["_range"] for r in got if r["n"] > 1 and r["s"] > OVERFULL * total / ranges]
        new: set[Key] = set()
        for x, more in weighted_samples(parts, over, SAMPLE * max(ranges // len(over), 2)).items() if over else ():
            new.update(quantiles(more, max(2, round(2 * weight[x] * ranges / total))))
        new -= set(splitters)
        if not new:
            break
        splitters = sorted(new.union(splitters))

    # a shard begins with the first record that has its share of bytes before it
    before, run = {}, 0
    for x in sorted(weight):
        before[x] = run
        run += weight[x]
    border = {x for i in range(1, shards) for x in weight
              if before[x] * shards < i * total <= (before[x] + weight[x]) * shards}
    if border:
        base = F.create_map(*[F.lit(v) for x in sorted(border) for v in (x, before[x])])
        w = Window.partitionBy("_range").orderBy(*KEY)
        run = (with_range(keys, splitters).filter(F.col("_range").isin(sorted(border)))
               .withColumn("_b", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
                           + F.element_at(base, F.col("_range"))))
        shard = F.floor(F.col("_b") * shards / F.lit(total)).cast("int")
        first = (run.withColumn("_s", shard).groupBy("_s").agg(F.min(F.struct("_b", *KEY)).alias("f"))
                    .select("_s", "f.*").orderBy("_s").collect())
        begins = {tuple(r[x] for x in KEY) for r in first if r["_s"] and r["_b"] * shards >= r["_s"] * total}
        splitters = sorted(begins.union(splitters))
    found = (with_range(keys, splitters).groupBy("_range").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
             .orderBy("_range").collect())
    out, run, rows = [(0, 0, 0)] * (len(splitters) + 1), 0, {}
    for r in found:
        shard = min(run * shards // total, shards - 1)
        out[r["_range"]] = (shard, rows.get(shard, 0), r["n"])
        rows[shard] = rows.get(shard, 0) + r["n"]
        run += r["s"]
    return splitters, out


def shard_documents(docs: DataFrame, shards: int = 40, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Columns ``keep`` with ``size``, ``law``, ``shard`` and ``slot``; the
    records of a range lie in one partition, in order."""
    spark = docs.sparkSession
    cols = [c for c in keep if c not in ("size", "law", "shard", "slot")]
    rows = store(docs.select(*[F.col(c).alias(f"c_{c}") for c in cols], *key_columns(), size_column()), "shard-rows")
    ranges = max(4 * shards, 2 * shuffle_partitions(spark))
    splitters, place = exact_splitters(rows.select(*KEY, "size"), shards, ranges)
    rows = with_range(rows, splitters)
    spot = spark.createDataFrame([(i, s, o) for i, (s, o, n) in enumerate(place)], "_range int, shard int, _o long")
    dealt = rows.repartition(shuffle_partitions(spark), "_range")
    w = Window.partitionBy("_range").orderBy(*KEY)
    # one row per range, and ranges are as many as the two parameters say
    placed = dealt.withColumn("_n", F.row_number().over(w)).join(F.broadcast(spot), "_range")
    return placed.select(*[F.col(f"c_{c}").alias(c) for c in cols], "size", F.lit("bytes").alias("law"), "shard",
                         (F.col("_o") + F.col("_n") - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, keep: tuple[str, ...] = ("doc_id", "text")) -> None:
    """Write the shards as folders ``shard=0 ..`` of Parquet files."""
    shard_documents(docs, shards, keep).write.partitionBy("shard").parquet(path)
