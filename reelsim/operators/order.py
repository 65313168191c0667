"""Dense positions in a global order.

A window without ``partitionBy`` would move every row into one task.
Instead the rows are sorted with a range-partitioned sort, tagged with
``monotonically_increasing_id`` (partition number in the upper bits, row
number within the partition in the lower 33), and stored once so the tags
are fixed.  Each partition's starting offset then comes from a running sum
over the per-partition row counts, a table with one row per partition, and
is broadcast back.  No row passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = 33


def dense_index(df: DataFrame, order: list[str | Column], name: str = "position",
                start: int = 0) -> DataFrame:
    """``df`` plus a ``name`` column numbering rows ``start, start+1, ...``
    in the given order (the order must be total for a repeatable result)."""
    from reelsim.session import store_table

    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    tagged = store_table(tagged, "dense_index")
    tagged = (tagged.withColumn("_p", F.shiftright("_mid", _LOW_BITS))
                    .withColumn("_i", F.col("_mid").bitwiseAND((1 << _LOW_BITS) - 1)))
    counts = tagged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_p")
    return out.withColumn(name, (F.col("_off") + F.col("_i") + F.lit(start)).cast("long")) \
              .drop("_p", "_i", "_mid", "_off")
