"""Data profiles (A14-A18): nulls, duplicates, lengths, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count of every column, one row."""
    cols = columns or df.columns
    return df.select(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in cols])


def duplicate_count(col: str = "title") -> Column:
    """Rows whose value occurred in an earlier row, nulls one group (A15):
    rows minus distinct values (a null group counts once)."""
    c = F.col(col)
    return (F.count(F.lit(1)) - F.count_distinct(c)
            - F.when(F.max(c.isNull().cast("int")) == 1, 1).otherwise(0))


def histogram(df: DataFrame, value: str | Column, bins: int) -> DataFrame:
    """Equal-width histogram from min to max with ``bins`` bins, the last
    bin closed, nulls ignored, empty bins listed (A17, A18).

    ``(bin, lo, hi, count)``; bin numbers 1..bins.  When min = max the
    range is widened by 0.5 on each side.  The counts combine map-side;
    the bin table has exactly ``bins`` rows.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    # no null filter before the aggregates: it would be pushed below the
    # projection and evaluate the value expression twice per row; min/max
    # skip nulls and the null bin is dropped after the (tiny) count
    vals = df.select(v.alias("v"))
    rng = vals.agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    lo = F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn"))
    hi = F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx"))
    rng = rng.select(lo.alias("lo"), hi.alias("hi"))
    lo_s, hi_s = rng.select("lo").scalar(), rng.select("hi").scalar()
    width = (hi_s - lo_s) / F.lit(float(bins))
    # least() skips nulls: keep a null value out of the last bin explicitly
    b = F.when(F.col("v").isNotNull(),
               F.least(F.floor((F.col("v") - lo_s) / width).cast("int") + 1, F.lit(bins)))
    counts = (vals.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
                  .filter(F.col("bin").isNotNull()))
    edges = rng.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "lo", "hi")
    edges = edges.select("bin",
                         (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins).alias("lo"),
                         (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("hi"))
    return (edges.join(counts, "bin", "left")
                 .select("bin", "lo", "hi", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))
