"""Temperature mixing of sources, native DataFrame functions only.

A source's weight is its token share to the power ``alpha``, normalised.
``alpha`` = 1 keeps the corpus as it is, 0 makes sources equal.  Sectioning
(bisection with ``GRID`` points a round, one aggregation each) finds the
largest exponent that reaches the target entropy, but no smaller one than the
repetition limit allows.  The budget is the least with which every source is
seen whole once, so no document is dropped and small sources repeat.

The weights are realised as block permutations: in every pass over a source
its documents follow a hash order; document copies are laid along the
source's quota until it is used up, and the same share of every source's
quota goes to each block, so every block has the target weights.  Running
sums go over (source, pass, stretch of the hash order): a source with a third
of all rows is many stretches.

Defined results: tokens are words plus one, so null and empty texts count 1;
a null source is the source ``''``; rows that repeat a doc_id are separate
documents; an empty table gives an empty result.  All columns of the input
are carried; one that is named like an output is replaced.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsim.llm.common import split_join, store

MAX_REPEATS = 1.5
TARGET_ENTROPY = 0.95              # of the entropy of equal sources
BLOCK_TOKENS = 1 << 20
STRETCH_ROWS = 10_000
GRID = 32
ROUNDS = 4
OUTPUTS = ("tokens", "copy", "block", "place")


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long") + 1


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with ``tokens``; ``source`` is not null."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (*OUTPUTS, "source")]
    return docs.select(*keep, F.coalesce("source", F.lit("")).alias("source"), token_count().alias("tokens"))


def find_exponent(sources: DataFrame, max_repeats: float, target_entropy: float) -> tuple[float, dict]:
    """The exponent, and the sums that go with it.  ``sources`` holds
    ``source, total``; every round is one aggregation over it."""
    top = log(sources.agg(F.max("total").alias("m")).first()["m"])

    def round_of(points: list[float]) -> list[dict]:
        grid = F.explode(F.array(*[F.lit(a) for a in points])).alias("a")
        # shares to the power a, kept in range by the largest total
        rows = sources.select((F.log(F.col("total").cast("double")) - F.lit(top)).alias("l"), grid)
        z = F.exp(F.col("a") * F.col("l"))
        got = (rows.groupBy("a").agg(F.sum(z).alias("z"), F.sum(z * F.col("a") * F.col("l")).alias("e"),
                                     F.count("*").alias("n"), F.max(F.col("l") * (F.col("a") - 1)).alias("r"))
                   .orderBy("a").collect())
        return [{"a": g["a"], "z": g["z"], "entropy": log(g["z"]) - g["e"] / g["z"], "n": g["n"], "log_repeats": g["r"]} for g in got]

    # entropy falls and repetition falls as the exponent grows from 0 to 1
    def section(good) -> float:
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            points = [low + (high - low) * i / GRID for i in range(GRID + 1)]
            flags = [good(x) for x in round_of(points)]
            i = max((i for i, f in enumerate(flags) if f), default=0)
            if i == GRID:
                return high
            low, high = points[i], points[i + 1]
        return low

    by_entropy = section(lambda x: x["entropy"] >= target_entropy * log(x["n"]) - 1e-12)
    # the smallest exponent within the limit, as the mirror of the largest beyond it
    over = section(lambda x: x["log_repeats"] > log(max_repeats) + 1e-12)
    step = GRID ** -ROUNDS
    by_repeats = 0.0 if round_of([0.0])[0]["log_repeats"] <= log(max_repeats) + 1e-12 else min(1.0, over + step)
    alpha = max(by_entropy, by_repeats)
    return alpha, round_of([alpha])[0]


def mixture(measured: DataFrame, max_repeats: float = MAX_REPEATS, target_entropy: float = TARGET_ENTROPY) -> DataFrame:
    """``source, total, docs, share, weight, quota``: one row per source."""
    sources = store(measured.groupBy("source").agg(F.sum("tokens").alias("total"), F.count("*").alias("docs")), "sources")
    if sources.isEmpty():
        return sources.select("source", "total", "docs", *[F.lit(0.0).alias(c) for c in ("share", "weight", "quota")])
    alpha, at = find_exponent(sources, max_repeats, target_entropy)
    top = sources.agg(F.max("total").alias("m"), F.sum("total").alias("s")).first()
    z = F.pow(F.col("total") / F.lit(float(top["m"])), F.lit(alpha))
    weight = z / F.lit(at["z"])
    # the largest source is seen once: budget = largest total / its weight
    budget = top["m"] * at["z"]
    return sources.select("source", "total", "docs", (F.col("total") / F.lit(float(top["s"]))).alias("share"),
                          weight.alias("weight"), F.greatest(F.floor(weight * F.lit(budget) + 1e-6), F.col("total")).cast("double").alias("quota"))


def realise(measured: DataFrame, plan: DataFrame, key: str = "doc_id", max_repeats: float = MAX_REPEATS,
            block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows of ``measured``, once per copy, with ``copy`` (from 0), ``block``
    and ``place`` (the share of the source's quota before the row)."""
    plan = store(plan, "mixture")
    size = plan.agg(F.sum("docs").alias("n"), F.sum("quota").alias("q")).first()
    total, blocks = size["n"] or 0, max(1, ceil((size["q"] or 0) / block_tokens))
    bits = max(1, min(20, (max(total, 1) // STRETCH_ROWS).bit_length()))
    # the input's columns travel in one struct, so none of them clashes
    row = F.struct(*[F.col(f"`{c}`") for c in measured.columns]).alias("row")
    slim = measured.select("source", "tokens", F.col(key).alias("key"), row)
    copies = split_join(slim, plan.select("source", "docs", "total", "quota"), "source", "docs", total, "inner",
                        F.xxhash64("key"))
    copies = (copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.ceil(F.col("quota") / F.col("total")).cast("int") - 1)))
                    .withColumn("_h", F.xxhash64("key", "copy", F.lit("mixing")))
                    .withColumn("_b", F.shiftright("_h", 64 - bits)))
    # tokens of the stretches before, per source and pass
    sums = (copies.groupBy("source", "copy", "_b").agg(F.sum("tokens").alias("_t")))
    w = Window.partitionBy("source", "copy").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "copy", "_b", F.coalesce(F.sum("_t").over(w), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source", "copy", "_b").orderBy("_h", "key").rowsBetween(Window.unboundedPreceding, 0)
    run = copies.withColumn("_run", F.sum("tokens").over(inside) - F.col("tokens"))
    at = F.col("copy") * F.col("total") + F.col("_before") + F.col("_run")
    out = run.join(sums, ["source", "copy", "_b"]).withColumn("_at", at).filter(F.col("_at") < F.col("quota"))
    place = F.col("_at") / F.col("quota")
    return out.select("row.*", "copy", F.floor(place * blocks).cast("int").alias("block"), place.alias("place"))


def permute(realised: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds ``slot``: the row's place in the permutation of its block (a
    block holds about ``BLOCK_TOKENS`` tokens, whatever the corpus)."""
    w = Window.partitionBy("block").orderBy(F.xxhash64(key, "copy", F.lit("slot")), key, "copy")
    return realised.withColumn("slot", F.row_number().over(w) - 1)
