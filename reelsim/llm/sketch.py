"""Threshold-scaled sketches of documents, native DataFrame functions only.

A document's sketch is every distinct 64-bit hash of its ``WORDS``-word
shingles that lies below a fixed fraction of the hash range (``kept``).  The
fraction is the same for all documents, so sketches merge by union and compare
at any sizes: overlaps of two sketches estimate Jaccard and containment.  The
least hash of all (``least``) is carried beside them; it merges by minimum and
stands in for the kept hashes where there are none, as in short texts.

Defined results: words are runs of other than space and ``\\x09``-``\\x0D``,
lower-cased; fewer than ``WORDS`` words give one hash of all of them; null
and empty texts, or texts of white space, have an empty sketch (fingerprint
``''``); two empty sketches are alike (1.0), an empty one is unlike any other
(0.0).  Rows without a doc_id come last in descending order; repeated rows
follow each other; the next of a sole document is itself; an empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsim.llm.common import shuffle_partitions

WORDS = 5
FRACTION = 0.25
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


def add_sketch(df: DataFrame, text: str, out: str, n: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """``df`` with the sketch of column ``text``: ``kept``, an ascending
    ``array<long>``, and ``least``, null without words."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), BLANKS), lambda w: w != "")
    # two projections: the word hashes are computed once, not once per shingle
    step = df.select(*cols, F.transform(words, lambda w: F.xxhash64(w)).alias("_w"))
    w = F.col("_w")
    many = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))
    hashes = (F.when(F.size(w) >= n, many).when(F.size(w) > 0, F.array(F.xxhash64(w, F.lit(n))))
               .otherwise(F.array().cast("array<bigint>")))
    step = step.select(*cols, hashes.alias("_s"))
    limit = F.lit(int(fraction * 2 ** 64) - 2 ** 63)
    step = step.select(*cols, "_s", F.array_sort(F.array_distinct(F.filter("_s", lambda x: x < limit))).alias("_k"))
    return step.select(*cols, F.struct(F.col("_k").alias("kept"), F.array_min("_s").alias("least")).alias(out))


def hashes_of(sketch: str) -> Column:
    """The hashes that stand for a document: those kept, or its least."""
    kept, least = F.col(sketch)["kept"], F.col(sketch)["least"]
    return F.when((F.size(kept) == 0) & least.isNotNull(), F.array(least)).otherwise(kept)


def fingerprint(sketch: str) -> Column:
    """The sketch as text: 16 hex digits for each hash, ascending."""
    return F.array_join(F.transform(hashes_of(sketch), lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def jaccard(a: str, b: str) -> Column:
    a, b = hashes_of(a), hashes_of(b)
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def containment(a: str, b: str) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds."""
    a, b = hashes_of(a), hashes_of(b)
    return F.when(F.size(a) == 0, (F.size(b) == 0).cast("double")).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merge(sketch: str) -> Column:
    """Aggregate: the sketch of the union of all documents of a group, equal
    to that made from all their shingles at once."""
    kept = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col(sketch)["kept"]))))
    return F.struct(kept.alias("kept"), F.min(F.col(sketch)["least"]).alias("least"))


def _range_of(value: Column, splits: list[int]) -> Column:
    """How many of the ascending ``splits`` lie below ``value``: first among
    every r-th of them, then in that one's stretch."""
    if not splits:
        return F.lit(0)
    r = isqrt(len(splits)) + 1
    lists = [splits[i:i + r] for i in range(0, len(splits), r)]
    arr = lambda x: F.array(*[F.lit(v).cast("bigint") for v in x])
    coarse = F.size(F.filter(arr([x[-1] for x in lists]), lambda s: s < value))
    fine = F.coalesce(F.try_element_at(F.array(*[arr(x) for x in lists]), coarse + 1), F.array().cast("array<bigint>"))
    # beyond the last list, which may be short, all splits lie below
    return F.least(coarse * r, F.lit(len(splits))) + F.size(F.filter(fine, lambda s: s < value))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text, sketch, next_sketch``: the next document in
    descending doc_id, and after the last the first.

    One shuffle of the texts by ranges of doc_id; the document at the top of
    each range goes to the range above as well, and the top one of all to
    the lowest.
    """
    n_parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id"), F.lit(-1 << 63)).alias("_id"))
    shares = [i / (2 * n_parts) for i in range(1, 2 * n_parts)]
    got = docs.agg(F.percentile_approx(F.coalesce(F.col("doc_id"), F.lit(-1 << 63)), shares, 100 * n_parts).alias("q"),
                   F.max(F.coalesce(F.col("doc_id"), F.lit(-1 << 63))).alias("top")).first()
    if got["top"] is None:
        splits, top = [], 0
    else:
        top = got["top"]
        splits = sorted({x for x in got["q"] if x < top})
    here = _range_of(F.col("_id"), splits)
    where = F.array(F.struct(here.alias("r"), F.lit(0).alias("role")))
    if splits:
        edge = F.array(*[F.lit(x).cast("bigint") for x in splits])
        up = F.when(F.array_contains(edge, F.col("_id")), F.array(F.struct((here + 1).alias("r"), F.lit(1).alias("role"))))
        where = F.concat(where, F.coalesce(up, F.array().cast("array<struct<r:int,role:int>>")))
    wrap = F.when(F.col("_id") == top, F.array(F.struct(F.lit(0).alias("r"), F.lit(2).alias("role"))))
    where = F.concat(where, F.coalesce(wrap, F.array().cast("array<struct<r:int,role:int>>")))
    spread = rows.select("doc_id", "text", "_id", F.explode(where).alias("_w")).select("doc_id", "text", "_id", "_w.r", "_w.role")
    dealt = add_sketch(spread.repartition(n_parts, "r"), "text", "sketch")
    w = Window.partitionBy("r").orderBy(F.when(F.col("role") == 2, 1).otherwise(0), F.col("_id").desc(), F.xxhash64("text"))
    seen = dealt.select("doc_id", "text", "role", "sketch", F.lead("text").over(w).alias("next_text"),
                        F.lead("sketch").over(w).alias("next_sketch"))
    return seen.filter("role = 0").drop("role")


def edited(text: str, other: str) -> Column:
    """``text`` with its last third (rounded down) of code points replaced by
    the first as many (or all) of ``other``."""
    n = F.char_length(text)
    k = F.floor(n / 3).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), n - k), F.substring(F.col(other), F.lit(1), k))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Every document with its sketch, that of its edited text and that of
    the next document: ``doc_id, text, edited, sketch, edited_sketch, next_sketch``."""
    rows = with_next(docs).select("doc_id", "text", edited("text", "next_text").alias("edited"), "sketch", "next_sketch")
    return add_sketch(rows, "edited", "edited_sketch")
