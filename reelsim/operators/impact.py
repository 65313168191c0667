"""Pruned search for one request over impact-ordered postings.

Postings are stored in blocks: a folder per band of document frequency and
per level of weight.  Rare terms are short lists that decide most of a score;
the long lists of common terms, and their many small weights, mostly need not
be read.  A search reads blocks in the order of what they can still change:

* ``ceiling`` bounds the score that unread blocks can add to any document:
  for some bands by Cauchy-Schwarz (documents are unit vectors), for the rest
  by the greatest unread weight of the band;
* a round reads the blocks of a prefix of that order (partition filters, so
  other folders are not opened) and keeps the ``HELD`` best partial scores;
* once the running n-th score is above the ceiling, a document that was not
  met cannot be in the list, and one that was met can only if its partial
  score plus the ceiling reaches the n-th.  Those few are scored in full from
  their vectors.  Otherwise the next round reads on, at the latest to the
  end, where partial scores are the scores.

So results are exact.  The driver plans over at most ``BANDS * LEVELS`` blocks
and holds one request's terms and ``HELD`` rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsim.operators.similarity import RANK_DECIMALS

BANDS, LEVELS = 32, 4
# Bound of the first round; later ones follow from the running n-th score.
FIRST_CEILING = 0.5
HELD = 1000
MARGIN = 10.0 ** -RANK_DECIMALS


def band_of(df: Column) -> Column:
    """Two octaves of document frequency are a band."""
    return F.least(F.floor(F.log2(df) / 2), F.lit(BANDS - 1)).cast("int")


def level_of(w: Column) -> Column:
    """Weights of at least 1/4, 1/8, 1/16, and the rest."""
    return F.least(F.greatest(F.floor(-F.log2(w)) - 1, F.lit(0)), F.lit(LEVELS - 1)).cast("int")


def with_blocks(postings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``postings`` with the ``band`` and ``level`` of every row."""
    bands = vocabulary.select("term", band_of(F.col("df")).alias("band"))
    return postings.join(bands, "term").withColumn("level", level_of(F.col("w")))


def block_sizes(blocks: DataFrame) -> dict[tuple[int, int], tuple[int, float]]:
    """Rows and greatest weight of every block."""
    rows = blocks.groupBy("band", "level").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("top")).collect()
    return {(r["band"], r["level"]): (r["n"], r["top"]) for r in rows}


@dataclass(frozen=True)
class Request:
    """One query vector: ``(term, band, weight)`` triples."""

    terms: tuple[tuple[str, int, float], ...]

    def by_band(self) -> dict[int, tuple[float, float]]:
        """Sum of the squared weights, and of the weights, per band."""
        out = defaultdict(lambda: (0.0, 0.0))
        for _, band, w in self.terms:
            out[band] = (out[band][0] + w * w, out[band][1] + w)
        return dict(out)


def ceiling(bands: dict[int, tuple[float, float]], unread: dict[int, float]) -> float:
    """The most that unread blocks add to a score; ``unread`` has the
    greatest unread weight of each band that still has some."""
    open_ = sorted((bands[b][1] * top, bands[b][0]) for b, top in unread.items() if b in bands)
    best = math.inf
    for k in range(len(open_) + 1):               # the k least sums as such, the rest by Cauchy-Schwarz
        best = min(best, sum(x for x, _ in open_[:k]) + math.sqrt(sum(s for _, s in open_[k:])))
    return best if open_ else 0.0


def reading_order(bands: dict[int, tuple[float, float]], sizes: dict) -> list[tuple[int, int, float]]:
    """``(band, level, ceiling after it)``: always the block next that lowers
    the ceiling most for its rows; levels of a band in turn."""
    left = {b: sorted((lv, *sizes[b, lv]) for x, lv in sizes if x == b) for b in bands}
    left = {b: x for b, x in left.items() if x}
    tops = {b: max(t for *_, t in x) for b, x in left.items()}
    out = []
    while left:
        now = ceiling(bands, tops)
        best = None
        for b, blocks in left.items():
            rest = {k: v for k, v in tops.items() if k != b} | ({b: max(t for *_, t in blocks[1:])} if blocks[1:] else {})
            then = ceiling(bands, rest)
            # bands whose next block changes nothing yet are read by size
            key = ((then - now) / blocks[0][1], blocks[0][1], b)
            if best is None or key < best[0]:
                best = (key, b, rest, then)
        _, b, tops, then = best
        out.append((b, left[b].pop(0)[0], then))
        if not left[b]:
            del left[b]
    return out


def search(request: Request, blocks: DataFrame, sizes: dict, vectors: DataFrame, ids: DataFrame, n: int,
           leave_out: int | None = None, allowed: DataFrame | None = None, first: float = FIRST_CEILING) -> list[tuple[int, float]]:
    """``(row_id, score)`` of the ``n`` (at most ``HELD``) best documents that
    share a term with the request, best first, with their exact scores.

    ``blocks(row_id, term, w, band, level)``; ``vectors(row_id, ids, ws)``
    and ``ids(term, term_id)`` score the survivors; ``allowed(row_id)`` is
    joined before anything is scored.
    """
    if n > HELD:
        raise ValueError(f"a pruned search answers at most {HELD} rows")
    spark = blocks.sparkSession
    order = reading_order(request.by_band(), sizes)
    query = spark.createDataFrame([(t, w) for t, _, w in request.terms], "term string, _qw double")
    goal = first
    while True:
        read = len(order) if goal <= 0 else next((i for i, x in enumerate(order, 1) if x[2] <= goal), len(order))
        top = order[read - 1][2] if read else 0.0
        met = partial_scores(blocks, query, order[:read], leave_out, allowed)
        found = [tuple(r) for r in met.orderBy(F.round("score", RANK_DECIMALS).desc(), F.col("row_id").desc()).limit(HELD + 1).collect()]
        nth = found[n - 1][1] if 0 < n <= len(found) else 0.0
        if top <= 0:                              # everything is read
            return found[:n]
        near = [row for row, score in found if score + top >= nth - MARGIN]
        if top < nth - MARGIN and len(near) <= HELD:
            exact = full_scores(near, vectors, ids, query).collect()
            return sorted(map(tuple, exact), key=lambda x: (-round(x[1], RANK_DECIMALS), -x[0]))[:n]
        goal = min(top / 2, nth - 2 * MARGIN) if nth > 2 * MARGIN else 0.0


def partial_scores(blocks: DataFrame, query: DataFrame, read: list, leave_out: int | None, allowed: DataFrame | None) -> DataFrame:
    """``(row_id, score)`` over the blocks ``read``."""
    upto: dict[int, int] = {}
    for band, level, _ in read:
        upto[band] = max(level, upto.get(band, 0))
    wanted = F.lit(False)
    for band, level in sorted(upto.items()):
        wanted = wanted | ((F.col("band") == band) & (F.col("level") <= level))
    rows = blocks.filter(wanted).select("row_id", "term", "w")
    if leave_out is not None:
        rows = rows.filter(F.col("row_id") != leave_out)
    if allowed is not None:
        rows = rows.join(allowed, "row_id", "left_semi")
    # one request's terms: at most the vocabulary
    return rows.join(F.broadcast(query), "term").groupBy("row_id").agg(F.sum(F.col("w") * F.col("_qw")).alias("score"))


def full_scores(rows: list[int], vectors: DataFrame, ids: DataFrame, query: DataFrame) -> DataFrame:
    """Exact scores of at most ``HELD`` rows; vectors are stored in the order
    of rows, so the literal filter skips most row groups."""
    known = query.join(ids.select("term", "term_id"), "term").select("term_id", "_qw")
    some = vectors.filter(F.col("row_id").isin(rows)).select("row_id", F.explode(F.arrays_zip("ids", "ws")).alias("v"))
    some = some.select("row_id", F.col("v.ids").alias("term_id"), F.col("v.ws").alias("w"))
    return some.join(F.broadcast(known), "term_id").groupBy("row_id").agg(F.sum(F.col("w") * F.col("_qw")).alias("score"))
