"""Cosine scoring, top-n with zero-score padding, intra-list similarity.

J3, J7, V5, V14, T1, W8, F6-F8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsim.functions.genres import genre_matches, pattern_valid

# Rows of a query table that may be broadcast: (id, term, weight) rows are
# ~50 bytes, so 1M rows stay well under 100 MB per executor.
BROADCAST_QUERY_ROWS = 1_000_000
# Scores are ranked after rounding to this many decimals, so that equal
# scores summed in another order still tie (then row_id decides).
RANK_DECIMALS = 9
SCORE_DECIMALS = 4


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_QUERY_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (a bounded check: the
    job stops counting after ``max_rows + 1``)."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, bounded: bool | None = None,
                    max_rows: int = BROADCAST_QUERY_ROWS) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise a shuffle join
    (AQE splits skewed term partitions)."""
    if bounded is None:
        bounded = fits_broadcast(df, max_rows)
    return F.broadcast(df) if bounded else df


def cosine_scores(query_vecs: DataFrame, postings: DataFrame, qid: str = "query_id",
                  bounded: bool | None = None, exclude_col: str | None = None,
                  exclude_masked: bool = True) -> DataFrame:
    """``(qid, row_id, score)`` for every (query, document) sharing a term.

    Both sides are unit vectors, so cosine = dot product.  ``exclude_col``
    on the query side names a row to leave out (masked: dropped; not
    masked: kept with score -1).  The query side
    is broadcast (size-checked): postings stream through without a
    shuffle on ``term``, so a term in a third of all documents is no hot
    partition; the sum combines map-side before the shuffle on
    ``(qid, row_id)``.
    """
    extra = [exclude_col] if exclude_col else []
    q = query_vecs.select(qid, "term", F.col("w").alias("_qw"), *extra)
    q = maybe_broadcast(q, bounded)
    j = postings.select("row_id", "term", "w").join(q, "term")
    prod = F.col("w") * F.col("_qw")
    if exclude_col and exclude_masked:
        # leave the query's own row out before aggregating
        j = j.filter(F.col("row_id") != F.col(exclude_col))
    elif exclude_col:
        prod = F.when(F.col("row_id") == F.col(exclude_col), F.lit(None)).otherwise(prod)
    out = j.groupBy(qid, "row_id").agg(F.sum(prod).alias("score"))
    if exclude_col and not exclude_masked:
        # the masked row keeps score -1 (notebook behaviour)
        out = out.withColumn("score", F.coalesce(F.col("score"), F.lit(-1.0)))
    return out


def _rank_order(score: str = "score"):
    return [F.round(F.col(score), RANK_DECIMALS).desc(), F.col("row_id").desc()]


def top_n_per_query(scored: DataFrame, n: int, qid: str = "query_id") -> DataFrame:
    """First ``n`` rows per query by score desc, row_id desc.  Spark plans
    a partial ``WindowGroupLimit`` before the shuffle, so at most ``n`` rows
    per query and partition move."""
    w = Window.partitionBy(qid).orderBy(*_rank_order())
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


NO_FILTER = "\u0000"   # join key standing for "no genre filter"


# Broadcast bound for (genre value, pattern) match tables.
MATCH_TABLE_ROWS = 2_000_000


def genre_hits(catalog: DataFrame, patterns: DataFrame, key: str,
               all_key: str | None = None) -> DataFrame:
    """Catalogue rows joined to every pattern of ``patterns[key]`` their
    genre matches (case-insensitive regex; ``all_key`` matches every row,
    a missing genre matches nothing else).  A pattern that is no regex
    matches no row.

    The regex test runs over the *distinct* genre strings, not the rows
    (genre strings repeat across a catalogue); the rows then join the
    matches by equality on the genre string -- broadcast when the match
    table is within its bound, so a genre held by a third of all rows is
    no hot partition.
    """
    pats = patterns.select(key).distinct().filter(pattern_valid(key))
    values = catalog.select("genre_src").filter(F.col("genre_src").isNotNull()).distinct()
    cond = genre_matches(F.col("genre_src"), F.col(key))
    if all_key is not None:
        cond = cond | (F.col(key) == all_key)
    matches = values.join(maybe_broadcast(pats, None, 10_000), cond)
    hits = catalog.join(maybe_broadcast(matches, None, MATCH_TABLE_ROWS), "genre_src")
    if all_key is not None:
        # rows without a genre still pass "no filter"
        no_genre = catalog.filter(F.col("genre_src").isNull()).withColumn(key, F.lit(all_key))
        hits = hits.unionByName(no_genre)
    return hits


def filter_heads(catalog: DataFrame, filter_keys: DataFrame, m: int,
                 key: str = "filter_key") -> DataFrame:
    """Per distinct filter key, the ``m`` highest row_ids of catalogue rows
    passing it (``NO_FILTER`` = every row).  ``(filter_key, row_id)``.
    The per-key limit runs before the shuffle."""
    hits = genre_hits(catalog.select("row_id", "genre_src"), filter_keys, key, all_key=NO_FILTER)
    w = Window.partitionBy(key).orderBy(F.col("row_id").desc())
    return (hits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= m)
                .select(key, "row_id"))


def rank_with_padding(scored: DataFrame, queries: DataFrame, catalog: DataFrame, n: int,
                      qid: str = "query_id", exclude_col: str | None = None,
                      filter_col: str | None = None, exclude_masked: bool = True,
                      bounded: bool | None = None, filtered: bool = False) -> DataFrame:
    """Top ``n`` catalogue rows per query, padded with score-0 rows.

    Rows sharing no term with the query score 0 and still fill the list,
    ordered by row_id desc.  Instead of scoring every row, only the
    ``n + 1`` highest row_ids that pass the query's filter are added as
    score-0 candidates: if ``k`` zero rows are needed, at most ``n - k``
    scored rows and the excluded row precede them, so they are among
    those.  ``queries`` holds ``qid`` and optionally ``exclude_col`` (row
    to leave out) and ``filter_col`` (normalised genre regex or null; a
    request whose filter is no regex gets no rows).
    ``scored`` must already leave out excluded rows (see
    :func:`cosine_scores`); ``filtered`` says that it holds no row that a
    genre filter leaves out; with ``exclude_masked=False`` the excluded row
    instead stays in the list with score -1 (notebook behaviour, V12).
    """
    qcols = [qid] + [c for c in (exclude_col, filter_col) if c]
    q = queries.select(*qcols)
    if filter_col:
        q = q.filter(pattern_valid(filter_col))
    if filter_col and not filtered:
        # genre of each scored row; scored rows are the small side
        scored = (scored.join(maybe_broadcast(q.select(qid, filter_col), bounded), qid)
                        .join(catalog.select("row_id", "genre_src"), "row_id")
                        .filter(F.col(filter_col).isNull()
                                | genre_matches(F.col("genre_src"), F.col(filter_col)))
                        .select(qid, "row_id", "score"))
    top = top_n_per_query(scored, n, qid).drop("rank")

    m = n + (1 if exclude_col else 0)
    if filter_col:
        qk = q.withColumn("_fk", F.coalesce(F.col(filter_col), F.lit(NO_FILTER)))
        heads = filter_heads(catalog, qk.select(F.col("_fk").alias("filter_key")), m)
        pad = qk.join(heads, F.col("_fk") == F.col("filter_key")).drop("filter_key")
    else:
        # same m rows for every query: a bounded array, no join
        head_ids = (catalog.select("row_id").orderBy(F.col("row_id").desc()).limit(m)
                           .agg(F.collect_list("row_id")).scalar())
        pad = q.select("*", F.explode(head_ids).alias("row_id"))
    pad_score = F.lit(0.0)
    if exclude_col:
        if exclude_masked:
            pad = pad.filter(F.col("row_id") != F.col(exclude_col))
        else:
            pad_score = F.when(F.col("row_id") == F.col(exclude_col), F.lit(-1.0)).otherwise(0.0)
    pad = pad.select(qid, "row_id", pad_score.alias("score"))

    cand = (top.unionByName(pad).groupBy(qid, "row_id")
               .agg(F.max("score").alias("score")))
    return top_n_per_query(cand, n, qid)


def intra_list_similarity(members: DataFrame, postings: DataFrame,
                          list_col: str = "query_id") -> DataFrame:
    """ILS of every list: mean cosine over ordered pairs of distinct
    positions, 0.0 for lists shorter than 2 (V14).

    Closed form on unit vectors, no self-join of members:
    ``(|sum v|^2 - sum |v|^2) / (k (k - 1))``, one group-by on
    ``(list, term)`` and one on ``list``.  ``members(list_col, row_id)``
    keeps multiplicity.  Returns ``(list_col, k, ils)``.
    """
    m = members.select(list_col, "row_id")
    k = m.groupBy(list_col).agg(F.count(F.lit(1)).alias("k"))
    per_term = (postings.select("row_id", "term", "w").join(maybe_broadcast(m), "row_id")
                        .groupBy(list_col, "term")
                        .agg(F.sum("w").alias("s"), F.sum(F.col("w") * F.col("w")).alias("q")))
    per_list = per_term.groupBy(list_col).agg(
        (F.sum(F.col("s") * F.col("s")) - F.sum("q")).alias("offdiag"))
    out = k.join(per_list, list_col, "left")
    ils = F.when(F.col("k") >= 2, F.coalesce(F.col("offdiag"), F.lit(0.0))
                 / (F.col("k") * (F.col("k") - 1))).otherwise(F.lit(0.0))
    return out.select(list_col, "k", ils.alias("ils"))
