"""Title lookup: tiered resolution and suggestions.

Substring matching runs through an n-gram index instead of testing every
(query, title) pair: each catalogue row is indexed under the distinct
substrings of 1 to 8 characters of its title key.  A distinct
query text is looked up once, under the rarest of its longest grams (an
equi-join), and only those candidates are checked with the exact predicate.
Every title that contains the query contains that gram, so the result is
exact.  Long grams keep the candidates near the matches; short suggestion
queries, whose grams are in very many titles, are answered from the heads of
their lists (:func:`gram_heads`), which hold no more rows than are shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsim.functions.titles import normalise_query, query_grams, substring_grams
from reelsim.operators.similarity import maybe_broadcast

# Suggestion queries of up to so many characters are answered by heads.
HEAD_LENGTH = 4
HEAD_ROWS = 8


def gram_index(titles: DataFrame, key_col: str = "title_key") -> DataFrame:
    """``(gram, row_id)`` for the distinct indexed grams of each key."""
    return titles.select("row_id", F.explode(substring_grams(F.col(key_col))).alias("gram"))


def gram_heads(titles: DataFrame, rows: int = HEAD_ROWS) -> DataFrame:
    """``(gram, match_rank, row_id, title)``: of every substring of up to
    ``HEAD_LENGTH`` characters the first ``rows`` titles, those whose name
    starts with it before those that contain it, each in row order.  A title
    that repeats counts with its first row.  The limit is planned before the
    shuffle, so a gram of every name is ``rows`` rows per partition."""
    first = titles.groupBy("title").agg(F.min(F.struct("row_id", "name_only")).alias("f")).select("title", "f.*")
    grams = first.select("row_id", "title", "name_only", F.explode(substring_grams("name_only", range(1, HEAD_LENGTH + 1))).alias("gram"))
    grams = grams.withColumn("match_rank", F.when(F.col("name_only").startswith(F.col("gram")), 0).otherwise(1))
    w = Window.partitionBy("gram").orderBy("match_rank", "row_id")
    return (grams.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= rows)
                 .select("gram", "match_rank", "row_id", "title"))


def gram_frequency(index: DataFrame) -> DataFrame:
    """Rows per gram (combined map-side; a gram present in every title is
    one row per partition before the shuffle)."""
    return index.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def candidates(keys: DataFrame, index: DataFrame, freq: DataFrame, qid: str = "query_id",
               bounded: bool | None = None) -> DataFrame:
    """``(qid, row_id)`` of rows containing every key gram's rarest gram.

    ``keys(qid, grams array)``.  A query with a gram absent from the index
    has no candidates.  Queries are the small, size-checked side.
    """
    qk = keys.select(qid, F.explode("grams").alias("gram")).distinct()
    nkeys = qk.groupBy(qid).agg(F.count(F.lit(1)).alias("_nk"))
    known = qk.join(freq, "gram")
    chosen = (known.groupBy(qid)
                   .agg(F.min_by("gram", F.col("n")).alias("gram"), F.count(F.lit(1)).alias("_nf"))
                   .join(nkeys, qid)
                   .filter(F.col("_nf") == F.col("_nk"))
                   .select(qid, "gram"))
    return index.join(maybe_broadcast(chosen, bounded), "gram").select(qid, "row_id")


def resolve_titles(queries: DataFrame, titles: DataFrame, index: DataFrame, freq: DataFrame,
                   qid: str = "query_id", text_col: str = "text",
                   bounded: bool | None = None, short_circuit: bool = True,
                   keep=None) -> DataFrame:
    """Resolve free-text titles to catalogue rows.

    Tiers: 1 exact key; 2 exact name without year; 3 every query word is a
    substring of the name; 4 the query is a substring of the key.  The
    lowest tier that matches wins, then the lowest row_id.  Blank queries
    resolve to nothing.  ``titles(row_id, title_key, name_only)`` may hold
    several rows per key (the first one counts).
    Returns ``(qid, row_id, tier, matched_key)``.
    """
    keep = keep or (lambda df: df)
    # the normalised queries and the unresolved rest are each read several
    # times below; ``keep`` computes them once (cache or stored table)
    asked = keep(queries.select(qid, normalise_query(F.col(text_col)).alias("q"))
                        .filter(F.col("q") != ""))
    found = _resolve_texts(asked.select("q").distinct(), titles, index, freq, bounded, short_circuit, keep)
    return asked.join(found, "q").select(qid, "row_id", "tier", "matched_key")


def _resolve_texts(q: DataFrame, titles: DataFrame, index, freq, bounded: bool | None, short_circuit: bool, keep) -> DataFrame:
    """:func:`resolve_titles` for distinct texts ``q``: a text that many
    requests share is looked up once."""
    qid = "_text"
    q = q.select("q", F.col("q").alias(qid))
    t = titles.select("row_id", "title_key", "name_only")
    tier1 = q.join(t, q.q == t.title_key).select(qid, "row_id", F.lit(1).alias("tier"), "title_key")
    tier2 = q.join(t, q.q == t.name_only).select(qid, "row_id", F.lit(2).alias("tier"), "title_key")
    easy = tier1.unionByName(tier2)
    rest = q.join(easy.select(qid).distinct(), qid, "left_anti")
    if short_circuit:
        # common case: every query matched a key or a name exactly (two
        # equi-joins, checked with one small job); the substring tiers are
        # then not planned at all
        if rest.isEmpty():
            best = easy.groupBy(qid).agg(F.min(F.struct("tier", "row_id", "title_key")).alias("b"))
            return best.select(F.col(qid).alias("q"), "b.row_id", "b.tier", F.col("b.title_key").alias("matched_key"))
    rest = keep(rest)
    # the gram index is only built when it is needed
    index, freq = (x() if callable(x) else x for x in (index, freq))

    words = F.split(F.col("q"), r"(?U)\s+")
    k3 = rest.select(qid, F.flatten(F.transform(words, lambda w: query_grams(w))).alias("grams"))
    c3 = (candidates(k3, index, freq, qid, bounded).join(rest, qid).join(t, "row_id")
          .filter(F.forall(F.split(F.col("q"), r"(?U)\s+"), lambda w: F.col("name_only").contains(w)))
          .select(qid, "row_id", F.lit(3).alias("tier"), "title_key"))
    k4 = rest.select(qid, query_grams(F.col("q")).alias("grams"))
    c4 = (candidates(k4, index, freq, qid, bounded).join(rest, qid).join(t, "row_id")
          .filter(F.col("title_key").contains(F.col("q")))
          .select(qid, "row_id", F.lit(4).alias("tier"), "title_key"))

    allm = easy.unionByName(c3).unionByName(c4)
    best = allm.groupBy(qid).agg(F.min(F.struct("tier", "row_id", "title_key")).alias("b"))
    return best.select(F.col(qid).alias("q"), "b.row_id", "b.tier", F.col("b.title_key").alias("matched_key"))


def suggest_titles(queries: DataFrame, titles: DataFrame, index, freq, heads,
                   limit: int = HEAD_ROWS, qid: str = "query_id", text_col: str = "text",
                   min_chars: int = 0, bounded: bool | None = None) -> DataFrame:
    """Raw titles whose name starts with the query, then those whose name
    contains it, each in row order; first ``limit`` (V10, U1, T6, W7).

    Texts of up to ``HEAD_LENGTH`` characters join ``heads`` (a function of
    the limit), others the gram index (``index`` and ``freq``, functions too).
    ``min_chars`` is the input gate of the search box (F10; 2 there).
    Returns ``(qid, rank, row_id, title)``.
    """
    q = queries.select(qid, F.col(text_col).alias("_raw"), normalise_query(F.col(text_col)).alias("q"))
    q = q.filter((F.col("q") != "") & (F.length(F.coalesce(F.col("_raw"), F.lit(""))) >= min_chars))
    short = q.filter(F.length("q") <= HEAD_LENGTH).join(heads(limit), F.col("q") == F.col("gram"))
    keys = q.filter(F.length("q") > HEAD_LENGTH).select(F.col("q").alias("_text"), "q").distinct()
    grams = keys.select("_text", query_grams(F.col("q")).alias("grams"))
    t = titles.select("row_id", "title", "name_only")
    cand = (candidates(grams, index(), freq(), "_text", bounded).join(keys, "_text").join(t, "row_id")
            .filter(F.col("name_only").contains(F.col("q")))
            .withColumn("match_rank", F.when(F.col("name_only").startswith(F.col("q")), 0).otherwise(1)))
    # first-seen raw title per text (no-op on a title-deduplicated catalogue)
    first = cand.groupBy("q", "title").agg(F.min(F.struct("row_id", "match_rank")).alias("f"))
    first = first.select("q", "title", "f.row_id", "f.match_rank")
    w = Window.partitionBy("q").orderBy("match_rank", "row_id")
    top = first.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit)
    cols = [qid, "match_rank", "row_id", "title"]
    both = short.select(*cols).unionByName(q.join(top, "q").select(*cols))
    w = Window.partitionBy(qid).orderBy("match_rank", "row_id")
    return (both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
                .select(qid, "rank", "row_id", "title"))


def resolve_exact(queries: DataFrame, titles: DataFrame, qid: str = "query_id",
                  text_col: str = "text") -> DataFrame:
    """Notebook lookup (V12): lower-cased title equals the lower-cased
    query, no trimming, no tiers; first row.  ``(qid, row_id)``."""
    q = queries.select(qid, F.lower(F.col(text_col)).alias("_q"))
    t = titles.select("row_id", F.lower(F.col("title")).alias("_lk"))
    return q.join(t, q._q == t._lk).groupBy(qid).agg(F.min("row_id").alias("row_id"))
