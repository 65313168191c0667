"""Genre browse and genre lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsim.functions.genres import ALL_GENRES, genre_matches, genre_pieces
from reelsim.operators.order import dense_index
from reelsim.operators.similarity import maybe_broadcast, genre_hits


def genre_values(catalog: DataFrame, col: str = "genre_src") -> DataFrame:
    """One row per trimmed genre piece of every non-null genre string."""
    return (catalog.filter(F.col(col).isNotNull())
                   .select(F.explode(genre_pieces(F.col(col))).alias("genre")))


def genre_counts(catalog: DataFrame, col: str = "genre_src") -> DataFrame:
    """``(genre, count)`` (A10); the count combines map-side."""
    return genre_values(catalog, col).groupBy("genre").agg(F.count(F.lit(1)).alias("count"))


def top_genres(catalog: DataFrame, k: int = 12, col: str = "genre_src") -> DataFrame:
    """The ``k`` most frequent genres, ties by name."""
    return genre_counts(catalog, col).orderBy(F.desc("count"), "genre").limit(k)


def all_genres(catalog: DataFrame, col: str = "genre_src") -> DataFrame:
    """Distinct genre pieces (V9); order with ``orderBy("genre")`` (T5)."""
    return genre_values(catalog, col).distinct()


def genre_menu(catalog: DataFrame, col: str = "genre_src") -> DataFrame:
    """Menu entries: ``All`` first, then the genres in order.
    ``(position, genre)``, numbered without a single-partition window."""
    g = all_genres(catalog, col)
    entries = g.select(F.lit(1).alias("_grp"), "genre").unionByName(
        g.sparkSession.range(1).select(F.lit(0).alias("_grp"), F.lit(ALL_GENRES).alias("genre")))
    return dense_index(entries, ["_grp", "genre"]).select("position", "genre")


def by_genre(catalog: DataFrame, queries: DataFrame, n: int = 5, qid: str = "query_id",
             genre_col: str = "genre", titles_unique: bool = False) -> DataFrame:
    """Top-rated rows per genre query (V8): case-insensitive regex
    containment in the genre string, first row per title (W4), ratings
    desc with nulls last, then row order (T2).

    The query patterns are broadcast if they are few; the per-query limit is
    planned before the shuffle.  Returns catalogue columns + qid, rank.
    """
    pats = queries.select(qid, F.lower(F.col(genre_col)).alias("_pat"))
    # regex over distinct genre strings, equi-join back to the rows
    hits = genre_hits(catalog, pats, "_pat").join(maybe_broadcast(pats, None, 10_000), "_pat")
    if titles_unique:
        first = hits.drop("_pat")
    else:
        # first row per (query, title): min_by combines map-side
        first = (hits.groupBy(qid, "title")
                     .agg(F.min_by(F.struct(*[F.col(c) for c in catalog.columns]),
                                   F.col("row_id")).alias("r"))
                     .select(qid, "r.*"))
    w = Window.partitionBy(qid).orderBy(F.desc_nulls_last("ratings"), F.asc("row_id"))
    return first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
