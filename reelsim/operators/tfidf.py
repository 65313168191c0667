"""TF-IDF and bag-of-words as plain DataFrames.

Model tables:
  vocabulary(term, df, cf, idf)      at most ``max_features`` rows
  postings(row_id, term, tf, w)      one row per non-zero; ``w`` is the
                                     L2-normalised weight of the term

Plan shape of :func:`fit`: documents are hash-partitioned on ``row_id``
once; term counts (group by row_id, term) and the per-document norm reuse
that partitioning, so the only other shuffle is the partial-aggregated
document-frequency count on ``term``.  Two passes: the vocabulary first, then
the counts of its terms alone, so the counts of all terms are never kept.
A stored catalogue is counted row by row instead (:func:`fit_rows`).
The vocabulary is capped by ``max_features`` -- a proven bound -- and is
broadcast to weigh postings; without a cap it is joined as the planner sees fit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsim.functions.text import bigrams, uni_bi_grams
from reelsim.operators import counting

MAX_FEATURES = 20_000
MIN_DF = 2


@dataclass
class TfidfModel:
    vocabulary: DataFrame   # term, df, cf, idf
    postings: DataFrame     # row_id, term, tf, w
    n_docs: Column          # lazy scalar: documents the model was fitted on
    sublinear_tf: bool = True
    use_idf: bool = True
    norm: bool = True
    weigh: Callable[[DataFrame], DataFrame] | None = None   # postings from a (stored) vocabulary
    by_row: Callable[[DataFrame, list], DataFrame] | None = None   # vectors of stored rows (fit_rows)

    def persist(self) -> "TfidfModel":
        self.vocabulary = self.vocabulary.persist()
        self.postings = self.postings.persist()
        return self


def term_counts(docs: DataFrame, terms_col: str = "terms", id_col: str = "row_id") -> DataFrame:
    """``(row_id, term, tf)``: count of each term in each document (A1).

    ``docs`` should already be partitioned on ``id_col``; grouping on
    ``(id_col, term)`` is then satisfied without another exchange.
    """
    return (docs.select(id_col, F.explode(terms_col).alias("term"))
                .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def select_vocabulary(tf: DataFrame, min_df: int = MIN_DF,
                      max_features: int | None = MAX_FEATURES) -> DataFrame:
    """Document and corpus frequency; keep ``df >= min_df`` then the
    ``max_features`` terms of largest ``cf`` (ties: term, binary order)
    (A2, A3).  The cut is a top-k, not a full sort."""
    parts = tf.select("term", F.lit(1).cast("long").alias("df"), F.col("tf").alias("cf"))
    return cut_vocabulary(parts, min_df, max_features)


def vocabulary_cut(parts: DataFrame, min_df: int, max_features: int) -> tuple[DataFrame, Column]:
    """``(term, df, cf)`` summed from partial counts, with ``df >= min_df``,
    and the cf of the last of ``max_features`` terms (null if fewer)."""
    stats = _summed(parts, min_df)
    # Exact filter before the top-k: the cf of the max_features-th term is
    # the largest cf whose running count of terms (from the top) reaches
    # max_features.  Only terms at or above it can be in the vocabulary, so
    # the top-k merges about max_features rows instead of partitions x
    # max_features.  The running count goes over the distinct cf values; as
    # they sum to at most the number of tokens T, there are fewer than
    # sqrt(2 T) of them.
    per_cf = stats.groupBy("cf").agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(Window.orderBy(F.desc("cf"))
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return stats, (per_cf.withColumn("_cum", running).filter(F.col("_cum") >= max_features)
                         .agg(F.max("cf")).scalar())


def _summed(parts: DataFrame, min_df: int) -> DataFrame:
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter(F.col("df") >= min_df)


def cut_vocabulary(parts: DataFrame, min_df: int = MIN_DF, max_features: int | None = MAX_FEATURES) -> DataFrame:
    """:func:`select_vocabulary` of partial counts ``(term, df, cf)``."""
    if max_features is None:
        return _summed(parts, min_df)
    stats, cut = vocabulary_cut(parts, min_df, max_features)
    stats = stats.filter(F.col("cf") >= F.coalesce(cut, F.lit(0)))
    return stats.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)


def smooth_idf(df: Column, n_docs: Column) -> Column:
    """``ln((1 + N) / (1 + df)) + 1`` (A4)."""
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def tf_weight(tf: Column, sublinear: bool = True) -> Column:
    """``1 + ln(tf)`` when sublinear (X17), else the raw count."""
    return (F.lit(1.0) + F.log(tf)) if sublinear else tf.cast("double")


def _weigh(tf: DataFrame, vocabulary: DataFrame, sublinear: bool, use_idf: bool,
           norm: bool, id_col: str, capped: bool = False) -> DataFrame:
    # a capped vocabulary has at most max_features rows: broadcast is size-bounded
    known = vocabulary.select("term", "idf")
    joined = tf.join(F.broadcast(known) if capped else known, "term")
    raw = tf_weight(F.col("tf"), sublinear) * (F.col("idf") if use_idf else F.lit(1.0))
    joined = joined.withColumn("_raw", raw)
    if norm:
        # same partitioning as tf (hash on id_col): no extra shuffle
        l2 = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(id_col)))
        joined = joined.withColumn("w", F.col("_raw") / l2)
    else:
        joined = joined.withColumn("w", F.col("_raw"))
    return joined.select(id_col, "term", "tf", "w")


def fit(docs: DataFrame, terms_col: str = "terms", min_df: int = MIN_DF,
        max_features: int | None = MAX_FEATURES, sublinear_tf: bool = True,
        use_idf: bool = True, norm: bool = True, id_col: str = "row_id",
        num_partitions: int | None = None,
        to_terms: Callable[[Column], Column] | None = None,
        n_docs: Column | None = None) -> TfidfModel:
    """Fit TF-IDF on ``docs(row_id, terms array)`` (V3; V2 with
    ``use_idf=False, norm=False, sublinear_tf=False``).

    ``to_terms`` turns ``terms_col`` into the term array *after* the
    repartition on ``row_id`` (ship tokens, not the larger n-gram arrays).
    ``N`` counts every fitted document, also those left without any
    vocabulary term; pass ``n_docs`` when it is already known.
    """
    parts = [num_partitions] if num_partitions else []
    docs = docs.select(id_col, terms_col).repartition(*parts, id_col)
    if to_terms is not None:
        docs = docs.select(id_col, to_terms(F.col(terms_col)).alias(terms_col))
    if n_docs is None:
        n_docs = docs.select(F.count(F.lit(1))).scalar()
    tf = term_counts(docs, terms_col, id_col)
    vocab = select_vocabulary(tf, min_df, max_features)
    vocab = vocab.withColumn("idf", smooth_idf(F.col("df"), n_docs)) if use_idf \
        else vocab.withColumn("idf", F.lit(1.0))

    def weigh(vocabulary: DataFrame) -> DataFrame:
        # at most max_features rows; without that cap the planner decides
        known = vocabulary.select("term")
        known = F.broadcast(known) if max_features else known
        kept = (docs.select(id_col, F.explode(terms_col).alias("term")).join(known, "term", "left_semi")
                    .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
        return _weigh(kept, vocabulary, sublinear_tf, use_idf, norm, id_col, bool(max_features))

    return TfidfModel(vocab, weigh(vocab), n_docs, sublinear_tf, use_idf, norm, weigh=weigh)


def fit_rows(docs: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES, sublinear_tf: bool = True,
             id_col: str = "row_id", n_docs: Column | None = None) -> TfidfModel:
    """:func:`fit` on a *stored* ``docs(row_id, tokens)`` (a list, or one string
    with blanks between the tokens), terms being words and bigrams, counted row by row (``operators.counting``).  Rows that share
    an id are one document: they go through :func:`fit`'s counting.
    ``by_row(docs with genre_id, terms)`` and ``weigh`` (for the ids that
    repeat; None if there are none) make the postings."""
    repeated = counting.repeated_ids(docs.select(id_col), id_col)
    odd = None
    single = docs.select(id_col, "tokens")
    if not repeated.isEmpty():
        same = F.col(id_col).eqNullSafe(F.col("_id"))
        odd, single = single.join(repeated, same, "left_semi"), single.join(repeated, same, "left_anti")

    tokens = F.col("tokens")
    if docs.schema["tokens"].dataType.simpleString() == "string":
        tokens = F.when(tokens != "", F.split(tokens, " ")).otherwise(F.array().cast("array<string>"))

    def parts(known: list[str] | None, pairs: bool) -> DataFrame:
        out = counting.term_stats(single, "tokens", known, pairs)
        if odd is None:
            return out
        terms = (bigrams(tokens) if known else uni_bi_grams(tokens)) if pairs else tokens
        rest = term_counts(odd.select(id_col, terms.alias("terms")), "terms", id_col)
        return out.unionByName(rest.select("term", F.lit(1).cast("long").alias("df"), F.col("tf").alias("cf")))

    # words first: their cut is a floor under that of all terms
    words, floor = vocabulary_cut(parts(None, False), min_df, max_features)
    frequent = words.filter((F.col("cf") >= F.coalesce(floor, F.lit(0))) | F.col("term").contains(" "))
    sent = [tuple(r) for r in frequent.select("term", "df", "cf").limit(counting.SENT_WORDS + 1).collect()]
    # fewer words than features (no floor), too many, or lemmas of several words: every bigram counts
    known = [w for w, *_ in sent] if max_features <= len(sent) <= counting.SENT_WORDS and not any(" " in w for w, *_ in sent) else None
    counted = parts(known, True)
    if known:
        # words of a cf under the floor are not among the terms, the others are counted
        counted = counted.unionByName(docs.sparkSession.createDataFrame(sent, "term string, df long, cf long"))
    vocab = cut_vocabulary(counted, min_df, max_features).withColumn("idf", smooth_idf(F.col("df"), n_docs))

    def weigh(vocabulary: DataFrame) -> DataFrame:
        terms = odd.select(id_col, F.explode(uni_bi_grams(tokens)).alias("term"))
        kept = terms.join(F.broadcast(vocabulary.select("term")), "term", "left_semi")
        return _weigh(kept.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")), vocabulary, sublinear_tf, True, True, id_col, True)

    def by_row(rows: DataFrame, terms: list[tuple[str, int, float]]) -> DataFrame:
        if odd is not None:
            rows = rows.join(repeated, F.col(id_col).eqNullSafe(F.col("_id")), "left_anti")
        return counting.by_document(rows, terms, sublinear_tf, True, "tokens", id_col)

    return TfidfModel(vocab, None, n_docs, sublinear_tf, weigh=weigh if odd is not None else None, by_row=by_row)


def bag_of_words(model: TfidfModel) -> TfidfModel:
    """The bag-of-words model (V2) over a fitted model's vocabulary, with
    counts as weights.  Neither the vocabulary nor the counts depend on the
    weighting, so nothing is fitted again."""
    return TfidfModel(model.vocabulary.withColumn("idf", F.lit(1.0)),
                      model.postings.withColumn("w", F.col("tf").cast("double")),
                      model.n_docs, sublinear_tf=False, use_idf=False, norm=False)


def round_weight(w: str | Column, digits: int) -> Column:
    """``F.round``, which goes through a decimal for every value, only where a
    tie may be near; elsewhere the nearest whole number is the same one."""
    w = F.col(w) if isinstance(w, str) else w
    at = w * F.lit(10.0 ** digits)
    plain = (w >= 0) & (at < 1e8) & (F.abs(at - F.floor(at) - F.lit(0.5)) > 1e-6)
    return F.when(plain, F.floor(at + F.lit(0.5)) / F.lit(10.0 ** digits)).otherwise(F.round(w, digits))


def top_terms(postings: DataFrame, k: int) -> DataFrame:
    """``(row_id, kind, rank, term, value)``: every document's ``k`` terms of
    the largest count (``bow``) and of the largest weight (``tfidf``), ties
    by term (T4, V16).  One fold per document, over its own terms, gives
    both lists, so the postings are shuffled once."""
    both = postings.groupBy("row_id").agg(
        F.collect_list(F.struct((-F.col("tf")).alias("by"), "term", F.col("tf").cast("double").alias("value"))).alias("bow"),
        F.collect_list(F.struct((-F.round("w", 9)).alias("by"), "term", F.round("w", 6).alias("value"))).alias("tfidf"))
    head = lambda c: F.transform(F.slice(F.sort_array(c), 1, k), lambda x, i: F.struct(
        F.lit(c).alias("kind"), (i + 1).alias("rank"), x["term"].alias("term"), x["value"].alias("value")))
    return both.select("row_id", F.inline(F.concat(head("bow"), head("tfidf"))))


def transform(model: TfidfModel, docs: DataFrame, terms_col: str = "terms",
              id_col: str = "query_id") -> DataFrame:
    """Weigh new documents (queries) with a fitted vocabulary (V4):
    out-of-vocabulary terms drop out (J4), same tf weighting and norm.
    Returns ``(id_col, term, tf, w)``."""
    tf = term_counts(docs.select(id_col, terms_col), terms_col, id_col)
    return _weigh(tf, model.vocabulary, model.sublinear_tf, model.use_idf, model.norm, id_col)


def docs_from_tokens(df: DataFrame, tokens_col: str = "tokens", id_col: str = "row_id") -> DataFrame:
    """``(row_id, terms)`` with unigrams and bigrams of a token column (V1)."""
    return df.select(id_col, uni_bi_grams(F.col(tokens_col)).alias("terms"))


def sparsity_pct(n_rows: Column, n_features: Column, nnz: Column) -> Column:
    """``100 * (1 - nnz / (rows * features))``."""
    return F.lit(100.0) * (F.lit(1.0) - nnz / (n_rows * n_features))
