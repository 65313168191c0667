"""Offline evaluation.

The per-title loop of the source becomes one batch: the sample is a
query table, ``by_title`` answers all of it at once, and ILS, coverage and
mean score are aggregates over the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsim.functions.titles import title_key
from reelsim.operators.dedupe import keep_first
from reelsim.operators.profile import histogram
from reelsim.operators.similarity import intra_list_similarity
from reelsim.plans.model import QID, Recommender

# Fixed evaluation protocol: 50 titles, top 5, seed 42.
SAMPLE_SIZE = 50
SAMPLE_SEED = 42
TOP_N = 5


def sample_key(row_id: F.Column, seed: int = SAMPLE_SEED) -> F.Column:
    """Repeatable pseudo-random order: md5 of ``row_id-seed``."""
    return F.md5(F.concat(row_id.cast("string"), F.lit(f"-{seed}")))


def eval_sample(catalog: DataFrame, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """``min(size, rows)`` catalogue rows without replacement.
    A top-k on a hash key: one pass, no global sort."""
    return (catalog.select("row_id", "title")
                   .orderBy(sample_key(F.col("row_id"), seed), "row_id").limit(size))


def sample_queries(rec: Recommender, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    s = eval_sample(rec.catalog, size, seed)
    return s.select(F.col("row_id").alias(QID), F.col("title").alias("text"))


def list_members(results: DataFrame, rec: Recommender) -> DataFrame:
    """Recommended titles looked up again through the title index (J6):
    key -> first catalogue row.  Titles that are not in the index drop out."""
    first = keep_first(rec.catalog.select("row_id", "title_key"), ["title_key"])
    keyed = results.select(QID, "rank", title_key(F.col("title")).alias("title_key"))
    return keyed.join(first, "title_key").select(QID, "rank", "row_id")


def list_ils(results: DataFrame, rec: Recommender) -> DataFrame:
    """ILS per non-empty result list: ``(query_id, k, ils)``."""
    return intra_list_similarity(list_members(results, rec), rec.model.postings, QID)


def summary(results: DataFrame, rec: Recommender, score_col: str = "similarity_score") -> DataFrame:
    """One row: mean ILS over lists with ILS > 0 (A11), coverage % of
    distinct recommended titles (A12), mean of per-list mean scores (A13)
    and the notebook ILS mean over lists of >= 2 members, zeros included
    (A11b)."""
    ils = list_ils(results, rec)
    n_rows = rec.catalog.select(F.count(F.lit(1))).scalar()
    covered = results.select(F.count_distinct("title")).scalar()
    per_list = results.groupBy(QID).agg(F.avg(score_col).alias("m"))
    mean_score = per_list.select(F.avg("m")).scalar()
    agg = ils.agg(
        F.coalesce(F.avg(F.when(F.col("ils") > 0, F.col("ils"))), F.lit(0.0)).alias("mean_ils"),
        F.avg(F.when(F.col("k") >= 2, F.col("ils"))).alias("mean_ils_notebook"),
        F.count(F.lit(1)).alias("lists"))
    return agg.select("mean_ils", "mean_ils_notebook", "lists",
                      (covered / n_rows * 100).alias("coverage_pct"),
                      mean_score.alias("mean_score"))


def run(rec: Recommender, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED,
        n: int = TOP_N) -> tuple[DataFrame, DataFrame]:
    """Evaluate: the batch result and its summary row."""
    from reelsim.session import store_table
    # the batch result is read by several aggregates: store it once
    results = store_table(rec.by_title(sample_queries(rec, size, seed), n, bounded=True), "eval_results")
    return results, summary(results, rec)


def ils_histogram(results: DataFrame, rec: Recommender, bins: int = 15) -> DataFrame:
    """15-bin histogram of list ILS, lists with >= 2 members."""
    ils = list_ils(results, rec).filter(F.col("k") >= 2)
    return histogram(ils, "ils", bins)


def score_histogram(results: DataFrame, bins: int = 15, score_col: str = "similarity_score") -> DataFrame:
    """15-bin histogram of per-list mean scores."""
    return histogram(results.groupBy(QID).agg(F.avg(score_col).alias("m")), "m", bins)


def notebook_run(rec: Recommender, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED,
                 n: int = TOP_N) -> tuple[DataFrame, DataFrame]:
    """Notebook evaluation (V15b): exact lower-cased title lookup, the
    queried row kept with score -1 (V12), members looked up by lower-cased
    title, ILS mean over lists of >= 2 members with zeros (A11b), mean of
    per-list mean scores (A13), coverage of distinct titles (A12)."""
    from reelsim.operators.lookup import resolve_exact
    from reelsim.operators.similarity import cosine_scores, rank_with_padding
    from reelsim.session import store_table

    res = rec._keep(resolve_exact(sample_queries(rec, size, seed), rec.titles, QID))
    q = res.select(QID, F.col("row_id").alias("_self"))
    qv = rec.vectors_of_rows(res, bounded=True, keep_self=True)
    scored = cosine_scores(qv, rec.model.postings, QID, True, exclude_col="_self", exclude_masked=False)
    ranked = rank_with_padding(scored, q, rec.catalog, n, QID, exclude_col="_self",
                               exclude_masked=False, bounded=True)
    results = store_table(rec._results(ranked, score_col="score", bounded=True), "nb_eval")
    first = keep_first(rec.catalog.select("row_id", F.lower("title").alias("lk")), ["lk"])
    members = (results.select(QID, "rank", F.lower("title").alias("lk"))
                      .join(first, "lk").select(QID, "rank", "row_id"))
    ils = intra_list_similarity(members, rec.model.postings, QID)
    n_rows = rec.catalog.select(F.count(F.lit(1))).scalar()
    covered = results.select(F.count_distinct("title")).scalar()
    mean_score = results.groupBy(QID).agg(F.avg("score").alias("m")).select(F.avg("m")).scalar()
    summ = ils.agg(F.avg(F.when(F.col("k") >= 2, F.col("ils"))).alias("mean_ils"),
                   F.count(F.lit(1)).alias("lists")).select(
        "mean_ils", "lists", (covered / n_rows * 100).alias("coverage_pct"), mean_score.alias("mean_score"))
    return results, summ
