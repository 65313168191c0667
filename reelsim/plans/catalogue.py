"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Every query reads the provided tables (``films`` is derived from
``documents`` and ``part``) and runs over all of them.  Query inputs are
taken from the data (first title, a seeded sample, every title, every
genre) or are the fixed demo strings of the source project.
Column names match ``reelsim.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsim.functions import display as D
from reelsim.functions.text import bigrams, clean_text, word_count
from reelsim.functions.titles import display_with_year, year
from reelsim.operators import browse, tfidf
from reelsim.operators.dedupe import keep_first
from reelsim.operators.lemma import lemmatise_nouns, lemmatise_with_table
from reelsim.operators.lookup import resolve_exact
from reelsim.operators.profile import duplicate_count, histogram, null_counts
from reelsim.plans import evaluate, present
from reelsim.plans.model import QID, ModelParams, Recommender
from reelsim.plans.prepare import TextParams
from reelsim.session import scratch_path
from reelsim.sources import catalog_io
from reelsim.sources.tables import films

# Fixed demo inputs of the source notebook and app.
DEMO_QUERY = "space adventure unlikely hero saving galaxy"
UNKNOWN_QUERY = "qwxyz zyxwq"
STOPWORD_QUERY = "the and of"
DEMO_GENRE_FILTER = "economy"
# Filters of one batch: none (two forms), a word, an alternative, an anchor,
# and one that is no regex and gets no rows.
DEMO_FILTERS = ("All", "", "economy", "steel|BRASS", "^en", "sci-fi (")
# Example lexicon for the lemma step (form -> lemma).
DEMO_LEXICON = {"heroes": "hero", "movies": "movie", "things": "thing", "stories": "story"}

FILM_COLUMNS = ["row_id", "title", "description", "ratings", "genre", "expanded_genres"]
REC_COLUMNS = [QID, "rank", "row_id", "title", "ratings", "similarity_score"]


_FITTED: dict = {}


def _rec(spark: SparkSession, sf: str, **kw) -> Recommender:
    """Fitted model for (session, tables, parameters), fitted once and
    materialised in the checkpoint folder, then shared by the queries."""
    key = (spark.sparkContext.applicationId, sf, repr(sorted(kw.items())))
    if key not in _FITTED:
        dedupe = kw.get("dedupe", True)
        params = {k: v for k, v in kw.items() if k != "dedupe"}
        _FITTED[key] = Recommender.fit(films(spark, sf), ModelParams(**params),
                                       dedupe=dedupe, materialize=True)
    return _FITTED[key]


def _long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


def _rec_out(df: DataFrame) -> DataFrame:
    return _long(df.select(*REC_COLUMNS), QID, "rank")


def _first_title(rec: Recommender) -> DataFrame:
    return rec.catalog.orderBy("row_id").limit(1).select(F.lit(0).cast("long").alias(QID),
                                                         F.col("title").alias("text"))


# ---- sources, profiles, preparation -------------------------------------
def q_normalise_catalog(spark, sf):
    return films(spark, sf)


def q_null_profile(spark, sf):
    return null_counts(films(spark, sf), FILM_COLUMNS)


def q_duplicate_titles(spark, sf):
    return films(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"),
                                duplicate_count("title").cast("long").alias("duplicate_titles"))


def q_prep_lineage(spark, sf):
    return _long(_rec(spark, sf).lineage(films(spark, sf)), "rows_raw", "dropped_null_description",
                 "dropped_duplicates", "dropped_blank_text", "rows_retained")


def q_dedupe_titles(spark, sf):
    f = films(spark, sf)
    return keep_first(f.filter(F.col("description").isNotNull()), ["title"]).select("row_id", "title")


def q_title_index(spark, sf):
    rec = _rec(spark, sf)
    return keep_first(rec.titles, ["title_key"]).select("title_key", "name_only", "row_id")


def q_clean_text(spark, sf):
    return _rec(spark, sf).catalog.select("row_id", "clean_description")


def q_lemmatised_tokens(spark, sf):
    rec = _rec(spark, sf, text=TextParams(lexicon=DEMO_LEXICON))
    return rec.catalog.select("row_id", "clean_description")


def q_lemmatised_by_table(spark, sf):
    """The lemma step through a lexicon table."""
    lexicon = spark.createDataFrame(sorted(DEMO_LEXICON.items()), "form string, lemma string")
    c = lemmatise_with_table(_rec(spark, sf).catalog.select("row_id", "tokens"), lexicon)
    return c.select("row_id", F.array_join("tokens", " ").alias("clean_description"))


def q_lemmatised_nouns(spark, sf):
    """Plurals to singulars (J9): the lexicon is derived from the catalogue
    (words of two rows at least that do not end in s), irregular forms come
    from the demo table."""
    c = _rec(spark, sf).catalog.select("row_id", "tokens")
    words = c.select(F.explode(F.array_distinct("tokens")).alias("lemma")).filter(~F.col("lemma").endswith("s"))
    lemmas = words.groupBy("lemma").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    exceptions = spark.createDataFrame(sorted(DEMO_LEXICON.items()), "form string, lemma string")
    out = lemmatise_nouns(c, lemmas, exceptions)
    return out.select("row_id", F.array_join("tokens", " ").alias("clean_description"))


def q_desc_length_stats(spark, sf):
    wc = films(spark, sf).select(word_count("description").alias("n"))
    return wc.agg(F.count("n").alias("n_described"), F.round(F.avg("n"), 6).alias("avg_words"),
                  F.min("n").cast("long").alias("min_words"), F.max("n").cast("long").alias("max_words"))


def _hist_out(h: DataFrame) -> DataFrame:
    return h.select(F.col("bin").cast("long").alias("bin"), F.round("lo", 6).alias("lo"),
                    F.round("hi", 6).alias("hi"), "count")


def q_desc_length_hist(spark, sf):
    return _hist_out(histogram(films(spark, sf), word_count("description"), 50))


def q_genre_counts_top12(spark, sf):
    return browse.top_genres(films(spark, sf), 12)


def q_all_genres(spark, sf):
    return _rec(spark, sf).all_genres()


def q_genre_menu(spark, sf):
    return _long(browse.genre_menu(_rec(spark, sf).catalog), "position")


def q_title_years(spark, sf):
    f = films(spark, sf)
    return f.select("row_id", display_with_year("title").alias("display"),
                    year("title").cast("long").alias("year"))


# ---- text model ----------------------------------------------------------
def q_bigrams(spark, sf):
    c = _rec(spark, sf).catalog
    return _long(c.select("row_id", F.posexplode(bigrams(F.col("tokens"))).alias("pos", "bigram")), "pos")


def q_bow_terms(spark, sf):
    bow = tfidf.bag_of_words(_rec(spark, sf).model)
    return bow.postings.select("row_id", "term", F.col("w").cast("long").alias("n"))


def q_vocabulary(spark, sf):
    v = _rec(spark, sf).model.vocabulary
    return v.select("term", "df", F.col("cf").cast("long").alias("cf"), F.round("idf", 9).alias("idf"))


def _weights(p: DataFrame) -> DataFrame:
    return _long(p.select("row_id", "term", "tf", tfidf.round_weight("w", 6).alias("w")), "tf")


def q_tfidf_weights(spark, sf):
    return _weights(_rec(spark, sf).model.postings)


def q_raw_tfidf_weights(spark, sf):
    return _weights(_rec(spark, sf, dedupe=False, tokenizer="raw").model.postings)


def q_top_terms_bow_vs_tfidf(spark, sf):
    return _long(tfidf.top_terms(_rec(spark, sf, dedupe=False).model.postings, 10), "rank")


# ---- lookup ------------------------------------------------------------
def _title_variants(rec: Recommender) -> DataFrame:
    t = keep_first(rec.titles, ["title_key"])
    rid = F.col("row_id") * 10
    v1 = t.select((rid + 1).alias(QID), F.concat(F.lit("  "), F.upper("title"), F.lit(" ")).alias("text"))
    v2 = t.select((rid + 2).alias(QID), F.col("name_only").alias("text"))
    v3 = t.select((rid + 3).alias(QID), F.array_join(F.reverse(F.split("name_only", " ")), " ").alias("text"))
    v4 = t.select((rid + 4).alias(QID), F.substring("title_key", -8, 8).alias("text"))
    return v1.unionByName(v2).unionByName(v3).unionByName(v4)


def q_resolve_titles(spark, sf):
    rec = _rec(spark, sf)
    return _long(rec.resolve(_title_variants(rec), bounded=False).select(QID, "row_id", "tier"), "tier")


def _suggest_words(rec: Recommender) -> DataFrame:
    return (rec.catalog.select(F.explode(F.split("name_only", " ")).alias("text"))
               .filter(F.col("text") != "").distinct()
               .select(F.col("text").alias("query"), "text"))


def q_title_suggestions(spark, sf):
    rec = _rec(spark, sf)
    from reelsim.operators.lookup import suggest_titles
    s = suggest_titles(_suggest_words(rec), rec.titles, lambda: rec.index, lambda: rec.freq, rec.heads, 8, "query", bounded=False)
    return _long(s, "rank")


# ---- recommendations ---------------------------------------------------
def _title_of_first(rec: Recommender) -> str:
    return rec.catalog.select("row_id", "title").orderBy("row_id").first()["title"]


def q_recommend_by_title(spark, sf):
    rec = _rec(spark, sf)
    return _rec_out(rec.recommend_by_title(_title_of_first(rec)))


def q_recommend_by_title_genre(spark, sf):
    rec = _rec(spark, sf)
    return _rec_out(rec.recommend_by_title(_title_of_first(rec), DEMO_GENRE_FILTER))


def q_recommend_by_title_filters(spark, sf):
    """One title under several genre filters in one batch."""
    rec = _rec(spark, sf)
    gf = F.posexplode(F.array(*map(F.lit, DEMO_FILTERS))).alias(QID, "gf")
    q = _long(_first_title(rec).select("text", gf), QID)
    return _rec_out(rec.by_title(q, 10, filter_col="gf", bounded=True))


def q_recommend_many(spark, sf):
    """A list longer than a small catalogue: every other row, ranked."""
    rec = _rec(spark, sf)
    return _rec_out(rec.by_title(_first_title(rec), 2000, bounded=True))


def _asked(rec: Recommender) -> DataFrame:
    """Requests of the batch searches: every row whose id is divisible by
    20."""
    return rec.catalog.filter(F.col("row_id") % 20 == 0)


def _batch_by_title(rec: Recommender) -> DataFrame:
    return rec.by_title(_asked(rec).select(F.col("row_id").alias(QID), F.col("title").alias("text")), 5, bounded=False)


def q_recommend_batch(spark, sf):
    return _rec_out(_batch_by_title(_rec(spark, sf)))


def _asked_descriptions(rec: Recommender) -> DataFrame:
    return _asked(rec).select(F.col("row_id").alias(QID), F.col("description").alias("text"))


def q_recommend_by_description(spark, sf):
    rec = _rec(spark, sf)
    return _rec_out(rec.by_description(_asked_descriptions(rec), 5, bounded=False))


def q_recommend_by_description_genre(spark, sf):
    rec = _rec(spark, sf)
    q = _asked_descriptions(rec).withColumn("gf", F.lit(DEMO_GENRE_FILTER))
    return _rec_out(rec.by_description(q, 5, filter_col="gf", bounded=False))


def _fixed_query(rec: Recommender, text: str) -> DataFrame:
    # one request, shaped from the catalogue's first row
    return rec.catalog.orderBy("row_id").limit(1).select(F.lit(0).cast("long").alias(QID),
                                                         F.lit(text).alias("text"))


def q_recommend_by_description_unknown(spark, sf):
    return _rec_out(_rec(spark, sf).recommend_by_description(UNKNOWN_QUERY))


def q_recommend_by_description_stopwords(spark, sf):
    return _rec_out(_rec(spark, sf).recommend_by_description(STOPWORD_QUERY))


def q_recommend_by_genre(spark, sf):
    rec = _rec(spark, sf)
    g = rec.all_genres().select(F.col("genre").alias("query"), "genre")
    r = browse.by_genre(rec.catalog.select("row_id", "title", "description", "ratings", "genre_src"),
                        g.withColumnRenamed("genre", "pattern"), 5, "query", "pattern",
                        titles_unique=True)
    return _long(r.select("query", "rank", "row_id", "title", "ratings"), "rank")


def _nb_rec(spark, sf) -> Recommender:
    return _rec(spark, sf, dedupe=False)


def q_notebook_recommend_title(spark, sf):
    rec = _nb_rec(spark, sf)
    res = resolve_exact(_first_title(rec), rec.titles)
    q = res.select(QID, F.col("row_id").alias("_self"))
    from reelsim.operators.similarity import cosine_scores, rank_with_padding
    qv = rec.vectors_of_rows(res, bounded=True, keep_self=True)
    scored = cosine_scores(qv, rec.model.postings, QID, bounded=True, exclude_col="_self",
                           exclude_masked=False)
    ranked = rank_with_padding(scored, q, rec.catalog, 5, QID, exclude_col="_self",
                               exclude_masked=False, bounded=True)
    out = rec._results(ranked, score_col="score", bounded=True)
    return _long(out.select(QID, "rank", "row_id", "title", "score"), QID, "rank")


def q_notebook_recommend_query(spark, sf):
    rec = _nb_rec(spark, sf)
    out = rec.by_description(_fixed_query(rec, DEMO_QUERY), 5, bounded=True, skip_empty=False)
    return _long(out.select(QID, "rank", "row_id", "title", F.col("similarity_score").alias("score")),
                 QID, "rank")


# ---- evaluation ----------------------------------------------------------
def q_eval_sample(spark, sf):
    return evaluate.eval_sample(_rec(spark, sf).catalog)


def q_intra_list_similarity(spark, sf):
    rec = _rec(spark, sf)
    ils = evaluate.list_ils(_batch_results(spark, sf), rec)
    return ils.select(QID, "k", F.round("ils", 6).alias("ils"))


def q_eval_summary(spark, sf):
    rec = _rec(spark, sf)
    res, summ = evaluate.run(rec)
    return summ.select(F.round("mean_ils", 6).alias("mean_ils"),
                       F.round("mean_ils_notebook", 6).alias("mean_ils_notebook"),
                       "lists", F.round("coverage_pct", 6).alias("coverage_pct"),
                       F.round("mean_score", 6).alias("mean_score"))


def q_ils_hist(spark, sf):
    return _hist_out(evaluate.ils_histogram(_batch_results(spark, sf), _rec(spark, sf)))


def q_model_stats(spark, sf):
    return _long(_rec(spark, sf).stats(), "total_movies", "tfidf_features", "total_genres")


# ---- presentation --------------------------------------------------------
def _batch_results(spark, sf) -> DataFrame:
    """Evaluation batch (50 sampled titles, top 5), stored once: several
    aggregates read it."""
    from reelsim.session import store_table
    rec = _rec(spark, sf)
    return store_table(rec.by_title(evaluate.sample_queries(rec), 5, bounded=True), "eval_results")


def _asked_results(spark, sf) -> DataFrame:
    """Answers to every twentieth row, stored once."""
    from reelsim.session import store_table
    return store_table(_batch_by_title(_rec(spark, sf)), "batch_results")


def q_result_cards(spark, sf):
    return present.result_cards(_asked_results(spark, sf))


def q_score_table(spark, sf):
    return present.score_table(_asked_results(spark, sf), scored=True)


def q_match_chart(spark, sf):
    return present.match_chart(_asked_results(spark, sf))


# ---- round trips -----------------------------------------------------------
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "films-csv")
    catalog_io.write_csv(films(spark, sf, normalised=False), path)
    back = catalog_io.read_csv(spark, path)
    return catalog_io.normalise(back)


def q_csv_split_load(spark, sf):
    """Two CSV splits without ids, several files each: numbered in source
    order (S1, S5).  The splits hold the whole table between them."""
    f = films(spark, sf, normalised=False)
    last = F.col("row_id") % 5 == 4
    paths = {}
    for name, rows in (("train", f.filter(~last)), ("validation", f.filter(last))):
        paths[name] = catalog_io.write_csv(rows.orderBy("row_id").drop("row_id"), scratch_path(spark, name))
    return catalog_io.normalise(catalog_io.load_splits(spark, paths, fmt="csv", ordered=True))


def q_column_rename_cases(spark, sf):
    """Tables whose columns need renames and trims, have one genre column
    under another name, or none, and no rating (S2, S3, S6, S7, F4, F5)."""
    f = films(spark, sf, normalised=False)
    one = f.select("row_id", F.col("title").alias("movie title - year"), F.col("description").alias(" description "),
                   F.col("ratings").alias("rating "), F.col("expanded_genres").alias("genres"))
    two = f.select("row_id", "title", "description")
    return (catalog_io.normalise(one).withColumn("kind", F.lit("renamed"))
            .unionByName(catalog_io.normalise(two).withColumn("kind", F.lit("bare"))))


def q_model_roundtrip(spark, sf):
    path = scratch_path(spark, "model")
    _rec(spark, sf).save(path)
    return _long(Recommender.load(spark, path).stats(), "total_movies", "tfidf_features", "total_genres")


def q_model_roundtrip_search(spark, sf):
    """A search on a model that was written and read back."""
    path = scratch_path(spark, "model")
    rec = _rec(spark, sf)
    rec.save(path)
    return _rec_out(Recommender.load(spark, path).recommend_by_title(_title_of_first(rec)))


def q_clean_description_text(spark, sf):
    """Cleaning applied to every raw description, blank rows included."""
    f = films(spark, sf)
    return f.select("row_id", clean_text("description").alias("clean_description"))



# ---- more inventory: shapes, preview, dense index, gates, formats ---------
def q_catalog_shape(spark, sf):
    return catalog_io.shape(films(spark, sf))


def q_catalog_preview(spark, sf):
    return catalog_io.preview(films(spark, sf), 3).select(*FILM_COLUMNS)


def q_dense_row_index(spark, sf):
    from reelsim.operators.order import dense_index
    c = _rec(spark, sf).catalog.select("row_id")
    return dense_index(c, ["row_id"], "position")


def q_title_suggestions_gated(spark, sf):
    rec = _rec(spark, sf)
    from reelsim.operators.lookup import suggest_titles
    s = suggest_titles(_suggest_words(rec), rec.titles, lambda: rec.index, lambda: rec.freq, rec.heads, 6, "query",
                       min_chars=2, bounded=False)
    return _long(s, "rank")


def q_score_hist(spark, sf):
    return _hist_out(evaluate.score_histogram(_batch_results(spark, sf)))


def q_stats_display(spark, sf):
    st = _rec(spark, sf).stats()
    return st.select(D.thousands("total_movies").alias("total_movies"),
                     D.thousands("tfidf_features").alias("tfidf_features"),
                     D.thousands("total_genres").alias("total_genres"),
                     F.format_string("%.1f%%", "sparsity_pct").alias("sparsity"))


def q_notebook_eval_summary(spark, sf):
    rec = _rec(spark, sf, dedupe=False, tokenizer="raw")
    _, summ = evaluate.notebook_run(rec)
    return summ.select(F.round("mean_ils", 6).alias("mean_ils"), "lists",
                       F.round("coverage_pct", 6).alias("coverage_pct"),
                       F.round("mean_score", 6).alias("mean_score"))


def q_bow_vs_tfidf_shapes(spark, sf):
    """Matrix shapes of the two weightings on the notebook catalogue."""
    rec = _rec(spark, sf, dedupe=False)
    bow = tfidf.bag_of_words(rec.model)
    n_docs = rec.catalog.select(F.count(F.lit(1))).scalar()

    def shape(model, name):
        return model.vocabulary.agg(F.count(F.lit(1)).alias("n_features")).select(
            F.lit(name).alias("method"), n_docs.alias("n_docs"), "n_features",
            model.postings.select(F.count(F.lit(1))).scalar().alias("nnz"))

    return shape(bow, "bow").unionByName(shape(rec.model, "tfidf"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
