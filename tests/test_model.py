"""Recommender semantics on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from reelsim.operators.similarity import intra_list_similarity
from reelsim.plans.model import ModelParams, Recommender
from reelsim.sources.catalog_io import normalise

FILMS = [
    (0, "Star Quest - 1977", "galaxy rebels fight empire across the galaxy", 8.6, "Sci-Fi", "Action, Sci-Fi"),
    (1, "Galaxy Heroes - 2014", "heroes defend galaxy from invading empire fleet", 8.0, "Sci-Fi", "Sci-Fi|Comedy"),
    (2, "Quiet Farm - 1999", "farmer grows wheat on quiet farm valley", None, "Drama", "Drama"),
    (3, "quiet farm - 1999", "duplicate title in other case farm valley wheat", 6.0, "Drama", "Drama/Family"),
    (4, "Ocean Deep - 2005", "submarine crew explores ocean trench deep water", 7.1, "Thriller", None),
    (5, "Ocean Deep - 2005", "same exact title later row dropped by dedupe", 9.9, "Thriller", "Thriller"),
    (6, "Harbor Lights - 1988", None, 5.5, "Drama", "Drama"),
    (7, "Empire Valley - 2001", "empire valley farmer wheat rebels", 7.7, "Western", "Western, Drama"),
    (8, "Night Train - 1960", "train night passengers mystery", 7.0, "Mystery", "Mystery,"),
]
SCHEMA = "row_id long, title string, description string, ratings double, genre string, expanded_genres string"


@pytest.fixture(scope="module")
def rec(spark):
    films = normalise(spark.createDataFrame(FILMS, SCHEMA))
    return Recommender.fit(films, ModelParams(min_df=1)).materialize()


def _q(spark, rows, extra=""):
    return spark.createDataFrame(rows, "query_id long, text string" + extra)


def test_catalogue_dedupe_and_nulls(rec):
    ids = sorted(r.row_id for r in rec.catalog.select("row_id").collect())
    assert ids == [0, 1, 2, 3, 4, 7, 8]          # 5: repeated title, 6: no description


def test_resolution_tiers(spark, rec):
    q = _q(spark, [(1, "  STAR quest - 1977 "), (2, "galaxy heroes"), (3, "farm quiet"),
                   (4, "- 200"), (5, "zzz qqq"), (6, "   "), (7, "quiet farm - 1999")])
    got = {r.query_id: (r.row_id, r.tier) for r in rec.resolve(q, bounded=True).collect()}
    assert got[1] == (0, 1)
    assert got[2] == (1, 2)
    assert got[3] == (2, 3)          # words are substrings; first row wins
    assert got[4] == (4, 4)
    assert 5 not in got and 6 not in got
    assert got[7] == (2, 1)          # case variants share one key: first row


def test_by_title_excludes_self_and_pads(spark, rec):
    out = rec.by_title(_q(spark, [(1, "Star Quest - 1977")]), n=6, bounded=True).orderBy("rank").collect()
    ids = [r.row_id for r in out]
    assert 0 not in ids and len(ids) == 6
    scores = [r.similarity_score for r in out]
    assert scores == sorted(scores, reverse=True)
    assert all(0.0 <= s <= 1.0 for s in scores)
    zeros = [r.row_id for r in out if r.similarity_score == 0.0]
    assert zeros == sorted(zeros, reverse=True)   # zero rows fill by row_id desc


def test_genre_filter_is_regex_and_nulls_never_match(spark, rec):
    q = _q(spark, [(1, "Star Quest - 1977", "dra.a"), (2, "Star Quest - 1977", "All")], ", gf string")
    out = rec.by_title(q, n=10, filter_col="gf", bounded=True)
    r1 = sorted(r.row_id for r in out.filter("query_id = 1").collect())
    assert r1 == [2, 3, 7]
    r2 = out.filter("query_id = 2").count()
    assert r2 == 6                       # "All" = no filter; every row but the movie itself


def test_description_unknown_and_stop_words(spark, rec):
    out = rec.by_description(_q(spark, [(1, "qwxyz zyxwq"), (2, "the and of")]), n=3, bounded=True)
    rows = out.orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.row_id, r.similarity_score) for r in rows] == [
        (1, 8, 0.0), (1, 7, 0.0), (1, 4, 0.0)]


def test_self_similarity_and_symmetry(spark, rec):
    p = rec.model.postings
    a = {(r.row_id, r.term): r.w for r in p.collect()}
    def cos(i, j):
        return sum(w * a.get((j, t), 0.0) for (r, t), w in a.items() if r == i)
    for i in (0, 1, 7):
        assert math.isclose(cos(i, i), 1.0, rel_tol=1e-9)
    out = rec.by_description(_q(spark, [(1, "galaxy rebels fight empire across the galaxy")]),
                             n=2, bounded=True).orderBy("rank").collect()
    assert out[0].row_id == 0 and out[0].similarity_score == 1.0
    assert math.isclose(cos(0, 1), cos(1, 0), rel_tol=1e-12)


def test_by_genre_sorts_ratings_nulls_last(spark, rec):
    q = spark.createDataFrame([(1, "drama")], "query_id long, genre string")
    rows = rec.by_genre(q, n=5).orderBy("rank").collect()
    assert [r.row_id for r in rows] == [7, 3, 2]


def test_suggestions_prefix_first(spark, rec):
    q = _q(spark, [(1, "farm"), (2, "qu"), (3, "")])
    rows = rec.suggest(q, limit=8, bounded=True).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.title) for r in rows] == [
        (1, "Quiet Farm - 1999"), (1, "quiet farm - 1999"),
        (2, "Quiet Farm - 1999"), (2, "quiet farm - 1999"), (2, "Star Quest - 1977")]


def test_ils_closed_form_matches_pairs(spark, rec):
    members = spark.createDataFrame([(1, 0), (1, 1), (1, 7), (1, 7), (2, 4)], "query_id long, row_id long")
    got = {r.query_id: r.ils for r in intra_list_similarity(members, rec.model.postings).collect()}
    a = {(r.row_id, r.term): r.w for r in rec.model.postings.collect()}
    def cos(i, j):
        return sum(w * a.get((j, t), 0.0) for (r, t), w in a.items() if r == i)
    lst = [0, 1, 7, 7]
    brute = sum(cos(x, y) for i, x in enumerate(lst) for j, y in enumerate(lst) if i != j) / 12
    assert math.isclose(got[1], brute, rel_tol=1e-9)
    assert got[2] == 0.0


def test_result_independent_of_partitioning(spark):
    films = normalise(spark.createDataFrame(FILMS, SCHEMA))
    a = Recommender.fit(films, ModelParams(min_df=1, num_partitions=1)).model.postings
    b = Recommender.fit(films.repartition(5), ModelParams(min_df=1, num_partitions=7)).model.postings
    key = lambda r: (r.row_id, r.term)
    ra = sorted(((r.row_id, r.term, round(r.w, 12)) for r in a.collect()))
    rb = sorted(((r.row_id, r.term, round(r.w, 12)) for r in b.collect()))
    assert ra == rb


def test_lexicon_table_matches_literal_map(spark):
    from reelsim.functions.text import clean_tokens
    from reelsim.operators.lemma import lemmatise_with_table
    df = spark.createDataFrame([(1, "Heroes save movies and heroes"), (2, "nothing here"), (3, "")],
                               "row_id long, d string").withColumn("tokens", clean_tokens("d"))
    lex = spark.createDataFrame([("heroes", "hero"), ("movies", "movie")], "form string, lemma string")
    got = {r.row_id: r.tokens for r in lemmatise_with_table(df, lex).collect()}
    want = {r.row_id: r.t for r in df.select("row_id", clean_tokens(
        "d", lexicon={"heroes": "hero", "movies": "movie"}).alias("t")).collect()}
    assert got == want == {1: ["hero", "save", "movie", "hero"], 2: ["nothing"], 3: []}


def test_split_load_rename_and_required_columns(spark, tmp_path):
    from reelsim.sources.catalog_io import load_splits, normalise, write_csv
    raw = spark.createDataFrame(
        [("Die Hard - 1988", "Action", "Action, Thriller", "8.2", "A cop.\nTwo lines \"quoted\""),
         ("NA", None, "War,", "n/a", "N/A")],
        "`movie title - year` string, genre string, `expanded-genres` string, rating string, description string")
    write_csv(raw, str(tmp_path / "train"))
    write_csv(raw.limit(1), str(tmp_path / "validation"))
    both = load_splits(spark, {"train": str(tmp_path / "train"), "validation": str(tmp_path / "validation")},
                       fmt="csv")
    assert sorted(r.split for r in both.collect()) == ["train", "train", "validation"]
    n = normalise(both.filter("split = 'train'").withColumn("row_id", __import__("pyspark.sql.functions",
                  fromlist=["lit"]).lit(1)))
    rows = {r.title: r for r in n.collect()}
    assert rows["Die Hard - 1988"].ratings == 8.2
    assert rows["Die Hard - 1988"].description == 'A cop.\nTwo lines "quoted"'
    assert rows["Die Hard - 1988"].genre_src == "Action, Thriller"
    assert None in rows and rows[None].description is None and rows[None].ratings is None
    import pytest as _pt
    with _pt.raises(ValueError):
        normalise(spark.createDataFrame([("x",)], "title string"))


def test_vocabulary_cut_is_exact(spark, sf_small):
    from reelsim.operators import tfidf
    from reelsim.sources.tables import films
    docs = tfidf.docs_from_tokens(Recommender.fit(films(spark, sf_small)).catalog)
    tf = tfidf.term_counts(docs.repartition("row_id"))
    every = sorted(((-r.cf, r.term) for r in tfidf.select_vocabulary(tf, 2, None).collect()))
    for cap in (50, 1000):
        cut = sorted((-r.cf, r.term) for r in tfidf.select_vocabulary(tf, 2, cap).collect())
        assert cut == every[:cap]


def test_source_order_over_files_of_different_size(spark, tmp_path):
    from reelsim.sources.catalog_io import load_splits
    for name, rows in (("a", ["first"]), ("b", [f"{x} {'long ' * 2000}" for x in range(4)])):
        (tmp_path / "train").mkdir(exist_ok=True)
        (tmp_path / "train" / f"part-{name}.csv").write_text("title,description\n" + "".join(f"{r},x\n" for r in rows))
    (tmp_path / "validation.csv").write_text("title,description\nlast,x\n")
    got = load_splits(spark, {"train": str(tmp_path / "train"), "validation": str(tmp_path / "validation.csv")},
                      fmt="csv", ordered=True).orderBy("row_id").collect()
    assert [(r.row_id, r.title.split()[0]) for r in got] == list(enumerate(["first", "0", "1", "2", "3", "last"]))


def test_invalid_pattern_costs_only_its_request(spark, rec):
    q = _q(spark, [(1, "Star Quest - 1977", "sci-fi ("), (2, "Star Quest - 1977", "drama")], ", gf string")
    assert sorted(r.row_id for r in rec.by_title(q, n=10, filter_col="gf").collect()) == [2, 3, 7]
    assert {r.query_id for r in rec.by_description(q, n=10, filter_col="gf").collect()} == {2}
    assert [tuple(r) for r in rec.rejected(q, "gf").collect()] == [(1, "sci-fi (")]
    g = spark.createDataFrame([(1, "["), (2, "drama")], "query_id long, genre string")
    assert {r.query_id for r in rec.by_genre(g, n=5).collect()} == {2}


def test_empty_vocabulary_is_an_error(spark):
    films = normalise(spark.createDataFrame([(0, "A", "one galaxy", 1.0, "x", "x"), (1, "B", "two valleys", 1.0, "x", "x")], SCHEMA))
    with pytest.raises(ValueError, match="nothing to fit"):
        Recommender.fit(films, ModelParams(min_df=3), materialize=True)


def test_bag_of_words_equals_its_own_fit(spark, rec):
    from reelsim.operators import tfidf
    own = tfidf.fit(tfidf.docs_from_tokens(rec.catalog), min_df=1, sublinear_tf=False, use_idf=False, norm=False)
    key = lambda m: sorted(tuple(r) for r in m.postings.select("row_id", "term", "tf", "w").collect())
    assert key(tfidf.bag_of_words(rec.model)) == key(own)


def test_release_leaves_no_request_tables(spark, rec):
    import os
    from reelsim.session import checkpoint_dir
    here = checkpoint_dir(spark).removeprefix("file:")
    q = _q(spark, [(1, "galaxy"), (2, "Star Quest - 1977")])
    rec.release()
    assert {r.query_id for r in rec.by_title(q, n=2, bounded=False).collect()} == {1, 2}
    assert any(x.startswith("request-") for x in os.listdir(here))
    rec.by_description(q, n=2, bounded=True).collect()
    rec.release()
    assert not any(x.startswith("request-") for x in os.listdir(here)) and not rec._kept
