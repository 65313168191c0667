"""Pruned and tiled search against plain cosines over every row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsim.operators import impact, tiles
from reelsim.plans.model import ModelParams, Recommender
from reelsim.sources.catalog_io import normalise

WORDS = [a + b for a in ("star", "farm", "deep", "iron", "moon", "wolf", "lake") for b in ("land", "ship", "song", "gate", "fall", "wind")]
GENRES = ["Drama", "Sci-Fi, Drama", "comedy|Noir", None, "Western"]


@pytest.fixture(scope="module")
def rec(spark):
    r = random.Random(4)
    rows = []
    for i in range(400):
        n = r.choice([1, 3, 12, 40])
        words = r.choices(WORDS, weights=[1 / (x + 1) for x in range(len(WORDS))], k=n)
        if i % 9 == 0 and rows:
            words = rows[-1][2].split()[:-1] + ["moongate"]        # near copies
        rows.append((i * 3, f"Title {i} - {1950 + i % 70}", " ".join(words), float(i % 7) if i % 5 else None, None, r.choice(GENRES)))
    films = normalise(spark.createDataFrame(rows, "row_id long, title string, description string, ratings double, genre string, expanded_genres string"))
    return Recommender.fit(films, ModelParams(min_df=1), materialize=True)


@pytest.fixture(scope="module")
def plain(rec):
    vectors = {}
    for x in rec.model.postings.select("row_id", "term", "w").collect():
        vectors.setdefault(x.row_id, {})[x.term] = x.w
    genres = {x.row_id: x.genre_src for x in rec.catalog.select("row_id", "genre_src").collect()}
    return vectors, genres


def best(plain, query, n, own=None, pattern=None):
    vectors, genres = plain
    rows = [(round(sum(w * query.get(t, 0) for t, w in vectors.get(i, {}).items()), 9), i) for i in genres if i != own
            and (pattern is None or pattern in (genres[i] or "").lower())]
    return [(i, round(s, 4)) for s, i in sorted(rows, key=lambda x: (-x[0], -x[1]))[:n]]


def got(rows):
    return [(r.row_id, r.similarity_score) for r in sorted(rows, key=lambda r: r["rank"])]


@pytest.mark.parametrize("first,held", [(0.5, 1000), (0.9, 1000), (0.05, 1000), (0.9, 6)])
def test_pruned_search_is_exact(rec, plain, monkeypatch, first, held):
    """Early and late stops, and more survivors than a round may hold."""
    monkeypatch.setattr(impact, "HELD", held)
    monkeypatch.setattr(impact.search, "__defaults__", (None, None, first))
    for i in (0, 27, 300) if held > 10 else (27,):
        title = rec.catalog.filter(F.col("row_id") == i).first().title
        assert got(rec.recommend_by_title(title, n=5).collect()) == best(plain, plain[0][i], 5, own=i)
    assert got(rec.recommend_by_title(title, "drama", n=4).collect()) == best(plain, plain[0][i], 4, own=i, pattern="drama")


def test_edges(rec, plain):
    assert rec.recommend_by_title("no such title at all").collect() == []
    assert rec.recommend_by_description("the of").collect() == []
    assert got(rec.recommend_by_description("qwertz", n=3).collect()) == best(plain, {}, 3)
    assert rec.recommend_by_description("starland", "broken (").collect() == []
    assert len(rec.recommend_by_title("Title 3 - 1953", n=2000).collect()) == rec.catalog.count() - 1


def test_only_some_blocks_are_read(rec):
    sizes = rec.block_sizes
    assert sum(n for n, _ in sizes.values()) == rec.model.postings.count()
    row = rec.model.postings.filter("row_id = 27").join(rec.model.vocabulary, "term").select("term", impact.band_of(F.col("df")).alias("band"), "w").collect()
    request = impact.Request(tuple((x.term, x.band, x.w) for x in row))
    order = impact.reading_order(request.by_band(), sizes)
    assert {x[:2] for x in order} == set(sizes) and order[-1][2] == 0
    assert [x[2] for x in order] == sorted((x[2] for x in order), reverse=True)
    query = rec.catalog.sparkSession.createDataFrame([(t, w) for t, _, w in request.terms], "term string, _qw double")
    plan = impact.partial_scores(rec.blocks, query, order[:1], None, None)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "level" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_ceiling_holds(rec, plain):
    """No unread blocks ever add more than the ceiling says."""
    r = random.Random(1)
    bands = {x.term: x.band for x in rec.model.vocabulary.select("term", impact.band_of(F.col("df")).alias("band")).collect()}
    level = lambda w: min(max(math.floor(-math.log2(w)) - 1, 0), impact.LEVELS - 1)
    for i in r.sample(sorted(plain[0]), 25):
        q = plain[0][i]
        order = impact.reading_order(impact.Request(tuple((t, bands[t], w) for t, w in q.items())).by_band(), rec.block_sizes)
        k = r.randrange(len(order))
        unread = {x[:2] for x in order[k + 1:]}
        most = max(sum(w * q.get(t, 0) for t, w in v.items() if (bands[t], level(w)) in unread) for v in plain[0].values())
        assert most <= order[k][2] + 1e-12


def test_tiles(spark, rec, plain, monkeypatch):
    """Several blocks of queries and of documents, filters, ties, unknown and
    broken requests."""
    monkeypatch.setattr(tiles, "QUERY_BLOCK", 7)
    monkeypatch.setattr(tiles, "DOC_BLOCK", 16)
    rows = [i for i in sorted(plain[0]) if i % 20 == 0]
    gf = [None, "drama", "noir", "x ("]
    t = {x.row_id: x.title for x in rec.catalog.select("row_id", "title").collect()}
    q = spark.createDataFrame([(i, t[i], gf[k % 4]) for k, i in enumerate(rows)] + [(9999, "unknown", None)], "query_id long, text string, gf string")
    out = {}
    for x in rec.by_title(q, 6, filter_col="gf", bounded=False).collect():
        out.setdefault(x.query_id, []).append(x)
    for k, i in enumerate(rows):
        want = [] if gf[k % 4] == "x (" else best(plain, plain[0][i], 6, own=i, pattern=gf[k % 4])
        assert got(out.get(i, [])) == want
    assert 9999 not in out
    rec.release()


def test_best_of_a_tile():
    r = np.random.default_rng(3)
    for n in (1, 3, 50):
        score = np.round(r.random((20, 5)) * 4) / 4 * (r.random((20, 5)) > 0.4)
        rows = r.permutation(20).astype(np.int64)
        doc, query = tiles.best_of(score, rows, n)
        for q in range(5):
            want = sorted(((score[d, q], rows[d]) for d in range(20) if score[d, q] > 0), reverse=True)[:n]
            assert [(score[d, q], rows[d]) for d in doc[query == q]] == want
