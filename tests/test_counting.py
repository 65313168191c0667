"""Counting row by row and the tile product, against the plain forms."""

import numpy as np

from reelsim.operators import counting, tfidf, tiles

ROWS = [(1, ["a", "b", "a", "b", "c"]), (2, ["b", "a", "b"]), (3, []), (4, ["c"]), (5, ["x", "a", "b"]), (6, ["y", "z", "y z"])]
TWICE = [(2, ["a", "b"]), (None, ["c", "a"]), (None, ["a", "c"])]


def _same(spark, rows, cap):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(rows, "row_id long, tokens array<string>").cache()
    n = F.lit(docs.count()).cast("long")
    plain = tfidf.fit(docs, "tokens", 2, cap, to_terms=tfidf.uni_bi_grams, n_docs=n)
    model = tfidf.fit_rows(docs, 2, cap, n_docs=n)
    vocabulary = sorted(map(tuple, model.vocabulary.collect()))
    assert vocabulary == sorted(map(tuple, plain.vocabulary.collect()))
    numbered = [(t, i, idf) for i, (t, _, _, idf) in enumerate(vocabulary)]
    name = [t for t, *_ in numbered]
    got = {(r.row_id, name[i], tf, round(w, 12)) for r in model.by_row(docs.withColumn("genre_id", F.lit(0).cast("long")), numbered).collect()
           for i, tf, w in zip(r.ids, r.tfs, r.ws)}
    if model.weigh:
        got |= {(*r[:3], round(r.w, 12)) for r in model.weigh(model.vocabulary).collect()}
    assert got == {(*r[:3], round(r.w, 12)) for r in plain.postings.collect()}


def test_rows_count_as_the_grouped_fit(spark):
    for rows in (ROWS, ROWS + TWICE):
        for cap in (2, 3, 100):
            _same(spark, rows, cap)


def test_no_row_per_document_and_term_is_shuffled(spark):
    """The only exchange below the sums is that of the partial counts."""
    docs = spark.createDataFrame(ROWS, "row_id long, tokens array<string>")
    plan = tfidf._summed(counting.term_stats(docs), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(row_id" not in plan


def test_tile_product_and_kept_rows():
    r = np.random.default_rng(5)
    docs, queries, terms, n = 300, 40, 60, 3
    share = np.linspace(0.01, 0.6, terms)
    d, q = ((r.random((k, terms)) < share) * r.random((k, terms)) for k in (docs, queries))
    at, term = np.nonzero(q)
    block = tiles._Block.of(term + 100, at, q[at, term], queries)
    assert (block.column >= 0).any() and block.count.any()
    doc, dterm = np.nonzero(d)
    place = block.places(dterm + 100)
    ok = place >= 0
    score = block.scores(doc[ok], place[ok], d[doc, dterm][ok], docs)
    assert np.allclose(score, d @ q.T)
    rows, best = np.arange(docs)[::-1].copy(), tiles._Best(queries, n)
    for i in range(0, docs, 50):
        best.add(score[i:i + 50], rows[i:i + 50])
        best.rank()
    query, row, _ = best.rank()
    want = {(k, x) for k in range(queries) for x in sorted(range(docs), key=lambda x: (-round(score[x, k], 9), -rows[x]))[:n] if score[x, k] > 0}
    assert {(int(a), docs - 1 - int(b)) for a, b in zip(query, row)} == want


def test_blocks_of_queries_are_bounded(monkeypatch):
    monkeypatch.setattr(tiles, "QUERY_BLOCK", 500)
    assert list(tiles._blocks([(1, 256, 10), (0, 256, 10), (2, 100, 10)], 5)) == [[0], [1, 2]]
    assert list(tiles._blocks([(0, 200, 10), (1, 200, tiles.BLOCK_TERMS), (2, 9, 1)], 5)) == [[0], [1], [2]]
    assert list(tiles._blocks([(0, 200, 10), (1, 200, 10)], tiles.KEPT)) == [[0], [1]]
