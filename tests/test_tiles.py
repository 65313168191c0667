"""Tiles in single precision, and the passes of a stored fit."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reelsim.operators import counting, impact, tfidf, tiles
from reelsim.plans.model import ModelParams, Recommender
from reelsim.sources.catalog_io import normalise


def test_lists_are_those_of_double_precision(spark, monkeypatch):
    """Scores nearer to each other than single precision tells apart, copies
    of a document, rows that share an id, and queries that are documents."""
    monkeypatch.setattr(tiles, "DOC_BLOCK", 32)
    monkeypatch.setattr(tiles, "WAITING", 200)
    monkeypatch.setattr(tiles, "AGAIN_DOCS", 3)
    monkeypatch.setattr(tiles, "AGAIN_ENTRIES", 50)
    r = np.random.default_rng(7)
    terms, n = 40, 4
    base = (r.random((12, terms)) < 0.4) * (0.5 + r.random((12, terms)))
    docs = np.concatenate([np.repeat(base[:1], 25, axis=0), np.repeat(base, 15, axis=0)])
    docs[25:] *= 1 + 3e-9 * r.integers(0, 30, (len(docs) - 25, 1))
    docs /= np.sqrt((base * base).sum(axis=1).max())
    row = r.permutation(len(docs)) * 10
    row[3] = row[4]
    asked = r.choice(len(docs), 30, replace=False)
    wide = lambda x: ([int(t) for t in np.flatnonzero(x)], [float(w) for w in x[x > 0]])
    d = spark.createDataFrame([(int(i), 0, *wide(x)) for i, x in zip(row, docs)], tiles.VECTOR)
    q = spark.createDataFrame([(int(k), int(row[k]), None, *wide(docs[k])) for k in asked],
                              "query_id long, _self long, _gf string, ids array<int>, ws array<double>")
    found = tiles.tile_top_n(q, d, spark.createDataFrame([("x", 0)], "genre_src string, genre_id long"), n)
    # the rows of every task's lists, before the padding of a search
    got = {}
    for x in found.collect():
        got.setdefault(x.query_id, []).append((round(x.score, 9), x.row_id))
    for k in asked:
        score = docs @ docs[k]
        want = sorted(((round(s, 9), int(i)) for s, i in zip(score, row) if i != row[k] and s > 0), reverse=True)[:n]
        assert sorted(got[k], reverse=True) == want


def test_a_block_holds_8192_queries_in_single_precision():
    assert len(list(tiles._blocks([(i, 256, 50_000) for i in range(32)], 5))) == 1
    block = tiles._Block.of(np.array([3, 5, 5]), np.array([0, 0, 1]), np.array([0.6, 0.8, 1.0]), 2)
    score = block.scores(np.array([0, 1]), block.places(np.array([5, 3])), np.array([1.0, 0.5]), 2)
    assert score.dtype == np.float32 and np.allclose(score, [[0.8, 1.0], [0.3, 0.0]])
    again = block.again(np.array([1, 0]), np.array([0, 1]), np.array([0, 1, 2]), block.places(np.array([5, 3])), np.array([1.0, 0.5]))
    assert again.tolist() == [0.3, 1.0]
    assert block.places(np.array([0, 3, 4, 5, 10 ** 6])).tolist() == [-1, 0, -1, 1, -1]


def test_largest_rows_of_equal_lists():
    lists = pa.array([[1], [2], [1], [1], [1], [2], [1]])
    off, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    assert tiles._largest(2, np.array([1, 2, 3, 4, 5, 6, 7]), (off, values)).tolist() == [1, 4, 5, 6]
    assert tiles._largest(2, np.array([1, 2, 3, 4, 4, 6, 7]), (off, values)).tolist() == [1, 3, 4, 5, 6]


def _films(spark, rows):
    made = [(i, f"Title {i}", " ".join(f"word{'abcdefgh'[(i + k * k) % 8]}" for k in range(6)), 1.0, None, "Drama") for i in range(rows)]
    return normalise(spark.createDataFrame(made, "row_id long, title string, description string, ratings double, genre string, expanded_genres string"))


def test_vectors_are_made_once_and_lie_in_order(spark, monkeypatch):
    """A range partitioning of the vectors would make them a second time."""
    monkeypatch.setattr(tiles, "FILE_ROWS", 20)
    made, make = spark.sparkContext.accumulator(0), counting.by_document

    def counted(*a, **b):
        def rows(batches):
            for x in batches:
                made.add(len(x))
                yield x

        out = make(*a, **b)
        return out.mapInArrow(rows, out.schema)

    monkeypatch.setattr(counting, "by_document", counted)
    for tokenizer in ("clean", "raw"):
        before = made.value
        rec = Recommender.fit(_films(spark, 100), ModelParams(tokenizer=tokenizer), materialize=True)
        assert made.value - before == 100
        vectors = rec.by_document[2]
        files = [(x.lo, x.hi) for x in vectors.groupBy(F.input_file_name()).agg(F.min("row_id").alias("lo"), F.max("row_id").alias("hi")).collect()]
        assert len(files) > 1 and all(a[1] < b[0] for a, b in zip(sorted(files), sorted(files)[1:]))


def test_blocks_are_stored_when_a_search_reads_them(spark):
    rec = Recommender.fit(_films(spark, 100), materialize=True)
    assert "level" not in rec.model.postings.columns
    want = sorted(map(tuple, impact.with_blocks(rec.model.postings, rec.model.vocabulary).select("row_id", "term", "tf", "w", "band", "level").collect()))
    assert sorted(map(tuple, rec.blocks.select("row_id", "term", "tf", "w", "band", "level").collect())) == want
    assert rec.model.postings is rec.blocks and rec.blocks._stored_path
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_tokens_as_one_string(spark):
    rows = [(1, "ab cd ab cd"), (2, "cd ab"), (3, ""), (4, "ab cd x1"), (5, "x1 x1"), (2, "ab"), (None, "cd x1")]
    text = spark.createDataFrame(rows, "row_id long, tokens string").cache()
    lists = text.withColumn("tokens", F.when(F.col("tokens") != "", F.split("tokens", " ")).otherwise(F.array().cast("array<string>"))).cache()
    for cap in (2, 3, 100):
        n = F.lit(7).cast("long")
        one, two = (tfidf.fit_rows(x, 2, cap, n_docs=n) for x in (text, lists))
        plain = tfidf.fit(lists, "tokens", 2, cap, to_terms=tfidf.uni_bi_grams, n_docs=n)
        want = sorted(map(tuple, plain.vocabulary.collect()))
        assert sorted(map(tuple, one.vocabulary.collect())) == sorted(map(tuple, two.vocabulary.collect())) == want
        numbered = [(t, i, idf) for i, (t, _, _, idf) in enumerate(want)]
        got = [sorted(map(str, m.by_row(x.withColumn("genre_id", F.lit(0).cast("long")), numbered).collect())) for m, x in ((one, text), (two, lists))]
        assert got[0] == got[1] and got[0]


def test_weights_are_rounded_as_before(spark):
    r = np.random.default_rng(2)
    values = [*r.random(2000), *(r.integers(0, 10 ** 7, 2000) / 1e7), 0.0, 0.0000005, 0.9999995, 1.0, 99.9999995, 1e9, -0.1234565, float("nan"), None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "w double")
    assert df.select(tfidf.round_weight("w", 6).alias("a"), F.round("w", 6).alias("b")).filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
