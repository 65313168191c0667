import json
import os
import tempfile

from reelsim.plans.model import ModelParams, Recommender
from reelsim.sources.catalog_io import normalise
from reelsim.streaming.serve import request_stream, serve
from test_model import FILMS, SCHEMA


def test_stream_of_requests(spark):
    rec = Recommender.fit(normalise(spark.createDataFrame(FILMS, SCHEMA)), ModelParams(min_df=1)).materialize()
    root = tempfile.mkdtemp(prefix="reelsim-stream-")
    inbox, out, ck = (os.path.join(root, d) for d in ("in", "out", "ck"))
    os.makedirs(inbox)
    reqs = [{"request_id": 1, "mode": "title", "text": "Star Quest - 1977", "genre_filter": None},
            {"request_id": 2, "mode": "description", "text": "quiet farm wheat", "genre_filter": "drama"},
            {"request_id": 3, "mode": "genre", "text": "sci-fi", "genre_filter": None}]
    with open(os.path.join(inbox, "batch1.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in reqs))
    q = serve(rec, request_stream(spark, inbox), out, ck, n=3)
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    counts = {r.request_id: r["count"] for r in res.groupBy("request_id").count().collect()}
    assert counts == {1: 3, 2: 3, 3: 2}
    top = res.filter("request_id = 2 AND rank = 1").first()
    assert top.row_id == 2


def test_answer_batch_with_missing_modes(spark):
    from reelsim.streaming.serve import REQUEST_SCHEMA, answer_batch
    rec = Recommender.fit(normalise(spark.createDataFrame(FILMS, SCHEMA)), ModelParams(min_df=1)).materialize()
    reqs = spark.createDataFrame([(7, "genre", "drama", None), (8, "title", "no such film", None)], REQUEST_SCHEMA)
    out = answer_batch(rec, reqs, n=2).collect()
    assert sorted((r.request_id, r["rank"], r.row_id) for r in out) == [(7, 1, 7), (7, 2, 3)]
    rec.release()
