"""Operators on pages and embeddings, the registered queries and the
pipeline."""

import math
import random

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from reelsim.llm import pivots, queries, url_lists, warc
from reelsim.llm.common import scratch_path

SF = "/root/testdata/sf0.001"


def test_warc_round_trip(spark):
    big = "<p>é" + "x" * 200 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(5, "http://a.b/1", big), (3, "http://a.b/2\n", big), (9, None, big), (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"),
            (7, "u", "line\n" * 300000), (None, "u", "no id " * 50), (8, "u", None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, n int").repartition(3)
    raw, done = scratch_path(spark, "raw"), scratch_path(spark, "done")
    warc.write_archives(pages, raw)
    warc.normalise(spark, raw, done)
    got = {r["page_id"]: r for r in warc.read_records(spark, done).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        r, text = got[i], html or ""
        assert r["payload_bytes"] == len(text.encode())
        if text == big and i != 3:
            assert (r["record_type"], r["refers_to"], r["html"]) == ("revisit", 3, None)
            assert r["payload_digest"] == got[3]["payload_digest"]
        else:
            assert (r["record_type"], r["refers_to"], r["html"]) == ("response", None, text)


def test_warc_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    raw, done = scratch_path(spark, "raw"), scratch_path(spark, "done")
    warc.write_archives(pages, raw)
    warc.normalise(spark, raw, done)
    assert warc.read_records(spark, done).count() == 0


def test_truncated_stream_is_an_error():
    import gzip
    import io
    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nabc")
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(whole)))


def test_temporal_join(spark):
    entries = [("bad.com", 10, "add"), ("bad.com", 20, "remove"), ("BAD.com", 30, "add"), ("x.bad.com", 12, "add"), ("x.bad.com", 12, "remove"),
               ("y.org", 5, "add"), ("y.org", 7, "add"), (None, 1, "add"), ("z.org", None, "add"), ("q.org", 3, "remove")]
    hosts = ["http://bad.com/a", "https://X.bad.com:80/", "http://notbad.com", "http://u@y.org./p", None, "nonsense", "http://q.org"]
    caps = [(100 * i + d, u, d) for i, u in enumerate(hosts) for d in (1, 5, 9, 10, 12, 19, 20, 29, 30, 99)] + [(9999, "http://bad.com", None)]
    got = url_lists.evaluate(spark.createDataFrame([(*c, "z") for c in caps], "page_id long, url string, fetch_day long, rule string"),
                             spark.createDataFrame(entries, "domain string, day long, action string")).collect()
    assert len(got) == len(caps)
    live = {"bad.com": [(10, 20), (30, None)], "y.org": [(5, None)]}
    for r in got:
        want = None
        for d, spans in live.items():
            if r["host"] and r["fetch_day"] is not None and (r["host"] == d or r["host"].endswith("." + d)):
                want = next(((d, a, b) for a, b in spans if a <= r["fetch_day"] and (b is None or r["fetch_day"] < b)), None)
        assert (r["blocked"], r["rule"], r["valid_from"], r["valid_to"]) == ((True, *want) if want else (False, None, None, None))
    empty = spark.createDataFrame([], "domain string, day long, action string")
    assert {r["blocked"] for r in url_lists.evaluate(spark.createDataFrame(caps, "page_id long, url string, fetch_day long"), empty).collect()} == {False}


def brute(rows, cosine):
    ok = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = v
    links, root = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in ok:
        for b in ok:
            if a < b and len(ok[a]) == len(ok[b]):
                dot = sum(x * y for x, y in zip(ok[a], ok[b]))
                if dot / math.sqrt(sum(x * x for x in ok[a]) * sum(x * x for x in ok[b])) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return links, {i: find(i) for i in root}


def test_pivot_index(spark):
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(32)] for _ in range(60)]
    rows = []
    for i in range(700):
        c = centres[i % 60]
        rows.append((i, [x + r.gauss(0, 0.16) for x in c] if i % 4 else list(c)))
    rows += [(1000, None), (1001, []), (1002, [0.0] * 32), (1003, [float("nan")] * 32), (1004, [None] * 32), (1005, [1.0, 2.0])]
    df = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, label int").repartition(3)
    got = {x["vec_id"]: x for x in pivots.near_duplicates(df).collect()}
    links, comp = brute(rows, pivots.COSINE)
    assert len(got) == len(rows)
    found = sum(x["n_links"] for x in got.values())
    assert 0.9 * sum(links.values()) <= found <= sum(links.values())
    assert all(got[i]["n_links"] <= links[i] for i in links)
    assert sum(got[i]["component_id"] == comp[i] for i in comp) >= 0.99 * len(comp)
    assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in range(1000, 1006))
    assert pivots.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("many", [64, 1000, 4096])
def test_links_at_the_threshold_meet_among_many_pivots(many):
    r = np.random.default_rng(many)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    refs, x = unit(r.normal(size=(many, 64))), unit(r.normal(size=(1000, 64)))
    y = r.normal(size=x.shape)
    y = pivots.COSINE * x + math.sqrt(1 - pivots.COSINE ** 2) * unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    k = pivots.described_length(many)
    a, b = (pivots.nearest_pivots(z, refs, k) for z in (x, y))
    assert ((a[:, :, None] == b[:, None, :]).sum(axis=(1, 2)) >= 2).mean() >= 0.94


def test_recall_among_dense_pivots(spark, monkeypatch):
    """Pivots far denser than clusters are wide: links still are found."""
    monkeypatch.setattr(pivots, "LEAST_PIVOTS", 600)
    r = np.random.default_rng(8)
    x = np.repeat(r.normal(size=(4, 32)), 600, axis=0)
    x = x + r.normal(scale=0.3, size=x.shape)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = int((u @ u.T >= pivots.COSINE).sum()) - len(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    found = sum(v["n_links"] for v in pivots.near_duplicates(df).collect())
    assert 0.9 * links <= found <= links


def test_long_lists_are_cut_into_blocks(spark, monkeypatch):
    """A third of the rows around one direction: the same links in blocks,
    and no task holds the whole group; scaled copies are one class."""
    r = np.random.default_rng(4)
    tight = r.normal(size=32) + r.normal(scale=0.1, size=(150, 32))
    tight[:40] = tight[0] * np.arange(1, 41)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((tight, r.normal(size=(300, 32)))))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    links, comp = brute(rows, pivots.COSINE)
    whole = {x["vec_id"]: x for x in pivots.near_duplicates(df).collect()}
    monkeypatch.setattr(pivots, "LIST_ROWS", 10)
    got = {x["vec_id"]: x for x in pivots.near_duplicates(df).collect()}
    assert got == whole and {i: got[i]["component_id"] for i in got} == comp
    assert 0.9 * sum(links.values()) <= sum(x["n_links"] for x in got.values()) <= sum(links.values())
    assert pivots.described(df.filter("vec_id < 40")).select("key").distinct().count() == 1
    one = [(7, x["vec_id"], x["raw"]) for x in pivots.described(df).filter("vec_id < 150").collect()]
    lists = spark.createDataFrame([(*x, 1, b"") for x in one], "list long, rep long, raw binary, copies long, near binary")
    sizes = lists.groupBy("list").count().withColumnRenamed("count", "rows")
    tasks = pivots.blocked(lists, sizes).groupBy("list", "i", "j").count().collect()
    assert len(tasks) == 120 and max(t["count"] for t in tasks) < 60


def test_vectors_of_every_length_link(spark):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) for _ in range(16)]) for i in range(100)]
    rows += [(100 + i, [x + r.gauss(0, 0.05) for x in rows[i][1]]) for i in range(100)]
    some = [[r.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows += [(200 + i, [x + r.gauss(0, 0.02) for x in some[i % 40]]) for i in range(80)]
    rows += [(300, [1.0, 2.0]), (301, [1.0, 2.1]), (302, [2.0, -1.0]), (303, [1.0]), (304, [1.0, 2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    links, comp = brute(rows, pivots.COSINE)
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in pivots.near_duplicates(df).collect()}
    assert got == {i: (links[i], comp[i]) for i in links}


def frame(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query(spark, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    assert rows
    if name in E.oracle_sql():
        con = duckdb.connect()
        for t in ("documents", "pages", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cols, want = frame(con, E.oracle_sql()[name])
        assert sorted(df.columns) == cols and sorted(rows, key=repr) == want


def test_pipeline(spark, odd_documents, tmp_path):
    """Stage by stage: each works on what its predecessor kept, and what one
    drops is what its operator says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = docs, list(corpus_pipeline.COLUMNS)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    sizes = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, SF)
        if i < 4:
            assert out.columns == columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert ids(out) <= ids(kept)
        sizes.append(len(ids(out)))
        kept = out
    assert sizes[0] < docs.count() and sizes[1] < sizes[0] >= sizes[2] == sizes[3] == sizes[4]
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").collect())) == \
        sorted(map(tuple, kept.select("doc_id", "start", "length", "ids_crc32").collect()))
    # odd rows pass every stage but the classifier
    odd = odd_documents
    for name, stage in corpus_pipeline.STAGES[1:]:
        odd = stage(spark, odd, SF)
    assert odd.count() > 0


def test_pipeline_keeps_one_row_of_repeated_and_null_ids(spark):
    """Repeated rows, texts under one doc_id, and rows without a doc_id."""
    def prose(seed):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(400)}" for _ in range(90))

    near = prose(4).split()
    near[45] = "changed"
    rows = [(1, prose(1)), (1, prose(1)), (1, prose(1)), (None, prose(2)), (None, prose(2)), (3, prose(3)), (None, prose(3)), (4, prose(4)),
            (None, " ".join(near)), (5, prose(5)), (5, prose(1)), (6, None), (6, None), (7, ""), (None, ""), (None, None), (8, prose(8))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), k) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, _extra int").repartition(4)
    want = [(1, prose(1)), (3, prose(3)), (4, prose(4)), (5, prose(5)), (6, None), (7, ""), (8, prose(8)), (None, prose(2)), (None, ""), (None, None)]
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    order = lambda pairs: sorted(pairs, key=repr)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert order((r["doc_id"], r["text"]) for r in kept.collect()) == order(want)
    left = corpus_pipeline.repeated_passages(spark, kept, SF)
    assert order((r["doc_id"], r["text"]) for r in left.collect()) == order(want)


def test_length_is_measured_where_no_links_are_known(spark):
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    refs, x = unit(rng.standard_normal((4096, 8))), unit(rng.standard_normal((300, 8)))
    lone = [v for i, v in enumerate(x) if (x[:i] @ v < pivots.COSINE).all()]
    rows = [(bytes([i // 256, i % 256]), i, 1, v.tobytes()) for i, v in enumerate(lone)]
    classes = spark.createDataFrame(rows, "key binary, rep long, copies long, raw binary")
    kind, by = np.dtype(np.float64), {64: refs}
    k = pivots.enough(pivots.with_nearest(classes, by, kind), by, pivots.NEAREST, pivots.COSINE, kind)
    assert pivots.described_length(4096) < k < pivots.MOST_NEAREST
    y = unit(rng.standard_normal((2000, 8)))
    away = rng.standard_normal(y.shape)
    z = pivots.COSINE * y + math.sqrt(1 - pivots.COSINE ** 2) * unit(away - (away * y).sum(axis=1, keepdims=True) * y)
    a, b = (pivots.nearest_pivots(v, refs, k) for v in (y, z))
    assert ((a[:, :, None] == b[:, None, :]).sum(axis=(1, 2)) >= 2).mean() >= 0.9


def test_near_duplicates_stores_no_text_of_unique_ids(spark, monkeypatch):
    import corpus_pipeline
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text), (9, text + " end"), (7, "one two three four five six"), (2, None), (1, "  ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    held, plain = [], corpus_pipeline.store
    monkeypatch.setattr(corpus_pipeline, "store", lambda df, name: held.append(df.columns) or plain(df, name))
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 7]
    assert not any("text" in c for c in held)
