"""Rows without ids, repeated rows and clashing names."""

import gzip
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelsim.llm import common, jaccard, mixing, packing, pivots, quality, splitters, warc
from reelsim.llm.common import release
from reelsim.llm.queries import tokenizer_path


def test_shards_of_rows_that_are_all_alike(spark):
    """A third of the rows without an id and with one text, another third one
    row over and over: every shard still has its share."""
    rows = [(None, "the same text") if i % 3 == 0 else (7, "one row") if i % 3 == 1 else (i, f"text {i} " + "x" * (i % 60)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = splitters.shard_documents(df, 7)
    by = got.groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    total = sum(len(t) + 16 for _, t in rows)
    assert sorted(r.shard for r in by) == list(range(7))
    assert all(abs(r.s - total / 7) <= 2 * 100 and r.n == r.d == r.m + 1 for r in by)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(rows)
    release(spark)


def test_mixing_carries_columns_of_any_name(spark):
    names = ["total", "docs", "quota", "copies", "row", "key", "_h", "_b", "_run", "_at", "_before", "_t", "_r", "_hk", "_hot", "a.b"]
    rows = [(i, f"s{i % 4 if i < 60 else 0}", "word " * (1 + i % 9), *(f"{n}{i}" for n in names)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, " + ", ".join(f"`{n}` string" for n in names))
    measured = mixing.measure(df)
    out = mixing.permute(mixing.realise(measured, mixing.mixture(measured))).collect()
    assert {r.doc_id for r in out} == set(range(200))
    assert all(r[n] == f"{n}{r.doc_id}" for r in out for n in names)
    release(spark)


def test_vectors_without_an_id_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [1.0, 0.01]), (3, [0.0, 1.0])]
    got = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in got if r.vec_id) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, None)] * 2
    release(spark)


def brute_groups(rows, n, p):
    """Smallest doc_id reachable by links, by comparing all sets."""
    sets = {}
    for i, t in rows:
        w = (t or "").split()
        sets[i] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    ids, root = sorted(sets), {i: i for i in sets}
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("group,block", [(1 << 14, 2048), (8, 2048), (8, 4), (3, 1)])
def test_long_shingle_groups_are_cut_into_blocks(spark, monkeypatch, group, block):
    """Texts of a few stock paragraphs share all their shingles with many
    others; short tails and dropped words make links of every kind."""
    r = random.Random(5)
    stock = [[f"p{x}_{i}" for i in range(r.randrange(8, 30))] for x in range(9)]
    rows = []
    for i in range(160):
        w = [x for q in sorted(r.sample(range(9), r.randrange(3, 7))) for x in stock[q]]
        rows.append((i, " ".join(w[r.randrange(0, 4):] + [f"t{i}_{x}" for x in range(r.randrange(0, 5))])))
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_groups(rows, 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(df, 5, 80, 100).collect()} == want
    assert 20 < len({c for _, c in want.values()}) < 150
    release(spark)


def test_prefix_pairs_are_the_same_in_blocks(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, " ".join(f"w{x}" for x in sorted(r.sample(range(40), r.randrange(20, 40))))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = jaccard.document_sets(docs, 1).selectExpr("doc_id AS node", "cast(n_shingles AS int) AS n", "doc_id AS label")
    nodes, seg = common.store(nodes, "nodes"), common.store(jaccard.segments(docs, nodes, 1), "segments")

    def pairs(group, block):
        monkeypatch.setattr(jaccard, "GROUP", group)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        return {tuple(x) for x in jaccard.prefix_pairs(nodes, seg, 80, 100).collect()}

    sets = {i: set(t.split()) for i, t in rows}
    whole = pairs(1 << 14, 2048)
    assert pairs(7, 2048) == pairs(7, 3) == pairs(1, 2) == whole
    assert all(a < b and na == len(sets[a]) and nb == len(sets[b]) for a, b, na, nb in whole)
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert links and links <= {x[:2] for x in whole}
    release(spark)


def test_groups_of_hot_copies_and_texts_without_words(spark, monkeypatch):
    """Copies that link with no other text, and many rows without words."""
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(i, one if i % 3 == 0 else None if i % 3 == 1 else two + (" tail" if i % 2 else "")) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(df).collect()}
    assert got == brute_groups(rows, 5, 80) and got[57] == (26, 0) and got[58] == (0, 58) and got[59][1] == 2
    release(spark)


def test_packing_spreads_rows_of_one_id(spark):
    """A third without an id, a third one row over and over: every row is
    packed whole, and no task gets all rows of an id."""
    rows = [(None, f"free text {i % 5}") if i % 3 == 0 else (7, "one row of words") if i % 3 == 1 else (i, f"text {i}") for i in range(3000)]
    df = common.store(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "rows")
    got = packing.pack(df, tokenizer_path(), with_ids=True).collect()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    ids = {t: [*tok.encode(t, add_special_tokens=False).ids, 2] for _, t in rows}
    whole, part = Counter(), {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):     # pieces of a row follow each other
        assert len(r.ids) == r.length and (r.start == 0 or part[r.sequence_id >> 32][1] == r.start)
        before = part.get(r.sequence_id >> 32, ([], 0))[0] if r.start else []
        part[r.sequence_id >> 32] = (before + r.ids, r.start + r.length)
        if r.start + r.length == r.doc_tokens:
            whole[r.doc_id, tuple(before + r.ids)] += 1
    assert whole == Counter((i, tuple(ids[t])) for i, t in rows)
    for key in (None, 7):
        tasks = Counter(r.sequence_id >> 32 for r in got if r.doc_id == key)
        assert len(tasks) > 1 and max(tasks.values()) < 800
    release(spark)


def test_an_id_of_many_rows_teaches_once(spark):
    docs = [(i, " ".join(f"word{(i * 7 + j * 13) % 301}" if i < 40 else f"W{j % 3}$$$" for j in range(5 + i))) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, quality int")
    more = docs + [docs[0], docs[79]] * 50 + [(3, docs[3][1] + " zzz")] * 20 + [(None, "x")] * 9 + [(4, None)] * 9
    fits = [quality.fit(spark.createDataFrame(d, "doc_id long, text string"), labels) for d in (docs, more)]
    assert fits[0] == fits[1]


def record(i: int, block: bytes) -> bytes:
    return f"WARC/1.1\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("members", [1, 3])
def test_inflation_is_bounded(monkeypatch, members):
    """Long runs of one byte inflate a thousandfold; pieces stay small."""
    monkeypatch.setattr(warc, "READ_BYTES", 1000)
    records = [record(i, b"x" * n) for i, n in enumerate((0, 10, 700_000, 999, 1000, 1001, 250_000))] * members
    whole = b"".join(gzip.compress(b"".join(records[k::members])) for k in range(members))
    assert max(map(len, warc.inflated(io.BytesIO(whole)))) <= 1000
    want = [x for k in range(members) for x in records[k::members]]
    assert list(warc.records_of(io.BytesIO(whole))) == want
    for cut in (1, 8, 9, len(whole) // 2):
        with pytest.raises(ValueError, match="truncated"):
            list(warc.records_of(io.BytesIO(whole[:-cut])))


def test_a_failed_task_leaves_no_part(tmp_path):
    from reelsim.llm.files import whole_file
    with pytest.raises(RuntimeError):
        with whole_file(f"{tmp_path}/a/b.gz") as out:
            out.write(b"half")
            raise RuntimeError
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_deals_hot_and_null_keys_over_tasks(spark, monkeypatch, how):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 50}") for i in range(3000)]
    left = common.store(spark.createDataFrame(rows, "i long, k string"), "left")
    right = common.store(spark.createDataFrame([("hot", 1000, 1), ("k5", 10, 2), ("k7", 5, 3), ("other", 3, 4)], "k string, n long, v int"), "right")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = common.split_join(left, right, "k", "n", len(rows), how, F.xxhash64("i"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        got = {(r.i, r.k): r.v for r in j.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    value = {"hot": 1, "k5": 2, "k7": 3}
    assert got == {x: value.get(x[1]) for x in rows if how == "left" or x[1] in value}
    if how == "left":
        assert "hashpartitioning(k#" in plan and "_ls#" in plan.split("hashpartitioning(k#")[1].split(")")[0]
    release(spark)
