"""Operators on documents against brute force on a small odd table."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsim.llm import jaccard, mixing, packing, quality, sketch, splitters, superkmer
from reelsim.llm.common import release
from reelsim.llm.queries import tokenizer_path

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("n,p", [(4, 85), (5, 80)])
def test_jaccard_groups(odd_documents, n, p):
    t, sets = texts(odd_documents), {}
    for i, x in t.items():
        w = WORD.findall((x or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    links = [(a, b) for a in t for b in t if a < b and sets[a] and
             100 * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b])]
    want = components(t, links)
    got = jaccard.similar_groups(odd_documents, n, p, 100).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), want[i]) for i in t}
    assert want[3] == want[2] == 1 and want[8] == 7


def test_jaccard_small_sets_lose_no_pair(spark):
    """Every edit distance around the threshold, on sets of all small sizes."""
    rows, i = [], 0
    for n in range(1, 60, 3):
        base = [f"b{n}_{x}" for x in range(n + 3)]
        for cut in range(0, 4):
            for tail in range(0, 3):
                rows.append((i, " ".join(base[cut:] + [f"t{i}_{x}" for x in range(tail)])))
                i += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = {k: {tuple(w[j:j + 4]) for j in range(len(w) - 3)} or {tuple(w)} for k, w in ((k, t.split()) for k, t in rows)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = components(sets, links)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(df, 4, 85, 100).collect()} == want


@pytest.mark.parametrize("a,b,p", [(16, 26, 60), (6, 11, 50), (16, 20, 80)])
def test_contained_sets_share_a_signature(a, b, p):
    """The smaller set may lie several bands of sizes below the larger."""
    sign = jaccard.Signer(p, 100)
    for seed in range(50):
        s = np.random.default_rng(seed).choice(1 << 62, b, replace=False).astype(np.uint64) * np.uint64(4)
        assert set(sign(np.sort(s[:a])).tolist()) & set(sign(np.sort(s)).tolist())


@pytest.mark.parametrize("k,hot", [(35, 1000), (35, 1), (8, 2)])
def test_repeats_are_removed(odd_documents, monkeypatch, k, hot):
    from reelsim.llm import common
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    t = {i: WORD.findall(x or "") for i, x in texts(odd_documents).items()}
    seen = Counter(tuple(w[j:j + k]) for w in t.values() for j in range(len(w) - k + 1))
    want = {}
    for i, w in t.items():
        gone = {x for j in range(len(w) - k + 1) if seen[tuple(w[j:j + k])] > 1 for x in range(j, j + k)}
        want[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    got = superkmer.remove_repeats(odd_documents, k, 3 if k == 8 else 5).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got} == want
    assert want[12][1] == 200 and (k != 35 or want[13][1] == 0 and want[14][1] == 35)


def test_whole_repeated_rows_are_occurrences(odd_documents):
    two = odd_documents.filter("doc_id in (9, 13)")
    got = superkmer.remove_repeats(two.unionByName(two)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(9, 3000), (9, 3000), (13, 0), (13, 0)]


def test_shards_are_even_and_gapless(odd_documents):
    got = splitters.shard_documents(odd_documents, 5, ("doc_id", "text", "size")).collect()
    t = texts(odd_documents)
    size = {i: len((x or "").encode()) + 16 for i, x in t.items()}
    assert {r["doc_id"]: r["size"] for r in got} == size and len(got) == len(t)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
        assert (r["text"], r["law"]) == (t[r["doc_id"]], "bytes")
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert sum(r["size"] for r in rows) <= sum(size.values()) / 5 + max(size.values())


def test_shards_with_a_hot_text(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same " * 9))
                                  .otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = splitters.shard_documents(df, 7).groupBy("shard").agg(F.sum("size").alias("s"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    s = [r["s"] for r in got]
    assert len(s) == 7 and max(s) - min(s) <= 2 * 61 and all(r["m"] == r["n"] - 1 for r in got)


def test_sketches(odd_documents):
    rows = sketch.compare_with_edits(odd_documents).select(
        "*", sketch.jaccard("sketch", "edited_sketch").alias("near"), sketch.containment("sketch", "edited_sketch").alias("held"),
        sketch.fingerprint("sketch").alias("f")).collect()
    t = texts(odd_documents)
    ids = sorted(t, reverse=True)
    text = {i: t[i] or "" for i in ids}
    assert len(rows) == len(t)
    by = {r["doc_id"]: r for r in rows}
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        k = len(text[i]) // 3
        assert by[i]["edited"] == (text[i][:len(text[i]) - k] + text[nxt][:k])
        assert by[i]["next_sketch"] == by[nxt]["sketch"]
    assert by[1]["f"] == by[2]["f"] != "" and by[4]["f"] == by[5]["f"] == by[6]["f"] == ""
    # the share of hashes kept, and estimates near the truth on a long text
    assert 0.2 < len(by[9]["sketch"]["kept"]) / 2996 < 0.3
    # the next text is short, so two thirds stay and little comes
    assert abs(by[9]["held"] - 2 / 3) < 0.08 and abs(by[9]["near"] - 2 / 3) < 0.08


def brute_sketch(text):
    """The sketch of a text, hash by hash: words, then shingles of words."""
    import struct

    import xxhash

    def signed(h):
        return h - (1 << 64) if h >> 63 else h

    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall("[^\x20\x09-\x0D]+", (text or "").lower())]

    def fold(run):
        h = 42
        for x in run:
            h = xxhash.xxh64_intdigest(struct.pack("<q", x), h)
        return h

    if len(words) >= sketch.WORDS:
        got = {signed(fold(words[i:i + sketch.WORDS])) for i in range(len(words) - sketch.WORDS + 1)}
    else:
        got = {signed(xxhash.xxh64_intdigest(struct.pack("<i", sketch.WORDS), fold(words)))} if words else set()
    limit = int(sketch.FRACTION * 2 ** 64) - 2 ** 63
    return {x for x in got if x < limit}, min(got, default=None)


def test_sketches_by_brute_force_and_their_merge(odd_documents):
    t = texts(odd_documents)
    made = sketch.add_sketch(odd_documents, "text", "s").select("doc_id", "s", sketch.fingerprint("s").alias("f"))
    want = {i: brute_sketch(x) for i, x in t.items()}
    for r in made.collect():
        kept, least = want[r["doc_id"]]
        assert (r["s"]["kept"], r["s"]["least"]) == (sorted(kept), least)
        assert r["f"] == "".join(f"{x % (1 << 64):016x}" for x in sorted(kept) or ([least] if least is not None else []))
    # a group's merged sketch is that of all shingles of its documents
    group = (F.col("doc_id") % 3).alias("g")
    for r in made.groupBy(group).agg(sketch.merge("s").alias("m")).collect():
        mine = [want[i] for i in t if i % 3 == r["g"]]
        least = min((x for _, x in mine if x is not None), default=None)
        assert (r["m"]["kept"], r["m"]["least"]) == (sorted(set().union(*(k for k, _ in mine))), least)


def test_mixing(odd_documents):
    m = mixing.measure(odd_documents.select("doc_id", "text", "source", "block"))
    plan = mixing.mixture(m, 2.5, 0.99).collect()
    assert sum(r["weight"] for r in plan) == pytest.approx(1)
    assert max(r["quota"] / r["total"] for r in plan) <= 2.5 + 1e-6
    out = mixing.permute(mixing.realise(m, mixing.mixture(m, 2.5, 0.99), block_tokens=500)).collect()
    t = texts(odd_documents)
    assert {r["doc_id"] for r in out} == set(t)
    tokens = defaultdict(int)
    for r in out:
        assert r["tokens"] == len(WORD.findall(t[r["doc_id"]] or "")) + 1
        tokens[r["source"]] += r["tokens"]
    longest = max(r["tokens"] for r in out)
    for r in plan:
        assert r["quota"] - 1 <= tokens[r["source"]] <= r["quota"] + longest
    for b in {r["block"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["block"] == b)
        assert slots == list(range(len(slots)))


def test_exponent_against_bisection(spark):
    totals = [1000, 300, 50, 7, 1]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(totals)], "source string, total long")

    def entropy(a):
        z = [x ** a for x in totals]
        return -sum(x / sum(z) * math.log(x / sum(z)) for x in z)
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(mid) >= 0.8 * math.log(5) else (low, mid)
    assert mixing.find_exponent(df, 1e9, 0.8)[0] == pytest.approx(low, abs=1e-5)
    assert mixing.find_exponent(df, 4.0, 1.0)[0] == pytest.approx(1 - math.log(4) / math.log(1000), abs=1e-5)


def test_packing_round_trip(odd_documents):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    t = texts(odd_documents)
    want = {i: tok.encode(x or "", add_special_tokens=False).ids + [2] for i, x in t.items()}
    rows = packing.pack(odd_documents, tokenizer_path(), with_ids=True).collect()
    got, seq = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == len(got[r["doc_id"]]) and r["length"] == len(r["ids"]) and r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        got[r["doc_id"]] += r["ids"]
        seq[r["sequence_id"]].append(r)
    assert dict(got) == want
    order = []
    for s in sorted(seq):
        rows = sorted(seq[s], key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == [sum(x["length"] for x in rows[:i]) for i in range(len(rows))]
        assert sum(r["length"] for r in rows) <= 4096
        order += [r["doc_id"] for r in rows]
    assert order == sorted(order)


def test_windows_are_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(30):
        p = np.unique(np.concatenate(([0], np.cumsum(rng.integers(1, 60, 60)))))
        cost = rng.choice([0.0, 8.0, 24.0], len(p))
        best = [0.0] + [math.inf] * (len(p) - 1)
        for j in range(1, len(p)):
            for i in range(j):
                n = p[j] - p[i]
                if n <= 256:
                    pad = 0 if n & (n - 1) == 0 and n >= 64 else 256 - n
                    best[j] = min(best[j], best[i] + pad + cost[j] + 1)
        cuts = packing.cut_windows(p, cost, 256)
        n = np.diff(cuts)
        assert cuts[0] == 0 and cuts[-1] == p[-1] and n.max() <= 256
        at = {x: c for x, c in zip(p, cost)}
        total = sum((0 if x & (x - 1) == 0 and x >= 64 else 256 - x) + at.get(y, 0) + 1 for x, y in zip(n, cuts[1:]))
        inside = [x for x in cuts if x not in at]
        assert total <= best[-1] + 1e-9 or inside


def test_quality_on_planted_labels(spark, odd_documents):
    good = [(i, " ".join(f"word{(i * 7 + j * 13) % 301}" for j in range(40)) + ".") for i in range(200)]
    bad = [(i, " ".join(f"W{j % 3}$$$" for j in range(40))) for i in range(200, 400)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    ranker = quality.fit(docs, labels)
    out = quality.predictions(quality.score(docs, ranker)).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 50 and all(r["predicted"] == int(r["doc_id"] < 200) for r in held)
    odd = quality.score(odd_documents, ranker).collect()
    assert len(odd) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in odd)
    taught = {r["doc_id"] for r in quality.training_labels(labels).collect()}
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in taught)
    assert quality.fit(docs, labels.filter("quality = 1")) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}


def test_empty_tables(no_documents):
    labels = no_documents.selectExpr("doc_id", "n_words AS quality", "n_words AS toxic")
    assert quality.score(no_documents, quality.fit(no_documents, labels)).count() == 0
    assert jaccard.similar_groups(no_documents).count() == 0
    assert superkmer.remove_repeats(no_documents).count() == 0
    assert splitters.shard_documents(no_documents).count() == 0
    assert sketch.compare_with_edits(no_documents).count() == 0
    m = mixing.measure(no_documents)
    assert mixing.realise(m, mixing.mixture(m)).count() == 0
    assert packing.pack(no_documents, tokenizer_path()).count() == 0


def test_scratch_is_released(spark, odd_documents):
    import os
    from reelsim.llm import common
    paths = list(common._STORED.get(spark.sparkContext.applicationId, []))
    jaccard.similar_groups(odd_documents).count()
    paths = common._STORED[spark.sparkContext.applicationId][len(paths):]
    assert paths
    release(spark)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)



def test_copies_of_a_hot_passage_report_runs(spark, monkeypatch):
    """Copies inside a batch are one row per document, not one per window."""
    from pyspark.sql.classic.dataframe import DataFrame

    from reelsim.llm import common
    monkeypatch.setattr(common, "HOT_ROWS", 1)
    made, plain = [], DataFrame.mapInArrow

    def spy(df, work, schema, *args, **kw):
        out = plain(df, work, schema, *args, **kw)
        if "packed binary" in str(schema):
            made.append(out)
        return out

    monkeypatch.setattr(DataFrame, "mapInArrow", spy)
    words = lambda name, n: " ".join(f"{name}{x * 7919 % 1009}" for x in range(n))
    docs = spark.createDataFrame([(i, f"{words(f'a{i}x', 40)} {words('p', 300)} {words(f'b{i}x', 40)}") for i in range(20)], "doc_id long, text string")
    monkeypatch.setattr(superkmer, "drop", lambda *t: None)
    got = superkmer.remove_repeats(docs.coalesce(1)).collect()
    assert [r["n_removed"] for r in got] == [300] * 20
    stay = made[0].filter("stay").agg(F.count("*").alias("rows"), F.sum("n").alias("windows")).first()
    assert stay["windows"] >= 8 * 200 and stay["rows"] <= 40
