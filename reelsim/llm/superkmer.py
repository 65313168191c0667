"""Substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words of one text.  Its minimiser is the
smallest hash among its ``m``-word grams (leftmost on ties).  Consecutive
windows that share one minimiser occurrence form a super-k-mer.  Equal
windows have equal minimisers, so a window can repeat only where its
minimiser repeats.

1. Every super-k-mer sends its minimiser hash, nothing else; minimisers are
   counted (combined before the shuffle).
2. Super-k-mers whose minimiser occurs again travel as one packed string of
   words to their minimiser's bucket.  Those of a hot minimiser (see
   ``common.hot_limit``) travel window by window instead, to the bucket of
   the window itself; equal strings of a batch travel once, and neighbouring
   copies of one document report themselves as one run of windows.
3. Each bucket is sorted, and its windows are counted exactly, by their
   words.  Windows seen again go back to their documents as spans.
4. Every word that such a window covers is removed.

Defined results: null and empty texts have no words and stay empty; texts
under ``k`` words lose nothing; whole repeated rows count as further
occurrences, so they lose their windows; an empty table gives an empty
result.  Columns other than ``doc_id``, ``text`` and those named in ``keep``
are ignored.  Words are unchanged; the kept text joins them by one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsim.llm.common import drop, hot_limit, shuffle_partitions, split_join, store, trimmed, with_fields
from reelsim.llm.words import Words, chunks, grams, mix, text_bytes

WINDOW = 35
GRAM = 5


def superkmers(w: Words, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(minimiser, text, first window, windows)`` of every super-k-mer of
    a chunk; windows are numbered by their first word within the text."""
    h = w.hashes()
    none = np.zeros(0, np.int64)
    if len(h) < k:
        return np.zeros(0, np.uint64), none, none, none
    g = grams(h, m)
    # smallest hash first, then leftmost: the hash's top bits above the position
    bits = max(int(len(g)).bit_length(), 1)
    low = ((g >> np.uint64(bits)) << np.uint64(bits)) | np.arange(len(g), dtype=np.uint64)
    span, done = k - m + 1, 1
    while done * 2 <= span:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if span > done:
        low = np.minimum(low[:len(low) - (span - done)], low[span - done:])
    where = (low & np.uint64((1 << bits) - 1)).astype(np.int64)
    doc = w.text_of_word()
    s = np.flatnonzero(doc[:len(h) - k + 1] == doc[k - 1:])      # windows inside one text
    if not len(s):
        return np.zeros(0, np.uint64), none, none, none
    where, doc = where[s], doc[s]
    new = np.concatenate(([True], (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])))
    at = np.flatnonzero(new)
    return g[where[at]], doc[at], s[at] - w.first[doc[at]], np.diff(np.append(at, len(s)))


def merged(stay: np.ndarray, doc: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, windows)``: the rows that begin a run and the windows of the
    run.  Rows that ``stay`` are one run if they follow each other in one
    document without a gap; any other row is a run of its own."""
    on = stay[1:] & stay[:-1] & (doc[1:] == doc[:-1]) & (first[1:] == first[:-1] + n[:-1])
    at = np.flatnonzero(np.concatenate(([True], ~on)))
    return at, np.add.reduceat(n, at)


def _keyed(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(-1 << 63)).alias("_id"),
                       F.xxhash64("text").alias("_h"), *[F.col(c).alias(f"c_{c}") for c in keep])


def repeated_spans(docs: DataFrame, k: int = WINDOW, m: int = GRAM) -> DataFrame:
    """``(_id, _h, spans)``: for every text with a repeated window, its
    spans ``(first window, windows)``."""
    n_parts = shuffle_partitions(docs.sparkSession)
    slim = _keyed(docs, ("text",))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column(2))
            for i, j in chunks(offs):
                mini, doc, first, n = superkmers(Words(data, offs, i, j), k, m)
                if len(mini):
                    rows = pa.array(doc + i)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mini.view(np.int64)), b.column(0).take(rows), b.column(1).take(rows),
                         pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                        ["mini", "_id", "_h", "first", "n"])

    found = store(slim.mapInArrow(trimmed(scan), "mini long, _id long, _h long, first int, n int"), "super-k-mers")
    total = found.count()
    again = found.groupBy("mini").agg(F.count("*").alias("seen")).filter("seen > 1")
    limit = hot_limit(total)
    again = store(again, "minimisers")
    hits = split_join(found, again, "mini", "seen", total, "inner",
                      F.xxhash64("_id", "first"))
    per_doc = (hits.groupBy("_id", "_h")
                   .agg(F.collect_set(F.struct("mini", "first", "n", (F.col("seen") > limit).alias("hot"))).alias("parts")))
    per_doc = store(per_doc, "parts")
    drop(found, again)
    texts = slim.repartition(n_parts, "_id", "_h").join(per_doc.hint("merge"), ["_id", "_h"]).select("_id", "_h", "c_text", "parts")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column(2))
            ids, hs, lists = b.column(0), b.column(1), b.column(3)
            at, rows = lists.offsets.to_numpy(), lists.values
            mini, first, n = (rows.field(x).to_numpy() for x in range(3))
            hot = rows.field(3).to_numpy(zero_copy_only=False)
            bucket, packed, doc, begin, seen = [], [], [], [], []
            sent: dict[bytes, int] = {}

            def send(key, text, t, s):
                old = sent.get(text)
                if old is not None:                       # repeats here already: one copy travels
                    seen[old] += 1
                    bucket.append(None)
                else:
                    sent[text] = len(packed)
                    bucket.append(key)
                packed.append(text)
                doc.append(t)
                begin.append(s)
                seen.append(1)

            def flush():
                if not packed:
                    return None
                stay = np.array([x is None for x in bucket])
                at, n = merged(stay, np.array(doc), np.array(begin), np.array([p.count(b" ") + 2 - k for p in packed]))
                many = np.array([seen[sent[packed[x]]] > 1 for x in at])
                # copies only report themselves: they need no bucket, an own key spreads them
                keys = [bucket[x] if bucket[x] is not None else (i * 0x9E3779B97F4A7C15 >> 3) % (1 << 62) for i, x in enumerate(at)]
                take = pa.array(np.array(doc)[at])
                out = pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array([None if stay[x] else packed[x] for x in at], pa.binary()),
                     ids.take(take), hs.take(take), pa.array(np.array(begin)[at], pa.int32()), pa.array(many),
                     pa.array(n, pa.int32()), pa.array(stay[at])],
                    ["bucket", "packed", "_id", "_h", "first", "many", "n", "stay"])
                for x in (bucket, packed, doc, begin, seen):
                    x.clear()
                sent.clear()
                return out

            size = 0
            for i, j in chunks(offs):
                w = Words(data, offs, i, j)
                raw = w.data.tobytes()
                for t in range(i, j):
                    f = int(w.first[t - i])
                    for x in int(at[t]) + np.argsort(first[at[t]:at[t + 1]], kind="stable"):
                        a = f + int(first[x])
                        if not hot[x]:
                            z = a + int(n[x]) + k - 1
                            text = b" ".join(raw[int(w.starts[a]):int(w.ends[z - 1])].split())
                            send(int(mini[x]), text, t, int(first[x]))
                            size += len(text) + 200
                        else:
                            for y in range(int(n[x])):
                                text = b" ".join(raw[int(w.starts[a + y]):int(w.ends[a + y + k - 1])].split())
                                key = int(mix(np.array([hash_bytes(text)], np.uint64)).view(np.int64)[0])
                                send(key, text, t, int(first[x]) + y)
                                size += len(text) + 200
                if size > 16 << 20:
                    size = 0
                    yield flush()
            if packed:
                yield flush()

    parts = texts.mapInArrow(trimmed(pack), "bucket long, packed binary, _id long, _h long, first int, many boolean, n int, stay boolean")
    dealt = parts.repartition(n_parts, "bucket").sortWithinPartitions("bucket")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        out: list[tuple] = []

        def close():
            if len(group) == 1 and not group[0][3]:
                return
            flags = [np.full(r[5], r[3]) for r in group]
            seen: dict[bytes, tuple[int, int]] = {}
            for x, r in enumerate(group):
                if r[0] is None:
                    continue
                p, flag = r[0], flags[x]
                cut = [0, *(y + 1 for y, c in enumerate(p) if c == 32)]
                end = [*(c - 1 for c in cut[1:]), len(p)]
                for s in range(r[5]):
                    old = seen.setdefault(p[cut[s]:end[s + k - 1]], (x, s))
                    if old != (x, s):
                        flags[old[0]][old[1]] = True
                        flag[s] = True
            for r, flag in zip(group, flags):
                edge = np.flatnonzero(np.diff(np.concatenate(([0], flag.astype(np.int8), [0]))))
                out.extend((r[1], r[2], r[4] + int(a), int(z - a)) for a, z in zip(edge[::2], edge[1::2]))

        def flush():
            cols = list(zip(*out)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                              ["_id", "_h", "first", "n"])

        for b in batches:
            keys = b.column(0).to_numpy()
            cols = [b.column(x).to_pylist() for x in (1, 2, 3, 5, 4, 6)]
            for q, r in zip(keys, zip(*cols)):
                if q != key:
                    if group:
                        close()
                    key, group = q, []
                group.append(r)
            if len(out) > 20_000:
                yield flush()
        if group:
            close()
        yield flush()

    spans = dealt.mapInArrow(trimmed(count), "_id long, _h long, first int, n int")
    spans = store(spans.groupBy("_id", "_h").agg(F.collect_set(F.struct("first", "n")).alias("spans")), "spans")
    drop(per_doc)
    return spans


def hash_bytes(text: bytes) -> int:
    import hashlib
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def remove_repeats(docs: DataFrame, k: int = WINDOW, m: int = GRAM, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, then ``n_words``, ``n_removed`` and ``kept_text``."""
    n_parts = shuffle_partitions(docs.sparkSession)
    cols = tuple(c for c in keep if c not in ("text", "n_words", "n_removed", "kept_text"))
    spans = repeated_spans(docs, k, m)
    left = _keyed(docs, ("text", *cols)).repartition(n_parts, "_id", "_h")
    both = left.join(spans.hint("merge"), ["_id", "_h"], "left").select(*[f"c_{c}" for c in cols], "c_text", "spans")
    nc = len(cols)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, spans = b.column(nc), b.column(nc + 1)
            n_words, n_removed, kept, size, begin = [], [], [], 0, 0

            def flush(end):
                return pa.RecordBatch.from_arrays(
                    [*(c.slice(begin, end - begin) for c in b.columns[:nc]), pa.array(n_words, pa.int64()),
                     pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    [*cols, "n_words", "n_removed", "kept_text"])

            for t in range(len(b)):
                raw = text[t].as_py()
                words = (raw or "").encode().split()
                n_words.append(len(words))
                if spans[t].is_valid:
                    flag = np.ones(len(words), bool)
                    for s in spans[t].as_py():
                        flag[s["first"]:s["first"] + s["n"] + k - 1] = False
                    n_removed.append(len(words) - int(flag.sum()))
                    words = [words[x] for x in np.flatnonzero(flag)]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words).decode())
                size += len(kept[-1])
                if size > 8 << 20:
                    yield flush(t + 1)
                    n_words, n_removed, kept, size, begin = [], [], [], 0, t + 1
            if n_words:
                yield flush(len(b))

    schema = with_fields(docs.select(*cols).schema, n_words=T.LongType(), n_removed=T.LongType(), kept_text=T.StringType())
    return both.mapInArrow(trimmed(cut), schema)
