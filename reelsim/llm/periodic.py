"""Periodic runs of words: recursive frequency splitting, then a lag scan.

A run is a maximal stretch of words with smallest period ``q`` that holds at
least ``LEAST`` words and ``TIMES`` periods.  So each of its words occurs at
least ``TIMES`` times within it.  A word that occurs fewer times within its
segment (at first the whole document) can be in no run and splits it there;
the parts are counted again until nothing splits and short parts are gone.

The survivors are scanned by lag.  For periods ``K .. 2K-1`` the lag of a
place is the distance to the next equal gram of ``2K`` words.  In a run of
smallest period ``q`` that lag is exactly ``q`` at every place whose gram and
its next copy lie in the run (a nearer copy would, by Fine and Wilf, make a
smaller period), and two ``q``-apart grams fit into three periods.  So a run
is a stretch of places of one lag, and the work is n log n for each doubling
of ``K`` instead of the product of places and lags.  Grams are numbered by
doubling, from exact word numbers, so nothing rests on a hash.

Documents are worked on chunk by chunk of at most ``words.CHUNK_BYTES`` (or
one text, if it is longer), whole and within a task; there is no shuffle.

Defined results: a null, empty or blank text has no words, no run and the
hashes of the empty string; rows without a doc_id keep their words in place
(``plant``) and are scanned like any other; repeated rows give repeated
results; an empty table gives an empty result.  Only ``doc_id`` and ``text``
are read, so extra columns never clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reelsim.llm.common import bound_batches, trimmed
from reelsim.llm.words import Words, chunks, text_bytes

LEAST = 24
TIMES = 3
RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def word_array(w: Words) -> pa.Array:
    """The words of a chunk as a binary array."""
    edges = np.empty(2 * len(w.starts) + 1, np.int64)
    edges[0::2] = np.append(w.starts, len(w.data))
    edges[1::2] = w.ends
    both = pa.Array.from_buffers(pa.large_binary(), 2 * len(w.starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(w.data))])
    return both.take(pa.array(np.arange(0, 2 * len(w.starts), 2)))


def planted_order(doc_ids: list, first: np.ndarray) -> np.ndarray:
    """For every word of a chunk the word that takes its place: a tenth of
    the documents, by the crc32 of their id, get a periodic tail."""
    order = np.arange(first[-1])
    for t, i in enumerate(doc_ids):
        n = int(first[t + 1] - first[t])
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if n and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            tail = np.arange(n - a)
            order[first[t] + a:first[t + 1]] = first[t] + a + tail % p
    return order


def split_by_frequency(ids: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, ends)`` of the segments, ascending, in which every word
    occurs ``times`` times and which hold ``least`` words.  ``ids`` are the
    word numbers of a chunk, ``first`` its documents' borders."""
    starts, ends = first[:-1].astype(np.int64), first[1:].astype(np.int64)
    done = []
    while True:
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        if not len(starts):
            break
        size = ends - starts
        seg = np.repeat(np.arange(len(starts)), size)
        at = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(len(seg))
        key = seg << 32 | ids[at]
        order = np.argsort(key, kind="stable")
        s = key[order]
        edge = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True])))
        count = np.empty(len(key), np.int64)
        count[order] = np.repeat(np.diff(edge), np.diff(edge))
        rare = count < times
        hit = np.zeros(len(starts), bool)
        hit[seg[rare]] = True
        done.append(np.stack([starts[~hit], ends[~hit]]))
        # what is between rare words of a segment that was hit goes round again
        keep = ~rare & hit[seg]
        new = keep.copy()
        new[1:] &= ~keep[:-1] | (seg[1:] != seg[:-1])
        end = keep.copy()
        end[:-1] &= ~keep[1:] | (seg[1:] != seg[:-1])
        starts, ends = at[new], at[end] + 1
    got = np.concatenate(done, axis=1) if done else np.zeros((2, 0), np.int64)
    return tuple(got[:, np.argsort(got[0], kind="stable")])


def lag_scan(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = LEAST,
             times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of the runs inside the segments, by start,
    then period."""
    found = [np.zeros((3, 0), np.int64)]
    size = ends - starts
    at = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
    stop = np.repeat(ends, size)                  # end of each place's segment
    rank = ids[at].astype(np.int64)
    k = 1
    while len(at):
        # grams of 2k words from those of k words: a pair of their numbers
        # (``at`` ascends, and a segment is kept whole or not at all)
        whole = at + 2 * k <= stop
        a, here = at[whole], np.flatnonzero(whole)
        key = rank[here] << 32 | rank[here + k]
        order = np.argsort(key, kind="stable")    # equal grams by place
        s = key[order]
        same = s[1:] == s[:-1]
        lag = np.zeros(len(a), np.int64)
        nxt = np.full(len(a), -1, np.int64)
        nxt[order[:-1][same]] = a[order[1:][same]]
        inside = (nxt >= 0) & (nxt < stop[here])
        lag[inside] = nxt[inside] - a[inside]
        lag[(lag < k) | (lag >= 2 * k)] = 0
        # stretches of places of one lag
        new = lag > 0
        new[1:] &= (lag[1:] != lag[:-1]) | (a[1:] != a[:-1] + 1)
        end = lag > 0
        end[:-1] &= (lag[1:] != lag[:-1]) | (a[1:] != a[:-1] + 1)
        q = lag[new]
        length = a[end] - a[new] + q + 2 * k
        ok = length >= np.maximum(least, times * q)
        found.append(np.stack([a[new][ok], length[ok], q[ok]]))
        number = np.zeros(len(at), np.int64)
        number[here[order]] = np.concatenate(([0], np.cumsum(~same))) if len(order) else 0
        k *= 2
        # only segments of three such periods go on
        keep = np.repeat(size >= times * k, size)
        at, stop, rank, size = at[keep], stop[keep], number[keep], size[size >= times * k]
    runs = np.concatenate(found, axis=1)
    return tuple(runs[:, np.lexsort((runs[2], runs[0]))])


def collapse(words: pa.Array, order: np.ndarray, keep: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Per document, the kept words joined by one space."""
    at = np.flatnonzero(keep)
    offs = pa.array(np.searchsorted(at, first), pa.int64())
    lists = pa.LargeListArray.from_arrays(offs, words.take(pa.array(order[at])))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).to_pylist()


def _chunk(doc_ids: pa.Array, w: Words, plant: bool) -> pa.RecordBatch:
    k, first = len(doc_ids), w.first.astype(np.int64)
    words = word_array(w)
    order = planted_order(doc_ids.to_pylist(), first) if plant else np.arange(first[-1])
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[order]
    start, length, period = lag_scan(ids, *split_by_frequency(ids, first))
    doc = np.searchsorted(first, start, "right") - 1
    # words of a run after its first period go
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    texts = collapse(words, order, np.cumsum(cover[:-1]) == 0, first)
    start = start - first[doc]
    # the best run of each document; equal fractions give equal quotients,
    # and others differ by more than rounding for texts of this size
    best = np.lexsort((period, start, -length / period, doc))
    lead = best[np.flatnonzero(np.diff(doc[best], prepend=-1))]
    n_runs = np.bincount(doc, minlength=k)
    some = n_runs > 0

    def column(x):
        out = np.zeros(k, np.int64)
        out[doc[lead]] = x
        return pa.array(out, mask=~some)

    lines = [f"{s},{n},{q}\n" for s, n, q in zip(start.tolist(), length.tolist(), period.tolist())]
    to = np.cumsum(n_runs)
    runs = [hashlib.sha256("".join(lines[b - n:b]).encode()).hexdigest() for n, b in zip(n_runs.tolist(), to.tolist())]
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(n_runs, pa.int64()), column(start[lead]), column(length[lead]), column(period[lead]),
         column(1000 * length[lead] // period[lead]), pa.array(runs), pa.array([hashlib.sha256(x).hexdigest() for x in texts])],
        [f.split()[0] for f in RESULT.split(", ")])


def find_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per document: its number of runs, the run of the greatest
    exponent, and hashes of all its runs and of the text without repeated
    periods.  ``plant`` first rewrites a tenth of the documents to end in a
    period of their own, a test input with known runs."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column(1))
            for i, j in chunks(offs):
                yield _chunk(b.column(0).slice(i, j - i), Words(data, offs, i, j), plant)

    bound_batches(docs.sparkSession)
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(trimmed(work), RESULT)
