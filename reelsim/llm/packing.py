"""Order-preserving packing of token streams by dynamic programming.

Documents follow each other in ``doc_id`` order, each closed by an end id.
Windows of at most ``size`` ids are cut out of that stream.  A cut at a
document's end is free, one at a sentence's end costs ``SENTENCE`` and one
inside a long sentence ``WITHIN``; padding costs one per id.  A window is
padded to ``size`` unless its length is a power of two.

``best[j] = min(best[i] + size - (p[j] - p[i]))`` over the boundaries ``i``
within ``size`` ids before ``j`` is a sliding minimum of ``best[i] + p[i]``,
kept in a monotone queue; windows of a power of two are further transitions.
So the work is linear in the number of boundaries.

The table is range-partitioned by ``doc_id`` (rows of one id, or without
one, may lie in several ranges); every task packs its own stretch of the order, a million ids at a time, and splits what is left at
the end of a stretch into powers of two.  Memory is bounded by a stretch (or
by one document, if that is longer).

Defined results: a null or empty text is the end id alone; rows without a
doc_id come first; rows of one id follow each other in hash order of their
texts; repeated rows are packed as often as they occur; an
empty table gives no piece.  Other columns are ignored.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsim.llm.common import shuffle_partitions, trimmed
from reelsim.llm.words import chunks, hash_ranges, text_bytes

SIZE = 4096
END = 2
SENTENCE = 8.0
WITHIN = 24.0
# A gap between boundaries longer than this gets cuts of its own.
LONG_GAP = 64
STRETCH = 1 << 20
# The encoder's memory: places for pre-tokens, and ids in all.
SLOTS = 1 << 21
FLAT = 1 << 24
PROBES = (0, 11, 23, 37)
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Token ids of texts, with a bounded memory of pre-tokens.

    The tokenizer lower-cases, splits at white space, which it drops, and
    then into runs of letters, runs of symbols and single digits; every such
    pre-token is encoded by itself.  Its ids are remembered under a 64-bit
    hash in a table of ``SLOTS`` places; a pre-token that finds no place
    there takes another's.  Blank-separated words with a character beyond
    ASCII and Latin-1 letters, an apostrophe, a control character or ``<|``
    go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        n = max(vocab.values()) + 1
        self.last, self.stop = np.zeros(n, bool), np.zeros(n, bool)
        for piece, i in vocab.items():
            self.last[i] = piece.endswith("</w>")
            self.stop[i] = piece.endswith("</w>") and any(c in piece[:-4] for c in ".!?")
        kind = np.full(256, 3, np.uint8)                  # symbols
        kind[[32, 9, 10, 11, 12, 13]] = 0
        kind[ord("a"):ord("z") + 1] = kind[ord("A"):ord("Z") + 1] = 1
        kind[ord("0"):ord("9") + 1] = 2
        kind[:9] = kind[14:32] = kind[127:] = kind[39] = 4   # odd
        self.kind = kind
        self.low = np.arange(256, dtype=np.uint8)
        self.low[ord("A"):ord("Z") + 1] += 32
        self.clear()

    def forget(self):
        """Give the memory back; :meth:`clear` makes it anew."""
        self.keys = self.place = self.flat = None

    def clear(self):
        self.keys = np.zeros(SLOTS, np.uint64)
        self.place = np.zeros(SLOTS, np.int64)            # first id and number of ids
        self.flat, self.used = np.zeros(1 << 20, np.uint16 if len(self.stop) <= 65536 else np.uint32), 0

    def _pretokens(self, raw: np.ndarray, off: np.ndarray):
        """``(bytes, starts, ends, odd)`` of the pre-tokens of some texts."""
        data, kind = self.low[raw], self.kind[raw]
        n = len(raw)
        lead = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0xBF) & (raw[1:] != 0x97) & (raw[1:] != 0xB7))
        kind[lead] = kind[lead + 1] = 1
        up = lead[(raw[lead + 1] < 0x9F)] + 1
        data[up] += 32
        kind[np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))] = 4
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        if (kind == 4).any():
            # the whole blank-separated word of an odd byte is odd
            blank = kind == 0
            new = ~blank
            new[1:] &= blank[:-1] | edge[1:n]
            word = np.cumsum(new)
            odd = np.zeros(int(word[-1]) + 1, bool)
            odd[word[kind == 4]] = True
            whole = odd[word] & ~blank
            kind[whole] = 4
            data[whole] = raw[whole]
        new = kind != 0
        new[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2) | edge[1:n]
        end = kind != 0
        end[:-1] &= (kind[1:] != kind[:-1]) | (kind[:-1] == 2) | edge[1:n]
        starts = np.flatnonzero(new)
        return data, starts, np.flatnonzero(end) + 1, kind[starts] == 4

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Places of known hashes, -1 for others."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for shift in PROBES:
            slot = ((h[left] >> np.uint64(shift)) & np.uint64(SLOTS - 1)).astype(np.int64)
            ok = self.keys[slot] == h[left]
            out[left[ok]] = self.place[slot[ok]]
            left = left[~ok]
            if not len(left):
                break
        return out

    def _learn(self, h: np.ndarray, texts: list[str], odd: np.ndarray) -> np.ndarray:
        """Encode new pre-tokens and return their places."""
        size, ids = np.zeros(len(h), np.int64), []
        plain = np.flatnonzero(~odd)
        # plain pre-tokens end at an id that closes a word, so many go at once
        got = np.array(self.tok.encode(" ".join([texts[x] for x in plain]), add_special_tokens=False).ids, np.int64)
        size[plain] = np.diff(np.concatenate(([0], np.flatnonzero(self.last[got]) + 1)))
        whole = np.flatnonzero(odd)
        rest = [e.ids for e in self.tok.encode_batch([texts[x] for x in whole], add_special_tokens=False)]
        size[whole] = [len(x) for x in rest]
        ids = np.concatenate((got, np.array([y for x in rest for y in x], np.int64))).astype(self.flat.dtype)
        order = np.concatenate((plain, whole))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used:self.used + len(ids)] = ids
        place = np.zeros(len(h), np.int64)
        place[order] = (self.used + np.cumsum(size[order]) - size[order]) << 24 | size[order]
        self.used += len(ids)
        left = np.arange(len(h))
        for shift in (*PROBES, PROBES[0]):
            slot = ((h[left] >> np.uint64(shift)) & np.uint64(SLOTS - 1)).astype(np.int64)
            free = (self.keys[slot] == 0) | (len(left) < len(h) and shift == PROBES[0])
            _, one = np.unique(slot, return_index=True)
            take = one[free[one]]
            self.keys[slot[take]] = h[left[take]]
            self.place[slot[take]] = place[left[take]]
            left = np.delete(left, take)
            if not len(left):
                break
        return place

    def __call__(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the texts, each closed by END."""
        data, offs = text_bytes(arr)
        raw, off = data[int(offs[0]):int(offs[-1])], offs - offs[0]
        if not len(raw):
            return np.full(len(arr), END, np.int64), np.arange(len(arr) + 1)
        if self.used + len(raw) > FLAT:                   # an id takes a byte at least
            self.clear()
        data, starts, ends, odd = self._pretokens(raw, off)
        h = hash_ranges(data, starts, ends) | np.uint64(1)
        place = self._find(h)
        miss = np.flatnonzero(place < 0)
        if len(miss):
            _, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            one = miss[one]
            every = data.tobytes()
            texts = [every[a:b].decode() for a, b in zip(starts[one].tolist(), ends[one].tolist())]
            place[miss] = self._learn(h[one], texts, odd[one])[back]
        size = place & ((1 << 24) - 1)
        ends_at = np.cumsum(size)
        total = int(ends_at[-1]) if len(size) else 0
        ids = self.flat[np.repeat((place >> 24) - (ends_at - size), size) + np.arange(total)]
        per = np.concatenate(([0], ends_at))[np.searchsorted(starts, off[1:])]
        return np.insert(ids, per, END), np.concatenate(([0], per + np.arange(1, len(arr) + 1)))


def encoder(path: str) -> Encoder:
    """One encoder per worker process, whatever function asks; what it
    remembers goes with the task (see :func:`pack`)."""
    kept = sys.modules.setdefault("_reelsim_encoders", types.ModuleType("_reelsim_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    elif kept[path].keys is None:
        kept[path].clear()
    return kept[path]


def boundaries(ids: np.ndarray, docs: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending from 0, and the cost of
    each.  ``docs`` are the documents' offsets."""
    total = len(ids)
    cost = np.full(total + 1, np.inf)
    cost[np.flatnonzero(stop[ids]) + 1] = SENTENCE
    cost[docs] = 0.0
    p = np.flatnonzero(np.isfinite(cost))
    gap = np.diff(p)
    for x in np.flatnonzero(gap > LONG_GAP):
        cost[np.arange(p[x] + LONG_GAP, p[x + 1], LONG_GAP)] = WITHIN
    p = np.flatnonzero(np.isfinite(cost))
    return p, cost[p]


def cut_windows(p: np.ndarray, cost: np.ndarray, size: int) -> np.ndarray:
    """The boundaries of the cheapest windows, first and last included."""
    n = len(p)
    jumps: dict[int, list[int]] = {}
    k = 64
    while k < size:
        at = np.searchsorted(p, p - k)
        for j in np.flatnonzero((p >= k) & (p[at] == p - k)).tolist():
            jumps.setdefault(j, []).append(int(at[j]))
        k *= 2
    pos, extra = p.tolist(), cost.tolist()
    best, back = [0.0] * n, [0] * n
    queue = deque([(0.0, 0)])                 # best[i] + p[i], ascending
    push, pop, popleft = queue.append, queue.pop, queue.popleft
    for j in range(1, n):
        x = pos[j]
        least = x - size
        while pos[queue[0][1]] < least:
            popleft()
        value, i = queue[0]
        value += size - x
        hit = jumps.get(j)
        if hit:
            for h in hit:
                if best[h] < value:
                    value, i = best[h], h
        value += extra[j] + 1.0               # one more sequence
        best[j], back[j] = value, i
        value += x
        while queue and queue[-1][0] >= value:
            pop()
        push((value, j))
    out, j = [], n - 1
    while j:
        out.append(pos[j])
        j = back[j]
    out.append(0)
    cuts = out[::-1]
    # the rest of the stretch: powers of two instead of a long padding
    rest = cuts[-1] - cuts[-2]
    if size - rest > WITHIN * bin(rest).count("1"):
        cuts.pop()
        while rest:
            k = 1 << (rest.bit_length() - 1)
            cuts.append(cuts[-1] + k)
            rest -= k
    return np.array(cuts, np.int64)


def pack(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence; ``with_ids`` adds the
    piece's ids (``array<int>``)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        seq = TaskContext.get().partitionId() << 32
        held_ids, held_docs, held = [], [], 0

        def flush():
            nonlocal seq, held
            ids = np.concatenate([x for x, _ in held_ids])
            lens = np.concatenate([np.diff(o) for _, o in held_ids])
            doc_id = pa.concat_arrays(held_docs)
            held_ids.clear()
            held_docs.clear()
            held = 0
            off = np.concatenate(([0], np.cumsum(lens)))
            cuts = cut_windows(*boundaries(ids, off, enc.stop), size)
            at = np.unique(np.concatenate((cuts, off)))
            a, b = at[:-1], at[1:]
            doc = np.searchsorted(off, a, "right") - 1
            win = np.searchsorted(cuts, a, "right") - 1
            raw = ids.astype("<u4")
            crc = np.array([zlib.crc32(raw[x:y].tobytes()) for x, y in zip(a.tolist(), b.tolist())], np.int64)
            cols = [doc_id.take(pa.array(doc)), a - off[doc], b - a, crc, lens[doc], seq + win, a - cuts[win]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(at.astype(np.int32), ids.astype(np.int32)))
                names.append("ids")
            seq += len(cuts) - 1
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in cols], names)

        for b in batches:
            texts = b.column(1)
            for i, j in chunks(text_bytes(texts)[1], 1 << 20):
                held_ids.append(enc(texts.slice(i, j - i)))
                held_docs.append(b.column(0).slice(i, j - i))
                held += len(held_ids[-1][0])
                if held >= STRETCH:
                    yield flush()
        if held:
            yield flush()
        enc.forget()

    n_parts = shuffle_partitions(docs.sparkSession)
    # order-preserving: one range of doc_ids per task, sorted; rows that repeat
    # an id or have none are told apart by their texts, and equal rows by
    # their places in the stored table, so a range can end among them
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_row"))
    dealt = rows.repartitionByRange(n_parts, "doc_id", "_h", "_row").sortWithinPartitions("doc_id", "_h", "_row")
    dealt = dealt.select("doc_id", "text")
    return dealt.mapInArrow(trimmed(work), PIECE + (", ids array<int>" if with_ids else ""))
