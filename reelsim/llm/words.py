"""Words, word hashes and n-gram hashes of Arrow text batches with numpy.

A word is a run of bytes other than space and ``\\x09``-``\\x0D``.  Work goes
over the UTF-8 bytes of many texts at once; memory is bounded by the chunk
size (or by one text, if a single text is longer).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 18
ODD = 0x9E3779B97F4A7C15          # odd multiplier of the byte polynomial
ODD_INV = pow(ODD, -1, 1 << 64)
GRAM = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), element-wise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)`` of a string array; nulls count as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    if bufs[1] is None or len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs


def chunks(offs: np.ndarray, most: int = CHUNK_BYTES):
    """Row ranges ``(i, j)`` of at most ``most`` bytes, or of one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """Word boundaries of the texts ``i .. j-1`` of a batch.

    ``data`` are their bytes, ``starts``/``ends`` the words' byte ranges and
    ``first`` the index of each text's first word (one entry more than
    texts).
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, i: int, j: int, lower: bool = False):
        base = int(offs[i])
        data = data[base:int(offs[j])]
        off = offs[i:j + 1] - base
        if lower:
            up = (data >= 65) & (data <= 90)
            data = data + (up.astype(np.uint8) << np.uint8(5))
        n = len(data)
        word = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.zeros(n + 1, bool)
        edge[off] = True                       # a text begins or the chunk ends
        new, end = word.copy(), word.copy()
        if n:
            new[1:] &= ~word[:-1] | edge[1:n]
            end[:-1] &= ~word[1:] | edge[1:n]
        self.data, self.off = data, off
        self.starts = np.flatnonzero(new)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, off)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        return hash_ranges(self.data, self.starts, self.ends)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ascending byte ranges that do not overlap: a byte
    polynomial modulo 2**64 taken from prefix sums over blocks, then mixed."""
    out = np.empty(len(starts), np.uint64)
    w, n = 0, len(starts)
    while w < n:
        s = int(starts[w])
        w2 = max(int(np.searchsorted(ends, s + BLOCK_BYTES, "right")), w + 1)
        e = int(ends[w2 - 1])
        up, down = _powers(e - s)
        c = np.zeros(e - s + 1, np.uint64)
        np.cumsum((data[s:e].astype(np.uint64) + np.uint64(1)) * up[:e - s], out=c[1:])
        a, b = starts[w:w2] - s, ends[w:w2] - s
        out[w:w2] = (c[b] - c[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(GRAM)
        w = w2
    return mix(out)


_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_POW.get("up", ())):
        n = max(n, BLOCK_BYTES + 64)
        for name, m in (("up", ODD), ("down", ODD_INV)):
            p = np.full(n, m, np.uint64)
            p[0] = 1
            _POW[name] = np.cumprod(p)
    return _POW["up"], _POW["down"]


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes; the caller
    leaves out those that cross a border between texts."""
    k = len(h) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    g = np.zeros(k, np.uint64)
    for i in range(n):
        g = g * np.uint64(GRAM) + h[i:i + k]
    return mix(g)


def shingle_sets(texts: pa.Array, n: int, lower: bool = True):
    """Per text, the sorted distinct hashes of its ``n``-word shingles; one
    hash of the whole sequence if it has fewer words; none without words."""
    data, offs = text_bytes(texts)
    for i, j in chunks(offs):
        w = Words(data, offs, i, j, lower)
        h = w.hashes()
        g = grams(h, n)
        first = w.first
        for t in range(j - i):
            a, b = int(first[t]), int(first[t + 1])
            if b - a >= n:
                s = np.sort(g[a:b - n + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                whole = np.uint64(0)
                with np.errstate(over="ignore"):
                    for x in h[a:b]:
                        whole = whole * np.uint64(GRAM) + x
                    whole = whole + np.uint64(b - a)
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
