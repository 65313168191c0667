"""Cross-tokenizer alignment with external spill counting.

Every text, after one space, is cut into tokens by two tokenizers, A and B.
A link is an A and a B token whose bytes overlap; byte offsets where tokens
of both end cut them into groups.  The count of an id pair is the number of
documents that hold it linked.

1. Tasks encode texts and note one record for each document and pair.  Up to
   ``SLICE`` records are one slice of documents.  Its records are
   radix-partitioned by A id, sorted by A id, B id and document (stable radix
   passes) and spilled as zstd runs: a head (pairs, and how many documents
   hold each) and a body (documents, and links in each).  A slice is a row
   of a stored table, so Spark's commit covers it and it outlives executors.
2. The heads, already one row per pair and slice, are dealt by radix and
   merged k-way through a heap (over ``FAN`` streams in several rounds).  The
   merge gives the pairs of an A id one after another, so sums and the A id's
   maximum come out in one pass over at most as many pairs as B has ids.
3. Each slice reads its runs again next to the sorted counts, radix by
   radix, and streams the contributions back to its own documents.

Only heads are shuffled: no id is hot, however many documents hold it, and a
document's records never leave its slice.  Memory is a slice and a block of
counts (or one document, if that is longer).

Encoding goes by blank-separated words.  Neither tokenizer has a token across
the border before a single space between visible characters (A's pattern
starts a piece there; no B piece has a space after another character), so the
parts of a text are those of its words, and words seen before are looked up.

Defined results: texts that are null or empty, or whose tokens do not spell
them, have no tokens and zeros; repeated rows are documents of their own,
each counted; rows without a doc_id count like any other; an empty table
gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import sys
import types
from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsim.llm.common import bound_batches, drop, scratch_path, store, trimmed
from reelsim.llm.files import open_store
from reelsim.llm.words import chunks, text_bytes

SLICE = 1 << 20          # records of a slice
RADIX = 32               # radix partitions of the A ids
FAN = 256                # streams that one heap merges
BLOCK = 1 << 15          # pairs of a merged block
WORK_BYTES = 1 << 20     # text encoded at once
CACHE_LINKS = 1 << 22    # links of remembered words, after which they are forgotten

RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
SPILL = "slice long, docs binary, heads array<binary>, bodies array<binary>"


def byte_of_symbol() -> dict[str, int]:
    """The byte for every symbol of a byte-level vocabulary: visible Latin-1
    characters stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, and the words they have met."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True       # their strings are plain text
        symbol = byte_of_symbol()
        vocab = self.a.get_vocab()
        self.spell_a = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.spell_a[i] = bytes(symbol[c] for c in piece) if all(c in symbol for c in piece) else piece.encode()
        self.n_b = self.b.get_piece_size()
        self.spell_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.n_b)]
        self.clear()

    def clear(self):
        self.known: dict[bytes, int] = {}
        self.strings: list[str] = []
        self.sizes = np.zeros((1 << 12, 5), np.int64)     # A tokens, B tokens, groups, links, odd
        self.first = np.zeros(1 << 12, np.int64)
        self.links, self.used = np.zeros(1 << 14, np.int64), 0

    def _align(self, raw: bytes, a: list[int], b: list[int]) -> tuple[str, int, list[int]] | None:
        """``(groups, number of groups, links)`` of a part, or None if the
        tokens do not spell it."""
        sa, sb = [self.spell_a[i] for i in a], [self.spell_b[i] for i in b]
        if b"".join(sa) != raw or b"".join(sb) != raw:
            return None
        i, j, x, y = 0, 0, len(sa[0]), len(sb[0])
        gi = gj = 0
        groups, links, n = [], [], self.n_b
        while True:
            links.append(a[i] * n + b[j])
            step_a, step_b = x <= y, y <= x
            if step_a and step_b:
                groups.append(f"{','.join(map(str, a[gi:i + 1]))}|{','.join(map(str, b[gj:j + 1]))}")
                gi, gj = i + 1, j + 1
                if gi == len(a):
                    return ";".join(groups), len(groups), links
            if step_a:
                i += 1
                x += len(sa[i])
            if step_b:
                j += 1
                y += len(sb[j])

    def learn(self, parts: list[bytes]) -> None:
        texts = [p.decode() for p in parts]
        ids_a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] for t in texts], num_threads=1)     # B adds the space itself
        for raw, a, b in zip(parts, ids_a, ids_b):
            k = len(self.strings)
            got = self._align(raw, a, b)
            if k == len(self.first):
                self.first = np.concatenate((self.first, np.zeros_like(self.first)))
                self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
            string, n_groups, links = got or ("", 0, [])
            self.known[raw] = k
            self.strings.append(string)
            self.first[k] = self.used
            self.sizes[k] = (len(a), len(b), n_groups, len(links), got is None)
            while self.used + len(links) > len(self.links):
                self.links = np.concatenate((self.links, np.zeros_like(self.links)))
            self.links[self.used:self.used + len(links)] = links
            self.used += len(links)

    def __call__(self, data: np.ndarray, off: np.ndarray):
        """Texts that each begin with the space: ``(sizes, hashes, doc, pair,
        links)``, the last three one entry per document and pair."""
        if self.used > CACHE_LINKS:
            self.clear()
        k, starts = len(off) - 1, part_starts(data, off)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [x for x in words if x not in self.known]
        if new:
            self.learn(new)
        place = np.array([self.known[x] for x in words], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        at = np.searchsorted(starts, off)         # every text begins a part
        size = np.add.reduceat(self.sizes[place], at[:-1])
        empty = np.diff(off) <= 1
        for t in np.flatnonzero(~empty & (size[:, 4] > 0)).tolist():
            empty[t] = not self.spelled(data[off[t]:off[t + 1]].tobytes())
        size[empty] = 0
        doc_of = np.repeat(np.arange(k), np.diff(at))
        place, doc_of = place[~empty[doc_of]], doc_of[~empty[doc_of]]
        n = self.sizes[place, 3]
        flat = self.links[np.repeat(self.first[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        key = np.sort(np.repeat(doc_of, n) << 40 | flat)
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else np.zeros(1, np.int64)
        one = key[edge[:-1]]
        strings, where = self.strings, place.tolist()
        to = np.concatenate(([0], np.cumsum(np.bincount(doc_of, minlength=k)))).tolist()
        hashes = ["" if e else hashlib.sha256(";".join([strings[x] for x in where[a:b]]).encode()).hexdigest()
                  for e, a, b in zip(empty.tolist(), to[:-1], to[1:])]
        return size[:, :4], hashes, one >> 40, one & ((1 << 40) - 1), np.diff(edge)

    def spelled(self, raw: bytes) -> bool:
        """Whether both tokenizers spell a whole text that has a part they do
        not spell."""
        text = raw.decode()
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:])
        return b"".join([self.spell_a[i] for i in a]) == raw and b"".join([self.spell_b[i] for i in b]) == raw


def part_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin: at each text, and at single spaces
    between characters that are surely visible on one side and not blank on
    the other.  Lead bytes C2 and E1 to E3 may begin blanks beyond ASCII."""
    seen = (data >= 0x21) & (data <= 0x7E)
    high = data >= 0x80
    sure = seen | ((data >= 0xC3) & ((data < 0xE1) | (data > 0xE3)))
    cut = np.zeros(len(data), bool)
    left, right = slice(None, -2), slice(2, None)
    cut[1:-1] = (data[1:-1] == 32) & (((seen | high)[left] & sure[right]) | (seen[left] & (seen | high)[right]))
    # a space that ends or begins a text has no neighbour of its own text
    inner = off[1:-1]
    cut[inner[inner > 0] - 1] = False
    cut[off[:-1]] = True
    return np.flatnonzero(cut)


def tokenizers(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per worker process."""
    kept = sys.modules.setdefault("_reelsim_pairs", types.ModuleType("_reelsim_pairs")).__dict__
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Pair(path_a, path_b)
    return kept[path_a, path_b]


def squeeze(x: np.ndarray) -> bytes:
    """Integers as zstd: differences, byte plane by byte plane."""
    x = np.diff(x.astype("<i8"), prepend=0)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T)
    return len(x).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unsqueeze(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw[8:], 8 * n, asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def two(x: np.ndarray, y: np.ndarray) -> bytes:
    a = squeeze(x)
    return len(a).to_bytes(8, "little") + a + squeeze(y)


def untwo(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = 8 + int.from_bytes(raw[:8], "little")
    return unsqueeze(raw[8:n]), unsqueeze(raw[n:])


def spill(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Encode and spill: one row per slice of documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(path_a, path_b)
        at = TaskContext.get().partitionId() << 32
        ids, sizes, hashes, recs, n_docs, n_recs = [], [], [], [], 0, 0

        def flush():
            nonlocal at, n_docs, n_recs
            size = np.concatenate(sizes)
            cols = {"doc_id": pa.concat_arrays(ids)} | {c: pa.array(size[:, x]) for x, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
            out = io.BytesIO()
            pq.write_table(pa.table(cols | {"groups_sha256": pa.array(hashes, pa.string())}), out, compression="zstd")
            doc, what, links = (np.concatenate(x) for x in zip(*recs))
            radix = what // pair.n_b % RADIX
            order = np.argsort(what, kind="stable")       # documents ascend already
            order = order[np.argsort(radix[order].astype(np.uint8), kind="stable")]
            doc, what, links = doc[order], what[order], links[order]
            border = np.searchsorted(radix[order], np.arange(RADIX + 1))
            heads, bodies = [], []
            for a, b in zip(border[:-1].tolist(), border[1:].tolist()):
                edge = np.flatnonzero(np.concatenate(([True], what[a + 1:b] != what[a:b - 1], [True]))) if b > a else np.zeros(1, np.int64)
                heads.append(two(what[a:b][edge[:-1]], np.diff(edge)))
                bodies.append(two(doc[a:b], links[a:b]))
            row = [pa.array([at]), pa.array([out.getvalue()], pa.binary()), pa.array([heads], pa.list_(pa.binary())),
                   pa.array([bodies], pa.list_(pa.binary()))]
            at, n_docs, n_recs = at + 1, 0, 0
            for x in (ids, sizes, hashes, recs):
                x.clear()
            return pa.RecordBatch.from_arrays(row, ["slice", "docs", "heads", "bodies"])

        for b in batches:
            data, offs = text_bytes(b.column(1))
            for i, j in chunks(offs, WORK_BYTES):
                off = offs[i:j + 1] - offs[i]
                raw = np.insert(data[offs[i]:offs[j]], off[:-1], 32)
                size, sha, doc, what, links = pair(raw, off + np.arange(j - i + 1))
                ids.append(b.column(0).slice(i, j - i))
                sizes.append(size)
                hashes.extend(sha)
                recs.append((doc + n_docs, what, links))
                n_docs, n_recs = n_docs + j - i, n_recs + len(what)
                if n_recs >= SLICE or n_docs >= SLICE:
                    yield flush()
        if n_docs:
            yield flush()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(trimmed(work), SPILL)


def heap_merge(blocks: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """``(pair, count)`` in the order of pairs, summed, from blocks that come
    in the order of their first pairs; only blocks that overlap are open."""
    heap, blocks, n = [], iter(blocks), 0
    ahead = next(blocks, None)
    now, total = None, 0
    while heap or ahead:
        while ahead and (not heap or ahead[0] <= heap[0][0]):
            keys = ahead[1].tolist()
            heapq.heappush(heap, (keys[0], n, 0, keys, ahead[2].tolist()))
            n, ahead = n + 1, next(blocks, None)
        key, who, at, keys, counts = heap[0]
        if key != now:
            if now is not None:
                yield now, total
            now, total = key, 0
        total += counts[at]
        at += 1
        if at < len(keys):
            heapq.heapreplace(heap, (keys[at], who, at, keys, counts))
        else:
            heapq.heappop(heap)
    if now is not None:
        yield now, total


def _streams(batches: Iterator[pa.RecordBatch], width: int):
    """Groups of equal first ``width`` columns, each with its blocks."""
    def rows():
        for b in batches:
            yield from zip(*[c.to_pylist() if x < width else c for x, c in enumerate(b.columns)])
    for key, group in groupby(rows(), lambda r: r[:width]):
        yield key, heap_merge((int(p[0]), p, c) for p, c in (untwo(r[-1].as_py()) for r in group) if len(p))


def count_pairs(slices: DataFrame, n_b: int, path: str) -> None:
    """Merge the heads of all slices and write ``(pair, count, best)``, a
    folder per radix partition, in the order of pairs."""
    heads = slices.select("slice", F.posexplode("heads").alias("radix", "head"))
    n = slices.count()

    def first_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = [int(p[0]) if len(p) else None for p, _ in (untwo(x.as_py()) for x in b.column(2))]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(first, pa.int64()), b.column(2)], ["slice", "radix", "first", "head"])

    runs = heads.mapInArrow(first_pair, "slice long, radix int, first long, head binary").filter("first is not null")
    left = []
    while n > FAN:
        n = -(-n // FAN)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (radix, group), pairs in _streams(batches, 2):
                while block := list(islice(pairs, BLOCK)):
                    p, c = (np.array(x, np.int64) for x in zip(*block))
                    yield pa.RecordBatch.from_pydict({"slice": pa.array([group], pa.int64()), "radix": pa.array([radix], pa.int32()),
                                                      "first": pa.array([int(p[0])], pa.int64()), "head": pa.array([two(p, c)], pa.binary())})

        dealt = runs.select("radix", F.pmod(F.xxhash64("slice"), F.lit(n)).alias("group"), "first", "head")
        dealt = dealt.repartition("radix", "group").sortWithinPartitions("radix", "group", "first")
        runs = store(dealt.mapInArrow(trimmed(merge), "slice long, radix int, first long, head binary"), "merged")
        left.append(runs)

    def side_major(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix,), pairs in _streams(batches, 1):
            held: list[tuple[int, int, bool]] = []
            for _, group in groupby(pairs, lambda x: x[0] // n_b):
                one = list(group)                 # at most one row per B id
                most = max(c for _, c in one)
                held += [(p, c, c == most) for p, c in one]
                if len(held) >= BLOCK:
                    yield out(radix, held)
                    held = []
            if held:
                yield out(radix, held)

    def out(radix, rows):
        p, c, b = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array([radix] * len(p), pa.int32()), pa.array(p, pa.int64()), pa.array(c, pa.int64()), pa.array(b)],
                                          ["radix", "pair", "count", "best"])

    dealt = runs.select("radix", "first", "head").repartition(RADIX, "radix").sortWithinPartitions("radix", "first")
    counts = dealt.mapInArrow(trimmed(side_major), "radix int, pair long, count long, best boolean")
    # the writer wants its folders' rows together; the order of pairs is part of that sort
    counts.sortWithinPartitions("radix", "pair").write.partitionBy("radix").parquet(path)
    drop(*left)


def contributions(slices: DataFrame, path: str) -> DataFrame:
    """Read every slice's runs next to the counts and add up per document."""
    def blocks(radix: int) -> Iterator[list[np.ndarray]]:
        from pyarrow import fs
        where, folder = open_store(f"{path}/radix={radix}")
        found = where.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        for f in sorted(x.path for x in found if x.path.endswith(".parquet")):
            with where.open_input_file(f) as raw:
                for b in pq.ParquetFile(raw).iter_batches(BLOCK, columns=["pair", "count", "best"]):
                    yield [c.to_numpy(zero_copy_only=False) for c in b.columns]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(len(b)):
                docs = pq.read_table(io.BytesIO(b.column(1)[row].as_py()))
                best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
                for radix, (head, body) in enumerate(zip(b.column(2)[row].values, b.column(3)[row].values)):
                    pairs, held = untwo(head.as_py())
                    doc, links = untwo(body.as_py())
                    count, top, met = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64), 0
                    for p, c, t in blocks(radix) if len(pairs) else ():
                        to = met + int(np.searchsorted(pairs[met:], p[-1], "right"))
                        at = np.searchsorted(p, pairs[met:to])
                        count[met:to], top[met:to], met = c[at], t[at], to
                        if met == len(pairs):
                            break
                    np.add.at(total, doc, links * np.repeat(count, held))
                    np.add.at(best, doc, links * np.repeat(top, held))
                cols = [docs[c].combine_chunks() for c in docs.column_names]
                yield pa.RecordBatch.from_arrays([*cols[:5], pa.array(best), pa.array(total), cols[5]], [f.split()[0] for f in RESULT.split(", ")])

    return slices.select("slice", "docs", "heads", "bodies").mapInArrow(trimmed(work), RESULT)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: tokens, groups, links and what the links count."""
    from sentencepiece import SentencePieceProcessor
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    slices = store(spill(docs, path_a, path_b), "slices")
    path = scratch_path(spark, "pair-counts")
    count_pairs(slices, SentencePieceProcessor(model_file=path_b).get_piece_size(), path)
    return contributions(slices, path)
