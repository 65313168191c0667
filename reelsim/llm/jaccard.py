"""N-gram Jaccard join by vertical partitioning.

A text's set holds the hashes of its distinct ``n``-word shingles.  The
global n-gram order is the order of these hashes, cut into fragments.

1. Candidates.  If two sets of sizes ``a <= b`` reach Jaccard ``p / q``, they
   differ in at most ``D`` shingles, so of more than ``D`` fragments at least
   one holds the same segment of both.  Each set therefore sends one
   signature per (non-empty) fragment; ``D`` and the number of fragments
   depend on a band of sizes, and a set also serves every band below in which
   its partners may lie.  A set with at most ``D`` non-empty fragments
   sends its empty ones too, so no pair is lost.
2. Sets that share a signature are a group; each gives a star around its
   smallest id, whose pairs are verified (3) and joined into components.
   Members of groups are then searched again by prefixes: in the order of
   document frequency, rarest first, sets that link share a shingle among the
   first ``n - ceil(n p / q) + 1`` of both, at places that leave room for the
   overlap they need.  Pairs inside a component are skipped.  So near copies
   that fail against a star's centre meet only where they share rare
   shingles.
3. Verification.  The sets of candidate documents are cut into vertical
   fragments; each fragment counts its partial overlap by itself, and the
   counts are summed per pair.  A pair links when
   ``q * overlap >= p * (a + b - overlap)``.

Equal sets form classes; a class is represented by its smallest id, so
copies are never paired with each other.

Defined results: null and empty texts have empty sets and link with nothing;
rows without a doc_id come back with no component; rows that repeat a doc_id
count as one document (its text should be the same); an empty table gives an
empty result.  Only ``doc_id`` and ``text`` are read, so extra columns never
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsim.llm.common import drop, hot_limit, shuffle_partitions, split_join, store, trimmed
from reelsim.llm.graph import components
from reelsim.llm.words import ODD, mix, shingle_sets

FRAGMENTS = 8
STEP = 2
BLOCK = 2048
HELD = 1 << 20
# Sets that share a prefix shingle are cut into blocks of about GROUP of them
# once they are more, or more than one in MOST_SPLIT of all prefix rows.
GROUP = 1 << 14
MOST_SPLIT = 1 << 20
# Set keys by which a task leaves out copies of a set it has signed.
SEEN = 1 << 18


def bands(p: int, q: int, most: int = 1 << 40) -> tuple[tuple[int, int, int], ...]:
    """``(top, D, fragments)`` of every size band, in order of size."""
    out, low = [], 1
    while low <= most:
        top = max(low, low * 3 // 2)
        d = (q - p) * (top + top * q // p) // (p + q)
        out.append((top, d, d + 2 + d // 8 if d else 0))
        low = top + 1
    return tuple(out)


class Signer:
    """Segment signatures of one set."""

    def __init__(self, p: int, q: int):
        self.p, self.q = p, q
        self.bands = bands(p, q)
        self.tops = np.array([b[0] for b in self.bands])
        self.edges: dict[int, np.ndarray] = {}

    def __call__(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        own = int(np.searchsorted(self.tops, n))
        use = [own]
        while use[-1] and -(-n * self.p // self.q) <= self.bands[use[-1] - 1][0]:
            use.append(use[-1] - 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(s), out=total[1:])
        out = []
        for b in use:
            _, d, k = self.bands[b]
            if not k:
                continue
            if b not in self.edges:
                self.edges[b] = np.array([(x << 64) // k for x in range(1, k)], np.uint64)
            at = np.concatenate(([0], np.searchsorted(s, self.edges[b]), [n]))
            size = np.diff(at)
            sig = mix(total[at[1:]] - total[at[:-1]] + size.astype(np.uint64)
                      + np.arange(b << 32, (b << 32) + k, dtype=np.uint64) * np.uint64(ODD))
            some = size > 0
            out.append(sig[some] if np.count_nonzero(some) > d else sig)
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _set_key(s: np.ndarray) -> bytes:
    import hashlib
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def document_sets(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, n_shingles, set_key)``; ``set_key`` is null for empty sets."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, key = [], []
            for s in shingle_sets(b.column(1), n):
                size.append(len(s))
                key.append(_set_key(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(key, pa.binary())],
                                             ["doc_id", "n_shingles", "set_key"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(work), "doc_id long, n_shingles long, set_key binary")


def signatures(docs: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """``(sig, node, size)``; of equal sets in one task only the first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, seen = Signer(p, q), set()
        for b in batches:
            sigs, rows, sizes, held = [], [], [], 0

            def flush():
                sig = np.concatenate(sigs)
                count = [len(x) for x in sigs]
                return pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), b.column(0).take(pa.array(np.repeat(rows, count))),
                     pa.array(np.repeat(np.array(sizes, np.int32), count))], ["sig", "node", "size"])

            for t, s in enumerate(shingle_sets(b.column(1), n)):
                if not len(s):
                    continue
                key = _set_key(s)
                if key in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()                          # a copy that is signed again costs a row, no link
                seen.add(key)
                sigs.append(sign(s))
                rows.append(t)
                sizes.append(len(s))
                held += len(sigs[-1])
                if held > 200_000:
                    yield flush()
                    sigs, rows, sizes, held = [], [], [], 0
            if sigs:
                yield flush()

    known = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return known.mapInArrow(trimmed(work), "sig long, node long, size int")


def stars(sigs: DataFrame) -> DataFrame:
    """``(sig, a, b, na, nb)``: in every group, its smallest node ``a`` with
    each other node.  Groups stream by; only the open one's centre is kept."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None                                       # centre of the open group
        for b in batches:
            sig, node, size = (b.column(x).to_numpy() for x in range(3))
            if last is not None:
                sig, node, size = (np.concatenate(([x], y)) for x, y in zip(last, (sig, node, size)))
            at = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            centre = np.repeat(at, np.diff(np.append(at, len(sig))))
            rows = np.flatnonzero(node != node[centre])
            last = (sig[at[-1]], node[at[-1]], size[at[-1]])
            if len(rows):
                c = centre[rows]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (sig[rows], node[c], node[rows], size[c], size[rows])],
                                                 ["sig", "a", "b", "na", "nb"])

    n_parts = shuffle_partitions(sigs.sparkSession)
    dealt = sigs.repartition(n_parts, "sig").sortWithinPartitions("sig", "node")
    return dealt.mapInArrow(trimmed(work), "sig long, a long, b long, na int, nb int")


def segments(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """``(node, fragment, seg)``: the sets of ``nodes`` cut vertically."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, frag, segs, held = [], [], [], 0

            def flush():
                at = np.cumsum([0, *(len(x) for x in segs)]).astype(np.int32)
                seg = pa.ListArray.from_arrays(at, np.concatenate(segs).view(np.int64))
                return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(frag, pa.int32()), seg],
                                                  ["node", "fragment", "seg"])

            for t, s in enumerate(shingle_sets(b.column(1), n)):
                at = np.searchsorted(s, np.array([(x << 64) // FRAGMENTS for x in range(1, FRAGMENTS)], np.uint64))
                for f, seg in enumerate(np.split(s, at)):
                    if len(seg):
                        rows.append(t)
                        frag.append(f)
                        segs.append(seg)
                        held += len(seg)
                if held > 500_000:
                    yield flush()
                    rows, frag, segs, held = [], [], [], 0
            if segs:
                yield flush()

    # the nodes are no fixed share of the table, so the same join at any size
    texts = docs.select("doc_id", "text").join(nodes.hint("merge"), F.col("doc_id") == F.col("node"), "left_semi")
    cut = texts.mapInArrow(trimmed(work), "node long, fragment int, seg array<long>")
    return cut.groupBy("node", "fragment").agg(F.first("seg").alias("seg"))


def verified(pairs: DataFrame, seg: DataFrame, p: int, q: int) -> DataFrame:
    """The links among stored ``pairs(a, b, na, nb)``, stored: partial overlaps are counted
    in every fragment by itself and summed per pair.  After every
    ``STEP`` fragments, pairs go that could not link even if all that is
    left of both sets were shared."""
    live = pairs.select("a", "b", "na", "nb", F.lit(0).cast("long").alias("o"), F.col("na").cast("long").alias("la"),
                        F.col("nb").cast("long").alias("lb"))
    before = None
    for f in range(0, FRAGMENTS, STEP):
        part = seg.filter((F.col("fragment") >= f) & (F.col("fragment") < f + STEP))
        left = part.select(F.col("node").alias("b"), "fragment", F.col("seg").alias("seg_b"))
        right = part.select(F.col("node").alias("a"), "fragment", F.col("seg").alias("seg_a"))
        both = live.select("a", "b").hint("merge").join(left, "b").hint("merge").join(right, ["a", "fragment"])
        over = (both.select("a", "b", F.size(F.array_intersect("seg_a", "seg_b")).alias("x"), F.size("seg_a").alias("sa"), F.size("seg_b").alias("sb"))
                    .groupBy("a", "b").agg(F.sum("x").alias("x"), F.sum("sa").alias("sa"), F.sum("sb").alias("sb")))
        none = F.lit(0)
        live = (live.join(over, ["a", "b"], "left")
                    .select("a", "b", "na", "nb", (F.col("o") + F.coalesce("x", none)).alias("o"),
                            (F.col("la") - F.coalesce("sa", none)).alias("la"), (F.col("lb") - F.coalesce("sb", none)).alias("lb"))
                    .filter((p + q) * (F.col("o") + F.least("la", "lb")) >= p * (F.col("na") + F.col("nb"))))
        live = store(live, "pairs")
        if before is not None:
            drop(before)
        before = live
    links = store(live.filter((p + q) * F.col("o") >= p * (F.col("na") + F.col("nb"))).select("a", "b"), "links")
    drop(live)
    return links


def frequencies(seg: DataFrame) -> DataFrame:
    """``(node, shingle, df)``: shingles that several sets hold, with the
    number of those sets (``HELD`` at most); a null ``shingle`` says in
    ``df`` how many shingles no other set holds (to be summed)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 2                # the open run
        long = None                                       # a run that is known to be long

        def rows(node, shingle, df):
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(shingle, pa.int64()), pa.array(df.astype(np.int32))], ["node", "shingle", "df"])

        def close(shingle, node):
            at = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
            df = np.diff(np.append(at, len(shingle)))
            own, count = np.unique(node[at[df == 1]], return_counts=True)
            if len(own):
                yield rows(own, pa.nulls(len(own), pa.int64()), count)
            each = np.repeat(df, df)
            if (each > 1).any():
                yield rows(node[each > 1], shingle[each > 1], np.minimum(each[each > 1], HELD))

        for b in batches:
            shingle, node = b.column(0).to_numpy(), b.column(1).to_numpy()
            if long is not None:
                k = int(np.searchsorted(shingle, long, "right"))
                if k:
                    yield rows(node[:k], shingle[:k], np.full(k, HELD))
                shingle, node = shingle[k:], node[k:]
                if not len(shingle):
                    continue
                long = None
            shingle, node = np.concatenate((held[0], shingle)), np.concatenate((held[1], node))
            k = int(np.searchsorted(shingle, shingle[-1], "left"))
            if k:
                yield from close(shingle[:k], node[:k])
            held = [shingle[k:], node[k:]]
            if len(held[0]) >= HELD:
                long = shingle[-1]
                yield rows(held[1], held[0], np.full(len(held[0]), HELD))
                held = [np.zeros(0, np.int64)] * 2
        if len(held[0]):
            yield from close(*held)

    n_parts = shuffle_partitions(seg.sparkSession)
    dealt = seg.select(F.explode("seg").alias("shingle"), "node").repartition(n_parts, "shingle").sortWithinPartitions("shingle")
    return dealt.mapInArrow(trimmed(work), "node long, shingle long, df int")


def prefix_pairs(members: DataFrame, seg: DataFrame, p: int, q: int) -> DataFrame:
    """``(a, b, na, nb)``, stored, of ``members(node, n, label)`` with
    different labels that may link, by prefixes in the order of document
    frequency.  Sets whose prefixes hold one shingle are a group; a long group
    is cut into blocks by hash, and each pair of blocks is work of its own.
    Within it sets are in order of size, so tiles whose sizes cannot link are
    not compared."""
    found = frequencies(seg)
    alone = found.filter("shingle is null").groupBy("node").agg(F.sum("df").alias("alone"))
    length = F.col("n") - F.ceil(F.col("n") * p / q).cast("int") + 1
    # a prefix of shingles that no other set holds meets nothing
    open_ = (members.join(alone.hint("merge"), "node", "left")
                    .select("node", "n", "label", F.coalesce("alone", F.lit(0)).cast("int").alias("alone"), length.alias("length"))
                    .filter("alone < length"))
    rows = found.filter("shingle is not null").join(open_.hint("merge"), "node")
    order = (rows.groupBy("node", "n", "label", "alone", "length")
                 .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s")))
    shared = (order.select("node", "label", "n", "alone", F.posexplode(F.slice("s", F.lit(1), F.col("length") - F.col("alone"))).alias("i", "t"))
                   .select(F.col("t.shingle").alias("shingle"), "node", "label", "n", (F.col("alone") + F.col("i")).alias("pos")))

    shared = store(shared, "prefixes")
    # groups of a shingle beyond the limit are cut into blocks; there are at
    # most 2 ** 20 of them, since together they hold no more than all rows
    limit = max(GROUP, -(-shared.count() // MOST_SPLIT))
    long = shared.groupBy("shingle").agg(F.count("*").alias("rows")).filter(F.col("rows") > limit)
    long = long.select(F.col("shingle").alias("_long"), F.ceil(F.col("rows") / GROUP).cast("int").alias("blocks"))
    cut = shared.join(F.broadcast(long), F.col("shingle") == F.col("_long"), "left")
    own, other = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.col("other")
    cut = cut.withColumn("own", F.coalesce(own, F.lit(0)))
    # a row meets every block of its group, its own included
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    cut = cut.select("shingle", F.least("own", other).alias("i"), F.greatest("own", other).alias("j"), "own", "node", "label", "n", "pos")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def meet(left, right):
            """Pairs of two blocks, each ascending in size; of a block with
            itself if they are the same."""
            for i in range(0, len(left[0]), BLOCK):
                node, label, n, pos = (c[i:i + BLOCK] for c in left)
                for j in range(i if left is right else 0, len(right[0]), BLOCK):
                    node2, label2, n2, pos2 = (c[j:j + BLOCK] for c in right)
                    if p * n2[0] > q * n[-1]:
                        break                             # so are all that follow
                    if p * n[0] > q * n2[-1]:
                        continue
                    room = np.minimum((n - pos)[:, None], (n2 - pos2)[None, :])
                    ok = (label[:, None] != label2[None, :]) & ((p + q) * room >= p * (n[:, None] + n2[None, :]))
                    u, v = np.nonzero(np.triu(ok, 1) if left is right and i == j else ok)
                    if len(u):
                        x, y = node[u], node2[v]
                        swap = x > y
                        cols = (np.minimum(x, y), np.maximum(x, y), np.where(swap, n2[v], n[u]), np.where(swap, n[u], n2[v]))
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cols[:2], *(c.astype(np.int32) for c in cols[2:]))],
                                                         ["a", "b", "na", "nb"])

        def group(cols):
            i, j, own, rows = cols[1][0], cols[2][0], cols[3], [c.astype(np.int64) for c in cols[4:]]
            if i == j:
                yield from meet(rows, rows)
            else:
                yield from meet([c[own == i] for c in rows], [c[own == j] for c in rows])

        held = None
        for b in batches:
            cols = [b.column(x).to_numpy() for x in range(8)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            new = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)
            at = np.flatnonzero(np.concatenate(([True], new, [True])))
            held = [c[at[-2]:] for c in cols]             # the last group may go on
            for x, y in zip(at[:-2], at[1:-1]):
                if y - x > 1:
                    yield from group([c[x:y] for c in cols])
        if held is not None and len(held[0]) > 1:
            yield from group(held)

    n_parts = shuffle_partitions(members.sparkSession)
    dealt = cut.repartition(n_parts, "shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "n")
    pairs = store(dealt.mapInArrow(trimmed(work), "a long, b long, na int, nb int").distinct(), "rest")
    drop(shared)
    return pairs


def similar_groups(docs: DataFrame, n: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs``: the size
    of its set and the smallest doc_id that links reach.  Stored tables go as
    soon as their readers are stored."""
    sets = store(document_sets(docs, n), "sets")
    total = sets.count()
    named = sets.filter(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    many = store(classes.filter("copies > 1"), "classes")
    member = split_join(sets, many, "set_key", "copies", total, "left", F.xxhash64("doc_id"))
    member = store(member.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")), "members")
    drop(sets, many)

    # copies of one set met across tasks are one class already
    rep_of = member.select(F.col("doc_id").alias("node"), F.col("rep").alias("of")).distinct()
    cand = stars(signatures(docs, n, p, q))
    cand = (cand.join(rep_of.select(F.col("node").alias("a"), F.col("of").alias("ra")), "a")
                .join(rep_of.select(F.col("node").alias("b"), F.col("of").alias("rb")), "b").filter("ra != rb")
                .select("sig", F.col("ra").alias("a"), F.col("rb").alias("b"), "na", "nb"))
    cand = store(cand, "stars")
    nodes = (cand.select(F.col("a").alias("node"), F.col("na").alias("n"))
                 .unionByName(cand.select(F.col("b").alias("node"), F.col("nb").alias("n"))).distinct())
    nodes = store(nodes, "nodes")

    swap = F.col("a") > F.col("b")
    pairs = (cand.filter(q * F.least("na", "nb") >= p * F.greatest("na", "nb"))
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                         F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                         F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb")).distinct())
    pairs = store(pairs, "star pairs")
    drop(cand)
    seg = store(segments(docs, nodes, n), "segments")
    links = verified(pairs, seg, p, q)
    drop(pairs)
    comp = components(links)

    label = nodes.join(comp, "node", "left").select("node", "n", F.coalesce("component", "node").alias("label"))
    label = store(label, "labels")
    drop(nodes)
    rest = prefix_pairs(label, seg, p, q)
    drop(label)
    if not rest.isEmpty():
        more = verified(rest, seg, p, q)
        drop(seg, comp)
        comp = components(links.unionByName(more))
        drop(links, more, rest)
    else:
        drop(seg, links, rest)

    sizes = member.groupBy("rep").agg(F.count("*").alias("copies"))
    # classes with many copies are named even if they link with nothing, so
    # that their rows are spread
    final = sizes.join(comp, F.col("node") == F.col("rep"), "left").select("rep", "component", "copies")
    final = final.filter(F.col("component").isNotNull() | (F.col("copies") > hot_limit(total)))
    out = split_join(member, final, "rep", "copies", total, "left", F.xxhash64("doc_id"))
    return out.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
