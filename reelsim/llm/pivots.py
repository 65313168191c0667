"""Embedding near-dedup with a pivot-permutation index.

Reference vectors (pivots) are a bounded sample, about the square root of the
table but ``MOST_PIVOTS`` at most.  A vector is described by its nearest
pivots in order: ``NEAREST`` of up to 64, one more for each further factor of
four (``described_length``), and as many more (``MOST_NEAREST`` at most) as it
takes to find ``RECALL`` of the links of a fixed query set, which are counted
against all rows (``enough``).  Where those are fewer than ``LEAST_LINKS``, the
length must also find as great a share of planted partners, made at the least
cosine in random directions.  Inverted lists are kept for pairs of pivots, so two
vectors meet where they share at least two of them; the shared-pivot count is
read off the descriptions.  A pair that meets in several lists is counted
only in the list of its two smallest shared pivots.  Candidates are verified
by cosine in double precision.

Vectors of equal direction (unit vectors that agree to ``DIGITS`` decimals, so
scaled copies too) are one class and never paired.  A list of more than
``LIST_ROWS`` rows is cut into blocks, and each pair of blocks is a task's work
of its own: a dense group takes work quadratic in its size, and each of its
rows travels once per block, but no task holds more than two blocks.  A list
returns sums of links and a spanning forest, not its pairs.

Every length of vectors has pivots and lists of its own; vectors of different
lengths never link.

Defined results: null, empty or zero vectors and those with null or non-finite
components link with nothing; their component is their own id.  Rows without a
vec_id take no part and come back with no component.  Rows that repeat a
vec_id count as one vector id, each row with its own links.  An empty table
gives an empty result.  Other columns (labels too) are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsim.llm.common import drop, shuffle_partitions, split_join, store, trimmed
from reelsim.llm.graph import components

COSINE = 0.9
NEAREST, MOST_NEAREST = 6, 24
QUERIES, RECALL = 256, 0.95
LEAST_LINKS = 1000
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
BLOCK = 1024
DIGITS = 12
LIST_ROWS = 8192


def kind_of(vectors: DataFrame) -> np.dtype:
    """Single precision for components of that type, else double."""
    return np.dtype(np.float32 if vectors.schema["embedding"].dataType.elementType == T.FloatType() else np.float64)


def described(vectors: DataFrame) -> DataFrame:
    """``(vec_id, key, raw)``: components as bytes of ``kind``, and a key of
    equal directions; both null for vectors that link with nothing."""
    kind = kind_of(vectors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for b in batches:
            key, raw = [], []
            lists = b.column(1)
            for x in range(len(b)):
                v = lists[x]
                ok = v.is_valid and len(v.values) > 0 and v.values.null_count == 0
                if ok:
                    a = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    ok = bool(np.isfinite(a).all() and a.any())
                raw.append(a.astype(kind).tobytes() if ok else None)
                key.append(hashlib.blake2b((unit([raw[-1]], kind).round(DIGITS) + 0.0).tobytes(), digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "key", "raw"])

    return vectors.select("vec_id", "embedding").mapInArrow(trimmed(work), "vec_id long, key binary, raw binary")


def unit(raws: list[bytes], kind: np.dtype) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), kind).reshape(len(raws), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow or underflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def described_length(many: int, nearest: int = NEAREST) -> int:
    """How many of ``many`` pivots describe a vector: two vectors share two
    of a fixed number ever less often as pivots grow denser."""
    while many > LEAST_PIVOTS:
        nearest, many = nearest + 1, -(-many // 4)
    return nearest


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :k]


def choose_pivots(classes: DataFrame, kind: np.dtype) -> dict[int, np.ndarray]:
    """Per length of vectors (in bytes), the most common first, its reference
    vectors: a bounded sample in hash order of keys.  A length of
    ``LEAST_PIVOTS`` classes or fewer has one, so all of them share a list."""
    sizes = classes.groupBy(F.octet_length("raw").alias("size")).agg(F.count("*").alias("n")).collect()
    out = {}
    for r in sorted(sizes, key=lambda r: (-r["n"], r["size"])):
        if r["n"] <= LEAST_PIVOTS:
            out[r["size"]] = np.ones((1, r["size"] // kind.itemsize))
            continue
        most = min(MOST_PIVOTS, max(LEAST_PIVOTS, isqrt(r["n"])))
        of = classes.filter(F.octet_length("raw") == r["size"]).select("raw", "key")
        out[r["size"]] = unit([bytes(x["raw"]) for x in of.orderBy(F.xxhash64("key"), "key").limit(most).collect()], kind)
    return out


def with_nearest(classes: DataFrame, pivots: dict[int, np.ndarray], kind: np.dtype) -> DataFrame:
    """``classes`` with ``near``: the ``MOST_NEAREST`` nearest pivots of each
    vector, nearest first, among those of its length; -1 after an only one.
    Pivots are numbered through over all lengths."""
    first = dict(zip(pivots, np.cumsum([0, *map(len, pivots.values())]).tolist()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(3).to_pylist()
            near = [None] * len(raw)
            by: dict[int, list[int]] = {}
            for x, r in enumerate(raw):
                by.setdefault(len(r), []).append(x)
            for size, at in by.items():
                for s in range(0, len(at), 4096):
                    part = at[s:s + 4096]
                    got = nearest_pivots(unit([raw[x] for x in part], kind), pivots[size], MOST_NEAREST).astype(np.int32) + np.int32(first[size])
                    got = np.pad(got, ((0, 0), (0, MOST_NEAREST - got.shape[1])), constant_values=-1)
                    for x, n in zip(part, got):
                        near[x] = n.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.binary())], ["key", "rep", "copies", "raw", "near"])

    return classes.select("key", "rep", "copies", "raw").mapInArrow(trimmed(work), "key binary, rep long, copies long, raw binary, near binary")


def depths(near: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Per pair of descriptions, the shortest length at which they share two
    pivots; more than ``near`` has if they never do."""
    at = np.where(near[:, :, None] == other[:, None, :], np.maximum(*np.indices((near.shape[1],) * 2))[None] + 1, near.shape[1] + 1)
    at = np.sort(at.reshape(len(at), -1), axis=1)
    return at[:, 1]


def enough(near: DataFrame, pivots: dict[int, np.ndarray], nearest: int, cosine: float, kind: np.dtype) -> int:
    """The described length: ``described_length``, or more if the links of a
    fixed query set of the most common length, counted against all rows of
    that length, need it, or, where links are rare, planted partners do."""
    size, many = max(((s, len(p)) for s, p in pivots.items()), key=lambda x: x[1], default=(0, 0))
    k = described_length(many, nearest)
    if many < 2:
        return k
    near = near.filter(F.octet_length("raw") == size)
    got = (near.orderBy(F.xxhash64("key", F.lit(1)), "key").limit(QUERIES)
               .select("key", "raw", "near").collect())
    keys = [bytes(r["key"]) for r in got]
    q = unit([bytes(r["raw"]) for r in got], kind)
    q_near = np.array([np.frombuffer(bytes(r["near"]), np.int32) for r in got])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(q_near.shape[1] + 2, np.int64)
        own = {x: i for i, x in enumerate(keys)}
        for b in batches:
            key, raw, n = (b.column(x).to_pylist() for x in range(3))
            x, n = unit(raw, kind), np.array([np.frombuffer(r, np.int32) for r in n])
            link = x @ q.T >= cosine
            for y, v in enumerate(key):
                if v in own:
                    link[y, own[v]] = False
            i, j = np.nonzero(link)
            for s in range(0, len(i), 4096):
                count += np.bincount(depths(n[i[s:s + 4096]], q_near[j[s:s + 4096]]), minlength=len(count))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count))), pa.array(count)], ["depth", "links"])

    rows = near.select("key", "raw", "near").mapInArrow(trimmed(work), "depth long, links long")
    links = np.zeros(q_near.shape[1] + 2)
    for r in rows.groupBy("depth").agg(F.sum("links").alias("links")).collect():
        links[r["depth"]] = r["links"]
    found = np.cumsum(links)
    planted = np.zeros(len(found))
    if found[-1] < LEAST_LINKS:
        planted = np.cumsum(planted_depths(q, q_near, pivots, size, cosine))
    while k < q_near.shape[1] and (found[k] < RECALL * found[-1] or planted[k] < RECALL * planted[-1]):
        k += 1
    return k


def planted_depths(q: np.ndarray, q_near: np.ndarray, pivots: dict[int, np.ndarray], size: int, cosine: float) -> np.ndarray:
    """How many planted partners of the queries are first met at each length:
    ``LEAST_LINKS`` or more, each at ``cosine`` from its query in a random
    direction (the seed is fixed).  One component has no such partners."""
    rng = np.random.default_rng(0)
    first = sum(len(p) for s, p in list(pivots.items())[:list(pivots).index(size)])
    count = np.zeros(q_near.shape[1] + 2, np.int64)
    for _ in range(-(-LEAST_LINKS // len(q)) if q.shape[1] > 1 else 0):
        away = rng.standard_normal(q.shape)
        away -= (away * q).sum(axis=1, keepdims=True) * q
        away /= np.linalg.norm(away, axis=1, keepdims=True)
        near = nearest_pivots(cosine * q + np.sqrt(1 - cosine ** 2) * away, pivots[size], q_near.shape[1]) + first
        near = np.pad(near, ((0, 0), (0, q_near.shape[1] - near.shape[1])), constant_values=-2)
        count += np.bincount(depths(near, q_near), minlength=len(count))
    return count


def inverted_lists(near: DataFrame, many: int, k: int) -> DataFrame:
    """``(list, rep, copies, raw, near)``: a row for each pair of a vector's
    ``k`` nearest pivots; ``near`` are those pivots, nearest first."""
    i, j = np.triu_indices(k, 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, len(b), 4096):
                part = b.slice(s, 4096)
                near = np.array([np.frombuffer(r, np.int32)[:k] for r in part.column(3).to_pylist()])
                low, high = (f(near[:, i], near[:, j]).astype(np.int64) for f in (np.minimum, np.maximum))
                only = near[:, 1] < 0                     # one list for all of that length
                mask = ~only[:, None] | (np.arange(len(i)) == 0)
                lists = np.where(only[:, None], near[:, :1].astype(np.int64) * (many + 1), low * many + high)[mask]
                rows = np.nonzero(mask)[0]
                flat = pa.array([r.tobytes() for r in near], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(lists), *(c.take(pa.array(rows)) for c in (*part.columns[:3], flat))],
                                                 ["list", "rep", "copies", "raw", "near"])

    return near.select("rep", "copies", "raw", "near").mapInArrow(trimmed(work), "list long, rep long, copies long, raw binary, near binary")


def blocked(lists: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lists`` with ``i``, ``j``, ``side``: the rows of a list over
    ``LIST_ROWS`` are cut into blocks by hash, and a row goes to every pair of
    blocks ``(i, j)``, ``i <= j``, that holds its block ``side``."""
    long = sizes.filter(F.col("rows") > LIST_ROWS).select("list", F.ceil(F.col("rows") / LIST_ROWS).cast("int").alias("blocks"))
    rows = (lists.join(F.broadcast(long), "list", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                 .withColumn("side", F.pmod(F.xxhash64("rep", "raw"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return rows.select("list", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
                       "side", "rep", "copies", "raw", "near")


def list_links(rows: list[tuple], many: int, cosine: float, kind: np.dtype):
    """Links within one pair of blocks of an inverted list: per row the
    copies it links to (pairs that belong to this list and these blocks), and
    forest edges over those links.  Rows are ``(list, i, j, side, rep,
    copies, raw, near)``."""
    key, first, second = rows[0][:3]
    low, high = divmod(key, many)
    near = np.frombuffer(b"".join(r[7] for r in rows), np.int32).reshape(len(rows), -1)
    # shared pivots below the list's larger one, other than its smaller one,
    # mean that an earlier list counts the pair
    early = np.sort(np.where((near < high) & (near != low), near, -1), axis=1)
    side = np.array([r[3] for r in rows])
    order = np.lexsort((*early.T, side))                  # equal descriptions side by side
    near, early, side, rows = near[order], early[order], side[order], [rows[x] for x in order]
    rep = np.array([r[4] for r in rows])
    copies = np.array([r[5] for r in rows], np.int64)
    x = unit([r[6] for r in rows], kind)
    links = np.zeros(len(rows), np.int64)
    root = np.arange(len(rows))
    cut = int(np.searchsorted(side, second)) if first != second else len(rows)

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    def common(a, z):
        """Earlier pivots that all these rows have."""
        return set.intersection(*(set(e) for e in np.unique(early[a:z], axis=0).tolist())) - {-1}

    if first != second:
        left, right = [(a, min(a + BLOCK, cut)) for a in range(0, cut, BLOCK)], [(b, min(b + BLOCK, len(rows))) for b in range(cut, len(rows), BLOCK)]
    else:
        left = right = [(a, min(a + BLOCK, len(rows))) for a in range(0, len(rows), BLOCK)]
    shared = {r: common(*r) for r in {*left, *right}}
    for a, az in left:
        for b, bz in right:
            if b < a or shared[a, az] & shared[b, bz]:
                continue                                  # an earlier list has all these pairs
            p, q = np.nonzero(x[a:az] @ x[b:bz].T >= cosine)
            p, q = p + a, q + b
            p, q = p[p < q], q[p < q]
            mine = np.ones(len(p), bool)
            for e in range(near.shape[1]):
                mine &= ~((early[p, e, None] == early[q]) & (early[p, e, None] >= 0)).any(axis=1)
            p, q = p[mine], q[mine]
            if not len(p):
                continue
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            pairs = np.unique(root[p] * len(rows) + root[q])
            for u, v in zip((pairs // len(rows)).tolist(), (pairs % len(rows)).tolist()):
                u, v = find(u), find(v)
                if u != v:
                    root[max(u, v)] = min(u, v)
            while not np.array_equal(root, root[root]):
                root = root[root]
    return rep, links, rep[root]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, nearest: int = NEAREST) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    n_parts = shuffle_partitions(vectors.sparkSession)
    kind = kind_of(vectors)
    all_ = store(described(vectors), "vectors")
    total = all_.count()
    usable = all_.filter(F.col("key").isNotNull() & F.col("vec_id").isNotNull())
    classes = store(usable.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min_by("raw", F.struct("vec_id", "raw")).alias("raw")), "classes")
    pivots = choose_pivots(classes, kind)
    many = max(sum(map(len, pivots.values())), 1)
    near = store(with_nearest(classes, pivots, kind), "nearest")
    drop(classes)
    k = enough(near, pivots, nearest, cosine, kind)
    lists = inverted_lists(near, many, k)
    sizes = store(inverted_lists(near.select("rep", "copies", F.lit(b"").alias("raw"), "near"), many, k)
                  .groupBy("list").agg(F.count("*").alias("rows")).filter(F.col("rows") > LIST_ROWS), "long lists")
    dealt = blocked(lists, sizes).repartition(n_parts, "list", "i", "j").sortWithinPartitions("list", "i", "j")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []

        def close():
            if len(group) > 1:
                rep, links, top = list_links(group, many, cosine, kind)
                for x in np.flatnonzero((links > 0) | (top != rep)):
                    out.append((int(rep[x]), int(top[x]), int(links[x])))

        def flush():
            cols = list(zip(*out)) or [()] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["rep", "top", "links"])

        for b in batches:
            for r in zip(*(b.column(x).to_pylist() for x in range(8))):
                if group and r[:3] != group[0][:3]:
                    close()
                    group = []
                group.append(r)
            if len(out) > 50_000:
                yield flush()
        close()
        yield flush()

    found = store(dealt.mapInArrow(trimmed(work), "rep long, top long, links long"), "found")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(found.filter("rep != top"), "rep", "top")
    per_class = (near.select("key", "rep", "copies").join(counts, "rep", "left")
                        .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                        .select("key", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                F.coalesce("component", "rep").alias("component")))
    # rows without an id take no part, whatever their vector
    mine = all_.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key"))
    out = split_join(mine, store(per_class, "per-class"), "key", "copies", total, "left", F.xxhash64("vec_id"))
    comp_id = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      (F.col("vec_id") == comp_id).alias("kept"))
