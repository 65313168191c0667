"""Batch search as a tiled sparse product.

A batch is cut into blocks of up to ``QUERY_BLOCK`` queries and
``BLOCK_TERMS`` terms.  For each block the documents' vectors stream by, a
tile of block x documents at a time: a tile is scored, masked (the query's own
row, genre filters), and what reaches a query's n-th score so far is kept;
only each query's top n leave the task.  Terms that many queries of the block
hold are a dense matrix product; of the others only the (query, document)
pairs that share one are summed.  So no row per (query, document) pair is ever
made, no term is a hot key, and memory is a tile whatever the batch holds.
The block is the one thing sent to every task.

Tiles are in single precision.  Weights are positive, so a sum of ``m``
products is off by a share of at most about ``m`` roundings; what may be in a
list within that share is scored again in double precision, and lists and
scores come from that alone.  Rows of one batch with the same vector and genre
have the same scores, so only the ``n + 1`` largest of them are looked at.

Genre filters come first: patterns are tested on the distinct genre strings
(once for a block), documents carry the number of their string, and those
that no filter of the block lets through are dropped before scoring.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsim.functions.genres import genre_matches, pattern_valid
from reelsim.operators.order import dense_index
from reelsim.operators.similarity import RANK_DECIMALS, fits_broadcast, maybe_broadcast, top_n_per_query
from reelsim.session import drop_table, scratch_path, store_table

MARGIN = 10.0 ** -RANK_DECIMALS

# executors need no copy of the package for the function below
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Queries are stored in folders of GROUP; a block takes as many of them as
# have QUERY_BLOCK queries, BLOCK_TERMS terms and KEPT answers at most, one at least.
GROUP, QUERY_BLOCK, BLOCK_TERMS, KEPT = 256, 8192, 2_000_000, 2_000_000
DOC_BLOCK = 128
# Terms of a block that are scored as a dense matrix: those of this share of
# its queries at least, so many at most.
DENSE_SHARE, DENSE_TERMS = 0.03, 256
# Entries of a term lie in rows of LANES, and so many rows are added at a time;
# one entry takes as long as so many cells of the matrix product.
LANES, ADDED, ENTRY_CELLS = 16, 8192, 130
# Candidates that wait before they are ranked among those kept so far.
WAITING = 50_000
# Documents whose vectors are laid out at a time, and entries of queries that
# are summed, when candidates are scored again.
AGAIN_DOCS, AGAIN_ENTRIES = 32, 500_000
# Tasks per core that a block's documents are dealt to, at most.
WAVES = 4
# Vectors of a stored file, at least.
FILE_ROWS = 4096
# Term numbers up to which a block finds its terms by a table.
TABLE = 1 << 22

VECTOR = "row_id long, genre_id long, ids array<int>, ws array<double>"


def term_ids(vocabulary: DataFrame) -> DataFrame:
    """``(term, df, term_id)``: dense numbers in the order of the terms."""
    numbered = dense_index(vocabulary.select("term", "df"), ["term"], "term_id")
    return numbered.withColumn("term_id", F.col("term_id").cast("int"))


def genre_ids(catalog: DataFrame) -> DataFrame:
    """``(genre_src, genre_id)`` of the distinct genre strings."""
    values = catalog.select("genre_src").filter(F.col("genre_src").isNotNull()).distinct()
    return dense_index(values, ["genre_src"], "genre_id")


def as_vectors(weights: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``(key, ids, ws)``: one row of ascending term numbers and weights per
    key, at most the vocabulary's size; from ``weights(key, term, w)``."""
    rows = weights.select(key, "term", "w").join(ids.select("term", "term_id"), "term")
    one = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term_id", "w"))).alias("v"))
    return one.select(key, F.col("v.term_id").alias("ids"), F.col("v.w").alias("ws"))


def document_vectors(postings: DataFrame, catalog: DataFrame, ids: DataFrame, genres: DataFrame) -> DataFrame:
    """The model by document, with the number of its genre string."""
    genre = catalog.select("row_id", "genre_src").join(genres, "genre_src", "left").select("row_id", "genre_id")
    return as_vectors(postings, ids, "row_id").join(genre, "row_id").select("row_id", "genre_id", "ids", "ws")


@dataclass
class _Block:
    """The terms of a block of queries, by number, in two forms.  By term, in
    single precision: the ``count`` rows from ``start`` of ``query`` and
    ``weight`` (``LANES`` wide, filled up with zero weights); the terms of many
    queries have a ``column`` as well (else -1), that is their rows of
    :meth:`dense`.  By query, in double precision: the ``width`` entries from
    ``first`` of ``place`` and ``exact``."""

    terms: np.ndarray
    column: np.ndarray
    often: np.ndarray
    start: np.ndarray
    count: np.ndarray
    query: np.ndarray
    weight: np.ndarray
    first: np.ndarray
    width: np.ndarray
    place: np.ndarray
    exact: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, query: np.ndarray, weight: np.ndarray, queries: int) -> "_Block":
        terms, at = np.unique(ids, return_inverse=True)
        held = np.bincount(at, minlength=len(terms))
        often = np.argsort(-held, kind="stable")[:DENSE_TERMS]
        often = often[held[often] >= max(1, DENSE_SHARE * queries)]
        column = np.full(len(terms), -1, np.int32)
        column[often] = np.arange(len(often))
        count = -(-held // LANES)
        start = np.cumsum(count) - count
        order = np.argsort(at, kind="stable")
        lane = np.arange(len(at)) + np.repeat(start * LANES - np.cumsum(held) + held, held)
        by_term = np.zeros(int(count.sum()) * LANES, np.int32), np.zeros(int(count.sum()) * LANES, np.float32)
        by_term[0][lane], by_term[1][lane] = query[order], weight[order]
        order = np.argsort(query, kind="stable")
        width = np.bincount(query, minlength=queries)
        return cls(terms, column, often, start, count, *(x.reshape(-1, LANES) for x in by_term),
                   np.cumsum(width) - width, width, at[order].astype(np.int32), weight[order])

    @cached_property
    def dense(self) -> np.ndarray:
        """``often`` x queries."""
        out = np.zeros((len(self.often), len(self.width)), np.float32)
        column = self.column[self.place]
        inner = column >= 0
        out[column[inner], np.repeat(np.arange(len(self.width)), self.width)[inner]] = self.exact[inner]
        return out

    @cached_property
    def table(self) -> np.ndarray:
        out = np.full(int(self.terms[-1]) + 2, -1, np.int32)
        out[self.terms] = np.arange(len(self.terms))
        return out

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Place of every term number among the block's terms, or -1."""
        if not len(self.terms):
            return np.full(len(ids), -1, np.int32)
        if self.terms[-1] < TABLE:
            return self.table[np.minimum(ids, len(self.table) - 1)]
        at = np.minimum(np.searchsorted(self.terms, ids), len(self.terms) - 1)
        return np.where(self.terms[at] == ids, at, -1)

    def scores(self, doc: np.ndarray, term: np.ndarray, w: np.ndarray, docs: int) -> np.ndarray:
        """``docs`` x queries, from entries ``(doc, place of term, weight)``."""
        column, queries, count = self.column[term], len(self.width), self.count[term]
        # a document goes through the matrix where that is less work than its entries there
        held = np.bincount(doc, np.where(column >= 0, count, 0), docs) * LANES
        matrix = held * ENTRY_CELLS > len(self.often) * queries
        inner = (column >= 0) & matrix[doc]
        out = np.zeros((docs, queries), np.float32)
        if some := int(matrix.sum()):
            tile = np.zeros((some, len(self.often)), np.float32)
            tile[(np.cumsum(matrix) - 1)[doc[inner]], column[inner]] = w[inner]
            if some == docs:
                np.matmul(tile, self.dense, out=out)
            else:
                out[matrix] = tile @ self.dense
        doc, term, w, count = doc[~inner], term[~inner], w[~inner], count[~inner]
        row = np.repeat(self.start[term] - np.cumsum(count) + count, count)
        row += np.arange(len(row))
        cell, w = np.repeat((doc * queries).astype(np.int32), count)[:, None], np.repeat(w.astype(np.float32), count)[:, None]
        for i in range(0, len(row), ADDED):
            at = self.query.take(row[i:i + ADDED], axis=0) + cell[i:i + ADDED]
            # an unpickled array has its own copy of the type, which numpy adds slowly
            add = self.weight.take(row[i:i + ADDED], axis=0).view(np.float32)
            add *= w[i:i + ADDED]
            np.add.at(out.reshape(-1), at.reshape(-1), add.reshape(-1))
        return out

    def again(self, doc: np.ndarray, query: np.ndarray, off: np.ndarray, place: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Scores of pairs of documents and queries in double precision; the
        entries of document ``i`` are ``off[i]`` to ``off[i + 1]``."""
        out, order = np.zeros(len(doc)), np.argsort(doc, kind="stable")
        some, which = np.unique(doc, return_inverse=True)
        laid = np.zeros((AGAIN_DOCS, len(self.terms)))
        ends = np.searchsorted(which[order], np.arange(0, len(some) + AGAIN_DOCS, AGAIN_DOCS))
        for k, (i, j) in enumerate(zip(ends, ends[1:])):
            filled = []
            for x, d in enumerate(some[k * AGAIN_DOCS:(k + 1) * AGAIN_DOCS]):
                met = place[off[d]:off[d + 1]]
                filled.append((x, met[met >= 0]))
                laid[x, met[met >= 0]] = w[off[d]:off[d + 1]][met >= 0]
            least = np.cumsum(self.width[query[order[i:j]]]) // AGAIN_ENTRIES
            for part in np.split(order[i:j], np.flatnonzero(np.diff(least)) + 1):
                width = self.width[query[part]]
                at = np.repeat(self.first[query[part]] - np.cumsum(width) + width, width)
                at += np.arange(len(at))
                pair = np.repeat(np.arange(len(part)), width)
                found = laid[(which[part] - k * AGAIN_DOCS)[pair], self.place[at]] * self.exact[at]
                out[part] = np.bincount(pair, found, len(part))
            for x, met in filled:
                laid[x, met] = 0
        return out


def best_of(score: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(document, query)`` places of each query's top ``n`` positive scores
    in a tile, by rounded score, then the larger row."""
    r = np.round(score, RANK_DECIMALS)
    if len(r) > n:
        doc, query = np.nonzero((r > 0) & (r >= np.partition(r, len(r) - n, axis=0)[len(r) - n]))
    else:
        doc, query = np.nonzero(r > 0)
    # rounding may hide the least scores, which still count as positive
    tiny_doc, tiny_query = np.nonzero((score > 0) & (r == 0))
    doc, query = np.concatenate((doc, tiny_doc)), np.concatenate((query, tiny_query))
    order = np.lexsort((-rows[doc], -r[doc, query], query))
    doc, query = doc[order], query[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return doc[rank < n], query[rank < n]


class _Best:
    """Each query's top ``n`` positive scores, by rounded score, then the
    larger row.  Scores that are added may be off by a share of ``slack``;
    then ``again(documents, queries)`` has the true ones."""

    def __init__(self, queries: int, n: int):
        self.n, self.low = n, np.zeros(queries)
        self.slack, self.again = 0.0, None
        # query, row, score, document
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        self.waiting = 0

    def batch(self, slack: float, again: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
        """The documents of the tiles to come are places in another batch;
        those of the last one are ranked."""
        self.slack, self.again = min(slack, 0.25), again

    def add(self, score: np.ndarray, rows: np.ndarray, first: int = 0) -> None:
        """A tile, whose documents are those from ``first`` of their batch."""
        score = np.ascontiguousarray(score)
        low = np.nextafter((self.low * (1 - 2 * self.slack)).astype(score.dtype), score.dtype.type(0))
        at = np.flatnonzero((score > low).reshape(-1))
        if len(at) > WAITING and len(score) > self.n:
            nth = np.partition(score, len(score) - self.n, axis=0)[len(score) - self.n]
            nth = np.maximum(nth * (1 - 4 * self.slack) - 2 * MARGIN, 0).astype(score.dtype)
            at = np.flatnonzero((score > np.maximum(low, nth)).reshape(-1))
        doc, query = np.divmod(at, score.shape[1])
        self.kept.append((query, rows[doc], score.reshape(-1)[at].astype(float), doc + first))
        self.waiting += len(at)
        if self.waiting > WAITING:
            self.thin()

    def thin(self) -> None:
        """Leaves out what cannot be in a list; ties may be many."""
        query, rows, score, doc = (np.concatenate(x) for x in zip(*self.kept))
        slack = self.slack * (doc >= 0)
        least = score * (1 - slack)
        order = np.lexsort((-least, query))
        rank = np.arange(len(query)) - np.searchsorted(query[order], query[order])
        last = order[rank == self.n - 1]
        # a lower score cannot round to the n-th
        self.low[query[last]] = np.maximum(self.low[query[last]], least[last] - 2 * MARGIN)
        top = (doc < 0) | (score * (1 + 2 * slack) > self.low[query])
        self.kept, self.waiting = [(query[top], rows[top], score[top], doc[top])], 0
        if int(top.sum()) > 10 * max(WAITING, len(self.low) * self.n):
            self.rank()

    def rank(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, row, score)`` kept so far."""
        if self.again and self.waiting:
            self.waiting = 0
            self.thin()
        query, rows, score, doc = (np.concatenate(x) for x in zip(*self.kept))
        if self.again and (doc >= 0).any():
            score[doc >= 0] = self.again(doc[doc >= 0], query[doc >= 0])
        r = np.round(score, RANK_DECIMALS)
        order = np.lexsort((-rows, -r, query))
        query, rows, score, r = query[order], rows[order], score[order], r[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        last = rank == self.n - 1
        # a lower score cannot round to the n-th
        self.low[query[last]] = np.maximum(r[last] - MARGIN, 0)
        top = rank < self.n
        self.kept, self.waiting = [(query[top], rows[top], score[top], np.full(int(top.sum()), -1))], 0
        return self.kept[0][:3]


def _largest(n: int, rows: np.ndarray, *lists: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Places, in order, of the documents with the ``n`` largest of the
    ascending ``rows`` in every group of equal lists ``(offsets, values)``; of
    one row ``n`` at most."""
    seen: dict[tuple, tuple[int, int, int]] = {}
    out = []
    for i in range(len(rows) - 1, -1, -1):
        key = tuple(x[o[i]:o[i + 1]].tobytes() for o, x in lists)
        last, held, times = seen.get(key, (None, 0, 0))
        held, times = (held, times + 1) if last == rows[i] else (held + 1, 1)
        seen[key] = (rows[i], held, times)
        if held <= n and times <= n:
            out.append(i)
    return np.array(out[::-1], np.int64)


def _block_scores(docs: DataFrame, queries: pa.Table, filters: np.ndarray, n: int) -> DataFrame:
    """``(slot, row_id, score)``: top ``n`` of every task.  ``docs`` has the
    columns of ``VECTOR`` and ``hits``, the block's filters its genre meets;
    ``filters`` is the one of each query, -1 for none."""
    def flat(name: str) -> np.ndarray:
        return queries[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)

    width = pc.list_value_length(queries["ids"]).to_numpy()
    block = _Block.of(flat("ids").astype(np.int64), np.repeat(np.arange(len(queries)), width), flat("ws"), len(queries))
    own = pc.fill_null(queries["_self"], -1).to_numpy()
    asked = filters >= 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(own), n)
        for b in batches:
            b = b.sort_by("row_id")
            all_off, all_hits = b.column(1).offsets.to_numpy(), b.column(3).offsets.to_numpy()
            few = _largest(n + 1, b.column(0).to_numpy(), (all_off, b.column(1).values.to_numpy()), (all_off, b.column(2).values.to_numpy()),
                           (all_hits, b.column(3).values.to_numpy()))
            if len(few) < len(b):
                b = b.take(pa.array(few))
            rows = b.column(0).to_numpy()
            off, hit_off = b.column(1).offsets.to_numpy(), b.column(3).offsets.to_numpy()
            place, ws = block.places(b.column(1).values.to_numpy()), b.column(2).values.to_numpy()
            hits = b.column(3).values.to_numpy()
            mine = np.isin(rows, own)
            # products, their sum, and the roundings of weights
            roundings = int(np.diff(off).max(initial=0)) + 8
            best.batch(roundings * 2.0 ** -23, lambda doc, query: block.again(doc, query, off, place, ws))
            for i in range(0, len(rows), DOC_BLOCK):
                j = min(i + DOC_BLOCK, len(rows))
                doc = np.repeat(np.arange(j - i), np.diff(off[i:j + 1]))
                met = place[off[i]:off[j]] >= 0
                score = block.scores(doc[met], place[off[i]:off[j]][met], ws[off[i]:off[j]][met], j - i)
                for d in np.flatnonzero(mine[i:j]):
                    score[d, own == rows[i + d]] = 0
                if asked.any():
                    ok = np.zeros((j - i, int(filters.max()) + 1), bool)
                    ok[np.repeat(np.arange(j - i), np.diff(hit_off[i:j + 1])), hits[hit_off[i]:hit_off[j]]] = True
                    if not ok.all():
                        score[:, asked] *= ok[:, filters[asked]]
                best.add(score, rows[i:j], i)
            best.rank()
        query, rows, score = best.rank()
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(rows), pa.array(score)], ["slot", "row_id", "score"])

    # documents stream by: a task of many finds its n-th scores, and reads the block, but once
    docs = docs.select("row_id", "ids", "ws", "hits").coalesce(WAVES * docs.sparkSession.sparkContext.defaultParallelism)
    found = docs.mapInArrow(work, "slot int, row_id long, score double")
    return top_n_per_query(found, n, "slot").drop("rank")


def _blocks(groups: list, n: int) -> Iterator[list[int]]:
    """Consecutive groups ``(group, queries, terms)`` up to a block's bounds."""
    held, queries, terms = [], 0, 0
    for g, q, t in sorted(groups):
        if held and (queries + q > QUERY_BLOCK or terms + t > BLOCK_TERMS or (queries + q) * n > KEPT):
            yield held
            held, queries, terms = [], 0, 0
        held, queries, terms = [*held, int(g)], queries + q, terms + t
    if held:
        yield held


def tile_top_n(queries: DataFrame, docs: DataFrame, genres: DataFrame, n: int, qid: str = "query_id") -> DataFrame:
    """``(qid, row_id, score)``: for every query its ``n`` best documents of
    those that share a term with it and pass its filter.

    ``queries(qid, _self, _gf, ids, ws)``: the row to leave out and the genre
    pattern may be null.  A request whose pattern is no regex finds nothing.
    Blocks are answered one after another, each by one job over ``docs``, and
    written to the shared folder: the result outlives executors and the
    driver holds one block.
    """
    spark = queries.sparkSession
    numbered = dense_index(queries.select(qid, "_self", "_gf", "ids", "ws"), [qid], "_n")
    numbered = numbered.withColumn("_block", F.floor(F.col("_n") / min(GROUP, QUERY_BLOCK)))
    path = scratch_path(spark, "query-blocks")
    numbered.write.mode("overwrite").partitionBy("_block").parquet(path)
    stored = numbered.schema
    held = spark.read.schema(stored).parquet(path)
    groups = held.groupBy("_block").agg(F.count(F.lit(1)), F.sum(F.size("ids"))).collect()
    out = scratch_path(spark, "tile-scores")
    schema = queries.select(qid, F.lit(0).cast("long").alias("row_id"), F.lit(0.0).alias("score")).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(out)
    for ks in _blocks([tuple(r) for r in groups], n):
        block = held.filter(F.col("_block").isin(ks)).orderBy("_n").toArrow()
        gf = block["_gf"].to_pylist()
        patterns = sorted({x for x in gf if x is not None})
        number = {x: i for i, x in enumerate(patterns)}
        filters = np.array([-1 if x is None else number[x] for x in gf], np.int64)
        if patterns:
            pats = spark.createDataFrame(list(enumerate(patterns)), "pattern_id int, pattern string").filter(pattern_valid("pattern"))
            met = genres.join(F.broadcast(pats), genre_matches(F.col("genre_src"), F.col("pattern"))).select("genre_id", "pattern_id")
            few = fits_broadcast(met)
            met = met.groupBy("genre_id").agg(F.collect_list("pattern_id").alias("hits"))
            open_ = (filters < 0).any()
            # else all vectors are shuffled for every block
            some = docs.join(maybe_broadcast(met, few), "genre_id", "left" if open_ else "inner")
            some = some.withColumn("hits", F.coalesce("hits", F.array().cast("array<int>")))
        else:
            some = docs.withColumn("hits", F.array().cast("array<int>"))
        slots = spark.createDataFrame([(i, q) for i, q in enumerate(block[qid].to_pylist())], f"slot int, {qid} {queries.schema[qid].dataType.simpleString()}")
        scored = _block_scores(some, block, filters, n).join(F.broadcast(slots), "slot")
        scored.select(qid, "row_id", "score").write.mode("append").parquet(out)
    done, asked = spark.read.schema(schema).parquet(out), spark.read.schema(stored).parquet(path)
    done._stored_path, asked._stored_path = out, path
    drop_table(asked)
    return done


def store_vectors(postings: DataFrame, catalog: DataFrame, ids: DataFrame, genres: DataFrame) -> DataFrame:
    return store_sorted(document_vectors(postings, catalog, ids, genres), catalog)


def store_sorted(vectors: DataFrame, catalog: DataFrame) -> DataFrame:
    """Stored in the order of rows, so a filter on few rows skips the rest.
    The borders of the files come from ``catalog``'s ids: ranges of
    ``vectors`` itself are found by making all of them another time or two."""
    files = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = max(1, min(files, catalog.count() // FILE_ROWS))
    borders = catalog.agg(F.percentile_approx("row_id", [i / files for i in range(1, files)])).first()[0] if files > 1 else None
    if borders:
        at = F.size(F.filter(F.array(*map(F.lit, borders)), lambda x: x <= F.col("row_id")))
        vectors = vectors.repartitionById(files, at)
    else:
        vectors = vectors.coalesce(1)
    return store_table(vectors.sortWithinPartitions("row_id"), "vectors")
