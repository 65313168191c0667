"""Term counts of whole documents, row by row (A1-A3, V1).

A document is one row, so its terms are counted where it is read: no row per
(document, term) passes a shuffle or a hash table of a task.  What a task
holds is one Arrow batch, bounded in bytes.  Bigrams go by pairs of word
numbers; only the distinct ones of a batch become text.

The vocabulary takes two passes.  The first counts words; the cf of the
last of ``max_features`` words is a floor under the cut, as those words are
as many terms.  The second counts bigrams, without those that hold a word of
a smaller cf: a bigram is at most as frequent as its words, so none of those
can be in the vocabulary.  Lemmas of several words break that rule; then the
second counts all words and bigrams.

Tokens are a list, or one string with blanks between them.

Rows must not share an id (:func:`reelsim.operators.tfidf.fit` counts others).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# executors need no copy of the package for the functions below
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words that may be sent to every task (about 20 bytes each).
SENT_WORDS = 500_000


def _lists(tokens: pa.Array) -> pa.Array:
    if not (pa.types.is_string(tokens.type) or pa.types.is_large_string(tokens.type)):
        return tokens
    return pc.split_pattern(pc.if_else(pc.equal(tokens, ""), pa.scalar(None, tokens.type), tokens), " ")


def _documents(tokens: pa.Array) -> np.ndarray:
    """The document of every token."""
    return np.repeat(np.arange(len(tokens)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))


def _several(words: pa.Array) -> np.ndarray:
    return pc.match_substring(words, " ").to_numpy(zero_copy_only=False)


def _runs(key: np.ndarray) -> np.ndarray:
    """Where a value of the sorted ``key`` begins."""
    return np.flatnonzero(np.diff(key, prepend=key[:1] - 1))


def _pair_stats(tokens: pa.Array, known: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(bigram, df, cf)`` of a batch, for bigrams of ``known`` words."""
    doc = _documents(tokens)
    coded = tokens.flatten().dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    used = pc.is_in(words, known).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    both = np.flatnonzero(used[:-1] & used[1:] & (doc[:-1] == doc[1:]))
    # one sort brings together a bigram's documents, and its places in each
    key = (code[both] * len(words) + code[both + 1]) * len(tokens) + doc[both]
    key.sort()
    pair = key // max(len(tokens), 1)
    first = _runs(pair)
    cf = np.diff(first, append=len(pair))
    df = np.add.reduceat(np.diff(key, prepend=-1) != 0, first, dtype=np.int64) if len(first) else cf
    pair = pair[first]
    text = pc.binary_join_element_wise(words.take(pa.array(pair // max(len(words), 1))), words.take(pa.array(pair % max(len(words), 1))), " ")
    return text, df, cf


def _counts(tokens: pa.Array, known: pa.Array | None, pairs: bool) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """``(terms, document, term number, count)`` of a batch of token lists:
    words, and bigrams if ``pairs``; a word that is not ``known`` and has no
    blank is left out, and so are its bigrams."""
    doc = _documents(tokens)
    coded = tokens.flatten().dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    several = _several(words)
    use = np.ones(len(words), bool) if known is None else pc.is_in(words, known).to_numpy(zero_copy_only=False) | several
    used = use[code] if len(code) else np.zeros(0, bool)
    terms, docs, codes = words, doc[used], code[used]
    if pairs and len(code):
        both = used[:-1] & used[1:] & (doc[:-1] == doc[1:])
        made, at = np.unique(code[:-1][both] * len(words) + code[1:][both], return_inverse=True)
        if len(made):
            text = pc.binary_join_element_wise(words.take(made // len(words)), words.take(made % len(words)), " ")
            terms = pa.concat_arrays([words, text])
            docs, codes = np.concatenate((docs, doc[:-1][both])), np.concatenate((codes, len(words) + at))
        if several.any():                             # a word may equal a bigram
            again = terms.dictionary_encode()
            terms, codes = again.dictionary, again.indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    key, n = np.unique(docs * max(len(terms), 1) + codes, return_counts=True)
    return terms, key // max(len(terms), 1), key % max(len(terms), 1), n


def term_stats(docs: DataFrame, tokens_col: str = "tokens", known: list[str] | None = None, pairs: bool = True) -> DataFrame:
    """``(term, df, cf)`` partial counts of ``docs[tokens_col]``: several rows
    per term, to be summed.  Given the ``known`` words, which hold no blank,
    those of their bigrams alone."""
    known_words = None if known is None else pa.array(known, pa.string())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = _lists(b.column(0))
            if known_words is not None:
                yield pa.RecordBatch.from_arrays([*map(pa.array, _pair_stats(tokens, known_words))], ["term", "df", "cf"])
                continue
            terms, _, code, n = _counts(tokens, None, pairs)
            df, cf = np.bincount(code, minlength=len(terms)), np.bincount(code, n, len(terms)).astype(np.int64)
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([terms.take(some), pa.array(df[some]), pa.array(cf[some])], ["term", "df", "cf"])

    return docs.select(tokens_col).mapInArrow(work, "term string, df long, cf long")


def by_document(docs: DataFrame, terms: list[tuple[str, int, float]], sublinear: bool, norm: bool, tokens_col: str = "tokens",
                id_col: str = "row_id") -> DataFrame:
    """``docs`` with ``ids, tfs, ws`` (ascending term numbers, counts and
    weights) in place of ``tokens_col``; rows without a term are left out.
    ``terms`` are ``(term, number, idf)`` of a vocabulary, numbered from 0;
    ``docs`` has ``id_col``, ``genre_id`` and the tokens."""
    terms = sorted(terms, key=lambda t: t[1])
    names, idf = pa.array([t for t, *_ in terms], pa.string()), np.array([x for *_, x in terms])
    parts = sorted({w for t, *_ in terms for w in t.split(" ")})
    known, place = pa.array(parts, pa.string()), {w: i for i, w in enumerate(parts)}
    # term numbers of words, and of bigrams by the places of their words
    single = np.full(len(parts) + 1, -1, np.int64)
    double = []
    for t, i, _ in terms:
        if t in place:
            single[place[t]] = i
        elif t.count(" ") == 1:
            double.append((place[t.split(" ")[0]] * len(parts) + place[t.split(" ")[1]], i))
    pairs, pair_terms = np.array(sorted(double), np.int64).reshape(-1, 2).T.copy()

    def found(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(document, term number, count)``, ascending."""
        coded = tokens.flatten().dictionary_encode()
        if _several(coded.dictionary).any():
            text, doc, code, tf = _counts(tokens, known, True)
            number = pc.fill_null(pc.index_in(text, names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            term = number[code] if len(code) else code
            doc, term, tf = doc[term >= 0], term[term >= 0], tf[term >= 0]
            order = np.lexsort((term, doc))
            return doc[order], term[order], tf[order]
        doc = _documents(tokens)
        at = pc.fill_null(pc.index_in(coded.dictionary, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = at[coded.indices.to_numpy(zero_copy_only=False)] if len(doc) else doc
        words = np.flatnonzero(single[at] >= 0)
        both = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0) & (doc[:-1] == doc[1:])) if len(pairs) else words[:0]
        pair = at[both] * len(parts) + at[both + 1]
        near = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        met = pairs[near] == pair if len(pairs) else np.zeros(0, bool)
        key = np.concatenate((doc[words] * len(idf) + single[at[words]], doc[both[met]] * len(idf) + pair_terms[near[met]]))
        key.sort()
        first = _runs(key)
        return key[first] // len(idf), key[first] % len(idf), np.diff(first, append=len(key))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, term, tf = found(_lists(b.column(2)))
            w = (1.0 + np.log(tf) if sublinear else tf.astype(float)) * idf[term]
            if norm:
                w = w / np.sqrt(np.bincount(doc, w * w, len(b)))[doc]
            n = np.bincount(doc, minlength=len(b))
            some, ends = np.flatnonzero(n), pa.array(np.concatenate(([0], np.cumsum(n[n > 0]))), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term.astype(np.int32), tf.astype(np.int64), w)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(some)), b.column(1).take(pa.array(some)), *lists],
                                             [id_col, "genre_id", "ids", "tfs", "ws"])

    return docs.select(id_col, "genre_id", tokens_col).mapInArrow(
        work, f"{id_col} long, genre_id long, ids array<int>, tfs array<long>, ws array<double>")


def repeated_ids(docs: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Ids of several rows, and a missing one."""
    n = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    return n.filter((F.col("_n") > 1) | F.col(id_col).isNull()).select(F.col(id_col).alias("_id"))
