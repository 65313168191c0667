"""Quality classifier: Bradley-Terry ranking of documents.

A document's strength is a linear score of text features.  The model learns
from preference pairs (a document labelled 1 is preferred to one labelled
0): logistic loss on the difference of their features.  The cut is a
quantile of the strengths of the training documents, and strengths are
mapped to 0..1 so that the cut lands on ``CUT``.

Defined results: a null or empty text has all-zero features and gets the
score those give; labels that are null or of unknown documents are ignored;
a document labelled twice counts with its smaller label, an id of several
rows teaches once, with its least text; without documents of both labels
every score is 0.5; repeated documents get equal scores; an
empty table gives an empty result.  Only ``doc_id`` and ``text`` are read,
and only the text is scored, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsim.llm.common import trimmed, with_fields
from reelsim.llm.words import Words, chunks, grams, text_bytes

# Documented bound of the training sample: so many documents of each label.
SAMPLE_PER_LABEL = 5_000
# Pairs drawn for each document of the rarer label.
PAIRS_PER_DOCUMENT = 16
# The score at the cut; documents at or above it are kept.
CUT = 0.7
RIDGE = 1e-3

KINDS = 11                         # byte classes, see _byte_classes
FEATURES = KINDS + 12


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 9, np.uint8)                      # other symbols
    kind[ord("a"):ord("z") + 1] = 0
    kind[ord("A"):ord("Z") + 1] = 1
    kind[ord("0"):ord("9") + 1] = 2
    kind[ord(" ")] = 3
    kind[[9, 10, 11, 12, 13]] = 4
    kind[[ord(c) for c in ".,;:?'\"-()"]] = 5
    kind[ord("!")] = 6
    kind[[ord(c) for c in "|<>{}[]\\/=_"]] = 7
    kind[128:] = 8
    kind[:9] = kind[14:32] = 10                           # control bytes
    return kind


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text, over the whole text."""
    data, offs = text_bytes(texts)
    out = np.zeros((len(texts), FEATURES))
    kind = _byte_classes()
    for i, j in chunks(offs):
        w = Words(data, offs, i, j)
        k, size = j - i, np.diff(w.off)
        row = np.repeat(np.arange(k, dtype=np.int64) * KINDS, size)
        by = np.bincount(row + kind[w.data], minlength=k * KINDS).reshape(k, KINDS)
        f = out[i:j]
        f[:, :KINDS] = by / np.maximum(size, 1)[:, None]
        h, doc = w.hashes(), w.text_of_word()
        n = np.diff(w.first)
        some = np.maximum(n, 1)
        length = w.ends - w.starts
        last = w.data[w.ends - 1] if len(h) else np.zeros(0, np.uint8)
        head = w.data[w.starts] if len(h) else np.zeros(0, np.uint8)
        per = lambda x: np.bincount(doc, weights=x, minlength=k)
        mean = per(length) / some
        f[:, KINDS] = np.log1p(n)
        f[:, KINDS + 1] = mean / 10
        f[:, KINDS + 2] = np.sqrt(np.maximum(per(length.astype(float) ** 2) / some - mean ** 2, 0)) / 10
        f[:, KINDS + 3] = per(kind[last] >= 6) / some     # words that end in a symbol
        f[:, KINDS + 4] = per(kind[head] == 1) / some     # words that begin upper-case
        f[:, KINDS + 5] = per((length == 1) & (kind[head] >= 5)) / some
        g = grams(h, 3)
        for t in range(k):
            a, b = int(w.first[t]), int(w.first[t + 1])
            if b > a:
                s = np.sort(h[a:b])
                edge = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True])))
                f[t, KINDS + 6] = (len(edge) - 1) / (b - a)
                f[t, KINDS + 7] = np.diff(edge).max() / (b - a)
                # distinct words against what prose of that length has
                f[t, KINDS + 8] = np.log((len(edge) - 1) / (b - a) ** 0.8)
            if b - a >= 3:
                s = np.sort(g[a:b - 2])
                f[t, KINDS + 9] = 1 - (1 + np.count_nonzero(s[1:] != s[:-1])) / (b - a - 2)
        f[:, KINDS + 10] = np.sqrt(f[:, 6] + f[:, 7] + f[:, 9] + f[:, 10])
        f[:, KINDS + 11] = np.sqrt(np.minimum(f[:, 1] / np.maximum(f[:, 0] + f[:, 1], 1e-9), 1))
    return out


@dataclass(frozen=True)
class Ranker:
    """Weights on standardised features, the cut and the spread of strengths."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    spread: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = (x - np.array(self.mean)) / np.array(self.scale) @ np.array(self.weights)
        z = np.clip((s - self.cut) / self.spread, -30, 30) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-z))


def fit_pairs(good: np.ndarray, bad: np.ndarray, bad_share: float, seed: int = 0) -> Ranker | None:
    """Bradley-Terry weights from pairs of a good and a bad feature row
    (Newton steps on the ridge-penalised logistic loss), then the cut at a
    score quantile: the one between ``bad_share`` of the weighted strengths
    and its neighbours that ranks the fewest training rows wrongly."""
    if not len(good) or not len(bad):
        return None
    x = np.vstack([good, bad])
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    g, b = (good - mean) / scale, (bad - mean) / scale
    rng = np.random.default_rng(seed)
    n = PAIRS_PER_DOCUMENT * min(len(g), len(b))
    d = g[rng.permutation(np.arange(n) % len(g))] - b[rng.permutation(np.arange(n) % len(b))]
    w = np.zeros(d.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (1 - p) / n - RIDGE * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / n + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    sg, sb = np.sort(g @ w), np.sort(b @ w)
    # candidate cuts are quantiles of the strengths, each class weighted as
    # in all the labels; ties go to the middle of the best stretch
    cuts = np.quantile(np.concatenate([sg, sb]), np.linspace(0, 1, 2001))
    wrong = ((1 - bad_share) * np.searchsorted(sg, cuts, "left") / len(sg)
             + bad_share * (1 - np.searchsorted(sb, cuts, "left") / len(sb)))
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    cut = float((cuts[best[0]] + cuts[best[-1]]) / 2)
    spread = float(np.std(np.concatenate([sg, sb])) / 4 or 1.0)
    return Ranker(tuple(mean), tuple(scale), tuple(w), cut, spread)


def training_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, quality)`` of the rows that may teach: crc32 of the id as
    text, modulo 4, is not 2."""
    ok = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ok)
                  .groupBy("doc_id").agg(F.min("quality").alias("quality")))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Ranker | None:
    """Fit on at most ``per_label`` documents of each label, taken in hash
    order of their ids.  Features are computed in tasks; the driver sees
    only the sample's feature rows."""
    known = training_labels(labels)
    n = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    take = lambda q: (known.filter(F.col("quality") == q)
                           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label))
    # at most 2 * per_label rows of two numbers: a fixed bound
    ids = F.broadcast(take(0).unionByName(take(1)).select(F.col("doc_id").alias("_id"), "quality"))
    # one row per labelled id, however often it repeats: the least text
    rows = (docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"))
                .groupBy("_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text")).select("quality", "text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = features(b.column(1))
            flat = pa.ListArray.from_arrays(np.arange(len(f) + 1, dtype=np.int32) * FEATURES, f.ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), flat], ["quality", "f"])

    got = rows.mapInArrow(trimmed(work), "quality int, f array<double>").toPandas()
    x = np.array(got["f"].tolist()).reshape(len(got), FEATURES)
    q = got["quality"].to_numpy()
    order = np.lexsort((*x.T, q))                        # the same fit whatever the row order
    x, q = x[order], q[order]
    return fit_pairs(x[q == 1], x[q == 0], n[0] / (n[0] + n[1]))


def score(docs: DataFrame, ranker: Ranker | None, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Columns ``keep`` of ``docs`` (text among them) and ``score``."""
    at = keep.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column(at)
            s = ranker.scores(features(t)) if ranker else np.full(len(t), 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*keep, "score"])

    slim = docs.select(*keep)
    return slim.mapInArrow(trimmed(work), with_fields(slim.schema, score=T.DoubleType()))


def predictions(scored: DataFrame) -> DataFrame:
    """Adds ``predicted``: 1 from the cut on, else 0."""
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
