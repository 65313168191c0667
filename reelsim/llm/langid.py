"""Language identification by interpolated Kneser-Ney character models.

Characters become six-bit symbols: 0 for a run of anything but letters, 1 to
61 for the letters with the greatest share in any one language (lower-cased),
62 for other letters.  A 4-gram is then one 24-bit code, which serves as its
own (collision-free) hash.  Letters and 4-grams are counted by Spark over the
whole texts of all documents that may teach, so the model grows with the
corpus until every gram has been met; a language holds at most 2 ** 24.

Counts are stored sorted by language and code.  Scoring tasks read them from
there into sorted arrays per language, of which they take what Kneser-Ney
needs: counts of 4-grams, continuation counts of shorter ones (how many
distinct symbols precede), context sums and one discount per order.  The
language with the lowest cross-entropy per symbol wins.

A fold of the teaching documents is left out of the counts and calibrates:
the likelihood ratio of the two best languages, in bins, against the share of
right answers (made monotone) gives the score; ``rejected`` marks answers
whose score is below ``RELIABLE`` or whose entropy is above nearly all of
the fold's.

Defined results: texts that are null or have no letter are ``und`` with score
0; so is everything if nothing teaches; equal entropies go to the smaller
language name; repeated rows get equal answers; rows without a doc_id do not
teach; an empty table gives an empty result.  Only ``doc_id``, ``text`` and
(of teaching rows) ``lang`` are read.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsim.llm.common import bound_batches, store, trimmed
from reelsim.llm.files import open_store
from reelsim.llm.words import chunks, text_bytes

BITS, ORDER = 6, 4
LETTERS, OTHER = 61, 62
GRAMS = 1 << BITS * ORDER
FOLDS = 5
UNKNOWN = "und"
RELIABLE = 0.9
# Calibration bins: of the log of the likelihood ratio, and of the entropy.
RATIO_BINS, RATIO_STEP = 64, 0.2
ENTROPY_STEP, ENTROPY_SHARE = 0.02, 0.999
# Distinct grams a worker remembers the probabilities of, and counts it holds.
REMEMBERED = 1 << 20
HELD = 1 << 22


def _kept(name: str) -> dict:
    """A place for what a worker process keeps between tasks."""
    return sys.modules.setdefault("_reelsim_langid", types.ModuleType("_reelsim_langid")).__dict__.setdefault(name, {})


def lower_letters() -> np.ndarray:
    """For every code point its lower-case letter, 0 if it is no letter."""
    kept = _kept("letters")
    if not kept:
        low = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                x = x.lower()
                low[c] = ord(x) if len(x) == 1 else c
        kept["low"] = low
    return kept["low"]


def code_points(data: np.ndarray, offs: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts ``i .. j-1`` and where each text begins."""
    raw = data[offs[i]:offs[j]]
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
    count = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return points, count[offs[i:j + 1] - offs[i]]


def symbol_table(letters: tuple[int, ...]) -> np.ndarray:
    """The symbol of every code point."""
    kept = _kept("symbols")
    if letters not in kept:
        low = lower_letters()
        of_letter = np.full(0x110000, OTHER, np.uint8)
        of_letter[0] = 0
        of_letter[list(letters)] = np.arange(1, len(letters) + 1)
        kept.clear()
        kept[letters] = of_letter[low]
    return kept[letters]


def gram_codes(points: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, symbols per text, letters per text)``: a 4-gram for every
    symbol, texts being preceded by three blanks."""
    sym = table[points]
    letter = sym > 0
    letters = np.diff(np.concatenate(([0], np.cumsum(letter)))[off])
    keep = letter.copy()
    keep[1:] |= letter[:-1]                       # the first of a run of blanks
    keep[off[:-1][np.diff(off) > 0]] = letter[off[:-1][np.diff(off) > 0]]
    n = np.diff(np.concatenate(([0], np.cumsum(keep)))[off])
    at = np.arange(n.sum()) + (ORDER - 1) * np.repeat(np.arange(1, len(n) + 1), n)
    stream = np.zeros(len(at) + (ORDER - 1) * len(n), np.uint32)
    stream[at] = sym[keep]
    code = np.zeros(len(at), np.uint32)
    for back in range(ORDER - 1, -1, -1):
        code = code << np.uint32(BITS) | stream[at - back]
    return code, n, letters


def fold() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))


def _counted(rows: DataFrame, langs: tuple[str, ...], code_of, size: int) -> DataFrame:
    """``(lang int, code int, n long)`` over whole texts; ``code_of`` maps a
    chunk to its codes (below ``size``) and how many each text has."""
    index = {x: i for i, x in enumerate(langs)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def merged():
            key, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(key, kind="stable")
            edge = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
            return key[order][edge], np.add.reduceat(n[order], edge)

        def out():
            key, n = merged()
            return pa.RecordBatch.from_arrays([pa.array((key // size).astype(np.int32)), pa.array((key % size).astype(np.int32)), pa.array(n)],
                                              ["lang", "code", "n"])

        for b in batches:
            data, offs = text_bytes(b.column(1))
            lang = np.array([index[x] for x in b.column(0).to_pylist()], np.int64)
            for i, j in chunks(offs):
                code, per = code_of(data, offs, i, j)
                key, n = np.unique(np.repeat(lang[i:j], per) * size + code, return_counts=True)
                if len(key):
                    held.append((key, n.astype(np.int64)))
                    n_held += len(key)
                if n_held > HELD:
                    held[:] = [merged()]
                    n_held = len(held[0][0])
                    if n_held > HELD // 2:        # hardly anything repeats: hand it on
                        yield out()
                        held.clear()
                        n_held = 0
        if held:
            yield out()

    counts = rows.select("lang", "text").mapInArrow(trimmed(work), "lang int, code int, n long")
    return counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def choose_letters(rows: DataFrame, langs: tuple[str, ...]) -> tuple[int, ...]:
    """The ``LETTERS`` letters of the greatest share in any language; the
    driver gets just these."""
    def letters(data, offs, i, j):
        points, off = code_points(data, offs, i, j)
        low = lower_letters()[points]
        return low[low > 0], np.diff(np.concatenate(([0], np.cumsum(low > 0)))[off])

    counts = _counted(rows, langs, letters, 0x110000)
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    best = counts.withColumn("share", share).groupBy("code").agg(F.max("share").alias("share"))
    return tuple(sorted(r["code"] for r in best.orderBy(F.desc("share"), "code").limit(LETTERS).collect()))


class KneserNey:
    """One language's model over sorted codes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.orders = []
        key, c = codes.astype(np.int64), counts.astype(float)
        for order in range(ORDER, 0, -1):
            ones, twos = np.count_nonzero(c == 1), np.count_nonzero(c == 2)
            discount = ones / (ones + 2 * twos) if ones else 0.5
            context, first = np.unique(key >> BITS, return_index=True)
            total, kinds = np.add.reduceat(c, first), np.diff(np.append(first, len(key)))
            self.orders.append((key, c, discount, context, total, kinds))
            # a shorter gram counts the distinct symbols before it
            key, c = np.unique(key & ((1 << BITS * (order - 1)) - 1), return_counts=True)
            c = c.astype(float)
        self.orders.reverse()

    def log_p(self, code: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each 4-gram after the rest."""
        p = np.full(len(code), 1 / (OTHER + 1))
        for order, (key, c, discount, context, total, kinds) in enumerate(self.orders, 1):
            gram = code.astype(np.int64) & ((1 << BITS * order) - 1)
            at = np.minimum(np.searchsorted(context, gram >> BITS), len(context) - 1)
            met = context[at] == gram >> BITS
            to = np.minimum(np.searchsorted(key, gram), len(key) - 1)
            seen = np.where(key[to] == gram, np.maximum(c[to] - discount, 0), 0)
            p = np.where(met, (seen + discount * kinds[at] * p) / total[at], p)
        return np.log(p)


class Scorer:
    """The models of all languages in one worker process."""

    def __init__(self, path: str, n_langs: int):
        from pyarrow import fs
        where, folder = open_store(path)
        files = [f.path for f in where.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".parquet")]
        tables = []
        for f in sorted(files):
            with where.open_input_file(f) as raw:
                tables.append(pq.read_table(raw, columns=["lang", "code", "n"]))
        t = pa.concat_tables(tables)
        lang, code, n = (t[c].to_numpy() for c in ("lang", "code", "n"))
        order = np.lexsort((code, lang))
        lang, code, n = lang[order], code[order], n[order]
        edge = np.searchsorted(lang, np.arange(n_langs + 1))
        self.models = [KneserNey(code[a:b], n[a:b]) if b > a else None for a, b in zip(edge[:-1], edge[1:])]
        self.clear()

    def clear(self):
        self.place = np.full(GRAMS, -1, np.int32)
        self.table = np.zeros((0, len(self.models)))

    def entropies(self, code: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Cross-entropy per symbol of each text (row) in each language."""
        if len(self.table) > REMEMBERED:
            self.clear()
        new = np.zeros(GRAMS, bool)
        new[code] = True
        new = np.flatnonzero(new & (self.place < 0))
        if len(new):
            self.place[new] = len(self.table) + np.arange(len(new))
            none = np.full(len(new), -np.inf)
            self.table = np.vstack([self.table, np.stack([m.log_p(new) if m else none for m in self.models], axis=1)])
        at = self.place[code]
        some = n > 0
        first = (np.cumsum(n) - n)[some]
        out = np.full((len(n), len(self.models)), np.inf)
        for x in range(len(self.models)):
            if some.any():
                out[some, x] = -np.add.reduceat(self.table[at, x], first) / n[some]
        return out


def scorer(path: str, n_langs: int) -> Scorer:
    kept = _kept("scorers")
    if path not in kept:
        kept.clear()
        kept[path] = Scorer(path, n_langs)
    return kept[path]


@dataclass(frozen=True)
class Model:
    """Where the counts are, and what the driver knows of them."""

    path: str
    langs: tuple[str, ...]
    letters: tuple[int, ...]
    score: tuple[float, ...] = ()            # calibrated, per bin of the ratio
    entropy: float = float("inf")            # above it an answer is rejected


def _answers(docs: DataFrame, model: Model, keep: str) -> DataFrame:
    """Column ``keep`` and for each text the best language, the log
    likelihood ratio to the next and the entropy; nulls without a letter."""
    langs = np.array(model.langs, object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, models = symbol_table(model.letters), scorer(model.path, len(langs))
        for b in batches:
            data, offs = text_bytes(b.column(1))
            for i, j in chunks(offs):
                code, n, letters = gram_codes(*code_points(data, offs, i, j), table)
                h = models.entropies(code, n)
                best = h.argmin(1)
                low = h[np.arange(j - i), best]
                none = (letters == 0) | ~np.isfinite(low)
                h[np.arange(j - i), best] = np.inf
                with np.errstate(invalid="ignore"):
                    ratio = np.where(none, 0, (h.min(1) - low) * n)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(langs[best], pa.string(), mask=none),
                                                  pa.array(ratio, mask=none), pa.array(low, mask=none)], [keep, "best", "ratio", "entropy"])

    slim = docs.select(keep, "text")
    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(trimmed(work), f"{keep} {kind}, best string, ratio double, entropy double")


def monotone(right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Share of right answers per bin, never falling (pooled neighbours)."""
    pools: list[list[float]] = []
    for r, n in zip(right.tolist(), total.tolist()):
        pools.append([r, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            r2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + r2, pools[-1][1] + n2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), r / n) for r, n, k in pools])


def fit(docs: DataFrame) -> Model | None:
    """Learn from the rows of ``docs`` with a language whose fold is not 0;
    fold 1 calibrates.  None if nothing teaches."""
    bound_batches(docs.sparkSession)
    teach = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 0)).select("doc_id", "text", "lang")
    count = teach.filter(fold() != 1)
    # one row per language: classes of the model
    langs = tuple(sorted(r["lang"] for r in count.select("lang").distinct().collect()))
    if not langs:
        return None
    letters = choose_letters(count, langs)

    def grams(data, offs, i, j):
        code, n, _ = gram_codes(*code_points(data, offs, i, j), symbol_table(letters))
        return code, n

    counts = store(_counted(count, langs, grams, GRAMS).repartitionByRange("lang", "code").sortWithinPartitions("lang", "code"), "grams")
    model = Model(counts._stored_path, langs, letters)
    tried = _answers(teach.filter(fold() == 1), model, "lang").filter("best is not null")
    step = F.least(F.floor(F.log1p("ratio") / RATIO_STEP), F.lit(RATIO_BINS - 1)).cast("int")
    rows = tried.groupBy(step.alias("bin"), F.floor(F.col("entropy") / ENTROPY_STEP).cast("int").alias("h")).agg(
        F.count("*").alias("n"), F.sum((F.col("best") == F.col("lang")).cast("long")).alias("right"))
    # at most bins of the ratio times bins of the entropy (below 5 nats)
    got = rows.toPandas()
    total, right = np.zeros(RATIO_BINS), np.zeros(RATIO_BINS)
    np.add.at(total, got["bin"].to_numpy(int), got["n"].to_numpy(float))
    np.add.at(right, got["bin"].to_numpy(int), got["right"].to_numpy(float))
    # one toss among the languages, spread over the bins, comes first
    score = monotone(right + 1 / len(langs) / RATIO_BINS, total + 1 / RATIO_BINS)
    by_h = got.groupby("h")["n"].sum().sort_index()
    cut = float("inf")
    if len(by_h):
        reach = by_h.cumsum().to_numpy() >= ENTROPY_SHARE * by_h.sum()
        cut = float((by_h.index[int(np.argmax(reach))] + 1) * ENTROPY_STEP)
    return Model(model.path, langs, letters, tuple(score.tolist()), cut)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score, entropy, rejected)`` for every row."""
    bound_batches(docs.sparkSession)
    ids = docs.select("doc_id", "text")
    if model is None:
        none = F.lit(None).cast("double")
        return ids.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("entropy"), F.lit(True).alias("rejected"))
    found = _answers(ids, model, "doc_id")
    # between the middles of two bins the score goes from one to the other
    steps = F.array(*[F.lit(x) for x in model.score])
    x = F.least(F.greatest(F.log1p("ratio") / RATIO_STEP - 0.5, F.lit(0.0)), F.lit(RATIO_BINS - 1.0))
    at = F.floor(x).cast("int")
    a, b = F.get(steps, at), F.get(steps, F.least(at + 1, F.lit(RATIO_BINS - 1)))
    known = F.col("best").isNotNull()
    score = F.when(known, a + (b - a) * (x - at)).otherwise(0.0)
    out = found.select("doc_id", F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"), "entropy")
    low = (F.col("score") < RELIABLE) | (F.coalesce("entropy", F.lit(float("inf"))) > model.entropy)
    return out.withColumn("rejected", low)
