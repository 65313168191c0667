"""Language models against a plain Kneser-Ney, and predictions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reelsim.llm import langid
from reelsim.llm.common import release, table
from reelsim.llm.queries import op11_langid
from reelsim.llm.words import text_bytes


def plain_symbols(text, letters):
    out = []
    for c in text:
        low = c.lower() if len(c.lower()) == 1 else c
        s = 0 if not c.isalpha() else letters.index(ord(low)) + 1 if ord(low) in letters else langid.OTHER
        if s or (out and out[-1]):
            out.append(s)
    return out


def plain_model(texts, letters):
    """``log p`` of the last symbol of a tuple, by counting tuples."""
    counts = Counter()
    for t in texts:
        s = [0, 0, 0, *plain_symbols(t, letters)]
        counts.update(tuple(s[i - 3:i + 1]) for i in range(3, len(s)))
    levels = []
    for _ in range(4):
        ones, twos = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        total, kinds = defaultdict(int), Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        levels.append((counts, ones / (ones + 2 * twos) if ones else 0.5, total, kinds))
        counts = Counter(g[1:] for g in counts)

    def p(gram, level):
        if level == 4:
            return 1 / 63
        counts, d, total, kinds = levels[level]
        lower = p(gram[1:], level + 1)
        if gram[:-1] not in total:
            return lower
        return (max(counts[gram] - d, 0) + d * kinds[gram[:-1]] * lower) / total[gram[:-1]] if gram in counts else \
            d * kinds[gram[:-1]] * lower / total[gram[:-1]]

    return lambda gram: math.log(p(gram, 0))


def test_model_is_kneser_ney():
    r = random.Random(2)
    texts = [" ".join("".join(r.choice("abcdeéÉB") for _ in range(r.randrange(1, 7))) for _ in range(r.randrange(30))) + r.choice(["", "!", " 12"])
             for _ in range(60)]
    letters = tuple(sorted(map(ord, "abcdé")))
    data, offs = text_bytes(pa.array(texts))
    code, n, found = langid.gram_codes(*langid.code_points(data, offs, 0, len(texts)), langid.symbol_table(letters))
    assert n.tolist() == [len(plain_symbols(t, letters)) for t in texts]
    assert found.tolist() == [sum(c.isalpha() for c in t) for t in texts]
    half = int(n[:40].sum())
    model = langid.KneserNey(*np.unique(code[:half], return_counts=True))
    want = plain_model(texts[:40], letters)
    grams = [tuple(int(c) >> langid.BITS * x & 63 for x in (3, 2, 1, 0)) for c in code]
    assert np.allclose(model.log_p(code), [want(g) for g in grams], rtol=1e-10)
    # a distribution: the symbols after a context sum to one
    for context in ((0, 0, 0), grams[5][1:], (9, 9, 9)):
        start = sum(s << langid.BITS * x for s, x in zip(context, (3, 2, 1)))
        assert np.exp(model.log_p(start + np.arange(63))).sum() == pytest.approx(1)


def test_predictions(spark):
    r = random.Random(1)
    words = {"xx": "kila moja watu hivyo nyumba kwa", "yy": "mõne suur kõik päev öö jõgi", "zz": "дом река ночь день вода лес"}
    rows = [(i, " ".join(r.choice(words[x].split()) for _ in range(r.randrange(3, 30))), x) for i in range(600) for x in [r.choice(list(words))]]
    rows += [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 !? 3", "zz"), (1003, "kwa", None), (None, "день", "zz"), (1004, "watu " * 20_000, "xx"),
             (1004, "watu " * 20_000, "xx"), (1005, "漢字 漢字", None), (1006, "ÖÖ JÕGI", None)]
    df = spark.createDataFrame([(*x, 0.5, "n") for x in rows], "doc_id long, text string, lang string, score double, best string").repartition(3)
    model = langid.fit(df)
    got = {x.doc_id: x for x in langid.predict(df, model).collect()}
    assert langid.predict(df, model).count() == len(rows)
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:600] if zlib.crc32(str(i).encode()) % 5 == 0)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (1000, 1001, 1002))
    assert got[1003].lang_pred == got[1004].lang_pred == "xx" and got[None].lang_pred == "zz" and got[1006].lang_pred == "yy"
    assert got[1005].lang_pred in words and got[1005].rejected                  # letters of no learned language
    assert all(0 <= x.score <= 1 for x in got.values()) and got[1004].score > 0.9 and not got[1004].rejected
    # held-out rows teach nothing
    other = df.withColumn("lang", langid.F.when(langid.fold() == 0, "xx").otherwise(langid.F.col("lang")))
    again = langid.predict(df, langid.fit(other))
    assert {x.doc_id: x.lang_pred for x in again.collect()} == {i: x.lang_pred for i, x in got.items()}
    release(spark)


def test_nothing_teaches(spark, no_documents):
    assert langid.fit(no_documents) is None
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(x.lang_pred, x.score, x.rejected) for x in langid.predict(df, langid.fit(df)).collect()] == [("und", 0.0, True)]
    one = spark.createDataFrame([(i, "nur eine", "de") for i in range(20)], "doc_id long, text string, lang string")
    assert {x.lang_pred for x in langid.predict(one, langid.fit(one)).collect()} == {"de"}
    release(spark)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op11_langid(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(x.lang == x.lang_pred for x in got) >= 0.98 * len(got) > 150
    release(spark)
