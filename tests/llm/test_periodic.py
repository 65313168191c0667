"""Periodic runs against a brute-force scan of every lag."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from reelsim.llm import periodic

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words, least=24, times=3):
    n, runs = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            smaller = any(all(words[x] == words[x + p] for x in range(s, e - p)) for p in range(1, q))
            if e - s >= max(least, times * q) and not smaller:
                runs.append((s, e - s, q))
            i = j
    return sorted(runs, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant):
    ws = WORD.findall(text or "")
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(ws)
    gone = {x for s, m, q in runs for x in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def odd_texts():
    r = random.Random(5)
    for i in range(300):
        n = r.randrange(160)
        if i % 5 == 0:                                    # two words: runs inside runs
            t = [r.choice("ab") for _ in range(n)]
        elif i % 5 == 1:                                  # neighbouring runs of many periods
            t = []
            while len(t) < n:
                p = [r.choice("abcd") for _ in range(r.randrange(1, 12))]
                t += (p * r.randrange(1, 14))[:r.randrange(1, 60)]
        elif i % 5 == 2:                                  # words at the frequency border
            t = [str(r.randrange(40)) for _ in range(n)]
        elif i % 5 == 3:                                  # Fibonacci words: almost periodic
            a, t = ["a"], ["a", "b"]
            for _ in range(r.randrange(3, 9)):
                a, t = t, t + a
            t = t * r.randrange(1, 4)
        else:                                             # a period that repeats a word
            t = [f"u{r.randrange(9)}" for _ in range(r.randrange(20))]
            t += (["x"] * r.randrange(1, 9) + ["é"]) * r.randrange(1, 12) + ["z"] * r.randrange(40)
        yield (None if i % 17 == 0 else i, None if i % 29 == 0 else r.choice([" ", "\n", "  \t"]).join(t))


@pytest.mark.parametrize("plant", [True, False])
def test_runs(spark, plant):
    rows = [*odd_texts(), (1000, ""), (1001, " \n"), (1001, " \n"), (1002, "a " * 23), (1003, "a " * 24), (1004, "a b c d e f g h i " * 3),
            (1005, "a b c d e f g h i " * 3), (1005, "a b c d e f g h i " * 3)]
    df = spark.createDataFrame([(*x, 1, "y") for x in rows], "doc_id long, text string, start int, period string").repartition(3)
    got = sorted(map(tuple, periodic.find_runs(df, plant).collect()), key=repr)
    assert got == sorted([brute(*x, plant) for x in rows], key=repr)
    assert sum(x[1] for x in got) > 200


def test_very_long_run_and_empty_table(spark, no_documents):
    long = "q " + "a b b a b c " * 20_000
    got = periodic.find_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert (got.n_runs, got.start, got.length, got.period) == (1, 1, 120_000, 6)
    assert got.collapsed_sha256 == hashlib.sha256(b"q a b b a b c").hexdigest()
    assert periodic.find_runs(no_documents).count() == 0
