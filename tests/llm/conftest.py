import random

import pytest

LONG = " ".join(f"w{i % 977}x{i}" for i in range(3000))


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]) + str(r.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, copies, near copies, shared passages, and
    extra columns named like outputs."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \t\n "), (7, "one two"), (8, "ONE two"),
            (9, LONG), (10, prose(3, 40) + "\n" + passage + " " + prose(4, 30)), (11, prose(5, 50) + " " + passage.replace(" ", "  ")),
            (12, "a " * 200), (13, prose(6, 34)), (14, prose(6, 35)), (15, prose(6, 35) + " tail"), (16, "É ß 'tis “x” 12,5 <b>hi</b>!"),
            (17, prose(1, 120) + " and more words at the end of it")]
    rows += [(100 + i, prose(100 + i, 20 + 7 * i % 90)) for i in range(30)]
    data = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", None if t is None else len(t), 1.0, "x", 7, "y", 3) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score double, "
                                       "size string, n_words int, sig string, block int").repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
