"""Cross-tokenizer alignment against whole-text encoding and plain counting."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelsim.llm import alignment
from reelsim.llm.common import release
from reelsim.llm.queries import aligned_tokenizers


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    path_a, path_b = aligned_tokenizers()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    sym = alignment.byte_of_symbol()
    spell = {i: bytes(sym[c] for c in p) for p, i in a.get_vocab().items() if all(c in sym for c in p)}
    held, base = [], []
    for doc_id, text in rows:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        sx = [spell[i] for i in x]
        sy = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not text or b"".join(sx) != (" " + text).encode() or b"".join(sy) != (" " + text).encode():
            base.append((doc_id, 0, 0, 0, ""))
            held.append(Counter())
            continue
        ex, ey = np.cumsum([len(s) for s in sx]), np.cumsum([len(s) for s in sy])
        links, groups, gi, gj = Counter(), [], 0, 0
        for e in sorted({*ex.tolist(), *ey.tolist()}):
            i, j = int(np.searchsorted(ex, e)), int(np.searchsorted(ey, e))
            links[x[i], y[j]] += 1
            if ex[i] == ey[j] == e:
                groups.append(",".join(map(str, x[gi:i + 1])) + "|" + ",".join(map(str, y[gj:j + 1])))
                gi, gj = i + 1, j + 1
        held.append(links)
        base.append((doc_id, len(x), len(y), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count, top = Counter(p for h in held for p in h), defaultdict(int)
    for (i, _), n in count.items():
        top[i] = max(top[i], n)
    return [(d, na, nb, ng, sum(h.values()), sum(n for p, n in h.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in h.items()), sha)
            for (d, na, nb, ng, sha), h in zip(base, held)]


def texts():
    r = random.Random(3)
    bits = ["the", "of", "Straße", "été", "naïve", "1234", "3.14", "can't", "I'll", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "\n", "\n\n", "\t", "  ",
            "   ", " ", "　", " ", "\u0085", "日本語", "العربية", "😀", "👩‍👩‍👧", "é", " ", "x" * 70, "...", "!?", "##", "_", "ﬁ", "²", "İ", "\x00",
            "\x1c", "​", "ﷺ", "ǅ", "a_b", "-", "—", "“q”"]
    for _ in range(400):
        yield "".join(r.choice(bits) + r.choice(["", " ", " ", " ", "  ", "\n"]) for _ in range(r.randrange(1, 25)))
    for _ in range(200):
        yield "".join(chr(r.choice([r.randrange(32, 127), r.randrange(0, 0x250), r.randrange(0x1F00, 0x2100), r.randrange(0x3000, 0x3100), 32, 32]))
                      for _ in range(r.randrange(1, 60)))


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, monkeypatch, small):
    """``small``: many slices, several merge rounds and forgotten words."""
    if small:
        for name, value in (("SLICE", 200), ("FAN", 3), ("BLOCK", 50), ("CACHE_LINKS", 500), ("WORK_BYTES", 700)):
            monkeypatch.setattr(alignment, name, value)
    rows = [*enumerate(texts()), (5000, None), (5001, ""), (5002, " "), (5003, "   "), (5004, "has ▁ mark"), (5005, "a▁b"), (None, "no id"),
            (5006, "again again"), (5006, "again again"), (5007, "word " * 3000 + "end"), (5008, "z" * 5000)]
    df = spark.createDataFrame([(*x, "k", 7) for x in rows], "doc_id long, text string, slice string, n_a int").repartition(3)
    got = alignment.align(df, *aligned_tokenizers()).collect()
    release(spark)
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)


def test_empty_table(spark, no_documents):
    assert alignment.align(no_documents, *aligned_tokenizers()).count() == 0
    release(spark)
