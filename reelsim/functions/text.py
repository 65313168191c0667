"""Text column expressions: cleaning, stop words, n-grams, word counts.

All functions return ``Column`` expressions evaluated JVM-side.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import lru_cache
from importlib.resources import files

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=None)
def spark_english_stop_words() -> tuple[str, ...]:
    """The English stop-word list of Spark ML, kept as a text resource of
    this package (fixed values), so neither a jar nor a JVM is needed."""
    text = files("reelsim.functions").joinpath("stopwords_english.txt").read_text("utf-8")
    return tuple(w for w in text.splitlines() if w and not w.startswith("#"))


@lru_cache(maxsize=None)
def default_stop_words() -> tuple[str, ...]:
    """Default stop words: Spark's English list plus the letter runs its
    entries split into.

    Cleaning turns every non-letter into a blank before the stop-word test,
    so ``don't`` reaches the test as ``don`` and ``t``; the fragments of
    listed words are therefore stop words too (181 + 21 = 202 entries).
    """
    base = spark_english_stop_words()
    out, seen = list(base), set(base)
    for w in base:
        for frag in re.findall("[a-z]+", w):
            if frag not in seen:
                seen.add(frag)
                out.append(frag)
    return tuple(out)


def word_tokens(text: str | Column) -> Column:
    """Lower-case, keep runs of ``a-z`` only; null or blank text -> [].

    Equal to: lower, replace ``[^a-z\\s]`` by blank, squeeze blanks, split.
    """
    col = F.col(text) if isinstance(text, str) else text
    toks = F.regexp_extract_all(F.lower(col), F.lit("[a-z]+"), 0)
    return F.coalesce(toks, F.array().cast("array<string>"))


def clean_tokens(text: str | Column,
                 stop_words: Sequence[str] | None = None,
                 min_len: int = 3,
                 lexicon: Mapping[str, str] | None = None) -> Column:
    """Cleaned token array of a description.

    Tokens shorter than ``min_len`` and stop words are dropped *before*
    lemmatising, so a lemma may be shorter than ``min_len``.  ``lexicon``
    maps a form to its lemma (a small literal map; larger lexicons go
    through :func:`reelsim.operators.lemma.lemmatise_with_table`).
    """
    stops = list(default_stop_words() if stop_words is None else stop_words)
    toks = word_tokens(text)

    def keep(w: Column) -> Column:
        cond = F.length(w) >= min_len
        if stops:
            # more than 10 literals -> Catalyst turns this into a hash InSet
            cond = cond & ~w.isin(*stops)
        return cond

    toks = F.filter(toks, keep)
    if lexicon:
        lex = F.create_map(*[F.lit(x) for kv in sorted(lexicon.items()) for x in kv])
        toks = F.transform(toks, lambda w: F.coalesce(F.try_element_at(lex, w), w))
    return toks


def clean_text(text: str | Column, **kw) -> Column:
    """Cleaned description as one blank-joined string (F2)."""
    return F.array_join(clean_tokens(text, **kw), " ")


def raw_tokens(text: str | Column) -> Column:
    """Tokens of the raw-text vectorizer (V3b): lower-cased runs of two or
    more word characters (letters, digits, underscore), stop words kept."""
    col = F.col(text) if isinstance(text, str) else text
    toks = F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)
    return F.coalesce(toks, F.array().cast("array<string>"))


def bigrams(tokens: str | Column) -> Column:
    """Adjacent token pairs joined by one blank; [] for fewer than 2 tokens."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    # zip the array with itself shifted by one; the lambda sees only its
    # two arguments, so the token array is evaluated once per row
    k = F.greatest(F.size(t) - 1, F.lit(0))
    return F.zip_with(F.slice(t, 1, k), F.slice(t, 2, k),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def uni_bi_grams(tokens: str | Column) -> Column:
    """Unigrams followed by bigrams (V1), formed after stop-word removal."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.concat(t, bigrams(t))


def word_count(text: str | Column) -> Column:
    """Number of whitespace-separated words; null stays null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.when(col.isNotNull(), F.size(F.regexp_extract_all(col, F.lit(r"(?U)\S+"), 0)))


def strip(col: str | Column) -> Column:
    """Remove leading/trailing whitespace of any kind (Python ``str.strip``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
