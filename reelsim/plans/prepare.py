"""Catalogue preparation: null drop, title de-dupe, cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reelsim.functions.text import clean_tokens
from reelsim.functions.titles import name_only, title_key
from reelsim.operators.dedupe import keep_first


@dataclass
class TextParams:
    stop_words: Sequence[str] | None = None   # None -> default list (202 words)
    min_len: int = 3                           # tokens of length <= 2 dropped
    lexicon: Mapping[str, str] | None = None   # form -> lemma; None: no lemmas


def with_title_keys(df: DataFrame) -> DataFrame:
    return (df.withColumn("title_key", title_key(F.col("title")))
              .withColumn("name_only", name_only(F.col("title_key"))))


def with_tokens(df: DataFrame, text: TextParams | None = None,
                text_col: str = "description") -> DataFrame:
    """Add the cleaned ``tokens`` column (F2)."""
    text = text or TextParams()
    return df.withColumn("tokens", clean_tokens(F.col(text_col), stop_words=text.stop_words,
                                                min_len=text.min_len, lexicon=text.lexicon))


def drop_blank(df: DataFrame) -> DataFrame:
    """Drop rows left without tokens; add ``clean_description``."""
    return (df.filter(F.size("tokens") > 0)
              .withColumn("clean_description", F.array_join("tokens", " ")))


def clean(df: DataFrame, text: TextParams | None = None, text_col: str = "description") -> DataFrame:
    """Add ``tokens`` and ``clean_description``; drop rows left blank."""
    return drop_blank(with_tokens(df, text, text_col))


def prepare_catalog(films: DataFrame, text: TextParams | None = None,
                    dedupe: bool = True, seen: Observation | None = None) -> DataFrame:
    """Normalised films -> catalogue.

    Steps: drop null descriptions (F1); first row per exact title (W2,
    which subsumes the (title, description) de-dupe W1); clean text and
    drop rows without tokens (F2, F3); title keys (X2, X3).
    ``dedupe=False`` gives the notebook catalogue (cleaning only).
    ``seen`` observes, when the catalogue is written, the rows that are left
    after the de-dupe and how many of them keep a token (A19).
    """
    if seen is None:
        # tokens are a column before the de-dupe: the blank-row filter after it
        # then tests that column instead of re-running the cleaning (filters
        # are pushed below the semi-join)
        df = with_tokens(films, text)
        if dedupe:
            df = keep_first(df.filter(F.col("description").isNotNull()), ["title"])
    else:
        # no filter is pushed below an observation, so the tokens need not
        # pass the de-dupe; nor do the texts, as long as its ids can be sent
        df = keep_first(films.filter(F.col("description").isNotNull()), ["title"], stored=True) if dedupe else films
        df = with_tokens(df, text)
        df = df.observe(seen, F.count(F.lit(1)).alias("deduped"), F.sum((F.size("tokens") > 0).cast("long")).alias("kept"))
    return with_title_keys(drop_blank(df))


def lineage(films: DataFrame, deduped: int, kept: int) -> DataFrame:
    """Rows dropped and kept per preparation step, one row (A19).  The counts
    after the de-dupe were observed while the catalogue was written; what is
    left is one aggregate over the source."""
    src = films.agg(F.count(F.lit(1)).alias("n0"), F.count("description").alias("n1"))
    n0, n1, n2, n3 = F.col("n0"), F.col("n1"), F.lit(deduped), F.lit(kept)
    return src.select(
        n0.alias("rows_raw"),
        (n0 - n1).alias("dropped_null_description"),
        (n1 - n2).alias("dropped_duplicates"),
        (n2 - n3).alias("dropped_blank_text"),
        n3.alias("rows_retained"),
    )
