"""Lemma lookup through a lexicon table.

For a lexicon too large for a literal map (``clean_tokens(lexicon=...)``).
The forms that change are sent to every task if they are few enough, and
documents are rewritten where they are read.  Otherwise, and for rows that
share an id, tokens are exploded with their positions, joined with
``lexicon(form, lemma)`` and put back in order per id; Spark splits hot forms.

:func:`noun_lemmas` makes such a lexicon from a table of known lemmas by
detaching noun endings, for the distinct forms of a corpus.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsim.operators.counting import SENT_WORDS, repeated_ids
from reelsim.session import bounded_tasks, store_table

# executors need no copy of the package for the function below
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The noun endings of the public WordNet morphology and what
# takes their place.
NOUN_ENDINGS = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))


def lemmatise_with_table(df: DataFrame, lexicon: DataFrame, tokens_col: str = "tokens",
                         id_col: str = "row_id") -> DataFrame:
    """Replace every token by its lemma (forms not in the lexicon stay)."""
    lex = lexicon.groupBy("form").agg(F.min("lemma").alias("lemma"))   # one lemma per form
    lex = store_table(lex.filter("form is not null and lemma != form"), "lexicon")
    out = df.select(id_col, *[c for c in df.columns if c not in (id_col, tokens_col)], tokens_col)
    if lex.limit(SENT_WORDS + 1).count() > SENT_WORDS:
        return _by_position(out, lex, tokens_col, id_col)
    repeated = repeated_ids(df.select(id_col), id_col)
    if repeated.isEmpty():
        return _by_row(out, lex, tokens_col)
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    return _by_row(out.join(repeated, same, "left_anti"), lex, tokens_col).unionByName(
        _by_position(out.join(repeated, same, "left_semi"), lex, tokens_col, id_col))


def _by_row(df: DataFrame, lex: DataFrame, tokens_col: str) -> DataFrame:
    """``df``, whose last column is ``tokens_col``, with at most ``SENT_WORDS``
    forms of ``lex`` replaced."""
    held = lex.toArrow()
    forms, lemmas = (held[c].combine_chunks().cast(pa.string()) for c in ("form", "lemma"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b.column(b.num_columns - 1)
            flat, n = tokens.flatten(), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            made = pc.coalesce(lemmas.take(pc.index_in(flat, forms, skip_nulls=True)), flat) if len(forms) else flat
            ends = pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(ends, made)], b.schema.names)

    return df.mapInArrow(work, df.schema)


def _by_position(df: DataFrame, lex: DataFrame, tokens_col: str, id_col: str) -> DataFrame:
    ex = df.select(id_col, F.posexplode(tokens_col).alias("_pos", "form"))
    mapped = ex.join(lex, "form", "left").select(
        id_col, "_pos", F.coalesce(F.col("lemma"), F.col("form")).alias("_tok"))
    back = (mapped.groupBy(id_col)
                  .agg(F.sort_array(F.collect_list(F.struct("_pos", "_tok"))).alias("_p"))
                  .select(id_col, F.transform("_p", lambda s: s["_tok"]).alias(tokens_col)))
    out = df.drop(tokens_col).join(back, id_col, "left")
    return out.withColumn(tokens_col, F.coalesce(F.col(tokens_col), F.array().cast("array<string>")))


def detached(form: Column) -> Column:
    """The forms that taking off one noun ending gives, shortest ending
    first; [] if none fits."""
    forms = [F.when(form.endswith(a), F.concat(F.left(form, F.length(form) - len(a)), F.lit(b))) for a, b in NOUN_ENDINGS]
    return F.array_compact(F.array(*forms))


def noun_lemmas(forms: DataFrame, lemmas: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``(form, lemma)`` for those of ``forms(form)`` that have a lemma.

    ``lemmas(lemma)`` are the known words, ``exceptions(form, lemma)`` the
    irregular ones.  A listed form takes the shortest known word among itself
    and its entries.  Any other takes the shortest known word among itself
    and what detaching one ending gives; if there is none, endings are
    detached again until something is known or nothing fits (ties: smaller
    text).  Forms without a known word have no row and stay as they are.
    The work goes over distinct forms, and rounds over those still unknown;
    each table that a round reads again is stored.
    """
    with bounded_tasks(forms.sparkSession):
        known = store_table(lemmas.select(F.col("lemma").alias("_known")).filter("_known != ''").distinct(), "lemma_known")
        forms = store_table(forms.select("form").filter(F.col("form").isNotNull()).distinct(), "lemma_distinct")
    none = F.array().cast("array<string>")
    if exceptions is None:
        left = forms.withColumn("listed", none)
    else:
        entries = exceptions.filter("form is not null and lemma is not null").groupBy("form").agg(F.collect_set("lemma").alias("listed"))
        left = forms.join(entries, "form", "left").withColumn("listed", F.coalesce("listed", none))
    irregular = F.size("listed") > 0
    # first itself and one step; then one step more at a time
    todo = left.select("form", F.when(irregular, none).otherwise(detached(F.col("form"))).alias("next"), "listed")
    todo = todo.withColumn("try", F.concat(F.array("form"), "listed", "next")).select("form", "next", "try")
    found = []
    while True:
        tried = todo.select("form", F.explode("try").alias("_try")).join(known, F.col("_try") == F.col("_known"))
        best = tried.groupBy("form").agg(F.min(F.struct(F.length("_try").alias("n"), F.col("_try").alias("lemma"))).alias("b"))
        best = store_table(best.select("form", "b.lemma"), "lemma_found")
        found.append(best)
        todo = todo.join(best.select("form"), "form", "left_anti")
        step = F.array_distinct(F.flatten(F.transform("next", detached)))
        todo = todo.select("form", step.alias("next")).filter(F.size("next") > 0).withColumn("try", F.col("next"))
        todo = store_table(todo, "lemma_forms")
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, found)


def lemmatise_nouns(df: DataFrame, lemmas: DataFrame, exceptions: DataFrame | None = None, tokens_col: str = "tokens",
                    id_col: str = "row_id") -> DataFrame:
    """Replace every token by its noun lemma (see :func:`noun_lemmas`)."""
    forms = df.select(F.explode(tokens_col).alias("form"))
    return lemmatise_with_table(df, noun_lemmas(forms, lemmas, exceptions), tokens_col, id_col)
