"""A training-data pipeline over ``documents`` from the operators in
``reelsim.llm``.

``STAGES`` names the stages; each is ``(spark, docs, sf_dir) -> DataFrame``
and gets what its predecessor kept, written as Parquet and read again.  All
but the last return the columns of ``documents``; columns beyond those are
dropped.  Near-duplicate work takes five words and a similarity of 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsim.llm import jaccard, mixing, packing, quality, superkmer
from reelsim.llm.common import drop, forget, store, stored, table
from reelsim.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the ranking rejects go."""
    ranker = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.predictions(quality.score(docs, ranker, COLUMNS))
    return scored.filter("predicted = 1").select(*COLUMNS) if ranker else docs.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one row of each group stays, the one with the smallest
    doc_id.  Groups are formed of rows, so rows that repeat a doc_id and rows
    without one (which come last in the order) are grouped by their texts like
    any other: if there are such rows, the table is stored once more with a
    number for every row; otherwise the doc_id is that number.  Rows without
    words link with nothing; of those that repeat a doc_id one stays."""
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("doc_id").isNull() | (F.col("rows") > 1))
    if shared.isEmpty():
        groups = jaccard.similar_groups(docs.select("doc_id", "text"), 5, 80, 100)
        gone = store(groups.filter("component_id != doc_id").select("doc_id"), "gone")
        return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)
    rows = store(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = jaccard.similar_groups(rows.select(F.col("_row").alias("doc_id"), "text"), 5, 80, 100)
    groups = groups.select(F.col("doc_id").alias("_row"), "n_shingles", "component_id")
    named = store(groups.join(rows.select("_row", "doc_id"), "_row"), "groups")
    wordless = F.col("n_shingles") == 0
    first = (named.groupBy(F.when(~wordless, F.col("component_id")).alias("group"), F.when(wordless, F.col("doc_id")).alias("id"),
                           F.when(wordless & F.col("doc_id").isNull(), F.col("_row")).alias("row"))
                  .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")))
    gone = store(named.join(first.select("first._row"), "_row", "left_anti").select("_row"), "gone")
    drop(named)
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: words of repeated passages go; texts that lose nothing
    stay as they are, and documents of which nothing is left go."""
    keep = tuple(c for c in COLUMNS if c != "text")
    cut = superkmer.remove_repeats(docs.withColumn("_text", F.col("text")), keep=(*keep, "_text"))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("_text"))
    left = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).withColumn("text", text)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.select("doc_id", "text", "lang", "source", n_chars.alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents of small sources come again, up to the
    repetition limit; every document comes at least once."""
    measured = mixing.measure(docs.select(*COLUMNS))
    slim = store(measured.select("doc_id", "source", "tokens"), "measured")
    return mixing.realise(measured, mixing.mixture(slim)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: pieces of documents in sequences of 4096 ids at most."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", classify), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("mixing", mix), ("packing", pack)]

# the quality model, hash permutations and tokenizer ids are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = stored(spark)
        out = store(stage(spark, docs, sf_dir), name)
        # what this stage stored for itself goes, and so does its input
        forget(spark, [p for p in stored(spark) if p not in before or p == getattr(docs, "_stored_path", None)], keep=out)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
