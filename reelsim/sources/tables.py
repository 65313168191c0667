"""Readers for the provided parquet tables and the derived ``films`` view."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsim.sources.catalog_io import normalise

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def films(spark: SparkSession, sf_dir: str, normalised: bool = True) -> DataFrame:
    """Movie-shaped catalogue over ``documents`` and ``part``.

    Every tenth document (``doc_id % 10 = 9``) repeats the title of the row
    before it, half of those upper-cased; some descriptions, ratings and
    genres are missing; genres use all three separators.
    Schema: row_id, title, description, ratings, genre, expanded_genres
    (+ genre_src, the resolved genre column, when ``normalised``).
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    b = docs.withColumn("tid", F.col("doc_id") - F.when(F.col("doc_id") % 10 == 9, 1).otherwise(0))
    # part is the dimension side of a key join; AQE broadcasts it when small
    t = b.join(part, part.p_partkey == b.tid, "left")
    raw_title = F.concat(F.col("p_name"), F.lit(" "), F.col("tid").cast("string"), F.lit(" - "),
                         (F.lit(1950) + F.col("tid") % 70).cast("string"))
    did = F.col("doc_id")
    out = t.select(
        did.alias("row_id"),
        F.when(did % 20 == 19, F.upper(raw_title)).otherwise(raw_title).alias("title"),
        F.when(did % 50 == 48, F.lit(None).cast("string")).otherwise(F.col("text")).alias("description"),
        F.when(did % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice")).alias("ratings"),
        F.col("lang").alias("genre"),
        F.when(did % 17 == 0, F.lit(None).cast("string"))
         .when(did % 3 == 0, F.concat(F.col("lang"), F.lit(", "), F.col("source"), F.lit("|"), F.col("p_type")))
         .otherwise(F.concat(F.col("lang"), F.lit("/"), F.col("p_type"))).alias("expanded_genres"),
    )
    return normalise(out) if normalised else out
