"""Model store: Parquet tables instead of pickles.

Layout under ``path``: catalog/, vocabulary/, postings/, model_meta/.
``postings`` has a folder per band of document frequency and level of weight
(see ``operators.impact``), and is sorted by term within them so Parquet
min/max statistics let a term filter skip row groups.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

TABLES = ("catalog", "vocabulary", "postings", "model_meta")


def save_model(rec, path: str) -> str:
    from dataclasses import asdict
    cat = rec.catalog.drop("tokens") if "tokens" in rec.catalog.columns else rec.catalog
    cat.write.mode("overwrite").parquet(os.path.join(path, "catalog"))
    rec.model.vocabulary.write.mode("overwrite").parquet(os.path.join(path, "vocabulary"))
    (rec.blocks.sortWithinPartitions("band", "level", "term")
        .write.mode("overwrite").partitionBy("band", "level").parquet(os.path.join(path, "postings")))
    params = asdict(rec.params)
    params["text"]["stop_words"] = list(params["text"]["stop_words"]) if params["text"]["stop_words"] else None
    params |= {"use_idf": rec.model.use_idf, "norm": rec.model.norm}
    # one row whatever the vocabulary holds
    meta = rec.catalog.sparkSession.range(1).select(
        rec.model.n_docs.alias("n_docs"), F.lit(json.dumps(params)).alias("params"),
        F.lit(rec.model.sublinear_tf).alias("sublinear_tf"))
    meta.write.mode("overwrite").parquet(os.path.join(path, "model_meta"))
    return path


def model_exists(spark: SparkSession, path: str) -> bool:
    """True when every model table can be read (S9 existence check)."""
    try:
        for t in TABLES:
            spark.read.parquet(os.path.join(path, t)).schema
        return True
    except AnalysisException:
        return False


def load_model(spark: SparkSession, path: str):
    from reelsim.operators.tfidf import TfidfModel
    from reelsim.plans.model import ModelParams, Recommender
    from reelsim.plans.prepare import TextParams

    if not model_exists(spark, path):
        raise FileNotFoundError(f"Artifact not found: {path}")
    rd = lambda t: spark.read.parquet(os.path.join(path, t))
    meta = rd("model_meta")
    p = json.loads(meta.select("params").first()[0])
    text = TextParams(**p.pop("text"))
    weights = {k: p.pop(k, True) for k in ("use_idf", "norm")}
    params = ModelParams(text=text, **p)
    model = TfidfModel(rd("vocabulary"), rd("postings"), meta.select("n_docs").scalar(),
                       sublinear_tf=params.sublinear_tf,
                       **weights)
    rec = Recommender(rd("catalog"), model, params)
    rec._stored = True                # what it derives on first use is stored too
    return rec
