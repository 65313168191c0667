"""Answer a stream of requests with Structured Streaming.

The source project answers one request per page interaction.  Here
requests arrive as rows of a streaming source (files landing in a
folder, a Kafka topic, ...); each micro-batch is answered as one batch
query against the fitted model and written once per epoch.

Request schema: ``request_id long, mode string ('title' | 'description'
| 'genre'), text string, genre_filter string``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelsim.plans.model import OUTPUT_COLUMNS, QID, Recommender

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("mode", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("genre_filter", T.StringType()),
])

RESULT_COLUMNS = ["request_id", "mode", "rank", "row_id", *OUTPUT_COLUMNS, "similarity_score"]


def answer_batch(rec: Recommender, requests: DataFrame, n: int = 5) -> DataFrame:
    """Answer a static batch of requests: one result table for all modes."""
    req = requests.select(F.col("request_id").alias(QID), "mode", "text", "genre_filter")
    by_t = rec.by_title(req.filter(F.col("mode") == "title"), n, filter_col="genre_filter")
    by_d = rec.by_description(req.filter(F.col("mode") == "description"), n,
                              filter_col="genre_filter")
    by_g = rec.by_genre(req.filter(F.col("mode") == "genre")
                           .select(QID, F.col("text").alias("genre")), n)
    by_g = by_g.withColumn("similarity_score", F.lit(None).cast("double"))

    def shape(df: DataFrame, mode: str) -> DataFrame:
        return df.select(F.col(QID).alias("request_id"), F.lit(mode).alias("mode"),
                         F.col("rank").cast("long").alias("rank"), "row_id", *OUTPUT_COLUMNS,
                         "similarity_score")

    return shape(by_t, "title").unionByName(shape(by_d, "description")).unionByName(shape(by_g, "genre"))


def serve(rec: Recommender, requests: DataFrame, output_path: str, checkpoint_location: str,
          n: int = 5, available_now: bool = True) -> StreamingQuery:
    """Start the serving query.  Each epoch's answers go to
    ``output_path/epoch=<id>`` with overwrite, so a retried epoch replaces
    its own output (idempotent sink); the checkpoint location records
    which input files each epoch consumed."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        out = answer_batch(rec, batch, n)
        out.write.mode("overwrite").parquet(os.path.join(output_path, f"epoch={epoch_id}"))
        rec.release()

    writer = (requests.writeStream.foreachBatch(handle)
                      .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def request_stream(spark, path: str, fmt: str = "json") -> DataFrame:
    """Streaming source of request files with a fixed schema."""
    return spark.readStream.schema(REQUEST_SCHEMA).format(fmt).load(path)
