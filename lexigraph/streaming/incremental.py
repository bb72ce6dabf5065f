"""Keyword postings kept up to date from a stream of new documents.

The batch engine rebuilds its index; for a growing corpus the same operators run on each
micro-batch, and the parts table is appended to.  Postings are made distinct on read, so a batch that
is written twice after a failure changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.text import tokens


def follow(stream: DataFrame, text: str, part: str, path: str, checkpoint: str, least: int = 4) -> StreamingQuery:
    """Appends (part, term) postings of a stream of documents under path/batch=N."""

    def write(batch: DataFrame, number: int) -> None:
        pairs = batch.select(F.col(part).alias("part"), F.explode(F.array_distinct(tokens(F.col(text), least, ()))).alias("term")).distinct()
        pairs.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_index(spark: SparkSession, path: str, most_parts: int = 2) -> DataFrame:
    pairs = spark.read.schema("part string, term string").parquet(path).select("part", "term").distinct()
    return pairs.groupBy("term").agg(F.array_sort(F.collect_set("part")).alias("parts")).where(F.size("parts") <= most_parts)
