"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; run() writes each
result as Parquet to the shared folder and reads it again as the next stage's docs, until that one is written.  All but the last
return the columns of documents as they came.  No stage drops a row for a null or repeated doc_id alone.  A null text is kept or rejected by its score as an empty text, is never
a near duplicate, matches no benchmark item, stays null, and packs as an empty document.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigraph.llm import decontaminate, jaccard_join, packing, pii, quality
from lexigraph.llm.common import bounded_batches, remove, staged, table

BATCH_ROWS = 256
KEY = "lexigraph.pii.key"  # the session's setting


def small_batches(spark: SparkSession) -> None:
    """The application's own setting: stages are worked out after they return, and an executor's memory holds few texts
    of a batch beside what JVM and workers need.  run() puts back what the session had."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    small_batches(spark)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), held_out)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates; rows that repeat both doc_id and
    text stay once.  Documents are told apart by doc_id and text, so different texts with one doc_id, or with
    none, are different documents.  A null doc_id comes after all others and equals other null ones; among equal ids
    the smallest hash stays."""
    row = F.xxhash64("doc_id", "text", F.col("doc_id").isNull())  # two documents share one with probability 2**-64
    found = jaccard_join.near_duplicates(docs.select(row.alias("row"), "text"), doc_id="row")
    # both sides grouped together instead of a join, in which repeated rows would meet each other
    none = F.lit(None).cast("long")
    both = found.select(F.col("doc_id").alias("row"), "component_id", none.alias("id")).unionByName(docs.select(row.alias("row"), none.alias("component_id"), F.col("doc_id").cast("long").alias("id")))
    rows = both.groupBy("row").agg(F.max("component_id").alias("component"), F.max("id").alias("id"), F.count("component_id").alias("n"))
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row", "n")).alias("first"))
    name = "__stays"
    while name in docs.columns:
        name += "_"
    stay = staged(first.select(F.col("first.row").alias(name), F.col("first.n").alias("n")), "stay")
    # the keys are the side that is built, so the texts are dealt by key once and not sorted
    kept = docs.join(stay.select(name).hint("shuffle_hash"), row == F.col(name), "left_semi")
    if stay.where("n > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even one with a few edits."""
    small_batches(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by pseudonyms under the session's key.  Whoever has the key can invert the
    pseudonyms, so there is no fixed one: where the session names none, it gets a random one, which equal values share until
    the application ends."""
    if not spark.conf.get(KEY, None):
        spark.conf.set(KEY, secrets.token_hex(32))
    return pii.pseudonymise(docs, spark.conf.get(KEY))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 2,048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]
ORACLE_SQL = None  # neither the classifier nor the tokenizer can be written in SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str, key: str | None = None) -> DataFrame:
    """All stages over the documents of a folder, under a key of pseudonyms if one is given, else the session's."""
    docs, before, own = spark.read.parquet(f"{sf_dir}/documents.parquet"), None, spark.conf.get(KEY, None)
    if key:
        spark.conf.set(KEY, key)
    try:
        with bounded_batches(spark, BATCH_ROWS):
            for name, stage in STAGES:
                docs = staged(stage(spark, docs, sf_dir), name)
                if before is not None:
                    remove(before)
                before = docs
    finally:
        if key:
            spark.conf.set(KEY, own) if own else spark.conf.unset(KEY)
    return docs
