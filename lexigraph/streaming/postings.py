"""Keyword postings that follow changes: records are added, changed and removed, and the index stays that of a full rebuild.

A posting (part, term) counts the records of the part that hold the term.  A batch of changes is joined with the records that it
names: their old terms count -1, the new ones +1, so a term whose last record goes leaves the part, and one that had too many parts comes back under
the cap.  Batches are numbered folders of signed counts and of record versions; nothing that stands is rewritten.  compact() sums them
up into a base.  A batch that is written again after a failure takes the place of its first try, and reads only batches before it, so replays change
nothing; a base counts once its write has succeeded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.text import tokens

RECORD = "key string, part string, terms array<string>"
POSTING = "part string, term string, n long"


def _folders(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    done = [s.getPath() for s in files.listStatus(folder)]
    return [p.getName() for p in done if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def _read(spark: SparkSession, path: str, kind: str, schema: str, before: int | None = None) -> DataFrame:
    """(number, columns) of the newest base and the batches after it; with `before`, of batches under that number."""
    found = [(n.split("=")[0], int(n.split("=")[1])) for n in _folders(spark, f"{path}/{kind}")]
    fits = [(k, n) for k, n in found if before is None or n < before]
    base = max((n for k, n in fits if k == "base"), default=None)
    names = [f"{path}/{kind}/{k}={n}" for k, n in fits if k == "base" and n == base or k == "batch" and (base is None or n > base)]
    if not names:
        return spark.createDataFrame([], f"number long, {schema}")
    number = F.regexp_extract(F.col("_metadata.file_path"), rf"/{kind}/(?:base|batch)=(\d+)/", 1).cast("long")
    return spark.read.schema(schema).parquet(*names).select(number.alias("number"), "*")


def records(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(key, part, terms): the newest version of each record that isn't removed."""
    newest = _read(spark, path, "records", RECORD, before).groupBy("key").agg(F.max_by(F.struct("part", "terms"), "number").alias("r"))
    return newest.where("r.part is not null").select("key", "r.part", "r.terms")


def postings(spark: SparkSession, path: str) -> DataFrame:
    """(part, term, n): how many records of a part hold a term."""
    return _read(spark, path, "postings", POSTING).groupBy("part", "term").agg(F.sum("n").alias("n")).where("n <> 0")


def current_index(spark: SparkSession, path: str, most_parts: int = 2) -> DataFrame:
    """(term, parts), as index.inverted_index gives from all records."""
    return postings(spark, path).groupBy("term").agg(F.array_sort(F.collect_set("part")).alias("parts")).where(F.size("parts") <= most_parts)


def apply(spark: SparkSession, path: str, number: int, changes: DataFrame, least: int = 4) -> None:
    """Batch `number` of changes (key, part, text, version): of several to a key the largest version counts; a null text removes the
    record."""
    last = changes.groupBy(F.col("key").cast("string").alias("key")).agg(F.max_by(F.struct("part", "text"), "version").alias("c"))
    terms = F.when(F.col("c.text").isNotNull(), F.array_distinct(tokens(F.col("c.text"), least, ())))
    last = last.select("key", F.when(terms.isNotNull(), F.col("c.part")).alias("part"), terms.alias("terms"))
    last.write.mode("overwrite").parquet(f"{path}/records/batch={number}")
    last = spark.read.schema(RECORD).parquet(f"{path}/records/batch={number}")
    old = records(spark, path, number).join(last.select("key"), "key", "left_semi")
    signed = lambda df, n: df.where("part is not null").select("part", F.explode("terms").alias("term"), F.lit(n).cast("long").alias("n"))
    moved = signed(last, 1).unionByName(signed(old, -1)).groupBy("part", "term").agg(F.sum("n").alias("n")).where("n <> 0")
    moved.write.mode("overwrite").parquet(f"{path}/postings/batch={number}")


def compact(spark: SparkSession, path: str) -> None:
    """Sums all batches up into a base, which later reads start from."""
    for kind, schema, whole in (("postings", POSTING, postings), ("records", RECORD, records)):
        numbers = [int(n.split("=")[1]) for n in _folders(spark, f"{path}/{kind}")]
        if numbers:
            whole(spark, path).write.mode("overwrite").parquet(f"{path}/{kind}/base={max(numbers)}")


def follow(stream: DataFrame, path: str, checkpoint: str, least: int = 4) -> StreamingQuery:
    """Keeps the postings under path up with a stream of changes (key, part, text, version)."""
    return stream.writeStream.foreachBatch(lambda batch, number: apply(batch.sparkSession, path, number, batch, least)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
