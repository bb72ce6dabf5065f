"""Shared plumbing of the training-data operators: staged tables, bounded batches, components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends there, and a lost
    executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/lexigraph/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def remove(*tables: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    for t in tables:
        folder = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.staged_at)
        folder.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def in_parts(batches: Iterable[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with at most so many rows and bytes of text, or a single row, so that however
    large the session's batches are, few texts are Python objects at a time."""
    for batch in batches:
        width = np.zeros(len(batch), dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
                width += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.cumsum(width), 0
        while at < len(batch):
            end = int(np.searchsorted(total, (total[at - 1] if at else 0) + size, side="right"))
            end = min(at + rows, max(at + 1, end))
            yield batch.slice(at, end - at)
            at = end


@contextmanager
def bounded_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs meanwhile; the session's own setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    if int(own) <= 0 or int(own) > rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of df's size; for a scan, from file sizes alone.  Where nothing is known, 1 GB."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 1 << 30


caches: dict[str, dict] = {}  # what functions keep in a worker from task to task, by kind


def lean_worker(keep: str = "") -> None:
    """Lets this Python worker give memory back between batches, which Arrow's own pools don't, and drops what other
    functions than those of kind `keep` have cached in it: a worker goes from task to task and stage to stage."""
    pa.set_memory_pool(pa.system_memory_pool())
    if caches.get(keep):
        return  # the next task of the same kind goes on with what is there
    for kind, held in caches.items():
        if kind != keep:
            held.clear()
    trim()


def trim() -> None:
    """Gives back what is free; glibc keeps it until asked."""
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release:
        release(0)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def components(edges: DataFrame, scratch: list[DataFrame], rounds: int = 60) -> DataFrame:
    """(node, root): smallest node reachable over undirected edges (u, v), by alternating large and
    small stars; each round is written to the shared folder, and the one before goes; the last, which the result reads, joins
    `scratch`.  Adaptive execution splits the
    rows of a star's centre in the joins.  Nodes without edges have no row."""
    spark = edges.sparkSession
    now = staged(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        last, now = now, staged(small, "edges")
        remove(last)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    else:
        raise RuntimeError("components did not settle")
    scratch.append(now)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
