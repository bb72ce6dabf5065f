"""A session with the settings the engine relies on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, partitions: int | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("lexigraph")
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    for k, v in (SETTINGS | {"spark.sql.shuffle.partitions": str(partitions or cores)} | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.  Where it is unset, one machine that is
    all there is takes a folder beside its warehouse; a cluster must name one."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/lexigraph-shared")
    return sc._jsc.sc().getCheckpointDir().get()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A driver table, its columns pruned at the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a frame's size; for a scan, from file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, most: int = 16 << 20) -> DataFrame:
    """df with a broadcast hint if its size is known to be at most `most` bytes; else as it is."""
    from pyspark.sql.functions import broadcast

    return broadcast(df) if plan_bytes(df) <= most else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: what several steps read is worked out once, and a lost
    executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/lexigraph/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
