import os
import random

import pytest
from pyspark.sql import functions as F

from lexigraph.sources import docs, paged
from lexigraph.sources.publish import FolderWriter, publish


def service(counter):
    """25 hits a page; a hit of each page comes again on the next; every page fails once."""

    def fetch(page):
        first = f"{counter}/{page}"
        if not os.path.exists(first):
            open(first, "w").close()
            raise OSError("busy")
        if page > 120:
            return []
        return [{"key": 25 * page + i, "name": f"n{page}.{i}"} for i in range(25)] + [{"key": 25 * (page + 1), "name": "late"}] * (page < 120)

    return fetch


def test_pages_are_partitions(spark, tmp_path):
    source = paged.paged_source("test_pages", service(str(tmp_path)), 130, per_partition=7, wait=0.0)
    rows = paged.hits(spark, source)
    assert rows.rdd.getNumPartitions() == 19
    got = paged.once(rows, "key").select("key", "page", F.get_json_object("hit", "$.name").alias("name")).collect()
    assert len(got) == 3000 and all(r.name == ("late" if int(r.key) % 25 == 0 and int(r.key) > 25 else f"n{int(r.key) // 25}.{int(r.key) % 25}") for r in got)


def test_a_page_that_never_comes(spark, tmp_path):
    def fetch(page):
        raise OSError("gone")

    with pytest.raises(Exception, match="gone"):
        paged.hits(spark, paged.paged_source("test_gone", fetch, 3, retries=1, wait=0.0)).count()


def test_a_stream_goes_on_at_its_page(spark, tmp_path):
    (tmp_path / "last").write_text("3")
    last = str(tmp_path / "last")
    source = paged.paged_source("test_stream", lambda page: [{"key": page}], lambda: int(open(last).read()))
    spark.dataSource.register(source)
    for end in (3, 3, 8):
        (tmp_path / "last").write_text(str(end))
        stream = spark.readStream.format("test_stream").load().writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/at").trigger(once=True)
        stream.start(f"{tmp_path}/out").awaitTermination()
    assert sorted(r.page for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(1, 9))


def test_many_files_are_published_at_once(spark, tmp_path):
    rows = spark.range(10_000).select(F.concat(F.col("id") % 7, F.lit("/ü "), "id", F.lit(".txt")).alias("file"), F.col("id").cast("string").alias("value"))
    publish(rows, f"file://{tmp_path}/out")
    assert sum(len(f) for _, _, f in os.walk(tmp_path / "out")) == 10_000 and (tmp_path / "out/3/ü 10.txt").read_text() == "10\n"
    publish(rows.where("id < 3"), f"file://{tmp_path}/out")
    assert sum(len(f) for _, _, f in os.walk(tmp_path / "out")) == 3 and os.listdir(tmp_path) == ["out"]


def test_a_failed_write_leaves_what_was(spark, tmp_path):
    good = spark.createDataFrame([("a", "1")], "file string, value string")
    publish(good, f"file://{tmp_path}/out")
    bad = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("file"), F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("string")).otherwise("x").alias("value"))
    with pytest.raises(Exception, match="broken"):
        publish(bad, f"file://{tmp_path}/out")
    with pytest.raises(ValueError, match="one name"):
        publish(good.unionAll(good), f"file://{tmp_path}/out")
    assert os.listdir(tmp_path) == ["out"] and os.listdir(tmp_path / "out") == ["a"]
    publish(spark.createDataFrame([("b", b"\x00\xff")], "file string, value binary").where("file = 'c'"), f"file://{tmp_path}/none")
    assert os.listdir(tmp_path / "none") == []


def test_conversions_are_made_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    at = str(calls)

    def text_of(content):
        open(f"{at}/{random.random()}", "w").close()
        return None if content == b"bad" else content.decode().upper()

    root = tmp_path / "docs"
    (root / "mathematik").mkdir(parents=True)
    for name, content in (("a.pdf", b"one"), ("b.pdf", b"one"), ("c.pdf", b"two"), ("bad.pdf", b"bad"), ("n.md", b"native")):
        (root / "mathematik" / name).write_bytes(content)
    scan = lambda: {r.pfad: r.text for r in docs.scan(spark, f"file://{root}", extractors={"pdf": (text_of,)}, store=f"file://{tmp_path}/store").collect()}
    want = {"mathematik/a.pdf": "ONE", "mathematik/b.pdf": "ONE", "mathematik/c.pdf": "TWO", "mathematik/bad.pdf": None, "mathematik/n.md": "native"}
    assert scan() == want and len(os.listdir(calls)) == 3  # once for each content
    assert scan() == want and len(os.listdir(calls)) == 3  # and never again
    (root / "mathematik" / "c.pdf").write_bytes(b"three")
    assert scan() == want | {"mathematik/c.pdf": "THREE"} and len(os.listdir(calls)) == 4
    cache = spark.createDataFrame([("mathematik/c.pdf", "cached")], "pfad string, cached string").withColumn("cache_mtime", F.current_timestamp())
    got = {r.pfad: r.text for r in docs.scan(spark, f"file://{root}", cache, {"pdf": (text_of,)}).collect()}
    assert got["mathematik/c.pdf"] == "cached" and len(os.listdir(calls)) == 7  # the other three contents' files alone


def test_rows_are_worked_out_once(spark, tmp_path, counted):
    same, seen = counted
    publish(spark.range(50).select(same(F.col("id").cast("string")).alias("file"), F.lit("x").alias("value")), f"file://{tmp_path}/out")
    assert seen() == 50 and len(os.listdir(tmp_path / "out")) == 50


def test_a_late_task_leaves_nothing(spark, tmp_path):
    writer = FolderWriter(f"file://{tmp_path}/out")
    writer.abort([])
    for name in ("a", "b/c"):
        with pytest.raises(OSError):
            writer.write(iter([(name, b"x")]))
    assert os.listdir(tmp_path) == []
    with pytest.raises(Exception):  # a value that no file can take fails the write itself
        publish(spark.createDataFrame([("a/b/c", "1"), ("d", None)], "file string, value string").repartition(2), f"file://{tmp_path}/out")
    assert os.listdir(tmp_path) == []
