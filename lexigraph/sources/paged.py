"""A paged service as a Spark source: pages are input partitions, read by the executors, in batches or as a stream.

A page is fetched by a function page -> list of hits (objects), so that any transport serves; attempts are repeated after
a growing wait.  The number of pages comes from the caller, or from a function that asks the service once.  Rows are
(page, pos, hit), the hit as JSON; once() keeps the first hit of each key."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "page int, pos int, hit string"
Fetch = Callable[[int], list[dict]]


class Pages(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


def fetched(fetch: Fetch, page: int, retries: int, wait: float) -> list[dict]:
    """A page's hits; a failed attempt is repeated after a wait that doubles."""
    for attempt in range(retries + 1):
        try:
            return fetch(page)
        except OSError:
            if attempt == retries:
                raise
            time.sleep(min(60.0, wait * 2**attempt))
    raise AssertionError


def split(first: int, last: int, size: int) -> list[Pages]:
    return [Pages(a, min(last, a + size - 1)) for a in range(first, last + 1, size)]


def paged_source(name: str, fetch: Fetch, last_page: Callable[[], int] | int, per_partition: int = 10, retries: int = 5, wait: float = 1.0) -> type[DataSource]:
    """A data source of this name for pages 1 to last_page."""

    def rows(pages: Pages) -> Iterator[tuple]:
        for page in range(pages.first, pages.last + 1):
            for pos, hit in enumerate(fetched(fetch, page, retries, wait)):
                yield page, pos, json.dumps(hit, ensure_ascii=False, sort_keys=True)

    def newest() -> int:
        return last_page() if callable(last_page) else last_page

    class Reader(DataSourceReader):
        def partitions(self) -> list[Pages]:
            return split(1, newest(), per_partition)

        def read(self, partition: Pages) -> Iterator[tuple]:
            return rows(partition)

    class StreamReader(DataSourceStreamReader):
        def initialOffset(self) -> dict:  # noqa: N802
            return {"page": 0}

        def latestOffset(self) -> dict:  # noqa: N802
            return {"page": newest()}

        def partitions(self, start: dict, end: dict) -> list[Pages]:
            return split(start["page"] + 1, end["page"], per_partition)

        def read(self, partition: Pages) -> Iterator[tuple]:
            return rows(partition)

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Reader()

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            return StreamReader()

    return Paged


def hits(spark: SparkSession, source: type[DataSource]) -> DataFrame:
    """(page, pos, hit) of a paged source."""
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()


def once(rows: DataFrame, key: str) -> DataFrame:
    """(key, page, hit): of hits with an equal value at a JSON path the one that comes first; a null key is a key."""
    place = F.struct("page", "pos")
    return rows.groupBy(F.try_variant_get(F.try_parse_json("hit"), f"$.{key}", "string").alias("key")).agg(F.min("page").alias("page"), F.min_by("hit", place).alias("hit"))
