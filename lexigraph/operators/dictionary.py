"""A keyword index stored under the runs of letters inside its terms, so that a search reads what it can match.

store() writes each term once for every run of one to three of its letters, partitioned by the index's scope and sorted by
run, beside how many terms have each run.  A search term of more than three letters has a rarest run; only that run's terms are read
and tested, and a shorter one's run is its answer.  Scans see the scope and the run as filters, so partitions and row groups without
them aren't read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import casefold
from ..session import staged
from .index import route

GRAM = 3


def grams_of(term: Column, n: int) -> Column:
    places = F.sequence(F.lit(1), F.length(term) - n + 1)
    return F.when(F.length(term) >= n, F.transform(places, lambda i: F.substr(term, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def store(index: DataFrame, scope: str, path: str) -> None:
    """Writes an index (scope, term, parts) under its terms' runs."""
    runs = F.array_distinct(F.concat(*[grams_of(F.col("term"), n) for n in range(1, GRAM + 1)]))
    # ranges are sampled before rows are dealt out, so the index would be built twice for either table
    rows = staged(index, "index").select(scope, "term", "parts", F.explode(runs).alias("gram"))
    # the term parts a run that many terms have over several ranges
    rows.repartitionByRange(scope, "gram", "term").sortWithinPartitions(scope, "gram", "term").write.partitionBy(scope).parquet(f"{path}/terms")
    rows.groupBy(scope, "gram").agg(F.count("*").alias("n")).repartitionByRange(scope, "gram").sortWithinPartitions(scope, "gram").write.partitionBy(scope).parquet(f"{path}/counts")


class Dictionary:
    """A stored index."""

    def __init__(self, spark: SparkSession, path: str, scope: str):
        self.scope = scope
        self.terms = spark.read.schema(f"term string, parts array<string>, gram string, {scope} string").parquet(f"{path}/terms")
        self.counts = spark.read.schema(f"gram string, n long, {scope} string").parquet(f"{path}/counts")

    def candidates(self, value: str, terms: list[str]) -> DataFrame:
        """(term, parts) of the scope's terms that hold some search term; those that only share its rarest run are still among them."""
        folded = [r[0] for r in self.counts.sparkSession.createDataFrame([(t,) for t in terms if t.strip()], "t string").select(casefold(F.trim("t"))).collect()]
        wanted: set[str] = set()
        for t in set(folded):
            runs = {t} if len(t) <= GRAM else {t[i : i + GRAM] for i in range(len(t) - GRAM + 1)}
            # a number for each run of the search term
            known = {r.gram: r.n for r in self.counts.where((F.col(self.scope) == value) & F.col("gram").isin(*runs)).collect()}
            if runs <= known.keys():
                wanted.add(min(runs, key=lambda g: (known[g], g)))
        rows = self.terms.where((F.col(self.scope) == value) & F.col("gram").isin(*wanted)) if wanted else self.terms.limit(0)
        return rows.select("term", "parts").distinct()

    def route(self, value: str, terms: list[str]) -> DataFrame:
        """(part, exact), as index.route gives from the whole index."""
        return route(self.candidates(value, terms), terms)
