"""Data-quality rules as frames of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import plan_bytes

#: Estimated bytes of rows that a task counts: about a million narrow ones, as they lie in their files.  The estimate of a join may
#: be far too high, so tasks have a limit, beyond which they grow.
SLICE, MOST_TASKS = 4 << 20, 10_000

FINDING = ("severity", "rule", "record", "message")
HARD, SOFT, INFO = "hard", "soft", "info"


def finding(rows: DataFrame, severity: str, rule: str, record: Column, message: Column | str) -> DataFrame:
    text = F.lit(message) if isinstance(message, str) else message
    return rows.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), record.cast("string").alias("record"), text.alias("message"))


def together(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def missing_required(rows: DataFrame, record: Column, *fields: str) -> DataFrame:
    """A finding for each required field that is null or blank."""
    gone = F.filter(F.array(*[F.when(F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == ""), F.lit(f)) for f in fields]), lambda f: f.isNotNull())
    return finding(rows.select("*", F.explode(gone).alias("__field")), HARD, "missing-required-field", record, F.col("__field"))


def pattern_violations(rows: DataFrame, record: Column, value: Column, pattern: str, rule: str = "malformed-id") -> DataFrame:
    return finding(rows.where(~F.coalesce(value.rlike(pattern), F.lit(False))), SOFT, rule, record, value)


def unknown_values(rows: DataFrame, record: Column, value: Column, legal: list[str], rule: str = "unknown-enum-value") -> DataFrame:
    return finding(rows.where(value.isNotNull() & ~value.isin(*legal)), INFO, rule, record, value.cast("string"))


def collisions(rows: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def repeat_aware_collisions(rows: DataFrame, key: str, repeatable: Column, *content: str) -> DataFrame:
    """Keys of more than one row, unless every row may repeat and all have the same content; nulls are a content too.

    Rows are dealt out by key once, over as many tasks as their size asks for, and each task counts its keys whole: what a
    task holds stays the same as the input grows."""
    lines = rows.select(key, repeatable.alias("may"), F.struct(*content).alias("content"))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, min(plan_bytes(lines) // SLICE + 1, MOST_TASKS))
    return lines.repartition(tasks, key).groupBy(key).agg(F.count("*").alias("n"), F.min("may").alias("may"), F.countDistinct("content").alias("contents")).where("n > 1 and not (may and contents = 1)").select(key, "n", "contents")


def dangling(rows: DataFrame, reference: str, targets: DataFrame, target: str) -> DataFrame:
    """Rows whose reference no target has; null references dangle nowhere."""
    return rows.where(F.col(reference).isNotNull()).join(targets.select(F.col(target).alias(reference)).distinct(), reference, "left_anti")


def symmetric_difference(rows: DataFrame, key: Column, left: Column, right: Column) -> DataFrame:
    """(key, only_left, only_right) of rows whose two sets differ."""
    out = rows.select(key, F.array_sort(F.array_except(left, right)).alias("only_left"), F.array_sort(F.array_except(right, left)).alias("only_right"))
    return out.where((F.size("only_left") > 0) | (F.size("only_right") > 0))


def reconcile(stored: DataFrame, found: DataFrame, key: list[str], *fields: str) -> DataFrame:
    """(key…, field, stored, found) of every difference; a missing side is a difference of all fields."""
    a, b = stored.select(*key, F.struct(*fields).alias("a")), found.select(*key, F.struct(*fields).alias("b"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col("a")[f].cast("string").alias("stored"), F.col("b")[f].cast("string").alias("found")) for f in fields])
    return a.join(b, key, "full_outer").select(*key, F.explode(F.filter(pairs, lambda p: ~p["stored"].eqNullSafe(p["found"]))).alias("p")).select(*key, "p.field", "p.stored", "p.found")


def oversize(rows: DataFrame, record: Column, text: Column, most_bytes: int = 50_000, most_tokens: int = 15_000) -> DataFrame:
    from ..functions.text import token_estimate

    return finding(rows.where((F.octet_length(text) > most_bytes) | (token_estimate(text) > most_tokens)), SOFT, "size-target-exceeded", record, F.octet_length(text).cast("string"))


def expected_counts(measured: DataFrame, expected: DataFrame, name: str = "name") -> DataFrame:
    """(name, expected, measured) of every count, matching or not; the expected table is small."""
    return expected.join(measured, name, "left").select(name, "expected", F.coalesce("measured", F.lit(0)).cast("long").alias("measured")).withColumn("matches", F.col("expected") == F.col("measured"))


def roll_up(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity", "rule").agg(F.count("*").alias("n"))


def ordered(findings: DataFrame) -> DataFrame:
    rank = F.when(F.col("severity") == HARD, 0).when(F.col("severity") == SOFT, 1).otherwise(2)
    return findings.orderBy(rank, "rule", "record", "message")


def exit_code(findings: DataFrame, strict: bool = False) -> int:
    bad = F.col("severity") == HARD
    if strict:
        bad = bad | (F.col("severity") == SOFT)
    return int(bool(findings.agg(F.coalesce(F.max(bad), F.lit(False))).first()[0]))
