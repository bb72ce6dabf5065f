"""Progression between neighbouring levels, back-links, and resolving stored references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def progression(rows: DataFrame, key: str, group: list[str], level: str) -> DataFrame:
    """(key, before, after): sorted keys of the same group one level below and above.

    Each side is grouped before the join, so that the join gives one row a key."""
    ids = rows.groupBy(*group, level).agg(F.array_sort(F.collect_set(key)).alias("ids"))
    before = ids.select(*group, (F.col(level) + 1).alias(level), F.col("ids").alias("before"))
    after = ids.select(*group, (F.col(level) - 1).alias(level), F.col("ids").alias("after"))
    none = F.array().cast(rows.select(F.array(key)).schema[0].dataType)
    return rows.select(key, *group, level).join(before, [*group, level], "left").join(after, [*group, level], "left").select(key, F.coalesce("before", none).alias("before"), F.coalesce("after", none).alias("after"))


def edges(rows: DataFrame, key: str, group: list[str], level: str) -> DataFrame:
    """(key, next): one row for each step from a level to the next within a group."""
    later = rows.select(*group, (F.col(level) - 1).alias(level), F.col(key).alias("next"))
    return rows.select(key, *group, level).join(later, [*group, level]).select(key, "next")


def back_links(items: DataFrame, flagged: Column, targets: DataFrame, item: str, target: str, group: list[str], level: str) -> DataFrame:
    """(item, targets, issue): for flagged items the targets of the level before in the same group; the first
    level, or no target, is an issue."""
    lists = targets.groupBy(*group, (F.col(level) + 1).alias(level)).agg(F.array_sort(F.collect_set(target)).alias("targets"))
    found = items.where(flagged).select(item, *group, level).join(lists, [*group, level], "left")
    return found.select(item, F.coalesce("targets", F.array().cast("array<string>")).alias("targets"), F.when(F.col(level) <= 1, "first-level").when(F.col("targets").isNull(), "no-target").alias("issue"))


def resolve(rows: DataFrame, key: str, references: str, targets: DataFrame, target: str, same: Column | None = None) -> DataFrame:
    """(key, pos, target, status): each stored reference in order; 'unknown' without a target row, 'foreign' where
    `same`, over the aliases a (row) and b (target), does not hold."""
    listed = rows.select("*", F.posexplode(references).alias("pos", "reference")).alias("a")
    joined = listed.join(targets.alias("b"), F.col("a.reference") == F.col(f"b.{target}"), "left")
    status = F.when(F.col(f"b.{target}").isNull(), "unknown")
    if same is not None:
        status = status.when(~F.coalesce(same, F.lit(False)), "foreign")
    return joined.select(F.col(f"a.{key}").alias("key"), "pos", F.col("a.reference").alias("target"), status.otherwise("ok").alias("status"))
