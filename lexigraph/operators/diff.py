"""Snapshot comparison with a classification of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def field_changes(before: DataFrame, after: DataFrame, key: str, *fields: str) -> DataFrame:
    """(key, side, field, baseline, candidate): 'added' and 'removed' keys once, changed fields of common keys each."""
    a = before.select(key, F.struct(*fields).alias("a"))
    b = after.select(key, F.struct(*fields).alias("b"))
    cell = lambda s, f: F.col(s)[f].cast("string")
    changed = F.filter(F.array(*[F.struct(F.lit(f).alias("field"), cell("a", f).alias("x"), cell("b", f).alias("y")) for f in fields]), lambda p: ~p["x"].eqNullSafe(p["y"]))
    whole = lambda name: F.array(F.struct(F.lit(name).alias("field"), F.lit(None).cast("string").alias("x"), F.lit(None).cast("string").alias("y")))
    rows = F.when(F.col("a").isNull(), whole("*")).when(F.col("b").isNull(), whole("*")).otherwise(changed)
    side = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, side.alias("side"), F.explode(rows).alias("p")).select(key, "side", "p.field", F.col("p.x").alias("baseline"), F.col("p.y").alias("candidate"))


# fixed values: the categories, most serious first
CATEGORIES = ("amendment", "repeal", "silent-republication", "document-added", "document-removed")


def classified(changes: DataFrame, key: str, identity: list[str], content: list[str], out_of_force: str = "ausserkrafttretensdatum") -> DataFrame:
    """Adds category: amendment where identity fields changed, and for content changes of the same key too;
    silent-republication for other content changes; repeal for the out-of-force date; added and removed keys;
    metadata for fields that none of these names."""
    amended = F.max(F.col("field").isin(*identity) & (F.col("side") == "changed")).over(Window.partitionBy(key))
    category = (
        F.when(F.col("side") != "changed", F.concat(F.lit("document-"), F.col("side")))
        .when(F.col("field").isin(*identity), "amendment")
        .when(F.col("field") == out_of_force, "repeal")
        .when(F.col("field").isin(*content), F.when(amended, "amendment").otherwise("silent-republication"))
        .otherwise("metadata")
    )
    return changes.withColumn("category", category)


def ordered(changes: DataFrame, *then: str) -> DataFrame:
    rank = F.coalesce(*[F.when(F.col("category") == c, i) for i, c in enumerate(CATEGORIES)], F.lit(len(CATEGORIES)))
    return changes.orderBy(rank, *then)


def key_sets(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, side) of keys in both or one of the snapshots."""
    a, b = before.select(key).distinct().withColumn("a", F.lit(True)), after.select(key).distinct().withColumn("b", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("common").alias("side"))
