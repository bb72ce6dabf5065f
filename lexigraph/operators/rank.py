"""Relevance ranking, top-k and token budgets; ordinals and carried state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows in an order, with their rank; partial top-k lists are merged, nothing is sorted whole."""
    best = rows.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def relevance(*hits: Column) -> list[Column]:
    """Sort keys: each condition's hits first, the first condition above all."""
    return [F.when(F.coalesce(h, F.lit(False)), 0).otherwise(1) for h in hits]


def within_budget(ranked: DataFrame, size: Column, budget: int, *columns: str) -> DataFrame:
    """Ranked rows (column rank; a bounded top-k list) with accepted: taken in order while they fit, skipping those
    that don't; the first is always taken."""
    one = F.struct("rank", size.cast("long").alias("size"), *columns)
    listed = ranked.agg(F.array_sort(F.collect_list(one)).alias("rows"))
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("taken"))

    def step(s: Column, r: Column) -> Column:
        fits = (F.size(s["taken"]) == 0) | (s["used"] + r["size"] <= budget)
        return F.when(fits, F.struct((s["used"] + r["size"]).alias("used"), F.array_append(s["taken"], r["rank"]).alias("taken"))).otherwise(s)

    folded = listed.select("rows", F.aggregate("rows", start, step).alias("state"))
    return folded.select(F.explode("rows").alias("r"), "state").select("r.*", F.array_contains("state.taken", F.col("r.rank")).alias("accepted"))


def ordinal(group: list[str], *order: str) -> Column:
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order))


def scope_id(group: list[str], order: list[str], reset: Column) -> Column:
    """Counts the resets up to and including each row."""
    return F.sum(F.when(reset, 1).otherwise(0)).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).cast("long")


def carried(value: Column, scope: list[str], order: list[str]) -> Column:
    """The last value of the scope that is not null, up to and including each row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*scope).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def newest(rows: DataFrame, group: list[str], date: Column, *ties: Column) -> DataFrame:
    """The newest row of each group."""
    order = Window.partitionBy(*group).orderBy(date.desc(), *ties)
    return rows.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def applicable(tags: Column, context: list[str]) -> Column:
    """Whether a list of conditions joined with '; ' holds in a context; none always holds."""
    listed = F.filter(F.split(F.coalesce(tags, F.lit("")), r"\s*;\s*"), lambda t: t != "")
    return F.forall(listed, lambda t: t.isin(*context) if context else F.lit(False))
