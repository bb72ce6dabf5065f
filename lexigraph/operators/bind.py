"""Metadata-driven lookups: attached content as one join, coordinates, crosswalk, level gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small, staged

SLOT = 4096  # keys of a block, on either side
RUN = 256  # keys of either side that are multiplied at once
TASKS = 20_000  # blocks that meet are dealt out over so many tasks at most


class MissingBlock(LookupError):
    """A coordinate names no block."""


def attach_key(binding: Column, own: Column, area: Column, level: Column) -> Column:
    """The key that a record and its content share under a binding; null, which nothing equals, under others."""
    return F.when(binding == "kompetenz", own).when(binding == "bereich", F.concat_ws(".", area, level)).when(binding == "stufe", level)


def attached(records: DataFrame, items: DataFrame, scope: str) -> DataFrame:
    """Every record with each of its items, by (scope, attach_key); records without items stay, with nulls."""
    return records.join(items, [scope, "attach_key"], "left")


def at_coordinates(blocks: DataFrame, where: Column) -> DataFrame:
    """Rows at coordinates, in source order; raises MissingBlock where there is none."""
    found = blocks.where(where)
    if found.limit(1).count() == 0:
        raise MissingBlock(str(where))
    return found.orderBy("pos")


def crosswalk(records: DataFrame, bridge: DataFrame, targets: DataFrame, left: list[str], right: list[str], key: str, target: str, order: str) -> DataFrame:
    """(key, target, …): targets of all areas that a record's area is bridged to, each once, under the first bridge row.

    The bridge is a small table of areas, whatever the number of records.  What a pair gives depends on the areas of its two
    sides alone, so that is worked out for combinations of areas.  Keys of one combination are put together in blocks; only
    blocks meet, and the pairs, which can be as many as records times targets, are made from two blocks by the task that
    returns them, never shuffled or sorted.  Each record of a block repeats a short run of targets, which files compress."""
    # null areas are bridged to nothing, as in a join
    ways = small(staged(bridge.dropna(subset=[*left, *right]).select(F.struct(*left).alias("__l"), F.struct(*right).alias("__r"), order), "bridge"))
    of_records, a = _blocks(records, ways, left, key, "l")
    of_targets, b = _blocks(targets, ways, right, target, "r")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1).cast("array<bigint>"))
    pairs = a.withColumn("__l", F.explode("__l_areas")).join(ways, "__l").join(b.withColumn("__r", F.explode("__r_areas")), "__r").groupBy("__l_areas", "__l_n", "__r_areas", "__r_n").agg(F.min(order).alias(order))
    met = pairs.agg(F.sum(F.col("__l_n") * F.col("__r_n"))).first()[0] or 1
    blocks = pairs.withColumn("__l_at", each("__l_n")).withColumn("__r_at", each("__r_n")).join(of_records, ["__l_areas", "__l_at"]).join(of_targets, ["__r_areas", "__r_at"])
    # adaptive execution would put what is small into one task
    blocks = blocks.repartition(min(4 * met, TASKS), "__l_areas", "__l_at", "__r_areas", "__r_at")
    # generated code holds all rows of one that it is given, so it is given short runs: a node with a higher-order function isn't part of it
    runs = lambda name: F.explode(F.transform(F.sequence(F.lit(1), F.size(name), F.lit(RUN)), lambda i: F.slice(name, i, F.lit(RUN))))
    rows = blocks.select("__l_keys", runs("__r_keys").alias("__r_run"), order).select(runs("__l_keys").alias("__l_run"), "__r_run", order)
    return rows.select(F.explode("__l_run").alias(key), "__r_run", order).select(key, F.explode("__r_run").alias(target), order)


def _blocks(rows: DataFrame, ways: DataFrame, columns: list[str], key: str, side: str) -> tuple[DataFrame, DataFrame]:
    """Keys with the same bridged areas in blocks of some SLOT, (areas, at, keys), and how many blocks there are, (areas, n)."""
    areas, n, at, keys = (f"__{side}_{x}" for x in ("areas", "n", "at", "keys"))
    rows = rows.select(key, F.struct(*columns).alias(f"__{side}")).join(ways.select(f"__{side}"), f"__{side}", "left_semi")
    rows = rows.groupBy(key).agg(F.array_sort(F.collect_set(f"__{side}")).alias(areas))
    sizes = small(staged(rows.groupBy(areas).agg(F.ceil(F.count("*") / SLOT).alias(n)), "areas"))
    dealt = rows.join(sizes, areas).withColumn(at, F.pmod(F.xxhash64(key), F.col(n)))
    # a list leaves a null out
    none = F.when(F.max(F.col(key).isNull()), F.array(F.lit(None).cast(rows.schema[key].dataType))).otherwise(F.array())
    return dealt.groupBy(areas, at).agg(F.concat(F.array_sort(F.collect_list(key)), none).alias(keys)), sizes


def gated(records: DataFrame, level: Column, boundary: Column, label: str = "open") -> DataFrame:
    from ..functions.text import level_at_least

    return records.withColumn(label, level_at_least(level, boundary))


def theme_catalog(meta: DataFrame, scope: str, themes: str, name: Column) -> DataFrame:
    """Scopes whose theme list has the name, folded; metadata alone is read."""
    from ..functions.text import casefold

    return meta.where(F.exists(themes, lambda t: casefold(t) == casefold(name))).select(scope)
