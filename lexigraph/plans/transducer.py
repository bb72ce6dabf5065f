"""Finite-state transducers over ordered events, evaluated by composing transition maps.

A document is cut into segments of so many children.  What a segment does to each state is one small map, and maps
compose associatively, so a segment's map is worked out by itself, the maps of a document are folded in order, and the
states inside each segment follow from the state at its entry.  No task holds more than a segment's events, however long a
document is; the fold over a document has one map for each segment.

Registers, that is values which an event writes, clears or leaves as they are, compose in the same way: the last write counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 10_000


@dataclass(frozen=True)
class Machine:
    """States by name, and for each token that moves any of them the state that each one goes to."""

    states: tuple[str, ...]
    start: str
    moves: dict[str, dict[str, str]]

    def table(self) -> Column:
        """token -> for each state's number the number of the next."""
        number = {s: i for i, s in enumerate(self.states)}
        rows = [(t, [number[goes.get(s, s)] for s in self.states]) for t, goes in self.moves.items()]
        return F.create_map(*[x for t, to in rows for x in (F.lit(t), F.array(*map(F.lit, to)))])

    def folded(self, tokens: list[str]) -> list[tuple[str, str]]:
        """(before, after) of each token, one after another."""
        out, state = [], self.start
        for t in tokens:
            after = self.moves.get(t, {}).get(state, state)
            out.append((state, after))
            state = after
        return out


def with_states(events: DataFrame, machine: Machine, segment: int = SEGMENT) -> DataFrame:
    """Adds before and after, the states around each child (doc, idx), by the token of its first row (pos 0)."""
    table, many = machine.table(), len(machine.states)
    cut = F.floor(F.col("idx") / segment).cast("long")
    events = events.withColumn("__segment", cut)
    step = F.when((F.col("pos") == 0) & F.col("token").isin(*machine.moves), F.struct("idx", "token"))
    # collect_list leaves out nulls: a segment's list has only what moves
    segments = events.groupBy("doc", "__segment").agg(F.array_sort(F.collect_list(step)).alias("__steps"))
    identity = F.array(*[F.lit(i) for i in range(many)])
    through = F.aggregate("__steps", identity, lambda m, x: F.transform(m, lambda s: F.element_at(F.element_at(table, x["token"]), s + 1)))
    maps = segments.select("doc", F.struct(F.col("__segment").alias("segment"), through.alias("map")).alias("m"))
    lists = maps.groupBy("doc").agg(F.array_sort(F.collect_list("m")).alias("maps"))
    start = F.struct(F.lit(machine.states.index(machine.start)).alias("state"), F.array().cast("array<struct<segment:bigint,entry:int>>").alias("entries"))
    entries = F.aggregate("maps", start, lambda a, m: F.struct(F.element_at(m["map"], a["state"] + 1).alias("state"), F.array_append(a["entries"], F.struct(m["segment"].alias("segment"), a["state"].alias("entry"))).alias("entries")))["entries"]
    entry = lists.select("doc", F.inline(entries)).withColumnRenamed("segment", "__segment")
    begun = F.struct(F.col("entry").alias("state"), F.array().cast("array<struct<idx:int,before:int,after:int>>").alias("spans"))
    goes = lambda a, x: F.element_at(F.element_at(table, x["token"]), a["state"] + 1)
    spans = F.aggregate("__steps", begun, lambda a, x: F.struct(goes(a, x).alias("state"), F.array_append(a["spans"], F.struct(x["idx"].cast("int").alias("idx"), a["state"].alias("before"), goes(a, x).alias("after"))).alias("spans")))["spans"]
    spans = segments.join(entry, ["doc", "__segment"]).select("doc", "__segment", "entry", spans.alias("__spans"))
    named = F.array(*map(F.lit, machine.states))
    rows = events.join(spans, ["doc", "__segment"])
    last = F.try_element_at(F.filter("__spans", lambda x: x["idx"] <= F.col("idx")), F.lit(-1))
    here = F.coalesce(last["idx"] == F.col("idx"), F.lit(False))
    before, after = F.when(here, last["before"]).otherwise(F.coalesce(last["after"], F.col("entry"))), F.coalesce(last["after"], F.col("entry"))
    return rows.withColumns({"before": F.element_at(named, before + 1), "after": F.element_at(named, after + 1)}).drop("__segment", "__spans", "entry")


def with_registers(events: DataFrame, writes: dict[str, Column], segment: int = SEGMENT, earlier: tuple[str, ...] = ()) -> DataFrame:
    """Adds registers: for each name the value last written up to and including each row, or, for names in `earlier`, before the row's child.
    A write is a struct with the one field `value`, which may hold null to clear the register; a null struct leaves it as it is."""
    events = events.withColumn("__segment", F.floor(F.col("idx") / segment).cast("long"))
    events = events.withColumns({f"__w_{n}": w for n, w in writes.items()})
    at = F.struct("idx", "pos")
    ends = events.groupBy("doc", "__segment").agg(*[F.max_by(f"__w_{n}", F.when(F.col(f"__w_{n}").isNotNull(), at)).alias(f"__e_{n}") for n in writes])
    gone = Window.partitionBy("doc").orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("doc", "__segment", *[F.last(f"__e_{n}", ignorenulls=True).over(gone).alias(f"__c_{n}") for n in writes])
    rows = events.join(ends, ["doc", "__segment"])
    upto = Window.partitionBy("doc", "__segment").orderBy("idx", "pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("doc", "__segment").orderBy("idx").rangeBetween(Window.unboundedPreceding, -1)
    value = lambda n: F.coalesce(F.last(f"__w_{n}", ignorenulls=True).over(before if n in earlier else upto), F.col(f"__c_{n}"))["value"]
    rows = rows.withColumns({n: value(n) for n in writes})
    return rows.drop("__segment", *[f"__{k}_{n}" for k in "wc" for n in writes])
