"""Cascade text join and verbatim checks."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import plan_bytes, staged


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def _pieces(n: Column, threshold: float) -> Column:
    """How many pieces a form of n characters is cut into: two texts of the ratio share one of them whole.

    A ratio of t means that all but (1 - t) of the characters of both match in order, so at most D = (1 - t) * (n + m)
    insertions and deletions part them, and one of D + 1 pieces is untouched.  m is at most n * (2 - t) / t."""
    return F.floor((1 - threshold) * (n + F.floor(n * (2 - threshold) / threshold)) + 1e-9) + 1


def similar_forms(left: DataFrame, right: DataFrame, bucket: list[str], form: str, other: str, threshold: float) -> DataFrame:
    """(bucket…, form, other, score): pairs of distinct forms of a bucket with a similarity of at least the threshold.

    Pairs meet through an equal piece at about the same place, so a bucket is never paired with itself whole.  What is
    left is bounded from above by the lengths and by the characters that both have, and only what may reach the
    threshold gets to the similarity function, a pair of texts once however many rows and buckets have it."""
    t = threshold
    a = left.select(*bucket, form).distinct().withColumn("__n", F.length(form)).where("__n > 0")
    b = right.select(*bucket, other).distinct().withColumn("__m", F.length(other)).where("__m > 0")
    k = _pieces(F.col("__n"), t)
    cut = lambda i: F.floor(F.col("__n") * i / k)
    piece = lambda i: F.struct(cut(i).alias("at"), F.substr(F.col(form), (cut(i) + 1).cast("int"), (cut(i + 1) - cut(i)).cast("int")).alias("piece"))
    a = a.withColumn("p", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), k - 1), piece))).select(*bucket, form, "__n", F.col("p.at").alias("__at"), F.col("p.piece").alias("__piece"))
    # the lengths that pieces of a partner can have, whatever its own length within the ratio
    lengths = F.array_distinct(F.flatten(F.transform(F.sequence(F.ceil(F.col("__m") * t / (2 - t) - 1e-9), F.floor(F.col("__m") * (2 - t) / t + 1e-9)), lambda n: F.array(F.floor(n / _pieces(n, t)), F.floor(n / _pieces(n, t)) + 1))))
    b = b.withColumn("__l", F.explode(F.filter(lengths, lambda x: (x > 0) & (x <= F.col("__m"))))).withColumn("__to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__m") - F.col("__l"))))
    b = b.select(*bucket, other, "__m", "__to", F.substr(F.col(other), (F.col("__to") + 1).cast("int"), F.col("__l").cast("int")).alias("__piece"))
    near = (F.abs(F.col("__at") - F.col("__to")) <= (1 - t) * (F.col("__n") + F.col("__m")) + 1e-9) & (2 * F.least("__n", "__m") >= t * (F.col("__n") + F.col("__m")) - 1e-9)
    pairs = a.join(b, [*bucket, "__piece"]).where(near).select(*bucket, form, other).distinct()
    texts = pairs.select(form, other).distinct()
    count = lambda c, x: F.length(c) - F.length(F.replace(c, x, F.lit("")))
    letters = F.array_distinct(F.split(F.col(form), ""))
    common = F.aggregate(F.filter(letters, lambda x: x != ""), F.lit(0), lambda s, x: s + F.least(count(F.col(form), x), count(F.col(other), x)))
    texts = texts.where(2 * common >= t * (F.length(form) + F.length(other)) - 1e-9)
    scored = texts.withColumn("score", similarity(form, other)).where(F.col("score") >= t)
    return pairs.join(scored, [form, other])


def cascade_join(left: DataFrame, right: DataFrame, bucket: list[str], key: str, form: str, ordinal: str, other: str, threshold: float = 0.9) -> DataFrame:
    """(key, other, mode, score): for each left row the right row of its bucket with the equal form; else the most similar
    one from the threshold on; else the one with the same ordinal; else none.

    Both sides have bucket, form and ordinal columns.  Only forms without an exact partner reach the similarity step;
    ties go to the right row with the least (ordinal, key)."""
    a = left.select(*bucket, key, form, ordinal)
    b = right.select(*bucket, F.col(other), F.col(form).alias("__form"), F.col(ordinal).alias("__ordinal"))
    first = b.groupBy(*bucket, "__form").agg(F.min(F.struct("__ordinal", other)).alias("__x"))
    exact = a.join(first.withColumnRenamed("__form", form), [*bucket, form], "left")
    done = exact.where("__x is not null").select(key, F.col("__x")[other].alias(other), F.lit("exact").alias("mode"), F.lit(1.0).alias("score"))
    rest = exact.where("__x is null").drop("__x")
    if threshold <= 1:
        alike = similar_forms(rest, b, bucket, form, "__form", threshold).join(first, [*bucket, "__form"])
        best = alike.groupBy(*bucket, form).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("__x"))).alias("__y"))
        rest = rest.join(best, [*bucket, form], "left")
        fuzzy = rest.where("__y is not null").select(key, F.col("__y")["__x"][other].alias(other), F.lit("fuzzy").alias("mode"), (-F.col("__y.s")).alias("score"))
        done, rest = done.unionByName(fuzzy), rest.where("__y is null").drop("__y")
    place = b.groupBy(*bucket, F.col("__ordinal").alias(ordinal)).agg(F.min(other).alias(other))
    last = rest.join(place, [*bucket, ordinal], "left").select(key, other, F.when(F.col(other).isNull(), "unmatched").otherwise("positional").alias("mode"), F.lit(None).cast("double").alias("score"))
    return done.unionByName(last)


def join_rates(joined: DataFrame) -> DataFrame:
    """Counts and shares of the modes of a cascade join."""
    modes = ("exact", "fuzzy", "positional", "unmatched")
    counts = joined.agg(F.count("*").alias("blocks"), *[F.count_if(F.col("mode") == m).alias(m) for m in modes])
    return counts.select("*", *[(F.col(m) / F.greatest(F.col("blocks"), F.lit(1))).alias(f"{m}_rate") for m in modes])


def contained(texts: DataFrame, text: str, quotes: DataFrame, quote: str, most_bytes: int = 8 << 20) -> DataFrame:
    """Pairs of rows whose text holds the quote verbatim.

    A quote list of a proven size is sent to every task, which makes one automaton of it and passes over each text once,
    however many quotes there are; a longer list is met by keys that any text that holds a quote has."""
    # a file size says little about what it unpacks to: the bytes are counted
    size = quotes.agg(F.coalesce(F.sum(F.octet_length(quote).cast("long")), F.lit(0)), F.count("*")).first()
    if size[0] + 64 * size[1] <= most_bytes and plan_bytes(quotes) <= 8 * most_bytes:
        return _contained_few(texts, text, quotes, quote)
    return _contained_many(texts, text, quotes, quote)


def _contained_many(texts: DataFrame, text: str, quotes: DataFrame, quote: str) -> DataFrame:
    """Every quote has pieces that any text that holds it has too: its inner runs of three words, or where it has none its runs of three
    characters, or it is no longer than that.  Of these the one that the fewest texts have is what it is met by.  Only numbers of
    texts and pieces are shuffled; a text goes along once for each quote that it may hold."""
    # numbers stand for texts and pieces: equal ones would only add candidates, which the texts themselves decide
    number = lambda c: F.xxhash64(c, F.length(c))
    words = lambda c: F.filter(F.split(c, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    run = lambda ws, first, last: F.when(last >= first, F.transform(F.sequence(first, last), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(ws, i, 3))))).otherwise(F.array().cast("array<bigint>"))
    chars = lambda c, n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.xxhash64(F.lit(n), F.substr(c, i, F.lit(n))))).otherwise(F.array().cast("array<bigint>"))
    asked = quotes.select(quote).where(F.col(quote).isNotNull()).distinct().withColumns({"__q": number(F.col(quote)), "__words": words(F.col(quote))})
    # a quote's first and last words may be parts of longer ones
    inner = run(F.col("__words"), F.lit(2), F.size("__words") - 3)
    short = F.when(F.length(quote) >= 3, chars(F.col(quote), 3)).when(F.length(quote) > 0, F.array(F.xxhash64(F.length(quote), quote))).otherwise(F.array().cast("array<bigint>"))
    asked = asked.withColumn("__pieces", F.array_distinct(F.when(F.size(inner) > 0, inner).otherwise(short))).drop("__words")
    pieces = asked.select("__q", F.explode("__pieces").alias("__piece"))
    held = texts.select(F.col(text).alias("__t")).where(F.col(text).isNotNull()).distinct()
    ws = words(F.col("__t"))
    some = [run(ws, F.lit(1), F.size(ws) - 2), *[chars(F.col("__t"), n) for n in (1, 2, 3)]]
    held = held.select(number(F.col("__t")).alias("__h"), F.explode(F.array_distinct(F.concat(*some))).alias("__piece"))
    held = staged(held.join(pieces.select("__piece").distinct(), "__piece", "left_semi"), "pieces")
    often = held.groupBy("__piece").count()
    rare = pieces.join(often, "__piece", "left").groupBy("__q").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "__piece")).alias("x"))
    pairs = rare.where("x.n > 0").select("__q", F.col("x.__piece").alias("__piece")).join(held, "__piece").select("__q", "__h").distinct()
    known = quotes.withColumn("__q", number(F.col(quote)))
    found = texts.withColumn("__h", number(F.col(text))).join(pairs, "__h").join(known, "__q").where(F.contains(F.col(text), F.col(quote))).drop("__h", "__q")
    empty = quotes.where(F.length(quote) == 0)
    if empty.limit(1).count():  # every text holds an empty quote: that is what is asked for
        found = found.unionByName(texts.join(empty, F.col(text).isNotNull()))
    return found


def _contained_few(texts: DataFrame, text: str, quotes: DataFrame, quote: str) -> DataFrame:
    wanted = [r[0] for r in quotes.where(F.col(quote).isNotNull()).select(quote).distinct().collect()]  # of a size that contained() has counted
    number = "__quote"
    while number in texts.columns or number in quotes.columns:
        number += "_"

    def found(batches):
        import ahocorasick

        automaton, always = ahocorasick.Automaton(), [q for q in wanted if not q]
        for q in wanted:
            if q:
                automaton.add_word(q, q)
        automaton.make_automaton()
        for batch in batches:
            rows, hits = [], []
            for i, t in enumerate(batch.column(text).to_pylist()):
                if t is None:
                    continue
                for q in always + sorted({q for _, q in automaton.iter(t)} if len(automaton) else ()):
                    rows.append(i), hits.append(q)
            held = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*held.columns, pa.array(hits, pa.string())], [*batch.schema.names, number])

    schema = T.StructType([*texts.schema.fields, T.StructField(number, T.StringType())])
    pairs = texts.mapInArrow(found, schema)
    return pairs.join(F.broadcast(quotes), pairs[number] == quotes[quote]).drop(number)


def located_prefix(needle: Column, hay: Column) -> Column:
    """The longest beginning of a text that another holds, found by halving: where the two part is what one looks at."""
    n = F.length(needle)
    state = F.struct(F.lit(0).alias("low"), n.alias("high"))

    def half(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        held = F.contains(hay, F.substr(needle, F.lit(1), middle))
        return F.when(s["low"] >= s["high"], s).when(held, F.struct(middle.alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), (middle - 1).alias("high")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 2)).cast("int"))
    return F.substr(needle, F.lit(1), F.aggregate(steps, state, half)["low"])


class PrefixAutomaton:
    """Reads texts once and knows of every needle the longest beginning that stood somewhere in them.

    States are the beginnings of all needles; the state after a character is the longest of them that the text read so far ends
    with, so a visit to it is an occurrence of that beginning."""

    def __init__(self, needles: list[str]):
        self.steps, self.back, self.depth, self.ends = [{}], [0], [0], []
        for n in needles:
            at = 0
            for c in n:
                if c not in self.steps[at]:
                    self.steps[at][c] = len(self.steps)
                    self.steps.append({})
                    self.back.append(0)
                    self.depth.append(self.depth[at] + 1)
                at = self.steps[at][c]
            self.ends.append(at)
        queue = list(self.steps[0].values())
        for at in queue:  # in order of depth, which appending keeps
            for c, to in self.steps[at].items():
                back = self.back[at]
                while back and c not in self.steps[back]:
                    back = self.back[back]
                self.back[to] = self.steps[back].get(c, 0) if self.steps[back].get(c, 0) != to else 0
                queue.append(to)
        self.order, self.seen = queue, bytearray(len(self.steps))

    def read(self, text: str) -> None:
        steps, back, seen, at = self.steps, self.back, self.seen, 0
        for c in text:
            while at and c not in steps[at]:
                at = back[at]
            at = steps[at].get(c, 0)
            seen[at] = 1

    def lengths(self) -> list[int]:
        """The longest beginning of each needle that was met."""
        for at in reversed(self.order):  # what ends a longer beginning was met with it
            if self.seen[at]:
                self.seen[self.back[at]] = 1
        longest = [0] * len(self.steps)
        for at in [0, *self.order]:
            for to in self.steps[at].values():
                longest[to] = self.depth[to] if self.seen[to] else longest[at]
        return [longest[e] for e in self.ends]


def located_prefixes(needles: DataFrame, needle: str, blocks: DataFrame, block: str, most_bytes: int = 4 << 20) -> DataFrame:
    """(needle, prefix): of each distinct needle the longest beginning that some block holds, "" if none.

    Needles of a proven size are made one automaton in every task, which passes over the blocks once and sends a length for each
    needle.  More are halved together: a beginning that a block holds has only beginnings that one holds, so each round asks
    contained() for the middle of what is still open, and there are as many rounds as the longest needle has binary digits."""
    some = needles.where(F.col(needle).isNotNull()).select(F.col(needle).alias("needle")).distinct()
    texts = blocks.select(F.col(block).alias("block")).where(F.col("block").isNotNull())
    size = some.agg(F.coalesce(F.sum(F.octet_length("needle").cast("long")), F.lit(0)), F.coalesce(F.max(F.length("needle")), F.lit(0))).first()
    if size[0] <= most_bytes and plan_bytes(needles) <= 8 * most_bytes:
        wanted = sorted(r[0] for r in some.collect())  # of a size that was counted

        def met(batches):
            automaton = PrefixAutomaton(wanted)
            for batch in batches:
                for t in batch.column(0).to_pylist():
                    automaton.read(t)
            found = automaton.lengths()
            yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.string()), pa.array(found, pa.int32())], ["needle", "n"])

        found = texts.mapInArrow(met, "needle string, n int").groupBy("needle").agg(F.max("n").alias("n"))
        return some.join(found, "needle", "left").select("needle", F.substr("needle", F.lit(1), F.coalesce("n", F.lit(0))).alias("prefix"))
    now = some.withColumns({"low": F.lit(0), "high": F.length("needle")})
    for _ in range(int(size[1]).bit_length() + 1):
        now = staged(now.withColumn("middle", F.substr("needle", F.lit(1), F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int"))), "halves")
        if not now.where("low < high").limit(1).count():
            break
        held = contained(texts, "block", now.where("low < high").select("middle").distinct(), "middle").select("middle").distinct().withColumn("held", F.lit(True))
        open_, length = F.col("low") < F.col("high"), F.length("middle")
        now = now.join(held, "middle", "left").select("needle", F.when(open_ & F.col("held").isNotNull(), length).otherwise(F.col("low")).alias("low"), F.when(open_ & F.col("held").isNull(), length - 1).otherwise(F.col("high")).alias("high"))
    return now.select("needle", F.substr("needle", F.lit(1), F.col("low")).alias("prefix"))


def mode_tally(modes: DataFrame) -> DataFrame:
    """(mode, n) of a fidelity check; a mode that doesn't occur has 0."""
    counts = modes.agg(*[F.count_if(F.col("mode") == m).alias(m) for m in ("exact", "bounded", "failed")])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(m).alias("mode"), F.col(m).alias("n")) for m in ("exact", "bounded", "failed")])))


def word_bounded(text: Column, quote: Column) -> Column:
    """Whether the text holds the quote with no letter or digit right before or after it."""
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.replace(quote, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![\p{L}\p{N}])"))
    return F.contains(text, quote) & F.rlike(text, pattern)


def fidelity(records: DataFrame, key: str, form: str, blocks: DataFrame, block: str) -> DataFrame:
    """(key, mode): 'exact' where a whole block equals the record's text, 'bounded' where a block holds it at word ends,
    else 'failed'."""
    whole = blocks.select(F.col(block).alias(form)).distinct()
    exact = records.join(whole, form, "left_semi").select(key, F.lit("exact").alias("mode"))
    rest = records.join(whole, form, "left_anti")
    held = contained(blocks.select(F.col(block).alias("__block")), "__block", rest.select(key, form), form).where(word_bounded(F.col("__block"), F.col(form))).select(key).distinct()
    bounded = held.select(key, F.lit("bounded").alias("mode"))
    failed = rest.join(held, key, "left_anti").select(key, F.lit("failed").alias("mode"))
    return exact.unionByName(bounded).unionByName(failed)


def best_by(rows: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """The first row of each group in an order."""
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where("__rank = 1").drop("__rank")
