"""Inverted keyword index, part catalogue, routed search and keyword coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold, token_estimate, tokens


def inverted_index(rows: DataFrame, text: Column, part: str, scope: list[str] | None = None, most_parts: int | None = 2, least: int = 4, stop: tuple[str, ...] | None = None) -> DataFrame:
    """(scope…, term, parts): terms of each scope with their sorted parts, without terms of more than `most_parts` parts
    (None: all terms, as a search needs that must find whatever holds a term).

    Terms are made distinct per (term, part) before the sets are built, so a word in every document is a
    row for each part, not for each occurrence."""
    scope = scope or []
    found = tokens(text, least) if stop is None else tokens(text, least, stop)
    pairs = rows.select(*scope, F.col(part).alias("part"), F.explode(F.array_distinct(found)).alias("term")).distinct()
    found = pairs.groupBy(*scope, "term").agg(F.array_sort(F.collect_set("part")).alias("parts"))
    return found if most_parts is None else selective(found, most_parts)


def selective(index: DataFrame, most_parts: int = 2) -> DataFrame:
    """The terms of an index that lead to few parts."""
    return index.where(F.size("parts") <= most_parts)


def route(index: DataFrame, terms: list[str]) -> DataFrame:
    """Parts that some indexed term with some search term inside it leads to, and whether a term is met exactly."""
    wanted = F.array(*[casefold(F.trim(F.lit(t))) for t in terms if t.strip()]) if any(t.strip() for t in terms) else F.array().cast("array<string>")
    hits = index.where(F.exists(wanted, lambda w: F.contains(F.col("term"), w)))
    return hits.withColumn("exact", F.array_contains(wanted, F.col("term"))).select(F.explode("parts").alias("part"), "exact").groupBy("part").agg(F.max("exact").alias("exact"))


def has_term(text: Column, terms: list[str]) -> Column:
    """Whether the folded text has any of the terms inside it; blank terms are ignored, none means no filter."""
    return folded_has(casefold(text), terms)


def folded_has(folded: Column, terms: list[str]) -> Column:
    """As has_term, of a text that is folded already: one pass over it, however many terms."""
    wanted = [t.strip().casefold() for t in terms if t and t.strip()]
    if len(wanted) <= 1:
        return F.contains(folded, F.lit(wanted[0])) if wanted else F.lit(True)
    return folded.rlike("|".join(r"\Q" + t.replace(r"\E", r"\E\\E\Q") + r"\E" for t in wanted))


def routed_search(rows: DataFrame, text: Column, part: str, index: DataFrame, terms: list[str]) -> DataFrame:
    """Rows with a term, looked for only in parts that the index leads to."""
    parts = route(index, terms).select(F.col("part").alias(part))
    return rows.where(has_term(text, terms)).join(parts, part, "left_semi")


def coverage(index: DataFrame, titles: DataFrame, title: Column, items: DataFrame, item: Column, terms: list[str]) -> DataFrame:
    """(term, status) for each term: 'title' if a title has it, 'item' if only an item has it, 'index_only' if
    only the index leads somewhere, else 'none'."""
    any_ = lambda cond, name: F.coalesce(F.max(cond), F.lit(False)).alias(name)
    n = range(len(terms))
    # one pass over each table, whatever the number of terms; the three results are one row each
    found = lambda rows, text, name: rows.select(casefold(text).alias("__folded")).agg(*[any_(folded_has(F.col("__folded"), [t]), f"{name}{i}") for i, t in zip(n, terms)])
    a, b = found(titles, title, "a"), found(items, item, "b")
    c = index.agg(*[any_(F.contains(F.col("term"), casefold(F.trim(F.lit(t)))), f"c{i}") for i, t in zip(n, terms)])
    status = lambda i: F.when(F.col(f"a{i}"), "title").when(F.col(f"b{i}"), "item").when(F.col(f"c{i}"), "index_only").otherwise("none")
    return a.crossJoin(b).crossJoin(c).select(F.inline(F.array(*[F.struct(F.lit(t).alias("term"), status(i).alias("status")) for i, t in zip(n, terms)])))


def part_catalog(rows: DataFrame, text: Column, *part: str) -> DataFrame:
    """Records, bytes and estimated tokens of each part."""
    return rows.groupBy(*part).agg(F.count("*").alias("records"), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).alias("bytes"), F.coalesce(F.sum(token_estimate(text)), F.lit(0)).alias("tokens"))


def packed_postings(index: DataFrame) -> DataFrame:
    """The index with each list joined to one string, as it is stored."""
    return index.withColumn("parts", F.concat_ws(",", "parts"))


def shape_sizes(rows: DataFrame, group: list[str], own: Column, *shared: str) -> DataFrame:
    """(group…, repeated_bytes, shared_bytes): what records weigh if each repeats the shared fields, and if each distinct
    combination of these is stored once."""
    size = lambda *c: reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(x), F.lit(0)).cast("long") for x in c])
    each = rows.groupBy(*dict.fromkeys([*group, *shared])).agg(F.sum(size(own)).alias("own"), F.count("*").alias("n")).withColumn("shared", size(*shared))
    return each.groupBy(*group).agg(F.sum(F.col("own") + F.col("n") * F.col("shared")).alias("repeated_bytes"), F.sum(F.col("own") + F.col("shared")).alias("shared_bytes"))
