"""Hierarchical identifiers: grammars, parsing into columns, minting and validation."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the frozen vocabulary of the identifier grammars
BANDS = {"PRIM": ("D", "M", "SU"), "SEK1": ("D", "E", "M")}
LEVELS = {"PRIM": "SCH[1-4]", "SEK1": "K[1-4]"}
AREA_CODES = {
    "SEK1.M": {"Zahlen und Maße": "ZAHLEN", "Variablen und Funktionen": "VARIABLEN", "Figuren und Körper": "FIGUREN", "Daten und Zufall": "DATEN", "Integrative Führung von Geometrisches Zeichnen": "GZINTEGRATIV"},
    "SEK1.D": {"Zuhören und Sprechen": "HOERENSPRECHEN", "Lesen": "LESEN", "Schreiben": "SCHREIBEN", "Sprachbewusstsein und Sprachreflexion": "SPRACHREFLEXION"},
    "SEK1.E": {"Hören": "HOEREN", "Lesen": "LESEN", "Sprechen (an Gesprächen teilnehmen und zusammenhängend sprechen)": "SPRECHEN", "Schreiben": "SCHREIBEN"},
    "PRIM.M": {"Zahlen und Daten": "ZAHLENDATEN", "Operationen": "OPERATIONEN", "Größen": "GROESSEN", "Ebene und Raum": "EBENERAUM"},
    "PRIM.D": {"(Zu-)Hören und Sprechen": "HOERENSPRECHEN", "Lesen": "LESEN", "Verfassen von Texten": "VERFASSEN", "(Recht-)Schreiben und Sprachbetrachtung": "RECHTSCHREIBEN"},
    "PRIM.SU": {"Sozialwissenschaftlicher Kompetenzbereich": "SOZIALWISS", "Naturwissenschaftlicher Kompetenzbereich": "NATURWISS", "Geografischer Kompetenzbereich": "GEOGRAFIE", "Historischer Kompetenzbereich": "HISTORISCH", "Technischer Kompetenzbereich": "TECHNIK", "Wirtschaftlicher Kompetenzbereich": "WIRTSCHAFT"},
}
_AREA = "(?!(?:AB|DT)[.])[A-Z][A-Z0-9]*"


@dataclass(frozen=True)
class Grammar:
    """A pattern with one group for each named part."""

    name: str
    pattern: str
    parts: tuple[str, ...]


def _curriculum(kind: str, middle: str, parts: tuple[str, ...]) -> Grammar:
    ahead = re.sub(r"\((?!\?)", "(?:", middle)  # the look-ahead must not count as groups
    heads = "|".join(f"{band}[.](?:{'|'.join(subjects)})[.]{ahead}[.]{LEVELS[band]}[.]" for band, subjects in BANDS.items())
    return Grammar(kind, rf"^AT[.]LP23[.](?={heads})(PRIM|SEK1)[.](D|E|M|SU)[.]{middle}[.]((?:K|SCH)[1-4])[.]([0-9]{{2}})$", parts)


COMPETENCE = _curriculum("competence", f"({_AREA})", ("band", "subject", "area", "level", "ordinal"))
ITEM = _curriculum("item", f"(AB|DT)[.]({_AREA})", ("band", "subject", "art", "area", "level", "ordinal"))
AREA_FREE_ITEM = _curriculum("area_free_item", "(AB|DT)", ("band", "subject", "art", "level", "ordinal"))
DESCRIPTOR = Grammar("descriptor", r"^AT[.]BIST[.](?!E[.]SCH4)(D|M|E)[.](SCH4|SCH8)[.]([A-Z][A-Z0-9]*)[.]([0-9]{2})$", ("subject", "level", "area", "ordinal"))
GRAMMARS = (COMPETENCE, ITEM, AREA_FREE_ITEM, DESCRIPTOR)


def matches(value: Column, grammar: Grammar) -> Column:
    return F.coalesce(value.rlike(grammar.pattern), F.lit(False))


def kind(value: Column) -> Column:
    """Name of the grammar that a value follows, or null."""
    out = F.lit(None).cast("string")
    for g in reversed(GRAMMARS):
        out = F.when(matches(value, g), g.name).otherwise(out)
    return out


def parse(df: DataFrame, column: str, *grammars: Grammar) -> DataFrame:
    """Adds kind, and each part that any of the grammars has; parts that don't apply are null."""
    grammars = grammars or GRAMMARS
    value = F.col(column)
    which = F.coalesce(*[F.when(matches(value, g), g.name) for g in grammars])
    columns: dict[str, Column] = {"kind": which}
    for part in dict.fromkeys(p for g in grammars for p in g.parts):
        got = F.coalesce(*[F.when(matches(value, g), F.regexp_extract(value, g.pattern, g.parts.index(part) + 1)) for g in grammars if part in g.parts])
        columns[part] = got.cast("int") if part == "ordinal" else got
    return df.withColumns(columns)


def mint(band: Column, subject: Column, area: Column, level: Column, ordinal: Column, art: Column | None = None) -> Column:
    """An identifier from its parts; null where it would not parse back to them."""
    number = F.lpad(ordinal.cast("string"), 2, "0")
    out = F.concat_ws(".", F.lit("AT"), F.lit("LP23"), band, subject, *([art] if art is not None else []), area, level, number)
    legal = matches(out, COMPETENCE) if art is None else matches(out, ITEM) | matches(out, AREA_FREE_ITEM)
    return F.when(legal & (ordinal < 100), out)


def mint_descriptor(subject: Column, level: Column, area: Column, ordinal: Column) -> Column:
    out = F.concat_ws(".", F.lit("AT"), F.lit("BIST"), subject, level, area, F.lpad(ordinal.cast("string"), 2, "0"))
    return F.when(matches(out, DESCRIPTOR) & (ordinal < 100), out)


def validate(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """(value, rule, n) of malformed values, and of well-formed ones that occur more than once."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    legal = F.coalesce(F.col("value").rlike(pattern), F.lit(False))
    rule = F.when(~legal, "malformed-id").when(F.col("n") > 1, "id-collision")
    return counted.withColumn("rule", rule).where("rule is not null").select("value", "rule", "n")


def area_code(shard: Column, name: Column) -> Column:
    """The frozen code of an area name, or null."""
    table = F.create_map(*[F.lit(x) for sh, codes in AREA_CODES.items() for n, c in codes.items() for x in (f"{sh}|{n}", c)])
    return F.try_element_at(table, F.concat_ws("|", shard, name))


def known_area(shard: Column, code: Column) -> Column:
    """Whether a code is one of the shard's frozen codes."""
    legal = F.array(*[F.lit(f"{sh}|{c}") for sh, codes in AREA_CODES.items() for c in codes.values()])
    return F.array_contains(legal, F.concat_ws("|", shard, code))
