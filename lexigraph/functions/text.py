"""Scalar text functions over columns."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: words that no index holds; compared unfolded with folded tokens
STOP_WORDS = tuple(
    """
    aber alle allem allen aller alles allenfalls allgemeinen also anhand
    auch bzw dabei dadurch dafür damit dass dessen deren dieser diese
    dieses diesem diesen dies doch durch eben einem einen einer eines
    einige einigen einiger etwa gegebenenfalls gegen gemäß gilt hierzu
    hierbei hinsichtlich ihre ihrem ihren ihrer immer indem insbesondere
    jede jedem jeden jeder jedes jeweils jeweilige kann können mithilfe
    muss müssen nach ohne schüler schülerinnen sich sind sofern sollen
    sowie sowohl soweit über unter unterschiedlichen unterschiedlicher
    verschiedene verschiedenen verschiedener viele vielen wenn werden
    wird wobei wodurch wurde wurden zwischen
    """.split()
)
# fixed values: the sentence that opens every competence list
STEM = r"(?i)^\s*Die\s+Sch(?:ü|ue)lerinnen\s+und\s+Sch(?:ü|ue)ler\s+k(?:ö|oe)nnen\b\s*:?\s*"
TOKEN = r"[\p{L}\p{Nl}\p{No}]+"
IMAGE = r"⟦ABB:([^⟧]+)⟧"


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition; needed only where decomposed input is possible."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def ascii_fold(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without marks and non-ASCII signs."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, list[tuple[str, str]], str, str]:
    """Lower-case characters whose folded form is another one: pairs of single ones, those that become several, and two
    patterns of what may be among them: all but the single-byte characters that aren't, which a regular expression looks up in
    one table, and all but the ranges of Latin letters and signs that hold none, which take it ten times as long."""
    odd = [(c, c.casefold()) for c in map(chr, range(0x80, 0x1FFFF)) if c.casefold() != c and c.lower() == c]
    one = [(c, f) for c, f in odd if len(f) == 1]
    edges = [-1, *(ord(c) for c, _ in odd if c < "\u0345"), 0x345]
    safe = "".join(f"\\x{{{a + 1:x}}}-\\x{{{b - 1:x}}}" for a, b in zip(edges, edges[1:]) if a + 1 <= b - 1)
    return "".join(c for c, _ in one), "".join(f for _, f in one), [(c, f) for c, f in odd if len(f) > 1], "[^" + "".join(f"\\x{{{i:x}}}" for i in range(256) if chr(i) not in {c for c, _ in odd}) + "]", f"[^{safe}\\x{{2000}}-\\x{{2bff}}]"


def casefold(text: Column) -> Column:
    """Full Unicode case folding.  Nearly all texts need no more than lower case and ss for ß; only those with one of the
    other characters go through the table, which is made by rule."""
    plain = F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))
    single, folded, several, wide, suspect = _folds()
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(f).alias("f")) for c, f in several])
    full = F.aggregate(pairs, F.translate(plain, single, folded), lambda s, p: F.replace(s, p["c"], p["f"]))
    return F.when(plain.rlike(wide) & plain.rlike(suspect), full).otherwise(plain)


def full_wording(stem: Column, text: Column) -> Column:
    """Stem and text as one sentence; without a stem, the text."""
    return F.trim(F.concat_ws(" ", F.nullif(F.trim(stem), F.lit("")), F.trim(text)))


def match_form(text: Column, stem_pattern: str | None = None) -> Column:
    """The form in which two wordings are compared: dashes, quotes and spaces folded, a leading stem and
    closing signs dropped, casefolded.  Expects composed text."""
    signs, plain = "‐‑‒–—―−„“”‚‘’«»\u00a0\u2002\u2003\u2007\u2009\u202f", "-------" + '"' * 8 + " " * 6
    folded = F.translate(text, signs, plain)
    folded = F.trim(F.regexp_replace(folded, r"\s+", " "))
    if stem_pattern:
        folded = F.regexp_replace(folded, stem_pattern, "")
    return casefold(F.regexp_replace(folded, r"[ .;:,]+$", ""))


def fidelity_form(text: Column) -> Column:
    """Only invisible signs and runs of white space may differ from the source."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[­​﻿]", ""), r"\s+", " "))


def tokens(text: Column, least: int = 4, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Folded letter runs of at least `least` letters, image marks left out."""
    found = F.transform(words(text, least), casefold)
    return F.filter(found, lambda t: ~t.isin(*stop)) if stop else found


def words(text: Column, least: int = 4) -> Column:
    """As tokens, but as they are written: neither folded nor filtered by stop words."""
    plain = F.when(F.contains(text, F.lit("⟦ABB:")), F.regexp_replace(text, IMAGE, " ")).otherwise(text)
    # a run is taken whole, so a shorter one than the least is never a part of one
    return F.regexp_extract_all(plain, F.lit(TOKEN.replace("[", "[a-zA-Z", 1)[:-1] + f"{{{least},}}"), F.lit(0))


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.octet_length(text) / 4)).cast("long")


def title(text: Column, fallback: Column) -> Column:
    """The first heading line, or the fallback."""
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(text, r"(?m)^\s*#+\s*(.+)$", 1)), F.lit("")), fallback)


def front_matter(text: Column) -> Column:
    """Map of the flat `key: value` lines between a leading pair of --- lines."""
    head = F.regexp_extract(text, r"(?s)\A---\s*\n(.*?)\n---", 1)
    pairs = F.filter(F.split(head, "\n"), lambda x: x.rlike(r"^\s*[^:\s][^:]*:"))
    entry = lambda x: F.struct(F.lower(F.trim(F.regexp_extract(x, r"^([^:]+):", 1))).alias("key"), F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)).alias("value"))
    return F.map_from_entries(F.transform(pairs, entry))


def slug(name: Column, most: int = 12) -> Column:
    """Upper-case ASCII slug of an area name; the two reserved codes get a trailing X."""
    plain = F.substring(F.upper(F.regexp_replace(ascii_fold(name), r"[^A-Za-z0-9]", "")), 1, most)
    return F.when(plain.isin("AB", "DT"), F.concat(plain, F.lit("X"))).otherwise(plain)


def plain_slug(name: Column, most: int = 24) -> Column:
    """Upper-case letters and digits of a name; a leading X where it would start with a digit."""
    plain = F.substring(F.upper(F.regexp_replace(name, r"[^A-Za-z0-9]", "")), 1, most)
    return F.when(plain.rlike("^[0-9]"), F.concat(F.lit("X"), plain)).otherwise(plain)


def citation(short_title: Column, part: Column, notice: Column, number: Column, as_of: Column) -> Column:
    """'title, part, notice (NOR: …; Stand: …)', without what is empty."""
    full = lambda c: F.nullif(F.trim(c), F.lit(""))
    where = F.concat_ws(", ", full(short_title), full(part), full(notice))
    inner = F.concat_ws("; ", F.concat(F.lit("NOR: "), full(number)), F.concat(F.lit("Stand: "), full(as_of)))
    return F.trim(F.when(inner != "", F.concat(where, F.lit(" ("), inner, F.lit(")"))).otherwise(where))


def level_family(level: Column) -> Column:
    return F.regexp_extract(level, "^([A-Z]+)", 1)


def level_number(level: Column) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(level, "([0-9]+)$", 1), F.lit("")), F.lit("999999999")).cast("int")


def level_at_least(level: Column, boundary: Column) -> Column:
    """Same family and at least the boundary's number; other families are below."""
    return F.coalesce((level_family(level) == level_family(boundary)) & (level_number(level) >= level_number(boundary)), F.lit(False))


def theme_sentence(text: Column) -> Column:
    """Themes of a sentence like 'Umwelt13, Wirtschafts-, Finanzbildung4.' as (number, name), in order.  Only a comma
    after a number parts two themes; a piece without a number has a null one."""
    # a mark takes the place of the comma, so that names with commas stay whole
    pieces = F.split(F.regexp_replace(F.regexp_replace(F.trim(text), r"\.+$", ""), r"(?<=[0-9]),\s*", "\u241e"), "\u241e")
    return F.transform(F.filter(pieces, lambda p: F.trim(p) != ""), lambda p: F.when(F.trim(p).rlike(r"^.+?[0-9]{1,2}$"), F.struct(F.regexp_extract(F.trim(p), r"^(.+?)([0-9]{1,2})$", 2).alias("number"), F.trim(F.regexp_extract(F.trim(p), r"^(.+?)([0-9]{1,2})$", 1)).alias("name"))).otherwise(F.struct(F.lit(None).cast("string").alias("number"), F.trim(p).alias("name"))))


def theme_names(marker: Column, legend: Column) -> Column:
    """Names of the numbers in a marker like '6, 7' by a legend map, in order, each once."""
    codes = F.transform(F.split(marker, r"\s*,\s*"), lambda c: F.regexp_replace(F.trim(c), "^0+(?=[0-9])", ""))
    return F.array_distinct(F.filter(F.transform(codes, lambda c: F.try_element_at(legend, c)), lambda n: n.isNotNull()))


def unresolved_themes(marker: Column, legend: Column) -> Column:
    codes = F.transform(F.split(marker, r"\s*,\s*"), lambda c: F.regexp_replace(F.trim(c), "^0+(?=[0-9])", ""))
    return F.filter(codes, lambda c: (c != "") & F.try_element_at(legend, c).isNull())
