"""A regulation's subject from events to tables, with the whole grammar of its sections.

What an event is (a token) depends in two places on where it stands: the word that opens an inline block of items counts
in the competence section alone, and a paragraph names an area in the section of items alone.  Tokens move a machine of
eight states (transducer.py): outside the subject, under the wrong part or the right one; before the first section; in the
competences, the items, or the integrated appendix; after a heading that is none of these; and after the subject, which another subject,
an inserted curriculum or the table of themes ends.  Level, area, stem and open block are registers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import area_code, known_area, mint
from ..functions.text import STEM, slug, theme_sentence
from ..operators import rank
from ..operators.bind import attach_key
from ..session import staged
from ..sources import snapshots
from .build import AREA_FORMS, TARGET_LEVEL, area_name, legend_entries, level_code, with_axis
from .transducer import SEGMENT, Machine, with_registers, with_states

STATES = ("wrong_part", "outside", "preamble", "competences", "items", "integrated", "appendix", "after")
INSIDE, SECTIONS = STATES[2:7], STATES[3:6]
# fixed values: headings of the law that are read as they stand
PARTS = tuple(f"{n} TEIL" for n in ("ERSTER", "ZWEITER", "DRITTER", "VIERTER", "FÜNFTER", "SECHSTER", "SIEBENTER", "ACHTER", "NEUNTER", "ZEHNTER", "ELFTER", "ZWÖLFTER"))
INSERTED, BLOCK, DIGITAL = "LEHRPLANZUSATZ", "Anwendungsbereiche", "Vorschläge für den Einsatz digitaler Technologien"
INTEGRATED, INTEGRATED_AREA = "Kompetenzen für den Mathematik-Lehrplan bei integrativer Führung von Geometrisches Zeichnen", ("Integrative Führung von Geometrisches Zeichnen", "GZINTEGRATIV")
THEMES = "Dieser Lehrplan greift folgende übergreifende Themen auf:"
REPEATED, OPTIONAL = r"^\s*Wiederholen\s+und\s+Festigen\s*:", r"(?i)\ballenfalls\b"


@dataclass(frozen=True)
class Subject:
    """How a subject's section is laid out."""

    shard: str
    heading: str
    part: str | None
    binding: str  # of items: to a competence, an area ("bereich"), a level ("stufe"); "prosa" and "keine" have none
    form: str = "numbered"  # of area headings
    competences: str = r"^Kompetenz(?:bereiche|beschreibungen)\b.*\("
    items: str | None = None  # heading of a section of items, if it has one
    paragraph_areas: bool = False
    optional_items: bool = False
    target_levels: bool = False


def machine(s: Subject) -> Machine:
    ends = {x: "after" for x in INSIDE}
    enter = lambda to: {x: to for x in INSIDE}
    return Machine(STATES, "wrong_part" if s.part else "outside", {
        "right_part": ends | {"wrong_part": "outside"},
        "other_part": ends | ({"outside": "wrong_part"} if s.part else {}),
        "subject": ends | {"outside": "preamble"},
        "other_subject": ends,
        "inserted": ends,
        "table": {x: "after" for x in SECTIONS},
        "competence_section": enter("competences"),
        "item_section": enter("items"),
        "integrated_section": enter("integrated"),
        "other_heading": {x: "appendix" for x in SECTIONS},
    })


def tokens(events: DataFrame, s: Subject) -> DataFrame:
    """Adds token: what an event is, wherever it stands; with_places() settles the two that depend on it."""
    text, typ = F.col("text"), F.col("typ")
    level = text.rlike(r"^[0-9]+[.]\s*(Klasse|Schulstufe)\s*:?\s*$")
    rest = F.regexp_replace(text, STEM, "")
    stem = F.when(rest != text, F.when(F.trim(F.translate(rest, ".:;", "   ")) != "", "sentence").otherwise("stem"))
    heading = (
        F.when(text.startswith(INSERTED), "inserted")
        .when(level, "level")
        .when(text.rlike(s.competences), "competence_section")
        .when(text.rlike(s.items) if s.items else F.lit(False), "item_section")
        .when(text.startswith(INTEGRATED), "integrated_section")
        .when(text.rlike(AREA_FORMS[s.form]), "area")
        .otherwise("other_heading")
    )
    title = F.trim(text)
    group = F.when(title == (s.part or ""), "right_part").when(title.isin(*PARTS), "other_part").when(title == s.heading, "subject").otherwise("other_subject")
    body = F.when(text.rlike(rf"^{BLOCK}\s*:?\s*$"), "inline_block").when(text.rlike(AREA_FORMS[s.form]) & F.lit(s.paragraph_areas), "paragraph_area").when(text.startswith(DIGITAL), "digital").otherwise(F.coalesce(stem, F.lit("text")))
    token = (
        F.when(F.col("element") == "ueberschrift", F.when(typ.isin("g1", "g1min"), group).when(typ == "erll", heading).otherwise("ignored"))
        .when(F.col("element") == "absatz", F.when((typ == "erltext") & level, "level").when(typ == "abs", body).otherwise("text"))
        .when(F.col("element") == "listelem", F.when(stem == "stem", "stem").otherwise("entry"))
        .when(F.col("element") == "td", "table")
        .otherwise("ignored")
    )
    return events.withColumn("token", token)


def with_places(events: DataFrame, s: Subject, segment: int = SEGMENT) -> DataFrame:
    """Events inside the subject with state (that before a table, else that after the event), level, area, stem, block and list, the registers in force;
    and those outside that say something about it."""
    e = with_states(tokens(events, s), machine(s), segment)
    token, state = F.col("token"), F.when(F.col("token") == "table", F.col("before")).otherwise(F.col("after"))
    settled = F.when(token == "inline_block", F.when(state == "competences", "block").otherwise("text")).when(token == "paragraph_area", F.when(state == "items", "area").otherwise("text")).otherwise(token)
    e = e.withColumns({"state": state, "token": settled}).where(F.col("before").isin(*INSIDE) | F.col("after").isin(*INSIDE) | (F.col("token") == "subject"))
    e = e.withColumn("in_list", F.col("element") == "listelem")
    is_ = lambda *names: F.col("token").isin(*names)
    in_ = lambda *names: F.col("state").isin(*names)
    value = lambda c: F.struct(c.alias("value"))
    named, none_area = area_name(F.col("text"), s.form), F.lit(None).cast("struct<number:int,name:string>")
    integrated = F.struct(F.lit(None).cast("int").alias("number"), F.lit(INTEGRATED_AREA[0]).alias("name"))
    none, opened = F.lit(None).cast("string"), F.struct(F.col("idx").alias("idx"), F.col("token").alias("kind"), F.col("text").alias("text"))
    no_block = F.lit(None).cast("struct<idx:int,kind:string,text:string>")
    section = is_("competence_section", "item_section", "integrated_section")
    code = level_code(s.shard, F.regexp_extract("text", "^([0-9]+)", 1))
    writes = {
        "level": F.when(is_("level") & in_("competences", "items", "integrated", "appendix"), value(code)).when(section | is_("other_heading"), value(none)),
        "area": F.when(is_("integrated_section"), value(integrated)).when(section | is_("other_heading"), value(none_area)).when(is_("level") & in_("competences", "items"), value(none_area)).when(is_("area") & in_("competences", "items"), value(named)),
        "stem": F.when(section | is_("other_heading") | is_("level", "area") & in_("competences", "integrated"), value(none)).when(is_("stem") & in_("competences", "integrated") | is_("sentence") & in_("competences"), value(F.col("text"))),
        "block": F.when(section | is_("other_heading", "level", "area"), value(no_block)).when(is_("block") & in_("competences") | is_("sentence", "digital") & in_("items"), value(opened)),
        "section": F.when(is_("competence_section"), value(F.col("text"))),
        "title": F.when(is_("other_heading"), value(F.col("text"))).when(section, value(none)),
        "list": F.when(F.col("in_list"), value(F.col("idx"))).when(section, value(F.lit(None).cast("int"))),
    }
    return with_registers(e, writes, segment, earlier=("list",))


def areas(e: DataFrame, s: Subject) -> DataFrame:
    """(doc, name, number, slug, mapped, idx): areas in order of their first heading; the appendix's own isn't one of them."""
    rows = e.where("token = 'area' and state in ('competences', 'items')")
    first = rows.groupBy("doc", F.col("area.name").alias("name")).agg(F.min(F.struct("idx", "pos", F.col("area.number").alias("number"))).alias("x"))
    code = area_code(F.lit(s.shard), F.col("name"))
    return first.select("doc", "name", "x.number", F.coalesce(code, slug(F.col("name"))).alias("slug"), code.isNotNull().alias("mapped"), "x.idx")


def _slug(s: Subject) -> Column:
    name = F.col("area.name")
    return F.when(name == INTEGRATED_AREA[0], INTEGRATED_AREA[1]).otherwise(F.coalesce(area_code(F.lit(s.shard), name), slug(name)))


def competences(e: DataFrame, s: Subject) -> DataFrame:
    """Entries under a level and an area outside a block of items, the appendix's among them."""
    band, subject = s.shard.split(".")
    rows = e.where("token = 'entry' and state in ('competences', 'integrated') and level is not null and area is not null and (block is null or state = 'integrated')")
    rows = rows.withColumn("slug", _slug(s)).withColumn("ordinal", rank.ordinal(["doc", "slug", "level"], "idx", "pos"))
    return rows.select("doc", mint(F.lit(band), F.lit(subject), F.col("slug"), F.col("level"), F.col("ordinal")).alias("id"), F.col("area.number").alias("bereich_nummer"), F.col("area.name").alias("bereich_name"), F.col("slug").alias("bereich_slug"), F.col("level").alias("stufe"), "ordinal", F.coalesce("stem", F.lit("")).alias("stammsatz"), "text", F.array_join("supers", ", ").alias("marker"), "idx", "pos")


def items(e: DataFrame, s: Subject) -> DataFrame:
    """Entries of the section of items and of inline blocks.  A block holds the first list after it; a digital one gives items of art DT.
    Items of a level have no area."""
    band, subject = s.shard.split(".")
    inline = (F.col("state") == "competences") & F.col("block").isNotNull() & F.lit(s.binding in ("bereich", "stufe"))
    rows = e.where((F.col("token") == "entry") & F.col("level").isNotNull() & ((F.col("state") == "items") | inline))
    open_ = F.col("block").isNotNull() & ((F.col("state") == "competences") | F.col("list").isNull() | (F.col("list") < F.col("block.idx")))
    digital = open_ & (F.col("block.kind") == "digital")
    free = F.lit(s.binding == "stufe") & (F.col("state") == "competences")
    rows = rows.withColumns({"art": F.when(digital, "DT").otherwise("AB"), "slug": F.when(~free, _slug(s)), "block_idx": F.when(open_, F.col("block.idx")), "block_text": F.when(open_ & (F.col("block.kind") == "sentence"), F.col("block.text"))})
    rows = rows.where(free | F.col("area").isNotNull()).withColumn("ordinal", rank.ordinal(["doc", "slug", "level", "art"], "idx", "pos"))
    number = mint(F.lit(band), F.lit(subject), F.col("slug"), F.col("level"), F.col("ordinal"), F.col("art"))
    binding = ~F.col("text").rlike(OPTIONAL) if s.optional_items else F.lit(True)
    return rows.select("doc", number.alias("id"), F.col("slug").alias("bereich_slug"), F.col("level").alias("stufe"), "art", "ordinal", "text", binding.alias("verbindlich"), F.col("text").rlike(REPEATED).alias("wiederholung"), "block_idx", "block_text", attach_key(F.lit(s.binding), F.lit(None).cast("string"), F.col("slug"), F.col("level")).alias("attach_key"), "idx", "pos")


def extras(e: DataFrame) -> DataFrame:
    """(doc, titel, stufe, text, idx, pos): entries after a heading that is no section's, kept as they stand."""
    return e.where("token in ('entry', 'stem') and element = 'listelem' and state = 'appendix'").select("doc", F.coalesce("title", F.lit("")).alias("titel"), F.col("level").alias("stufe"), "text", "idx", "pos")


def subject_themes(e: DataFrame) -> DataFrame:
    """(doc, number, name): the themes that the preamble's sentence lists, the last such sentence counting."""
    said = e.where((F.col("state") == "preamble") & (F.col("token") == "text") & F.col("roh").startswith(THEMES))
    last = said.groupBy("doc").agg(F.max_by("roh", F.struct("idx", "pos")).alias("roh"))
    return last.select("doc", F.inline(theme_sentence(F.substr("roh", F.lit(len(THEMES) + 1)))))


def legend(e: DataFrame) -> DataFrame:
    """(doc, number, name) of the table that ends the subject, or stands in an appendix."""
    return legend_entries(e.where((F.col("element") == "td") & F.col("state").isin(*SECTIONS, "appendix")))


def targets(e: DataFrame) -> DataFrame:
    """(doc, stufe, niveau, satz, abschnitt, quell_index): each level's first target sentence before its areas."""
    hit = e.where(F.col("text").rlike(TARGET_LEVEL) & (F.col("token") == "text") & (F.col("state") == "competences") & F.col("area").isNull() & F.col("level").isNotNull())
    first = hit.groupBy("doc", F.col("level").alias("stufe")).agg(F.min(F.struct("idx", "pos", F.regexp_extract("text", TARGET_LEVEL, 1).alias("niveau"), F.regexp_extract("text", TARGET_LEVEL, 0).alias("satz"), "section")).alias("x"))
    return first.select("doc", "stufe", "x.niveau", "x.satz", F.col("x.section").alias("abschnitt"), F.col("x.idx").alias("quell_index"))


def subjects(e: DataFrame, s: Subject, axis: Column | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """(doc, achse, provenienz): each subject that was found, with its axis of differentiation, the target levels filled in where it has a place for
    them, and where its text comes from by the manifest's row (document) of the name; without an axis or a manifest no such column."""
    rows = e.where("token = 'subject' and before = 'outside'").select("doc").distinct()
    if manifest is not None:
        source = snapshots.provenance(manifest, F.lit(s.part)).select(F.col("document").alias("doc"), "provenienz")
        rows = rows.join(source, "doc", "left")
    return rows if axis is None else with_axis(rows.withColumn("achse", axis), "achse", targets(e))


def issues(e: DataFrame, s: Subject) -> DataFrame:
    """(doc, idx, rule, text): what couldn't be placed, once for each child."""
    is_ = lambda *names: F.col("token").isin(*names)
    in_ = lambda *names: F.col("state").isin(*names)
    entry = is_("entry")
    competence = entry & in_("competences", "integrated") & F.col("block").isNull()
    left = F.col("before").isin("competences", "items")
    rules = {
        "subject-in-wrong-part": is_("subject") & (F.col("before") == "wrong_part"),
        "section-not-closed": is_("subject", "other_subject", "right_part", "other_part", "inserted") & left,
        "unknown-heading": is_("other_heading") & F.col("before").isin(*SECTIONS),
        "unexpected-level-unit": is_("level") & in_(*INSIDE) & ~F.col("text").contains("Schulstufe" if s.shard.startswith("PRIM") else "Klasse"),
        "list-without-context": competence & (F.col("level").isNull() | F.col("area").isNull()),
        "competence-without-stem": competence & F.col("level").isNotNull() & F.col("area").isNotNull() & F.col("stem").isNull(),
        "items-without-level": entry & in_("items") & F.col("level").isNull(),
        "items-without-sentence": entry & in_("items") & (F.col("block").isNull() | F.coalesce(F.col("list") >= F.col("block.idx"), F.lit(False))),
        "sentence-without-area": is_("sentence") & in_("items") & F.col("area").isNull(),
        "bare-stem-among-items": is_("stem") & in_("items"),
        "prose-block": is_("block") & in_("competences") & F.lit(s.binding == "prosa"),
        "block-without-area": is_("block") & in_("competences") & F.col("area").isNull() & F.lit(s.binding == "bereich"),
        "list-in-prose-block": entry & in_("competences") & F.col("block").isNotNull() & F.lit(s.binding == "prosa"),
        "unmapped-area": is_("area") & in_("competences", "items") & ~known_area(F.lit(s.shard), _slug(s)),
        "unhandled-token": is_("digital") & in_("competences", "integrated") | is_("area", "sentence") & in_("integrated"),
    }
    found = F.filter(F.array(*[F.when(F.coalesce(hit, F.lit(False)), F.lit(rule)) for rule, hit in rules.items()]), lambda r: r.isNotNull())
    rows = e.select("doc", "idx", "pos", "text", F.explode(found).alias("rule"))
    return rows.groupBy("doc", "idx", "rule").agg(F.min_by("text", "pos").alias("text")).select("doc", "idx", "rule", "text")


def build(events: DataFrame, s: Subject, segment: int = SEGMENT, axis: Column | None = None, manifest: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of a subject; see subjects() for axis and manifest."""
    e = staged(with_places(events, s, segment), "places")
    out = {"events": e, "areas": areas(e, s), "competences": competences(e, s), "items": items(e, s), "extras": extras(e), "themes": subject_themes(e), "legend": legend(e), "issues": issues(e, s), "subjects": subjects(e, s, axis, manifest)}
    return out | ({"targets": targets(e)} if s.target_levels else {})
