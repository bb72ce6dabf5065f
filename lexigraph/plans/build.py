"""From source events to curriculum tables: classification, carried state, joins, links and shaping.

The state machine of a document is order-dependent, and documents are independent: events are
classified by expressions, scopes are running counts of resets, and what a scope holds is carried by
windows partitioned by document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import AREA_CODES
from ..functions.text import STEM, match_form, theme_names, unresolved_themes
from ..operators import graph, match, rank
from ..operators.bind import attach_key
from ..session import staged


# fixed values: the four forms of an area heading, as patterns of (number, name)
AREA_FORMS = {
    "numbered": r"^Kompetenzbereich\s+([0-9]+)\s*:\s*(.+?)\s*$",
    "unnumbered": r"^(?:Integrativer\s+)?Kompetenzbereich\s+()(.+)$",
    "plain": r"^Kompetenzbereich\s+()(.+)$",
    "adjective": r"^()(.+\bKompetenzbereich)$",
}
TARGET_LEVEL = r"^In allen vier Kompetenzbereichen wird das Zielniveau (.+?) angestrebt\."


def area_name(heading: Column, form: str) -> Column:
    """(number, name) of an area heading of a form; null for another heading."""
    pattern = AREA_FORMS[form]
    number = F.try_to_number(F.nullif(F.regexp_extract(heading, pattern, 1), F.lit("")), F.lit("99")).cast("int")
    return F.when(heading.rlike(pattern), F.struct(number.alias("number"), F.trim(F.regexp_extract(heading, pattern, 2)).alias("name")))


@dataclass(frozen=True)
class Spec:
    """How a subject's section is laid out: one row of a small configuration table."""

    shard: str
    subject_heading: str
    binding: str
    area_pattern: str = r"^Kompetenzbereich(?: ([0-9]+))?:? (.+)$"
    level_pattern: str = r"^([0-9])[.] (?:Klasse|Schulstufe)"
    content_heading: str = r"^(?:Anwendungsbereiche|Lehrstoff)"
    legend_heading: str = r"^Übergreifende Themen"
    stem_pattern: str = r"^Die Schülerinnen und Schüler können\b.*$"
    optional_items: bool = False


def level_code(shard: str, number):
    return F.concat(F.lit("SCH" if shard.startswith("PRIM") else "K"), number)


def classified(events: DataFrame, spec: Spec) -> DataFrame:
    """Adds token: what an event is to the parser."""
    head = F.col("element") == "ueberschrift"
    text = F.col("text")
    token = (
        F.when(text == "", "abstand")
        .when(head & (text == spec.subject_heading), "fach")
        .when(head & text.rlike(spec.legend_heading), "legende")
        .when(head & text.rlike(spec.content_heading), "inhalt")
        .when(head & text.rlike(spec.level_pattern), "stufe")
        .when(head & text.rlike(spec.area_pattern), "bereich")
        .when(head & (F.col("typ") == "g1"), "anderes_fach")
        .when(head & (F.col("typ") == "erll"), "kopf")
        .when(head, "unbekannt")
        .when(F.col("element") == "td", "zelle")
        .when(text.rlike(spec.stem_pattern), "stamm")
        .when(F.col("element") == "listelem", "eintrag")
        .otherwise("absatz")
    )
    return events.withColumn("token", token)


def placed(events: DataFrame, spec: Spec) -> DataFrame:
    """Adds the state in force at each event: inside the subject, section, level, area and stem, with scopes that reset
    level and area at a section, area at a level, and the stem at any of them."""
    doc, order = ["doc"], ["idx", "pos"]
    is_ = lambda *names: F.col("token").isin(*names)
    e = classified(events, spec)
    e = e.withColumn("subject", rank.carried(F.when(is_("fach"), True).when(is_("anderes_fach"), False), doc, order))
    e = e.where("subject").withColumn("section", F.coalesce(rank.carried(F.when(is_("inhalt"), "inhalt").when(is_("legende"), "legende").when(is_("fach"), "kompetenzen").when(is_("unbekannt"), "anhang"), doc, order), F.lit("kompetenzen")))
    e = e.withColumn("s0", rank.scope_id(doc, order, is_("fach", "inhalt", "legende", "unbekannt")))
    e = e.withColumn("level", rank.carried(F.when(is_("stufe"), level_code(spec.shard, F.regexp_extract("text", spec.level_pattern, 1))), [*doc, "s0"], order))
    e = e.withColumn("s1", rank.scope_id([*doc, "s0"], order, is_("stufe")))
    named = F.struct(F.try_to_number(F.nullif(F.regexp_extract("text", spec.area_pattern, 1), F.lit("")), F.lit("99")).cast("int").alias("number"), F.trim(F.regexp_extract("text", spec.area_pattern, 2)).alias("name"))
    e = e.withColumn("area", rank.carried(F.when(is_("bereich"), named), [*doc, "s0", "s1"], order))
    e = e.withColumn("s2", rank.scope_id([*doc, "s0", "s1"], order, is_("bereich")))
    return e.withColumn("stem", rank.carried(F.when(is_("stamm"), F.col("text")), [*doc, "s0", "s1", "s2"], order))


def area_slugs(rows: DataFrame, shard: str) -> DataFrame:
    """Adds slug: the frozen code of the area name, or the name as an upper-case code."""
    from ..functions.ids import area_code
    from ..functions.text import slug

    return rows.withColumn("slug", F.coalesce(area_code(F.lit(shard), F.col("area.name")), slug(F.col("area.name"))))


def competences(state: DataFrame, spec: Spec) -> DataFrame:
    """Records of list entries under a level, an area and a stem, with ordinals by place and minted ids."""
    from ..functions.ids import mint

    rows = area_slugs(state.where("token = 'eintrag' and section = 'kompetenzen' and level is not null and area is not null"), spec.shard)
    rows = rows.withColumn("ordinal", rank.ordinal(["doc", "slug", "level"], "idx", "pos"))
    band, subject = spec.shard.split(".")
    return rows.select("doc", F.lit(spec.shard).alias("shard"), mint(F.lit(band), F.lit(subject), F.col("slug"), F.col("level"), F.col("ordinal")).alias("id"), F.col("area.number").alias("bereich_nummer"), F.col("area.name").alias("bereich_name"), F.col("slug").alias("bereich_slug"), F.col("level").alias("stufe"), F.try_to_number(F.regexp_extract("level", "([0-9])$", 1), F.lit("9")).cast("int").alias("stufe_nr"), "ordinal", F.coalesce("stem", F.lit("")).alias("stammsatz"), "text", F.when(F.col("roh") != F.col("text"), F.col("roh")).alias("text_roh"), F.array_join("supers", ", ").alias("marker"), "images", "idx", "pos")


def items(state: DataFrame, spec: Spec) -> DataFrame:
    """Entries of the content section with the block that they stand in; binding and repeat markers as flags."""
    rows = area_slugs(state.where("token = 'eintrag' and section = 'inhalt' and level is not null"), spec.shard)
    binding = ~F.col("text").rlike(r"(?i)\ballenfalls\b") if spec.optional_items else F.lit(True)
    rows = rows.withColumn("block_text", F.col("stem")).withColumn("ordinal", rank.ordinal(["doc", "slug", "level"], "idx", "pos"))
    return rows.select("doc", F.lit(spec.shard).alias("shard"), F.col("slug").alias("bereich_slug"), F.col("area.number").alias("bereich_nummer"), F.col("level").alias("stufe"), F.try_to_number(F.regexp_extract("level", "([0-9])$", 1), F.lit("9")).cast("int").alias("stufe_nr"), "ordinal", "text", "block_text", binding.alias("verbindlich"), F.col("text").rlike(r"^\s*Wiederholen\s+und\s+Festigen\s*:").alias("wiederholung"), attach_key(F.lit(spec.binding), F.lit(None).cast("string"), F.col("slug"), F.col("level")).alias("attach_key"), "idx", "pos")


def legend(state: DataFrame) -> DataFrame:
    """(doc, number, name) of the theme table; a section's first entry for a number counts."""
    return legend_entries(state.where("section = 'legende' and token in ('zelle', 'eintrag', 'absatz')"))


def legend_entries(cells: DataFrame) -> DataFrame:
    pairs = cells.select("doc", "idx", "pos", F.regexp_extract("text", r"^([0-9]{1,2})\s*(\D.*)$", 1).alias("number"), F.trim(F.regexp_extract("text", r"^([0-9]{1,2})\s*(\D.*)$", 2)).alias("name")).where("number <> ''")
    return pairs.groupBy("doc", "number").agg(F.min_by("name", F.struct("idx", "pos")).alias("name"))


def with_themes(records: DataFrame, themes: DataFrame) -> DataFrame:
    """Adds the names of each record's markers and the markers that the legend lacks."""
    maps = themes.groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.regexp_replace("number", "^0+(?=[0-9])", "").alias("number"), "name")))).alias("legend"))
    rows = records.join(maps, "doc", "left").withColumn("legend", F.coalesce("legend", F.create_map().cast("map<string,string>")))
    return rows.withColumns({"uebergreifende_themen": theme_names(F.col("marker"), F.col("legend")), "fussnoten_unaufgeloest": unresolved_themes(F.col("marker"), F.col("legend"))}).drop("legend")


def attached_blocks(records: DataFrame, contents: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Each content block joined to its competence within level and area number: equal wording, then the most similar,
    then the same ordinal."""
    blocks = contents.groupBy("doc", "stufe", "bereich_nummer", "block_text").agg(F.min(F.struct("idx", "pos")).alias("at"))
    blocks = blocks.withColumn("ordinal", F.row_number().over(Window.partitionBy("doc", "stufe", "bereich_nummer").orderBy("at"))).withColumn("block", F.concat_ws("|", "doc", F.col("at.idx").cast("string"), F.col("at.pos").cast("string"))).withColumn("form", match_form(F.coalesce("block_text", F.lit("")), STEM))
    right = records.withColumn("form", match_form(F.col("text"), STEM))
    joined = match.cascade_join(blocks, right, ["doc", "stufe", "bereich_nummer"], "block", "form", "ordinal", "id", threshold)
    return joined.join(blocks.select("block", "doc", "stufe", "bereich_nummer", "block_text"), "block")


def linked(records: DataFrame) -> DataFrame:
    """Adds vorlaeufer and folge: ids of the same area one level before and after."""
    p = graph.progression(records, "id", ["shard", "bereich_slug"], "stufe_nr").withColumnsRenamed({"before": "vorlaeufer", "after": "folge"})
    return records.join(p, "id")


def routed(contents: DataFrame, official: DataFrame) -> DataFrame:
    """Adds datei: the part of an item's area if it is an official one, else the extra part."""
    known = official.select("shard", F.col("slug").alias("bereich_slug"), F.lit(True).alias("__known")).distinct()
    rows = contents.join(known, ["shard", "bereich_slug"], "left")
    return rows.withColumn("datei", F.when(F.col("__known"), F.concat(F.lower("bereich_slug"), F.lit(".json"))).otherwise("zusatz.json")).drop("__known")


def counts(records: DataFrame, contents: DataFrame) -> DataFrame:
    """The counts that a build reports and that are held against expected ones."""
    a = records.agg(F.count_distinct("bereich_slug").alias("bereiche"), F.count("*").alias("kompetenzen"), F.count_if(F.size("uebergreifende_themen") > 0).alias("mit_themen"), F.count_if(F.size("fussnoten_unaufgeloest") > 0).alias("unaufgeloest"))
    b = contents.agg(F.count("*").alias("items"), F.count_if(~F.col("verbindlich")).alias("unverbindlich"), F.count_if("wiederholung").alias("wiederholungen"))
    return a.crossJoin(b).select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("measured")) for c in ("bereiche", "kompetenzen", "mit_themen", "unaufgeloest", "items", "unverbindlich", "wiederholungen")])))


def target_levels(state: DataFrame) -> DataFrame:
    """(doc, stufe, niveau, satz, abschnitt, quell_index): the sentence that names a level's target, word for word; of
    several the first."""
    hit = state.where(F.col("level").isNotNull() & F.col("text").rlike(TARGET_LEVEL))
    one = F.struct("idx", "pos", F.regexp_extract("text", TARGET_LEVEL, 1).alias("niveau"), F.regexp_extract("text", TARGET_LEVEL, 0).alias("satz"), F.col("section").alias("abschnitt"))
    first = hit.groupBy("doc", F.col("level").alias("stufe")).agg(F.min(one).alias("x"))
    return first.select("doc", "stufe", "x.niveau", "x.satz", "x.abschnitt", F.col("x.idx").alias("quell_index"))


def with_axis(subjects: DataFrame, axis: str, targets: DataFrame) -> DataFrame:
    """Rows (doc, an axis struct) with the target levels that were found filled in; an axis without a place for them stays
    as it is, and one that got none says so."""
    found = targets.groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stufe", F.struct("niveau", "satz", "abschnitt", "quell_index").alias("v"))))).alias("__levels"))
    levels = F.coalesce("__levels", F.create_map().cast("map<string,struct<niveau:string,satz:string,abschnitt:string,quell_index:int>>"))
    filled = F.col(axis).withField("gers", F.col(axis)["gers"].withField("je_stufe", levels).withField("je_stufe_ausgewiesen", F.size(levels) > 0))
    return subjects.join(found, "doc", "left").withColumn(axis, filled).drop("__levels")  # a null place stays null


def level_blocks(blocks: DataFrame, binding: str) -> DataFrame:
    """(doc, stufe, n) of levels with more than one block, where the binding allows one a level."""
    counted = blocks.groupBy("doc", "stufe").agg(F.count("*").alias("n"))
    return counted.where(F.lit(binding == "stufe") & (F.col("n") > 1))


def issues(state: DataFrame, blocks: DataFrame, themes: DataFrame, spec: Spec) -> DataFrame:
    """(doc, idx, rule, text): what the parser met and could not place."""
    none = F.lit(None).cast("int")
    row = lambda rows, rule, idx, text: rows.select("doc", idx.alias("idx"), F.lit(rule).alias("rule"), text.alias("text"))
    entries = state.where("token = 'eintrag' and section in ('kompetenzen', 'inhalt')")
    named = state.where("token = 'bereich'").select("doc", "idx", "area", "text")
    known = list(AREA_CODES.get(spec.shard, {}))
    out = row(state.where("token = 'unbekannt'"), "unknown-heading", F.col("idx"), F.col("text"))
    out = out.unionByName(row(entries.where("level is null"), "entry-without-level", F.col("idx"), F.col("text")))
    out = out.unionByName(row(entries.where("level is not null and area is null and section = 'kompetenzen'"), "entry-without-area", F.col("idx"), F.col("text")))
    if known:
        out = out.unionByName(row(named.where(~F.col("area.name").isin(*known)), "unmapped-area", F.col("idx"), F.col("area.name")))
    out = out.unionByName(row(level_blocks(blocks, spec.binding), "several-blocks-in-a-level", none, F.concat_ws(" ", "stufe", F.col("n").cast("string"))))
    docs = state.select("doc").distinct()
    return out.unionByName(row(docs.join(themes.select("doc").distinct(), "doc", "left_anti"), "no-theme-legend", none, F.lit(None).cast("string")))


def build(events: DataFrame, spec: Spec) -> dict[str, DataFrame]:
    state = staged(placed(events, spec), "state")
    records = staged(linked(with_themes(competences(state, spec), legend(state))), "records")
    contents = items(state, spec)
    themes, blocks = legend(state), staged(attached_blocks(records, contents), "blocks")
    repeats = graph.back_links(contents.withColumn("key", F.concat_ws("|", "doc", F.col("idx").cast("string"), F.col("pos").cast("string"))), F.col("wiederholung"), records, "key", "id", ["shard", "bereich_slug"], "stufe_nr")
    # an appendix after an unknown heading is kept as it stands
    appendix = state.where("section = 'anhang' and token <> 'unbekannt' and text <> ''").select("doc", "idx", "pos", "element", "text")
    return {"competences": records, "items": contents, "blocks": blocks, "issues": issues(state, blocks, themes, spec), "repeats": repeats, "legend": themes, "targets": target_levels(state), "appendix": appendix}
