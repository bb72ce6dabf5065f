"""Educational standards from source events: areas, stems and descriptors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import mint_descriptor
from ..functions.text import plain_slug
from ..operators import rank

_AXES = r"Handlungsbereich[:\s]+[„\"]?([^“”\",;]+?)[“”\"]?\s*[,;–-]\s*Inhaltsbereich[:\s]+[„\"]?([^“”\"]+?)[“”\"]?\s*$"
_STEM = r"^(.*\bkönnen)\s*:?\s*$"


def axes(heading: Column) -> Column:
    """The two axes of a matrix heading, or null."""
    return F.when(heading.rlike(_AXES), F.struct(F.trim(F.regexp_extract(heading, _AXES, 1)).alias("handlung"), F.trim(F.regexp_extract(heading, _AXES, 2)).alias("inhalt")))


def area_code(heading: Column, actions: dict[str, str], contents: dict[str, str]) -> Column:
    """A matrix heading's code by its axes' codes, joined; another heading's slug."""
    pick = lambda table, key: F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key) if table else F.lit(None).cast("string")
    both = axes(heading)
    return F.coalesce(F.concat(pick(actions, both["handlung"]), pick(contents, both["inhalt"])), plain_slug(F.regexp_replace(heading, r"^[0-9.]+\s*", "")))


def split_stem(text: Column) -> Column:
    """(stem, text) of a descriptor that is a whole sentence with its own stem before a colon."""
    own = r"^(.{3,120}?\bkönnen)\s*:\s*(.+)$"
    return F.when(text.rlike(own), F.struct(F.regexp_extract(text, own, 1).alias("stem"), F.regexp_extract(text, own, 2).alias("text"))).otherwise(F.struct(F.lit(None).cast("string").alias("stem"), text.alias("text")))


def descriptors(events: DataFrame, subject: str, level: str, actions: dict[str, str] | None = None, contents: dict[str, str] | None = None) -> DataFrame:
    """Descriptors of a document's list entries under area headings, with ordinals by place and minted ids; a stem
    is carried to later entries of its area, and a heading resets it."""
    doc, order = ["doc"], ["idx", "pos"]
    heading = F.col("element") == "ueberschrift"
    e = events.where("text <> ''").withColumn("area", rank.carried(F.when(heading, F.col("text")), doc, order)).withColumn("scope", rank.scope_id(doc, order, heading))
    e = e.withColumn("stem", rank.carried(F.when((F.col("element") != "listelem") & F.col("text").rlike(_STEM), F.regexp_extract("text", _STEM, 1)), [*doc, "scope"], order))
    rows = e.where("element = 'listelem' and area is not null").withColumn("s", split_stem(F.col("text"))).withColumn("code", area_code(F.col("area"), actions or {}, contents or {}))
    rows = rows.withColumn("ordinal", rank.ordinal([*doc, "code"], *order))
    return rows.select("doc", mint_descriptor(F.lit(subject), F.lit(level), F.col("code"), F.col("ordinal")).alias("id"), F.lit(subject).alias("fach"), F.lit(level).alias("programmstufe"), F.col("code").alias("bereich_code"), F.col("area").alias("ueberschrift_roh"), F.coalesce("s.stem", "stem", F.lit("")).alias("stammsatz"), F.col("s.text").alias("text"), "ordinal")


def documents(rows: DataFrame, names: DataFrame, source: Column) -> DataFrame:
    """(file, value): descriptors as one JSON document for each subject and level, with the areas (bereich_code, name) that
    it has, in order of their codes, and where it comes from."""
    code = F.concat(F.lower("fach"), F.regexp_extract("programmstufe", "([0-9])$", 1))
    fields = ("id", "fach", "programmstufe", "bereich_code", "stammsatz", "text", "ordinal")
    areas = rows.select("fach", "programmstufe", "bereich_code").distinct().join(names, "bereich_code", "left")
    areas = areas.groupBy("fach", "programmstufe").agg(F.array_sort(F.collect_list(F.struct(F.col("bereich_code").alias("code"), "name"))).alias("kompetenzbereiche"))
    listed = rows.groupBy("fach", "programmstufe").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("deskriptoren"))
    meta = F.struct(F.upper(code).alias("shard"), "programmstufe", source.alias("provenienz"))
    return listed.join(areas, ["fach", "programmstufe"]).select(F.concat(code, F.lit(".json")).alias("file"), F.to_json(F.struct(meta.alias("meta"), "kompetenzbereiche", "deskriptoren")).alias("value"))
