"""Shard documents: nested JSON parts, read once with a fixed schema into flat tables.

A root holds <band>/<subject>/<part>.json; index.json is derived data and never a part.  Map-typed
fields are declared, as inference would turn their keys into columns."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import full_wording
from ..operators.bind import attach_key

_IMAGE = "ARRAY<STRUCT<token: STRING, datei: STRING, pfad: STRING>>"
_THEMES = "uebergreifende_themen: ARRAY<STRING>, themen_marker_roh: ARRAY<STRING>, fussnoten_unaufgeloest: ARRAY<STRING>"
ITEM = f"STRUCT<id: STRING, bereich_nummer: INT, bereich_name: STRING, stufe: STRING, ordinal: INT, text: STRING, text_roh: STRING, verbindlich: BOOLEAN, art: STRING, kompetenz_id: STRING, wiederholung_von: ARRAY<STRING>, {_THEMES}, abbildungen: {_IMAGE}>"
COMPETENCE = f"STRUCT<id: STRING, bereich_nummer: INT, bereich_name: STRING, stufe: STRING, ordinal: INT, stammsatz: STRING, text: STRING, text_roh: STRING, {_THEMES}, vorlaeufer: ARRAY<STRING>, folge: ARRAY<STRING>, abbildungen: {_IMAGE}, anwendungsbereiche: ARRAY<{ITEM}>>"
SOURCE = "STRUCT<quelle: STRING, kurztitel: STRING, nor: STRING, kundmachung: STRING, anlage: STRING, teil: STRING, stand: STRING>"
AXIS = "STRUCT<typ: STRING, niveaus: ARRAY<STRING>, gilt_ab_stufe: STRING, enrichment_quelle: STRING, spiralprinzip_backlinks: BOOLEAN, quelle: STRING, optional_material: STRING, gers: STRUCT<typ: STRING, referenzrahmen: STRING, niveaus: ARRAY<STRING>, je_stufe_ausgewiesen: BOOLEAN, je_stufe: MAP<STRING, STRUCT<niveau: STRING, satz: STRING, abschnitt: STRING, quell_index: INT>>>>"
META = f"STRUCT<dataset_version: STRING, lehrplan_fassung: STRING, band: STRING, fach: STRUCT<code: STRING, name: STRING>, uebergreifende_themen_fach: ARRAY<STRING>, uebergreifende_themen_legende: MAP<STRING, STRING>, differenzierungs_achse: {AXIS}, anwendungsbereiche_status: STRING, anwendungsbereiche_bindung: STRING, lehrstoff_quelle: STRING, bildungsstandard_bezug: STRING, provenienz: {SOURCE}, anwendungsbereiche_bloecke: MAP<STRING, STRUCT<bindung: STRING, bereich_name: STRING, bereich_slug: STRING, items: ARRAY<{ITEM}>>>>"
PART = f"meta {META}, kompetenzbereiche ARRAY<STRUCT<nummer: INT, slug: STRING, name: STRING, kompetenzen: ARRAY<{COMPETENCE}>>>, zusatzkompetenzen ARRAY<{COMPETENCE}>, digitale_technologien_vorschlaege ARRAY<{ITEM}>, _corrupt_record STRING"
INDEX = f"meta {META}, teile ARRAY<STRUCT<datei: STRING, typ: STRING, nummer: INT, slug: STRING, name: STRING, kompetenzen: INT, anwendungsitems: INT, zusatzkompetenzen: INT, digitale_technologien_vorschlaege: INT, bytes: INT, tokens_approx: INT>>, stichwort_index MAP<STRING, STRING>"


def _read(spark: SparkSession, root: str, schema: str, glob: str) -> DataFrame:
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(root)
    path = F.split(F.col("_metadata.file_path"), "/")
    rows = rows.select("*", F.element_at(path, -1).alias("datei"), F.upper(F.concat_ws(".", F.element_at(path, -3), F.element_at(path, -2))).alias("shard"))
    return rows


def parts(spark: SparkSession, root: str) -> DataFrame:
    """One row for each part document, with its shard and file name; unreadable ones have _corrupt_record."""
    return _read(spark, root, PART, "*.json").where("datei <> 'index.json'")


def stored_index(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, INDEX, "index.json")


def shards(rows: DataFrame) -> DataFrame:
    """(shard, parts): the shards that have parts, and how many."""
    return rows.where("meta is not null").groupBy("shard").agg(F.count("*").alias("parts"))


def competences(rows: DataFrame) -> DataFrame:
    """All competence records of parts, area ones and extra ones, with their area, source and full wording."""
    area = rows.select("shard", "datei", F.col("meta.provenienz").alias("provenienz"), F.explode("kompetenzbereiche").alias("b"))
    inside = area.select("shard", "datei", "provenienz", F.col("b.nummer").alias("bereich_nummer"), F.col("b.slug").alias("bereich_slug"), F.col("b.name").alias("bereich_name"), F.lit(False).alias("ist_zusatz"), F.explode("b.kompetenzen").alias("k"))
    extra = rows.select("shard", "datei", F.col("meta.provenienz").alias("provenienz"), F.explode("zusatzkompetenzen").alias("k"))
    none = F.lit(None).cast("string")
    extra = extra.select("shard", "datei", "provenienz", F.col("k.bereich_nummer").alias("bereich_nummer"), none.alias("bereich_slug"), F.col("k.bereich_name").alias("bereich_name"), F.lit(True).alias("ist_zusatz"), "k")
    out = inside.unionByName(extra)
    slug = F.coalesce("bereich_slug", F.get(F.split("k.id", "[.]"), F.lit(4)))
    fields = ("id", "stufe", "ordinal", "stammsatz", "text", "text_roh", "uebergreifende_themen", "themen_marker_roh", "fussnoten_unaufgeloest", "vorlaeufer", "folge", "abbildungen", "anwendungsbereiche")
    return out.select("shard", "datei", "provenienz", "bereich_nummer", slug.alias("bereich_slug"), "bereich_name", "ist_zusatz", *[F.col(f"k.{f}").alias(f) for f in fields], full_wording(F.coalesce("k.stammsatz", F.lit("")), F.coalesce("k.text", F.lit(""))).alias("volltext"))


def items(rows: DataFrame) -> DataFrame:
    """Application items of the four places that hold them, each id once: the last place of a part wins, and the
    same block repeated in several parts counts once."""
    nested = competences(rows).select("shard", "datei", F.lit(0).alias("place"), F.col("id").alias("owner"), "bereich_slug", "stufe", F.posexplode("anwendungsbereiche").alias("pos", "i"))
    block = rows.select("shard", "datei", F.explode("meta.anwendungsbereiche_bloecke").alias("key", "b"))
    blocks = block.select("shard", "datei", F.lit(2).alias("place"), F.lit(None).cast("string").alias("owner"), F.col("b.bereich_slug").alias("bereich_slug"), F.element_at(F.split("key", "[.]"), -1).alias("stufe"), F.posexplode("b.items").alias("pos", "i"))
    digital = rows.select("shard", "datei", F.lit(3).alias("place"), F.lit(None).cast("string").alias("owner"), F.lit(None).cast("string").alias("bereich_slug"), F.lit(None).cast("string").alias("stufe"), F.posexplode("digitale_technologien_vorschlaege").alias("pos", "i"))
    every = nested.unionByName(blocks).unionByName(digital)
    last = F.row_number().over(Window.partitionBy("shard", "i.id").orderBy(F.desc("place"), F.desc("datei"), F.desc("pos")))
    once = every.withColumn("__n", last).where("__n = 1")
    meta = shard_meta(rows).select("shard", "bindung")
    bound = once.join(meta, "shard")
    key = attach_key(F.col("bindung"), F.coalesce("i.kompetenz_id", "owner"), F.col("bereich_slug"), F.coalesce("stufe", "i.stufe"))
    fields = ("id", "ordinal", "text", "text_roh", "verbindlich", "art", "kompetenz_id", "wiederholung_von", "uebergreifende_themen", "abbildungen")
    return bound.select("shard", "datei", "bindung", F.when(F.col("place") < 3, key).alias("attach_key"), "bereich_slug", F.col("i.stufe").alias("stufe"), "pos", *[F.col(f"i.{f}").alias(f) for f in fields])


def shard_meta(rows: DataFrame) -> DataFrame:
    """One row a shard: the meta block that its parts share."""
    m = "meta."
    wanted = {"band": "band", "fach_code": "fach.code", "fach_name": "fach.name", "bindung": "anwendungsbereiche_bindung", "lehrstoff_quelle": "lehrstoff_quelle", "bildungsstandard_bezug": "bildungsstandard_bezug", "anwendungsbereiche_status": "anwendungsbereiche_status", "themen_fach": "uebergreifende_themen_fach", "achse": "differenzierungs_achse", "provenienz": "provenienz"}
    flat = rows.where("meta is not null").select("shard", "datei", *[F.col(m + path).alias(name) for name, path in wanted.items()], F.to_json(F.col("meta.uebergreifende_themen_legende")).alias("legende"))
    return flat.groupBy("shard").agg(F.min_by(F.struct(*wanted, "legende"), "datei").alias("m")).select("shard", *[F.col(f"m.{n}").alias(n) for n in wanted], F.from_json("m.legende", "map<string,string>").alias("themen_legende"))


def areas(rows: DataFrame) -> DataFrame:
    """Areas with a stable order: numbered ones by number, then by slug."""
    a = rows.select("shard", "datei", F.inline("kompetenzbereiche")).select("shard", "datei", "nummer", "slug", "name").distinct()
    return a.withColumn("rang", F.row_number().over(Window.partitionBy("shard").orderBy(F.col("nummer").asc_nulls_last(), "slug")))


def words(rows: DataFrame) -> DataFrame:
    """(shard, datei, text): every text that the keyword index reads; raw texts are not among them."""
    k = competences(rows)
    own = k.select("shard", "datei", F.concat_ws(" ", "stammsatz", "text").alias("text"))
    nested = k.select("shard", "datei", F.explode("anwendungsbereiche.text").alias("text"))
    blocks = rows.select("shard", "datei", F.explode(F.map_values("meta.anwendungsbereiche_bloecke")).alias("b")).select("shard", "datei", F.explode("b.items.text").alias("text"))
    digital = rows.select("shard", "datei", F.explode("digitale_technologien_vorschlaege.text").alias("text"))
    return own.unionByName(nested).unionByName(blocks).unionByName(digital)


def projected(*fields: Column | str) -> Column:
    """A record as JSON with the given fields, without those that it doesn't have."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})


@dataclass
class Tables:
    parts: DataFrame
    competences: DataFrame
    items: DataFrame
    meta: DataFrame
    areas: DataFrame


def flat(rows: DataFrame) -> Tables:
    """The tables of parts; unreadable ones have no records."""
    good = rows.where("_corrupt_record is null")
    return Tables(rows, competences(good), items(good), shard_meta(good), areas(good))


def tables(spark: SparkSession, root: str) -> Tables:
    return flat(parts(spark, root))


def store(found: Tables, folder: str) -> None:
    """The flat tables as Parquet.  Documents are parsed once, for the parts; the other tables, which scan them up to
    five times each, are made from the stored parts, as are all queries that follow."""
    found.parts.write.parquet(f"{folder}/parts")
    own = flat(found.parts.sparkSession.read.schema(found.parts.schema).parquet(f"{folder}/parts"))
    for f in fields(Tables)[1:]:
        getattr(own, f.name).write.parquet(f"{folder}/{f.name}")


def stored(spark: SparkSession, folder: str) -> Tables:
    return Tables(*[spark.read.parquet(f"{folder}/{f.name}") for f in fields(Tables)])


def slim_images(images: Column) -> Column:
    """Image entries without what the registry holds."""
    return F.transform(images, lambda a: F.struct(a["token"].alias("token"), a["datei"].alias("datei"), a["pfad"].alias("pfad")))
