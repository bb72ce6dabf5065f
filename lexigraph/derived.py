"""A curriculum made from the driver's tables, so that sources, plans and rules can be held against SQL.

Parts become competence records, and items hang on them as each shard's binding says.  The records and
items are one SQL text that Spark and the SQL counterparts share; everything after that (documents, files, XML,
lessons) is written by the engine's own sinks and read by its own sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import standards
from .session import shared_dir, table
from .sources.publish import publish

SHARDS = ("PRIM.D", "PRIM.M", "PRIM.SU", "SEK1.D", "SEK1.E", "SEK1.M")
BINDINGS = ("bereich", "keine", "stufe", "bereich", "prosa", "kompetenz")
SOURCES = ("aus_anwendungsbereichen", "eigen_ausgewiesen", "aus_anwendungsbereichen", "aus_anwendungsbereichen", "aus_anwendungsbereichen", "aus_anwendungsbereichen")
THEMES = (("Umwelt", "Sprache"), ("Umwelt",), ("Sprache",), ("Medien", "Sprache"), ("Medien",), ("Verkehr", "Umwelt"))


def _pick(names: tuple[str, ...], by: str = "s") -> str:
    return f"CASE {by} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


#: r: a record for each part.  49 ordinals, four levels and six shards; then the next area
RECORDS = f"""r0 AS (SELECT p_partkey AS k, p_name, p_type, p_partkey % 6 AS s, CAST(floor(p_partkey / 6) AS BIGINT) % 4 + 1 AS l,
    CAST(floor(p_partkey / 24) AS BIGINT) % 49 + 1 AS o, CAST(floor(p_partkey / 1176) AS BIGINT) AS a FROM {{part}}),
  r1 AS (SELECT *, {_pick(SHARDS)} AS shard, {_pick(BINDINGS)} AS bindung, 'A' || CAST(a AS STRING) AS slug, CASE WHEN s < 3 THEN 'SCH' ELSE 'K' END || CAST(l AS STRING) AS stufe FROM r0),
  r AS (SELECT *, 'AT.LP23.' || shard || '.' || slug || '.' || stufe || '.' || lpad(CAST(o AS STRING), 2, '0') AS id,
    CASE WHEN l > 1 THEN 'AT.LP23.' || shard || '.' || slug || '.' || CASE WHEN s < 3 THEN 'SCH' ELSE 'K' END || CAST(l - 1 AS STRING) || '.' || lpad(CAST(o AS STRING), 2, '0') END AS before_id,
    'Bereich ' || CAST(a AS STRING) AS area_name, CASE WHEN s % 2 = 0 THEN a + 1 END AS nummer, CASE WHEN k % 5 = 0 THEN '' ELSE 'Die Kinder können' END AS stem,
    p_name || CASE WHEN k % 10 = 7 THEN ' ⟦ABB:bild' || CAST(k % 4 AS STRING) || '.png⟧' ELSE '' END AS wording, lower(slug) || '.json' AS datei FROM r1)"""
#: i: items of the three bindings that have any; place tells which document field holds them
ITEMS = """j AS (SELECT r.*, n FROM r CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2 AS n) x WHERE s = 5 AND n <= k % 3),
  i AS (SELECT k, shard, datei, slug, stufe, id AS owner, 'AT.LP23.' || shard || '.AB.' || slug || '.' || stufe || '.' || lpad(CAST((o - 1) * 2 + n AS STRING), 2, '0') AS item_id, id AS attach_key,
      p_type || ' ' || CAST(n AS STRING) AS item_text, n = 1 AS verbindlich, CASE WHEN n = 2 AND k % 7 = 0 THEN 'digitale_technologien' ELSE 'praezisierung' END AS art, (o - 1) * 2 + n AS ordinal, 'nested' AS place FROM j
    UNION ALL SELECT k, shard, datei, slug, stufe, NULL, 'AT.LP23.' || shard || '.AB.' || slug || '.' || stufe || '.' || lpad(CAST(o AS STRING), 2, '0'), slug || '.' || stufe, p_type || ' ' || p_name, true, 'praezisierung', o, 'block'
      FROM r WHERE bindung = 'bereich' AND o % 3 = 1
    UNION ALL SELECT k, shard, NULL, NULL, stufe, NULL, 'AT.LP23.' || shard || '.AB.' || stufe || '.' || lpad(CAST(o AS STRING), 2, '0'), stufe, p_name || ' im Jahr', true, 'praezisierung', o, 'year'
      FROM r WHERE bindung = 'stufe' AND a = 0 AND o % 4 = 1)"""


def sql(body: str) -> str:
    """A counterpart: the body with records r and items i before it."""
    return _after(f"WITH {RECORDS.format(part='part')},\n{ITEMS}", body)


def _after(tables: str, body: str) -> str:
    """A query, or further named tables and a query, after the tables."""
    return tables + (",\n" if body.split()[1].upper() == "AS" else "\n") + body


def records(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(f"WITH {RECORDS} SELECT * FROM r", part=table(spark, d, "part", "p_partkey", "p_name", "p_type"))


def items(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(f"WITH {RECORDS}, {ITEMS} SELECT * FROM i", part=table(spark, d, "part", "p_partkey", "p_name", "p_type"))


def _item():
    return F.struct(F.col("item_id").alias("id"), F.col("stufe"), F.col("ordinal").cast("int").alias("ordinal"), F.col("item_text").alias("text"), "verbindlich", "art", F.col("owner").alias("kompetenz_id"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    """(shard, datei, value): the parts as JSON documents, an area each."""
    r, i = records(spark, d), items(spark, d)
    nested = i.where("place = 'nested'").groupBy("owner").agg(F.array_sort(F.collect_list(_item())).alias("anwendungsbereiche")).withColumnRenamed("owner", "id")
    r = r.join(nested, "id", "left")
    after = F.when(F.col("l") < 4, F.concat(F.lit("AT.LP23."), "shard", F.lit("."), "slug", F.lit("."), F.when(F.col("s") < 3, "SCH").otherwise("K"), (F.col("l") + 1).cast("string"), F.lit("."), F.lpad(F.col("o").cast("string"), 2, "0")))
    refs = lambda *c: F.filter(F.array(*c), lambda x: x.isNotNull())
    image = F.regexp_extract("wording", "⟦ABB:([^⟧]+)⟧", 1)
    # a few records break rules: a reference to nothing, an image without an entry, an entry without an image
    images = F.when(F.col("k") % 30 == 7, F.array()).when(F.col("k") % 50 == 11, F.array(F.struct(F.lit("x").alias("token"), F.lit("fremd.png").alias("datei")))).when(image != "", F.array(F.struct(image.alias("token"), image.alias("datei")))).otherwise(F.array())
    one = F.struct(F.col("id"), F.col("stufe"), F.col("o").cast("int").alias("ordinal"), F.col("stem").alias("stammsatz"), F.col("wording").alias("text"), refs(F.when(F.col("k") % 4 == 0, F.lit("Umwelt"))).alias("uebergreifende_themen"), refs("before_id", F.when(F.col("k") % 97 == 5, F.lit("AT.LP23.SEK1.M.NICHTS.K1.01"))).alias("vorlaeufer"), refs(after).alias("folge"), images.alias("abbildungen"), F.coalesce("anwendungsbereiche", F.array()).alias("anwendungsbereiche"))
    parts = r.groupBy("shard", "s", "slug", "area_name", "nummer", "bindung", "datei").agg(F.array_sort(F.collect_list(F.struct("l", "o", one.alias("r")))).alias("k"))
    of_area = i.where("place = 'block'").groupBy("shard", "slug", "stufe").agg(F.array_sort(F.collect_list(_item())).alias("items"))
    of_area = of_area.groupBy("shard", "slug").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat_ws(".", "slug", "stufe").alias("key"), F.struct(F.lit("bereich").alias("bindung"), F.col("slug").alias("bereich_slug"), "items").alias("value"))))).alias("area_blocks"))
    of_year = i.where("place = 'year'").groupBy("shard", "stufe").agg(F.array_sort(F.collect_list(_item())).alias("items"))
    of_year = of_year.groupBy("shard").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("stufe").alias("key"), F.struct(F.lit("stufe").alias("bindung"), F.lit(None).cast("string").alias("bereich_slug"), "items").alias("value"))))).alias("year_blocks"))
    parts = parts.join(of_area, ["shard", "slug"], "left").join(of_year, "shard", "left")
    pick = lambda names: F.element_at(F.array(*[F.array(*map(F.lit, n)) if isinstance(n, tuple) else F.lit(n) for n in names]), (F.col("s") + 1).cast("int"))
    axis = F.struct(F.lit("standard_standardplus").alias("typ"), F.array(F.lit("Standard"), F.lit("Standard plus")).alias("niveaus"), F.when(F.col("s") >= 3, "K2").otherwise("SCH3").alias("gilt_ab_stufe"), F.when(F.col("s") == 5, "allenfalls").alias("enrichment_quelle"))
    source = F.struct(F.lit("Amtsblatt").alias("quelle"), F.lit("Lehrplan").alias("kurztitel"), F.concat(F.lit("NOR"), F.col("s").cast("string")).alias("nor"))
    meta = F.struct(F.split("shard", "[.]")[0].alias("band"), F.struct(F.split("shard", "[.]")[1].alias("code"), F.concat(F.lit("Fach "), F.split("shard", "[.]")[1]).alias("name")).alias("fach"), pick(THEMES).alias("uebergreifende_themen_fach"), axis.alias("differenzierungs_achse"), F.col("bindung").alias("anwendungsbereiche_bindung"), pick(SOURCES).alias("lehrstoff_quelle"), F.when(F.col("s") == 2, "keine_verordnung").otherwise("verordnet").alias("bildungsstandard_bezug"), source.alias("provenienz"), F.coalesce("area_blocks", "year_blocks").alias("anwendungsbereiche_bloecke"))
    area = F.struct(F.col("nummer").cast("int").alias("nummer"), "slug", F.col("area_name").alias("name"), F.transform("k", lambda x: x["r"]).alias("kompetenzen"))
    return parts.select("shard", "datei", F.to_json(F.struct(meta.alias("meta"), F.array(area).alias("kompetenzbereiche"))).alias("value"))


def indexes(spark: SparkSession, d: str) -> DataFrame:
    """Stored indexes of all shards but one: counts of each part, one of them stale."""
    r = records(spark, d).where("shard <> 'SEK1.E'").groupBy("shard", "datei", "slug").agg(F.count("*").cast("int").alias("kompetenzen"))
    stale = F.when((F.col("shard") == "PRIM.D") & (F.col("datei") == "a0.json"), F.col("kompetenzen") + 1).otherwise(F.col("kompetenzen"))
    listed = r.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("datei", "slug", stale.alias("kompetenzen")))).alias("teile"))
    return listed.select("shard", F.lit("index.json").alias("datei"), F.to_json(F.struct("teile")).alias("value"))


_roots: dict[tuple[str, str, str], str] = {}


def made(spark: SparkSession, d: str, name: str, write) -> str:
    """The folder that write(folder) filled for a set of tables, written once in an application."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _roots:
        folder = f"{shared_dir(spark)}/lexigraph/{name}-{uuid.uuid4().hex}"
        write(folder)
        _roots[key] = folder
    return _roots[key]


def root(spark: SparkSession, d: str) -> str:
    """A data root <band>/<subject>/<part>.json written by the engine's own sink."""

    def write(folder: str) -> None:
        publish(documents(spark, d).unionByName(indexes(spark, d)).select(F.concat_ws("/", F.lower(F.replace("shard", F.lit("."), F.lit("/"))), "datei").alias("file"), "value"), folder)

    return made(spark, d, "root", write)


#: e: the events of one XML document for each area of SEK1.M; g orders the children of a document, pos what is in one
EVENTS = """d AS (SELECT DISTINCT a, slug, area_name, lower(slug) || '.xml' AS doc FROM r WHERE s = 5),
  dl AS (SELECT DISTINCT d.*, l FROM d JOIN r USING (a) WHERE s = 5),
  q AS (SELECT d.doc, d.area_name, r.*, p_name || ' ' || lpad(CAST(o AS STRING), 2, '0') AS entry FROM d JOIN r USING (a) WHERE r.s = 5),
  e0 AS (SELECT doc, 0 AS g, 0 AS pos, 'ueberschrift' AS element, 'g1' AS typ, 'Mathematik' AS text, '' AS sup FROM d
    UNION ALL SELECT doc, 1, 0, 'ueberschrift', 'erll', 'Kurztitel', '' FROM d
    UNION ALL SELECT doc, 2, 0, 'absatz', 'abs', 'Lehrplan ' || doc, '' FROM d
    UNION ALL SELECT doc, 1000000 + l * 10000, 0, 'ueberschrift', 'g2', CAST(l AS STRING) || '. Klasse', '' FROM dl
    UNION ALL SELECT doc, 1000000 + l * 10000 + 1, 0, 'ueberschrift', 'g3', 'Kompetenzbereich 1: ' || area_name, '' FROM dl
    UNION ALL SELECT doc, 1000000 + l * 10000 + 2, 0, 'absatz', 'abs', 'Die Schülerinnen und Schüler können', '' FROM dl
    UNION ALL SELECT doc, 1000000 + l * 10000 + 3, row_number() OVER (PARTITION BY doc, l ORDER BY o) - 1, 'listelem', NULL, entry, CASE k % 4 WHEN 0 THEN '6' WHEN 1 THEN '99' ELSE '' END FROM q
    UNION ALL SELECT doc, 2000000, 0, 'ueberschrift', 'g2', 'Anwendungsbereiche', '' FROM d
    UNION ALL SELECT doc, 2000000 + l * 10000, 0, 'ueberschrift', 'g2', CAST(l AS STRING) || '. Klasse', '' FROM dl
    UNION ALL SELECT doc, 2000000 + l * 10000 + 1, 0, 'ueberschrift', 'g3', 'Kompetenzbereich 1: ' || area_name, '' FROM dl
    UNION ALL SELECT doc, 2000000 + l * 10000 + o * 100, 0, 'absatz', 'abs', 'Die Schülerinnen und Schüler können ' || CASE WHEN o % 20 = 1 THEN entry ELSE entry || ' gar nicht wirklich' END, '' FROM q WHERE o % 10 = 1
    UNION ALL SELECT doc, 2000000 + l * 10000 + o * 100 + 1, 0, 'listelem', NULL, CASE WHEN k % 3 = 0 THEN 'allenfalls ' ELSE '' END || p_type || ' addieren', '' FROM q WHERE o % 10 = 1
    UNION ALL SELECT doc, 2000000 + l * 10000 + o * 100 + 1, 1, 'listelem', NULL, 'Wiederholen und Festigen: ' || p_type, '' FROM q WHERE o % 10 = 1
    UNION ALL SELECT doc, 3000000, 0, 'ueberschrift', 'g2', 'Übergreifende Themen', '' FROM d
    UNION ALL SELECT doc, 3000001, 0, 'td', NULL, '6 Umwelt', '' FROM d UNION ALL SELECT doc, 3000001, 1, 'td', NULL, '7 Sprache', '' FROM d),
  e AS (SELECT *, dense_rank() OVER (PARTITION BY doc ORDER BY g) - 1 AS idx FROM e0)"""


#: e: a regulation for each area of SEK1.M with every kind of heading, list and table that a subject's section may have
LAW = """d AS (SELECT DISTINCT a, slug, area_name, lower(slug) || '.xml' AS doc FROM r WHERE s = 5),
  dl AS (SELECT DISTINCT d.*, l FROM d JOIN r USING (a) WHERE s = 5),
  q AS (SELECT d.doc, d.area_name, r.*, p_name || ' ' || lpad(CAST(o AS STRING), 2, '0') AS entry, row_number() OVER (PARTITION BY d.doc, l, o % 10 ORDER BY o) AS nth FROM d JOIN r USING (a) WHERE r.s = 5),
  e0 AS (SELECT doc, 0 AS g, 0 AS pos, 'ueberschrift' AS element, 'g1' AS typ, CASE WHEN a % 5 = 4 THEN 'NEUNTER TEIL' ELSE 'ACHTER TEIL' END AS text, '' AS sup FROM d
    UNION ALL SELECT doc, 1, 0, 'ueberschrift', 'g1', 'MATHEMATIK', '' FROM d
    UNION ALL SELECT doc, 2, 0, 'absatz', 'abs', 'Dieser Lehrplan greift folgende übergreifende Themen auf: Umwelt6, Sprach-, Medien- und Lesebildung7.', '' FROM d
    UNION ALL SELECT doc, 3, 0, 'ueberschrift', 'erll', 'Kompetenzbereiche (1. bis 4. Klasse):', '' FROM d
    UNION ALL SELECT doc, 1000000 + l * 10000, 0, 'absatz', 'erltext', CAST(l AS STRING) || '. Klasse:', '' FROM dl
    UNION ALL SELECT doc, 1000000 + l * 10000 + 1, 0, 'absatz', 'abs', 'Anwendungsbereiche', '' FROM dl WHERE l = 2
    UNION ALL SELECT doc, 1000000 + l * 10000 + 1, 0, 'absatz', 'abs', 'In allen vier Kompetenzbereichen wird das Zielniveau A' || CAST(l AS STRING) || '+ angestrebt. Mehr.', '' FROM dl WHERE l <> 2
    UNION ALL SELECT doc, 1000000 + l * 10000 + 2, 0, 'ueberschrift', 'erll', 'Kompetenzbereich 1: ' || area_name, '' FROM dl
    UNION ALL SELECT doc, 1000000 + l * 10000 + 3, 0, 'absatz', 'abs', 'Die Schülerinnen und Schüler können', '' FROM dl WHERE l <> 3
    UNION ALL SELECT doc, 1000000 + l * 10000 + 4, row_number() OVER (PARTITION BY doc, l ORDER BY o) - 1, 'listelem', NULL, entry, CASE k % 4 WHEN 0 THEN '6' WHEN 1 THEN '99' ELSE '' END FROM q
    UNION ALL SELECT doc, 2000000, 0, 'ueberschrift', 'erll', 'Anwendungsbereiche (1. bis 4. Klasse):', '' FROM d
    UNION ALL SELECT doc, 2000000 + l * 10000, 0, 'absatz', 'erltext', CAST(l AS STRING) || '. Klasse:', '' FROM dl
    UNION ALL SELECT doc, 2000000 + l * 10000 + 1, 0, 'absatz', 'abs', 'Kompetenzbereich 1: ' || area_name, '' FROM dl
    UNION ALL SELECT doc, 2000000 + l * 10000 + o * 100, 0, 'absatz', 'abs', 'Die Schülerinnen und Schüler können ' || entry, '' FROM q WHERE o % 10 = 1
    UNION ALL SELECT doc, 2000000 + l * 10000 + o * 100, 0, 'absatz', 'abs', 'Vorschläge für den Einsatz digitaler Technologien in der ' || CAST(l AS STRING) || '. Klasse', '' FROM q WHERE o % 10 = 2
    UNION ALL SELECT doc, 2000000 + l * 10000 + o * 100 + 1, 0, 'listelem', NULL, CASE WHEN k % 3 = 0 THEN 'allenfalls ' ELSE '' END || p_type || ' addieren', '' FROM q WHERE o % 10 IN (1, 2, 3)
    UNION ALL SELECT doc, 2000000 + l * 10000 + o * 100 + 1, 1, 'listelem', NULL, 'Wiederholen und Festigen: ' || p_type, '' FROM q WHERE o % 10 = 1
    UNION ALL SELECT doc, 3000000, 0, 'ueberschrift', 'erll', 'Kompetenzen für den Mathematik-Lehrplan bei integrativer Führung von Geometrisches Zeichnen (1. bis 4. Klasse):', '' FROM d
    UNION ALL SELECT doc, 3000000 + l * 10000, 0, 'absatz', 'erltext', CAST(l AS STRING) || '. Klasse:', '' FROM dl WHERE l > 2
    UNION ALL SELECT doc, 3000000 + l * 10000 + 1, 0, 'absatz', 'abs', 'Die Schülerinnen und Schüler können', '' FROM dl WHERE l > 2
    UNION ALL SELECT doc, 3000000 + l * 10000 + 2, nth - 1, 'listelem', NULL, 'zeichnen ' || entry, '' FROM q WHERE o % 10 = 4 AND l > 2
    UNION ALL SELECT doc, 4000000, 0, 'ueberschrift', 'erll', 'Didaktische Hinweise', '' FROM d
    UNION ALL SELECT doc, 4000000 + l * 10000, 0, 'absatz', 'erltext', CAST(l AS STRING) || '. Klasse:', '' FROM dl WHERE l = 1
    UNION ALL SELECT doc, 4000000 + l * 10000 + 1, nth - 1, 'listelem', NULL, 'Hinweis ' || entry, '' FROM q WHERE o % 10 = 5 AND l = 1
    UNION ALL SELECT doc, 5000000, 0, 'td', NULL, '6 Umwelt', '' FROM d UNION ALL SELECT doc, 5000000, 1, 'td', NULL, '7 Sprache', '' FROM d
    UNION ALL SELECT doc, 6000000, 0, 'ueberschrift', 'erll', 'LEHRPLANZUSATZ Deutsch', '' FROM d
    UNION ALL SELECT doc, 6000001, 0, 'ueberschrift', 'erll', 'Kompetenzbereiche (1. bis 4. Klasse):', '' FROM d
    UNION ALL SELECT doc, 6000002, nth - 1, 'listelem', NULL, 'nicht mehr ' || entry, '' FROM q WHERE o % 10 = 6 AND l = 1),
  e AS (SELECT *, dense_rank() OVER (PARTITION BY doc ORDER BY g) - 1 AS idx FROM e0)"""


def xml_sql(body: str) -> str:
    return _after(f"WITH {RECORDS.format(part='part')},\n{EVENTS}", body)


def law_sql(body: str) -> str:
    return _after(f"WITH {RECORDS.format(part='part')},\n{LAW}", body)


def xml_root(spark: SparkSession, d: str, name: str = "xml", tables: str = EVENTS) -> str:
    """A folder of XML documents, a document for each group of the events that the tables hold."""

    def write(folder: str) -> None:
        e = spark.sql(f"WITH {RECORDS}, {tables} SELECT * FROM e", part=table(spark, d, "part", "p_partkey", "p_name", "p_type"))
        inner = F.concat("text", F.when(F.col("sup") != "", F.concat(F.lit("<super>"), "sup", F.lit("</super>"))).otherwise(""))
        one = F.concat(F.lit("<"), "element", F.when(F.col("typ").isNotNull(), F.concat(F.lit(' typ="'), "typ", F.lit('"'))).otherwise(""), F.lit(">"), inner, F.lit("</"), "element", F.lit(">"))
        child = e.groupBy("doc", "idx", "element").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", one.alias("x")))), lambda x: x["x"]), "").alias("x"))
        held = F.when(F.col("element") == "listelem", F.concat(F.lit("<liste><aufzaehlung>"), "x", F.lit("</aufzaehlung></liste>"))).when(F.col("element") == "td", F.concat(F.lit("<table><tr>"), "x", F.lit("</tr></table>"))).otherwise(F.col("x"))
        docs = child.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", held.alias("x")))), lambda x: x["x"]), "").alias("x"))
        value = F.concat(F.lit('<risdok xmlns="http://www.bka.gv.at"><nutzdaten><abschnitt>'), "x", F.lit("</abschnitt></nutzdaten></risdok>"))
        publish(docs.select(F.col("doc").alias("file"), value.alias("value")), folder)

    return made(spark, d, name, write)


def standards_root(spark: SparkSession, d: str) -> str:
    """A standards shard with a descriptor for each nation, its areas the regions, and a crosswalk to two of them."""

    def write(folder: str) -> None:
        n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
        code = F.concat(F.lit("H"), F.col("n_regionkey").cast("string"))
        rows = n.select(F.concat(F.lit("AT.BIST.M.SCH8."), code, F.lit("."), F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0")).alias("id"), F.lit("M").alias("fach"), F.lit("SCH8").alias("programmstufe"), code.alias("bereich_code"), F.lit("Lernende können").alias("stammsatz"), F.lower("n_name").alias("text"), (F.col("n_nationkey") + 1).alias("ordinal"))
        names = n.select(code.alias("bereich_code"), F.concat(F.lit("Gebiet "), F.col("n_regionkey").cast("string")).alias("name")).distinct()
        shard = standards.documents(rows, names, F.create_map(F.lit("quelle"), F.lit("Verordnung")))
        bridge = F.array(*[F.struct(F.lit("SEK1.M").alias("lehrplan_fach"), F.lit("A0").alias("lehrplan_bereich"), F.lit("m8").alias("bildungsstandard_shard"), F.lit(f"H{i}").alias("bildungsstandard_bereich"), F.lit(k).alias("beziehung")) for i, k in ((3, "bereichsentsprechung"), (1, "querschnitt"), (3, "matrix"))])
        walk = spark.range(1).select(F.to_json(F.struct(bridge.alias("zuordnungen"))).alias("value"))
        publish(shard.unionByName(walk.select(F.lit("crosswalk.json").alias("file"), "value")), folder)

    return made(spark, d, "standards", write)


#: f: a file for each nation; text, place and format by its key
FILES = """f AS (SELECT n_nationkey AS n, n_name, CASE n_regionkey WHEN 0 THEN 'mathematik/K1/' WHEN 1 THEN 'mathematik/K2/' WHEN 2 THEN 'deutsch/' WHEN 3 THEN '' ELSE 'mathematik/' END || lower(n_name) || CASE WHEN n_nationkey % 6 = 1 THEN '__AT.LP23.SEK1.M.A0.K1.05' ELSE '' END
    || '.' || CASE WHEN n_nationkey % 11 = 3 THEN 'xyz' WHEN n_nationkey % 5 = 4 THEN 'txt' ELSE 'md' END AS pfad,
    CASE WHEN n_nationkey % 4 = 0 THEN '# Titel ' || n_name || chr(10) ELSE '' END || repeat('wort ', CAST(n_nationkey * 60 AS INT)) || 'ende' AS text FROM {nation})"""


def material_root(spark: SparkSession, d: str) -> str:
    def write(folder: str) -> None:
        f = spark.sql(f"WITH {FILES} SELECT pfad AS file, text AS value FROM f", nation=table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey"))
        publish(f, folder)

    return made(spark, d, "material", write)
