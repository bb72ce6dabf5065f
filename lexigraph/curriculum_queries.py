"""Queries of the sources, plans, rules and lessons over a curriculum made from the driver's tables (derived.py).

Each goes through files: the engine's sinks wrote them, its sources read them.  The SQL counterparts never see a
file; they work on the records that the files were made from."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import derived
from .derived import law_sql, sql, xml_sql
from .functions import ids, text as tx
from .operators import anchor, dictionary, diff, graph, lessons, match, quality, schema_check
from .plans import build, regulation, standards, validate
from .plans.curriculum import Curriculum
from .queries import long, query
from .session import shared_dir, staged, table
from .sources import docs, nested_json, paged, publish, snapshots, tree_xml
from .streaming import postings


def _joined(c) -> Column:
    return F.array_join(c, "|")


def _parts(spark, d) -> DataFrame:
    return nested_json.parts(spark, derived.root(spark, d)).where("_corrupt_record is null")


def _plan(spark, d, indexed: bool = False) -> Curriculum:
    root = derived.root(spark, d)
    tables = derived.made(spark, d, "tables", lambda folder: nested_json.store(nested_json.tables(spark, root), folder))
    own = lambda **more: Curriculum(spark, root, derived.standards_root(spark, d), derived.material_root(spark, d), stored=tables, **more)
    if not indexed:
        return own()
    # a build stores the index beside its parts
    return own(dictionary=derived.made(spark, d, "dictionary", lambda folder: dictionary.store(own().keyword_index(), "shard", folder)))


def _labelled(**frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.withColumn("call", F.lit(name)) for name, f in frames.items()])


# -- scans


@query(sql("SELECT shard, count(DISTINCT slug) AS parts FROM r GROUP BY shard"))
def c_shards(spark, d):
    return nested_json.shards(_parts(spark, d))


@query(sql("SELECT id, shard, datei, slug AS bereich_slug, nummer AS bereich_nummer, area_name AS bereich_name, stufe, o AS ordinal, trim(stem || ' ' || wording) AS volltext FROM r"))
def c_competences(spark, d):
    k = nested_json.competences(_parts(spark, d))
    return k.select("id", "shard", "datei", "bereich_slug", long("bereich_nummer"), "bereich_name", "stufe", long("ordinal"), "volltext")


@query(sql("SELECT shard, item_id AS id, attach_key, item_text AS text, verbindlich, art, ordinal FROM i"))
def c_items(spark, d):
    return nested_json.items(_parts(spark, d)).select("shard", "id", "attach_key", "text", "verbindlich", "art", long("ordinal"))


@query(sql("""SELECT shard, datei, slug, CAST(count(*) + CASE WHEN shard = 'PRIM.D' AND slug = 'A0' THEN 1 ELSE 0 END AS BIGINT) AS kompetenzen FROM r WHERE shard <> 'SEK1.E' GROUP BY shard, datei, slug"""))
def c_stored_index(spark, d):
    return nested_json.stored_index(spark, derived.root(spark, d)).select("shard", F.inline("teile")).select("shard", "datei", "slug", long("kompetenzen"))


@query(sql("""w AS (SELECT shard, datei, 'kompetenz' AS kind, id, false AS repeats FROM r
    UNION ALL SELECT shard, datei, 'item', item_id, false FROM i WHERE place = 'nested'
    UNION ALL SELECT shard, datei, 'item', item_id, false FROM i WHERE place = 'block'
    UNION ALL SELECT i.shard, p.datei, 'item', item_id, true FROM i JOIN (SELECT DISTINCT shard, datei FROM r) p ON p.shard = i.shard WHERE place = 'year')
  SELECT * FROM w"""))
def c_record_walk(spark, d):
    return validate.record_walk(_parts(spark, d)).select("shard", "datei", "kind", "id", "repeats")


@query(sql("SELECT DISTINCT shard, slug, dense_rank() OVER (PARTITION BY shard ORDER BY nummer NULLS LAST, slug) AS rang FROM r"))
def c_area_order(spark, d):
    return nested_json.areas(_parts(spark, d)).select("shard", "slug", long("rang"))


@query(sql("SELECT DISTINCT shard, split_part(shard, '.', 1) AS band, split_part(shard, '.', 2) AS fach_code, bindung, CASE WHEN s = 2 THEN 'keine_verordnung' ELSE 'verordnet' END AS bezug, 'NOR' || s AS nor FROM r"))
def c_shard_meta(spark, d):
    return nested_json.shard_meta(_parts(spark, d)).select("shard", "band", "fach_code", "bindung", F.col("bildungsstandard_bezug").alias("bezug"), F.col("provenienz.nor").alias("nor"))


@query(sql("""SELECT id, array_to_string(list_sort(list_distinct(regexp_extract_all(wording, '⟦ABB:([^⟧]+)⟧', 1))), '|') AS images FROM r WHERE k % 10 = 7 AND k % 30 <> 7"""))
def c_slim_images(spark, d):
    k = nested_json.competences(_parts(spark, d)).where(F.size("abbildungen") > 0)
    return k.select("id", _joined(F.transform(nested_json.slim_images(F.col("abbildungen")), lambda a: a["datei"])).alias("images")).where("images <> 'fremd.png'")


@query(sql("""p AS (SELECT shard, datei, slug, count(*) AS records FROM r GROUP BY ALL) SELECT shard, datei, p.records + (SELECT count(*) FROM i WHERE i.shard = p.shard AND (i.slug = p.slug OR i.slug IS NULL)) AS records FROM p"""))
def c_build_report(spark, d):
    return validate.build_report(_parts(spark, d)).select("shard", "datei", "records")


@query(sql("""SELECT id, '{"id":"' || id || '","stufe":"' || stufe || '"' || CASE WHEN nummer IS NOT NULL THEN ',"bereich_nummer":' || nummer ELSE '' END || '}' AS record FROM r"""))
def c_projection(spark, d):
    return nested_json.competences(_parts(spark, d)).select("id", nested_json.projected("id", "stufe", "bereich_nummer").alias("record"))


@query(sql("""p AS (SELECT DISTINCT shard, datei, s FROM r) SELECT 'schema-violation' AS rule, shard || '/' || datei AS record, CASE s % 2 WHEN 0 THEN 'unknown notiz,zusatz' ELSE 'missing kompetenzbereiche' END AS message FROM p WHERE s < 4"""))
def c_shape_rules(spark, d):
    """Parts of some shards with fields added or taken away."""
    texts = derived.documents(spark, d)
    worse = F.when(F.col("shard").isin("PRIM.D", "PRIM.SU"), F.concat(F.lit('{"zusatz":1,"notiz":2,'), F.substr("value", F.lit(2)))).when(F.col("shard").isin("PRIM.M", "SEK1.D"), F.regexp_replace("value", '"kompetenzbereiche":.*$', '"meta2":0}')).otherwise(F.col("value"))
    found = validate.shape_rules(texts.select(F.concat_ws("/", "shard", "datei").alias("datei"), worse.alias("value")))
    return found.where("message <> 'unknown meta2'").select("rule", "record", "message")


# -- the query functions

_ID = "AT.LP23.SEK1.M.A0.K2.05"
_CALLS = {"nested": "AT.LP23.SEK1.M.A0.K2.05", "area": "AT.LP23.PRIM.D.A0.SCH3.07", "year": "AT.LP23.PRIM.SU.A0.SCH2.09", "none": "AT.LP23.PRIM.M.A0.SCH1.01", "prose": "AT.LP23.SEK1.E.A0.K1.03"}


@query(sql(f"SELECT id, shard, slug AS bereich_slug, stufe, o AS ordinal, trim(stem || ' ' || wording) AS volltext FROM r WHERE id = '{_ID}'"))
def c_by_id(spark, d):
    return _plan(spark, d).kompetenz_nach_id(f" {_ID} ").select("id", "shard", "bereich_slug", "stufe", long("ordinal"), "volltext")


@query(sql("""c AS (SELECT 'level' AS call, id FROM r WHERE shard = 'SEK1.M' AND stufe = 'K3'
    UNION ALL SELECT 'area', id FROM r WHERE shard = 'PRIM.D' AND lower(area_name) = 'bereich 0'
    UNION ALL SELECT 'slug', id FROM r WHERE shard = 'PRIM.D' AND slug = 'A0' AND stufe = 'SCH1'
    UNION ALL SELECT 'words', id FROM r WHERE shard = 'SEK1.D' AND (contains(lower(wording), 'gizmo') OR contains(lower(wording), 'hot anvil'))
    UNION ALL SELECT 'code', id FROM r WHERE id = 'AT.LP23.SEK1.M.A0.K2.05') SELECT * FROM c"""))
def c_search(spark, d):
    c = _plan(spark, d)
    return _labelled(
        level=c.finde_kompetenz("sek1.m", stufe=" k3"), area=c.finde_kompetenz("PRIM.D", kompetenzbereich="BEREICH 0"), slug=c.finde_kompetenz("PRIM.D", "sch1", "a0"),
        words=c.finde_kompetenz("SEK1.D", stichworte=["Gizmo", "hot anvil", " "]), code=c.finde_kompetenz("SEK1.M", code=_ID), stranger=c.finde_kompetenz("SEK1.D", code=_ID), other_level=c.finde_kompetenz("SEK1.M", "K1", code=_ID),
    ).select("call", "id")


@query(sql(f"""c AS (SELECT 'vor' AS call, n.id, 0 AS pos FROM r JOIN r n ON n.before_id = r.id WHERE r.id = '{_ID}' UNION ALL SELECT 'zurueck', n.id, 0 FROM r JOIN r n ON r.before_id = n.id WHERE r.id = '{_ID}') SELECT call, id FROM c"""))
def c_progression(spark, d):
    c = _plan(spark, d)
    return _labelled(vor=c.finde_progression(_ID, "vor"), zurueck=c.finde_progression(_ID, "zurueck")).select("call", "id")


@query(sql("c AS (VALUES " + ", ".join(f"('{n}', '{x}')" for n, x in _CALLS.items()) + """), o AS (SELECT col0 AS call, r.shard, CASE bindung WHEN 'kompetenz' THEN id WHEN 'bereich' THEN slug || '.' || stufe WHEN 'stufe' THEN stufe END AS at FROM c JOIN r ON r.id = col1)
  SELECT call, item_id AS id, item_text AS text, verbindlich FROM o JOIN i ON i.shard = o.shard AND i.attach_key = o.at WHERE art = 'praezisierung'"""))
def c_application_items(spark, d):
    c = _plan(spark, d)
    return _labelled(**{n: c.finde_anwendungsbereiche(x) for n, x in _CALLS.items()}).select("call", "id", "text", "verbindlich")


@query(sql("""c AS (SELECT 'area' AS call, item_id AS id FROM i WHERE shard = 'SEK1.D' AND attach_key = 'A0.K2' UNION ALL SELECT 'year', item_id FROM i WHERE shard = 'PRIM.SU' AND attach_key = 'SCH4'
  UNION ALL SELECT 'choice', item_id FROM i WHERE attach_key = 'AT.LP23.SEK1.M.A0.K2.05' AND NOT verbindlich AND art = 'praezisierung') SELECT * FROM c"""))
def c_items_at_coordinates(spark, d):
    c = _plan(spark, d)
    return _labelled(area=c.finde_anwendungsbereiche(fach="SEK1.D", stufe="k2", bereich="a0"), year=c.finde_anwendungsbereiche(fach="PRIM.SU", stufe="SCH4"), choice=c.finde_anwendungsbereiche(_ID, False)).select("call", "id")


@query(sql(f"""c AS (SELECT 'items' AS call, 'aus_anwendungsbereichen' AS quelle, item_text AS text FROM i WHERE attach_key = '{_ID}' AND art = 'praezisierung'
  UNION ALL SELECT 'own', 'eigen_ausgewiesen', trim(stem || ' ' || wording) FROM r WHERE id = '{_CALLS["none"]}') SELECT * FROM c"""))
def c_matter(spark, d):
    c = _plan(spark, d)
    return _labelled(items=c.finde_lehrstoff(_ID), own=c.finde_lehrstoff(_CALLS["none"])).select("call", "quelle", "text")


_THEMES = "t AS (VALUES " + ", ".join(f"('{s}', '{x}')" for s, xs in zip(derived.SHARDS, derived.THEMES) for x in xs) + ")"


@query(sql(f"""{_THEMES}, c AS (SELECT 'fach' AS call, col1 AS value FROM t WHERE col0 = 'SEK1.M' UNION ALL SELECT 'record', 'Umwelt' FROM r WHERE id = 'AT.LP23.SEK1.D.A0.K3.01' AND k % 4 = 0
  UNION ALL SELECT 'thema', col0 FROM t WHERE lower(col1) = 'umwelt') SELECT * FROM c"""))
def c_themes(spark, d):
    c = _plan(spark, d)
    value = lambda f, name: f.select(F.col(name).alias("value"))
    return _labelled(fach=value(c.finde_uebergreifende_themen(fach="SEK1.M"), "thema"), record=value(c.finde_uebergreifende_themen(kompetenz_id="AT.LP23.SEK1.D.A0.K3.01"), "thema"), thema=value(c.finde_uebergreifende_themen(thema=" UMWELT "), "shard"))


@query(sql(f"""c AS (SELECT id, CASE WHEN l >= CASE WHEN s >= 3 THEN 2 ELSE 3 END THEN 'Standard|Standard plus' ELSE '' END AS labels, before_id FROM r WHERE id IN ('{_ID}', 'AT.LP23.PRIM.D.A0.SCH2.01', 'AT.LP23.SEK1.M.A0.K1.02'))
  SELECT c.id, labels, (SELECT count(*) FROM i WHERE i.attach_key = c.id AND NOT verbindlich AND art = 'praezisierung') AS enrichment, (SELECT count(*) FROM r WHERE r.id = c.before_id) AS before FROM c"""))
def c_differentiation(spark, d):
    c, out = _plan(spark, d), []
    for x in (_ID, "AT.LP23.PRIM.D.A0.SCH2.01", "AT.LP23.SEK1.M.A0.K1.02"):
        f = c.finde_differenzierung(x)
        one = f["achse"].select(F.lit(x).alias("id"), _joined("niveaus").alias("labels"))
        out.append(one.crossJoin(f["enrichment"].agg(F.count("*").alias("enrichment"))).crossJoin(f["vorklasse"].agg(F.count("*").alias("before"))))  # one row each
    return reduce(DataFrame.unionByName, out)


@query(sql(f"""n AS (SELECT 'AT.BIST.M.SCH8.H' || n_regionkey || '.' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS id, CASE n_regionkey WHEN 3 THEN 0 ELSE 1 END AS row FROM nation WHERE n_regionkey IN (1, 3))
  SELECT true AS abgedeckt, string_agg(row || ':' || id, '|' ORDER BY row, id) AS descriptors, 3 AS bridges FROM n"""))
def c_standards(spark, d):
    f = _plan(spark, d).finde_bildungsstandard_bezug(_ID)
    return f.select("abgedeckt", _joined(F.transform("deskriptoren", lambda x: F.concat_ws(":", x["bridge_row"].cast("string"), x["id"]))).alias("descriptors"), F.size("zuordnungen").alias("bridges"))


_FILES = derived.FILES.format(nation="nation")


@query(f"""WITH RECURSIVE {_FILES}, h AS (SELECT pfad, greatest(1, strlen(text) // 4 + CASE WHEN strlen(text || chr(10)) % 4 = 0 THEN 1 ELSE 0 END) AS tokens, contains(pfad, '__') AS own, (pfad LIKE 'mathematik/K2/%')::INT AS level,
    starts_with(pfad, 'mathematik/') AS subject FROM f WHERE NOT ends_with(pfad, '.xyz')),
  k AS (SELECT pfad, tokens, row_number() OVER (ORDER BY (NOT own)::INT, (NOT subject)::INT, 1 - level, pfad) AS rank FROM h WHERE own OR (subject AND NOT contains(pfad, '/K1/'))),
  b AS (SELECT 1 AS rank, (SELECT tokens FROM k WHERE rank = 1) AS used, true AS taken UNION ALL SELECT b.rank + 1, b.used + CASE WHEN b.used + k.tokens <= 4000 THEN k.tokens ELSE 0 END, b.used + k.tokens <= 4000 FROM b JOIN k ON k.rank = b.rank + 1)
  SELECT k.pfad, CAST(k.rank AS BIGINT) AS rank, CASE WHEN taken THEN 'treffer' ELSE 'verworfen' END AS status FROM k JOIN b USING (rank)
  UNION ALL SELECT pfad, NULL, 'uebersprungen' FROM f WHERE ends_with(pfad, '.xyz')""")
def c_material(spark, d):
    return docs.collect_material(docs.scan(spark, derived.material_root(spark, d)), "M", "K2", "AT.LP23.SEK1.M.A0.K1.05").select("pfad", long("rank"), "status")


@query(f"""WITH {_FILES} SELECT pfad, CASE WHEN n % 4 = 0 THEN 'Titel ' || n_name ELSE lower(n_name) END AS titel, CASE WHEN starts_with(pfad, 'mathematik/') THEN 'M' WHEN starts_with(pfad, 'deutsch/') THEN 'D' END AS fach,
  CASE WHEN contains(pfad, '/K1/') THEN 'K1' WHEN contains(pfad, '/K2/') THEN 'K2' END AS stufe, CASE WHEN n % 6 = 1 THEN 'AT.LP23.SEK1.M.A0.K1.05' END AS kompetenz_id, CASE WHEN ends_with(pfad, '.xyz') THEN 'uebersprungen' ELSE 'treffer' END AS status FROM f WHERE NOT ends_with(pfad, '.xyz')""")
def c_material_scan(spark, d):
    return docs.scan(spark, derived.material_root(spark, d)).where("format <> 'xyz'").select("pfad", "titel", "fach", "stufe", "kompetenz_id", "status")


@query(sql(r"""x AS (SELECT shard, datei, wording || ' ' || stem AS t FROM r UNION ALL SELECT i.shard, coalesce(i.datei, p.datei), item_text FROM i LEFT JOIN (SELECT DISTINCT shard, datei FROM r) p ON p.shard = i.shard AND i.datei IS NULL),
  w AS (SELECT DISTINCT shard, datei, replace(lower(t), 'ß', 'ss') AS term FROM (SELECT shard, datei, unnest(regexp_extract_all(regexp_replace(t, '⟦ABB:[^⟧]+⟧', ' ', 'g'), '[\p{L}\p{Nl}\p{No}]+')) AS t FROM x) WHERE length(t) >= 4)
  SELECT shard, term, string_agg(datei, ',' ORDER BY datei) AS parts FROM w WHERE term NOT IN ('können') GROUP BY shard, term HAVING count(*) <= 2"""))
def c_keyword_index(spark, d):
    return _plan(spark, d).keyword_index().withColumn("parts", F.array_join("parts", ","))


@query(sql(r"""p AS (SELECT shard, count(DISTINCT slug) AS n FROM r GROUP BY shard) SELECT 'gizmo' AS term, CASE WHEN n <= 2 THEN 'kompetenztreffer' ELSE 'keine_indexkandidaten' END AS suchstatus,
    CASE WHEN n <= 2 THEN (SELECT count(DISTINCT id) FROM r WHERE shard = 'SEK1.M' AND contains(wording, 'gizmo')) ELSE 0 END AS records FROM p WHERE shard = 'SEK1.M'
  UNION ALL SELECT 'qqq', 'keine_indexkandidaten', 0"""))
def c_coverage(spark, d):
    c = _plan(spark, d, indexed=True)
    one = lambda t: c.stichwort_abdeckung("SEK1.M", t).select(F.lit(t).alias("term"), "suchstatus", F.size("kompetenz_ids").cast("long").alias("records"))
    return one("gizmo").unionByName(one("qqq"))


# -- rules

_RULES = """x AS (SELECT 'dangling-reference' AS rule, id AS record FROM r WHERE k % 97 = 5
    UNION ALL SELECT 'dangling-reference', r.id FROM r WHERE l < 4 AND NOT EXISTS (SELECT 1 FROM r n WHERE n.before_id = r.id)
    UNION ALL SELECT 'orphan-token-no-abbildung-entry', id FROM r WHERE k % 30 = 7
    UNION ALL SELECT 'orphan-abbildung-entry-no-token', id FROM r WHERE k % 50 = 11 AND k % 30 <> 7)"""


@query(sql(f"{_RULES} SELECT rule, count(*) AS n FROM x GROUP BY rule"))
def c_record_rules(spark, d):
    return validate.record_rules(_parts(spark, d)).groupBy("rule").agg(F.count("*").alias("n"))


@query(sql("""SELECT 'soft' AS severity, 'index-missing' AS rule, 'SEK1.E' AS record UNION ALL SELECT 'soft', 'index-mismatch', 'PRIM.D/a0.json' UNION ALL SELECT 'soft', 'size-target-exceeded', 'n' FROM (SELECT 1) WHERE false"""))
def c_file_rules(spark, d):
    return validate.file_rules(spark, derived.root(spark, d)).where("rule <> 'size-target-exceeded'").select("severity", "rule", "record")


@query(sql("""u AS (SELECT DISTINCT 'bild' || k % 4 || '.png' AS datei FROM r WHERE k % 10 = 7 AND k % 30 <> 7 UNION SELECT 'fremd.png' FROM r WHERE k % 50 = 11 AND k % 30 <> 7)
  SELECT 'abbildung-not-in-registry' AS rule, datei AS record FROM u WHERE datei NOT IN ('bild0.png', 'bild1.png', 'bild2.png') UNION ALL SELECT 'registry-entry-incomplete', 'bild2.png' UNION ALL SELECT DISTINCT 'abbildung-file-missing', datei FROM u WHERE datei <> 'bild1.png'"""))
def c_registry_rules(spark, d):
    registry = spark.createDataFrame([(f"bild{i}.png", "N", "u", 1, 1 if i < 2 else None, "s") for i in range(3)], "datei string, nor string, url string, width int, height int, sha256 string")
    files = spark.createDataFrame([("bild1.png",)], "datei string")
    return validate.registry_rules(_parts(spark, d), registry, files).select("rule", "record").distinct()


@query(sql("""m AS (SELECT shard, 'kompetenz' AS kind, count(DISTINCT id) AS n FROM r GROUP BY shard UNION ALL SELECT shard, 'item', count(DISTINCT item_id) FROM i GROUP BY shard)
  SELECT 'count-mismatch-vs-frozen-expected' AS rule, shard || '/' || kind AS record, '7 ' || n AS message FROM m WHERE n <> 7"""))
def c_count_rules(spark, d):
    have = validate.record_walk(_parts(spark, d)).select("shard", "kind").distinct()
    return validate.count_rules(_parts(spark, d), have.withColumn("expected", F.lit(7).cast("long"))).select("rule", "record", "message")


@query(sql(f"{_RULES}, y AS (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS strict FROM x) SELECT 0 AS plain, strict FROM y"))
def c_exit_codes(spark, d):
    found = staged(validate.record_rules(_parts(spark, d)), "findings")
    return spark.createDataFrame([(quality.exit_code(found), quality.exit_code(found, strict=True))], "plain int, strict int")


@query(sql(f"{_RULES} SELECT row_number() OVER (ORDER BY rule, record) AS place, rule, record FROM (SELECT DISTINCT rule, record FROM x)"))
def c_ordered_findings(spark, d):
    found = validate.record_rules(_parts(spark, d))
    named = found.select("severity", "rule", F.when(F.col("rule") == "dangling-reference", F.col("record")).alias("record"), "message", F.col("record").alias("at"))
    k = validate.record_walk(_parts(spark, d)).select(F.concat_ws("/", "shard", "datei", "path").alias("at"), "id")
    rows = quality.ordered(named.join(k, "at", "left").select("severity", "rule", F.coalesce("record", "id").alias("record"), F.lit("").alias("message")).distinct())
    listed = rows.agg(F.array_sort(F.collect_list(F.struct("rule", "record"))).alias("x"))  # findings are few beside the records
    return listed.select(F.posexplode("x").alias("place", "x")).select((F.col("place") + 1).cast("long").alias("place"), "x.rule", "x.record")


# -- XML

_SPEC = build.Spec("SEK1.M", "Mathematik", "kompetenz", optional_items=True)


def _events(spark, d) -> DataFrame:
    return tree_xml.xml_events(spark, derived.xml_root(spark, d))


def _state(spark, d) -> DataFrame:
    return build.placed(_events(spark, d), _SPEC)


@query(xml_sql("SELECT doc, idx, pos, element, typ, text, sup AS marks FROM e"))
def c_xml_events(spark, d):
    return _events(spark, d).select("doc", long("idx"), long("pos"), "element", "typ", "text", F.array_join("supers", "|").alias("marks"))


@query(xml_sql("SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY g, pos) - 1 AS pos, text FROM e"))
def c_xml_blocks(spark, d):
    return tree_xml.source_blocks(spark, derived.xml_root(spark, d)).select("doc", long("pos"), "text")


@query(xml_sql("SELECT doc, 'Kurztitel' AS label, 'Lehrplan ' || doc AS value FROM d"))
def c_xml_header(spark, d):
    return tree_xml.header_values(_events(spark, d))


@query(xml_sql("""SELECT doc, 'AT.LP23.SEK1.M.BEREICH' || a || '.K' || l || '.' || lpad(CAST(row_number() OVER (PARTITION BY doc, l ORDER BY o) AS VARCHAR), 2, '0') AS id, 'K' || l AS stufe, 1 AS bereich_nummer,
  'Die Schülerinnen und Schüler können' AS stammsatz, entry AS text, CASE k % 4 WHEN 0 THEN 'Umwelt' ELSE '' END AS themen, CASE k % 4 WHEN 1 THEN '99' ELSE '' END AS offen FROM q"""))
def c_parsed_records(spark, d):
    state = _state(spark, d)
    rows = build.with_themes(build.competences(state, _SPEC), build.legend(state))
    return rows.select("doc", "id", "stufe", "bereich_nummer", "stammsatz", "text", _joined("uebergreifende_themen").alias("themen"), _joined("fussnoten_unaufgeloest").alias("offen"))


@query(xml_sql("""t AS (SELECT doc, l, o, 0 AS pos, CASE WHEN k % 3 = 0 THEN 'allenfalls ' ELSE '' END || p_type || ' addieren' AS text, k % 3 <> 0 AS verbindlich, false AS wiederholung FROM q WHERE o % 10 = 1
  UNION ALL SELECT doc, l, o, 1, 'Wiederholen und Festigen: ' || p_type, true, true FROM q WHERE o % 10 = 1)
  SELECT doc, 'K' || l AS stufe, row_number() OVER (PARTITION BY doc, l ORDER BY o, pos) AS ordinal, text, verbindlich, wiederholung FROM t"""))
def c_parsed_items(spark, d):
    return build.items(_state(spark, d), _SPEC).select("doc", "stufe", long("ordinal"), "text", "verbindlich", "wiederholung")


@query(xml_sql("SELECT doc, n AS number, name FROM d, (VALUES ('6', 'Umwelt'), ('7', 'Sprache')) v(n, name)"))
def c_legend(spark, d):
    return build.legend(_state(spark, d))


@query(xml_sql("SELECT mode, count(*) AS n FROM (SELECT CASE WHEN o % 20 = 1 THEN 'exact' ELSE 'positional' END AS mode FROM q WHERE o % 10 = 1) GROUP BY mode"))
def c_attached_blocks(spark, d):
    state = _state(spark, d)
    return build.attached_blocks(build.competences(state, _SPEC), build.items(state, _SPEC)).groupBy("mode").agg(F.count("*").alias("n"))


@query(xml_sql("SELECT count(*) AS blocks, count(*) FILTER (WHERE o % 20 = 1) AS exact, count(*) FILTER (WHERE o % 20 = 1) / greatest(count(*), 1) AS exact_rate FROM q WHERE o % 10 = 1"))
def c_join_rates(spark, d):
    state = _state(spark, d)
    return match.join_rates(build.attached_blocks(build.competences(state, _SPEC), build.items(state, _SPEC))).select("blocks", "exact", "exact_rate")


@query(xml_sql("""k AS (SELECT doc, l, row_number() OVER (PARTITION BY doc, l ORDER BY o) AS n, 'AT.LP23.SEK1.M.BEREICH' || a || '.K' || l || '.' AS head FROM q), m AS (SELECT doc, l, head, count(*) AS c FROM k GROUP BY ALL)
  SELECT k.head || lpad(CAST(k.n AS VARCHAR), 2, '0') AS id, coalesce(b.c, 0) AS before, coalesce(f.c, 0) AS after FROM k LEFT JOIN m b ON b.doc = k.doc AND b.l = k.l - 1 LEFT JOIN m f ON f.doc = k.doc AND f.l = k.l + 1"""))
def c_linked(spark, d):
    return build.linked(build.competences(_state(spark, d), _SPEC)).select("id", F.size("vorlaeufer").cast("long").alias("before"), F.size("folge").cast("long").alias("after"))


@query(xml_sql("SELECT CASE WHEN l = 1 THEN 'first-level' END AS issue, count(*) AS n FROM q WHERE o % 10 = 1 GROUP BY 1"))
def c_repeats(spark, d):
    return build.build(_events(spark, d), _SPEC)["repeats"].groupBy("issue").agg(F.count("*").alias("n"))


@query(xml_sql("""SELECT name, measured FROM (SELECT count(DISTINCT a) AS bereiche, count(*) AS kompetenzen, count(*) FILTER (WHERE k % 4 = 0) AS mit_themen, count(*) FILTER (WHERE k % 4 = 1) AS unaufgeloest, 2 * count(*) FILTER (WHERE o % 10 = 1) AS items,
  count(*) FILTER (WHERE o % 10 = 1 AND k % 3 = 0) AS unverbindlich, count(*) FILTER (WHERE o % 10 = 1) AS wiederholungen FROM q) UNPIVOT (measured FOR name IN (bereiche, kompetenzen, mit_themen, unaufgeloest, items, unverbindlich, wiederholungen))"""))
def c_build_counts(spark, d):
    state = _state(spark, d)
    return build.counts(build.with_themes(build.competences(state, _SPEC), build.legend(state)), build.items(state, _SPEC))


@query(xml_sql("SELECT 'a0.json' AS datei, 2 * count(*) AS n FROM q WHERE o % 10 = 1 AND a = 0 UNION ALL SELECT 'zusatz.json', 2 * count(*) FROM q WHERE o % 10 = 1 AND a > 0 HAVING count(*) > 0"))
def c_routed_items(spark, d):
    official = spark.createDataFrame([("SEK1.M", "BEREICH0")], "shard string, slug string")
    rows = build.routed(build.items(_state(spark, d), _SPEC), official)
    return rows.groupBy(F.replace("datei", F.lit("bereich"), F.lit("a")).alias("datei")).agg(F.count("*").alias("n"))


@query(xml_sql("SELECT doc, 'unmapped-area' AS rule, count(*) AS n FROM dl JOIN (SELECT 1 AS x UNION ALL SELECT 2) v ON true GROUP BY doc"))
def c_parse_issues(spark, d):
    return build.build(_events(spark, d), _SPEC)["issues"].groupBy("doc", "rule").agg(F.count("*").alias("n"))


@query(xml_sql("SELECT 'K' || l AS stufe, doc, count(*) AS n FROM q WHERE o % 10 = 1 GROUP BY ALL HAVING count(*) > 1"))
def c_level_blocks(spark, d):
    state = _state(spark, d)
    return build.level_blocks(build.attached_blocks(build.competences(state, _SPEC), build.items(state, _SPEC)), "stufe")


@query(xml_sql("""v AS (SELECT 'exact' AS mode, count(*) AS n FROM q UNION ALL SELECT 'bounded', count(DISTINCT p_name) FROM q UNION ALL SELECT 'failed', count(*) FROM q) SELECT * FROM v"""))
def c_fidelity(spark, d):
    k = derived.records(spark, d).where("s = 5")
    entry = F.concat_ws(" ", "p_name", F.lpad(F.col("o").cast("string"), 2, "0"))
    wanted = k.select(F.col("k").alias("key"), tx.fidelity_form(F.concat(F.lit(" ​"), entry, F.lit("  "))).alias("form"))
    wanted = wanted.unionByName(k.groupBy("p_name").agg(F.min("k").alias("k")).select((-F.col("k") - 1).alias("key"), F.col("p_name").alias("form")))
    wanted = wanted.unionByName(k.select((F.col("k") + 10_000_000).alias("key"), F.concat(entry, F.lit("x")).alias("form")))
    return match.mode_tally(match.fidelity(wanted, "key", "form", tree_xml.source_blocks(spark, derived.xml_root(spark, d)), "text"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE substr(n_name, 1, 5) END AS prefix FROM nation""")
def c_located_prefix(spark, d):
    n = table(spark, d, "nation", "n_nationkey", "n_name")
    needle = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.concat(F.substring("n_name", 1, 5), F.lit("#weiter")))
    return n.select("n_nationkey", match.located_prefix(needle, F.concat(F.lit("davor "), "n_name", F.lit(" danach"))).alias("prefix"))


_HEAD = "CASE WHEN n_regionkey < 3 THEN 'Handlungsbereich: H' || n_regionkey || ', Inhaltsbereich: I1' ELSE '2. Gebiet ' || n_regionkey END"


@query(f"""WITH n AS (SELECT *, CASE n_regionkey WHEN 0 THEN 'HAIA' WHEN 1 THEN 'HBIA' WHEN 2 THEN 'HANDLUNGSBEREICHH2INHALT' ELSE 'GEBIET' || n_regionkey END AS code, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS o FROM nation)
  SELECT 'AT.BIST.M.SCH8.' || code || '.' || lpad(CAST(o AS VARCHAR), 2, '0') AS id, code AS bereich_code, CASE WHEN n_nationkey % 3 = 0 THEN 'Lernende können' ELSE 'Alle können' END AS stammsatz, lower(n_name) AS text, o AS ordinal FROM n""")
def c_descriptors(spark, d):
    n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    one = lambda pos, element, text: F.struct(F.lit(pos).alias("at"), F.lit(element).alias("element"), text.alias("text"))
    head = F.expr(_HEAD)
    entry = F.concat(F.when(F.col("n_nationkey") % 3 == 0, "Lernende können: ").otherwise(""), F.lower("n_name"))
    heads = n.select("n_regionkey").distinct().select("n_regionkey", F.lit(-1).cast("long").alias("n_nationkey"), F.explode(F.array(one(0, "ueberschrift", head), one(1, "absatz", F.lit("Alle können")))).alias("e"))
    rows = heads.unionByName(n.select("n_regionkey", "n_nationkey", one(2, "listelem", entry).alias("e")))
    events = rows.select(F.lit("m8.xml").alias("doc"), (F.col("n_regionkey") * 1000 + F.col("n_nationkey") + 1).alias("idx"), F.col("e.at").alias("pos"), "e.element", "e.text")
    return standards.descriptors(events, "M", "SCH8", {"H0": "HA", "H1": "HB"}, {"I1": "IA"}).select("id", "bereich_code", "stammsatz", "text", long("ordinal"))


@query("SELECT n_nationkey, 'K' || n_regionkey AS stufe, 'A' || n_regionkey || '+' AS niveau, 'In allen vier Kompetenzbereichen wird das Zielniveau A' || n_regionkey || '+ angestrebt.' AS satz FROM (SELECT min(n_nationkey) AS n_nationkey, n_regionkey FROM nation GROUP BY n_regionkey)")
def c_target_levels(spark, d):
    n = table(spark, d, "nation", "n_nationkey", "n_regionkey")
    r = F.col("n_regionkey").cast("string")
    text = F.concat(F.lit("In allen vier Kompetenzbereichen wird das Zielniveau A"), r, F.when(F.col("n_nationkey") == F.min("n_nationkey").over(_by("n_regionkey")), "+").otherwise(" spät"), F.lit(" angestrebt. Es folgt mehr."))
    state = n.select(F.lit("d").alias("doc"), F.col("n_nationkey").cast("int").alias("idx"), F.lit(0).alias("pos"), F.concat(F.lit("K"), r).alias("level"), F.lit("kompetenzen").alias("section"), text.alias("text"))
    return build.target_levels(state).select(long("quell_index"), "stufe", "niveau", "satz").withColumnRenamed("quell_index", "n_nationkey")


def _by(*columns: str):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


@query("SELECT 'd' || n_regionkey AS doc, n_regionkey < 2 AS has, CASE WHEN n_regionkey < 2 THEN n_regionkey = 0 END AS stated, CASE WHEN n_regionkey = 0 THEN 'A1' END AS niveau FROM nation GROUP BY n_regionkey")
def c_axis(spark, d):
    n = table(spark, d, "nation", "n_regionkey").distinct().withColumn("doc", F.concat(F.lit("d"), F.col("n_regionkey").cast("string")))
    gers = F.when(F.col("n_regionkey") < 2, F.struct(F.lit("gers").alias("typ"), F.lit(True).alias("je_stufe_ausgewiesen")))
    targets = spark.createDataFrame([("d0", "K1", "A1", "s", "x", 3)], "doc string, stufe string, niveau string, satz string, abschnitt string, quell_index int")
    out = build.with_axis(n.withColumn("achse", F.struct(F.lit("generisch").alias("typ"), gers.alias("gers"))), "achse", targets)
    return out.select("doc", F.col("achse.gers").isNotNull().alias("has"), F.col("achse.gers.je_stufe_ausgewiesen").alias("stated"), F.try_element_at("achse.gers.je_stufe", F.lit("K1"))["niveau"].alias("niveau"))


# -- manifests, registries, hits


def _manifest(spark, d) -> str:
    """A manifest of nations written by the sink."""

    def write(folder: str) -> None:
        n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
        rows = n.select(F.lower("n_name").alias("document"), F.concat(F.lit("NOR"), F.col("n_nationkey").cast("string")).alias("nor"), F.lit("Lehrplan").alias("kurztitel"), F.lit("BGBl. 1 ").alias("kundmachungsorgan"), F.lit("Anl. 1").alias("artikel_paragraph_anlage"), F.lit("2025-01-01").alias("retrieval_date"), F.create_map(F.lit("pdf"), F.struct(F.sha2("n_name", 256).alias("sha256"), F.length("n_name").cast("long").alias("size"))).alias("files"))
        snapshots.write_documents(snapshots.manifest_json(rows, "document").select(F.lit("manifest.json").alias("file"), "value"), folder)

    return derived.made(spark, d, "manifest", write) + "/manifest.json"


@query("SELECT lower(n_name) AS document, 'NOR' || n_nationkey AS nor, sha256(n_name) AS pdf_sha256, 'BGBl. 1' AS kundmachung, 'RIS Bundesrecht konsolidiert' AS quelle, '2. Teil' AS teil FROM nation")
def c_manifest(spark, d):
    rows = snapshots.provenance(snapshots.manifest(spark, _manifest(spark, d)), F.lit("2. Teil"))
    return rows.select("document", "nor", "pdf_sha256", "provenienz.kundmachung", "provenienz.quelle", "provenienz.teil")


@query("SELECT lower(n_name) AS document, length(n_name) AS size, CAST(NULL AS VARCHAR) AS gone FROM nation")
def c_dotted_path(spark, d):
    raw = spark.read.text(_manifest(spark, d), wholetext=True)
    each = raw.select(F.explode(F.from_json("value", "map<string,variant>")).alias("document", "v")).withColumn("j", F.to_json("v"))
    return each.select("document", snapshots.path_value(F.col("j"), "files.pdf.size").cast("long").alias("size"), snapshots.path_value(F.col("j"), "files.xml.sha256").alias("gone"))


@query("""SELECT o_custkey, 'NOR' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS nor, c > 1 AS disambiguated FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) AS r,
  count(*) OVER (PARTITION BY o_custkey) AS c FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 <> 0) WHERE r = 1""")
def c_in_force(spark, d):
    o = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    rows = o.select("o_custkey", F.concat(F.lit("NOR"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("nor"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("inkrafttretensdatum"), F.when(F.col("o_orderstatus") == "F", "2020-01-01").otherwise(" ").alias("ausserkrafttretensdatum"), F.when(F.col("o_orderkey") % 7 == 0, "Anl. 2").otherwise("Anl. 1").alias("artikel_paragraph_anlage"))
    return snapshots.in_force(rows, ["o_custkey"]).select("o_custkey", "nor", "disambiguated")


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n, CASE n_nationkey % 3 WHEN 0 THEN 'b' || n_nationkey WHEN 1 THEN 'c' || n_nationkey END AS main FROM nation")
def c_one_or_many(spark, d):
    n = table(spark, d, "nation", "n_nationkey")
    k = F.col("n_nationkey").cast("string")
    value = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('{"x":[{"t":"Beilage","u":"a'), k, F.lit('"},{"t":"MainDocument","u":"b'), k, F.lit('"}]}'))).when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit('{"x":{"t":"Beilage","u":"c'), k, F.lit('"}}'))).otherwise("{}")
    listed = F.transform(snapshots.as_list(value, "x"), lambda v: F.struct(F.get_json_object(v, "$.t").alias("content_type"), F.get_json_object(v, "$.u").alias("url")))
    return n.select("n_nationkey", F.size(listed).alias("n"), snapshots.main_document(listed)["url"].alias("main"))


@query("SELECT s_suppkey AS datei, CASE WHEN s_suppkey % 2 = 0 THEN 'neu' ELSE 'alt' END AS url, CASE WHEN s_suppkey % 3 = 0 THEN 7 ELSE 1 END AS width FROM supplier")
def c_merged_registry(spark, d):
    s = table(spark, d, "supplier", "s_suppkey").withColumnRenamed("s_suppkey", "datei")
    old = s.where("datei % 2 = 1 or datei % 3 <> 0").select("datei", F.lit("alt").alias("url"), F.lit(1).alias("width"))
    new = s.where("datei % 2 = 0 or datei % 3 = 0").select("datei", F.when(F.col("datei") % 2 == 0, "neu").when(F.col("datei") % 3 == 0, F.when(F.col("datei") % 2 == 0, "neu")).alias("url"), F.when(F.col("datei") % 3 == 0, 7).alias("width"))
    return snapshots.merged_registry(old, new, "datei")


@query("""SELECT n_nationkey, 'https://daten.example/suche?Applikation=BrKons&Gesetzesnummer=100' || n_nationkey || '&Fassung.FassungVom=2025-01-01+10%3A00&Seitennummer=' || (n_nationkey + 1) AS url FROM nation""")
def c_search_url(spark, d):
    n = table(spark, d, "nation", "n_nationkey")
    return n.select("n_nationkey", snapshots.search_url("https://daten.example/suche", F.concat(F.lit("100"), F.col("n_nationkey").cast("string")), F.lit("2025-01-01 10:00"), F.col("n_nationkey") + 1).alias("url"))


@query("SELECT count(*) AS hits, count(DISTINCT n_nationkey) AS keys, 25 - min(n_nationkey) AS last FROM nation")
def c_all_pages(spark, d):
    keys = [r.n_nationkey for r in table(spark, d, "nation", "n_nationkey").orderBy("n_nationkey").collect()]  # 25 rows
    pages = lambda n: [{"key": k} for k in (keys + keys[:3])[(n - 1) * 10 : n * 10]]
    hits = snapshots.all_pages(pages, "key")
    return spark.createDataFrame([(len(hits), len({h["key"] for h in hits}), 25 - min(h["key"] for h in hits))], "hits long, keys long, last long")


def _png(width: int, height: int) -> bytes:
    return b"\x89PNG\r\n\x1a\n" + b"\x00\x00\x00\rIHDR" + width.to_bytes(4, "big") + height.to_bytes(4, "big") + b"\x08\x00\x00\x00\x00"


def _images(spark, d) -> str:
    def write(folder: str) -> None:
        snapshots.write_binary(spark, {f"bild{r.r_regionkey}.png": _png(100 + r.r_regionkey, 7) for r in table(spark, d, "region", "r_regionkey").collect()} | {"kein.png": b"GIF89a"}, folder)  # five rows

    return derived.made(spark, d, "images", write)


@query("SELECT 'bild' || r_regionkey || '.png' AS datei, 100 + r_regionkey AS width, 7 AS height, 29 AS bytes FROM region UNION ALL SELECT 'kein.png', NULL, NULL, 6")
def c_images(spark, d):
    return snapshots.images(spark, _images(spark, d)).select("datei", long("width"), long("height"), "bytes")


@query("SELECT 'bild' || r_regionkey || '.png' AS datei, true AS copied FROM region WHERE r_regionkey < 3")
def c_installed_images(spark, d):
    wanted = table(spark, d, "region", "r_regionkey").where("r_regionkey < 3").select(F.concat(F.lit("bild"), F.col("r_regionkey").cast("string"), F.lit(".png")).alias("datei"))
    source = _images(spark, d)
    return snapshots.install_images(spark, source, source + "-installed", wanted).select("datei", "copied")


@query("SELECT n_name AS document, 'rule' || (n_nationkey % 2) AS rule, 2 AS n FROM nation")
def c_deviation_log(spark, d):
    def write(folder: str) -> None:
        rows = table(spark, d, "nation", "n_nationkey", "n_name").select(F.col("n_name").alias("document"), F.concat(F.lit("rule"), (F.col("n_nationkey") % 2).cast("string")).alias("rule"), F.lit("m").alias("message"))
        for _ in range(2):
            snapshots.append_deviations(rows, folder)

    path = derived.made(spark, d, "deviations", write)
    return spark.read.schema("document string, rule string, message string").json(path).groupBy("document", "rule").agg(F.count("*").cast("int").alias("n"))


@query(sql("SELECT shard, slug, count(*) AS n FROM r GROUP BY ALL"))
def c_stored_parts(spark, d):
    k = nested_json.competences(_parts(spark, d)).select("shard", "bereich_slug", "id", "volltext")
    path = derived.made(spark, d, "stored", lambda folder: snapshots.write_parts(k, folder))
    return spark.read.parquet(path).groupBy("shard", F.col("bereich_slug").alias("slug")).agg(F.count("*").alias("n"))


@query(sql("SELECT attach_key AS block, count(*) AS n FROM i WHERE place = 'year' GROUP BY attach_key"))
def c_combined(spark, d):
    blocks = _parts(spark, d).where("shard = 'PRIM.SU'").select(F.explode("meta.anwendungsbereiche_bloecke").alias("block", "b")).select("block", F.to_json("b").alias("content"), F.size("b.items").cast("long").alias("n"))
    return snapshots.combined(blocks, "block", "content", "n").select("block", "n")


# -- lessons and anchors


def _lessons(spark, d) -> DataFrame:
    """A lesson for each record of SEK1.M's first area: a quote, its items under a label, and shared material."""
    r, i = derived.records(spark, d).where("s = 5 and a = 0"), derived.items(spark, d).where("place = 'nested'")
    per = i.groupBy(F.col("owner").alias("id")).agg(F.array_sort(F.collect_list(F.when(F.col("verbindlich"), F.col("item_text")))).alias("must"))
    r = r.join(per, "id", "left")
    wording = F.trim(F.concat_ws(" ", "stem", "wording"))
    quote = F.struct(F.lit("kompetenzbezug").alias("type"), F.when(F.col("k") % 13 == 0, F.concat("id", F.lit("9"))).otherwise(F.col("id")).alias("kompetenz_id"), F.when(F.col("k") % 7 == 0, F.lit("anders")).otherwise(wording).alias("text"), F.struct(F.lit("Amtsblatt").alias("quelle"), F.lit("Lehrplan").alias("kurztitel"), F.lit("NOR5").alias("nor")).alias("quelle"))
    claim = F.struct(F.lit("list").alias("type"), F.when(F.col("k") % 4 == 1, "Optionale Inhalte").otherwise("Verbindliche Inhalte").alias("label"), F.when(F.col("k") % 9 == 2, F.array(F.lit("erfunden"))).otherwise(F.coalesce("must", F.array().cast("array<string>"))).alias("items"))
    shared = F.struct(F.struct(F.lit("Frag nach.").alias("teacher"), F.lit("Rechne.").alias("student")).alias("p1"))
    blocks = F.array(F.to_json(quote), F.to_json(claim), F.lit('{"type":"from_shared","key":"p1"}'), F.lit('{"type":"workspace"}'))
    doc = lambda audience: F.concat(F.lit('{"id":"'), F.lit(audience), F.lit('","audience":"'), F.lit(audience), F.lit('","title":"T","sections":[{"heading":"H","blocks":['), F.array_join(blocks, ","), F.lit("]}]}"))
    tree = F.concat(F.lit('{"shared":'), F.to_json(F.struct(shared.alias("shared"))), F.lit(',"documents":['), doc("teacher"), F.lit(","), doc("student"), F.lit("]}"))
    return r.select(F.col("id").alias("lesson"), F.replace(tree, F.lit('{"shared":{"shared":'), F.lit('{"shared":')).alias("tree")).withColumn("tree", F.replace("tree", F.lit('}}},"documents"'), F.lit('}},"documents"')))


_CLAIMS = """v AS (SELECT r.*, trim(stem || ' ' || wording) AS full_text, (SELECT list_sort(list(item_text)) FROM i WHERE i.owner = r.id AND verbindlich) AS must FROM r WHERE s = 5 AND a = 0),
  c AS (SELECT id AS lesson, 'id-unaufloesbar' AS rule, 2 AS n FROM v WHERE k % 13 = 0
    UNION ALL SELECT id, 'zitat-nicht-wortgetreu', 2 FROM v WHERE k % 13 <> 0 AND k % 7 = 0
    UNION ALL SELECT id, CASE WHEN k % 4 = 1 THEN 'erfundenes-optionales-item' ELSE 'erfundenes-verbindliches-item' END, 2 FROM v WHERE k % 9 = 2
    UNION ALL SELECT id, CASE WHEN k % 4 = 1 THEN 'erfundenes-optionales-item' ELSE 'erfundenes-verbindliches-item' END, 2 * len(must) FROM v WHERE k % 9 <> 2 AND must IS NOT NULL AND k % 13 = 0
    UNION ALL SELECT id, 'verbindliches-item-als-optional-ausgegeben', 2 * len(must) FROM v WHERE k % 9 <> 2 AND must IS NOT NULL AND k % 13 <> 0 AND k % 4 = 1)"""


@query(sql(f"{_CLAIMS} SELECT lesson, rule, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL"))
def c_anchor_violations(spark, d):
    parts = _parts(spark, d)
    k = nested_json.competences(parts).select("id", "volltext", F.to_json("provenienz").alias("provenienz"))
    truth = nested_json.items(parts).where("shard = 'SEK1.M'").select(F.col("attach_key").alias("kompetenz_id"), "text", "verbindlich")
    return anchor.violations(_lessons(spark, d), "lesson", "tree", k, truth).groupBy("lesson", "rule").agg(F.count("*").alias("n"))


@query(sql("""v AS (SELECT id, k FROM r WHERE s = 5 AND a = 0), b AS (SELECT id AS lesson, unnest(['kompetenzbezug', 'list', 'from_shared', 'workspace', 'kompetenzbezug', 'list', 'from_shared', 'workspace']) AS type FROM v) SELECT lesson, type, count(*) AS n FROM b GROUP BY ALL"""))
def c_block_walk(spark, d):
    return anchor.blocks(_lessons(spark, d), "lesson", "tree").where("type is not null").groupBy("lesson", "type").agg(F.count("*").alias("n"))


@query(sql("""v AS (SELECT id, k, CASE WHEN k % 7 = 0 THEN 'anders' ELSE trim(stem || ' ' || wording) END AS quote, CASE WHEN k % 13 = 0 THEN id || '9' ELSE id END AS named, CASE WHEN k % 4 = 1 THEN 'Optionale Inhalte' ELSE 'Verbindliche Inhalte' END AS label,
    CASE WHEN k % 9 = 2 THEN ['erfunden'] ELSE coalesce((SELECT list_sort(list(item_text)) FROM i WHERE i.owner = r.id AND verbindlich), []) END AS entries FROM r WHERE s = 5 AND a = 0),
  h AS (SELECT id, k, '<div class="anchor"><b>Kompetenzbezug ' || named || '</b><p>„' || regexp_replace(quote, '⟦ABB:([^⟧]+)⟧', '<img src="\\1" alt="\\1">', 'g') || '“</p><p class="source">Quelle: Lehrplan (NOR: NOR5)</p></div><p><b>' || label || '</b></p><ul>' || array_to_string(list_transform(entries, lambda e: '<li>' || e || '</li>'), '') || '</ul>' AS body FROM v),
  a AS (SELECT 'teacher' AS audience, '<p class="instructions">Frag nach.</p><div class="together"><p><b>Sicht der Schüler:innen:</b> Rechne.</p><div class="workspace"></div></div>' AS tail UNION ALL SELECT 'student', '<div class="together"><p>Rechne.</p><div class="workspace"></div></div>')
  SELECT id AS lesson, audience AS document, '<!DOCTYPE html><html lang="de"><head><meta charset="utf-8"><title>T</title></head><body><h1>T</h1><section><h2>H</h2>' || body || tail || '</section></body></html>' AS html FROM h, a"""))
def c_lesson_pages(spark, d):
    return lessons.render(_lessons(spark, d), "lesson", "tree").select("lesson", "document", "html")


@query(sql("""SELECT id, array_to_string(list_filter([CASE WHEN k % 10 = 7 THEN 'text:' || p_name || ' ' ELSE 'text:' || p_name END, CASE WHEN k % 10 = 7 THEN 'image:bild' || k % 4 || '.png' END], lambda x: x IS NOT NULL), '|') AS runs FROM r"""))
def c_image_runs(spark, d):
    k = nested_json.competences(_parts(spark, d))
    return k.select("id", _joined(F.transform(lessons.image_runs(F.col("text")), lambda r: F.concat_ws(":", r["kind"], r["value"]))).alias("runs"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'eigen' ELSE 'gemeinsam' END AS a, 'gemeinsam' AS b FROM nation")
def c_merged_maps(spark, d):
    n = table(spark, d, "nation", "n_nationkey")
    own = F.when(F.col("n_nationkey") % 2 == 0, F.create_map(F.lit("a"), F.lit("eigen"))).otherwise(F.create_map().cast("map<string,string>"))
    m = lessons.merged(F.create_map(F.lit("a"), F.lit("gemeinsam"), F.lit("b"), F.lit("gemeinsam")), own)
    return n.select("n_nationkey", m["a"].alias("a"), m["b"].alias("b"))


# -- functions


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN 'ABX' ELSE upper(substr('GROE' || regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g'), 1, 12)) END AS slug,
  CASE WHEN s_suppkey % 4 = 0 THEN 'X' ELSE '' END || upper(substr(CASE WHEN s_suppkey % 4 = 0 THEN '7' ELSE '' END || regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g'), 1, 24)) AS plain FROM supplier""")
def c_slugs(spark, d):
    s = table(spark, d, "supplier", "s_suppkey", "s_name")
    name = F.when(F.col("s_suppkey") % 10 == 0, F.lit("a-b")).otherwise(F.concat(F.lit("Größe "), "s_name"))
    plain = F.concat(F.when(F.col("s_suppkey") % 4 == 0, "7").otherwise(""), F.col("s_name"))
    return s.select("s_suppkey", tx.slug(name).alias("slug"), tx.plain_slug(plain).alias("plain"))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Lehrplan, 2. Teil, BGBl. 1 (NOR: NOR' || s_suppkey || '; Stand: 2025-01-01)' WHEN 1 THEN 'Lehrplan (NOR: NOR' || s_suppkey || ')' ELSE '' END AS citation FROM supplier""")
def c_citations(spark, d):
    s = table(spark, d, "supplier", "s_suppkey")
    k = F.col("s_suppkey") % 3
    return s.select("s_suppkey", tx.citation(F.when(k < 2, "Lehrplan").otherwise(" "), F.when(k == 0, "2. Teil"), F.when(k == 0, "BGBl. 1").otherwise(""), F.when(k < 2, F.concat(F.lit("NOR"), F.col("s_suppkey").cast("string"))), F.when(k == 0, "2025-01-01")).alias("citation"))


@query(sql("SELECT k, CASE WHEN o < 48 THEN id END AS id, CASE WHEN l = 4 AND s IN (3, 4, 5) THEN NULL ELSE 'K' || l END AS level FROM r"))
def c_minted(spark, d):
    r = derived.records(spark, d)
    n = F.when(F.col("o") < 48, F.col("o")).otherwise(F.col("o") + 60)
    part = lambda i: F.split("shard", "[.]")[i]
    return r.select("k", ids.mint(part(0), part(1), F.col("slug"), F.col("stufe"), n).alias("id"), F.when(~((F.col("l") == 4) & (F.col("s") >= 3)), build.level_code("SEK1.M", F.col("l").cast("string"))).alias("level"))


@query("""SELECT s_suppkey, lower(replace(s_name, '#', ' ')) || ' "x" - y' AS form FROM supplier""")
def c_match_form(spark, d):
    s = table(spark, d, "supplier", "s_suppkey", "s_name")
    text = F.concat(F.lit("Die Schülerinnen und Schüler können:  "), F.replace("s_name", F.lit("#"), F.lit("  ")), F.lit(" „x“ – y .;"))
    return s.select("s_suppkey", tx.match_form(text, tx.STEM).alias("form"))


@query("""SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN n_nationkey % 9 + 1 END AS number, CASE n_regionkey WHEN 0 THEN n_name WHEN 1 THEN n_name WHEN 2 THEN n_name WHEN 3 THEN n_name || 'er Kompetenzbereich' END AS name FROM nation""")
def c_area_forms(spark, d):
    n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r, name = F.col("n_regionkey"), F.col("n_name")
    heading = F.when(r == 0, F.concat(F.lit("Kompetenzbereich "), (F.col("n_nationkey") % 9 + 1).cast("string"), F.lit(": "), name, F.lit(" "))).when(r == 1, F.concat(F.lit("Integrativer Kompetenzbereich "), name)).when(r == 2, F.concat(F.lit("Kompetenzbereich "), name)).when(r == 3, F.concat(name, F.lit("er Kompetenzbereich"))).otherwise(F.concat(F.lit("Bereich "), name))
    found = F.when(r == 0, build.area_name(heading, "numbered")).when(r == 1, build.area_name(heading, "unnumbered")).when(r == 2, build.area_name(heading, "plain")).otherwise(build.area_name(heading, "adjective"))
    return n.select("n_nationkey", found["number"].alias("number"), found["name"].alias("name"))


@query("SELECT n_nationkey, 'Umwelt=13|Wirtschafts-, Finanzbildung=4|' || CASE WHEN n_nationkey % 2 = 0 THEN 'ohne Zahl' ELSE 'N' || chr(CAST(65 + n_regionkey AS INT)) || '=7' END AS themes FROM nation")
def c_theme_sentence(spark, d):
    n = table(spark, d, "nation", "n_nationkey", "n_regionkey")
    last = F.when(F.col("n_nationkey") % 2 == 0, F.lit("ohne Zahl.")).otherwise(F.concat(F.lit("N"), F.char(F.col("n_regionkey") + 65), F.lit("7.")))
    text = F.concat(F.lit("Umwelt13, Wirtschafts-, Finanzbildung4, "), last)
    return n.select("n_nationkey", _joined(F.transform(tx.theme_sentence(text), lambda t: F.concat_ws("=", t["name"], t["number"]))).alias("themes"))


@query("SELECT doc_id AS key, CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'common' WHEN l.doc_id IS NULL THEN 'removed' ELSE 'added' END AS side FROM documents d FULL JOIN labels l USING (doc_id)")
def c_key_sets(spark, d):
    return diff.key_sets(table(spark, d, "documents", "doc_id"), table(spark, d, "labels", "doc_id"), "doc_id").withColumnRenamed("doc_id", "key")


@query("SELECT c_custkey, n_name AS name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 1 AND c_custkey % 2 = 0 UNION ALL SELECT c_custkey, '' FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 1 AND c_custkey % 2 = 0")
def c_resolved_references(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_nationkey").where("c_custkey % 2 = 0").select("c_custkey", F.array("c_nationkey").alias("refs"))
    found = graph.resolve(c, "c_custkey", "refs", table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey"), "n_nationkey", F.col("b.n_regionkey") == 1)
    names = table(spark, d, "nation", "n_nationkey", "n_name")
    return found.join(names, found["target"] == names["n_nationkey"]).select(F.col("key").alias("c_custkey"), F.when(F.col("status") == "ok", F.col("n_name")).otherwise("").alias("name"))


# -- a regulation with the whole grammar of its sections

_LAW = regulation.Subject("SEK1.M", "MATHEMATIK", "ACHTER TEIL", "kompetenz", items=r"^Anwendungsbereiche\b.*\(", paragraph_areas=True, optional_items=True)


def _law(spark, d) -> dict[str, DataFrame]:
    return regulation.build(tree_xml.xml_events(spark, derived.xml_root(spark, d, "law", derived.LAW)), _LAW)


_LAW_ID = "'AT.LP23.SEK1.M.' || {} || '.K' || l || '.' || lpad(CAST(row_number() OVER (PARTITION BY doc, l ORDER BY o) AS VARCHAR), 2, '0')"


@query(law_sql("""SELECT doc, idx, pos, CASE WHEN g = 1 THEN 'preamble' WHEN g = 2 THEN 'preamble' WHEN g < 2000000 THEN 'competences' WHEN g < 3000000 THEN 'items' WHEN g < 4000000 THEN 'integrated' WHEN g < 6000000 THEN 'appendix' ELSE 'after' END AS state
  FROM e JOIN d USING (doc) WHERE a % 5 <> 4 AND g BETWEEN 1 AND 6000000 UNION ALL SELECT doc, idx, pos, 'wrong_part' FROM e JOIN d USING (doc) WHERE a % 5 = 4 AND g = 1"""))
def c_law_states(spark, d):
    return _law(spark, d)["events"].select("doc", long("idx"), long("pos"), "state")


@query(law_sql(f"""SELECT doc, {_LAW_ID.format("'BEREICH' || a")} AS id, 1 AS bereich_nummer, area_name AS bereich_name, CASE WHEN l = 3 THEN '' ELSE 'Die Schülerinnen und Schüler können' END AS stammsatz, entry AS text FROM q WHERE a % 5 <> 4
  UNION ALL SELECT doc, {_LAW_ID.format("'GZINTEGRATIV'")}, NULL, 'Integrative Führung von Geometrisches Zeichnen', 'Die Schülerinnen und Schüler können', 'zeichnen ' || entry FROM q WHERE a % 5 <> 4 AND o % 10 = 4 AND l > 2"""))
def c_law_competences(spark, d):
    return _law(spark, d)["competences"].select("doc", "id", "bereich_nummer", "bereich_name", "stammsatz", "text")


@query(law_sql("""t AS (SELECT *, 0 AS p, CASE WHEN k % 3 = 0 THEN 'allenfalls ' ELSE '' END || p_type || ' addieren' AS text, k % 3 <> 0 AS verbindlich, false AS wiederholung FROM q WHERE o % 10 IN (1, 2, 3)
  UNION ALL SELECT *, 1, 'Wiederholen und Festigen: ' || p_type, true, true FROM q WHERE o % 10 = 1),
  n AS (SELECT *, CASE WHEN o % 10 = 2 THEN 'DT' ELSE 'AB' END AS art FROM t WHERE a % 5 <> 4),
  m AS (SELECT *, row_number() OVER (PARTITION BY doc, l, art ORDER BY o, p) AS ordinal FROM n)
  SELECT doc, CASE WHEN ordinal < 100 THEN 'AT.LP23.SEK1.M.' || art || '.BEREICH' || a || '.K' || l || '.' || lpad(CAST(ordinal AS VARCHAR), 2, '0') END AS id, art, text, verbindlich, wiederholung,
    CASE WHEN o % 10 = 1 THEN 'Die Schülerinnen und Schüler können ' || entry END AS block_text, o % 10 <> 3 AS attached FROM m"""))
def c_law_items(spark, d):
    return _law(spark, d)["items"].select("doc", "id", "art", "text", "verbindlich", "wiederholung", "block_text", F.col("block_idx").isNotNull().alias("attached"))


@query(law_sql("SELECT doc, 'Didaktische Hinweise' AS titel, 'K1' AS stufe, 'Hinweis ' || entry AS text FROM q WHERE o % 10 = 5 AND l = 1 AND a % 5 <> 4"))
def c_law_extras(spark, d):
    return _law(spark, d)["extras"].select("doc", "titel", "stufe", "text")


@query(law_sql("""SELECT doc, 'subject-in-wrong-part' AS rule, 1 AS n FROM d WHERE a % 5 = 4
  UNION ALL SELECT doc, 'unknown-heading', 1 FROM d WHERE a % 5 <> 4
  UNION ALL SELECT doc, 'unmapped-area', 2 * count(*) FROM dl WHERE a % 5 <> 4 GROUP BY doc
  UNION ALL SELECT doc, 'competence-without-stem', 1 FROM dl WHERE l = 3 AND a % 5 <> 4
  UNION ALL SELECT doc, 'items-without-sentence', count(*) FROM q WHERE o % 10 = 3 AND a % 5 <> 4 GROUP BY doc"""))
def c_law_issues(spark, d):
    return _law(spark, d)["issues"].groupBy("doc", "rule").agg(F.count("*").alias("n"))


@query(law_sql("""SELECT doc, kind, number, name FROM d, (VALUES ('legend', '6', 'Umwelt'), ('legend', '7', 'Sprache'), ('subject', '6', 'Umwelt'), ('subject', '7', 'Sprach-, Medien- und Lesebildung')) v(kind, number, name) WHERE a % 5 <> 4
  UNION ALL SELECT doc, 'area', 'BEREICH' || a, area_name FROM d WHERE a % 5 <> 4"""))
def c_law_names(spark, d):
    t = _law(spark, d)
    rows = t["legend"].select("doc", F.lit("legend").alias("kind"), "number", "name").unionByName(t["themes"].select("doc", F.lit("subject").alias("kind"), "number", "name"))
    return rows.unionByName(t["areas"].select("doc", F.lit("area").alias("kind"), F.col("slug").alias("number"), "name"))


@query(law_sql("""SELECT doc, 'Titel ' || doc AS kurztitel, 'ACHTER TEIL' AS teil, 'K' || l AS stufe, 'A' || l || '+' AS niveau, 'In allen vier Kompetenzbereichen wird das Zielniveau A' || l || '+ angestrebt.' AS satz, 'Kompetenzbereiche (1. bis 4. Klasse):' AS abschnitt
  FROM dl WHERE l <> 2 AND a % 5 <> 4"""))
def c_law_subjects(spark, d):
    events = tree_xml.xml_events(spark, derived.xml_root(spark, d, "law", derived.LAW))
    e = staged(regulation.with_places(events, _LAW), "places")
    level = "map<string,struct<niveau:string,satz:string,abschnitt:string,quell_index:int>>"
    axis = F.struct(F.lit("gers").alias("typ"), F.struct(F.create_map().cast(level).alias("je_stufe"), F.lit(False).alias("je_stufe_ausgewiesen")).alias("gers"))
    columns = {"nor": F.lit("NOR1"), "kurztitel": F.concat(F.lit("Titel "), "document"), "kundmachungsorgan": F.lit("BGBl."), "artikel_paragraph_anlage": F.lit("Anl. 1"), "retrieval_date": F.lit("2025-01-01")}
    manifest = events.select(F.col("doc").alias("document")).distinct().withColumns(columns)
    rows = regulation.subjects(e, _LAW, axis, manifest).where("achse.gers.je_stufe_ausgewiesen")
    rows = rows.select("doc", "provenienz.kurztitel", "provenienz.teil", F.explode("achse.gers.je_stufe").alias("stufe", "v"))
    return rows.select("doc", "kurztitel", "teil", "stufe", "v.niveau", "v.satz", "v.abschnitt")


# -- documents against a schema

_ORDER_SCHEMA = {
    "type": "object",
    "required": ["id", "status", "customer", "notes"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 1},
        "status": {"enum": ["F", "O"]},
        "customer": {"$ref": "#/$defs/customer"},
        "notes": {"type": "array", "maxItems": 2, "items": {"oneOf": [{"type": "string", "minLength": 1}, {"$ref": "#/$defs/note"}]}},
    },
    "$defs": {
        "customer": {"type": "object", "required": ["key", "price"], "properties": {"key": {"type": "string", "pattern": "^C[0-9]+$"}, "price": {"type": "number", "exclusiveMaximum": 150000}}},
        "note": {"type": "object", "properties": {"to": {"type": "array", "items": {"type": "object", "required": ["name"], "properties": {"name": {"const": "x"}}}}}, "required": ["to"]},
    },
}
#: o: an order as JSON; what breaks the schema follows from its key
_ORDERS = """o AS (SELECT o_orderkey AS k, CAST(o_totalprice AS BIGINT) AS price, o_orderstatus AS st, '{{"id":' || CAST(o_orderkey - CASE WHEN o_orderkey % 5 = 0 THEN 100000000000 ELSE 0 END AS STRING) || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ',"status":"' || o_orderstatus || '"' END
  || ',"customer":{{"key":"' || CASE WHEN o_orderkey % 11 = 0 THEN 'K' ELSE 'C' END || CAST(o_custkey AS STRING) || '","price":' || CAST(CAST(o_totalprice AS BIGINT) AS STRING) || '}},"notes":['
  || CASE o_orderkey % 6 WHEN 0 THEN '"a","b","c"' WHEN 1 THEN '""' WHEN 2 THEN '{{"to":[{{"name":"x"}},{{"name":"y"}},{{}}]}}' WHEN 3 THEN '5,"a"' WHEN 4 THEN '{{"to":[{{"name":"x"}}]}}' ELSE '' END || ']'
  || CASE WHEN o_orderkey % 13 = 0 THEN ',"more":1' ELSE '' END || CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE '}}' END AS text FROM {orders})"""


@query(f"""WITH {_ORDERS.format(orders='orders')}, v AS (SELECT * FROM o WHERE k % 17 <> 0), x AS (SELECT k, '' AS path, 'json' AS keyword FROM o WHERE k % 17 = 0
  UNION ALL SELECT k, '/id', 'minimum' FROM v WHERE k % 5 = 0 UNION ALL SELECT k, '/status', 'required' FROM v WHERE k % 7 = 0 UNION ALL SELECT k, '/status', 'enum' FROM v WHERE k % 7 <> 0 AND st NOT IN ('F', 'O')
  UNION ALL SELECT k, '/customer/key', 'pattern' FROM v WHERE k % 11 = 0 UNION ALL SELECT k, '/customer/price', 'exclusiveMaximum' FROM v WHERE price >= 150000
  UNION ALL SELECT k, '/notes', 'maxItems' FROM v WHERE k % 6 = 0 UNION ALL SELECT k, '/notes/0', 'oneOf' FROM v WHERE k % 6 IN (1, 2, 3) UNION ALL SELECT k, '/more', 'additionalProperties' FROM v WHERE k % 13 = 0)
  SELECT k, path, keyword FROM x""")
def c_schema_violations(spark, d):
    # SQL's cast to a whole number rounds, halves to even ones; Spark's cuts off
    rounded = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").withColumn("o_totalprice", F.rint("o_totalprice"))
    o = spark.sql(f"WITH {_ORDERS} SELECT k, text FROM o", orders=rounded)
    return schema_check.violations(o, "k", "text", _ORDER_SCHEMA)


# -- a paged service, published files, conversions by content, postings that follow changes

_HITS = """h AS (SELECT c_custkey AS k, c_name AS name, CAST(floor(c_custkey / 40) AS INT) + 1 AS page FROM {customer} UNION ALL SELECT c_custkey, 'late', CAST(floor(c_custkey / 40) AS INT) FROM {customer} WHERE c_custkey % 40 = 0 AND c_custkey > 0)"""


@query(f"WITH {_HITS.format(customer='customer')} SELECT CAST(k AS VARCHAR) AS key, min(page) AS page, arg_min(name, page) AS name FROM h GROUP BY k")
def c_paged_hits(spark, d):
    hits = spark.sql(f"WITH {_HITS} SELECT * FROM h", customer=table(spark, d, "customer", "c_custkey", "c_name"))
    pages = hits.groupBy("page").agg(F.to_json(F.collect_list(F.struct("k", "name"))).alias("value"))  # some forty hits a page
    folder = derived.made(spark, d, "hits", lambda to: publish.publish(pages.select(F.concat("page", F.lit(".json")).alias("file"), "value"), to))

    def fetch(page: int) -> list[dict]:
        files, place = publish._place(f"{folder}/{page}.json")
        with files.open_input_stream(place) as stream:
            return json.loads(stream.read())

    source = paged.paged_source("lexigraph_hits", fetch, pages.agg(F.max("page")).first()[0] or 0)
    return paged.once(paged.hits(spark, source), "k").select("key", "page", F.get_json_object("hit", "$.name").alias("name"))


@query("SELECT s_nationkey || '/' || s_suppkey || '.txt' AS file, s_name AS value FROM supplier")
def c_published_files(spark, d):
    s = table(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_name")
    folder = derived.made(spark, d, "published", lambda to: publish.publish(s.select(F.concat("s_nationkey", F.lit("/"), "s_suppkey", F.lit(".txt")).alias("file"), F.col("s_name").alias("value")), to))
    rows = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    return rows.select(F.array_join(F.slice(F.split("_metadata.file_path", "/"), -2, 2), "/").alias("file"), F.rtrim(F.replace("value", F.lit("\n"), F.lit(""))).alias("value"))


def _shouted(content: bytes) -> str | None:
    return content.decode().upper() if content != b"-" else None


@query("""SELECT 'deutsch/' || s_suppkey || '.pdf' AS pfad, CASE WHEN s_suppkey % 9 > 0 THEN upper('land ' || s_nationkey) END AS text, (SELECT count(DISTINCT CASE WHEN s_suppkey % 9 > 0 THEN s_nationkey ELSE -1 END) FROM supplier) AS conversions FROM supplier""")
def c_conversions(spark, d):
    s = table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    content = F.when(F.col("s_suppkey") % 9 > 0, F.concat(F.lit("land "), "s_nationkey")).otherwise("-").cast("binary")
    folder = derived.made(spark, d, "pdf", lambda to: publish.publish(s.select(F.concat(F.lit("deutsch/"), "s_suppkey", F.lit(".pdf")).alias("file"), content.alias("value")), to))
    scan = lambda store: docs.scan(spark, folder, extractors={"pdf": (_shouted,)}, store=store)
    store = derived.made(spark, d, "conversions", lambda to: scan(to).count())
    made = spark.read.schema(docs.STORED).parquet(store).agg(F.count("*").alias("conversions"))
    return scan(store).select("pfad", "text").crossJoin(F.broadcast(made))  # one row


@query(r"""WITH c AS (SELECT conv_id || '.' || turn AS key, CASE WHEN conv_id % 5 = 1 THEN 'moved' ELSE role END AS part, CASE WHEN conv_id % 5 = 2 THEN reverse(text) ELSE text END AS text FROM conversations WHERE conv_id % 5 <> 3),
  p AS (SELECT DISTINCT part, replace(lower(t), 'ß', 'ss') AS term FROM (SELECT part, unnest(regexp_extract_all(text, '[\p{L}\p{Nl}\p{No}]+')) AS t FROM c) WHERE length(t) >= 4)
  SELECT term, string_agg(part, ',' ORDER BY part) AS parts FROM p GROUP BY term HAVING count(*) <= 2""")
def c_followed_postings(spark, d):
    c = table(spark, d, "conversations", "conv_id", "turn", "role", "text").select(F.concat_ws(".", "conv_id", "turn").alias("key"), F.col("role").alias("part"), "text", F.lit(0).alias("version"), (F.col("conv_id") % 5).alias("m"))
    changed = c.where("m in (1, 2, 3)").select("key", F.when(F.col("m") == 1, "moved").otherwise(F.col("part")).alias("part"), F.when(F.col("m") == 1, F.col("text")).when(F.col("m") == 2, F.reverse("text")).alias("text"), "version")

    def write(folder: str) -> None:
        postings.apply(spark, folder, 0, c.drop("m"))
        postings.apply(spark, folder, 1, changed.where("key not like '%.0'"))
        postings.compact(spark, folder)
        postings.apply(spark, folder, 2, changed.where("key like '%.0'"))

    folder = f"{shared_dir(spark)}/lexigraph/followed-{uuid.uuid4().hex}"
    write(folder)
    return postings.current_index(spark, folder).select("term", F.array_join("parts", ",").alias("parts"))


# -- every rule on records, each with records that break it

#: w: a record for each order line, whose key says what is wrong with it
_WALK = """b AS (SELECT p_partkey AS k, p_name AS t, CASE WHEN p_partkey % 2 = 0 THEN 'SEK1.D' ELSE 'SEK1.M' END AS shard, CASE WHEN p_partkey % 4 < 2 THEN 'item' ELSE 'kompetenz' END AS kind, CAST(CAST(floor(p_partkey / 90) AS BIGINT) AS STRING) AS a, lpad(CAST(p_partkey % 90 + 1 AS STRING), 2, '0') AS o FROM {part}),
  w AS (SELECT k, shard, 'a.json' AS datei, kind, CAST(k AS STRING) AS path,
    CASE WHEN k % 7 = 1 THEN NULL WHEN k % 13 = 3 THEN 'bad' || CAST(k AS STRING) WHEN kind = 'kompetenz' AND k % 43 = 10 THEN 'AT.LP23.SEK1.M.DOPPELT.K1.01' WHEN kind = 'kompetenz' THEN 'AT.LP23.' || shard || '.A' || a || '.K1.' || o WHEN k % 41 = 12 THEN 'AT.LP23.' || shard || '.AB.K2.' || o ELSE 'AT.LP23.' || shard || '.AB.A' || a || '.K1.' || o END AS id,
    CASE WHEN k % 11 = 2 THEN ' ' WHEN k % 19 = 5 THEN 'X9' ELSE 'K1' END AS stufe, CASE WHEN k % 47 = 1 THEN '' ELSE t || CASE WHEN k % 23 = 6 THEN ' ⟦ABB:a.png⟧' ELSE '' END END AS text, CAST(CASE WHEN k % 17 = 4 THEN 0 ELSE 1 END AS INT) AS ordinal,
    CASE WHEN k % 31 = 8 THEN 'ANDERS' WHEN k % 5 = 0 THEN NULL ELSE 'A' || a END AS slug, k % 29 = 7 AS entry, CASE WHEN kind = 'item' THEN CASE WHEN k % 37 = 9 THEN 'neu' WHEN k % 37 = 10 THEN '' ELSE 'praezisierung' END END AS art, CASE WHEN kind = 'item' THEN CASE WHEN k % 3 = 0 THEN 'false' WHEN k % 53 = 2 THEN NULL ELSE 'true' END END AS verbindlich,
    CASE WHEN kind = 'item' AND k % 10 = 1 THEN 'AT.X' END AS own, CASE WHEN kind = 'kompetenz' AND k % 59 = 3 THEN 'AT.fehlt' || CAST(k AS STRING) END AS ref FROM b)"""


@query(f"""WITH {_WALK.format(part='part')}, v AS (SELECT *, shard || '/a.json/' || path AS loc, coalesce(CASE WHEN kind = 'kompetenz' THEN regexp_full_match(id, 'AT[.]LP23[.]SEK1[.][DM][.][A-Z][A-Z0-9]*[.]K1[.][0-9]{{2}}') ELSE regexp_full_match(id, 'AT[.]LP23[.]SEK1[.][DM][.]AB[.](A[0-9]+[.])?K[12][.][0-9]{{2}}') END, false) AS good, coalesce(id LIKE '%.AB.K2.%', false) AS free FROM w),
  x AS (SELECT 'hard' AS severity, 'missing-required-field' AS rule, loc AS record, 'id' AS message FROM v WHERE id IS NULL UNION ALL SELECT 'hard', 'missing-required-field', loc, 'stufe' FROM v WHERE trim(stufe) = '' UNION ALL SELECT 'hard', 'missing-required-field', loc, 'text' FROM v WHERE text = ''
  UNION ALL SELECT 'hard', 'missing-required-field', loc, 'art' FROM v WHERE art = '' UNION ALL SELECT 'hard', 'missing-required-field', loc, 'verbindlich' FROM v WHERE kind = 'item' AND verbindlich IS NULL
  UNION ALL SELECT 'soft', 'malformed-id', loc, id FROM v WHERE id IS NOT NULL AND NOT good UNION ALL SELECT 'soft', 'schema-violation', loc, 'ordinal must be a positive number' FROM v WHERE ordinal < 1 UNION ALL SELECT 'soft', 'schema-violation', loc, 'stufe=' || stufe FROM v WHERE stufe <> 'K1'
  UNION ALL SELECT 'soft', 'orphan-token-no-abbildung-entry', loc, 'a.png' FROM v WHERE text LIKE '%ABB:%' UNION ALL SELECT 'soft', 'orphan-abbildung-entry-no-token', loc, 'b.png' FROM v WHERE entry
  UNION ALL SELECT 'soft', 'unknown-area-code', loc, id FROM v WHERE slug IS NOT NULL AND NOT free AND split_part(id, '.', CASE WHEN kind = 'kompetenz' THEN 5 ELSE 6 END) <> slug AND id NOT LIKE 'bad%'
  UNION ALL SELECT 'soft', 'kompetenz-id-not-allowed-for-binding', loc, own FROM v WHERE own IS NOT NULL AND shard = 'SEK1.D' UNION ALL SELECT 'soft', 'area-free-id-outside-stufe-binding', loc, id FROM v WHERE free
  UNION ALL SELECT 'soft', 'verbindlich-false-outside-sek1-m', loc, id FROM v WHERE verbindlich = 'false' AND shard = 'SEK1.D' UNION ALL SELECT 'info', 'unknown-enum-value', loc, art FROM v WHERE art IN ('neu', '')
  UNION ALL SELECT 'hard', 'id-collision', id, CAST(count(*) AS VARCHAR) FROM v WHERE good GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'soft', 'dangling-reference', id, ref FROM v WHERE ref IS NOT NULL)
  SELECT severity, rule, record, message FROM x""")
def c_planted_findings(spark, d):
    w = spark.sql(f"WITH {_WALK} SELECT * FROM w", part=table(spark, d, "part", "p_partkey", "p_name"))
    entry = F.when(F.col("entry"), F.array(F.struct(F.lit("b.png").alias("datei"))))
    record = F.to_json(F.struct("k", "art", "verbindlich", F.col("own").alias("kompetenz_id"), entry.alias("abbildungen"), F.when(F.col("ref").isNotNull(), F.array("ref")).alias("vorlaeufer")))
    walk = w.select("shard", "datei", "kind", "path", "id", "stufe", "text", "ordinal", F.col("slug").alias("bereich_slug"), F.lit(False).alias("repeats"), record.alias("record"))
    meta = spark.createDataFrame([("SEK1.D", "bereich", "SEK1", "D"), ("SEK1.M", "kompetenz", "SEK1", "M")], "shard string, bindung string, band string, fach_code string")
    return validate.record_findings(walk, meta)


@query("""WITH n AS (SELECT DISTINCT left(replace(text, 'e', CASE WHEN item_id % 3 = 0 THEN 'e' ELSE '~' END), 40) AS needle FROM benchmark),
  c AS (SELECT needle, i, left(needle, i) AS p FROM n, range(0, 41) r(i) WHERE i <= length(needle)),
  f AS (SELECT needle, max(i) AS i FROM c WHERE i = 0 OR EXISTS (SELECT 1 FROM documents WHERE contains(text, p)) GROUP BY needle) SELECT needle, left(needle, CAST(i AS INT)) AS prefix FROM f""")
def c_located_prefixes(spark, d):
    b = table(spark, d, "benchmark", "item_id", "text")
    needle = F.left(F.replace("text", F.lit("e"), F.when(F.col("item_id") % 3 == 0, "e").otherwise("~")), F.lit(40))
    return match.located_prefixes(b.select(needle.alias("needle")), "needle", table(spark, d, "documents", "text"), "text")
