"""The dataset validator: every rule a frame of findings, all of them one frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import IMAGE
from ..operators import quality as q, schema_check
from ..operators.index import part_catalog
from ..session import small, staged
from ..sources import nested_json

# fixed values: the legal values of closed and open fields
BINDINGS = ["kompetenz", "bereich", "stufe", "prosa", "keine"]
SOURCES = ["aus_anwendungsbereichen", "eigen_ausgewiesen"]
RELATIONS = ["verordnet", "keine_verordnung"]
ARTS = ["praezisierung", "digitale_technologien"]
BANDS = ["PRIM", "SEK1"]
REGISTRY = ("nor", "url", "width", "height", "sha256")


def record_walk(parts: DataFrame) -> DataFrame:
    """(shard, datei, kind, path, id, stufe, text, ordinal, bereich_slug, repeats, record): every record of every part with
    its place; repeats is true in year blocks, which stand in several parts by design."""
    at = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in p])
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, path: Column, slug: Column, repeats: Column) -> DataFrame:
        r = F.col("r")
        return df.select("shard", "datei", F.lit(kind).alias("kind"), path.alias("path"), r["id"].alias("id"), r["stufe"].alias("stufe"), r["text"].alias("text"), r["ordinal"].alias("ordinal"), slug.alias("bereich_slug"), repeats.alias("repeats"), F.to_json("r").alias("record"))

    areas = parts.select("shard", "datei", F.posexplode("kompetenzbereiche").alias("a", "b"))
    inside = areas.select("shard", "datei", "a", F.col("b.slug").alias("slug"), F.posexplode("b.kompetenzen").alias("i", "r"))
    nested = inside.select("shard", "datei", "a", "slug", F.col("i").alias("j"), F.posexplode("r.anwendungsbereiche").alias("i", "r"))
    extra = parts.select("shard", "datei", F.posexplode("zusatzkompetenzen").alias("i", "r"))
    digital = parts.select("shard", "datei", F.posexplode("digitale_technologien_vorschlaege").alias("i", "r"))
    blocks = parts.select("shard", "datei", F.explode("meta.anwendungsbereiche_bloecke").alias("key", "b")).select("shard", "datei", "key", F.col("b.bereich_slug").alias("slug"), (F.col("b.bindung") == "stufe").alias("year"), F.posexplode("b.items").alias("i", "r"))
    no = F.lit(False)
    return q.together(
        rows(inside, "kompetenz", at("kompetenzbereiche[", F.col("a"), "].kompetenzen[", F.col("i"), "]"), F.col("slug"), no),
        rows(nested, "item", at("kompetenzbereiche[", F.col("a"), "].kompetenzen[", F.col("j"), "].anwendungsbereiche[", F.col("i"), "]"), F.col("slug"), no),
        rows(extra, "kompetenz", at("zusatzkompetenzen[", F.col("i"), "]"), none, no),
        rows(digital, "item", at("digitale_technologien_vorschlaege[", F.col("i"), "]"), none, no),
        rows(blocks, "item", at("meta.anwendungsbereiche_bloecke[", F.col("key"), "].items[", F.col("i"), "]"), F.col("slug"), F.coalesce("year", no)),
    )


def record_rules(parts: DataFrame) -> DataFrame:
    """Findings on records.  The walk over all documents is made once, for all rules."""
    return record_findings(staged(record_walk(parts), "walk"), nested_json.shard_meta(parts).select("shard", "bindung", "band", "fach_code"))


def record_findings(walk: DataFrame, meta: DataFrame) -> DataFrame:
    """Findings on a walk's records, with each shard's (bindung, band, fach_code).  What a record shows by itself is one array of findings,
    made in one pass; what takes several records is an aggregate and a join by id."""
    wellformed = F.coalesce(_wellformed(), F.lit(False))
    twice = q.repeat_aware_collisions(walk.where(wellformed), "id", F.col("repeats"), "record")
    known = walk.where("kind = 'kompetenz'").select("shard", F.col("id").alias("ref"))
    refs = F.array_union(*[F.coalesce(F.from_json(F.get_json_object("record", f"$.{f}"), "array<string>"), F.array().cast("array<string>")) for f in ("vorlaeufer", "folge")])
    links = walk.where("kind = 'kompetenz'").select("shard", "id", F.explode(refs).alias("ref"))
    return q.together(
        own_findings(walk, meta),
        q.finding(twice, q.HARD, "id-collision", F.col("id"), F.col("n").cast("string")),
        q.finding(links.join(known, ["shard", "ref"], "left_anti"), q.SOFT, "dangling-reference", F.col("id"), F.col("ref")),
    )


def _wellformed() -> Column:
    return F.when(F.col("kind") == "kompetenz", F.col("id").rlike(ids.COMPETENCE.pattern)).otherwise(F.col("id").rlike(ids.ITEM.pattern) | F.col("id").rlike(ids.AREA_FREE_ITEM.pattern))


def own_findings(walk: DataFrame, meta: DataFrame) -> DataFrame:
    """Findings that one record shows, as a row each; the records are read once."""
    where, item = F.concat_ws("/", "shard", "datei", "path"), F.col("kind") == "item"
    stated = lambda f: F.get_json_object("record", f"$.{f}")
    blank = lambda c: c.isNull() | (F.trim(c.cast("string")) == "")
    tokens = F.array_distinct(F.regexp_extract_all("text", F.lit(IMAGE), F.lit(1)))
    entries = F.array_distinct(F.coalesce(F.from_json(stated("abbildungen"), "array<struct<token:string,datei:string>>")["datei"], F.array().cast("array<string>")))
    free, steps = F.col("id").rlike(ids.AREA_FREE_ITEM.pattern), F.split("id", "[.]")
    area = F.get(steps, F.when(F.col("kind") == "kompetenz", 4).otherwise(5))
    own, art = stated("kompetenz_id"), stated("art")
    text = lambda c: F.array_join(c, ",")
    missing = [(q.HARD, "missing-required-field", hit, F.lit(f)) for f, hit in (("id", blank(F.col("id"))), ("stufe", blank(F.col("stufe"))), ("text", blank(F.col("text"))), ("art", item & blank(art)), ("verbindlich", item & blank(stated("verbindlich"))))]
    rules = [
        *missing,
        (q.SOFT, "malformed-id", F.col("id").isNotNull() & ~F.coalesce(_wellformed(), F.lit(False)), F.col("id")),
        (q.SOFT, "schema-violation", F.col("ordinal").isNull() | (F.col("ordinal") < 1), F.lit("ordinal must be a positive number")),
        (q.SOFT, "schema-violation", ~F.col("stufe").rlike("^(?:SCH|K)[1-4]$"), F.concat(F.lit("stufe="), "stufe")),
        (q.SOFT, "orphan-token-no-abbildung-entry", F.size(F.array_except(tokens, entries)) > 0, text(F.array_except(tokens, entries))),
        (q.SOFT, "orphan-abbildung-entry-no-token", F.size(F.array_except(entries, tokens)) > 0, text(F.array_except(entries, tokens))),
        (q.SOFT, "unknown-area-code", F.col("bereich_slug").isNotNull() & ~free & (area != F.col("bereich_slug")), F.col("id")),
        (q.SOFT, "kompetenz-id-not-allowed-for-binding", item & own.isNotNull() & (F.col("bindung") != "kompetenz"), own),
        (q.SOFT, "area-free-id-outside-stufe-binding", item & free & (F.get(steps, F.lit(4)) == "AB") & (F.col("bindung") != "stufe"), F.col("id")),
        (q.SOFT, "verbindlich-false-outside-sek1-m", item & (stated("verbindlich") == "false") & ((F.col("band") != "SEK1") | (F.col("fach_code") != "M")), F.col("id")),
        (q.INFO, "unknown-enum-value", item & art.isNotNull() & ~art.isin(*ARTS), art),
    ]
    one = lambda severity, rule, hit, message: F.when(F.coalesce(hit, F.lit(False)), F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), where.alias("record"), message.alias("message")))
    found = F.filter(F.array(*[one(*r) for r in rules]), lambda f: f.isNotNull())
    return walk.join(small(meta), "shard", "left").select(F.inline(found))


def meta_rules(parts: DataFrame) -> DataFrame:
    meta = nested_json.shard_meta(parts)
    shard = F.col("shard")
    wrong = lambda c, legal: q.finding(meta.where(~F.coalesce(F.col(c).isin(*legal), F.lit(False))), q.SOFT, "schema-violation", shard, F.concat(F.lit(c + "="), F.coalesce(F.col(c), F.lit("null"))))
    return q.together(wrong("bindung", BINDINGS), wrong("lehrstoff_quelle", SOURCES), wrong("bildungsstandard_bezug", RELATIONS), wrong("band", BANDS))


# fixed values: the fields that a part may have
PART_FIELDS = ("meta", "kompetenzbereiche", "zusatzkompetenzen", "digitale_technologien_vorschlaege")


def shape_rules(texts: DataFrame) -> DataFrame:
    """Documents (datei, value) against the shape of a part: fields that it lacks, and fields that it must not have."""
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    whole = texts.where(F.ltrim("value").startswith("{"))
    extra = F.array_except(keys, F.array(*map(F.lit, PART_FIELDS)))
    lost = F.array_except(F.array(F.lit("meta"), F.lit("kompetenzbereiche")), keys)
    say = lambda what, c: F.concat(F.lit(what + " "), F.array_join(F.array_sort(c), ","))
    return q.together(
        q.finding(whole.where(F.size(extra) > 0), q.SOFT, "schema-violation", F.col("datei"), say("unknown", extra)),
        q.finding(whole.where(F.size(lost) > 0), q.SOFT, "schema-violation", F.col("datei"), say("missing", lost)),
    )


def schema_rules(texts: DataFrame, schema: dict) -> DataFrame:
    """Documents (datei, value) against a JSON Schema, a finding for each violation at its place."""
    found = schema_check.violations(texts, "datei", "value", schema)
    return q.finding(found.where("keyword <> 'json'"), q.SOFT, "schema-violation", F.col("datei"), F.concat_ws(": ", F.when(F.col("path") == "", "<root>").otherwise(F.col("path")), "keyword"))


def unreadable_registry(texts: DataFrame) -> DataFrame:
    """Registries (datei, value) that are no JSON object."""
    sound = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    return q.finding(texts.where(~sound), q.HARD, "registry-unreadable", F.col("datei"), "not a JSON object")


def part_texts(spark: SparkSession, root: str) -> DataFrame:
    """(value, datei) of all parts, as they stand."""
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("datei")).where("datei <> 'index.json'")


def file_rules(spark: SparkSession, root: str) -> DataFrame:
    """Unreadable parts, oversize parts, and stored indexes against what the parts hold."""
    rows = nested_json.parts(spark, root)
    name = F.concat_ws("/", "shard", "datei")
    texts = part_texts(spark, root)
    broken = ~F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    index = nested_json.stored_index(spark, root).select("shard", F.explode_outer("teile").alias("t"), (F.size("teile") >= 0).alias("sound"))
    have = rows.select("shard", "datei", F.coalesce(F.aggregate("kompetenzbereiche", F.lit(0), lambda s, b: s + F.greatest(F.size(b["kompetenzen"]), F.lit(0))), F.lit(0)).alias("kompetenzen"))
    listed = index.where("t is not null").select("shard", "t.datei", F.coalesce("t.kompetenzen", F.lit(0)).alias("kompetenzen"))
    indexed = index.select("shard").distinct()
    differ = q.reconcile(listed, have.join(indexed, "shard", "left_semi"), ["shard", "datei"], "kompetenzen")
    empty = rows.agg(F.count("*").alias("n")).where("n = 0")
    return q.together(
        q.finding(texts.where(broken), q.HARD, "part-unreadable", F.col("datei"), "not a JSON object of the expected shape"),
        q.oversize(texts, F.col("datei"), F.col("value")),
        shape_rules(texts),
        q.finding(rows.select("shard").distinct().join(indexed, "shard", "left_anti"), q.SOFT, "index-missing", F.col("shard"), "no index.json"),
        q.finding(index.where("not coalesce(sound, false)"), q.SOFT, "index-unreadable", F.col("shard"), "no list of parts"),
        q.finding(differ, q.SOFT, "index-mismatch", name, F.concat_ws(" ", "field", F.coalesce("stored", F.lit("-")), F.coalesce("found", F.lit("-")))),
        q.finding(empty, q.SOFT, "no-shards-found", F.lit(root), "no part documents"),
    )


def registry_rules(parts: DataFrame, registry: DataFrame | None, files: DataFrame | None = None) -> DataFrame:
    """Images that records use against the registry (datei and its fields) and the files there are."""
    used = record_walk(parts).select("shard", F.explode(F.from_json(F.get_json_object("record", "$.abbildungen"), "array<struct<token:string,datei:string>>")["datei"]).alias("datei")).distinct()
    if registry is None:
        return q.finding(used.limit(1), q.SOFT, "registry-missing", F.lit("registry"), "images are used but there is no registry")
    gaps = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REGISTRY if c in registry.columns]), lambda c: c.isNotNull())
    out = q.together(
        q.finding(used.join(registry, "datei", "left_anti"), q.SOFT, "abbildung-not-in-registry", F.col("datei"), F.col("shard")),
        q.finding(registry.where(F.size(gaps) > 0), q.SOFT, "registry-entry-incomplete", F.col("datei"), F.array_join(gaps, ",")),
    )
    return out if files is None else out.unionByName(q.finding(used.join(files, "datei", "left_anti"), q.SOFT, "abbildung-file-missing", F.col("datei"), F.col("shard")))


def count_rules(parts: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct records of each shard against frozen counts: rows (shard, kind, expected)."""
    found = record_walk(parts).groupBy("shard", "kind").agg(F.count_distinct("id").alias("measured"))
    both = expected.join(found, ["shard", "kind"], "left").withColumn("measured", F.coalesce("measured", F.lit(0)))
    return q.finding(both.where("expected <> measured"), q.SOFT, "count-mismatch-vs-frozen-expected", F.concat_ws("/", "shard", "kind"), F.concat_ws(" ", F.col("expected").cast("string"), F.col("measured").cast("string")))


def validate(spark: SparkSession, root: str, registry: DataFrame | None = None, files: DataFrame | None = None, expected: DataFrame | None = None, frozen_areas: bool = False, schema: dict | None = None, registry_texts: DataFrame | None = None) -> DataFrame:
    """All findings of a data root; with frozen_areas, areas must be of the frozen table; with a schema, parts are held against it; with
    registry_texts (datei, value), registries must be readable."""
    parts = nested_json.parts(spark, root).where("_corrupt_record is null")
    out = q.together(file_rules(spark, root), meta_rules(parts), record_rules(parts), registry_rules(parts, registry, files))
    if schema is not None:
        out = out.unionByName(schema_rules(part_texts(spark, root), schema))
    if registry_texts is not None:
        out = out.unionByName(unreadable_registry(registry_texts))
    if frozen_areas:
        areas = nested_json.areas(parts)
        out = out.unionByName(q.finding(areas.where(~ids.known_area(F.col("shard"), F.col("slug"))), q.SOFT, "unknown-area-code", F.concat_ws("/", "shard", "datei"), F.col("slug")))
    return out if expected is None else out.unionByName(count_rules(parts, expected))


def build_report(parts: DataFrame) -> DataFrame:
    """Records, bytes and estimated tokens of each part's texts."""
    return part_catalog(record_walk(parts), F.col("record"), "shard", "datei")
