"""The query functions over curriculum data: each returns a DataFrame; malformed arguments raise."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import STOP_WORDS, casefold, full_wording, level_at_least
from ..operators import bind, index
from ..operators.dictionary import Dictionary
from ..sources import docs as docs_source
from ..sources import nested_json
from ..session import small


class CurriculumError(ValueError):
    """A malformed argument, or data that no function is defined for."""


class NotFound(CurriculumError):
    """A well-formed identifier that no record has."""


BIST = "meta STRUCT<shard: STRING, programmstufe: STRING, provenienz: MAP<STRING, STRING>>, kompetenzbereiche ARRAY<STRUCT<code: STRING, name: STRING>>, deskriptoren ARRAY<STRUCT<id: STRING, fach: STRING, programmstufe: STRING, bereich_code: STRING, stammsatz: STRING, text: STRING, ordinal: INT, titel: STRING>>"
CROSSWALK = "zuordnungen ARRAY<STRUCT<lehrplan_fach: STRING, lehrplan_bereich: STRING, bildungsstandard_shard: STRING, bildungsstandard_bereich: STRING, beziehung: STRING, amtlich: BOOLEAN, rationale: STRING>>"


class Curriculum:
    """Tables of a data root, and optionally of a standards root and a folder of teachers' files.

    Filters on shard and area reach the scan when the tables are stored by band and subject; the
    metadata of a shard is one row and is joined as such."""

    def __init__(self, spark: SparkSession, root: str, standards: str | None = None, material: str | None = None, stored: str | None = None, dictionary: str | None = None):
        """stored names a folder that nested_json.store filled, whose tables are then read instead of the documents; dictionary
        one that operators.dictionary.store filled with the keyword index by shard."""
        self.spark, self.standards, self.material = spark, standards, material
        self.tables = nested_json.stored(spark, stored) if stored else nested_json.tables(spark, root)
        self.dictionary = Dictionary(spark, dictionary, "shard") if dictionary else None
        self.shards = [r.shard for r in self.tables.meta.select("shard").orderBy("shard").collect()]

    # -- guards

    def _shard(self, name: str) -> str:
        key = name.strip().upper()
        if key not in self.shards:
            raise CurriculumError(f"unknown subject {name!r}; known: {', '.join(self.shards)}")
        return key

    @staticmethod
    def _one(**given) -> str:
        named = [k for k, v in given.items() if v is not None]
        if len(named) != 1:
            raise CurriculumError(f"exactly one of {', '.join(given)} is needed")
        return named[0]

    def _meta(self, shard: str):
        return self.tables.meta.where(F.col("shard") == shard).first()

    # -- 1, 2: records and search

    def kompetenz_nach_id(self, kompetenz_id: str) -> DataFrame:
        """The record of an identifier, looked for in the part of its area, the extra part and then the rest."""
        parts = kompetenz_id.strip().split(".")
        if not re.match(ids.COMPETENCE.pattern, kompetenz_id.strip()):
            kind = "an item" if len(parts) > 5 and parts[4:5] and parts[4] in ("AB", "DT") else "malformed"
            raise CurriculumError(f"{kompetenz_id!r} is {kind}, not a competence identifier")
        shard = self._shard(".".join(parts[2:4]))
        found = self.tables.competences.where((F.col("shard") == shard) & (F.col("id") == kompetenz_id.strip()))
        if found.limit(1).count() == 0:
            raise NotFound(kompetenz_id)
        return found.limit(1)

    def keyword_index(self, shard: str | None = None, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
        """Terms with at most two parts, of one shard or all."""
        words = nested_json.words(self.tables.parts.where("_corrupt_record is null"))
        if shard:
            words = words.where(F.col("shard") == shard)
        return index.inverted_index(words, F.col("text"), "datei", ["shard"], stop=stop)

    def _route(self, shard: str, terms: list[str]) -> DataFrame:
        """(datei, exact) of the parts that the keyword index leads to: the stored one, or one made here."""
        found = self.dictionary.route(shard, terms) if self.dictionary else index.route(self.keyword_index(shard), terms)
        return found.withColumnRenamed("part", "datei")

    def finde_kompetenz(self, fach: str, stufe: str | None = None, kompetenzbereich: str | None = None, code: str | None = None, stichworte: list[str] | None = None) -> DataFrame:
        """Records of a subject by level, area (slug or name, folded) and keywords (any), all of which must hold.  A code
        takes the keywords' place: its record by level and area, or nothing if no record or another subject has it.  Keywords are
        looked for in the records' own texts: the index leaves out what many parts have, stop words, phrases and raw texts."""
        shard = self._shard(fach)
        rows = self.tables.competences.where(F.col("shard") == shard)
        if code is not None:
            try:
                rows = self.kompetenz_nach_id(code).where(F.col("shard") == shard)
            except NotFound:
                return self.tables.competences.limit(0)
        if stufe is not None:
            rows = rows.where(F.col("stufe") == stufe.strip().upper())
        if kompetenzbereich is not None:
            wanted = casefold(F.trim(F.lit(kompetenzbereich)))
            rows = rows.where((casefold(F.col("bereich_slug")) == wanted) | (casefold(F.col("bereich_name")) == wanted))
        terms = [t for t in stichworte or [] if t and t.strip()]
        if terms and code is None:
            hay = F.concat_ws(" ", "stammsatz", "text", "text_roh")
            rows = rows.where(index.has_term(hay, terms))
        return rows.orderBy(F.coalesce("stufe", F.lit("")), F.coalesce("bereich_slug", F.lit("")), F.coalesce("ordinal", F.lit(0)))

    def stichwort_abdeckung(self, fach: str, begriff: str) -> DataFrame:
        """One row: suchstatus, exakt, kompetenz_ids, lehrstoff_ids of the parts that the index leads to."""
        shard = self._shard(fach)
        parts = self._route(shard, [begriff])
        hay = F.concat_ws(" ", "stammsatz", "text", "text_roh")
        k = self.tables.competences.where((F.col("shard") == shard) & index.has_term(hay, [begriff])).join(parts, "datei", "left_semi")
        i = self.tables.items.where((F.col("shard") == shard) & (F.col("art") == "praezisierung") & index.has_term(F.concat_ws(" ", "text", "text_roh"), [begriff])).join(parts, "datei", "left_semi")
        one = parts.agg(F.count("*").alias("n"), F.coalesce(F.max("exact"), F.lit(False)).alias("exakt"))
        one = one.crossJoin(k.agg(F.array_sort(F.collect_set("id")).alias("kompetenz_ids"))).crossJoin(i.agg(F.array_sort(F.collect_set("id")).alias("lehrstoff_ids")))
        status = F.when(F.col("n") == 0, "keine_indexkandidaten").when(F.size("kompetenz_ids") > 0, "kompetenztreffer").when(F.size("lehrstoff_ids") > 0, "nur_lehrstofftreffer").otherwise("kandidaten_ohne_texttreffer")
        return one.select(status.alias("suchstatus"), "exakt", "kompetenz_ids", "lehrstoff_ids")

    # -- 3: progression

    def finde_progression(self, kompetenz_id: str, richtung: str) -> DataFrame:
        """Records before ('zurueck') or after ('vor'), in stored order; unknown ones and ones of another area drop out."""
        if richtung not in ("zurueck", "vor"):
            raise CurriculumError(f"richtung must be 'zurueck' or 'vor', not {richtung!r}")
        own = self.kompetenz_nach_id(kompetenz_id)
        listed = own.select(F.col("bereich_slug").alias("own_slug"), F.posexplode("vorlaeufer" if richtung == "zurueck" else "folge").alias("pos", "id"))
        found = self.tables.competences.join(small(listed), "id").where(F.col("bereich_slug").eqNullSafe(F.col("own_slug")))
        return found.drop("own_slug").orderBy("pos").drop("pos")

    # -- 4, 5: application items and teaching matter

    def _coordinates(self, kompetenz_id, fach, stufe, bereich) -> None:
        if (kompetenz_id is None) == (fach is None):
            raise CurriculumError("give either kompetenz_id or coordinates")
        if kompetenz_id is not None and (stufe or bereich):
            raise CurriculumError("kompetenz_id takes no coordinates")

    def finde_anwendungsbereiche(self, kompetenz_id: str | None = None, nur_verbindlich: bool | None = None, *, fach: str | None = None, stufe: str | None = None, bereich: str | None = None) -> DataFrame:
        """Precisions attached to a record by its shard's binding, or those at coordinates.  A record without a block
        has none; coordinates without a block raise."""
        self._coordinates(kompetenz_id, fach, stufe, bereich)
        rows = self.tables.items
        if kompetenz_id is not None:
            meta = self.tables.meta.select("shard", "bindung")
            own = self.kompetenz_nach_id(kompetenz_id).join(meta, "shard").select("shard", bind.attach_key(F.col("bindung"), F.col("id"), F.col("bereich_slug"), F.col("stufe")).alias("attach_key"))
            rows = rows.join(small(own), ["shard", "attach_key"], "left_semi")
        else:
            shard = self._shard(fach)
            binding = self._meta(shard).bindung
            if binding not in ("bereich", "stufe"):
                raise CurriculumError(f"binding {binding!r} needs a kompetenz_id")
            if not stufe or (binding == "bereich") != bool(bereich):
                raise CurriculumError(f"binding {binding!r} needs stufe" + " and bereich" * (binding == "bereich"))
            key = f"{bereich.strip().upper()}.{stufe.strip().upper()}" if bereich else stufe.strip().upper()
            rows = bind.at_coordinates(rows, (F.col("shard") == shard) & (F.col("attach_key") == key))
        rows = rows.where("art = 'praezisierung'")
        if nur_verbindlich is not None:
            rows = rows.where(F.col("verbindlich") == nur_verbindlich)
        return rows.orderBy("pos", "id")

    def finde_lehrstoff(self, kompetenz_id: str | None = None, *, fach: str | None = None, stufe: str | None = None, bereich: str | None = None) -> DataFrame:
        """(quelle, pos, text): texts of the items, or the record's own wording where the shard states its own."""
        self._coordinates(kompetenz_id, fach, stufe, bereich)
        shard = self._shard(fach) if fach is not None else self.kompetenz_nach_id(kompetenz_id).first().shard
        source = self._meta(shard).lehrstoff_quelle
        if source == "eigen_ausgewiesen":
            if kompetenz_id is None:
                raise CurriculumError("this subject's matter needs a kompetenz_id")
            return self.kompetenz_nach_id(kompetenz_id).select(F.lit(source).alias("quelle"), F.lit(0).alias("pos"), F.col("volltext").alias("text"))
        if source != "aus_anwendungsbereichen":
            raise CurriculumError(f"unknown source {source!r}")
        return self.finde_anwendungsbereiche(kompetenz_id, fach=fach, stufe=stufe, bereich=bereich).select(F.lit(source).alias("quelle"), "pos", "text")

    # -- 6: teachers' material

    def finde_lernaufgaben(self, fach: str | None = None, stufe: str | None = None, kompetenz_id: str | None = None) -> DataFrame:
        if self.material is None:
            return self.spark.createDataFrame([], docs_source.SCHEMA)
        if kompetenz_id is not None:
            own = self.kompetenz_nach_id(kompetenz_id).first()
            fach, stufe = fach or own.shard, stufe or own.stufe
        subject = fach.strip().upper().split(".")[-1] if fach else None
        return docs_source.collect_material(docs_source.scan(self.spark, self.material), subject, stufe.strip().upper() if stufe else None, kompetenz_id)

    # -- 7: standards

    def _standards(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        read = lambda schema: self.spark.read.option("multiLine", True).schema(schema)
        rows = read(BIST).option("pathGlobFilter", "[a-z][0-9].json").json(self.standards)
        targets = rows.select(F.upper("meta.shard").alias("bildungsstandard_shard"), F.col("meta.provenienz").alias("bist_provenienz"), F.inline("deskriptoren")).withColumnRenamed("bereich_code", "bildungsstandard_bereich").withColumn("volltext", full_wording(F.coalesce("stammsatz", F.lit("")), F.coalesce("text", F.lit(""))))
        names = rows.select(F.upper("meta.shard").alias("bildungsstandard_shard"), F.inline("kompetenzbereiche")).withColumnsRenamed({"code": "bildungsstandard_bereich", "name": "bildungsstandard_bereich_name"})
        bridge = read(CROSSWALK).json(f"{self.standards}/crosswalk.json").select(F.posexplode("zuordnungen").alias("bridge_row", "z")).select("bridge_row", "z.*").withColumn("bildungsstandard_shard", F.upper("bildungsstandard_shard"))
        return targets, names, bridge

    def finde_bildungsstandard_bezug(self, kompetenz_id: str) -> DataFrame:
        """One row: abgedeckt, grund, zuordnungen (bridge rows of the record's area), deskriptoren (each once, under the
        first of them).  A subject without standards is not covered; an area without a bridge is covered and empty."""
        own = self.kompetenz_nach_id(kompetenz_id)
        shard = own.first().shard
        relation = self._meta(shard).bildungsstandard_bezug
        if relation == "keine_verordnung":
            return self.spark.range(1).select(F.lit(False).alias("abgedeckt"), F.lit("keine BiSt verordnet").alias("grund"))
        if relation != "verordnet":
            raise CurriculumError(f"unknown relation {relation!r}")
        targets, names, bridge = self._standards()
        area = own.select(F.col("shard").alias("lehrplan_fach"), F.col("bereich_slug").alias("lehrplan_bereich"))
        hops = bridge.join(small(area), ["lehrplan_fach", "lehrplan_bereich"], "left_semi")
        hit = hops.select("bridge_row", "bildungsstandard_shard", "bildungsstandard_bereich").join(targets, ["bildungsstandard_shard", "bildungsstandard_bereich"])
        each = hit.groupBy("id").agg(F.min(F.struct("bridge_row", "ordinal", "stammsatz", "text", "volltext")).alias("d"))
        found = each.agg(F.array_sort(F.collect_list(F.struct("d.bridge_row", "id", "d.ordinal", "d.stammsatz", "d.text", "d.volltext"))).alias("deskriptoren"))
        lines = hops.join(names, ["bildungsstandard_shard", "bildungsstandard_bereich"], "left")
        rows = lines.agg(F.array_sort(F.collect_list(F.struct("bridge_row", "bildungsstandard_shard", "bildungsstandard_bereich", "bildungsstandard_bereich_name", "beziehung", "amtlich", "rationale"))).alias("zuordnungen"))
        return rows.crossJoin(found).select(F.lit(True).alias("abgedeckt"), F.lit(None).cast("string").alias("grund"), "zuordnungen", "deskriptoren")

    # -- 8: themes

    def finde_uebergreifende_themen(self, fach: str | None = None, kompetenz_id: str | None = None, thema: str | None = None) -> DataFrame:
        mode = self._one(fach=fach, kompetenz_id=kompetenz_id, thema=thema)
        if mode == "kompetenz_id":
            return self.kompetenz_nach_id(kompetenz_id).select(F.explode("uebergreifende_themen").alias("thema"))
        if mode == "fach":
            return self.tables.meta.where(F.col("shard") == self._shard(fach)).select(F.explode("themen_fach").alias("thema"))
        found = bind.theme_catalog(self.tables.meta, "shard", "themen_fach", F.trim(F.lit(thema)))
        return self.tables.meta.join(found, "shard", "left_semi").select("shard", "band", F.col("fach_name").alias("name")).orderBy("shard")

    # -- 9, 10: differentiation, misconceptions

    def finde_differenzierung(self, kompetenz_id: str) -> dict[str, DataFrame]:
        """achse (one row with the labels in force and the target-level sentence), enrichment, vorklasse and material."""
        own = self.kompetenz_nach_id(kompetenz_id)
        rows = own.select("shard", "stufe").join(self.tables.meta.select("shard", "achse"), "shard")
        boundary = F.col("achse.gilt_ab_stufe")
        labels = F.when(boundary.isNull() | level_at_least(F.upper("stufe"), F.upper(boundary)), F.col("achse.niveaus")).otherwise(F.array().cast("array<string>"))
        target = F.when(F.col("achse.gers.je_stufe_ausgewiesen"), F.try_element_at("achse.gers.je_stufe", F.col("stufe")))
        axis = rows.select("achse", labels.alias("niveaus"), target.alias("gers_stufe"))
        extra = self.finde_anwendungsbereiche(kompetenz_id, False)
        if axis.where("achse.enrichment_quelle = 'allenfalls'").count() == 0:
            extra = extra.limit(0)
        return {"achse": axis, "enrichment": extra, "vorklasse": self.finde_progression(kompetenz_id, "zurueck"), "material": self.finde_lernaufgaben(kompetenz_id=kompetenz_id)}

    def finde_typische_fehlvorstellungen(self, kompetenz_id: str) -> DataFrame:
        """No such data exist; the result is empty by contract."""
        return self.spark.createDataFrame([], "kompetenz_id string, text string")
