import pytest

from lexigraph.operators.bind import MissingBlock
from lexigraph.plans.curriculum import Curriculum, CurriculumError, NotFound
from lexigraph.sources import nested_json

from . import fixtures

ONE, TWO = "AT.LP23.SEK1.M.ALPHA.K1.01", "AT.LP23.SEK1.M.ALPHA.K2.01"


@pytest.fixture(scope="module")
def c(spark, tmp_path_factory):
    root = fixtures.write(tmp_path_factory.mktemp("lehrplan"))
    return Curriculum(spark, f"{root}/daten", f"{root}/standards", f"{root}/docs")


def ids_of(df):
    return [r.id for r in df.collect()]


def test_flatten_counts_and_index_is_no_part(c):
    assert c.shards == ["PRIM.M", "PRIM.SU", "SEK1.D", "SEK1.E", "SEK1.M"]
    assert c.tables.competences.count() == 10 and c.tables.parts.where("datei = 'index.json'").count() == 0
    assert c.tables.areas.where("shard = 'SEK1.D'").count() == 2


def test_lookup(c):
    r = c.kompetenz_nach_id(ONE).first()
    assert (r.bereich_slug, r.volltext, r.provenienz.nor) == ("ALPHA", "Die Kinder können mit Bruchzahlen rechnen.", "NOR1")
    assert c.kompetenz_nach_id("AT.LP23.SEK1.M.EXTRA.K3.01").first().ist_zusatz
    with pytest.raises(NotFound):
        c.kompetenz_nach_id("AT.LP23.SEK1.M.ALPHA.K4.99")
    for wrong in ("x", "AT.LP23.SEK1.M.AB.ALPHA.K1.01", "AT.LP23.SEK1.SU.ALPHA.K1.01", "AT.LP23.SEK1.M.ALPHA.SCH1.01"):
        with pytest.raises(CurriculumError):
            c.kompetenz_nach_id(wrong)


def test_search(c):
    assert ids_of(c.finde_kompetenz("sek1.m")) == [ONE, TWO, "AT.LP23.SEK1.M.EXTRA.K3.01"]
    assert ids_of(c.finde_kompetenz("SEK1.M", stufe=" k2 ")) == [TWO]
    assert ids_of(c.finde_kompetenz("SEK1.M", kompetenzbereich="ZAHLEN UND MASSE")) == [ONE, TWO]
    assert ids_of(c.finde_kompetenz("SEK1.M", stichworte=["Bruch", " "])) == [ONE]
    assert ids_of(c.finde_kompetenz("SEK1.M", stichworte=["nirgends"])) == []
    assert ids_of(c.finde_kompetenz("SEK1.M", code=TWO)) == [TWO] and ids_of(c.finde_kompetenz("SEK1.D", code=TWO)) == []
    assert ids_of(c.finde_kompetenz("SEK1.M", code="AT.LP23.SEK1.M.ALPHA.K4.99")) == []
    with pytest.raises(CurriculumError):
        c.finde_kompetenz("SEK1.X")
    with pytest.raises(CurriculumError):
        c.finde_kompetenz("SEK1.M", code="kaputt")


def test_coverage_statuses(c):
    status = lambda t: c.stichwort_abdeckung("SEK1.M", t).first().suchstatus
    assert [status(t) for t in ("Bruchzahlen", "erweitern", "Software", "qqqq")] == ["kompetenztreffer", "nur_lehrstofftreffer", "kandidaten_ohne_texttreffer", "keine_indexkandidaten"]


def test_progression(c):
    assert ids_of(c.finde_progression(ONE, "vor")) == [TWO]
    assert ids_of(c.finde_progression(TWO, "zurueck")) == [ONE]  # an unknown id drops out
    assert ids_of(c.finde_progression("AT.LP23.SEK1.E.EPSILON.K1.01", "zurueck")) == []  # another area drops out
    assert ids_of(c.finde_progression("AT.LP23.SEK1.D.GAMMA.K2.01", "zurueck")) == ["AT.LP23.SEK1.D.GAMMA.K1.01", "AT.LP23.SEK1.D.GAMMA.K1.02"]
    with pytest.raises(CurriculumError):
        c.finde_progression(ONE, "seitwärts")


def test_items_by_binding(c):
    assert ids_of(c.finde_anwendungsbereiche(ONE)) == ["AT.LP23.SEK1.M.AB.ALPHA.K1.01", "AT.LP23.SEK1.M.AB.ALPHA.K1.02"]
    assert ids_of(c.finde_anwendungsbereiche(ONE, False)) == ["AT.LP23.SEK1.M.AB.ALPHA.K1.02"]
    assert ids_of(c.finde_anwendungsbereiche("AT.LP23.SEK1.D.GAMMA.K1.02")) == ["AT.LP23.SEK1.D.AB.GAMMA.K1.01"]
    assert ids_of(c.finde_anwendungsbereiche("AT.LP23.SEK1.D.GAMMA.K2.01")) == []
    assert ids_of(c.finde_anwendungsbereiche("AT.LP23.PRIM.SU.IOTA.SCH2.01")) == ["AT.LP23.PRIM.SU.AB.SCH2.01"]
    for none in ("AT.LP23.SEK1.E.EPSILON.K1.01", "AT.LP23.PRIM.M.THETA.SCH1.01", TWO):
        assert ids_of(c.finde_anwendungsbereiche(none)) == []


def test_items_by_coordinates(c):
    assert ids_of(c.finde_anwendungsbereiche(fach="SEK1.D", stufe="k1", bereich="delta")) == ["AT.LP23.SEK1.D.AB.DELTA.K1.01"]
    assert ids_of(c.finde_anwendungsbereiche(fach="PRIM.SU", stufe="SCH2")) == ["AT.LP23.PRIM.SU.AB.SCH2.01"]
    with pytest.raises(MissingBlock):
        c.finde_anwendungsbereiche(fach="SEK1.D", stufe="K4", bereich="GAMMA")
    for wrong in ({}, {"fach": "SEK1.M", "stufe": "K1"}, {"kompetenz_id": ONE, "fach": "SEK1.M"}, {"fach": "SEK1.D", "stufe": "K1"}):
        with pytest.raises(CurriculumError):
            c.finde_anwendungsbereiche(**wrong)


def test_teaching_matter(c):
    texts = lambda **k: [(r.quelle, r.text) for r in c.finde_lehrstoff(**k).collect()]
    assert texts(kompetenz_id="AT.LP23.PRIM.M.THETA.SCH1.01") == [("eigen_ausgewiesen", "Die Kinder können Längen messen.")]
    assert texts(kompetenz_id=ONE)[0] == ("aus_anwendungsbereichen", "Brüche kürzen und erweitern")
    with pytest.raises(CurriculumError):
        c.finde_lehrstoff(fach="PRIM.M", stufe="SCH1")


def test_standards(c):
    r = c.finde_bildungsstandard_bezug(ONE).first()
    assert r.abgedeckt and [z.bildungsstandard_bereich for z in r.zuordnungen] == ["H1", "H2", "H1"] and len(r.deskriptoren) == 3
    assert r.deskriptoren[0].volltext == "Lernende können Satz 1."
    assert not c.finde_bildungsstandard_bezug("AT.LP23.PRIM.SU.IOTA.SCH2.01").first().abgedeckt
    empty = c.finde_bildungsstandard_bezug("AT.LP23.SEK1.M.EXTRA.K3.01").first()
    assert empty.abgedeckt and empty.zuordnungen == [] and empty.deskriptoren == []


def test_themes(c):
    assert [r.thema for r in c.finde_uebergreifende_themen(kompetenz_id=ONE).collect()] == ["Umwelt"]
    assert [r.thema for r in c.finde_uebergreifende_themen(fach="SEK1.M").collect()] == ["Umwelt", "Sprache"]
    assert [r.shard for r in c.finde_uebergreifende_themen(thema=" UMWELT ").collect()] == ["PRIM.M", "SEK1.M"]
    with pytest.raises(CurriculumError):
        c.finde_uebergreifende_themen()


def test_differentiation(c):
    one, two = c.finde_differenzierung(ONE), c.finde_differenzierung(TWO)
    assert one["achse"].first().niveaus == [] and two["achse"].first().niveaus == ["Standard", "Standard plus"]
    assert ids_of(one["enrichment"]) == ["AT.LP23.SEK1.M.AB.ALPHA.K1.02"] and ids_of(two["vorklasse"]) == [ONE]
    english = c.finde_differenzierung("AT.LP23.SEK1.E.EPSILON.K1.01")["achse"].first()
    assert english.gers_stufe.niveau == "A1" and english.niveaus == []
    assert c.finde_differenzierung("AT.LP23.PRIM.M.THETA.SCH1.01")["achse"].first().niveaus == ["A", "B"]
    assert c.finde_typische_fehlvorstellungen(ONE).count() == 0


def test_material(c):
    rows = {r.pfad: r for r in c.finde_lernaufgaben(kompetenz_id=ONE).collect()}
    hits = [p for p, r in sorted(rows.items(), key=lambda x: x[1]["rank"] or 99) if r.status == "treffer"]
    assert hits[:2] == [f"mathematik/K2/drei__{ONE}.md", "deutsch/kopf.md"] and "mathematik/K1/blatt.md" in hits and "mathematik/K2/zwei.md" not in rows
    assert rows["mathematik/K1/blatt.md"].titel == "Übungsblatt" and "�" in rows["mathematik/K1/roh.txt"].text
    assert rows["mathematik/kaputt.pdf"].status == rows["mathematik/bild.xyz"].status == "uebersprungen"
    assert "README.md" not in rows and not any(".hidden" in p for p in rows) and "notiz.md" not in rows


def test_documents_are_parsed_once_for_their_store(spark, tmp_path, counted):
    same, seen = counted
    root = f"{fixtures.write(tmp_path)}/daten"
    direct = nested_json.tables(spark, root)
    rows = direct.parts.withColumn("datei", same("datei"))
    nested_json.store(nested_json.Tables(rows, *[f(rows.where("_corrupt_record is null")) for f in (nested_json.competences, nested_json.items, nested_json.shard_meta, nested_json.areas)]), f"{tmp_path}/stored")
    assert seen() == direct.parts.count()
    found = nested_json.stored(spark, f"{tmp_path}/stored")
    for name in ("competences", "items", "meta", "areas"):
        a, b = getattr(direct, name), getattr(found, name)
        assert a.columns == b.columns and a.count() == b.count() > 0
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
