import copy
import json

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import anchor, quality
from lexigraph.plans import standards, validate
from lexigraph.sources import http, tree_xml

from . import fixtures

BASE = {"meta": fixtures.meta("SEK1", "M", "Mathematik", "kompetenz"), "kompetenzbereiche": [fixtures.area("ALPHA", "Zahlen", fixtures.record("AT.LP23.SEK1.M.ALPHA.K1.01", "eins", "K1", 1, anwendungsbereiche=[fixtures.item("AT.LP23.SEK1.M.AB.ALPHA.K1.01", "item", owner="AT.LP23.SEK1.M.ALPHA.K1.01")]), fixtures.record("AT.LP23.SEK1.M.ALPHA.K1.02", "zwei", "K1", 2))]}


def rules_of(spark, root, doc, **more):
    (root / "sek1" / "m").mkdir(parents=True)
    (root / "sek1" / "m" / "alpha.json").write_text(doc if isinstance(doc, str) else json.dumps(doc), encoding="utf-8")
    (root / "sek1" / "m" / "index.json").write_text(json.dumps({"meta": BASE["meta"], "teile": [{"datei": "alpha.json", "kompetenzen": 2}]}))
    return {r.rule for r in validate.validate(spark, f"file://{root}", **more).collect()}


def k(doc, i=0):
    return doc["kompetenzbereiche"][0]["kompetenzen"][i]


MUTATIONS = {
    "missing-required-field": lambda d: k(d).update(text=" "),
    "id-collision": lambda d: k(d, 1).update(id=k(d)["id"]),
    "malformed-id": lambda d: k(d).update(id="AT.LP23.SEK1.M.ALPHA.K1.1"),
    "schema-violation": lambda d: d["meta"].update(lehrstoff_quelle="erfunden"),
    "dangling-reference": lambda d: k(d).update(folge=["AT.LP23.SEK1.M.ALPHA.K2.09"]),
    "orphan-token-no-abbildung-entry": lambda d: k(d).update(text="x ⟦ABB:a.png⟧"),
    "orphan-abbildung-entry-no-token": lambda d: k(d).update(abbildungen=[{"token": "t", "datei": "a.png"}]),
    "unknown-area-code": lambda d: d["kompetenzbereiche"][0].update(slug="BETA"),
    "kompetenz-id-not-allowed-for-binding": lambda d: d["meta"].update(anwendungsbereiche_bindung="bereich"),
    "area-free-id-outside-stufe-binding": lambda d: k(d)["anwendungsbereiche"][0].update(id="AT.LP23.SEK1.M.AB.K1.01"),
    "verbindlich-false-outside-sek1-m": lambda d: (d["meta"]["fach"].update(code="D"), k(d)["anwendungsbereiche"][0].update(verbindlich=False)),
    "unknown-enum-value": lambda d: k(d)["anwendungsbereiche"][0].update(art="neu"),
    "size-target-exceeded": lambda d: k(d).update(text="x" * 60_000),
    "index-mismatch": lambda d: d["kompetenzbereiche"][0]["kompetenzen"].pop(),
}


@pytest.mark.parametrize("rule", MUTATIONS)
def test_one_fault_one_rule(spark, tmp_path, rule):
    doc = copy.deepcopy(BASE)
    MUTATIONS[rule](doc)
    found = rules_of(spark, tmp_path, doc)
    assert rule in found and found <= {rule, "registry-missing"}


def test_sound_data_has_no_findings(spark, tmp_path):
    expected = spark.createDataFrame([("SEK1.M", "kompetenz", 2), ("SEK1.M", "item", 1)], "shard string, kind string, expected int")
    assert rules_of(spark, tmp_path, BASE, expected=expected) == set()


def test_unreadable_part_is_hard(spark, tmp_path):
    assert "part-unreadable" in rules_of(spark, tmp_path, '{"meta": ')


def test_registry_and_counts(spark, tmp_path):
    doc = copy.deepcopy(BASE)
    k(doc).update(text="x ⟦ABB:a.png⟧ ⟦ABB:b.png⟧", abbildungen=[{"token": "t", "datei": "a.png"}, {"token": "t", "datei": "b.png"}])
    registry = spark.createDataFrame([("a.png", "n", None)], "datei string, nor string, sha256 string")
    files = spark.createDataFrame([("a.png",)], "datei string")
    expected = spark.createDataFrame([("SEK1.M", "kompetenz", 3)], "shard string, kind string, expected int")
    assert rules_of(spark, tmp_path, doc, registry=registry, files=files, expected=expected) == {"abbildung-not-in-registry", "registry-entry-incomplete", "abbildung-file-missing", "count-mismatch-vs-frozen-expected"}


def test_year_blocks_may_repeat_if_equal(spark, tmp_path_factory):
    root = fixtures.write(tmp_path_factory.mktemp("v"))
    found = validate.validate(spark, f"{root}/daten")
    assert quality.exit_code(found) == 0
    assert {r.rule for r in found.collect()} == {"index-missing", "index-mismatch", "dangling-reference"}


def test_early_claims_meet_all_anchors(spark):
    claimed = spark.createDataFrame([("d", None, "gut", True), ("d", None, "falsch", True), ("d", None, "neu", True), ("d", "A", "gut", True), ("e", None, "gut", True)], "doc string, anchor string, item string, claims_binding boolean")
    truth = spark.createDataFrame([("A", "gut", True), ("B", "falsch", False)], "anchor string, item string, b boolean")
    anchors = spark.createDataFrame([("d", "A"), ("d", "B")], "doc string, anchor string")
    got = anchor.classify_claims(claimed, truth, "anchor", "item", "b", "doc", anchors)
    assert sorted((r.doc, r.anchor or "", r.item, r.rule) for r in got.collect()) == [("d", "", "falsch", "swapped"), ("d", "", "gut", "ok"), ("d", "", "neu", "fabricated"), ("d", "A", "gut", "ok"), ("e", "", "gut", "no-anchor")]


def test_lesson_violations(spark):
    claim = lambda label, *items: {"label": label, "items": list(items)}
    block = {"type": "kompetenzbezug", "kompetenz_id": "A", "text": "Wortlaut", "quelle": {"nor": "1"}}
    tree = lambda *b: json.dumps({"documents": [{"sections": [{"blocks": list(b)}]}]})
    lessons = {"gut": tree(block, claim("Verbindlich", "m"), claim("optional", "o")), "ohne": tree({"type": "paragraph"}), "id": tree(block | {"kompetenz_id": "Z"}), "zitat": tree(block | {"text": "anders"}), "quelle": tree(block | {"quelle": {"nor": "2"}}), "mix": tree(block, claim("verbindlich oder optional", "m")), "falsch": tree(block, claim("verbindlich", "o", "x"), claim("allenfalls", "m", "y"))}
    rows = spark.createDataFrame(list(lessons.items()), "k string, tree string")
    records = spark.createDataFrame([("A", "Wortlaut", '{"nor": "1"}')], "id string, volltext string, provenienz string")
    items = spark.createDataFrame([("A", "m", True), ("A", "o", False)], "kompetenz_id string, text string, verbindlich boolean")
    got = sorted((r.k, r.rule) for r in anchor.violations(rows, "k", "tree", records, items).collect())
    assert got == sorted([("ohne", "kein-kompetenzbezug"), ("id", "id-unaufloesbar"), ("zitat", "zitat-nicht-wortgetreu"), ("quelle", "provenienz-veraendert"), ("mix", "verbindlich-optional-vermischt"), ("falsch", "optionales-item-als-verbindlich-ausgegeben"), ("falsch", "erfundenes-verbindliches-item"), ("falsch", "verbindliches-item-als-optional-ausgegeben"), ("falsch", "erfundenes-optionales-item")])


def test_standards(spark):
    rows = [("x", 0, 0, "ueberschrift", "Handlungsbereich „Modellieren“, Inhaltsbereich „Zahlen“"), ("x", 1, 0, "absatz", "Schülerinnen können:"), ("x", 2, 0, "listelem", "rechnen"), ("x", 2, 1, "listelem", "Alle Kinder können: schätzen"), ("x", 3, 0, "ueberschrift", "2. Lesen"), ("x", 4, 0, "listelem", "lesen")]
    events = spark.createDataFrame(rows, "doc string, idx int, pos int, element string, text string")
    got = {r.id: (r.stammsatz, r.text) for r in standards.descriptors(events, "M", "SCH8", {"Modellieren": "H1"}, {"Zahlen": "I1"}).collect()}
    assert got == {"AT.BIST.M.SCH8.H1I1.01": ("Schülerinnen können", "rechnen"), "AT.BIST.M.SCH8.H1I1.02": ("Alle Kinder können", "schätzen"), "AT.BIST.M.SCH8.LESEN.01": ("", "lesen")}


def test_image_references(spark):
    events = spark.createDataFrame([("d", 2, 0, ["b", "a"]), ("d", 1, 0, ["a"]), ("d", 3, 0, [])], "doc string, idx int, pos int, images array<string>")
    assert [(r.datei, r.pos) for r in tree_xml.image_references(events).orderBy("pos").collect()] == [("a", 1), ("b", 2)]


def test_polite_client():
    now, waits, answers = [0.0], [], iter([(503, b""), (429, b""), (200, b"ok"), (404, b"")])

    def sleep(s):
        waits.append(s)
        now[0] += s

    c = http.PoliteClient(lambda url: next(answers), sleep=sleep, clock=lambda: now[0])
    assert c.get("u") == b"ok" and waits == [1.0, 2.0]
    with pytest.raises(http.FetchError):
        c.get("u")
    with pytest.raises(http.FetchError, match="no answer"):
        http.PoliteClient(lambda url: (500, b""), retries=2, sleep=sleep, clock=lambda: now[0]).get("u")
    assert F is not None
