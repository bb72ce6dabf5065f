import random

import pytest
from pyspark.sql import functions as F

from lexigraph.plans import regulation as rg
from lexigraph.plans.transducer import Machine, with_registers, with_states

EVENT = "doc string, idx int, pos int, element string, typ string, text string, roh string, supers array<string>, images array<string>"
STEM = "Die Schülerinnen und Schüler können"


@pytest.mark.parametrize("segment", [1, 7, 10_000])
def test_states_are_those_of_a_sequential_fold(spark, segment):
    rng = random.Random(segment)
    machine = rg.machine(rg.Subject("SEK1.M", "M", "ACHTER TEIL", "kompetenz"))
    names = [*machine.moves, "text", "level", "entry"]
    docs = {f"d{i}": [rng.choice(names if rng.random() < 0.5 else ["text", "right_part", "subject", "competence_section", "other_heading"]) for _ in range(rng.randrange(1, 120))] for i in range(25)}
    rows = [(d, i, p, t) for d, some in docs.items() for i, t in enumerate(some) for p in range(rng.randrange(1, 3))]
    got = {(r.doc, r.idx, r.pos): (r.before, r.after) for r in with_states(spark.createDataFrame(rows, "doc string, idx int, pos int, token string"), machine, segment).collect()}
    want = {(d, i): s for d, some in docs.items() for i, s in enumerate(machine.folded(some))}
    assert len(got) == len(rows) and all(s == want[d, i] for (d, i, _), s in got.items())
    assert {s for _, s in want.values()} == set(rg.STATES)


@pytest.mark.parametrize("segment", [3, 10_000])
def test_registers_are_those_of_a_sequential_fold(spark, segment):
    rng = random.Random(segment)
    rows = [(d, i, p, rng.choice("aab-..")) for d in "xy" for i in range(60) for p in range(rng.randrange(1, 4))]
    write = F.when(F.col("w") == "-", F.struct(F.lit(None).cast("string").alias("value"))).when(F.col("w") != ".", F.struct(F.concat("w", F.col("idx").cast("string"), F.col("pos").cast("string")).alias("value")))
    df = spark.createDataFrame(rows, "doc string, idx int, pos int, w string")
    got = {(r.doc, r.idx, r.pos): (r.now, r.earlier) for r in with_registers(df, {"now": write, "earlier": write}, segment, earlier=("earlier",)).collect()}
    for d in "xy":
        held, before, at = None, None, -1
        for _, i, p, w in [r for r in rows if r[0] == d]:
            if i != at:
                before, at = held, i
            held = None if w == "-" else held if w == "." else f"{w}{i}{p}"
            assert got[d, i, p] == (held, before)


def test_one_huge_document_is_split_over_tasks(spark):
    rows = spark.range(200_000).select(F.lit("d").alias("doc"), F.col("id").cast("int").alias("idx"), F.lit(0).alias("pos"), F.when(F.col("id") % 50_000 == 7, "go").otherwise("stay").alias("token"))
    machine = Machine(("a", "b", "c"), "a", {"go": {"a": "b", "b": "c", "c": "a"}})
    got = with_states(rows, machine, 1000)
    assert {r.after: r.n for r in got.groupBy("after").agg(F.count("*").alias("n")).collect()} == {"a": 50_007, "b": 99_993, "c": 50_000}


def parsed(spark, subject, children, segment=3):
    rows, n = [], 0
    for child in children:
        element, typ, texts = child
        for p, t in enumerate(texts if isinstance(texts, list) else [texts]):
            rows.append(("d", n, p, element, typ, t, t, [], []))
        n += 1
    return rg.build(spark.createDataFrame(rows, EVENT), subject, segment)


def head(text, typ="erll"):
    return ("ueberschrift", typ, text)


def law(binding_word=True):
    return [
        head("DEUTSCH", "g1"),
        head("NEUNTER TEIL", "g1"),
        head("DEUTSCH", "g1"),
        ("absatz", "abs", "Ein Satz."),
        head("Kompetenzbeschreibungen und Anwendungsbereiche, Lehrstoff (1. bis 4. Schulstufe):"),
        head("1. Schulstufe:"),
        ("listelem", None, ["verloren"]),
        head("Kompetenzbereich Lesen"),
        ("absatz", "abs", STEM),
        ("listelem", None, ["lesen", "Die Schüler lesen", STEM + ":", "vorlesen"]),
        ("absatz", "abs", "Anwendungsbereiche:"),
        ("listelem", None, ["Märchen", "Wiederholen und Festigen: Sagen"]),
        ("listelem", None, ["Fabeln allenfalls"]),
        head("Integrativer Kompetenzbereich Neues"),
        ("listelem", None, ["ohne Stamm"]),
        head("2. Klasse"),
        ("td", None, ["1 Umwelt", "02Sprache", "x"]),
        ("listelem", None, ["danach"]),
        head("MATHEMATIK", "g1"),
    ]


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("idx", "pos").select(*columns).collect()]


@pytest.mark.parametrize("binding", ["bereich", "stufe", "prosa"])
def test_combined_section(spark, binding):
    subject = rg.Subject("PRIM.D", "DEUTSCH", "NEUNTER TEIL", binding, form="unnumbered", competences=r"^Kompetenzbeschreibungen\b.*Lehrstoff\s*\(")
    t = parsed(spark, subject, law())
    assert rows(t["competences"], "id", "stammsatz", "text") == [("AT.LP23.PRIM.D.LESEN.SCH1.01", STEM, "lesen"), ("AT.LP23.PRIM.D.LESEN.SCH1.02", STEM, "Die Schüler lesen"), ("AT.LP23.PRIM.D.LESEN.SCH1.03", STEM + ":", "vorlesen"), ("AT.LP23.PRIM.D.NEUES.SCH1.01", "", "ohne Stamm")]
    area = {"bereich": "LESEN.", "stufe": ""}.get(binding)
    want = [] if area is None else [(f"AT.LP23.PRIM.D.AB.{area}SCH1.0{i + 1}", x, True, i == 1) for i, x in enumerate(["Märchen", "Wiederholen und Festigen: Sagen", "Fabeln allenfalls"])]
    assert rows(t["items"], "id", "text", "verbindlich", "wiederholung") == want
    found = {(r.rule, r.idx) for r in t["issues"].collect()}
    want = {("subject-in-wrong-part", 0), ("list-without-context", 6), ("competence-without-stem", 14), ("unexpected-level-unit", 15), ("unmapped-area", 13)}
    assert found == want | ({("prose-block", 10), ("list-in-prose-block", 11), ("list-in-prose-block", 12)} if binding == "prosa" else set())
    assert {(r.number, r.name) for r in t["legend"].collect()} == {("1", "Umwelt"), ("02", "Sprache")}
    assert [(r.name, r.slug, r.mapped) for r in t["areas"].orderBy("idx").collect()] == [("Lesen", "LESEN", True), ("Neues", "NEUES", False)]


def test_target_levels_stand_before_the_areas(spark):
    subject = rg.Subject("SEK1.E", "ENGLISCH", None, "prosa", form="unnumbered", target_levels=True)
    say = "In allen vier Kompetenzbereichen wird das Zielniveau A2 mit Teilen aus B1 angestrebt. Mehr."
    t = parsed(spark, subject, [head("ENGLISCH", "g1"), head("Kompetenzbereiche (1. bis 4. Klasse):"), ("absatz", "abs", say), head("1. Klasse"), ("absatz", "abs", say), ("absatz", "abs", say), head("Kompetenzbereich Hören"), ("absatz", "abs", say.replace("A2", "C1")), head("Irgendwas"), ("listelem", None, ["mehr"])])
    assert [tuple(r) for r in t["targets"].collect()] == [("d", "K1", "A2 mit Teilen aus B1", say[:-6], "Kompetenzbereiche (1. bis 4. Klasse):", 4)]
    assert rows(t["extras"], "titel", "stufe", "text") == [("Irgendwas", None, "mehr")]
    empty = rg.build(spark.createDataFrame([], EVENT), subject)
    assert all(df.count() == 0 for df in empty.values())
