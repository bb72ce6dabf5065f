import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lexigraph.functions import ids, text as tx
from lexigraph.operators import anchor, diff, graph, index, match, quality, rank
from lexigraph.plans import build
from lexigraph.sources import snapshots, tree_xml

from . import fixtures


def values(spark, column, *rows, schema="x string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def test_text_functions(spark):
    x = F.col("x")
    assert values(spark, tx.casefold(x), "MAßE", "Übung", None) == ["masse", "übung", None]
    assert values(spark, tx.match_form(x), "Die „Zahl“ –  so; ", "ABC.:") == ['die "zahl" - so', "abc"]
    assert values(spark, tx.fidelity_form(x), " a­b \n c﻿") == ["ab c"]
    assert values(spark, tx.tokens(x), "Die Brüche ⟦ABB:bild.png⟧ gemäß m² nach Übung12") == [["brüche", "gemäss", "übung"]]
    assert values(spark, tx.token_estimate(x), "", "abcdefgh", "äö") == [1, 2, 1]
    assert values(spark, tx.title(x, F.lit("f")), "a\n ## Kopf \nb", "none") == ["Kopf", "f"]
    assert values(spark, tx.front_matter(x)["a"], "---\nA: b: c\n---\nx", "no") == ["b: c", None]
    assert values(spark, tx.slug(x), "Zahlen und Maße", "AB", "Größen – Äpfel!") == ["ZAHLENUNDMAE", "ABX", "GROENAPFEL"]
    assert values(spark, tx.plain_slug(x), "3 Dinge") == ["X3DINGE"]
    assert values(spark, tx.level_at_least(x, F.lit("K2")), "K1", "K2", "K3", "SCH3", "") == [False, True, True, False, False]
    legend = F.create_map(F.lit("6"), F.lit("Umwelt"), F.lit("7"), F.lit("Sprache"))
    assert values(spark, tx.theme_names(x, legend), "06, 7, 6", "8") == [["Umwelt", "Sprache"], []]
    assert values(spark, tx.unresolved_themes(x, legend), "6, 8", "") == [["8"], []]
    cite = tx.citation(x, F.lit(""), F.lit("BGBl. 1"), F.lit("NOR1"), F.lit(None))
    assert values(spark, cite, "Titel") == ["Titel, BGBl. 1 (NOR: NOR1)"]
    assert values(spark, tx.nfc(x), "ü", None) == ["ü", None]


@pytest.mark.parametrize("value, kind", [("AT.LP23.SEK1.M.ALPHA.K1.01", "competence"), ("AT.LP23.PRIM.SU.AB.IOTA.SCH2.03", "item"), ("AT.LP23.PRIM.SU.DT.SCH2.03", "area_free_item"), ("AT.BIST.M.SCH8.H1.01", "descriptor"), ("AT.LP23.SEK1.M.AB.K1.01", "area_free_item"), ("AT.LP23.SEK1.M.ALPHA.SCH2.01", None), ("AT.LP23.SEK1.SU.ALPHA.K1.01", None), ("AT.LP23.SEK1.M.ALPHA.K1.1", None), ("at.lp23.sek1.m.alpha.k1.01", None), ("AT.LP23.SEK1.M.ALPHA.K1.01.02", None), (None, None)])
def test_id_grammars(spark, value, kind):
    row = ids.parse(spark.createDataFrame([(value,)], "x string"), "x").first()
    assert row.kind == kind
    if kind == "item":
        assert (row.band, row.subject, row.art, row.area, row.level, row.ordinal) == ("PRIM", "SU", "AB", "IOTA", "SCH2", 3)


def test_mint_round_trip(spark):
    lit = lambda *v: [F.lit(x) for x in v]
    made = spark.range(1).select(ids.mint(*lit("SEK1", "M", "ALPHA", "K1", 7)), ids.mint(*lit("SEK1", "M", "AB", "K1", 7)), ids.mint(*lit("SEK1", "M", "ALPHA", "K1", 100)), ids.mint(*lit("PRIM", "SU", "X", "SCH1", 2), art=F.lit("AB")), ids.mint_descriptor(*lit("D", "SCH4", "L", 3))).first()
    assert list(made) == ["AT.LP23.SEK1.M.ALPHA.K1.07", None, None, "AT.LP23.PRIM.SU.AB.X.SCH1.02", "AT.BIST.D.SCH4.L.03"]


def test_index_caps_and_routing(spark):
    rows = spark.createDataFrame([("a", "Bruchzahl überall selten"), ("b", "überall Bruchteil"), ("c", "überall anders")], "part string, text string")
    idx = index.inverted_index(rows, F.col("text"), "part")
    assert {r.term: r.parts for r in idx.collect()} == {"bruchzahl": ["a"], "selten": ["a"], "bruchteil": ["b"], "anders": ["c"]}
    assert {(r.part, r.exact) for r in index.route(idx, ["bruch"]).collect()} == {("a", False), ("b", False)}
    assert [r.part for r in index.routed_search(rows, F.col("text"), "part", idx, ["SELTEN"]).collect()] == ["a"]
    assert index.routed_search(rows, F.col("text"), "part", idx, ["überall"]).count() == 0  # a term of too many parts leads nowhere


def test_cascade(spark):
    left = spark.createDataFrame([(1, "b", "mit zahlen rechnen", 1), (2, "b", "zahlen gut vergleichen", 2), (3, "b", "ganz anders", 3), (4, "c", "allein", 9)], "l int, bucket string, form string, o int")
    right = spark.createDataFrame([(10, "b", "mit zahlen rechnen", 5), (11, "b", "zahlen gut vergleichem", 6), (12, "b", "nichts davon", 3)], "r int, bucket string, form string, o int")
    got = {x.l: (x.r, x.mode) for x in match.cascade_join(left, right, ["bucket"], "l", "form", "o", "r").collect()}
    assert got == {1: (10, "exact"), 2: (11, "fuzzy"), 3: (12, "positional"), 4: (None, "unmatched")}
    assert SequenceMatcher(None, "zahlen gut vergleichen", "zahlen gut vergleichem").ratio() >= 0.9
    rates = match.join_rates(match.cascade_join(left, right, ["bucket"], "l", "form", "o", "r")).first()
    assert (rates.blocks, rates.exact, rates.exact_rate) == (4, 1, 0.25)


def test_containment_both_ways(spark):
    texts = spark.createDataFrame([(1, "x eins zwei drei vier fünf y"), (2, "eins zwei drei vier fünfzig"), (3, None), (4, "")], "id int, t string")
    quotes = spark.createDataFrame([("eins zwei drei vier fünf",), ("zwei drei",), ("fehlt",), (None,)], "q string")
    want = {(1, "eins zwei drei vier fünf"), (1, "zwei drei"), (2, "eins zwei drei vier fünf"), (2, "zwei drei")}
    for most in (1 << 20, 0):
        assert {(r.id, r.q) for r in match.contained(texts, "t", quotes, "q", most).collect()} == want
    records = spark.createDataFrame([("a", "eins zwei drei vier fünfzig"), ("b", "zwei drei"), ("c", "zwei dre")], "id string, f string")
    blocks = texts.where("t is not null").select("t")
    assert {(r.id, r.mode) for r in match.fidelity(records, "id", "f", blocks, "t").collect()} == {("a", "exact"), ("b", "bounded"), ("c", "failed")}


def test_quality_rules(spark):
    rows = spark.createDataFrame([("a", "x", True, "1"), ("a", "x", True, "1"), ("b", "y", True, "1"), ("b", "z", True, "1"), ("c", "x", False, "1"), ("c", "x", False, "1"), ("d", None, True, " ")], "id string, t string, may boolean, r string")
    assert {r.id for r in quality.repeat_aware_collisions(rows, "id", F.col("may"), "t").collect()} == {"b", "c"}
    missing = quality.missing_required(rows, F.col("id"), "t", "r")
    assert {(r.record, r.message) for r in missing.collect()} == {("d", "t"), ("d", "r")}
    assert quality.exit_code(missing) == 1 and quality.exit_code(missing.limit(0)) == 0
    soft = quality.pattern_violations(rows, F.col("id"), F.col("id"), "^[ab]$")
    assert quality.exit_code(soft) == 0 and quality.exit_code(soft, strict=True) == 1
    assert {(r.rule, r.n) for r in quality.roll_up(quality.together(missing, soft)).collect()} == {("missing-required-field", 2), ("malformed-id", 3)}
    stored, found = spark.createDataFrame([("a", 1, 2), ("b", 1, 1)], "k string, x int, y int"), spark.createDataFrame([("a", 1, 3), ("c", 5, 5)], "k string, x int, y int")
    assert {(r.k, r.field) for r in quality.reconcile(stored, found, ["k"], "x", "y").collect()} == {("a", "y"), ("b", "x"), ("b", "y"), ("c", "x"), ("c", "y")}


def test_snapshot_categories(spark):
    schema = "doc string, nor string, sha string, retrieval_date string, url string"
    a = spark.createDataFrame([("x", "1", "h", "d1", "u"), ("y", "1", "h", "d1", "u"), ("z", "1", "h", "d1", "u")], schema)
    b = spark.createDataFrame([("x", "2", "i", "d2", "u"), ("y", "1", "i", "d1", "v"), ("w", "1", "h", "d1", "u")], schema)
    got = diff.classified(diff.field_changes(a, b, "doc", "nor", "sha", "retrieval_date", "url"), "doc", ["nor"], ["sha"], "retrieval_date")
    assert {(r.doc, r.field, r.category) for r in got.collect()} == {("x", "nor", "amendment"), ("x", "sha", "amendment"), ("x", "retrieval_date", "repeal"), ("y", "sha", "silent-republication"), ("y", "url", "metadata"), ("z", "*", "document-removed"), ("w", "*", "document-added")}
    assert {(r.doc, r.side) for r in diff.key_sets(a, b, "doc").collect()} == {("x", "common"), ("y", "common"), ("z", "removed"), ("w", "added")}


def test_anchors_and_claims(spark):
    tree = {"documents": [{"sections": [{"blocks": [{"label": "verbindlich", "items": ["früh"]}, {"type": "kompetenzbezug", "kompetenz_id": "A", "text": "t"}, {"label": "Verbindlich", "items": ["gut", "falsch", "erfunden"]}]}]}]}
    docs = spark.createDataFrame([("d", json.dumps(tree)), ("e", "{"), ("f", None)], "doc string, j string")
    b = anchor.blocks(docs, "doc", "j")
    assert b.where("doc <> 'd'").count() == 0
    b = b.withColumn("a", F.get_json_object("block", "$.kompetenz_id"))
    b = b.withColumn("anchor", anchor.anchor_in_force(b, ["doc"], "pos", F.col("a")))
    rows = b.select("doc", "pos", "anchor", F.get_json_object("block", "$.label").alias("label"), F.explode(F.from_json(F.get_json_object("block", "$.items"), "array<string>")).alias("item"))
    claimed = anchor.claims(rows, F.col("label"), F.col("item"))
    truth = spark.createDataFrame([("A", "gut", True), ("A", "falsch", False)], "anchor string, item string, verbindlich boolean")
    assert {r.item: r.rule for r in anchor.classify_claims(claimed, truth, "anchor", "item", "verbindlich").collect()} == {"früh": "no-anchor", "gut": "ok", "falsch": "swapped", "erfunden": "fabricated"}
    quoted = b.where("type = 'kompetenzbezug'").select(F.col("a").alias("id"), "pos", F.get_json_object("block", "$.text").alias("text"))
    known = spark.createDataFrame([("A", "anders")], "id string, text string")
    assert [r.rule for r in anchor.check_quotes(quoted, known, "id", "text").collect()] == ["text-differs"]
    assert [r.rule for r in anchor.check_quotes(quoted, known.limit(0), "id", "text").collect()] == ["unknown-anchor"]


def test_budget_skips_and_goes_on(spark):
    rows = spark.createDataFrame([(1, 50), (2, 60), (3, 30), (4, 20)], "rank int, size int")
    take = lambda b: [r["rank"] for r in rank.within_budget(rows, F.col("size"), b).collect() if r.accepted]
    assert take(100) == [1, 3, 4] and take(10) == [1] and take(1000) == [1, 2, 3, 4]


def test_graph(spark):
    rows = spark.createDataFrame([("a1", "g", 1), ("a2", "g", 1), ("b1", "g", 2), ("c1", "h", 2)], "id string, g string, n int")
    got = {r.id: (r.before, r.after) for r in graph.progression(rows, "id", ["g"], "n").collect()}
    assert got == {"a1": ([], ["b1"]), "a2": ([], ["b1"]), "b1": (["a1", "a2"], []), "c1": ([], [])}
    links = graph.back_links(rows, F.lit(True), rows, "id", "id2", ["g"], "n") if False else graph.back_links(rows, F.col("id") != "a2", rows.withColumn("id2", F.col("id")), "id", "id2", ["g"], "n")
    assert {r.id: (r.targets, r.issue) for r in links.collect()} == {"a1": ([], "first-level"), "b1": (["a1", "a2"], None), "c1": ([], "no-target")}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("xml")
    (path / "lehrplan.xml").write_text(fixtures.XML, encoding="utf-8")
    events = tree_xml.xml_events(spark, f"file://{path}").cache()
    return events, build.build(events, build.Spec("SEK1.M", "Mathematik", "kompetenz", optional_items=True)), tree_xml.source_blocks(spark, f"file://{path}")


def test_xml_keeps_mixed_content_in_order(built):
    events, _, blocks = built
    rows = {r.text: r for r in events.collect()}
    assert rows["mit Zahlen rechnen"].supers == ["6, 7"] and rows["Zahlen ⟦ABB:z1.png⟧ vergleichen"].images == ["z1.png"] and "6 Umwelt-Bildung" in rows
    assert {r.label: r.value for r in tree_xml.header_values(events).collect()} == {"Kurztitel": "Lehrplan Probe"}
    assert "6 Umwelt-Bildung" in {r.text for r in blocks.collect()}


def test_build(built):
    _, out, _ = built
    k = {r.id: r for r in out["competences"].collect()}
    one, two, three = "AT.LP23.SEK1.M.ZAHLEN.K1.01", "AT.LP23.SEK1.M.ZAHLEN.K1.02", "AT.LP23.SEK1.M.ZAHLEN.K2.01"
    assert set(k) == {one, two, three}
    assert k[one].uebergreifende_themen == ["Umwelt-Bildung", "Sprache"] and k[two].fussnoten_unaufgeloest == ["99"]
    assert k[one].stammsatz.startswith("Die Schülerinnen") and k[three].stammsatz == ""  # a new level resets the stem
    assert k[three].vorlaeufer == [one, two] and k[one].folge == [three]
    assert {(r.id, r.mode) for r in out["blocks"].collect()} == {(one, "exact"), (two, "fuzzy"), (three, "positional")}
    assert {r.text: r.verbindlich for r in out["items"].collect()}["allenfalls wurzeln"] is False
    assert {(tuple(r.targets), r.issue) for r in out["repeats"].collect()} == {((), "first-level"), ((one, two), None)}
    assert [r.text for r in out["issues"].collect()] == ["Unbekanntes"]
    counts = {r.name: r.measured for r in build.counts(out["competences"], out["items"]).collect()}
    assert counts["kompetenzen"] == 3 and counts["unverbindlich"] == 1 and counts["wiederholungen"] == 2


def test_snapshots(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"x": {"nor": "1", "files": {"pdf": {"sha256": "h", "size": 1}}}, "y": {"nor": "2"}}))
    rows = snapshots.manifest(spark, f"file://{tmp_path}/m.json")
    assert {(r.document, r.nor, r.pdf_sha256) for r in rows.collect()} == {("x", "1", "h"), ("y", "2", None)}
    assert list(json.loads(snapshots.manifest_json(rows.select("document", "nor"), "document").first().value)) == ["x", "y"]
    (tmp_path / "bad.json").write_text("[1]")
    with pytest.raises(Exception, match="JSON object"):
        snapshots.manifest(spark, f"file://{tmp_path}/bad.json").collect()
    assert snapshots.all_pages(lambda n: [{"k": n}, {"k": 1, "n": n}] if n < 4 else [], "k") == [{"k": 1}, {"k": 2}, {"k": 3}]
    laws = spark.createDataFrame([("g", "n1", "Anl. 1", "2020-01-01", None), ("g", "n2", "Anl. 1", "2021-01-01", ""), ("g", "n3", "Anl. 1", "2022-01-01", "2023-01-01"), ("g", "n4", "Anl. 2", "2024-01-01", None)], "g string, nor string, artikel_paragraph_anlage string, inkrafttretensdatum string, ausserkrafttretensdatum string")
    got = snapshots.in_force(laws, ["g"]).first()
    assert got.nor == "n2" and got.disambiguated
    doc = F.lit('{"a": {"b": [1, 2]}, "c": {"d": 5}}')
    assert list(spark.range(1).select(snapshots.path_value(doc, "c.d"), snapshots.path_value(doc, "c.x"), snapshots.as_list(doc, "a.b"), snapshots.as_list(doc, "c"), snapshots.as_list(doc, "q")).first()) == ["5", None, ["1", "2"], ['{"d":5}'], []]
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (300).to_bytes(4, "big") + (17).to_bytes(4, "big") + b"\x08\x02\0\0\0"
    (tmp_path / "a.png").write_bytes(png)
    r = snapshots.images(spark, f"file://{tmp_path}").first()
    assert (r.width, r.height, r.bytes) == (300, 17, len(png))
    old, new = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, w int, u string"), spark.createDataFrame([("a", 9, None), ("c", 3, "z")], "k string, w int, u string")
    assert {tuple(r) for r in snapshots.merged_registry(old, new, "k").collect()} == {("a", 9, "x"), ("b", 2, "y"), ("c", 3, "z")}
    tagged = spark.createDataFrame([(1, None), (2, "m=1; l=de"), (3, "m=2")], "i int, t string")
    assert [r.i for r in tagged.where(rank.applicable(F.col("t"), ["m=1", "l=de"])).collect()] == [1, 2]


def test_streamed_postings(spark, tmp_path):
    from lexigraph.streaming.incremental import current_index, follow

    for n, rows in enumerate([[("a", "Bruchzahl hier")], [("b", "Bruchzahl dort")]]):
        spark.createDataFrame(rows, "part string, text string").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = spark.readStream.schema("part string, text string").parquet(f"file://{tmp_path}/in")
        follow(stream, "text", "part", f"file://{tmp_path}/out", f"file://{tmp_path}/ck").awaitTermination()
    assert {r.term: r.parts for r in current_index(spark, f"file://{tmp_path}/out").collect()} == {"bruchzahl": ["a", "b"], "hier": ["a"], "dort": ["b"]}


def test_repeats_of_null_contents_and_tasks_by_size(spark, tmp_path, monkeypatch):
    rows = [(1, True, "x", None), (1, True, None, "x"), (2, True, None, "x"), (2, True, None, "x"), (3, False, "x", "y"), (3, True, "x", "y"), (4, None, "x", "y"), (None, False, None, None), (None, True, None, None)]
    df = spark.createDataFrame(rows, "k long, may boolean, a string, b string")
    want = {(1, 2, 2), (3, 2, 1), (None, 2, 1)}
    assert {tuple(r) for r in quality.repeat_aware_collisions(df, "k", F.col("may"), "a", "b").collect()} == want
    df.write.parquet(f"file://{tmp_path}/t")
    monkeypatch.setattr(quality, "SLICE", 64)
    got = quality.repeat_aware_collisions(spark.read.parquet(f"file://{tmp_path}/t"), "k", F.col("may"), "a", "b")
    assert got.rdd.getNumPartitions() > 8 and {tuple(r) for r in got.collect()} == want
    # one exchange, and no counting before it
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan.split("Exchange")[-1]
