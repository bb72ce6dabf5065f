import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lexigraph.functions import text as tx
from lexigraph.operators import index, lessons, match
from lexigraph.plans import build
from lexigraph.sources import docs, snapshots


def values(spark, column, *rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_full_case_folding(spark):
    odd = ["ſtraße", "ΣΑΣ ς", "ﬁn ﬂ", "İzmir", "ŉa ǰ ΐ", "Ǆ ᾳ ᾼ", "µ Å K", "ẞ", "ꭰ Ꭰ", "plain ÄÖÜ", ""]
    assert values(spark, tx.casefold(F.col("x")), *odd, None) == [x.casefold() for x in odd] + [None]


def test_theme_sentences_and_area_forms(spark):
    found = values(spark, tx.theme_sentence(F.col("x")), "Umwelt13, Wirtschafts-, Finanz- und Verbraucherbildung4.", "ohne", "", None)
    assert [[tuple(t) for t in x] if x is not None else None for x in found] == [[("13", "Umwelt"), ("4", "Wirtschafts-, Finanz- und Verbraucherbildung")], [(None, "ohne")], [], None]
    name = lambda form, *x: [tuple(r) if r else None for r in values(spark, build.area_name(F.col("x"), form), *x)]
    assert name("numbered", "Kompetenzbereich 3: Zahlen ", "Kompetenzbereich Lesen") == [(3, "Zahlen"), None]
    assert name("unnumbered", "Integrativer Kompetenzbereich Sprache", "Kompetenzbereich Lesen", "Lesen") == [(None, "Sprache"), (None, "Lesen"), None]
    assert name("plain", "Integrativer Kompetenzbereich Sprache") == [None]
    assert name("adjective", "Technischer Kompetenzbereich", "Kompetenzbereich Lesen") == [(None, "Technischer Kompetenzbereich"), None]


def test_levels_axes_and_blocks(spark):
    say = lambda n: f"In allen vier Kompetenzbereichen wird das Zielniveau {n} angestrebt. Und mehr."
    rows = [("d", 5, 0, "K1", "s", say("A1")), ("d", 7, 0, "K1", "s", say("A2")), ("d", 9, 0, "K2", "s", say("A2+ mit B1")), ("d", 1, 0, None, "s", say("C1")), ("d", 3, 0, "K3", "s", "Zielniveau A1")]
    levels = build.target_levels(spark.createDataFrame(rows, "doc string, idx int, pos int, level string, section string, text string"))
    assert sorted((r.stufe, r.niveau, r.quell_index) for r in levels.collect()) == [("K1", "A1", 5), ("K2", "A2+ mit B1", 9)]
    axes = spark.createDataFrame([("d", ("x", ("gers", True))), ("e", ("x", ("gers", True))), ("f", ("x", None))], "doc string, achse struct<typ: string, gers: struct<typ: string, je_stufe_ausgewiesen: boolean>>")
    got = {r.doc: r.achse.gers for r in build.with_axis(axes, "achse", levels).collect()}
    assert got["d"].je_stufe_ausgewiesen and got["d"].je_stufe["K2"].niveau == "A2+ mit B1" and not got["e"].je_stufe_ausgewiesen and got["f"] is None
    blocks = spark.createDataFrame([("d", "K1"), ("d", "K1"), ("d", "K2")], "doc string, stufe string")
    assert [tuple(r) for r in build.level_blocks(blocks, "stufe").collect()] == [("d", "K1", 2)] and build.level_blocks(blocks, "bereich").count() == 0


def test_similar_forms_against_all_pairs(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(1, 40))) for _ in range(40)]

    def changed(t):
        t = list(t)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.randrange(2)] = rng.choice(["", "x", "ab"])
        return "".join(t)

    left, right = [(i % 3, t) for i, t in enumerate(base)], [(i % 3, changed(t)) for i, t in enumerate(base * 3)]
    for threshold in (0.9, 0.75, 1.0):
        want = {(x, y) for a, x in left for b, y in right if a == b and x and y and SequenceMatcher(None, x, y).ratio() >= threshold}
        got = match.similar_forms(spark.createDataFrame(left, "b int, f string"), spark.createDataFrame(right, "b int, g string"), ["b"], "f", "g", threshold)
        assert {(r.f, r.g) for r in got.collect()} == want and len(want) > 3


def test_containment_by_every_route(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["ab", "cde", "f", "gh-i", "jk"]) for _ in range(n))
    texts = [(i, say(rng.randrange(20))) for i in range(40)] + [(90, None), (91, "")]
    quotes = [say(n) for n in (1, 2, 4, 6, 7) for _ in range(4)] + ["b", " f", "h-", "", None, "zzz"]
    want = {(i, q) for i, t in texts for q in quotes if t is not None and q is not None and q in t}
    a, b = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame([(q,) for q in set(quotes)], "q string")
    for most in (1 << 20, 0):
        got = [(r.id, r.q) for r in match.contained(a, "t", b, "q", most).collect()]
        assert set(got) == want and len(got) == len(want)


def test_located_prefix_and_tally(spark):
    pairs = [("abcdef", "xxabcdyy"), ("abc", "abc"), ("q", "abc"), ("", "abc"), ("aaaa", "aa b aaa")]
    df = spark.createDataFrame(pairs, "n string, h string")
    want = [max((n[:i] for i in range(len(n) + 1) if n[:i] in h), key=len) for n, h in pairs]
    assert [r[0] for r in df.select(match.located_prefix(F.col("n"), F.col("h"))).collect()] == want
    modes = spark.createDataFrame([("exact",), ("exact",), ("failed",)], "mode string")
    assert {r.mode: r.n for r in match.mode_tally(modes).collect()} == {"exact": 2, "bounded": 0, "failed": 1}


def test_documents_images_and_deviations_are_written(spark, tmp_path):
    rows = spark.createDataFrame([("a/b.json", '{"x": 1}'), ("c d__e.md", "zwei\nZeilen"), ("ü.txt", "")], "file string, value string")
    snapshots.write_documents(rows, f"file://{tmp_path}/out")
    assert (tmp_path / "out/a/b.json").read_text() == '{"x": 1}\n' and (tmp_path / "out/c d__e.md").read_text() == "zwei\nZeilen\n" and (tmp_path / "out/ü.txt").exists()
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith((".", "_"))] or not (tmp_path / "out/.writing").exists()
    png = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR\x00\x00\x00\x05\x00\x00\x00\x06"
    snapshots.write_binary(spark, {"a.png": png, "b.png": png}, f"file://{tmp_path}/img")
    got = snapshots.install_images(spark, f"file://{tmp_path}/img", f"file://{tmp_path}/new", spark.createDataFrame([("a.png",), ("a.png",), ("fehlt.png",)], "datei string"))
    assert [(r.datei, r.copied) for r in got.collect()] == [("a.png", True)] and (tmp_path / "new/a.png").read_bytes() == png and not (tmp_path / "new/b.png").exists()
    for n in range(2):
        snapshots.append_deviations(spark.createDataFrame([("d", "r", str(n))], "document string, rule string, message string"), f"file://{tmp_path}/log")
    assert spark.read.json(f"file://{tmp_path}/log").count() == 2


def test_provenance_and_search_address(spark):
    row = spark.createDataFrame([("k", "NOR1", "Titel", "BGBl. 1 ", "Anl. 1", "2025-01-01")], "document string, nor string, kurztitel string, kundmachungsorgan string, artikel_paragraph_anlage string, retrieval_date string")
    got = snapshots.provenance(row, F.lit(None).cast("string")).first().provenienz.asDict()
    assert got == {"quelle": "RIS Bundesrecht konsolidiert", "kurztitel": "Titel", "nor": "NOR1", "kundmachung": "BGBl. 1", "anlage": "Anl. 1", "teil": "", "stand": "2025-01-01"}
    with pytest.raises(Exception, match="no manifest entry"):
        snapshots.provenance(row.withColumn("nor", F.lit(None).cast("string")), F.lit("x")).select("provenienz.nor").collect()
    url = spark.range(1).select(snapshots.search_url("https://h/x", F.lit("10 1"), F.lit("2025-01-01"), F.lit(3))).first()[0]
    assert url == "https://h/x?Applikation=BrKons&Gesetzesnummer=10+1&Fassung.FassungVom=2025-01-01&Seitennummer=3"


def test_material_beyond_the_file_limit(spark):
    rows = [(f"t{i}", f"p{i:02d}.md", "M", None, None, "md", False, "x", 4, 1, "treffer", None) for i in range(6)]
    got = {r.pfad: (r.status, r.grund) for r in docs.collect_material(spark.createDataFrame(rows, docs.SCHEMA), "M", most_files=4, most_tokens=3).collect()}
    assert got == {"p00.md": ("treffer", None), "p01.md": ("treffer", None), "p02.md": ("treffer", None), "p03.md": ("verworfen", "token budget"), "p04.md": ("verworfen", "file limit"), "p05.md": ("verworfen", "file limit")}


def test_shape_sizes(spark):
    df = spark.createDataFrame([("g", "aaa", "zz"), ("g", "a", "zz"), ("g", "b", "y"), ("h", None, "y")], "k string, own string, s string")
    assert {r.k: (r.repeated_bytes, r.shared_bytes) for r in index.shape_sizes(df, ["k"], F.col("own"), "s").collect()} == {"g": (10, 8), "h": (1, 1)}


def test_prose_is_mended():
    p = lambda text, kind="paragraph", **more: {"type": kind, "text": text, **more}
    assert lessons.mended([p("eine Zeile - und | mehr"), {"type": "h2", "text": "a\n- b"}]) == [p("eine Zeile - und | mehr"), {"type": "h2", "text": "a\n- b"}]
    assert lessons.mended([p("• a\n- b\nrest", "labeled", label="X")]) == [p("", "labeled", label="X"), {"type": "list", "items": ["a", "b"]}, p("rest")]
    assert lessons.mended([p("see\n| a | b |\n|---|:-:|\n| 1 |\nend\nof it")]) == [p("see"), {"type": "table", "headers": ["a", "b"], "rows": [["1", ""]]}, p("end\nof it")]
    assert lessons.mended([p("one row\n| a | b |")]) == [p("one row"), p("| a | b |")] and lessons.mended([p("\n")]) == [p("")]
    inside = lessons.mended([{"type": "columns", "left": [p("- a\n- b")], "right": []}, {"type": "niveau_spalte", "niveaus": [{"label": "L", "blocks": [p("x\n- y")]}]}])
    assert inside[0]["left"] == [{"type": "list", "items": ["a", "b"]}] and inside[1]["niveaus"][0]["blocks"][1]["items"] == ["y"]
    sections = [{"blocks": [p("a")]}, {"blocks": [p("3 + ■ = 5")]}]
    assert len(lessons.with_symbol_note(sections)[1]["blocks"]) == 2 and lessons.with_symbol_note([{"blocks": [p("■ stands for x. ■")]}]) == [{"blocks": [p("■ stands for x. ■")]}]
    assert lessons.meta_line([{"label": "Zeit:", "value": "5"}, "x", {"text": "y"}]) == "Zeit: 5 · x · y" and lessons.marks([1, "2", {"position": 3, "label": "c"}, None, "z"]) == [(1.0, None), (2.0, None), (3.0, "c")]


def test_commands_and_exit_codes(spark, tmp_path, capsys):
    from lexigraph.__main__ import main

    from . import fixtures

    (tmp_path / "data").mkdir()
    root = fixtures.write(tmp_path / "data")
    assert main(["validate", f"{root}/daten", "--strict"]) == 1 and "index-missing" in capsys.readouterr().out
    assert main(["report", f"{root}/daten"]) == 0 and "SEK1.M\talpha.json\t5" in capsys.readouterr().out
    assert main(["validate", f"file://{tmp_path}/nichts"]) == 2
    lesson = '{"id": "l", "tree": "{\\"documents\\": [{\\"id\\": \\"blatt\\", \\"title\\": \\"T\\", \\"grade\\": 1, \\"sections\\": [{\\"blocks\\": [{\\"type\\": \\"workspace\\"}]}]}]}"}'
    (tmp_path / "l.json").write_text(lesson)
    assert main(["render", f"file://{tmp_path}/l.json", f"file://{tmp_path}/html"]) == 0
    assert 'style="height:200pt"' in (tmp_path / "html/l/blatt.html").read_text()
    entry = '"artikel_paragraph_anlage": "Anl. 1", "kundmachungsorgan": "B", "files": {"pdf": {"sha256": "%s", "size": 1}}'
    for name, digest in (("a", "1"), ("b", "2")):
        (tmp_path / f"{name}.json").write_text('{"doc": {"nor": "N", ' + entry % digest + "}}")
    assert main(["diff", f"file://{tmp_path}/a.json", f"file://{tmp_path}/b.json"]) == 1 and "silent-republication" in capsys.readouterr().out
    assert main(["diff", f"file://{tmp_path}/a.json", f"file://{tmp_path}/a.json"]) == 0


def test_grades():
    assert [lessons.grade(d) for d in ({"grade": "K"}, {"shared": {"grade": "Grade 4"}}, {"eyebrow": "7th grade math"}, {"meta": [{"label": "Grade", "value": "11"}]}, {"title": "x"}, {"eyebrow": "Kindergarten"}, {"grade": "2nd"}, {"meta": "page 3"})] == [0, 4, 7, 11, None, 0, 2, None]


def test_extractors_in_order(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.pdf").write_bytes(b"%PDF eins")
    none = docs.scan(spark, f"file://{tmp_path}/m").first()
    some = docs.scan(spark, f"file://{tmp_path}/m", extractors={"pdf": (lambda c: None, lambda c: c.decode()[5:])}).first()
    assert (none.status, none.grund, some.status, some.text) == ("uebersprungen", "no text could be extracted", "treffer", "eins")


def test_standards_documents(spark):
    from lexigraph.plans import standards

    rows = spark.createDataFrame([("x.02", "M", "SCH8", "B", "s", "t2", 2), ("x.01", "M", "SCH8", "A", "s", "t1", 1), ("y.01", "D", "SCH4", "A", "s", "t", 1)], "id string, fach string, programmstufe string, bereich_code string, stammsatz string, text string, ordinal int")
    names = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "bereich_code string, name string")
    import json

    got = {r.file: json.loads(r.value) for r in standards.documents(rows, names, F.create_map(F.lit("q"), F.lit("v"))).collect()}
    assert set(got) == {"m8.json", "d4.json"} and got["m8.json"]["meta"]["shard"] == "M8"
    assert [a["name"] for a in got["m8.json"]["kompetenzbereiche"]] == ["Alpha", "Beta"] and [x["id"] for x in got["m8.json"]["deskriptoren"]] == ["x.01", "x.02"]


def test_rubric_tables(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/eins.csv").write_text('Criterion,Conditional\n"sagt ""ja""\nund mehr",\nzwei,lang=de; band=PRIM\n')
    rows = snapshots.rubric(spark, f"file://{tmp_path}").collect()
    assert sorted((r.Criterion, r.Conditional) for r in rows) == [('sagt "ja"\nund mehr', None), ("zwei", "lang=de; band=PRIM")]


def test_conversions_are_kept_until_the_file_changes(spark, tmp_path):
    import datetime

    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.pdf").write_bytes(b"%PDF eins")
    schema = "pfad string, cache_mtime timestamp, cached string"
    later, before = datetime.datetime(2100, 1, 1), datetime.datetime(2000, 1, 1)
    scan = lambda at: docs.scan(spark, f"file://{tmp_path}/m", spark.createDataFrame([("a.pdf", at, "aus dem Speicher")], schema)).first()
    assert scan(later).text == "aus dem Speicher" and scan(before).text is None


def test_arguments_that_exclude_each_other(spark, tmp_path):
    from lexigraph.plans.curriculum import Curriculum, CurriculumError

    from . import fixtures

    root = fixtures.write(tmp_path)
    c = Curriculum(spark, f"{root}/daten")
    for call in (lambda: c.finde_anwendungsbereiche(), lambda: c.finde_anwendungsbereiche("x", fach="SEK1.M"), lambda: c.finde_uebergreifende_themen(), lambda: c.finde_uebergreifende_themen(fach="SEK1.M", thema="x"), lambda: c.finde_kompetenz("SEK1.X")):
        with pytest.raises(CurriculumError):
            call()


def test_origin_is_named():
    official = lessons.origin({"amtlich": True, "quelle": {"kurztitel": "Q"}, "blocks": []})
    own = lessons.origin({"quelle_hinweis": "selbst", "blocks": [{"type": "paragraph", "text": "t"}]})
    assert "Amtlicher Text" in official and "Quelle: Q" in official and "Eigenes Material" in own and "Herkunft: selbst" in own


def test_folding_looks_up_plain_texts_in_one_table(spark):
    *_, wide, suspect = tx._folds()
    latin = "".join(map(chr, range(256))).replace("µ", "").lower()  # all that a lower-case text of single bytes holds
    latin, odd = latin.replace("ß", ""), ["aµ", "ſ", "ﬁ", "x ǰ", "ꭰ"]  # ß is replaced before
    assert values(spark, F.col("x").rlike(wide), latin, *odd) == [False] + [True] * len(odd)
    assert all(values(spark, F.col("x").rlike(suspect), *odd))
    assert values(spark, tx.casefold(F.col("x")), latin, latin.upper(), "„Maß“ – 3 €") == [latin.casefold(), latin.upper().casefold(), "„mass“ – 3 €"]


def test_words_are_whole_runs(spark):
    texts = ["Maß und Übung12, m² Ⅷabc ⟦ABB:bildname.png⟧x", "⟦ABB:⟧ offen", "abc abcd́e 𝒜𝒷𝒸𝒹 x_yzzz"]
    assert values(spark, tx.words(F.col("x")), *texts, None) == [["Übung", "Ⅷabc"], ["offen"], ["abcd", "𝒜𝒷𝒸𝒹", "yzzz"], None]
