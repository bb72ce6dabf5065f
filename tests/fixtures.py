"""Invented curriculum data covering every binding, source and standards relation."""

from __future__ import annotations

import json
from pathlib import Path

SOURCE = {"quelle": "Amtsblatt", "kurztitel": "Lehrplan Probe", "nor": "NOR1", "kundmachung": "BGBl. 1", "anlage": "Anl. 1", "teil": "2. Teil", "stand": "2025-01-01"}
AXIS = {"typ": "standard_standardplus", "niveaus": ["Standard", "Standard plus"], "gilt_ab_stufe": "K2"}


def meta(band, code, name, binding, source="aus_anwendungsbereichen", relation="verordnet", axis=None, blocks=None):
    return {"band": band, "fach": {"code": code, "name": name}, "uebergreifende_themen_fach": ["Umwelt", "Sprache"] if code == "M" else ["Sprache"], "uebergreifende_themen_legende": {"6": "Umwelt"}, "differenzierungs_achse": axis or AXIS, "anwendungsbereiche_bindung": binding, "lehrstoff_quelle": source, "bildungsstandard_bezug": relation, "provenienz": SOURCE, **({"anwendungsbereiche_bloecke": blocks} if blocks else {})}


def item(id, text, art="praezisierung", binding=True, owner=None, level="K1"):
    return {"id": id, "stufe": level, "ordinal": int(id[-2:]), "text": text, "verbindlich": binding, "art": art, "kompetenz_id": owner, "wiederholung_von": []}


def record(id, text, level, ordinal, stem="Die Kinder können", before=(), after=(), **more):
    return {"id": id, "stufe": level, "ordinal": ordinal, "stammsatz": stem, "text": text, "uebergreifende_themen": ["Umwelt"] if ordinal == 1 else [], "vorlaeufer": list(before), "folge": list(after), "abbildungen": [], **more}


def area(slug, name, *records, number=None):
    return {"nummer": number, "slug": slug, "name": name, "kompetenzen": list(records)}


def write(root: Path) -> str:
    m, d = "AT.LP23.SEK1.M.", "AT.LP23.SEK1.D."
    one, two = m + "ALPHA.K1.01", m + "ALPHA.K2.01"
    own = [item(m + "AB.ALPHA.K1.01", "Brüche kürzen und erweitern", owner=one), item(m + "AB.ALPHA.K1.02", "allenfalls Kettenbrüche", binding=False, owner=one), item(m + "AB.ALPHA.K1.03", "mit Software zeichnen", art="digitale_technologien", owner=one)]
    files = {
        "sek1/m/alpha.json": {"meta": meta("SEK1", "M", "Mathematik", "kompetenz", axis=AXIS | {"enrichment_quelle": "allenfalls"}), "kompetenzbereiche": [area("ALPHA", "Zahlen und Maße", record(one, "mit Bruchzahlen rechnen.", "K1", 1, after=[two], anwendungsbereiche=own), record(two, "Gleichungen lösen.", "K2", 1, before=[one, m + "ALPHA.K1.09"], anwendungsbereiche=[]), number=1)]},
        "sek1/m/zusatz.json": {"meta": meta("SEK1", "M", "Mathematik", "kompetenz"), "kompetenzbereiche": [], "zusatzkompetenzen": [record(m + "EXTRA.K3.01", "Körper darstellen.", "K3", 1)], "digitale_technologien_vorschlaege": [item(m + "DT.K1.01", "Tabellen am Computer", art="digitale_technologien")]},
        "sek1/d/gamma.json": {"meta": meta("SEK1", "D", "Deutsch", "bereich", blocks={"GAMMA.K1": {"bindung": "bereich", "bereich_name": "Lesen", "bereich_slug": "GAMMA", "items": [item(d + "AB.GAMMA.K1.01", "Sagen und Märchen")]}, "DELTA.K1": {"bindung": "bereich", "bereich_name": "Schreiben", "bereich_slug": "DELTA", "items": [item(d + "AB.DELTA.K1.01", "Briefe")]}}), "kompetenzbereiche": [area("GAMMA", "Lesen", record(d + "GAMMA.K1.01", "Texte verstehen.", "K1", 1), record(d + "GAMMA.K1.02", "Texte deuten.", "K1", 2), record(d + "GAMMA.K2.01", "Texte vergleichen.", "K2", 1, before=[d + "GAMMA.K1.01", d + "GAMMA.K1.02"]))]},
        "sek1/d/delta.json": {"meta": meta("SEK1", "D", "Deutsch", "bereich"), "kompetenzbereiche": [area("DELTA", "Schreiben")]},
        "sek1/e/epsilon.json": {"meta": meta("SEK1", "E", "Englisch", "prosa", axis=AXIS | {"gers": {"typ": "gers", "niveaus": ["A1"], "je_stufe_ausgewiesen": True, "je_stufe": {"K1": {"niveau": "A1", "satz": "Zielniveau A1", "abschnitt": "1. Klasse", "quell_index": 3}}}}), "kompetenzbereiche": [area("EPSILON", "Hören", record("AT.LP23.SEK1.E.EPSILON.K1.01", "Ansagen verstehen.", "K1", 1, before=[d + "GAMMA.K1.01"]))]},
        "prim/m/theta.json": {"meta": meta("PRIM", "M", "Mathematik", "keine", source="eigen_ausgewiesen", axis={"typ": "lehrplan_generisch", "niveaus": ["A", "B"]}), "kompetenzbereiche": [area("THETA", "Größen", record("AT.LP23.PRIM.M.THETA.SCH1.01", "Längen messen.", "SCH1", 1))]},
        "prim/su/iota.json": {"meta": meta("PRIM", "SU", "Sachunterricht", "stufe", relation="keine_verordnung", blocks={"SCH2": {"bindung": "stufe", "items": [item("AT.LP23.PRIM.SU.AB.SCH2.01", "Wetter beobachten", level="SCH2")]}}), "kompetenzbereiche": [area("IOTA", "Natur", record("AT.LP23.PRIM.SU.IOTA.SCH2.01", "das Wetter beschreiben.", "SCH2", 1))]},
    }
    files["prim/su/kappa.json"] = {"meta": files["prim/su/iota.json"]["meta"], "kompetenzbereiche": [area("KAPPA", "Technik", record("AT.LP23.PRIM.SU.KAPPA.SCH1.01", "Geräte nutzen.", "SCH1", 1))]}
    files["sek1/m/index.json"] = {"meta": files["sek1/m/zusatz.json"]["meta"], "teile": [{"datei": "alpha.json"}], "stichwort_index": {"bruch": "alpha.json"}}
    for name, doc in files.items():
        path = root / "daten" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(doc, ensure_ascii=False, indent=1), encoding="utf-8")
    bist = root / "standards"
    bist.mkdir()
    descriptor = lambda n, area: {"id": f"AT.BIST.M.SCH8.{area}.{n:02d}", "fach": "M", "programmstufe": "SCH8", "bereich_code": area, "stammsatz": "Lernende können", "text": f"Satz {n}.", "ordinal": n}
    (bist / "m8.json").write_text(json.dumps({"meta": {"shard": "M8", "programmstufe": "SCH8", "provenienz": {"quelle": "x"}}, "kompetenzbereiche": [{"code": "H1", "name": "Modell"}, {"code": "H2", "name": "Rechnen"}], "deskriptoren": [descriptor(1, "H1"), descriptor(2, "H1"), descriptor(3, "H2")]}))
    bridge = lambda area, kind: {"lehrplan_fach": "SEK1.M", "lehrplan_bereich": "ALPHA", "bildungsstandard_shard": "m8", "bildungsstandard_bereich": area, "beziehung": kind, "amtlich": False, "rationale": "r"}
    (bist / "crosswalk.json").write_text(json.dumps({"meta": {}, "zuordnungen": [bridge("H1", "bereichsentsprechung"), bridge("H2", "querschnitt_prozess"), bridge("H1", "matrix_inhaltsachse")], "nicht_abgedeckt": []}))
    docs = root / "docs"
    for name, text in {"README.md": "no", "notiz.md": "freie Notiz", "mathematik/K1/blatt.md": "# Übungsblatt\n" + "wort " * 100, "mathematik/allgemein.txt": "Text", "mathematik/K2/zwei.md": "zwei", f"mathematik/K2/drei__{one}.md": "eigenes", "deutsch/kopf.md": f"---\nkompetenz_id: {one}\ntitel: x\n---\nText", "mathematik/.hidden/x.md": "h", "mathematik/bild.xyz": "?", "mathematik/kaputt.pdf": "%PDF", "mathematik/K1/roh.txt": b"gut \xff schlecht"}.items():
        path = docs / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"file://{root}"


XML = """<risdok xmlns="http://www.bka.gv.at"><metadaten/><nutzdaten><abschnitt>
<ueberschrift typ="g1">Deutsch</ueberschrift><liste><aufzaehlung><listelem>nicht dieses</listelem></aufzaehlung></liste>
<ueberschrift typ="g1">Mathematik</ueberschrift>
<ueberschrift typ="erll">Kurztitel</ueberschrift><absatz typ="abs">Lehrplan Probe</absatz>
<ueberschrift typ="g2">1. Klasse</ueberschrift><ueberschrift typ="g3">Kompetenzbereich 1: Zahlen und Maße</ueberschrift>
<absatz typ="abs">Die Schülerinnen und Schüler können</absatz>
<liste><aufzaehlung><listelem><symbol>–</symbol>mit Zahlen <super>6, 7</super>rechnen</listelem><listelem>Zahlen <binary><src>img/z1.png</src></binary> vergleichen<super>99</super></listelem></aufzaehlung></liste>
<ueberschrift typ="g2">2. Klasse</ueberschrift><ueberschrift typ="g3">Kompetenzbereich 1: Zahlen und Maße</ueberschrift>
<liste><aufzaehlung><listelem>ohne Stamm lösen</listelem></aufzaehlung></liste>
<ueberschrift typ="g2">Anwendungsbereiche</ueberschrift><ueberschrift typ="g2">1. Klasse</ueberschrift><ueberschrift typ="g3">Kompetenzbereich 1: Zahlen und Maße</ueberschrift>
<absatz typ="abs">Die Schülerinnen und Schüler können mit Zahlen rechnen</absatz><liste><aufzaehlung><listelem>addieren</listelem><listelem>allenfalls wurzeln</listelem></aufzaehlung></liste>
<absatz typ="abs">Die Schülerinnen und Schüler können Zahlen ⟦ABB:z1.png⟧ vergleichem</absatz><liste><aufzaehlung><listelem>Wiederholen und Festigen: ordnen</listelem></aufzaehlung></liste>
<ueberschrift typ="g2">2. Klasse</ueberschrift><ueberschrift typ="g3">Kompetenzbereich 1: Zahlen und Maße</ueberschrift>
<absatz typ="abs">Die Schülerinnen und Schüler können etwas völlig anderes tun</absatz><liste><aufzaehlung><listelem>Wiederholen und Festigen: alles</listelem></aufzaehlung></liste>
<ueberschrift typ="g2">Unbekanntes</ueberschrift>
<ueberschrift typ="g2">Übergreifende Themen</ueberschrift><table><tr><td>6 Umwelt<gdash/>Bildung</td><td>7 Sprache</td></tr></table>
<ueberschrift typ="g1">Musik</ueberschrift><liste><aufzaehlung><listelem>auch nicht</listelem></aufzaehlung></liste>
</abschnitt></nutzdaten></risdok>"""
