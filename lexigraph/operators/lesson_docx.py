"""Lesson documents as Word files: the blocks of lessons.py as paragraphs and tables of a minimal package."""

from __future__ import annotations

import io
import json
import re
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import IMAGE
from . import lessons

_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>'
_RELS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'
_STAMP = (1980, 1, 1, 0, 0, 0)  # equal documents give equal bytes


def runs(text: object, verbatim: bool = False) -> str:
    """Text as runs; **bold** and *italic* unless the wording is official; an image as its name in brackets."""
    plain = re.sub(IMAGE, r"[\1]", str(text or ""))
    pieces = [plain] if verbatim else re.split(r"(\*\*.+?\*\*|(?<!\*)\*[^*\n]+\*)", plain)
    out = []
    for p in filter(None, pieces):
        bold, italic = p.startswith("**") and not verbatim, p[:1] == "*" != p[1:2] and len(p) > 2 and not verbatim
        mark = "<w:rPr><w:b/></w:rPr>" if bold else "<w:rPr><w:i/></w:rPr>" if italic else ""
        out.append(f'<w:r>{mark}<w:t xml:space="preserve">{escape(p.strip("*") if mark else p)}</w:t></w:r>')
    return "".join(out)


def paragraph(text: object, style: str = "", lead: object = None, verbatim: bool = False) -> str:
    props = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
    head = f'<w:r><w:rPr><w:b/></w:rPr><w:t xml:space="preserve">{escape(str(lead))}: </w:t></w:r>' if lead else ""
    return f"<w:p>{props}{head}{runs(text, verbatim)}</w:p>"


def grid(rows: list[list], head: list) -> str:
    line = lambda cells: "<w:tr>" + "".join(f"<w:tc>{paragraph(c)}</w:tc>" for c in cells) + "</w:tr>"
    body = ([line(head)] if head else []) + [line(r) for r in rows]
    return f'<w:tbl><w:tblPr/><w:tblGrid/>{"".join(body)}</w:tbl>{paragraph("")}' if body else ""


def block(b: dict) -> str:
    """A block as paragraphs and tables; nested blocks follow one another, blanks are lines to write on."""
    kind, label = b.get("type"), b.get("label")
    if kind in ("table", "fill_table"):
        head = [h.get("label", h.get("text", "")) if isinstance(h, dict) else h for h in b.get("headers") or []]
        rows = b.get("rows") if isinstance(b.get("rows"), list) else [[""] * max(1, len(head))] * int(b.get("blank_rows") or b.get("rows") or 3)
        return grid([["" if re.fullmatch(r"\s*_+\s*", str(c)) else c for c in lessons.cells(r)] for r in rows], head)
    if kind == "kompetenzbezug":
        where = lessons.source(b.get("quelle"))
        return paragraph(b.get("kompetenz_id"), lead="Kompetenzbezug") + paragraph(f"„{b.get('text', '')}“", verbatim=True) + (paragraph(where, lead="Quelle") if where else "")
    if kind == "niveau_spalte":
        return "".join(paragraph(n.get("titel"), lead=n.get("label")) + body(n.get("blocks")) for n in b.get("niveaus") or [])
    if kind == "herkunftsblock":
        official = b.get("amtlich") is True
        foot = lessons.source(b.get("quelle")) if official else b.get("quelle_hinweis")
        return paragraph("Amtlicher Text" if official else "Eigenes Material", "Heading3") + body(b.get("blocks")) + (paragraph(foot, lead="Quelle" if official else "Herkunft") if foot else "")
    if kind in ("workspace", "answer_box", "labeled_box", "fill_in"):
        return (paragraph("", lead=label) if label else "") + paragraph("_" * 40) * (1 if kind == "fill_in" else 3)
    if kind == "page_break":
        return '<w:p><w:r><w:br w:type="page"/></w:r></w:p>'
    if kind == "phase_header":
        return paragraph(f"{b.get('name', '')}" + (f" ({b['minutes']} min)" if b.get("minutes") is not None else ""), "Heading2")
    if kind in ("h2", "h3"):
        return paragraph(b.get("text"), "Heading" + kind[1])
    if kind == "cards":
        return "".join(paragraph(c.get("text"), lead=c.get("title")) for c in (x if isinstance(x, dict) else {"title": x} for x in b.get("items") or []))
    if kind == "uebergreifende_themen_tag":
        return paragraph(", ".join(map(str, b.get("themen") or [])), lead=label or "Übergreifende Themen")
    if kind == "number_line":
        marks = [m if isinstance(m, dict) else {"value": m} for m in b.get("marks") or []]
        return paragraph(" – ".join([str(b.get("min", 0)), *[str(m.get("label") or m["value"]) for m in marks], str(b.get("max", 10))]))
    if kind == "source_card":
        return paragraph(b.get("excerpt") or b.get("text"), lead=" · ".join(str(b[k]) for k in ("title", "author", "date", "origin") if b.get(k)))
    text = b.get("text") or b.get("body") or b.get("content")
    out = paragraph(text, lead=label) if text or label else ""
    out += "".join(paragraph(i, "ListNumber" if b.get("ordered") else "ListBullet") for i in b.get("items") or [])
    return out + "".join(body(b.get(f)) for f in ("left", "right", "blocks"))


def body(blocks: list[dict] | None) -> str:
    return "".join(map(block, blocks or []))


def package(doc: dict) -> bytes:
    text = paragraph(doc.get("title"), "Title") + "".join((paragraph(s["heading"], "Heading1") if s.get("heading") else "") + body(s.get("blocks")) for s in doc.get("sections") or [])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in (("[Content_Types].xml", _TYPES), ("_rels/.rels", _RELS), ("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document {_NS}><w:body>{text}</w:body></w:document>')):
            z.writestr(zipfile.ZipInfo(name, _STAMP), data)
    return out.getvalue()


def render(documents: DataFrame, key: str, tree: str) -> DataFrame:
    """(key, document, docx) of each document of each lesson; broken JSON gives none."""

    def walked(batches):
        for batch in batches:
            rows = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    lesson = json.loads(text or "null") or {}
                except ValueError:
                    continue
                for n, which in enumerate(lesson.get("documents") or []):
                    name = re.sub(r"[^A-Za-z0-9_-]+", "-", str(which.get("id") or n)).strip("-")
                    rows.append((k, name, package(lessons.document(lesson, which))))
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary()))], [key, "document", "docx"])

    return documents.select(F.col(key).cast("string").alias(key), tree).mapInArrow(walked, f"{key} string, document string, docx binary")
