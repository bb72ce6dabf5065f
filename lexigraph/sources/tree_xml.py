"""Mixed-content XML as ordered rows; element order is data, so documents are walked, not mapped to columns."""

from __future__ import annotations

from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "doc string, idx int, pos int, element string, typ string, text string, roh string, supers array<string>, images array<string>"
_BULLETS = set("•–-·▪*")


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def extract(element: ElementTree.Element, drop_bullets: bool = True) -> tuple[str, str, list[str], list[str]]:
    """(text, raw text, superscript markers, image names).  Superscripts are markers, not text; an image stands as
    a token; a dash element is a hyphen; a symbol is dropped if it is a bullet and kept if it is a word."""
    clean, raw, supers, images = [], [], [], []
    todo: list = [element]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            clean.append(node), raw.append(node)
            continue
        name, tail = local(node.tag), node.tail if node is not element else None
        if tail:
            todo.append(tail)
        if name == "super":
            mark = "".join(node.itertext())
            supers.append(mark.strip()), raw.append(mark)
        elif name == "src":
            image = (node.text or "").strip().rsplit("/", 1)[-1]
            images.append(image), clean.append(f"⟦ABB:{image}⟧"), raw.append(f"⟦ABB:{image}⟧")
        elif name == "gdash":
            clean.append("-"), raw.append("-")
        elif name == "symbol" and drop_bullets and "".join(node.itertext()).strip() in _BULLETS:
            raw.append("".join(node.itertext()))
        else:
            todo.extend(reversed(list(node)))
            if node.text:
                todo.append(node.text)
    squeeze = lambda parts: " ".join("".join(parts).split())
    return squeeze(clean), squeeze(raw), supers, images


def section(root: ElementTree.Element) -> ElementTree.Element | None:
    data = next((e for e in root.iter() if local(e.tag) == "nutzdaten"), None)
    return None if data is None else next((e for e in data.iter() if local(e.tag) == "abschnitt"), None)


def events_of(doc: str, content: bytes, drop_bullets: bool = True) -> list[tuple]:
    """The flat children of a document's section: an event each, list elements and table cells one by one."""
    try:
        top = section(ElementTree.fromstring(content))
    except ElementTree.ParseError as wrong:
        raise ValueError(f"{doc}: {wrong}") from wrong
    if top is None:
        raise ValueError(f"{doc}: no section")
    rows = []
    for idx, child in enumerate(top):
        name = local(child.tag)
        inner = [e for e in child.iter() if local(e.tag) in ("listelem", "td")] if name in ("liste", "aufzaehlung", "table") else [child]
        for pos, e in enumerate(inner):
            text, raw, supers, images = extract(e, drop_bullets)
            rows.append((doc, idx, pos, local(e.tag), e.get("typ") or child.get("typ"), text, raw, supers, images))
    return rows


def xml_events(spark: SparkSession, path: str, drop_bullets: bool = True) -> DataFrame:
    """EVENT rows of all XML files under a path; parallel over documents, in order within each."""

    def walked(batches):
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()))
        names = [c.split()[0] for c in EVENT.split(", ")]
        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                columns = list(zip(*events_of(doc, content, drop_bullets))) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("doc"), "content").mapInArrow(walked, EVENT)


def source_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(doc, pos, text): text blocks for fidelity checks, by a flattener of its own that shares nothing with extract."""

    def flattened(batches):
        for batch in batches:
            rows = []
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pos = 0
                for e in ElementTree.fromstring(content).iter():
                    if e.tag.split("}")[-1] in ("ueberschrift", "absatz", "listelem", "td"):
                        parts = [e.text or ""]
                        for c in e:
                            kind = c.tag.split("}")[-1]
                            if kind == "gdash":
                                parts.append("-")
                            elif kind not in ("super", "binary", "liste", "aufzaehlung", "table"):
                                parts.append("".join(c.itertext()))
                            parts.append(c.tail or "")
                        rows.append((doc, pos, " ".join("".join(parts).split())))
                        pos += 1
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.string()))], ["doc", "pos", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("doc"), "content").mapInArrow(flattened, "doc string, pos int, text string")


def header_values(events: DataFrame) -> DataFrame:
    """(doc, label, value): headings of kind 'erll' with the paragraph that follows each."""
    from pyspark.sql import Window

    after = F.lead("text").over(Window.partitionBy("doc").orderBy("idx", "pos"))
    kind = F.lead("element").over(Window.partitionBy("doc").orderBy("idx", "pos"))
    rows = events.select("doc", "element", "typ", F.col("text").alias("label"), after.alias("value"), kind.alias("next"))
    return rows.where("element = 'ueberschrift' and typ = 'erll' and next = 'absatz'").select("doc", "label", "value")


def image_references(events: DataFrame) -> DataFrame:
    """(doc, datei, pos): the images of each document, each once, in the order of first use."""
    from pyspark.sql import Window

    each = events.select("doc", "idx", F.col("pos").alias("at"), F.posexplode("images").alias("n", "datei"))
    first = each.groupBy("doc", "datei").agg(F.min(F.struct("idx", "at", "n")).alias("first"))
    return first.select("doc", "datei", F.row_number().over(Window.partitionBy("doc").orderBy("first")).alias("pos"))
