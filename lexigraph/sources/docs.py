"""A folder of teachers' files: subject and level by path, ids by file name or front matter."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import front_matter, title, token_estimate
from ..operators.rank import top_k, within_budget

# fixed values: folder names, levels, formats and limits
SUBJECTS = {"mathematik": "M", "deutsch": "D", "englisch": "E", "sachunterricht": "SU", "m": "M", "d": "D", "e": "E", "su": "SU"}
LEVELS = ("K1", "K2", "K3", "K4", "SCH1", "SCH2", "SCH3", "SCH4")
NATIVE, CONVERTED = ("md", "txt"), ("docx", "pdf")
MOST_BYTES, MOST_FILES, MOST_TOKENS = 2 * 1024 * 1024, 20, 4000
SCHEMA = "titel string, pfad string, fach string, stufe string, kompetenz_id string, format string, konvertiert boolean, text string, bytes long, tokens_approx long, status string, grund string"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(content: bytes) -> str | None:
    """Headings as # lines, table rows with their cells joined by ' | '; None if the file can't be read."""
    try:
        body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{_W}body")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    lines = []
    for e in body if body is not None else ():
        if e.tag == f"{_W}p":
            style = e.find(f"{_W}pPr/{_W}pStyle")
            level = re.search(r"(?:Heading|berschrift)\s*(\d)", style.get(f"{_W}val", "")) if style is not None else None
            lines.append("#" * int(level[1]) + " " + text(e) if level else text(e))
        elif e.tag == f"{_W}tbl":
            lines += [" | ".join(text(c) for c in r.iter(f"{_W}tc")) for r in e.iter(f"{_W}tr")]
    return "\n".join(lines)


#: by format, the functions from a file's bytes to its text, in order; the first that gives one counts.  None ships for PDF
EXTRACTORS: dict[str, tuple[Callable[[bytes], str | None], ...]] = {"docx": (docx_text,), "pdf": ()}


def _converted(files: DataFrame, extractors: dict[str, tuple[Callable[[bytes], str | None], ...]]) -> DataFrame:
    """Adds text for formats that need a converter; one that no extractor can read stays null."""

    def convert(batches):
        for batch in batches:
            texts = [next((t for e in extractors.get(f, ()) if (t := e(c)) is not None), None) if c is not None else None for f, c in zip(batch.column("format").to_pylist(), batch.column("content").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("pfad"), pa.array(texts, pa.string())], ["pfad", "converted"])

    return files.select("pfad", "format", "content").mapInArrow(convert, "pfad string, converted string")


STORED = "hash string, format string, tool string, text string"


def _through_store(files: DataFrame, extractors: dict[str, tuple[Callable[[bytes], str | None], ...]], store: str) -> DataFrame:
    """(pfad, converted) by way of a table of conversions, keyed by content, format and the extractors' names: what it has, even if nothing
    could be read, isn't converted again; what it lacks is converted once for all files with the content, and added to it."""
    spark = files.sparkSession
    tools = {f: ",".join(getattr(e, "__qualname__", str(e)) for e in some) for f, some in extractors.items()}
    tool = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in tools.items() for x in kv]), F.col("format")), F.lit("")) if tools else F.lit("")
    keyed = files.select("pfad", "format", tool.alias("tool"), F.sha2("content", 256).alias("hash"), "content")
    place = spark._jvm.org.apache.hadoop.fs.Path(store)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    known = spark.read.schema(STORED).parquet(store) if there else spark.createDataFrame([], STORED)
    key = ["hash", "format", "tool"]
    new = keyed.join(known.select(*key), key, "left_anti").groupBy(*key).agg(F.any_value("content").alias("content"))
    made = _converted(new.select(F.to_json(F.struct(*key)).alias("pfad"), "format", "content"), extractors)
    made.select(F.inline(F.array(F.from_json("pfad", "hash string, format string, tool string"))), F.col("converted").alias("text")).write.mode("append").parquet(store)
    # two writers may both add a conversion: any of them serves
    all_ = spark.read.schema(STORED).parquet(store).groupBy(*key).agg(F.max("text").alias("converted"))
    return keyed.select("pfad", *key).join(all_, key).select("pfad", "converted")


def scan(spark: SparkSession, root: str, cache: DataFrame | None = None, extractors: dict[str, tuple[Callable[[bytes], str | None], ...]] = EXTRACTORS, store: str | None = None) -> DataFrame:
    """Every file of the folder with its text, or why it is skipped.  `cache` has (pfad, cache_mtime, cached) of
    earlier conversions, used where not older than the file, which then isn't converted; `store` names a table of conversions by content, which
    this call reads and adds to."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.rstrip("/").removeprefix("file://") + "/"
    relative = F.regexp_replace(F.col("path"), f"^(?:[a-z]+:)?/*{re.escape(base.lstrip('/'))}", "")
    files = raw.select(relative.alias("pfad"), F.col("length").alias("bytes"), "modificationTime", "content").where(~F.col("pfad").rlike(r"(^|/)\.") & (F.lower("pfad") != "readme.md"))
    files = files.withColumn("format", F.lower(F.regexp_extract("pfad", r"\.([^./]+)$", 1)))
    steps = F.split("pfad", "/")
    folder = F.create_map(*[F.lit(x) for kv in SUBJECTS.items() for x in kv])
    subject = F.when(F.size(steps) > 1, F.try_element_at(folder, F.lower(F.get(steps, F.lit(0)))))
    level = F.when(F.size(steps) > 2, F.upper(F.get(steps, F.lit(1))))
    text = F.when(F.col("format").isin(*NATIVE) & (F.col("bytes") <= MOST_BYTES), F.make_valid_utf8(F.col("content").cast("string")))
    files = files.withColumns({"fach": subject, "stufe": F.when(level.isin(*LEVELS), level), "native": text})
    if cache is not None:
        files = files.join(cache, "pfad", "left").withColumn("__cached", F.when(F.col("cache_mtime") >= F.col("modificationTime"), F.col("cached")))
    else:
        files = files.withColumn("__cached", F.lit(None).cast("string"))
    wanted = files.where(F.col("format").isin(*CONVERTED) & (F.col("bytes") <= MOST_BYTES) & F.col("__cached").isNull())
    made = _through_store(wanted, extractors, store) if store else _converted(wanted, extractors)
    files = files.join(made, "pfad", "left").withColumn("converted", F.coalesce("__cached", "converted"))
    text = F.coalesce("native", "converted")
    suffix = F.nullif(F.regexp_extract("pfad", r"__(AT[.]LP23[.][^/]+)[.][^./]+$", 1), F.lit(""))
    named = F.coalesce(F.try_element_at(front_matter(text), F.lit("kompetenz_id")), suffix)
    bound = F.when(F.coalesce(ids.matches(named, ids.COMPETENCE), F.lit(False)), named)
    reason = (
        F.when(~F.col("format").isin(*NATIVE, *CONVERTED), "format not supported")
        .when(F.col("bytes") > MOST_BYTES, "file too large")
        .when(text.isNull(), "no text could be extracted")
    )
    name = F.regexp_replace(F.element_at(steps, -1), r"(__AT[.]LP23[.].*)?[.][^.]+$", "")
    return files.select(title(text, name).alias("titel"), "pfad", "fach", "stufe", bound.alias("kompetenz_id"), "format", F.col("format").isin(*CONVERTED).alias("konvertiert"), text.alias("text"), F.col("bytes"), token_estimate(F.coalesce(text, F.lit(""))).alias("tokens_approx"), F.when(reason.isNull(), "treffer").otherwise("uebersprungen").alias("status"), reason.alias("grund"))


def relevant(files: DataFrame, subject: str | None, level: str | None, competence: str | None) -> Column:
    own = F.lit(False) if competence is None else F.coalesce(F.col("kompetenz_id") == competence, F.lit(False))
    place = F.col("kompetenz_id").isNull() & (F.lit(True) if subject is None else F.coalesce(F.col("fach") == subject, F.lit(False))) & (F.lit(True) if level is None else F.coalesce((F.col("stufe") == level) | F.col("stufe").isNull(), F.lit(True)))
    return own | place


def collect_material(files: DataFrame, subject: str | None = None, level: str | None = None, competence: str | None = None, most_files: int = MOST_FILES, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """Accepted, skipped and dropped files: hits ranked by id, subject, level and path, cut at the file limit, then
    taken while their tokens fit the budget."""
    good = files.where((F.col("status") == "treffer") & relevant(files, subject, level, competence))
    keys = [F.when(F.col("kompetenz_id").eqNullSafe(F.lit(competence)) & F.col("kompetenz_id").isNotNull(), 0).otherwise(1), F.when(F.col("fach").eqNullSafe(F.lit(subject)), 0).otherwise(1), F.when(F.col("stufe").eqNullSafe(F.lit(level)), 0).otherwise(1), F.col("pfad")]
    first = top_k(good, most_files, *keys)  # files beyond have no rank: nothing is sorted whole
    taken = within_budget(first, F.col("tokens_approx"), most_tokens, "pfad").select("pfad", "rank", "accepted")
    judged = good.join(F.broadcast(taken), "pfad", "left")  # at most `most_files` rows
    reason = F.when(F.col("accepted").isNull(), "file limit").when(~F.col("accepted"), "token budget")
    judged = judged.withColumn("status", F.when(reason.isNull(), "treffer").otherwise("verworfen")).withColumn("grund", reason)
    return judged.drop("accepted").unionByName(files.where("status = 'uebersprungen'").withColumn("rank", F.lit(None).cast("int")))
