"""Source manifests, search responses, image files and rubric tables."""

from __future__ import annotations

import urllib.parse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "map<string, struct<nor: string, eli: string, gesetzesnummer: string, kurztitel: string, kundmachungsorgan: string, artikel_paragraph_anlage: string, inkrafttretensdatum: string, ausserkrafttretensdatum: string, dokument_url: string, disambiguated: boolean, fallback_used: boolean, retrieval_date: string, files: map<string, struct<sha256: string, size: long>>, images: map<string, struct<nor: string, src: string, url: string, sha256: string, size: long>>>>"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(document, field columns…, pdf_sha256, xml_sha256) of a manifest file, which must be a JSON object."""
    raw = spark.read.text(path, wholetext=True)
    checked = raw.select(F.when(F.ltrim("value").startswith("{"), F.from_json("value", MANIFEST)).otherwise(F.raise_error(F.lit("a manifest must be a JSON object")).cast(MANIFEST)).alias("m"))
    rows = checked.select(F.explode("m").alias("document", "r")).select("document", "r.*")
    return rows.select("*", F.col("files")["pdf"]["sha256"].alias("pdf_sha256"), F.col("files")["xml"]["sha256"].alias("xml_sha256")).drop("files", "images")


def manifest_json(rows: DataFrame, key: str) -> DataFrame:
    """One row with the manifest as JSON, documents in order of their keys."""
    fields = [c for c in sorted(rows.columns) if c != key]
    entry = F.struct(F.col(key).alias("key"), F.struct(*fields).alias("value"))
    by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)  # noqa: E731  values may hold maps
    return rows.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry), by_key))).alias("value"))


def path_value(document: Column, path: str) -> Column:
    """A dotted path of a JSON text, or null."""
    return F.try_variant_get(F.try_parse_json(document), "$." + path, "string")


def as_list(document: Column, path: str) -> Column:
    """Array of JSON texts at a path that may hold one object, a list or nothing."""
    value = F.get_json_object(document, "$." + path)
    return F.when(value.isNull(), F.array().cast("array<string>")).when(F.ltrim(value).startswith("["), F.transform(F.from_json(value, "array<variant>"), lambda v: F.to_json(v))).otherwise(F.array(value))


def all_pages(fetch: Callable[[int], list[dict]], key: str, most_pages: int = 1000) -> list[dict]:
    """Hits of a paged source until an empty page, each key once, the first kept."""
    seen: dict[object, dict] = {}
    for page in range(1, most_pages + 1):
        hits = fetch(page)
        if not hits:
            break
        for hit in hits:
            seen.setdefault(hit.get(key), hit)
    return list(seen.values())


def in_force(rows: DataFrame, group: list[str], part: str = "Anl. 1") -> DataFrame:
    """The entry of a part that is in force: no end date; of several the newest, flagged as disambiguated."""
    live = rows.where((F.col("artikel_paragraph_anlage") == part) & (F.coalesce(F.trim("ausserkrafttretensdatum"), F.lit("")) == ""))
    order = Window.partitionBy(*group).orderBy(F.desc("inkrafttretensdatum"), "nor")
    several = F.count("*").over(Window.partitionBy(*group)) > 1
    return live.withColumns({"__n": F.row_number().over(order), "disambiguated": several}).where("__n = 1").drop("__n")


def main_document(contents: Column) -> Column:
    """The entry of kind MainDocument of an array, or its first."""
    return F.coalesce(F.get(F.filter(contents, lambda c: c["content_type"] == "MainDocument"), F.lit(0)), F.get(contents, F.lit(0)))


def images(spark: SparkSession, path: str) -> DataFrame:
    """(datei, width, height, sha256, bytes) of PNG files, sizes from the header; others have null sizes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").load(path)
    is_png = F.hex(F.substring("content", 1, 8)) == "89504E470D0A1A0A"
    number = lambda at: F.when(is_png, F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int"))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("datei"), number(17).alias("width"), number(21).alias("height"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def merged_registry(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Registry rows, the new value of each field where there is one."""
    a, b = old.select(key, F.struct(*[c for c in old.columns if c != key]).alias("o")), new.select(key, F.struct(*[c for c in new.columns if c != key]).alias("n"))
    return a.join(b, key, "full_outer").select(key, *[F.coalesce(F.col("n")[c], F.col("o")[c]).alias(c) for c in old.columns if c != key])


def rubric(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', recursiveFileLookup=True)


def write_parts(rows: DataFrame, path: str) -> None:
    """Normalised rows as Parquet, a folder for each band and subject."""
    rows.withColumns({"band": F.get(F.split("shard", "[.]"), F.lit(0)), "fach": F.get(F.split("shard", "[.]"), F.lit(1))}).write.mode("overwrite").partitionBy("band", "fach").parquet(path)


def write_parts_json(rows: DataFrame, path: str) -> None:
    """One JSON document a line and part, without null fields."""
    rows.select("shard", F.to_json(F.struct(*[c for c in rows.columns if c != "shard"]), {"ignoreNullFields": "true"}).alias("value")).write.mode("overwrite").partitionBy("shard").text(path)


def write_documents(rows: DataFrame, folder: str) -> None:
    """Rows (file, value) as files of these relative names, each with the text and a line's end.

    Tasks write the texts; the driver only renames files, and its work is a call for each of them."""
    spark = rows.sparkSession
    base = f"{folder}/.writing"
    coded = rows.select(F.replace("file", F.lit("/"), F.lit("|")).alias("file"), "value")
    coded.repartition("file").write.partitionBy("file").text(base)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for place in fs.listStatus(path(base)):
        name = place.getPath().getName()
        if not name.startswith("file="):
            continue
        target = path(f"{folder}/" + urllib.parse.unquote(name.removeprefix("file=")).replace("|", "/"))
        fs.mkdirs(target.getParent())
        written = [f.getPath() for f in fs.listStatus(place.getPath()) if f.getPath().getName().startswith("part-")]
        if len(written) != 1 or not fs.rename(written[0], target):
            raise OSError(f"{target} was not written once")
    fs.delete(path(base), True)


def write_binary(spark: SparkSession, files: dict[str, bytes], folder: str) -> None:
    """A few small files from the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, content in files.items():
        out = fs.create(path(f"{folder}/{name}"), True)
        out.write(bytearray(content))
        out.close()


def install_images(spark: SparkSession, source: str, target: str, wanted: DataFrame) -> DataFrame:
    """Copies the named images (datei) to the target folder and reads them again: (datei, sha256, copied), copied only
    where the bytes that arrived have the hash of those that were read."""
    found = images(spark, source).join(wanted.select("datei").distinct(), "datei", "left_semi").select("datei", "sha256")
    folder, settings = target, spark._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    for r in found.select("datei").toLocalIterator():  # a copy by the file system for each image, none by its bytes
        a, b = path(f"{source}/{r.datei}"), path(f"{folder}/{r.datei}")
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(settings), a, b.getFileSystem(settings), b, False, True, settings)
    arrived = images(spark, target).select("datei", F.col("sha256").alias("arrived"))
    return found.join(arrived, "datei", "left").select("datei", "sha256", F.coalesce(F.col("sha256") == F.col("arrived"), F.lit(False)).alias("copied"))


def append_deviations(rows: DataFrame, path: str) -> None:
    """Adds (document, rule, message) rows to a log that only grows."""
    rows.select("document", "rule", "message").write.mode("append").json(path)


def search_url(base: str, law: Column, as_of: Column, page: Column) -> Column:
    """The address of a page of search hits; names of the parameters are the service's."""
    given = {"Applikation": F.lit("BrKons"), "Gesetzesnummer": law, "Fassung.FassungVom": as_of, "Seitennummer": page.cast("string")}
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *[F.concat(F.lit(k + "="), F.url_encode(v)) for k, v in given.items()]))


def provenance(rows: DataFrame, part: Column) -> DataFrame:
    """Manifest rows with provenienz: where a text comes from, all of it from the manifest but the heading of the part."""
    source = F.struct(F.lit("RIS Bundesrecht konsolidiert").alias("quelle"), "kurztitel", "nor", F.trim("kundmachungsorgan").alias("kundmachung"), F.col("artikel_paragraph_anlage").alias("anlage"), F.coalesce(part, F.lit("")).alias("teil"), F.col("retrieval_date").alias("stand"))
    return rows.withColumn("provenienz", F.when(F.col("nor").isNull(), F.raise_error(F.lit("no manifest entry")).cast(source_type(source, rows))).otherwise(source))


def source_type(column: Column, rows: DataFrame) -> str:
    return rows.select(column.alias("x")).schema["x"].dataType.simpleString()


def combined(parts: DataFrame, key: str, *content: str) -> DataFrame:
    """Parts recombined: equal blocks of several parts once; a key with different contents is an error."""
    rows = parts.groupBy(key).agg(F.count_distinct(F.xxhash64(*content)).alias("__n"), *[F.first(c).alias(c) for c in content])
    return rows.withColumn(key, F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("conflicting contents for "), F.col(key).cast("string"))).cast("string")).otherwise(F.col(key))).drop("__n")
