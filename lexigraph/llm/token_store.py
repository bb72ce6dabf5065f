"""Token-id output as a content-addressed store.

A store is a folder of three tables:

* parts/kind=chunk     key (16-byte BLAKE2b of the chunk's ids as little-endian uint32), n, data (the ids,
             two bytes each where all fit): every distinct chunk once, whatever number of documents use it
* recipes/             part, block, before, doc_id, n_tokens, chunks (the hashes in order), root (their Merkle
             root), in ascending doc_id order; before counts the ids of the part that come earlier
* manifest/            a row for each block of consecutive documents: part, block, documents, ids, Merkle root

A part is a range of documents that one task wrote; a document starts at the ids of all earlier parts,
one number a part, plus its own before.  A block ends with the Arrow batch in which it reaches 65,536
documents or 4,000,000 ids.

Id streams are cut where a rolling hash of the last eight ids has its low bits clear, so that equal
passages give equal chunks wherever they stand; chunks hold 64 to 1,024 ids (a document's last may
hold fewer).  Reading verifies every chunk against its hash, every recipe against its root and length
and every block against the manifest, and raises on any difference.

A map task sends a chunk once, however many of its documents use it, so that a passage of all documents
makes no hot key where chunks are stored.  Where recipes meet the digests of their chunks, adaptive execution
splits the recipes' side of such a key.

A null or empty text is stored as its end id alone.  Rows that repeat a doc_id are all stored, those
with equal ids next to each other; null ids come first.  An empty table gives an empty store.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, in_parts, lean_worker, shared_dir
from .shingles import mix64, powers
from .tokens import default_vocabulary, encoder

WINDOW, LEAST, MOST, MASK = 8, 64, 1024, 255
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def chunk_ends(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """For each document bounds[i]:bounds[i+1] of a joined id stream, where its chunks end."""
    n = len(ids)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix64(ids.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
    roll = mix64((total[WINDOW:] - total[:-WINDOW]) * powers(_INVERSE, n + 1)[: max(0, n + 1 - WINDOW)]) if n >= WINDOW else np.empty(0, np.uint64)
    cuts = np.flatnonzero((roll & np.uint64(MASK)) == 0) + WINDOW
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        ends, last = [], lo
        a, b = np.searchsorted(cuts, [lo + LEAST, hi])
        for c in cuts[a:b].tolist():
            while c - last > MOST:
                last += MOST
                ends.append(last)
            if c - last >= LEAST:
                ends.append(c)
                last = c
        while hi - last > MOST:
            last += MOST
            ends.append(last)
        if hi > last:
            ends.append(hi)
        out.append(ends)
    return out


def _digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd leaf goes up as it is."""
    level = leaves or [_digest(b"")]
    while len(level) > 1:
        level = [_digest(b"".join(level[i : i + 2])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


_advance: dict[int, np.ndarray] = {}


def _tables(n_bytes: int) -> list[list[int]]:
    """Four tables that advance a CRC-32 register over so many zero bytes."""
    if n_bytes not in _advance:
        zeros = bytes(n_bytes)
        bit = [zlib.crc32(zeros, (1 << i) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(32)]
        tables = []
        for k in range(4):
            one = [0]
            for i in range(8):
                one += [x ^ bit[8 * k + i] for x in one]
            tables.append(one)
        _advance[n_bytes] = tables
    return _advance[n_bytes]


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of a concatenation from (crc, bytes) of its parts."""
    crc = 0
    for one, n in parts:
        a, b, c, d = _tables(n)
        crc = a[crc & 255] ^ b[crc >> 8 & 255] ^ c[crc >> 16 & 255] ^ d[crc >> 24] ^ one
    return crc


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes every whole text and writes the store to a shared folder."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()

    def encoded(batches):
        lean_worker(keep="tokens")
        encode, seen, row = encoder(vocabulary).encode, set(), TaskContext.get().partitionId() << 40
        names = ["kind", "deal", "key", "doc_id", "n", "data", "chunks", "root"]
        with np.errstate(over="ignore"):
            for batch in in_parts(batches):
                keys = batch.column(0).to_pylist()
                found = [np.append(x, np.uint32(end_id)) for x in encode(batch.column(1).to_pylist())]
                bounds = np.cumsum([0] + [len(x) for x in found])
                ids = np.concatenate(found)
                whole, narrow = memoryview(ids.astype("<u4").tobytes()), ids.max() < 65536
                stored, width = (memoryview(ids.astype("<u2").tobytes()), 2) if narrow else (whole, 4)
                new_keys, new_sizes, new_data, uses, roots = [], [], [], [], []
                for lo, ends in zip(bounds[:-1].tolist(), chunk_ends(ids, bounds)):
                    at, hashes = lo, []
                    for end in ends:
                        name = blake2b(whole[4 * at : 4 * end], digest_size=16).digest()
                        hashes.append(name)
                        if name not in seen:
                            seen.add(name)
                            new_keys.append(name), new_sizes.append(end - at), new_data.append(bytes(stored[width * at : width * end]))
                        at = end
                    uses.append(hashes), roots.append(merkle_root(hashes))
                if len(seen) > 250_000:
                    seen = set()
                n, m = len(new_keys), len(keys)
                no, long = [None], pa.int64()
                deal = np.concatenate([np.frombuffer(b"".join(new_keys), "<i8")[::2], np.arange(row, row + m)])
                row += m
                columns = [pa.array(["chunk"] * n + ["recipe"] * m), pa.array(deal), pa.array(new_keys + no * m, pa.binary()), pa.array(no * n + keys, long), pa.array(new_sizes + np.diff(bounds).tolist(), long), pa.array(new_data + no * m, pa.binary()), pa.array(no * n + uses, pa.list_(pa.binary())), pa.array(no * n + roots, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(encoded, "kind string, deal long, key binary, doc_id long, n long, data binary, chunks array<binary>, root binary")
    # one shuffle brings equal chunks to one task, where they are neighbours once sorted; recipes are dealt evenly
    rows = rows.repartition("deal").sortWithinPartitions("key")

    def once(batches):
        lean_worker()
        last = None
        for batch in batches:
            keys = batch.column("key")
            before = pa.concat_arrays([pa.array([last], pa.binary()), keys.slice(0, max(0, len(keys) - 1))])
            yield batch.filter(pc.fill_null(pc.not_equal(keys, before), True))
            last = keys[-1].as_py() if len(keys) else last

    rows.drop("deal").mapInArrow(once, rows.drop("deal").schema).write.partitionBy("kind").parquet(f"{path}/parts")
    raw = spark.read.schema(rows.drop("deal").schema).parquet(f"{path}/parts").where("kind = 'recipe'").select("doc_id", F.col("n").alias("n_tokens"), "chunks", "root")
    _numbered(raw).write.parquet(f"{path}/recipes")
    _manifest(spark.read.parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")


def _numbered(recipes: DataFrame, documents: int = 1 << 16, most_ids: int = 4_000_000) -> DataFrame:
    """Recipes in ascending doc_id order with the part and block they fall in, and the ids before them in the part."""

    def placed(batches):
        lean_worker()
        part, block, rows, ids, before = TaskContext.get().partitionId(), 0, 0, 0, 0
        for batch in batches:
            ends = before + np.cumsum(batch.column("n_tokens").to_numpy())
            n = len(ends)
            if not n:
                continue
            if rows >= documents or ids >= most_ids:
                block, rows, ids = block + 1, 0, 0
            starts = np.concatenate([[before], ends[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part), pa.int32()), pa.array(np.full(n, block), pa.int32()), pa.array(starts, pa.int64()), *batch.columns], ["part", "block", "before", *batch.schema.names])
            rows, ids, before = rows + n, ids + int(ends[-1]) - before, int(ends[-1])

    # the last key parts rows that are equal in the others, so that no range holds all copies of one document
    ordered = recipes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("doc_id", "root", "tie").sortWithinPartitions("doc_id", "root", "tie").drop("tie")
    return ordered.mapInArrow(placed, "part int, block int, before long, doc_id long, n_tokens long, chunks array<binary>, root binary")


def _manifest(recipes: DataFrame) -> DataFrame:
    """Blocks of consecutive documents: documents, ids and Merkle root."""
    rows = recipes.groupBy("part", "block").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("ids"), F.array_sort(F.collect_list(F.struct("before", "root"))).alias("leaves"))

    def rooted(batches):
        lean_worker()
        for batch in batches:
            roots = [merkle_root([x["root"] for x in leaves]) for leaves in batch.column("leaves").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "block", "documents", "ids")), pa.array(roots, pa.binary())], ["part", "block", "documents", "ids", "root"])

    return rows.mapInArrow(rooted, "part int, block int, documents long, ids long, root binary")


def _with_start(spark: SparkSession, path: str, recipes: DataFrame) -> DataFrame:
    """Recipes with start, the ids of all documents before.  The ids of each part go through the driver: a number a
    task that wrote recipes, however many documents there are."""
    sums = spark.read.parquet(f"{path}/manifest").groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()
    starts, running = [], 0
    for r in sums:
        starts.append((r.part, running))
        running += r.ids
    return recipes.join(F.broadcast(spark.createDataFrame(starts, "part int, first long")), "part", "left").withColumn("start", F.col("first") + F.col("before")).drop("part", "block", "before", "first")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("kind string, key binary, n long, data binary").parquet(f"{path}/parts").where("kind = 'chunk'").select("key", "n", "data")


def _ids(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the stored files, all verified."""
    stored, recipes = spark.read.parquet(f"{path}/manifest"), spark.read.parquet(f"{path}/recipes")
    both = _manifest(recipes).withColumnsRenamed({c: f"{c}_found" for c in ("documents", "ids", "root")}).join(stored, ["part", "block"], "full")
    same = F.lit(True)
    for c in ("documents", "ids", "root"):
        same &= F.col(f"{c}_found").eqNullSafe(F.col(c))
    if both.where(~same).limit(1).count():
        raise ValueError("the manifest does not match the recipes")

    def summed(batches):
        lean_worker()
        for batch in batches:
            crc = []
            for key, n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                whole = _ids(data, n).tobytes()
                if _digest(whole) != key:
                    raise ValueError(f"chunk {key.hex()} is damaged")
                crc.append(zlib.crc32(whole))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crc, pa.int64())], ["key", "n", "crc"])

    parts = _chunks(spark, path).mapInArrow(summed, "key binary, n long, crc long")
    uses = _with_start(spark, path, recipes).select("doc_id", "start", "n_tokens", "root", F.posexplode("chunks").alias("pos", "key"))
    each = uses.join(parts, "key", "left").groupBy("doc_id", "start", "n_tokens", "root").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "n", "crc"))).alias("parts"))

    def joined(batches):
        for batch in batches:
            lists = batch.column("parts")
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            _, key, n, crc = (c.to_pylist() for c in lists.flatten().flatten())
            out = []
            for a, b, total, root in zip(at[:-1].tolist(), at[1:].tolist(), batch.column("n_tokens").to_pylist(), batch.column("root").to_pylist()):
                if None in crc[a:b] or sum(n[a:b]) != total or merkle_root(key[a:b]) != root:
                    raise ValueError(f"recipe {root.hex()} does not match its chunks")
                out.append(joined_crc([(c, 4 * k) for c, k in zip(crc[a:b], n[a:b])]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(out, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return each.mapInArrow(joined, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, ids) with the ids themselves, of all documents or of those whose doc_id `only` has."""
    recipes = _with_start(spark, path, spark.read.parquet(f"{path}/recipes"))
    if only is not None:
        recipes = recipes.join(only.select("doc_id").distinct(), "doc_id", "left_semi")
    uses = recipes.select("doc_id", "start", F.posexplode("chunks").alias("pos", "key"))
    each = uses.join(_chunks(spark, path), "key").groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "data"))).alias("parts"))

    def joined(batches):
        for batch in batches:
            ids = [np.concatenate([_ids(p["data"], p["n"]) for p in parts]).astype(np.int64) for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "start", "ids"])

    return each.mapInArrow(joined, "doc_id long, start long, ids array<long>")


def store_and_read(docs: DataFrame, **options) -> DataFrame:
    """Writes a store into a new shared folder and reads its digests back."""
    import uuid

    path = f"{shared_dir(docs.sparkSession)}/lexigraph/tokens-{uuid.uuid4().hex}"
    with bounded_batches(docs.sparkSession):
        write_store(docs, path, **options)
    return read_digests(docs.sparkSession, path)
