"""N-gram Jaccard self-join of texts: a size-aware heavy-light join.

Sets are the distinct five-word shingles of each text (see shingles.py); two texts link when
100 * |A n B| >= 80 * |A u B|.  Texts with equal sets form one class and are joined as one.

* Light sets (at most `boundary` shingles): for every pair of sizes (a, b) that can link, both sides
  enumerate their subsets of exactly the overlap that the pair needs; an equal subset is a link, with
  no further check.
* Heavy sets: inverted lists.  Shingles are put in one global order, rare ones first; a set scans and
  enters only the lists of its first n - ceil(0.8 n) + 1 shingles, as two sets that share none of
  these can't link.  Light sets near the boundary enter too, to meet heavy ones.
* The boundary is the size with the least total of enumerated subsets and scanned list entries over
  the sizes that the data has.

The order needs document frequencies, which are counted over all texts: each map task sends its
shingles as packed 4-byte remainders, one array a bucket of the hash space; reducers count runs and
answer with two filters of fixed size, "seen at least t1 times" and "at least t2 times".  t1 = 2
and t2 = 16 unless the filters would fill up, when both rise.  A set whose prefix has only
shingles seen once has no partner and sends nothing.

Lists of shingles seen fewer than t2 times hold fewer than t2 sets, so their pairs are made directly,
cut by size and by the misses before the last common shingle, and checked against both whole sets.
Sets whose prefix reaches a frequent shingle (large groups of near copies, texts made of common passages) are
gathered into clusters that share a frequent prefix shingle.  In a large cluster every set meets one hub of each near
size first, so that a group of near copies is one component after as many comparisons as it has sets.  Sets are then
dealt into cells of a few hundred sets of like size, and each pair of cells, but for two of the same
component, is checked at once as a product of incidence matrices.  A pair of cells
returns a spanning forest of its links, so no group gives a row for each of its pairs, and no link
between components is lost.  No list, group or candidate is capped.

Null and empty texts have an empty set, link with nothing and are components of their own.  Repeated
rows keep a row each.  Extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, components, in_parts, lean_worker, plan_bytes, remove, staged
from .shingles import mix64, shingle_sets

NUM, DEN = 4, 5  # similarity 0.8 as a fraction
LIGHT_MOST = 14  # sizes that enumeration is considered for
CELL = 256  # sets in a cell of a frequent cluster
HUBS = 4  # rounds of hubs in clusters of more sets


def least_overlap(a: int, b: int) -> int:
    """Smallest intersection with which sets of a and b elements link."""
    return -(-NUM * (a + b) // (NUM + DEN))


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def partner_sizes(n: int, most: int) -> range:
    return range(-(-NUM * n // DEN), min(most, DEN * n // NUM) + 1)


def subset_cost(n: int, most: int) -> int:
    return sum(math.comb(n, least_overlap(n, b)) for b in partner_sizes(n, most) if least_overlap(n, b) <= min(n, b) and not (b == n and least_overlap(n, b) == n))


def choose_boundary(histogram: dict[int, int], list_length: float) -> int:
    """The size up to which enumerating subsets costs least, given how many sets have each small size
    and how long an inverted list is on average."""
    def total(x: int) -> float:
        return sum(c * (subset_cost(n, x) if n <= x else prefix_length(n) * (1 + list_length) + list_length * n) for n, c in histogram.items() if n)

    return min(range(0, LIGHT_MOST + 1), key=total)


def subset_keys(values: np.ndarray, most: int) -> list[int]:
    """A signed 64-bit key for each subset that a light set enumerates; the key holds both sizes, and
    is odd if they are equal."""
    n, out = len(values), []
    for b in partner_sizes(n, most):
        c = least_overlap(n, b)
        if c > min(n, b) or (b == n and c == n):
            continue
        salt = np.uint64(min(n, b) * 1000 + max(n, b))
        for part in itertools.combinations(values, c):
            key = int(mix64(np.array([np.bitwise_xor.reduce(mix64(np.array(part, dtype=np.uint64) + salt)) + salt], dtype=np.uint64)).view(np.int64)[0])
            out.append(key | 1 if b == n else key & ~1)
    return out


def _buckets(df: DataFrame) -> int:
    return 1 << min(20, max(8, math.ceil(math.log2(max(1, plan_bytes(df) / (8 << 20))))))


def _cells(hashes: np.ndarray, log_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = (hashes >> np.uint64(64 - log_buckets)).astype(np.int64)
    return bucket, ((hashes >> np.uint64(32 - log_buckets)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _slot(rest: np.ndarray, bits: int) -> np.ndarray:
    return ((rest.astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)) % np.uint64(bits)


def frequency_filters(docs: DataFrame, text: str, max_bits: int = 1 << 29) -> dict:
    """Two bit filters over shingles by document frequency, and the histogram of small set sizes.

    max_bits bounds what reaches the driver and each Python worker: two filters of max_bits bits."""
    buckets = _buckets(docs)
    log_buckets = buckets.bit_length() - 1

    def packed(batches):
        held, size, sizes = [], 0, np.zeros(LIGHT_MOST + 1, dtype=np.int64)

        def flush():
            values = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            counts = np.diff(np.concatenate([first, [len(values)]])).astype(np.uint32)
            bucket, rest = _cells(values[first], log_buckets)
            edges, rows = np.searchsorted(bucket, np.arange(buckets + 1)), []
            for b in range(buckets):
                some, n = rest[edges[b] : edges[b + 1]], counts[edges[b] : edges[b + 1]]
                if len(some):
                    # a shingle once for each flush, however many texts have it; most need no count
                    rows.append((b, some[n == 1].tobytes(), np.stack([some[n > 1], n[n > 1]]).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]], ["bucket", "packed", "several"])

        lean_worker()
        with np.errstate(over="ignore"):
            for batch in in_parts(batches):
                for values in shingle_sets(as_bytes(batch.column(0))):
                    if len(values) <= LIGHT_MOST:
                        sizes[len(values)] += 1
                    if len(values):
                        held.append(values)
                        size += len(values)
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
            if held:
                yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([sizes.tobytes()], pa.binary()), pa.array([b""], pa.binary())], ["bucket", "packed", "several"])

    def counted(key: tuple, chunk: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(x, dtype=np.uint32) for x in chunk.column("packed").to_pylist()]
        bucket = key[0].as_py()
        if bucket < 0:
            sizes = np.sum([a.view(np.int64) for a in arrays], axis=0)
            return pa.table({"bucket": pa.array([-1], pa.int32()), "rests": [sizes.tobytes()], "powers": [b""], "total": [0], "distinct": [0]})
        several = [np.frombuffer(x, dtype=np.uint32).reshape(2, -1) for x in chunk.column("several").to_pylist()]
        values = np.concatenate([*arrays, *[x[0] for x in several]])
        weights = np.ones(len(values), dtype=np.int64)
        weights[sum(map(len, arrays)) :] = np.concatenate([x[1] for x in several])
        order = np.argsort(values, kind="stable")
        values, weights = values[order], weights[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        counts, total = np.add.reduceat(weights, first), int(weights.sum())
        more = counts > 1
        power = np.floor(np.log2(counts[more])).astype(np.uint8)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "rests": [values[first][more].tobytes()], "powers": [power.tobytes()], "total": [total], "distinct": [len(first)]})

    rows = docs.select(text).mapInArrow(packed, "bucket int, packed binary, several binary")
    rows = staged(rows.groupBy("bucket").applyInArrow(counted, "bucket int, rests binary, powers binary, total long, distinct long"), "frequencies")

    def tallied(batches):
        tally, sums = np.zeros(64, dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for p, t, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tally += np.bincount(np.frombuffer(p, dtype=np.uint8), minlength=64)
                sums += (t, d)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in [*tally, *sums]], [f"c{i}" for i in range(66)])

    tally = rows.select("powers", "total", "distinct").mapInArrow(tallied, ", ".join(f"c{i} long" for i in range(66))).agg(*[F.sum(f"c{i}") for i in range(66)]).first()
    at_least = lambda p: sum(x or 0 for x in tally[p:64])  # noqa: E731  shingles seen at least 2**p times
    low = next(p for p in range(1, 64) if at_least(p) * 8 <= max_bits)
    high = max(low + 1, 4)
    bits = max(64, 1 << max(0, math.ceil(math.log2(max(1, at_least(low) * 8)))))
    bits = min(max_bits, bits) // buckets or 8
    bits = max(8, bits // 8 * 8)

    def filtered(batches):
        for batch in batches:
            out = []
            for b, r, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                slot, power, two = _slot(np.frombuffer(r, dtype=np.uint32), bits), np.frombuffer(p, dtype=np.uint8), []
                for least in (low, high):
                    flags = np.zeros(bits, dtype=bool)
                    flags[slot[power >= least]] = True
                    two.append(np.packbits(flags).tobytes())
                out.append((b, *two))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())], ["bucket", "low", "high"])

    filters = np.zeros((2, buckets, bits // 8), dtype=np.uint8)
    for r in rows.where("bucket >= 0").select("bucket", "rests", "powers").mapInArrow(filtered, "bucket int, low binary, high binary").toLocalIterator():
        filters[0, r.bucket], filters[1, r.bucket] = np.frombuffer(r.low, np.uint8), np.frombuffer(r.high, np.uint8)
    small = rows.where("bucket < 0").select("rests").first()
    remove(rows)
    sizes = np.frombuffer(small.rests, dtype=np.int64) if small else np.zeros(LIGHT_MOST + 1, dtype=np.int64)
    return {"filters": filters.reshape(2, -1), "bits": bits, "log_buckets": log_buckets, "skip": low == 1, "sizes": {i: int(c) for i, c in enumerate(sizes)}, "list_length": (tally[64] or 0) / max(1, tally[65] or 0)}


def _ranks(values: np.ndarray, info: dict, filters: np.ndarray) -> np.ndarray:
    bucket, rest = _cells(values, info["log_buckets"])
    slot = bucket * info["bits"] + _slot(rest, info["bits"]).astype(np.int64)
    byte, bit = slot >> 3, (7 - (slot & 7)).astype(np.uint8)
    return ((filters[0][byte] >> bit) & 1) + ((filters[1][byte] >> bit) & 1)


def signatures(docs: DataFrame, doc_id: str, text: str, info: dict, boundary: int) -> DataFrame:
    """Per document its set's size and fingerprint; where a partner is possible, also the set and its
    light keys, rare and frequent prefix shingles with positions."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(info["filters"])
    plain = {k: info[k] for k in ("log_buckets", "bits", "skip")}

    def signed(batches):
        lean_worker()
        filters = shared.value
        with np.errstate(over="ignore"):
            for batch in in_parts(batches):
                fp, n, data, light, rare, at, hot = [], [], [], [], [], [], []
                for values in shingle_sets(as_bytes(batch.column(1))):
                    n.append(len(values))
                    fp.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                    keys, cold, spots, often = [], [], [], []
                    if 0 < len(values) <= boundary:
                        keys = subset_keys(values, boundary)
                    if len(values) >= NUM * (boundary + 1) / DEN:
                        rank = _ranks(values, plain, filters)
                        p = prefix_length(len(values))
                        order = np.argsort(rank, kind="stable")[:p]
                        rank, first = rank[order], values[order].view(np.int64)
                        keep = rank < 2 if not plain["skip"] else rank == 1
                        spots = np.flatnonzero(keep).tolist()
                        cold, often = first[spots].tolist(), first[rank == 2].tolist()
                    light.append(keys), rare.append(cold), at.append(spots), hot.append(often)
                    data.append(values.tobytes() if keys or cold or often else None)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(data, pa.binary()), pa.array(light, longs), pa.array(rare, longs), pa.array(at, longs), pa.array(hot, longs)], ["doc_id", "n", "fp", "data", "light", "rare", "at", "hot"])

    schema = "doc_id long, n long, fp binary, data binary, light array<long>, rare array<long>, at array<long>, hot array<long>"
    return staged(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(signed, schema), "signatures")


def _light_links(sets: DataFrame) -> DataFrame:
    """Sets with an equal subset of the needed size link: those of the one size with the first of the
    other, or where both sizes are the same, all with the first."""
    keys = sets.where(F.size("light") > 0).select("rep", "n", F.explode("light").alias("key"))
    ends = keys.groupBy("key").agg(F.min(F.struct("n", "rep")).alias("lo"), F.max(F.struct("n", (-F.col("rep")).alias("rep"))).alias("hi"))
    ends = ends.where("lo.n < hi.n or key & 1 = 1")
    other = F.when((F.col("key").bitwiseAND(1) == 0) & (F.col("n") == F.col("lo.n")), -F.col("hi.rep")).otherwise(F.col("lo.rep"))
    return keys.join(ends, "key").select(F.col("rep").alias("u"), other.alias("v")).where("u != v")


def _rare_links(sets: DataFrame, boundary: int) -> DataFrame:
    entries = sets.where(F.size("rare") > 0).select("rep", "n", F.explode(F.arrays_zip("rare", "at")).alias("e")).select("rep", "n", F.col("e.rare").alias("key"), F.col("e.at").alias("at"))
    a, b = entries.select(*[F.col(c).alias(f"{c}_a") for c in entries.columns]), entries.select(*[F.col(c).alias(f"{c}_b") for c in entries.columns])
    need = F.ceil((F.col("n_a") + F.col("n_b")) * NUM / (NUM + DEN))
    pairs = a.join(b, F.col("key_a") == F.col("key_b")).where((F.col("rep_a") < F.col("rep_b")) & (F.least("n_a", "n_b") * DEN >= F.greatest("n_a", "n_b") * NUM) & (F.greatest("n_a", "n_b") > boundary))
    pairs = pairs.groupBy("rep_a", "rep_b", "n_a", "n_b").agg(F.count("*").alias("m"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b"))
    pairs = pairs.where((F.col("at_a") + 1 - F.col("m") <= F.col("n_a") - need) & (F.col("at_b") + 1 - F.col("m") <= F.col("n_b") - need)).select("rep_a", "rep_b")
    data = sets.where(F.size("rare") > 0).select("rep", "data")
    pairs = pairs.join(data.toDF("rep_a", "data_a"), "rep_a").join(data.toDF("rep_b", "data_b"), "rep_b")

    return pairs.select("rep_b", "data_b", "rep_a", "data_a").mapInArrow(_checked, "u long, v long")


def _forest(ids: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets marked left and those marked right."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.concatenate([[0], (flat[1:] != flat[:-1]).astype(np.int64)]))
    often = np.bincount(column)[column] > 1
    owner, column = owner[often], column[often]
    column = np.cumsum(np.concatenate([[0], (column[1:] != column[:-1]).astype(np.int64)])) if len(column) else column
    both = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = 4096
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [c, c + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[lo:hi], column[lo:hi] - c] = 1
        both += part @ part.T
    linked = (DEN * both >= NUM * (sizes[:, None] + sizes[None, :] - both)) & ((left[:, None] & right[None, :]) | (right[:, None] & left[None, :]))
    root = np.arange(len(sets))
    out = []
    for i in range(len(sets)):
        for j in np.flatnonzero(linked[i, :i]):
            if root[i] != root[j]:
                out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
                root[root == root[i]] = root[j]
    return out


def _small(df: DataFrame, most: int = 32 << 20) -> DataFrame:
    """A staged table with a hint to broadcast it if its files are at most so large."""
    return F.broadcast(df) if plan_bytes(df) <= most else df


def _hub_links(member: DataFrame, scratch: list[DataFrame]) -> DataFrame | None:
    """Links of sets to hubs: in clusters of several cells one set of each size class, then, as long as many sets are
    left, one of those that met no hub, and so on.  None if no cluster is so large."""
    place, found = ["cluster", "size_class"], None

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(staged(df, name))
        return scratch[-1]

    large = kept(member.groupBy(*place).count().where(F.col("count") > CELL).select("cluster").distinct(), "large")
    if not large.limit(1).count():
        return None
    rest = member.join(_small(large), "cluster", "left_semi")
    for turn in range(HUBS):
        first = rest.groupBy(*place).agg(F.min(F.struct(F.xxhash64("rep", F.lit(turn)), "rep")).alias("hub"), F.count("*").alias("c"))
        first = kept(first.select(*place, F.col("hub.rep").alias("rep"), "c"), "hubs")
        if not first.where(F.col("c") > CELL).limit(1).count():
            break
        hubs = member.join(_small(first.select("rep")), "rep", "left_semi")
        hubs = kept(hubs.select("cluster", F.explode(F.sequence(F.col("size_class") - 2, F.col("size_class") + 2)).alias("size_class"), F.col("rep").alias("hub"), F.col("data").alias("hub_data")), "hubs")
        pairs = rest.join(_small(hubs), place).where("rep <> hub").select("rep", "data", "hub", "hub_data")
        links = kept(pairs.mapInArrow(_checked, "u long, v long"), "links")
        found = links if found is None else found.unionByName(links)
        met = links.select(F.col("u").alias("rep")).unionByName(first.select("rep")).distinct()
        rest = kept(rest.join(met, "rep", "left_anti"), "frequent")
    return found


def _checked(batches):
    """Of pairs (a, its set, b, its set) those that link."""
    lean_worker()
    for batch in in_parts(batches):
        keep = []
        for x, y in zip(batch.column(1), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(DEN * both >= NUM * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _frequent_links(sets: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(staged(df, name))
        return scratch[-1]

    often = sets.where(F.size("hot") > 0)
    keys = often.select("rep", F.explode("hot").alias("key"))
    stars = keys.groupBy("key").agg(F.min("rep").alias("v"))
    edges = keys.join(stars, "key").where("rep != v").select(F.col("rep").alias("u"), "v").distinct()
    cluster = components(edges, scratch).toDF("rep", "cluster")
    member = often.select("rep", "n", "data").join(cluster, "rep").withColumn("size_class", F.floor(F.log(F.col("n").cast("double")) / math.log(DEN / NUM)).cast("int"))
    member = kept(member, "frequent")
    hub_links = _hub_links(member, scratch)
    member = member.withColumn("root", F.col("rep"))
    if hub_links is not None:
        # sets that hubs have linked need no comparison among themselves
        roots = components(hub_links, scratch).toDF("rep", "hub_root")
        member = kept(member.join(roots, "rep", "left").withColumn("root", F.coalesce("hub_root", "rep")).drop("hub_root"), "frequent")
    place = ["cluster", "size_class"]
    pure = member.groupBy(*place, "root").agg(F.count("*").alias("c")).where(F.col("c") > CELL // 2)
    pure = _small(kept(pure.select(*place, "root", F.lit(True).alias("pure"), F.ceil(F.col("c") / CELL).alias("cells")), "roots"))
    placed = member.join(pure.select(*place, "root", "pure"), [*place, "root"], "left").withColumn("pure", F.coalesce("pure", F.lit(False)))
    mixed = placed.where("not pure").groupBy(*place).agg(F.ceil(F.count("*") / CELL).alias("cells")).select(*place, F.lit(0).cast("long").alias("root"), F.lit(False).alias("pure"), "cells")
    groups = _small(kept(pure.unionByName(mixed), "cells"))
    placed = placed.withColumn("group", F.when(F.col("pure"), F.col("root")).otherwise(0))
    groups = groups.withColumnRenamed("root", "group")
    # sets of a large root are dealt by themselves, small roots each as one, into cells; a set that is one of the
    # many of its cluster meets cells of other roots alone.  One more class than the ratio allows, so that rounding
    # can't part two sets that may link
    near = groups.select("cluster", *[F.col(c).alias(f"near_{c}") for c in ("size_class", "pure", "group", "cells")])
    reach = groups.join(near, "cluster").where("abs(size_class - near_size_class) <= 2 and not (pure and near_pure and group = near_group)")
    reach = _small(kept(reach, "reach"))
    cell = F.pmod(F.when(F.col("pure"), F.xxhash64("rep")).otherwise(F.xxhash64("root")), F.col("cells"))
    dealt = placed.join(reach, [*place, "pure", "group"]).withColumn("cell", cell).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("near_cells") - 1)))
    mine = F.struct("size_class", "pure", "group", "cell")
    theirs = F.struct(F.col("near_size_class").alias("size_class"), F.col("near_pure").alias("pure"), F.col("near_group").alias("group"), F.col("other").alias("cell"))
    dealt = dealt.select("cluster", F.least(mine, theirs).alias("x"), F.greatest(mine, theirs).alias("y"), (mine <= theirs).alias("left"), (mine >= theirs).alias("right"), "rep", "data")
    parts = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("x", "y") for c in ("size_class", "pure", "group", "cell")]

    def linked(part: pa.Table) -> pa.Table:
        lean_worker()
        ids = part.column("rep").to_numpy()
        found = _forest(ids, [np.frombuffer(x, np.uint64) for x in part.column("data").to_pylist()], np.array(part.column("left").to_pylist()), np.array(part.column("right").to_pylist()))
        return pa.table({"u": pa.array([a for a, _ in found], pa.int64()), "v": pa.array([b for _, b in found], pa.int64())})

    dealt = dealt.select("cluster", *parts, "left", "right", "rep", "data")
    links = dealt.groupBy(*dealt.columns[:-4]).applyInArrow(linked, "u long, v long")
    return links if hub_links is None else links.unionByName(hub_links)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = 1 << 29) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; see the module's text."""
    with bounded_batches(docs.sparkSession):
        info = frequency_filters(docs, text, max_bits)
        boundary = choose_boundary(info["sizes"], info["list_length"])
        signed = signatures(docs, doc_id, text, info, boundary)
        classes = signed.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))
        # rows of a class carry the same set: one of them, whichever, joins for all
        sets = signed.where("data is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "data", "light", "rare", "at", "hot")])
        sets = staged(sets.drop("fp"), "sets")
        scratch: list[DataFrame] = []
        links = staged(_light_links(sets).unionByName(_rare_links(sets, boundary)).unionByName(_frequent_links(sets, scratch)), "links")
        remove(*scratch)
        scratch = [sets, links]
        roots = components(links, scratch).toDF("rep", "root")
        classes = staged(classes.join(roots, "rep", "left").select("fp", F.coalesce("root", "rep").alias("component")), "classes")
        remove(*scratch)
    return signed.join(classes, "fp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
