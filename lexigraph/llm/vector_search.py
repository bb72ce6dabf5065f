"""Exact top-k inner-product search by tiled matrix products.

Components become floor(scale * x).  All rows are packed into tiles of a few thousand vectors, the
queries into blocks of a few hundred.  Tiles are dealt to slots and blocks to groups, some 64 MB each, and
every slot meets every group once in a task of its own, so a tile travels once for each group of queries and
no row-by-row cross join is made.  A task multiplies block and tile, selects the k best of each query from
the tile, and merges the tiles' lists pairwise as a tree; the lists of all tasks are then merged by query.
Products are exact: float64 where every partial sum fits 53 bits, whole numbers of any size
elsewhere (such scores are clamped to 64 bits in the result, and rank as clamped).

Vectors that are null, or hold a null or non-finite component, and rows whose vec_id is null take no part.  Vectors of different
lengths aren't compared.  Rows that share a query's id count as the query's own.  Ties go to the
smaller vec_id; rows that repeat an id and a vector rank one after another, and a query row that is repeated gives
its result as often.  A query without candidates has no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean_worker, plan_bytes, staged

TILE, BLOCK, CELL = 4096, 512, 64 << 20  # vectors, queries, bytes of either in a task


def _packed(rows: DataFrame, most: int, scale: int) -> DataFrame:
    """Rows (id, v array<double>) of a partition as tiles (nr, dim, ids, data) of at most `most` vectors, ids ascending.
    data holds 32-bit whole numbers where all fit, else the components as they are; nr is a tile's own number."""

    def tiles(batches):
        lean_worker()
        held: dict[int, list] = {}
        nr = TaskContext.get().partitionId() << 32

        def flush(dim: int):
            nonlocal nr
            ids = np.concatenate([i for i, _ in held[dim]])
            data = np.concatenate([d for _, d in held[dim]])
            order = np.argsort(ids, kind="stable")
            held[dim] = []
            for a in range(0, len(ids), most):
                some = order[a : a + most]
                with np.errstate(over="ignore"):
                    whole = np.floor(data[some] * scale)
                narrow = np.abs(whole).max(initial=0) < 1 << 31
                nr += 1
                yield pa.RecordBatch.from_arrays([pa.array([nr], pa.int64()), pa.array([dim], pa.int32()), pa.array([ids[some].tobytes()], pa.binary()), pa.array([(whole.astype("<i4") if narrow else data[some].astype("<f8")).tobytes()], pa.binary())], ["nr", "dim", "ids", "data"])

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            dims = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            ends = np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                which = np.flatnonzero(dims == dim)
                data = flat[(ends[which, None] - dim + np.arange(dim))].reshape(len(which), dim)
                held.setdefault(dim, []).append((ids[which], data))
                if sum(len(i) for i, _ in held[dim]) >= most:
                    yield from flush(dim)
        for dim in list(held):
            if held[dim]:
                yield from flush(dim)

    return rows.mapInArrow(tiles, "nr long, dim int, ids binary, data binary")


def _matrix(ids: bytes, data: bytes, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and whole numbers of a tile: int32, or Python's where some don't fit."""
    ids = np.frombuffer(ids, "<i8")
    if len(data) == 4 * dim * len(ids):
        return ids, np.frombuffer(data, "<i4").reshape(len(ids), dim)
    whole = [int(np.floor(x * scale)) if abs(x) < 1 << 52 else int(x) * scale for x in np.frombuffer(data, "<f8").tolist()]
    out = np.empty(len(whole), dtype=object)
    out[:] = whole
    return ids, out.reshape(len(ids), dim)


def best_of_tile(q_ids, q, t_ids, t, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, vec_id, score) of each query's k best of a tile whose ids ascend."""
    n = len(t_ids)
    plain = q.dtype != object and t.dtype != object
    if plain and float(np.abs(q).max(initial=0)) * float(np.abs(t).max(initial=0)) * max(1, q.shape[1]) * n < 1 << 52:
        # one number orders by score, then by position in the tile, which is by vec_id
        key = (q.astype(np.float64) @ t.astype(np.float64).T) * n + (n - 1 - np.arange(n))
        key[q_ids[:, None] == t_ids[None, :]] = -np.inf
        top = np.argpartition(key, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), key.shape)
        value = np.take_along_axis(key, top, axis=1)
        row, col = np.nonzero(np.isfinite(value))
        at = top[row, col]
        return row, t_ids[at], np.floor_divide(value[row, col], n).astype(np.int64)
    rows, ids, scores = [], [], []
    for i, x in enumerate(q.astype(object)):
        clamped = (max(-(1 << 63), min((1 << 63) - 1, int(np.dot(x, y)))) for y in t.astype(object))
        for s, v in sorted((-s, int(v)) for s, v in zip(clamped, t_ids) if v != q_ids[i])[:k]:
            rows.append(i), ids.append(v), scores.append(-s)
    return np.array(rows, dtype=np.int64), np.array(ids, dtype=np.int64), np.array(scores, dtype=np.int64)


def _merged(rows, ids, scores, k: int):
    """The k best of each query among rows that may hold several lists."""
    order = np.lexsort((ids, ~scores, rows))  # ~ falls as scores rise, without overflow
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - first < k
    return rows[keep], ids[keep], scores[keep]


def merged_tree(lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query of several lists, two lists at a time."""
    while len(lists) > 1:
        lists = [_merged(*map(np.concatenate, zip(*lists[i : i + 2])), k) for i in range(0, len(lists), 2)]
    return lists[0]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row that is_query (a condition on vec_id) selects."""
    sound = F.col(embedding).isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(sound & F.col(vec_id).cast("long").isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), is_query.alias("q"))
    slots = max(24, plan_bytes(vectors) // CELL)
    blocks = staged(_packed(rows.where("q").select("id", "v").repartition(max(1, plan_bytes(vectors) // (256 << 20))), BLOCK, scale), "queries")
    groups = 1 + int((blocks.agg(F.sum(F.length("data"))).first()[0] or 0) // CELL)
    deal = lambda n: F.pmod(F.xxhash64("nr"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tiles = _packed(rows.select("id", "v"), TILE, scale).withColumn("slot", deal(slots)).withColumn("group", every(groups))
    blocks = blocks.withColumn("group", deal(groups)).withColumn("slot", every(slots))
    cell = ["slot", "group", "dim"]

    def searched(key: tuple, some: pa.Table, queries: pa.Table) -> pa.Table:
        lean_worker()
        dim, out = key[2].as_py(), []
        for nr, ids, data in zip(*(queries.column(c).to_pylist() for c in ("nr", "ids", "data"))):
            block = _matrix(ids, data, dim, scale)
            found = [best_of_tile(*block, *_matrix(i, d, dim, scale), k) for i, d in zip(some.column("ids").to_pylist(), some.column("data").to_pylist())]
            if found:
                row, vec_ids, scores = merged_tree(found, k)
                out.append((np.full(len(row), nr), row, block[0][row], vec_ids, scores))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.empty(0, np.int64)] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["block", "pos", "query_id", "vec_id", "score"])

    parts = tiles.groupBy(*cell).cogroup(blocks.groupBy(*cell)).applyInArrow(searched, "block long, pos long, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "pos", "query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
