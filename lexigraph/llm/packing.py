"""Best-fit-decreasing packing of token pieces into sequences of a fixed capacity.

Each document is its token ids and an end id.  Documents longer than the capacity are cut into pieces of
exactly the capacity; what is left over, and every shorter document, is one piece.

Pieces of the same length are interchangeable, so best-fit decreasing over all documents of the
corpus needs only how many pieces there are of each length: at most `capacity` numbers.  Lengths are
placed from the longest down; a segment tree over remaining capacities gives the tightest open bin
that a piece fits in logarithmic time.  Bins with the same remaining capacity and history are kept
as a run with a count, so placing a million equal pieces takes as many steps as placing one.  The
result is the bins that document-by-document best-fit decreasing gives for the whole corpus.

Pieces then find their place by their rank among the pieces of their length.  Ranks are counted
within (length, salt) groups plus group offsets.  A length gets a salt for every `group` pieces that it has,
however many those are, so that one that holds a third of all pieces is not ranked by few tasks; pieces are
dealt to salts by a number that is stored with them, so that copies part too.

A null text is empty: one piece with the end id alone.  Repeated documents are packed as often as they
occur.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, in_parts, lean_worker, staged
from .shingles import mix64
from .tokens import default_vocabulary, encoder


class OpenBins:
    """Segment tree over remaining capacities; a leaf holds the runs of bins with that much room."""

    def __init__(self, capacity: int):
        self.width = 1
        while self.width <= capacity:
            self.width *= 2
        self.filled = [0] * (2 * self.width)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.width)]

    def _mark(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.filled[node] += by
            node //= 2

    def push(self, room: int, first: int, count: int) -> None:
        self.runs[room].append((first, count))
        self._mark(room, 1)

    def pop(self, room: int) -> tuple[int, int]:
        self._mark(room, -1)
        return self.runs[room].pop()

    def tightest(self, need: int) -> int | None:
        """Least room >= need that some open bin has."""
        node = need + self.width
        if self.filled[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.width
            node //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Placements (length, first rank, count, first bin, offset, per bin): pieces of the length with
    ranks from the first on go to consecutive bins, `per bin` of them one after another in each."""
    bins, placed, next_bin = OpenBins(capacity), [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                room, first, count = capacity, next_bin, -(-left // (capacity // length))
                next_bin += count
            else:
                first, count = bins.pop(room)
            # the bin just used is the tightest again while another piece fits
            each = room // length
            whole = min(count, left // each)
            if whole:
                placed.append((length, rank, whole * each, first, capacity - room, each))
                rank, left = rank + whole * each, left - whole * each
                if room % length:
                    bins.push(room % length, first, whole)
            if whole < count:
                if left:
                    placed.append((length, rank, left, first + whole, capacity - room, left))
                    if room - left * length:
                        bins.push(room - left * length, first + whole, 1)
                    whole, left = whole + 1, 0
                if whole < count:
                    bins.push(room, first + whole, count - whole)
    return placed


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, nr) of every piece; nr is a mixed number of its own."""

    def cut(batches):
        lean_worker(keep="tokens")
        # packing comes last, beside whatever else a worker's executor holds: fewer strings are kept, and some learned twice
        encode, at_row = encoder(vocabulary, held=300_000).encode, TaskContext.get().partitionId() << 40
        for batch in in_parts(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            owner, start, length, crc = [], [], [], []
            for i, found in enumerate(encode(texts)):
                data = np.append(found, np.uint32(end_id)).astype("<u4").tobytes()
                for at in range(0, len(data), 4 * capacity):
                    part = data[at : at + 4 * capacity]
                    owner.append(i), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            start = np.array(start, dtype=np.int64)
            nr = mix64(np.arange(at_row, at_row + len(owner), dtype=np.uint64)).view(np.int64)
            at_row += len(owner)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner, pa.int64())), pa.array((start // capacity).astype(np.int32), pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(nr, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "nr"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, nr long")


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", group: int = 500_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    with bounded_batches(spark):
        cut = staged(pieces(docs, vocabulary or default_vocabulary(), capacity, end_id, doc_id, text), "pieces")
    counts = {r.length: r.c for r in cut.groupBy("length").agg(F.count("*").alias("c")).collect()}  # at most `capacity` rows
    salts = {n: -(-c // group) for n, c in counts.items() if c > group}
    salt = F.lit(0)
    for n, k in salts.items():
        salt = F.when(F.col("length") == n, F.pmod("nr", F.lit(k))).otherwise(salt)
    cut = cut.withColumn("salt", salt.cast("long"))
    # a row for each salted group, one for every `group` pieces or so, and one for each other length
    sizes = {(r.length, r.salt): r.c for r in cut.where(F.col("length").isin(list(salts))).groupBy("length", "salt").agg(F.count("*").alias("c")).collect()} if salts else {}
    sizes |= {(n, 0): c for n, c in counts.items() if n not in salts}
    order = sorted(sizes)
    keys = np.array([(n << 32) + s for n, s in order], dtype=np.int64)
    base, last, running = np.zeros(len(order), dtype=np.int64), None, 0
    for i, (n, s) in enumerate(order):
        running = 0 if n != last else running
        base[i], last, running = running, n, running + sizes[n, s]
    runs = np.array(best_fit_decreasing(counts, capacity), dtype=np.int64).reshape(-1, 6)
    within = cut.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "nr")).cast("long") - 1)
    shared = spark.sparkContext.broadcast((keys, base, runs[np.lexsort((runs[:, 1], runs[:, 0]))]))

    def place(batches):
        lean_worker()
        keys, base, runs = shared.value
        span = np.int64(1) << np.int64(48)
        firsts = runs[:, 0] * span + runs[:, 1]
        for batch in batches:
            length, salt, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "salt", "rank"))
            rank = rank + base[np.searchsorted(keys, (length << 32) + salt)]
            run = runs[np.searchsorted(firsts, length * span + rank, side="right") - 1]
            nth = rank - run[:, 1]
            sequence, offset = run[:, 3] + nth // run[:, 5], run[:, 4] + nth % run[:, 5] * length
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return within.drop("nr").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
