"""Importance resampling towards a target: hashed n-gram features, log-ratio gains, Gumbel draws.

Words are runs of digits, ASCII letters and bytes above 0x7F of a whole text, A-Z lower-cased.  Features are all runs of
one to `longest` words, joined by one space, repeats counted; a feature's bucket is its UTF-8 bytes' CRC32 modulo
`buckets`.  The automaton of words.py finds and hashes them on the bytes that Arrow hands over.

With s of S features of all documents and t of T of the target in a bucket, its gain is
floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))); a document's weight is the sum of its features' gains, and its score
adds Gumbel noise that `seed` and doc_id fix, so that the highest scores are a draw without replacement in
proportion to the weights.  Of the documents with at least `least_words` words the best `percent` in a hundred are drawn.

Bucket counts are summed in each task before they are shuffled, and are all that reaches the driver.  Ranks come from
range partitions that are sorted by themselves and from the partitions' counts, so no task sees all rows.

A null text has no words; a document without features has weight 0.  A null doc_id has no score, and is neither counted
among the documents to draw from nor drawn.  Repeated rows keep a row each; rows of one doc_id and score are ranked by
weight and n_features.  Empty tables give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, in_parts, lean_worker, staged
from .words import SPACE, advance, joined, runs

_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_FRESH = 0xFFFFFFFF


def features(texts: list[bytes | None], buckets: int, longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, the number of the text it is from, and how many words each text has."""
    block, bounds = joined(texts)
    starts, ends = runs(_WORD[block])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    words = np.bincount(owner, minlength=len(texts))
    state = advance(np.full(len(starts), _FRESH, np.uint32), block, starts, ends)
    found, owners = [~state], [owner]
    blank, at = np.array([SPACE], dtype=np.uint8), np.arange(len(starts))
    for k in range(1, longest):
        # a run of k + 1 words goes on from its first k with a space and one word more
        at = at[at + k < len(starts)]
        at = at[owner[at + k] == owner[at]]
        zero = np.zeros(len(at), np.int64)
        state[at] = advance(advance(state[at], blank, zero, zero + 1), block, starts[at + k], ends[at + k])
        found.append(~state[at])
        owners.append(owner[at])
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(owners), words


def bucket_counts(texts: DataFrame, text: str, buckets: int, longest: int = 1) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def counted(batches):
        lean_worker()
        total = np.zeros(buckets, dtype=np.int64)
        for batch in in_parts(batches):
            total += np.bincount(features(as_bytes(batch.column(0)), buckets, longest)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    sums = texts.select(text).mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.toLocalIterator():  # a number for each bucket
        out[r.bucket] = r.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio) of each bucket."""
    n = len(own)
    s_all, t_all = float(own.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(own.astype(float), target.astype(float))], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str, text: str, longest: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # a number for each bucket

    def weighed(batches):
        lean_worker()
        gain = shared.value
        for batch in in_parts(batches):
            bucket, owner, words = features(as_bytes(batch.column(1)), len(gain), longest)
            n = np.bincount(owner, minlength=len(batch))
            order = np.argsort(owner, kind="stable")
            sums = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
            total = np.diff(sums[np.concatenate([[0], np.cumsum(n)])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(total, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(weighed, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int):
    """Gumbel noise in thousandths, from the first 32 bits of a digest of seed and doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, *order) -> DataFrame:
    """rows with `rank`, from 1 in the given order, without one task for all: sorted range partitions, numbered each by itself, and
    after the counts of those before."""
    dealt = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranges")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, first = [], 0
    for r in dealt.groupBy(part.alias("part")).count().orderBy("part").collect():  # a number for each partition
        before.append((r.part, first))
        first += r["count"]
    offsets = rows.sparkSession.createDataFrame(before, "part int, before long")
    return dealt.withColumn("part", part.cast("int")).join(F.broadcast(offsets), "part").withColumn("rank", place + F.col("before") + 1).drop("part", "before", "at")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = 10_000, longest: int = 1, least_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it isn't drawn."""
    with bounded_batches(docs.sparkSession):
        gain = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))
        scored = staged(weights(docs, gain, doc_id, text, longest).withColumn("score", F.col("weight") + noise(seed)), "scored")
    may = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    draw = scored.where(may).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    best = ranked(scored.where(may).select(columns), F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.desc("n_features"))
    rank = F.when(F.col("rank") <= draw, F.col("rank"))
    return best.select(*columns, rank.alias("rank")).unionByName(scored.where(~may).select(*columns, F.lit(None).cast("long").alias("rank")))
