"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a vector of transformed statistics (length, shares of character classes, word
lengths, repetition of words, three-word runs and lines).  Each class has a mean and a covariance, shrunk
towards its diagonal and towards a floor; both come from sums over at most `sample` labelled training rows, the
first by a hash of doc_id, added up where the rows are; texts that none of these name aren't measured for it.  A score is the posterior probability of class 1: half the difference of the
Mahalanobis distances, found with Cholesky factors made once, plus log-determinants and log-priors.

Null and empty texts have the statistics of a text of no words and are scored like others.  A
document without a label takes no part in training; one with several label rows counts once for
each.  With fewer than two training rows of either class, every score is the share of class 1 (0.5
where there is no label).  Repeated rows get a row each.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, in_parts, lean_worker
from .shingles import _MIX, mix64, word_hashes

#: the character classes whose shares are statistics; a byte may be in several
_CLASSES = {
    "upper": bytes(range(65, 91)),
    "letter": bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)),
    "digit": b"0123456789",
    "bang": b"!",
    "stop": b".,;:?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@\\^_`{}~[]",
    "line": b"\n",
    "wide": bytes(range(192, 256)),
}
_LOOKUP = np.zeros((len(_CLASSES), 256), dtype=np.float32)
for _row, _bytes in zip(_LOOKUP, _CLASSES.values()):
    _row[list(_bytes)] = 1
STATISTICS = ("log_words", "word_length", *_CLASSES, "distinct_words", "distinct_runs", "distinct_lines", "short_words", "length_spread")
_SCHEMA = "doc_id long, stats array<double>"


def _of_block(texts: list[bytes]) -> np.ndarray:
    """A row of statistics for each text."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    block = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    starts = np.cumsum(np.concatenate([[0], sizes[:-1] + 1]))
    shares = np.stack([np.add.reduceat(row[block], starts) for row in _LOOKUP], axis=1) / np.maximum(sizes, 1)[:, None]
    hashes, counts = word_hashes(texts)
    runs = hashes.copy()
    if len(runs) > 2:
        runs[:-2] = mix64(hashes[:-2] * _MIX[0] + hashes[1:-1] * _MIX[1] + hashes[2:] * _MIX[2])
    lengths = np.diff(np.flatnonzero(np.concatenate([[True], _is_space(block)])))
    lengths = lengths[lengths > 1] - 1
    lengths = lengths if len(lengths) == len(hashes) else np.full(len(hashes), 1)
    out = np.zeros((n, len(STATISTICS)))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for i in range(n):
        a, b = bounds[i], bounds[i + 1]
        c = b - a
        out[i, 0] = np.log1p(c)
        if not c:
            continue
        w = lengths[a:b]
        lines = [x for x in texts[i].split(b"\n") if x.strip()]
        out[i, 1] = np.log(w.mean())
        tail = out[i, 2 + len(_CLASSES) :]
        tail[0] = len(np.unique(hashes[a:b])) / c
        tail[1] = len(np.unique(runs[a : b - 2])) / (c - 2) if c > 2 else 1
        tail[2] = len(set(lines)) / len(lines) if lines else 1
        tail[3] = (w <= 3).sum() / c
        tail[4] = np.log1p(w.std())
    out[:, 2 : 2 + len(_CLASSES)] = np.log(shares + 1e-3)
    out[:, 2 + len(_CLASSES) : 5 + len(_CLASSES)] = -np.log(1.02 - out[:, 2 + len(_CLASSES) : 5 + len(_CLASSES)])
    return out


def _is_space(block: np.ndarray) -> np.ndarray:
    return (block == 32) | ((block >= 9) & (block <= 13))


def measured(texts: list[bytes | None], block_bytes: int = 1 << 18) -> np.ndarray:
    """A row of statistics for each text, worked out in blocks of bounded size."""
    rows, at = [np.empty((0, len(STATISTICS)))], 0
    with np.errstate(over="ignore"):
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end] or b"") <= block_bytes):
                held += len(texts[end] or b"")
                end += 1
            rows.append(_of_block([t or b"" for t in texts[at:end]]))
            at = end
    return np.concatenate(rows)


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    def listed(batches):
        lean_worker()
        for batch in in_parts(batches):
            flat = measured(as_bytes(batch.column(1))).ravel()
            bounds = np.arange(0, len(flat) + 1, len(STATISTICS), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], ["doc_id", "stats"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(listed, _SCHEMA)


class Discriminant:
    """Class means, Cholesky factors of shrunk covariances, log-determinants and priors."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, shrink: float, floor: float):
        self.share = float((counts[1] + 1e-9) / (counts.sum() + 2e-9))
        self.usable = bool((counts >= 2).all())
        if not self.usable:
            return
        means = sums / counts[:, None]
        pooled = np.maximum(np.diag(sum(squares) / counts.sum() - np.outer(sums.sum(0), sums.sum(0)) / counts.sum() ** 2), 1e-6)
        self.means, self.roots, self.constants = means, [], []
        for c in (0, 1):
            cov = squares[c] / counts[c] - np.outer(means[c], means[c])
            cov = (1 - shrink) * cov + shrink * np.diag(np.diag(cov)) + floor * np.diag(pooled)
            root = np.linalg.cholesky(cov)
            self.roots.append(np.linalg.inv(root))
            self.constants.append(float(np.log(counts[c] / counts.sum()) - np.log(np.diag(root)).sum()))

    def posterior(self, x: np.ndarray) -> np.ndarray:
        if not self.usable:
            return np.full(len(x), self.share)
        logs = [c - 0.5 * (((x - m) @ r.T) ** 2).sum(1) for m, r, c in zip(self.means, self.roots, self.constants)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(labelled: DataFrame, shrink: float = 0.1, floor: float = 0.02) -> Discriminant:
    """From rows (stats or text, label); only class sums, merged where they are, reach the driver."""
    d = len(STATISTICS)

    def summed(batches):
        lean_worker()
        counts, sums, squares = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in in_parts(batches):
            given = batch.column(0)
            x = np.array(given.flatten()).reshape(-1, d) if pa.types.is_list(given.type) else measured(as_bytes(given))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                part = x[y == c]
                counts[c] += len(part)
                sums[c] += part.sum(0)
                squares[c] += part.T @ part
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([counts, sums.ravel(), squares.ravel()]).tobytes()], pa.binary())], ["sums"])

    def merged(batches):
        total = np.zeros(2 + 2 * d + 2 * d * d)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                total += np.frombuffer(b)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = labelled.mapInArrow(summed, "sums binary").repartition(8).mapInArrow(merged, "sums binary").collect()
    total = sum((np.frombuffer(r.sums) for r in parts), np.zeros(2 + 2 * d + 2 * d * d))
    return Discriminant(total[:2], total[2 : 2 + 2 * d].reshape(2, d), total[2 + 2 * d :].reshape(2, d, d), shrink, floor)


def known(labels: DataFrame, held_out: Column, sample: int, doc_id: str, label: str) -> DataFrame:
    """(doc_id, label) of at most `sample` label rows that may be learned from, the first by a hash of doc_id."""
    marks = labels.select(F.col(doc_id).cast("long").alias(doc_id), F.col(label).cast("int").alias("label")).where("label in (0, 1)").where(~F.coalesce(held_out, F.lit(False)))
    return F.broadcast(marks.orderBy(F.xxhash64(doc_id), doc_id, "label").limit(sample))  # 20,000 rows of two numbers


def score(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 20_000) -> DataFrame:
    """(doc_id, held_out, score, predicted); held_out is a condition on doc_id whose rows aren't trained on."""
    own = docs.select(F.col(doc_id).cast("long").alias(doc_id), text)
    with bounded_batches(docs.sparkSession):
        model = fit(own.join(known(labels, held_out, sample, doc_id, label), doc_id).select(text, "label"))

    def scored(batches):
        lean_worker()
        for batch in in_parts(batches):
            p = model.posterior(measured(as_bytes(batch.column(2))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return own.select(doc_id, F.coalesce(held_out, F.lit(False)).alias("held_out"), text).mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 20_000) -> DataFrame:
    """The rows of docs, with all their columns, whose score is at least the threshold; rows don't move."""
    own = docs.select(F.col(doc_id).cast("long").alias(doc_id), text)
    with bounded_batches(docs.sparkSession):
        model = fit(own.join(known(labels, held_out, sample, doc_id, label), doc_id).select(text, "label"))

    def kept(batches):
        lean_worker()
        for batch in in_parts(batches):
            yield batch.filter(pa.array(model.posterior(measured(as_bytes(batch.column(text)))) >= threshold))

    return docs.mapInArrow(kept, docs.schema)
