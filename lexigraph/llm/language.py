"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A whole text is lower-cased, everything but letters becomes a space, and its two- and three-byte runs
are counted into hashed dimensions.  Counts are dampened, weighted by inverse document frequency and
normalised.  Each language keeps several centroids, found by spherical k-means over its training
vectors, so that kinds of text within a language don't blur into one mean.  The prediction is the
language of the centroid with the largest cosine; `rejected` says that even this one is farther than nearly
all training texts are from theirs.

Training takes at most `sample` documents with letters, the first by a hash of doc_id, then of the text, within each language;
every document is scored.  A null text, or one without letters, is "und" with score 0, and so is
everything where no row can be learned from.  Repeated rows get a row each.  Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_parts, lean_worker

DIMENSIONS = 4096
_ASCII_LETTER = re.compile("[A-Za-z]")
_KEEP = np.full(256, 32, dtype=np.uint32)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def counts(texts: list[str]) -> np.ndarray:
    """Hashed counts of the two- and three-byte runs of lower-cased texts, a row for each."""
    data = [f" {t.lower()} ".encode() for t in texts]
    block = _KEEP[np.frombuffer(b"".join(data), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(data), dtype=np.uint32), [len(d) for d in data]) * np.uint32(DIMENSIONS)
    two = block[:-1] << np.uint32(8) | block[1:]
    out = np.zeros(len(data) * DIMENSIONS)
    for runs in (two, (two[:-1] << np.uint32(8) | block[2:]) + np.uint32(1 << 25)):
        cells = (runs * np.uint32(2654435761)) >> np.uint32(20)
        out += np.bincount(cells + owner[: len(cells)], minlength=len(out))
    return out.reshape(len(data), DIMENSIONS)


def _blocks(texts: list[str], size: int = 1 << 18, rows: int = 64):
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and end - at < rows and (end == at or held + len(texts[end]) <= size):
            held += len(texts[end])
            end += 1
        yield at, end
        at = end


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def cluster(vectors: np.ndarray, k: int, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """Unit centroids of spherical k-means, started at far-apart vectors."""
    rng = np.random.default_rng(seed)
    chosen = [vectors[rng.integers(len(vectors))]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(vectors[np.argmin((vectors @ np.array(chosen).T).max(1))])
    centroids = np.array(chosen)
    for _ in range(rounds):
        near = (vectors @ centroids.T).argmax(1)
        moved = np.array([vectors[near == i].sum(0) if (near == i).any() else centroids[i] for i in range(len(centroids))])
        moved = _normal(moved)
        if np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    return centroids


class Centroids:
    def __init__(self, languages: list[str], rows: np.ndarray, k: int, tail: float):
        seen = (rows > 0).sum(0)
        self.weights = np.log((1 + len(rows)) / (1 + seen)) + 1
        vectors = self.vectors(rows)
        names = np.array(languages)
        self.names = sorted(set(languages))
        self.centroids = [cluster(vectors[names == x], k) for x in self.names]
        own = np.concatenate([(vectors[names == x] @ c.T).max(1) for x, c in zip(self.names, self.centroids)])
        self.least = float(np.quantile(own, tail))

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return _normal(np.log1p(rows) * self.weights)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score and cosine of the nearest centroid."""
        v = self.vectors(rows)
        best = np.stack([(v @ c.T).max(1) for c in self.centroids], axis=1)
        weight = np.exp(25 * (best - best.max(1, keepdims=True)))
        return best.argmax(1), weight.max(1) / weight.sum(1), best.max(1)


def train(docs: DataFrame, trained: Column, sample: int, k: int, tail: float, doc_id: str, text: str, lang: str) -> Centroids | None:
    # a text without letters would be an outlier that centroids start from
    known = docs.where(trained & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.xxhash64(doc_id).alias("h"), text)
    sizes = {r.lang: r.c for r in known.groupBy("lang").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "lang").limit(sample).collect()}
    if not sizes:
        return None
    each = max(1, sample // len(sizes))
    # a share of the hash range that holds about twice as many as wanted, then the first of these
    wide = F.lit(False)
    for name, c in sizes.items():
        wide = wide | ((F.col("lang") == name) & (F.pmod("h", F.lit(1 << 20)) <= min(1.0, (2 * each + 20) / c) * (1 << 20)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", F.xxhash64(text), text))
    taken = known.where(wide).withColumn("r", rank).where(F.col("r") <= each).select("lang", text)

    def counted(batches):
        lean_worker()
        for batch in in_parts(batches):
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _blocks(texts):
                rows = np.minimum(counts(texts[a:b]), 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([pa.array(names[a:b]), pa.array([r.tobytes() for r in rows], pa.binary())], ["lang", "row"])

    got = taken.mapInArrow(counted, "lang string, row binary").orderBy("lang", "row").collect()
    if not got:
        return None
    rows = np.frombuffer(b"".join(r.row for r in got), dtype=np.uint16).reshape(-1, DIMENSIONS).astype(np.float32)
    return Centroids([r.lang for r in got], rows, k, tail)


def identify(docs: DataFrame, held_out: Column, sample: int = 3000, k: int = 4, tail: float = 0.001, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document."""
    model = train(docs, ~F.coalesce(held_out, F.lit(False)), sample, k, tail, doc_id, text, lang)

    def predicted(batches):
        lean_worker()
        for batch in in_parts(batches):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            names, scores, far = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            for a, b in _blocks(texts):
                some = [i for i in range(a, b) if model and has_letter(texts[i])]
                if some:
                    which, score, cosine = model.nearest(counts([texts[i] for i in some]))
                    for i, w in zip(some, which):
                        names[i] = model.names[w]
                    scores[some], far[some] = score, cosine < model.least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores), pa.array(far)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text)
    return rows.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
