"""Toxicity: a learned lexicon met through Levenshtein automata, with context-window scores.

Lexicon.  Terms are whole words and word beginnings that occur in toxic training documents far more
than in others.  They are kept in a trie.

Matching.  A word meets a term by running the word's Levenshtein automaton along the trie: a state is
the row of edit distances between the word and the path so far, and a branch whose row exceeds the
largest budget is left.  Terms of five letters or more allow one edit, of nine or more two, word
beginnings one letter later; after a beginning the word may go on.  Each distinct word is run once in a
worker.  A word that has none of a term's budget-plus-one pieces within the budget of the piece's place can't
be that near, and isn't run.

Context.  A hit counts less inside quotation marks or after a word of reporting, and more the more other
hits stand within eight words.  Sums and the highest window of a document's exact, misspelled and
quoted hits, and their density, go through a logistic model.

The lexicon and the model are fitted on at most `sample` labelled documents, the first by a hash of doc_id, of
which those with the same label that are copies or share long passages (they have one of eight minima of hashes of
their shingles in common) count as one;
a document whose labels differ is none of them, and of several texts under one doc_id the first by hash counts.  So
rows that repeat change nothing that is learned.  Every whole text is scored.  Null and empty texts have no hits and get the model's base score.  With
no toxic or no other training row, every score is the share of toxic rows (0 with no rows).
Repeated rows get a row each.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, in_parts, lean_worker, remove, staged
from .shingles import mix64, shingle_sets

_WORD = re.compile(r"\w+(?:[*@$]+\w+)*")
_MARK = re.compile(r"\w+(?:[*@$]+\w+)*|[\"“”„«»]")
_REPORTS = frozenset("said says wrote called quoted quote term word".split())
WINDOW = 8
_FEATURES = 6


def budget(term: str) -> int:
    n = len(term) - 2 * term.endswith("*")
    return 0 if n < 5 else 1 if n < 9 else 2


class Lexicon:
    """Terms with weights in a trie.  A term that ends in * is a word beginning."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.root: dict = {}
        self.most = max(map(budget, weights), default=0)
        pieces: dict[tuple[int, int], set[str]] = {}
        for term in weights:
            plain, k = term.rstrip("*"), budget(term)
            node = self.root
            for c in plain:
                node = node.setdefault(c, {})
            node.setdefault(None, []).append(term)
            cuts = [len(plain) * i // (k + 1) for i in range(k + 2)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                for at in range(max(0, a - k), a + k + 1) if i else [0]:
                    pieces.setdefault((at, at + b - a), set()).add(plain[a:b])
                    if not i and k:  # an edit before the first piece moves it too
                        for moved in range(1, k + 1):
                            pieces.setdefault((moved, moved + b - a), set()).add(plain[a:b])
        self.pieces = [(a, b, some) for (a, b), some in sorted(pieces.items())]

    def near(self, word: str) -> bool:
        """Whether the word has a piece of some term about its place, as any word within the term's budget must."""
        return any(word[a:b] in some for a, b, some in self.pieces)

    def match(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the best term the word meets: fewest edits, then largest weight."""
        best: tuple[int, float] | None = None
        stack = [(self.root, list(range(len(word) + 1)), 0)]
        while stack:
            node, row, depth = stack.pop()
            for term in node.get(None, ()):
                k = budget(term)
                edits = min(row) if term[-1] == "*" else row[-1]
                if edits <= k and (best is None or (edits, -self.weights[term]) < best):
                    best = (edits, -self.weights[term])
            for c, child in node.items():
                if c is None:
                    continue
                step = [depth + 1]
                for j, w in enumerate(word):
                    step.append(min(row[j] + (w != c), row[j + 1] + 1, step[j] + 1))
                if min(step) <= self.most:
                    stack.append((child, step, depth + 1))
        return (-best[1], best[0]) if best else None


class Matcher:
    """A worker's memory of the words it has run."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.clean, self.hits = lexicon, set(), {}

    def features(self, text: str) -> np.ndarray:
        out = np.zeros(_FEATURES)
        low = text.lower()
        words = set(_WORD.findall(low))
        for w in words - self.clean - self.hits.keys():
            found = self.lexicon.match(w) if self.lexicon.near(w) else None
            if found:
                self.hits[w] = found
            else:
                self.clean.add(w)
        if len(self.clean) > 300_000:
            self.clean = set()
        if words.isdisjoint(self.hits.keys()):
            return out
        at, quoted, spots, lately = 0, False, [], -99
        for token in _MARK.findall(low):
            if token in '"“”„«»':
                quoted = token in "“„«" or (token == '"' and not quoted)
                continue
            if token in _REPORTS:
                lately = at
            if token in self.hits:
                weight, edits = self.hits[token]
                spots.append((at, weight, edits, quoted or at - lately <= 3))
            at += 1
        sums, top = np.zeros(3), 0.0
        for i, (p, weight, edits, mention) in enumerate(spots):
            around = sum(1 for q in spots[max(0, i - 5) : i + 6] if abs(q[0] - p) <= WINDOW) - 1
            sums[2 if mention else 1 if edits else 0] += weight
            top = max(top, weight * (0.3 if mention else 0.7 if edits else 1.0) * (1 + 0.2 * around))
        out[:3] = np.log1p(sums)
        out[3], out[4], out[5] = top, math.log1p(100 * len(spots) / max(at, 1)), math.log1p(len(spots))
        return out


def _terms(text: str) -> set[str]:
    words = {w for w in _WORD.findall(text.lower()) if 3 < len(w) <= 40}
    return words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n}


def without_copies(sample: DataFrame, text: str) -> DataFrame:
    """Of sample rows (row, text, label; row is a key), in order of row, those that share none of eight minima of hashes of
    their shingles with an earlier one of the same label that stays.  So copies go, and so do texts that share long
    passages: a passage's words would else count as often as it was copied."""
    seeds = mix64(np.arange(1, 9, dtype=np.uint64))

    def sketched(batches):
        lean_worker()
        with np.errstate(over="ignore"):
            for batch in in_parts(batches):
                found = [mix64(v[None, :] ^ seeds[:, None]).min(1).view(np.int64).tolist() if len(v) else [] for v in shingle_sets(as_bytes(batch.column(1)))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int64()))], ["row", "label", "minima"])

    rows = sample.select("row", text, "label").mapInArrow(sketched, "row long, label int, minima array<long>").orderBy("row").collect()  # bounded by the sample
    seen: set[tuple[int, int, int]] = set()
    drop = []
    for row, label, minima in rows:
        own = {(label, i, m) for i, m in enumerate(minima)}
        if own & seen:
            drop.append(row)
        else:
            seen |= own
    gone = sample.sparkSession.createDataFrame([(x,) for x in drop], "row long")
    return sample.join(F.broadcast(gone), "row", "left_anti")


def learn_lexicon(sample: DataFrame, text: str, toxic: int, other: int, most_terms: int) -> Lexicon:
    """Terms that toxic training documents have ten times as often as others, beyond chance."""

    def counted(batches):
        lean_worker()
        tally: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in in_parts(batches):
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tally[y].update(_terms(t or ""))
        # every count is sent, as another task may hold the toxic documents of a term that has none here
        rows = [(k, tally[1][k], tally[0][k]) for k in tally[0].keys() | tally[1].keys()]
        for i in range(0, len(rows), 10_000):
            part = rows[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([r[1] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int64())], ["term", "toxic", "other"])

    share = toxic / (toxic + other)
    t, o = F.col("t"), F.col("o")
    odds = F.log((t + 0.5) / (toxic + 1)) - F.log((o + 0.5) / (other + 1))
    # how unlikely so many toxic documents would be by chance, as n * divergence of the shares; of a million candidates about
    # ten may pass by chance, with so few documents that they seldom occur again
    chance = t * F.log(t / (t + o) / share) + F.when(o > 0, o * F.log(o / (t + o) / (1 - share))).otherwise(0.0)
    rows = sample.select(text, "label").mapInArrow(counted, "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").cast("double").alias("t"), F.sum("other").cast("double").alias("o"))
    rows = rows.where(t >= 3).withColumn("odds", odds).where((F.col("odds") > math.log(10)) & (chance > math.log(1e5)))
    found = {r.term: (r.odds, r.t) for r in rows.orderBy(F.desc(t), "term").limit(most_terms).collect()}
    keep: dict[str, float] = {}
    for term in sorted(found, key=lambda x: (-len(x.rstrip("*")), x)):
        weight, cases = found[term]
        plain = term.rstrip("*")
        # the longest beginning that keeps nearly all cases stands for its words; a single word for itself
        shorter = [plain[:n] + "*" for n in range(4, len(plain) + 1) if plain[:n] + "*" != term and plain[:n] + "*" in found]
        longer = [w for w in found if w != term and w.startswith(plain) and found[w][1] >= 0.9 * cases]
        if longer and term.endswith("*") or any(found[x][1] > cases / 0.9 for x in shorter):
            continue
        keep[term] = float(min(weight, 5.0))
    return Lexicon(keep)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Coefficients, the intercept last, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def score(docs: DataFrame, labels: DataFrame, held_out: Column, sample: int = 12_000, most_terms: int = 4000, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted, hits) of every document; held_out is a condition on doc_id."""
    docs = docs.select(F.col(doc_id).cast("long").alias(doc_id), text).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    marks = labels.select(F.col(doc_id).cast("long").alias(doc_id), F.col(label).cast("int").alias("label")).where("label in (0, 1)").where(~F.coalesce(held_out, F.lit(False)))
    # one row for each document: of labels that differ the document takes none, of texts the first by hash
    marks = marks.groupBy(doc_id).agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    few = marks.orderBy(F.xxhash64(doc_id), doc_id).limit(sample)  # at most `sample` short rows, so that they may be broadcast
    known = docs.join(F.broadcast(few), doc_id).groupBy(doc_id, "label").agg(F.min(F.struct(F.xxhash64(text), text)).alias("one"))
    known = known.select(F.col(doc_id).alias("row"), F.col(f"one.{text}").alias(text), "label")
    every = staged(known, "labelled")
    known = staged(without_copies(every, text), "labelled")
    remove(every)
    sizes = {r.label: r.c for r in known.groupBy("label").agg(F.count("*").alias("c")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = learn_lexicon(known, text, toxic, other, most_terms) if toxic and other else Lexicon({})

    def measured(batches):
        lean_worker()
        matcher = Matcher(lexicon)
        for batch in in_parts(batches):
            rows = [matcher.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()), batch.column(1)], ["x", "label"])

    beta = np.zeros(_FEATURES + 1)
    if toxic and other:
        rows = known.select(text, "label").mapInArrow(measured, "x binary, label int").collect()  # at most `sample`
        rows.sort()  # so that sums don't depend on the order in which tasks end
        beta = fit_logistic(np.array([np.frombuffer(r.x) for r in rows]), np.array([r.label for r in rows]))
    else:
        beta[-1] = 30.0 if toxic else -30.0

    remove(known)

    def scored(batches):
        lean_worker()
        matcher = Matcher(lexicon)
        for batch in in_parts(batches):
            x = np.array([matcher.features(t or "") for t in batch.column(2).to_pylist()]).reshape(-1, _FEATURES)
            p = 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
            hits = np.rint(np.expm1(x[:, 5])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32), pa.int32()), pa.array(hits)], ["doc_id", "held_out", "score", "predicted", "hits"])

    return docs.select(doc_id, "held_out", text).mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int, hits long")
