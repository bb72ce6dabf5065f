"""Spelling variants: words one edit apart, by two-dimensional range reporting.

Words are maximal runs of ASCII letters and the letters U+00C0 to U+00FF of whole texts, A-Z lower-cased; in one of
`every` runs of a document, chosen by CRC32, a code point is deleted.  Those of at least `least` code points that occur at
least `often` times in all are the dictionary.

Two words are near if they differ by one inserted, deleted or replaced code point.  A word that differs from w in position
i alone starts with w[:i] and ends with w[i+1:]; one that has a code point more there starts with w[:i] and ends with w[i:].
The dictionary, in forward order, has the first in one interval, and in the order of reversed words it has the second in
another; a wavelet matrix over the reverse ranks, in forward order, reports the words that lie in both.

Words are dealt into shards, ranges of the forward order, each with matrices of its own, one for each length.  An edit in the
second half of a word leaves its first half as it is, so a word visits the shards that its first half's interval
meets, mostly one; edits in the first half are found in the same way among reversed words.  A shard that many words visit is
copied, and its visitors are shared out among the copies, so a task has at most `SHARD` words and about `VISITS`
visitors, however many share a prefix.  Each task sends a count and the best near word for each word, not the pairs.

A word's form is its near word with the largest count, ties by code points, if that is at least `ratio` times its
own.  Forms grow by that factor, so chains are short; roots are found by pointer doubling.

Null texts have no words; with a null doc_id no code point is deleted.  Repeated rows count each.  Without
dictionary words there are no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, in_parts, lean_worker, remove, staged
from .words import advance, hashes, joined, runs

SHARD = 100_000  # words of a shard
VISITS = 300_000  # visitors of a copy of a shard
_ASCII = np.zeros(256, dtype=bool)
_ASCII[0x61:0x7B] = True
_HELD = 300_000  # distinct words that a task keeps before it sends them


def letter_runs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased block of UTF-8 bytes, each run's start, end and number of code points, and which text it is from."""
    block, bounds = joined(texts)
    lead = block == 0xC3  # of the 64 letters from U+00C0 on, in UTF-8
    inside = _ASCII[block] | lead
    inside[1:] |= lead[:-1]
    starts, ends = runs(inside)
    leads = np.concatenate([[0], np.cumsum(lead)])
    return block, starts, ends, ends - starts - (leads[ends] - leads[starts]), np.searchsorted(bounds, starts, side="right") - 1


def word_counts(docs: DataFrame, doc_id: str, text: str, least: int, every: int) -> DataFrame:
    """(word, n) of all documents, after the deletions."""

    def counted(batches):
        lean_worker()
        held: dict[bytes, int] = {}

        def flush():
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in in_parts(batches):
            block, starts, ends, length, owner = letter_runs(as_bytes(batch.column(1)))
            ids = batch.column(0).to_pylist()
            known = np.array([i is not None for i in ids], dtype=bool)
            prefix = np.array([zlib.crc32(f"{i}:".encode()) ^ 0xFFFFFFFF for i in ids], dtype=np.uint32)
            keep = length >= least
            starts, ends, length, owner = starts[keep], ends[keep], length[keep], owner[keep]
            h = ~advance(prefix[owner], block, starts, ends)
            cut = (h % np.uint32(every) == 0) & known[owner]
            for i in np.flatnonzero(cut & (length > least)).tolist():
                word, at = block[starts[i] : ends[i]].tobytes().decode(), int(h[i]) % int(length[i])
                word = (word[:at] + word[at + 1 :]).encode()
                held[word] = held.get(word, 0) + 1
            starts, ends = starts[~cut], ends[~cut]
            _, first, n = np.unique(hashes(block, starts, ends), return_index=True, return_counts=True)
            whole = block.tobytes()
            for a, b, c in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
                word = whole[a:b]
                held[word] = held.get(word, 0) + c
            if len(held) > _HELD:
                yield flush()
                held.clear()
        yield flush()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class WaveletMatrix:
    """Distinct numbers 0 .. n-1 in a given order; reports those that stand in an interval and are of a range."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def report(self, lo: np.ndarray, hi: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, number) for each number of [low, high) in places [lo, hi), of all queries at once."""
        query, value = np.flatnonzero((lo < hi) & (low < high)), 0
        lo, hi = lo[query], hi[query]
        value = np.zeros(len(query), dtype=np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            one_lo, one_hi = ones[lo], ones[hi]
            lo, hi = np.concatenate([lo - one_lo, zeros + one_lo]), np.concatenate([hi - one_hi, zeros + one_hi])
            value = np.concatenate([value, value | 1 << b])
            query = np.concatenate([query, query])
            live = (lo < hi) & (value < high[query]) & (value + (1 << b) > low[query])
            query, value, lo, hi = query[live], value[live], lo[live], hi[live]
        return query, value


def _fixed(words: list[bytes], length: int) -> np.ndarray:
    return np.array(words, dtype=f"S{length}")


def _letters(words: np.ndarray) -> np.ndarray:
    """Words of one length as a matrix of bytes."""
    return np.ascontiguousarray(words).view(np.uint8).reshape(len(words), words.dtype.itemsize)


def _strings(letters: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(letters).view(f"S{letters.shape[1]}").ravel()


class _Lengths:
    """The words of one length of a shard: in forward order, in reverse order, and the matrix that ties both."""

    def __init__(self, words: list[bytes], n: list[int]):
        words = _fixed(words, len(words[0]))
        order = np.argsort(words, kind="stable")
        self.words, self.n = words[order], np.array(n, dtype=np.int64)[order]
        self.letters = _letters(self.words)
        turned = _strings(self.letters[:, ::-1])
        self.by_end = np.argsort(turned, kind="stable")  # forward place of each reverse rank
        self.turned = turned[self.by_end]
        rank = np.empty(len(words), dtype=np.int64)
        rank[self.by_end] = np.arange(len(words))
        self.matrix = WaveletMatrix(rank)

    @staticmethod
    def _interval(ordered: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where words that start so stand; `starts` is a matrix of bytes, narrower than the words by some columns."""
        padded = np.zeros((2, len(starts), length), dtype=np.uint8)
        padded[:, :, : starts.shape[1]] = starts
        padded[1, :, starts.shape[1] :] = 255
        return np.searchsorted(ordered, _strings(padded[0]), side="left"), np.searchsorted(ordered, _strings(padded[1]), side="right")

    def near(self, letters: np.ndarray, home: np.ndarray, first: int, extra: int, turned: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, place) of words that differ from a row of letters by one code point at position `first` or later: replaced
        if extra is 0, inserted if it is 1.  An inserted code point that equals its neighbours may stand at several positions;
        the last of them counts, of reversed words the first.  `home` says which rows are words of this shard themselves."""
        size, length = letters.shape[1], self.words.dtype.itemsize
        live, rows, places = np.arange(len(letters)), [], []
        for i in range(first, size + extra):
            lo, hi = self._interval(self.words, letters[live, :i], length)
            some = hi - lo > (0 if extra else home[live])  # a word that is there itself meets no other alone
            live, lo, hi = live[some], lo[some], hi[some]
            if not len(live):
                break
            low, high = self._interval(self.turned, letters[live, i + 1 - extra :][:, ::-1], length)
            query, value = self.matrix.report(lo, hi, low, high)
            row, place = live[query], self.by_end[value]
            if not extra:
                once = self.letters[place, i] != letters[row, i]
            elif turned:
                once = self.letters[place, i] != letters[row, i - 1]
            else:
                once = self.letters[place, i] != letters[row, i] if i < size else np.ones(len(row), dtype=bool)
            rows.append(row[once])
            places.append(place[once])
        none = np.empty(0, dtype=np.int64)
        return np.concatenate([none, *rows]), np.concatenate([none, *places])


def near_pairs(words: list[bytes], n: list[int], visitors: list[bytes], turned: bool) -> list[tuple[int, bytes, int]]:
    """(number of a visitor, near word, its n) for edits in the half of the visitor that is read last, each pair once: a
    replaced code point, or one that the near word has more.  Bytes are Latin-1; `turned` says that all are reversed, and keeps
    the middle to the forward side."""
    classes: dict[int, tuple[list[bytes], list[int]]] = {}
    for w, c in zip(words, n):
        mine = classes.setdefault(len(w), ([], []))
        mine[0].append(w)
        mine[1].append(c)
    by_length = {k: _Lengths(*v) for k, v in classes.items()}
    askers, here = {}, set(words)
    for i, w in enumerate(visitors):
        askers.setdefault(len(w), []).append(i)
    out = []
    for length, rows in askers.items():
        half = length - length // 2 if turned else length // 2
        letters = _letters(_fixed([visitors[i] for i in rows], length))
        home = np.array([visitors[i] in here for i in rows], dtype=np.int64)
        for extra in (0, 1):
            there = by_length.get(length + extra)
            if there is None:
                continue
            row, place = there.near(letters, home, half + (extra if turned else 0), extra, turned)
            out.extend(zip(np.array(rows)[row].tolist(), there.words[place].tolist(), there.n[place].tolist()))
    return out


def shard_bounds(words: DataFrame, key: str, shards: int, scratch: list[DataFrame]) -> tuple[DataFrame, list[str]]:
    """Words with the number of their shard, ranges of the order of `key`, and each shard's first word."""
    dealt = staged(words.repartitionByRange(shards, key).withColumn("range", F.spark_partition_id()), "shards")
    scratch.append(dealt)
    first = dealt.groupBy("range").agg(F.min(key).alias("first")).orderBy("first").collect()  # a word for each shard
    numbers = words.sparkSession.createDataFrame([(r["range"], i) for i, r in enumerate(first)], "range int, shard int")
    return dealt.join(F.broadcast(numbers), "range").drop("range"), [r["first"] for r in first]


def visits(words: DataFrame, bounds: list[str], turned: bool) -> DataFrame:
    """(word, key, n, shard): the shards that hold words which start with the half of the key that is read first."""
    shared = words.sparkSession.sparkContext.broadcast(bounds)  # a word for each shard

    def routed(batches):
        bounds = shared.value
        for batch in batches:
            rows, shard = [], []
            for i, key in enumerate(batch.column("key").to_pylist()):
                half = key[: len(key) - len(key) // 2 if turned else len(key) // 2]
                a = max(0, bisect_right(bounds, half) - 1)
                b = bisect_right(bounds, half + "\U0010ffff")
                rows.extend([i] * (b - a))
                shard.extend(range(a, b))
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(rows, pa.int64())) for c in batch.columns], pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])

    return words.select("key", "n").mapInArrow(routed, "key string, n long, shard int")


def near_words(words: DataFrame, turned: bool, scratch: list[DataFrame], shard: int = SHARD, most: int = VISITS) -> DataFrame:
    """(word, n_near, best) of the pairs that edits in one half make: how many near words, and the best (count, word).  Tables
    that the result reads join `scratch`."""
    total = words.count()
    keyed = words.select((F.reverse("word") if turned else F.col("word")).alias("key"), "n")
    dealt, bounds = shard_bounds(keyed, "key", max(1, math.ceil(total / shard)), scratch)
    asked = staged(visits(dealt, bounds, turned), "visits")
    scratch.append(asked)
    copies = F.broadcast(asked.groupBy("shard").agg(F.ceil(F.count("*") / most).cast("int").alias("copies")))  # a row for each shard
    points = dealt.join(copies, "shard").select("shard", "key", "n", F.lit(True).alias("point"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    asked = asked.join(copies, "shard").select("shard", "key", "n", F.lit(False).alias("point"), F.pmod(F.xxhash64("key"), "copies").cast("int").alias("copy"))

    def met(group: pa.Table) -> pa.Table:
        lean_worker()
        point = np.array(group.column("point").to_pylist(), dtype=bool)
        keys = [k.encode("latin-1") for k in group.column("key").to_pylist()]
        n = group.column("n").to_pylist()
        here, asking = np.flatnonzero(point).tolist(), np.flatnonzero(~point).tolist()
        found: dict[bytes, list] = {}

        def add(word: bytes, other: bytes, c: int) -> None:
            mine, other = found.setdefault(word, [0, 0, b""]), other[::-1] if turned else other
            mine[0] += 1
            if c > mine[1] or c == mine[1] and other < mine[2]:
                mine[1:] = c, other

        for i, other, c in near_pairs([keys[i] for i in here], [n[i] for i in here], [keys[i] for i in asking], turned):
            word = keys[asking[i]]
            add(word, other, c)
            if len(other) > len(word):  # the longer of two doesn't ask for the shorter
                add(other, word, n[asking[i]])
        text = lambda x: x.decode("latin-1")
        words = [text(w[::-1] if turned else w) for w in found]
        return pa.table({"word": pa.array(words, pa.string()), "n_near": pa.array([f[0] for f in found.values()], pa.int64()), "best_n": pa.array([f[1] for f in found.values()], pa.int64()), "best": pa.array([text(f[2]) for f in found.values()], pa.string())})

    return points.unionByName(asked).groupBy("shard", "copy").applyInArrow(met, "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame, rounds: int = 20) -> DataFrame:
    """(word, root) of (word, form): where following forms ends, by pointer doubling."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        remove(now)
        now = after
        if not now.where("moved").limit(1).count():
            return now.drop("moved")
    raise RuntimeError("forms don't end")


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 6, often: int = 5, ratio: int = 5, every: int = 199, shard: int = SHARD, most: int = VISITS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every dictionary word."""
    with bounded_batches(docs.sparkSession):
        words = staged(word_counts(docs, doc_id, text, least, every).where(F.col("n") >= often), "words")
    scratch = [words]
    halves = near_words(words, False, scratch, shard, most).unionByName(near_words(words, True, scratch, shard, most))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("best")
    near = halves.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    chosen = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best.best")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"))
    found = staged(found, "variants")
    remove(*scratch)
    root = roots(found.where("form is not null"))
    return found.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
