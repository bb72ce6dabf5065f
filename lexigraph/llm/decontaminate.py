"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised: lower case, every run of ASCII characters that are neither letters nor digits one
space.  An item of m characters may differ from a stretch of a text by k = floor(rate * m) edits.
It is split into k + 1 pieces; k edits leave at least one piece whole, so every match holds an exact
piece.  One Aho-Corasick automaton finds all pieces of all items in a text; around each hit the
stretch that the item could cover, unless it lacks too many of the item's four-character runs for so few
edits, is searched with Myers' bit-parallel edit distance, a whole item at a time in one big integer.
An item that stands in the text as it is needs no such search.

Items are loaded in blocks of bounded size, one pass over the texts for each; a worker holds one block: its
automaton, and bit masks of the items that some text had a piece of.
Every match of every item counts: nothing is capped.

Null and empty texts match nothing; items that are null or empty after normalising take no part.
Items so short that the rate gives them no edit must occur at word ends.  Repeated documents and items
are matched each.  An empty table on either side gives no matches.  Extra columns are ignored, or
kept as they are by without_contaminated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, lean_worker

_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normalised(text: str) -> str:
    """One character a byte, so that lengths and edits count bytes of the lower-cased UTF-8 text."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split()).decode("latin-1")


def cut_pieces(text: str, k: int) -> list[tuple[int, str]]:
    n = len(text)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def _grams(text: str) -> set[str]:
    return {text[i : i + 4] for i in range(len(text) - 3)}


def myers(pattern_masks: dict[str, int], m: int, stretch: str, k: int) -> tuple[int, int] | None:
    """(fewest edits, where the match ends) of the pattern anywhere in the stretch, if within k."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = k + 1, 0
    get = pattern_masks.get
    for i, c in enumerate(stretch):
        eq = get(c, 0)
        x = eq | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        h = minus | (~(d | plus) & full)
        g = plus & d
        if h & top:
            score += 1
        elif g & top:
            score -= 1
        h = (h << 1) & full
        g = (g << 1) & full
        plus = g | (~(d | h) & full)
        minus = h & d
        if score < best:
            best, end = score, i + 1
    return (best, end) if best <= k else None


class Items:
    """Pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items, pieces = [], {}
        self.met: dict[int, tuple[dict[str, int], set[str]]] = {}  # masks and runs of items that some text has a piece of
        for item_id, text in items:
            text = normalised(text)
            if not text:
                continue
            k = int(rate * len(text))
            at = len(self.items)
            self.items.append((item_id, text, k))
            for offset, piece in cut_pieces(text, k):
                pieces.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, edits, start, end) of the nearest match of every item that the text holds; places
        are in the normalised text, and start is where an unedited item would begin."""
        if not self.items or not text:
            return
        text = normalised(text)
        spans: dict[int, list[list[int]]] = {}
        for end, (n, uses) in self.automaton.iter(text):
            for at, offset in uses:
                _, item, k = self.items[at]
                a = end - n + 1 - offset - k
                b = a + len(item) + 2 * k
                held = spans.setdefault(at, [])
                if held and a <= held[-1][1] and a >= held[-1][0]:
                    held[-1][1] = max(held[-1][1], b)
                else:
                    held.append([a, b])
        for at, held in spans.items():
            item_id, item, k = self.items[at]
            found = text.find(item) if k else self._exact(text, item)
            if found >= 0:
                yield item_id, 0, found, found + len(item)
                continue
            if not k:
                continue
            best = None
            masks, grams = self._prepared(at)
            for a, b in held:
                a = max(0, a)
                # an edit spoils at most four of the item's runs of four characters
                if len(grams - _grams(text[a:b])) > 4 * k:
                    continue
                hit = myers(masks, len(item), text[a:b], k)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], a + hit[1])
            if best:
                yield item_id, best[0], max(0, best[1] - len(item)), best[1]

    def _prepared(self, at: int) -> tuple[dict[str, int], set[str]]:
        if at not in self.met:
            text, masks = self.items[at][1], {}
            for i, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << i
            self.met[at] = masks, _grams(text)
        return self.met[at]

    @staticmethod
    def _exact(text: str, item: str) -> int:
        found = re.search(rf"(?:^| ){re.escape(item)}(?: |$)", text)
        return -1 if not found else found.start() + (text[found.start()] == " ")


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about so many characters; the driver holds one block at a time."""
    held, size = [], 0
    for r in benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).toLocalIterator():
        held.append((r.i, r.t))
        size += len(r.t)
        if size >= block_chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, block_chars: int = 4_000_000, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, start, end): the nearest match of every item in every document that holds it."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, start long, end long"
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_id, item_text, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def searched(batches, shared=shared):
            lean_worker()
            items = Items(shared.value, rate)
            for batch in in_parts(batches):
                rows = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for hit in items.matches(t or "")]
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))], ["doc_id", "item_id", "edits", "start", "end"])

        found = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(searched, schema)
        out = out.unionByName(found)
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, block_chars: int = 4_000_000, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text matches no item; rows don't move."""
    spark = docs.sparkSession
    for block in _blocks(benchmark, item_id, item_text, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def kept(batches, shared=shared):
            lean_worker()
            items = Items(shared.value, rate)
            for batch in in_parts(batches):
                keep = [next(items.matches(t or ""), None) is None for t in batch.column(text).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(kept, docs.schema)
    return docs
