"""Language model scores by context-tree weighting over bytes.

A text is lower-cased (A-Z) and its words, runs of bytes other than space and 0x09-0x0D, are joined by one space; 0x0A ends it and
fills the contexts of its first bytes.  Every byte is eight binary decisions, each with a tree of its own over the
preceding bytes, nearest first, down to `depth`.  A node holds how often its decision was 0 and 1 in that context in all
training texts, and the Krichevsky-Trofimov probability of these.  The weighted probability of a node is half its own and
half the product of its children's; at the greatest depth it is its own.  From these follows how much each depth counts
where a decision is predicted: a node takes its share of what the shallower ones left, and the deepest node that
training has seen takes the rest, so that an unseen context neither adds nor costs anything.  A document's score is the log10
probability of its whole text, `bits_per_byte` its code length a byte.

Beside it stands a base: words, then one end, each by itself, with add-one counts of all training tokens.

How it is spread out.  Documents are dealt by hash into blocks of bounded size.  A block sends its distinct grams (a byte and
its `depth` bytes of context) and words, with their counts in training texts, in sorted arrays, one for each shard; a shard
holds all contexts that end in the same three bytes, or a share of the words.  Blocks' arrays are merged 64 at a time until a shard has one.
Shards work out the subtrees of three bytes and more; the trees above, which hold no more than a decision for each pair of bytes (at most
65,536 x 255 nodes), are summed up by node, finished on the driver and shared with all tasks.  Then each shard
answers what the blocks asked, for 64 blocks at a time, and each block adds up the answers for its documents.  Nothing
that grows with the texts passes through the driver or one task, and no count is pruned or hashed into a
fixed table; words are told apart by a 64-bit hash.

Null and empty texts have the end alone.  A document whose `held_out` is null isn't learned from, and isn't held out.  Where
nothing can be learned from, every decision has probability 1/2.  Repeated rows keep a row each, and count each.  Extra columns are
ignored.  Rows that repeat both doc_id and text are of one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, in_parts, lean_worker, remove, staged
from .shingles import mix64, word_hashes

BLOCK = 20 << 20  # bytes of text to a block
PIECES = 1 << 20  # bytes of text that are worked on at a time
FAN = 64  # blocks whose arrays are merged, or answered, at a time
ASKED = 1 << 18  # grams whose probabilities are worked out at a time
SPLIT = 3  # nearest bytes of context that a shard's subtrees share
_HELD = 1_500_000  # grams and words of a block that are kept before they are merged
_GRAMS, _WORDS = 0, 1
_END = np.uint64(1)  # what stands for the end of a text among hashes of words
_TABLE = 4096
_HALVES = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_TABLE) + 0.5))])  # ln of 1/2 * 3/2 * ... , n factors
_WHOLES = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 2 * _TABLE + 1)))])  # ln n!


def _ln_gamma(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def evidence(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""

    def halves(n):
        out, many = _HALVES[np.minimum(n, _TABLE)], n > _TABLE
        out[many] = _ln_gamma(n[many] + 0.5) - math.lgamma(0.5)
        return out

    n = zeros + ones
    whole, many = _WHOLES[np.minimum(n, 2 * _TABLE)], n > 2 * _TABLE
    whole[many] = _ln_gamma(n[many] + 1.0)
    return halves(zeros) + halves(ones) - whole


def _firsts(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else np.empty(0, np.int64)


def normalised(texts: list[bytes | None]) -> list[bytes]:
    return [b" ".join((t or b"").lower().split()) for t in texts]


Piece = tuple[int, bytes, bytes]  # number of the text, the bytes before, a part of the text


def cut(texts: list[bytes], depth: int, most: int = PIECES) -> Iterator[list[Piece]]:
    """Normalised texts with their ends, in lists of about `most` bytes; a longer text is cut between words."""
    held: list[Piece] = []
    size = 0
    for i, text in enumerate(texts):
        whole, at = text + b"\n", 0
        while at < len(whole):
            to = len(whole)
            if to - at > most:
                to = whole.rfind(b" ", at, at + most) + 1 or whole.find(b" ", at + most) + 1 or to
            held.append((i, (b"\n" * depth + whole[max(0, at - depth) : at])[-depth:], whole[at:to]))
            size, at = size + len(held[-1][2]), to
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def grams(pieces: list[Piece], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the pieces: context and byte as one number, the nearest byte of context on top, and the number of the
    text."""
    block = np.frombuffer(b"".join(before + part for _, before, part in pieces), dtype=np.uint8)
    sizes = [len(part) for _, _, part in pieces]
    at = np.arange(sum(sizes)) + depth * np.repeat(np.arange(1, len(pieces) + 1), sizes)
    key = block[at].astype(np.uint64)
    for d in range(1, depth + 1):
        key |= block[at - d].astype(np.uint64) << np.uint64(8 * (depth - d + 1))
    return key, np.repeat([i for i, _, _ in pieces], sizes)


def tokens(pieces: list[Piece]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the pieces and of the ends of texts, and the number of the text."""
    words, counts = word_hashes([part for _, _, part in pieces])
    ends = [i for i, _, part in pieces if part.endswith(b"\n")]
    return np.concatenate([words, np.full(len(ends), _END)]), np.concatenate([np.repeat([i for i, _, _ in pieces], counts), np.array(ends, dtype=np.int64)])


class Level:
    """The nodes of one depth and one decision of the eight, in order of context and the bits before."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray | None):
        own = evidence(zeros, ones)
        self.node, self.zeros, self.ones = node, zeros, ones
        # ln of the weighted probability, and how much the node's own estimate counts against its children's
        self.ln = own if split is None else np.logaddexp(own, split) - math.log(2)
        self.share = np.ones(len(node)) if split is None else np.exp(own - math.log(2) - self.ln)


def above(node: np.ndarray, bit: int) -> np.ndarray:
    """The node of one byte less context."""
    bits = np.uint64(bit)
    return node >> np.uint64(8) >> bits << bits | node & np.uint64((1 << bit) - 1)


def decisions(keys: np.ndarray, counts: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of sorted grams that were met in training, and how often their decision was 0 and 1."""
    node = keys >> np.uint64(8 - bit)
    first = _firsts(node)
    if not len(first):
        return node, np.empty(0, np.int64), np.empty(0, np.int64)
    ones = np.add.reduceat(counts * ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64), first)
    return node[first], np.add.reduceat(counts, first) - ones, ones


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[list[Level]]:
    """Nodes from depth `top` to `depth`, shallow ones first, of sorted grams with their counts."""
    keys, counts = keys[counts > 0], counts[counts > 0]
    out: list[list[Level]] = []
    for d in range(depth, top - 1, -1):
        if d < depth:
            low = np.uint64(255)
            keys, counts = merged(keys >> np.uint64(16) << np.uint64(8) | keys & low, counts)
        level = []
        for bit in range(8):
            node, zeros, ones = decisions(keys, counts, bit)
            split = None
            if out:
                split = np.bincount(np.searchsorted(node, above(out[-1][bit].node, bit)), weights=out[-1][bit].ln, minlength=len(node))
                out[-1][bit].ln = None  # nothing else reads it
            level.append(Level(node, zeros, ones, split))
        out.append(level)
    return out[::-1]


def top_trees(sums: dict[int, tuple], top: int) -> list[list[Level]]:
    """Nodes from depth 0 to `top`, from those at `top`: for each bit (node, zeros, ones, sum of the children's ln)."""
    out: list[list[Level]] = []
    for d in range(top, -1, -1):
        level = []
        for bit in range(8):
            if not out:
                node, zeros, ones, split = sums[bit]
            else:
                below = out[-1][bit]
                node, where = np.unique(above(below.node, bit), return_inverse=True)
                zeros, ones = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
                np.add.at(zeros, where, below.zeros)
                np.add.at(ones, where, below.ones)
                split = np.bincount(where, weights=below.ln, minlength=len(node))
            level.append(Level(node, zeros, ones, split))
        out.append(level)
    return out[::-1]


def log_probability(keys: np.ndarray, depth: int, levels: list[list[Level]]) -> np.ndarray:
    """log10 probability of each gram's byte after its context; `levels` from depth 0 on."""
    if len(keys) > ASKED:
        return np.concatenate([log_probability(keys[i : i + ASKED], depth, levels) for i in range(0, len(keys), ASKED)])
    out = np.zeros(len(keys))
    for bit in range(8):
        mixed, left, one = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), 0.5)
        for d, level in enumerate(levels):
            here = level[bit]
            if not len(here.node):
                break
            node = keys >> np.uint64(8 * (depth - d) + 8) << np.uint64(bit) | (keys >> np.uint64(8 - bit)) & np.uint64((1 << bit) - 1)
            at = np.minimum(np.searchsorted(here.node, node), len(here.node) - 1)
            seen = here.node[at] == node
            estimate = (here.ones[at] + 0.5) / (here.zeros[at] + here.ones[at] + 1.0)
            one = np.where(seen, mixed + left * estimate, one)
            share = here.share[at]
            mixed = np.where(seen, mixed + left * share * estimate, mixed)
            left = np.where(seen, left * (1 - share), left)
        out += np.log10(np.where((keys >> np.uint64(7 - bit)) & np.uint64(1), one, 1 - one))
    return out


_ARRAYS = "kind int, shard int, block int, keys binary, counts binary"


def _numbers(column, kind) -> list[np.ndarray]:
    """The arrays of a binary column, without copies."""
    return [np.frombuffer(x.as_buffer(), dtype=kind) if len(x.as_buffer()) else np.empty(0, kind) for x in column]


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Pieces of an array between its edges as a binary column, without copies."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _shard(kind: int, keys: np.ndarray, shards: int, depth: int, split: int) -> np.ndarray:
    """A shard for all contexts that end in the same bytes; for words, a share."""
    with np.errstate(over="ignore"):
        return (mix64(keys >> np.uint64(8 * (depth + 1 - split))) if kind == _GRAMS else keys >> np.uint64(16)) % np.uint64(shards)


def gathered(docs: DataFrame, depth: int, split: int, shards: int) -> DataFrame:
    """Distinct grams and words of each block with their counts in training texts, an array for each shard."""

    def gather(group: pa.Table) -> pa.Table:
        lean_worker()
        held: list[list] = [[], []]

        def add(kind: int, keys: np.ndarray, learned: np.ndarray) -> None:
            flag = np.uint64(1)
            keys = np.sort(keys << flag | learned.astype(np.uint64)) if kind == _GRAMS else keys
            if kind == _GRAMS:
                learned, keys = (keys & flag).astype(np.int64), keys >> flag
                first = _firsts(keys)
                held[kind].append((keys[first], np.add.reduceat(learned, first)))
            else:
                held[kind].append(merged(keys, learned.astype(np.int64)))
            if sum(len(k) for k, _ in held[kind]) > _HELD:
                held[kind][:] = [merged(*map(np.concatenate, zip(*held[kind])))]

        for batch in in_parts(group.select(["text", "learned"]).to_batches()):
            texts, learned = normalised(as_bytes(batch.column(0))), np.array(batch.column(1).to_pylist(), dtype=bool)
            for pieces in cut(texts, depth):
                for kind, found in ((_GRAMS, grams(pieces, depth)), (_WORDS, tokens(pieces))):
                    add(kind, found[0], learned[found[1]])
        block, tables = group.column("block")[0].as_py(), []
        for kind in (_GRAMS, _WORDS):
            keys, counts = merged(*map(np.concatenate, zip(*held[kind])))
            held[kind].clear()
            shard = _shard(kind, keys, shards, depth, split)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            numbers = np.flatnonzero(np.diff(edges))
            edges = np.append(edges[numbers], edges[-1])
            one = {"kind": np.full(len(numbers), kind, np.int32), "shard": numbers.astype(np.int32), "block": np.full(len(numbers), block, np.int32)}
            tables.append(pa.table(one | {"keys": _binary(keys[order], edges), "counts": _binary(counts[order], edges)}))
            del keys, counts, shard, order
        return pa.concat_tables(tables)

    return docs.groupBy("block").applyInArrow(gather, _ARRAYS)


def summed(arrays: DataFrame, blocks: int) -> DataFrame:
    """One array for each kind and shard, merged from at most `FAN` at a time."""

    def merge(group: pa.Table) -> pa.Table:
        lean_worker()
        keys, counts = merged(np.concatenate(_numbers(group.column("keys"), np.uint64)), np.concatenate(_numbers(group.column("counts"), np.int64)))
        one = group.slice(0, 1)
        return pa.table({"kind": one["kind"], "shard": one["shard"], "block": one["block"], "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    while True:
        blocks = math.ceil(blocks / FAN)
        arrays = arrays.withColumn("block", F.expr(f"block div {FAN}").cast("int")).groupBy("kind", "shard", "block").applyInArrow(merge, _ARRAYS)
        if blocks == 1:
            return staged(arrays, "counts")


def _top(counts: DataFrame, depth: int, split: int) -> list[list[Level]]:
    """The trees above the shards' subtrees."""
    low = split - 1

    def up(batches):
        lean_worker()
        for batch in batches:
            for keys, counts in zip(_numbers(batch.column(0), np.uint64), _numbers(batch.column(1), np.int64)):
                for bit, level in enumerate(subtrees(keys, counts, depth, split)[0]):
                    if not len(level.node):
                        continue
                    node, where = np.unique(above(level.node, bit), return_inverse=True)
                    sums = [np.bincount(where, weights=x, minlength=len(node)) for x in (level.zeros, level.ones, level.ln)]
                    yield pa.RecordBatch.from_arrays([pa.array([bit] * len(node), pa.int32()), pa.array(node.astype(np.int64)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(sums[2])], ["bit", "node", "zeros", "ones", "ln"])

    nodes = counts.where(f"kind = {_GRAMS}").select("keys", "counts").mapInArrow(up, "bit int, node long, zeros long, ones long, ln double")
    nodes = nodes.groupBy("bit", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "ln")]).toArrow()  # a row for each decision after two bytes
    bits, sums = nodes["bit"].to_numpy(), {}
    for bit in range(8):
        mine = np.flatnonzero(bits == bit)
        mine = mine[np.argsort(nodes["node"].to_numpy()[mine])]
        zeros, ones, ln = (nodes[c].to_numpy()[mine] for c in ("zeros", "ones", "ln"))
        sums[bit] = nodes["node"].to_numpy()[mine].astype(np.uint64), zeros, ones, ln
    return top_trees(sums, low)


def answered(arrays: DataFrame, counts: DataFrame, blocks: int, top: list[list[Level]], depth: int, split: int) -> DataFrame:
    """(block, kind, keys, values): of the blocks' grams the log10 probabilities, of their words the counts."""
    shared = counts.sparkSession.sparkContext.broadcast(top)

    def answer(asked: pa.Table, model: pa.Table) -> pa.Table:
        lean_worker()
        if not asked.num_rows:
            return pa.table({"block": pa.array([], pa.int32()), "kind": pa.array([], pa.int32()), "keys": pa.array([], pa.binary()), "values": pa.array([], pa.binary())})
        (known,), (count,) = _numbers(model.column("keys"), np.uint64), _numbers(model.column("counts"), np.int64)
        values = count.astype(np.float64)
        if model.column("kind")[0].as_py() == _GRAMS:
            values = log_probability(known, depth, shared.value + subtrees(known, count, depth, split))
        found = [values[np.searchsorted(known, keys)].tobytes() for keys in _numbers(asked.column("keys"), np.uint64)]
        return pa.table({"block": asked["block"], "kind": asked["kind"], "keys": asked["keys"], "values": pa.array(found, pa.binary())})

    asked = arrays.select("kind", "shard", F.expr(f"block div {FAN}").cast("int").alias("part"), "block", "keys")
    copies = F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // FAN)))
    model = counts.select("kind", "shard", copies.alias("part"), "keys", "counts")
    place = ["kind", "shard", "part"]
    return asked.groupBy(*place).cogroup(model.groupBy(*place)).applyInArrow(answer, "block int, kind int, keys binary, values binary")


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", depth: int = 5, block_bytes: int = BLOCK) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row; depth from 1 to 6."""
    split = min(SPLIT, depth)
    # the bytes are counted: an estimate that is too small would make blocks too large
    blocks = max(1, math.ceil((docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0) / block_bytes))
    # so many that what the blocks of one answer ask of a shard is small at any size
    shards = max(24, math.ceil(blocks / 2))
    row = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    row = row.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"), F.coalesce(~F.col("held_out"), F.lit(False)).alias("learned"))
    row = row.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    with bounded_batches(docs.sparkSession):
        arrays = staged(gathered(row, depth, split, shards), "gathered")
        counts = summed(arrays, blocks)
        top = _top(counts, depth, split)

        def totals(batches):
            for batch in batches:
                counts = _numbers(batch.column(0), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(c.sum()) for c in counts], pa.int64()), pa.array([int((c > 0).sum()) for c in counts], pa.int64())], ["n", "v"])

        of_words = counts.where(f"kind = {_WORDS}").select("counts").mapInArrow(totals, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
        n_all, distinct = of_words[0] or 0, of_words[1] or 0
        answers = staged(answered(arrays, counts, blocks, top, depth, split), "answers")
        remove(arrays, counts)

        def added(group: pa.Table, answers: pa.Table) -> pa.Table:
            lean_worker()
            # a shard's answers stay as they came: in order of their keys
            known: list[dict] = [{}, {}]
            for kind, keys, values in zip(answers.column("kind").to_pylist(), _numbers(answers.column("keys"), np.uint64), _numbers(answers.column("values"), np.float64)):
                known[kind][int(_shard(kind, keys[:1], shards, depth, split)[0])] = keys, values

            def told(kind: int, wanted: np.ndarray) -> np.ndarray:
                shard, found = _shard(kind, wanted, shards, depth, split), np.empty(len(wanted))
                order = np.argsort(shard, kind="stable")
                for part in np.split(order, _firsts(shard[order])[1:]):
                    keys, values = known[kind][int(shard[part[0]])]
                    found[part] = values[np.searchsorted(keys, wanted[part])]
                return found

            out = []
            for batch in in_parts(group.select(["doc_id", "text", "held_out"]).to_batches(), rows=256):
                texts = normalised(as_bytes(batch.column(1)))
                n = len(texts)
                total, logs, n_tokens, n_known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for pieces in cut(texts, depth):
                    keys, owner = grams(pieces, depth)
                    # grams of one kind side by side are looked up once: number of the text in the low byte
                    keys = np.sort(keys << np.uint64(8) | owner.astype(np.uint64))
                    owner, keys = (keys & np.uint64(255)).astype(np.int64), keys >> np.uint64(8)
                    first = _firsts(keys)
                    each = told(_GRAMS, keys[first])
                    total += np.bincount(owner, weights=np.repeat(each, np.diff(np.append(first, len(keys)))), minlength=n)
                    words, owner = tokens(pieces)
                    distinct_words, where = np.unique(words, return_inverse=True)
                    count = told(_WORDS, distinct_words)[where]
                    n_tokens += np.bincount(owner, minlength=n)
                    n_known += np.bincount(owner, weights=count > 0, minlength=n).astype(np.int64)
                    logs += np.bincount(owner, weights=np.log10(count + 1), minlength=n)
                base = logs - n_tokens * math.log10(n_all + distinct + 1)
                bits = -total / math.log10(2) / (np.array([len(t) for t in texts]) + 1)
                out.append(pa.table({"doc_id": batch.column(0), "held_out": batch.column(2), "n_tokens": n_tokens, "n_known": n_known, "train_tokens": np.full(n, n_all, np.int64), "base_score": base, "score": total, "bits_per_byte": bits}))
            return pa.concat_tables(out)

        schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
        # worked out here, in small batches
        out = staged(row.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(added, schema), "scores")
        remove(answers)
    return out
