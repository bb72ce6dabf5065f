"""Operators 11 to 13: resampling, context-tree scores, spelling variants, each against a plain version."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigraph.llm import context_tree, resampling, variants, words
from lexigraph.llm.queries import ORACLE_SQL

texts = st.lists(st.none() | st.text(alphabet=st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=5)


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def lower(data: bytes) -> bytes:
    return data.lower()  # of bytes, A-Z alone


def encoded(many):
    return [None if t is None else t.encode() for t in many]


# --- op11


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 3))
def test_features_of_any_text(many, longest):
    bucket, owner, n = resampling.features(encoded(many), 1000, longest)
    want, sizes = [], []
    for i, t in enumerate(many):
        found = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower((t or "").encode()))
        sizes.append(len(found))
        want += [(i, zlib.crc32(b" ".join(found[j : j + k])) % 1000) for k in range(1, longest + 1) for j in range(len(found) - k + 1)]
    assert sorted(zip(owner.tolist(), bucket.tolist())) == sorted(want)
    assert n.tolist() == sizes


def test_crc_of_long_words():
    data = [b"a" * 10_000, b"", b"xyz", b"\xff" * 70] + [b"q" * k for k in range(60, 80)]
    ends = np.cumsum([len(d) for d in data])
    block = np.frombuffer(b"".join(data), np.uint8)
    state = words.advance(np.full(len(data), 0xFFFFFFFF, np.uint32), block, ends - [len(d) for d in data], ends)
    assert (~state).tolist() == [zlib.crc32(d) for d in data]


def documents(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1.0) for r in rows], "doc_id long, text string, rank int, word string, score double")


def corpus(seed, n, vocabulary=("the", "of", "haus", "größe", "étude", "étudez", "wandering", "wanderinng", "wandring", "Wanderung", "x", "3rd")):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.randrange(60)))) for i in range(n)]
    return rows + [(900, None), (901, ""), (902, " \t\n"), (5, rows[5][1]), (5, "same id " * 15), (None, "no id " * 30), (903, "y" * 30_000), (904, "Ab cd " * 20_000)]


def plain_resample(rows, target, buckets, longest, least, percent):
    def found(text):
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower((text or "").encode()))
        return len(w), [zlib.crc32(b" ".join(w[j : j + k])) % buckets for k in range(1, longest + 1) for j in range(len(w) - k + 1)]

    own, aim = Counter(), Counter()
    for _, t in rows:
        own.update(found(t)[1])
    for t in target:
        aim.update(found(t)[1])
    a, b = sum(own.values()) + buckets, sum(aim.values()) + buckets
    out, may = [], []
    for i, t in rows:
        n, f = found(t)
        weight = sum(math.floor(1000 * math.log((aim[k] + 1) * a / ((own[k] + 1) * b))) for k in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if n >= least and i is not None:
            may.append(out[-1])
    may.sort(key=lambda r: (-r[3], r[0], -r[2], -r[1]))
    for k, r in enumerate(may[: len(may) * percent // 100]):
        r[4] = k + 1
    return out


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_against_plain(spark, longest):
    rows = corpus(1, 60)
    target = ["the étude of wandering", None, "", "of of größe"]
    got = resampling.resample(documents(spark, rows), spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"), longest=longest, percent=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert as_rows(got) == sorted(map(tuple, plain_resample(rows, target, 10_000, longest, 20, 40)), key=repr)


def test_resampling_of_empty_tables(spark):
    empty = documents(spark, []).limit(0)
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(empty, target).count() == 0
    rows = [(1, "a " * 25), (2, None)]
    assert as_rows(resampling.resample(documents(spark, rows), target, percent=100)) == sorted(map(tuple, plain_resample(rows, [], 10_000, 1, 20, 100)), key=repr)


def test_ranks_over_many_partitions(spark):
    rows = spark.range(3000).select((F.col("id") % 700).alias("a"), "id")
    got = resampling.ranked(rows, F.desc("a"), F.asc("id")).collect()
    assert [(r.a, r.id) for r in sorted(got, key=lambda r: r.rank)] == sorted(((r.a, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert sorted(r.rank for r in got) == list(range(1, 3001))


# --- op12


class PlainTree:
    """A context tree of dictionaries, weighted by plain recursion."""

    def __init__(self, depth):
        self.depth, self.seen = depth, {}

    @staticmethod
    def sequence(text):
        return b" ".join(lower((text or "").encode()).split()) + b"\n"

    def steps(self, text):
        data = b"\n" * self.depth + self.sequence(text)
        for at in range(self.depth, len(data)):
            context = data[at - self.depth : at][::-1]
            for bit in range(8):
                yield context, (bit, data[at] >> (8 - bit)), data[at] >> (7 - bit) & 1

    def learn(self, text):
        for context, bits, value in self.steps(text):
            for d in range(self.depth + 1):
                self.seen.setdefault((context[:d], bits), [0, 0])[value] += 1

    def weigh(self):
        self.children = {}
        for context, bits in self.seen:
            if context:
                self.children.setdefault((context[:-1], bits), []).append(context)
        self.memo = {}

    def ln(self, context, bits):
        if (context, bits) not in self.memo:
            a, b = self.seen[context, bits]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
            if len(context) == self.depth:
                self.memo[context, bits] = own, own
            else:
                split = sum(self.ln(c, bits)[0] for c in self.children[context, bits])
                top = max(own, split)
                self.memo[context, bits] = top + math.log((math.exp(own - top) + math.exp(split - top)) / 2), own
        return self.memo[context, bits]

    def one(self, context, bits, d=0):
        if (context[:d], bits) not in self.seen:
            return None
        a, b = self.seen[context[:d], bits]
        estimate = (b + 0.5) / (a + b + 1)
        deeper = self.one(context, bits, d + 1) if d < self.depth else None
        if deeper is None:
            return estimate
        whole, own = self.ln(context[:d], bits)
        share = math.exp(own - whole) / 2
        return share * estimate + (1 - share) * deeper

    def score(self, text):
        total = 0.0
        for context, bits, value in self.steps(text):
            p = self.one(context, bits)
            total += math.log10(0.5 if p is None else p if value else 1 - p)
        return total


def test_evidence_is_krichevsky_trofimov():
    many = np.array([[0, 0], [1, 0], [3, 4], [100, 7], [4095, 4097], [5000, 1], [20_000, 300_000], [0, 10**9]])
    want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1) for a, b in many.tolist()]
    assert np.allclose(context_tree.evidence(many[:, 0], many[:, 1]), want, rtol=1e-9, atol=1e-4)  # sums of 1e9 cancel


@pytest.mark.parametrize("depth, block_bytes", [(1, 1 << 30), (2, 1500), (4, 1500), (5, 1 << 30)])
def test_context_tree_against_plain(spark, depth, block_bytes, monkeypatch):
    monkeypatch.setattr(context_tree, "FAN", 3)
    rows = [r for r in corpus(2, 40) if len(r[1] or "") < 1000] + [(70, "日本 \x00 \x1f end"), (71, "zzz" * 50)]
    got = context_tree.score(documents(spark, rows), held_out(), depth=depth, block_bytes=block_bytes).collect()
    tree, counts = PlainTree(depth), Counter()
    train = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    for _, t in train:
        tree.learn(t)
        counts.update([*re.findall(rb"[^\x20\x09-\x0D]+", lower((t or "").encode())), None])
    tree.weigh()
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        tokens = [*re.findall(rb"[^\x20\x09-\x0D]+", lower((t or "").encode())), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        want.append((i, out, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6), round(tree.score(t), 6)))
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got], key=repr) == sorted(want, key=repr)
    assert all(math.isclose(r.bits_per_byte * len(tree.sequence(t)), -r.score / math.log10(2)) for r, t in zip(sorted(got, key=lambda r: (repr(r.doc_id), r.score)), [t for _, t in sorted(rows, key=lambda r: (repr(r[0]), tree.score(r[1])))]))


def test_context_tree_probabilities_sum_to_one(spark):
    tree_texts = context_tree.normalised([b"the cat sat on the mat", b"a hat"])
    keys, counts = context_tree.merged(context_tree.grams(next(context_tree.cut(tree_texts, 3)), 3)[0], np.ones(sum(len(t) + 1 for t in tree_texts), np.int64))
    levels = context_tree.subtrees(keys, counts, 3, 0)
    for context in (b"the", b"\n\n\n", b"xyz", b"zat"):
        head = sum(context[2 - d] << 8 * (3 - d) for d in range(3))
        each = context_tree.log_probability(np.arange(256, dtype=np.uint64) | np.uint64(head), 3, levels)
        assert math.isclose((10**each).sum(), 1)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab cé", max_size=30), min_size=1, max_size=5), st.integers(1, 12), st.integers(1, 6))
def test_cutting_texts_changes_nothing(many, most, depth):
    whole = context_tree.normalised(encoded(many))
    both = lambda found: sorted(zip(*[np.concatenate(x).tolist() for x in zip(*found)]))
    for kind in (lambda p: context_tree.grams(p, depth), context_tree.tokens):
        assert both(map(kind, context_tree.cut(whole, depth, most))) == both(map(kind, context_tree.cut(whole, depth, 1 << 20)))
    keys, owner = context_tree.grams(next(context_tree.cut(whole, depth)), depth)
    want = [(int.from_bytes((b"\n" * depth + t + b"\n")[j : j + depth][::-1] + (t + b"\n")[j : j + 1]), i) for i, t in enumerate(whole) for j in range(len(t) + 1)]
    assert list(zip(keys.tolist(), owner.tolist())) == want


def test_context_tree_extremes(spark):
    assert context_tree.score(documents(spark, []).limit(0), held_out()).count() == 0
    none = context_tree.score(documents(spark, [(None, "abc"), (None, None)]), held_out()).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.score / math.log10(0.5))) for r in none) == [(1, 0, 0, 8), (2, 0, 0, 32)]
    rows = [(i, f"word{i % 7} " * 50) for i in range(50)] + [(100, "tail " * 300_000)]
    got = {r.doc_id: r for r in context_tree.score(documents(spark, rows), held_out()).collect()}
    assert len(got) == 51 and got[100].n_tokens == 300_001


def test_held_out_documents_are_likelier_than_by_their_words_alone(spark):
    got = context_tree.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), held_out()).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


# --- op13


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="abÿé", min_size=2, max_size=7), min_size=1, max_size=60))
def test_near_pairs_of_any_words(some):
    some = sorted(w.encode("latin-1") for w in some)
    found = []
    for turned in (False, True):
        keys = [w[::-1] for w in some] if turned else some
        for i, other, n in variants.near_pairs(keys, list(range(len(keys))), keys, turned):
            assert keys[n] == other
            found.append((some[i], other[::-1] if turned else other))
    found += [(b, a) for a, b in found if len(b) > len(a)]
    assert sorted(found) == sorted((a, b) for a in some for b in some if near(a, b))


@settings(max_examples=100, deadline=None)
@given(st.permutations(range(23)), st.lists(st.tuples(*[st.integers(0, 23)] * 4), max_size=8))
def test_wavelet_matrix_reports_rectangles(order, asked):
    matrix = variants.WaveletMatrix(np.array(order))
    lo, hi, low, high = np.array(asked, dtype=np.int64).reshape(-1, 4).T
    query, value = matrix.report(lo, hi, low, high)
    assert sorted(zip(query.tolist(), value.tolist())) == sorted((q, v) for q, (a, b, c, d) in enumerate(asked) for v in order[a:b] if c <= v < d)


def plain_variants(rows, least=6, often=5, ratio=5, every=199):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least and n >= often}
    met = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, vs in met.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n, len(met[w]), counts.get(form[w])) for w, n in counts.items()), key=repr)


@pytest.mark.parametrize("shard, most", [(100_000, 300_000), (3, 2)])
def test_variants_against_plain(spark, shard, most):
    rng = random.Random(3)
    stems = ["wandering", "thought", "étudiant", "aaaaaaa", "Prüfung"]

    def word():
        w = rng.choice(stems)
        while rng.random() < 0.5:
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeé") + w[i:], w[:i] + rng.choice("aeÉ") + w[i + 1 :]])
        return w

    rows = [(i, " ".join([word() for _ in range(80)] + ["thought"] * 30 + ["thoughts"] * 5)) for i in range(60)]
    rows += [(900, None), (901, ""), (5, rows[5][1]), (None, "wandering wanderings " * 9), (902, ("a" * 5000 + "b ") * 6 + ("a" * 5000 + "c ") * 31)]
    got = variants.group(documents(spark, rows), every=7, shard=shard, most=most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(rows, every=7)
    assert as_rows(got) == want
    assert sum(1 for r in want if r[1]) > 20 and any(r[1] and r[2] != r[1] for r in want)


def test_variants_without_words(spark):
    assert variants.group(documents(spark, []).limit(0)).count() == 0
    assert variants.group(documents(spark, [(1, "short few"), (2, None)])).count() == 0


@pytest.mark.parametrize("name", ["op11_resampling", "op13_variants"])
def test_sql_agrees(spark, name):
    from lexigraph.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert as_rows(QUERIES[name](spark, folder).select(columns)) == sorted(found.fetchall(), key=repr)


def test_probabilities_of_many_grams_take_little_memory():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 20, 1 << 20).astype(np.uint64))
    levels = context_tree.subtrees(keys[::9], np.ones(len(keys[::9]), np.int64), 2, 0)
    tracemalloc.start()
    found = context_tree.log_probability(keys, 2, levels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6 * keys.nbytes and np.array_equal(found[:1000], context_tree.log_probability(keys[:1000], 2, levels))
