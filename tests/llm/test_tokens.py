import bisect
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexigraph.llm import packing, token_store
from lexigraph.llm.tokens import default_vocabulary, encoder

ODD = ["It's we'll don't I'D", "Straße ÉMIGRÉ ıİ ΣΑΣ", "a<|endoftext|>b <| x", "３½² x_y __ -- ...", "日本語 тест", "é   x\u000by", "", " ", "퟿ 😀 ok", "a" * 5000, "“q” – €5 … «v»"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_vocabulary())


def test_ids_are_the_library_s(library):
    got = encoder(default_vocabulary()).encode(ODD + [None])
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in ODD] + [[]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_ids_of_any_text(texts):
    lib = encoder(default_vocabulary()).library
    assert [x.tolist() for x in encoder(default_vocabulary()).encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def frame(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["wort", "über", "the", "xylophon"]) + str(i % 7) for i in range(4000))
    rows = [(5, long), (3, None), (3, ""), (9, "short text"), (9, "short text"), (1, long + " end"), (-4, "minus"), (7, "a <|endoftext|> b")]
    rows += [(100 + i, " ".join(rng.choice(ODD) for _ in range(rng.randrange(60)))) for i in range(60)]
    return rows, spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, start int, length int, kind string")


def test_store_round_trip(spark, library, tmp_path):
    rows, df = frame(spark)
    path = f"file://{tmp_path}/store"
    token_store.write_store(df, path)
    want, start = [], 0
    ids = sorted((d, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tolist()) for d, t in rows)
    got = sorted(tuple(r) for r in token_store.read_digests(spark, path).collect())
    for d, x in ids:
        want.append((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    assert sorted((d, n, c) for d, _, n, c in got) == sorted(want)
    for d, s, n, _ in sorted(got, key=lambda r: r[1]):
        assert s == start
        start += n
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == sorted(d for d, _ in rows)
    back = sorted((r.doc_id, list(r.ids)) for r in token_store.read_ids(spark, path).collect())
    assert back == ids
    chunks = spark.read.parquet(f"{path}/parts").where("kind = 'chunk'")
    assert chunks.count() == chunks.select("key").distinct().count()


def test_store_notices_damage(spark, tmp_path):
    _, df = frame(spark)
    path = f"file://{tmp_path}/store"
    token_store.write_store(df, path)
    recipes = spark.read.parquet(f"{path}/recipes")
    lost = recipes.where("doc_id <> 5").collect()
    spark.createDataFrame(lost, recipes.schema).write.mode("overwrite").parquet(f"{path}/recipes")
    with pytest.raises(Exception, match="manifest"):
        token_store.read_digests(spark, path).count()


def test_store_notices_a_damaged_chunk(spark, tmp_path):
    _, df = frame(spark)
    path = f"file://{tmp_path}/store"
    token_store.write_store(df, path)
    chunks = spark.read.parquet(f"{path}/parts/kind=chunk")
    worse = chunks.withColumn("data", F.when(F.col("n") == chunks.agg(F.max("n")).first()[0], F.concat(F.substring("data", 1, 3), F.lit(b"\x01"), F.expr("substring(data, 5)"))).otherwise(F.col("data"))).collect()
    spark.createDataFrame(worse, chunks.schema).write.mode("overwrite").parquet(f"{path}/parts/kind=chunk")
    with pytest.raises(Exception, match="damaged"):
        token_store.read_digests(spark, path).collect()


def test_store_of_a_hot_passage_and_a_long_text(spark, library, tmp_path):
    rng = random.Random(4)
    passage = " ".join(rng.choice(["haus", "wald", "über", "the"]) + rng.choice("abcdefgh") for _ in range(3000))
    rows = [(i % 7, passage) for i in range(300)] + [(900, passage + " ende"), (901, (passage + " x ") * 90), (None, None), (None, ""), (None, passage)]
    path = f"file://{tmp_path}/store"
    token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path)
    got = sorted(((r.doc_id is not None, r.doc_id), r.n_tokens, r.ids_crc32, r.start) for r in token_store.read_digests(spark, path).collect())
    want = [((d is not None, d), x) for d, t in rows for x in [np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")]]
    assert sorted((k, len(x), zlib.crc32(x.tobytes())) for k, x in want) == [g[:3] for g in got]
    start = 0
    for (_, n, _, s) in sorted(got, key=lambda g: g[3]):
        assert s == start
        start += n
    keys = [k for k, *_ in sorted(got, key=lambda g: g[3])]
    assert keys == sorted(keys)
    chunks = spark.read.parquet(f"{path}/parts/kind=chunk")
    assert chunks.count() == chunks.select("key").distinct().count() < 400


def test_empty_store(spark):
    assert token_store.store_and_read(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    body = rng.integers(0, 49000, 6000).astype(np.uint32)
    with np.errstate(over="ignore"):
        a = token_store.chunk_ends(np.concatenate([rng.integers(0, 9, 37).astype(np.uint32), body]), np.array([0, 6037]))[0]
        b = token_store.chunk_ends(body, np.array([0, 6000]))[0]
    assert len({x - 37 for x in a} & set(b)) > len(b) // 2
    sizes = np.diff([0, *b])
    assert sizes.max() <= token_store.MOST and sizes[:-1].min() >= token_store.LEAST


def test_joined_crc():
    parts = [b"abcd" * n for n in (1, 3, 700)]
    assert token_store.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def plain_best_fit(lengths, capacity):
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        k = bisect.bisect_left(rooms, x)
        room = rooms.pop(k) if k < len(rooms) else capacity
        n += room == capacity
        bisect.insort(rooms, room - x)
    return n


@pytest.mark.parametrize("seed", range(12))
def test_runs_give_the_bins_of_plain_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randrange(1, 65), 3, 40, 64]) for _ in range(rng.randrange(400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    bins, placed = {}, 0
    for length, _, count, first, offset, each in packing.best_fit_decreasing(counts, 64):
        for i in range(count):
            bins.setdefault(first + i // each, []).append((offset + i % each * length, length))
            placed += 1
    assert placed == len(lengths)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) == plain_best_fit([n for n in lengths if n < 64], 64) + lengths.count(64)


def test_packing_against_the_library(spark, library):
    rows, df = frame(spark)
    want = []
    for d, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(d, i // 128, i, len(ids[i : i + 128]), zlib.crc32(ids[i : i + 128].tobytes())) for i in range(0, len(ids), 128)]
    got = [tuple(r) for r in packing.pack(df, capacity=128).collect()]
    assert sorted(r[:5] for r in got) == sorted(want)
    places = {}
    for *_, length, _, sequence, offset in got:
        places.setdefault(sequence, []).append((offset, length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    assert len(places) == plain_best_fit([w[3] for w in want if w[3] < 128], 128) + sum(w[3] == 128 for w in want)


def test_packing_in_many_groups(spark):
    rows = [(1, "a b c")] * 200 + [(i, "wort " * (i % 40)) for i in range(300)] + [(5, None)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = packing.pack(df, capacity=32, group=10).collect()
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 32
    lengths = [r.length for r in got]
    assert sum(lengths) == 200 * 4 + sum(i % 40 + 1 for i in range(300)) + 30
    assert len(places) == plain_best_fit([n for n in lengths if n < 32], 32) + lengths.count(32)


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
