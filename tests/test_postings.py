import random

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import dictionary, index
from lexigraph.streaming import postings as ps

WORDS = ["haus", "hausbau", "größe", "straße", "baum", "kurz", "abababab", "über", "ringe", "ring"]


def listed(df):
    return sorted((r.term, tuple(r.parts)) for r in df.collect())


def rebuilt(spark, state, most=2):
    df = spark.createDataFrame([(p, t) for p, t in state.values()], "part string, text string")
    return listed(index.inverted_index(df, F.col("text"), "part", most_parts=most, stop=()))


def test_any_changes_equal_a_rebuild(spark, tmp_path):
    rng, state, path = random.Random(7), {}, f"file://{tmp_path}/p"
    for number in range(7):
        changes = []
        for version in range(rng.randrange(1, 9)):
            key = str(rng.randrange(8))
            if rng.random() < 0.3:
                changes.append((key, None, None, version))
                state.pop(key, None)
            else:
                part, text = rng.choice("xyz"), " ".join(rng.choices(WORDS, k=rng.randrange(4)))
                changes.append((key, part, text, version))
                state[key] = part, text
        df = spark.createDataFrame(changes, "key string, part string, text string, version int")
        ps.apply(spark, path, number, df)
        if rng.random() < 0.5:
            ps.apply(spark, path, number, df)  # again, as after a failure
        if number in (2, 5):
            ps.compact(spark, path)
        assert listed(ps.current_index(spark, path)) == rebuilt(spark, state)
        assert {(r.key, r.part) for r in ps.records(spark, path).collect()} == {(k, p) for k, (p, _) in state.items()}
    assert all(r.n > 0 for r in ps.postings(spark, path).collect())


def test_a_term_comes_back_under_the_cap(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    say = lambda *rows: spark.createDataFrame(rows, "key string, part string, text string, version int")
    ps.apply(spark, path, 0, say(("1", "a", "haus", 0), ("2", "b", "haus", 0), ("3", "c", "haus haus", 0)))
    assert listed(ps.current_index(spark, path)) == []
    ps.apply(spark, path, 1, say(("3", None, None, 0)))
    assert listed(ps.current_index(spark, path)) == [("haus", ("a", "b"))]
    ps.apply(spark, path, 2, say(("2", "a", "haus", 0)))
    assert listed(ps.current_index(spark, path)) == [("haus", ("a",))]


def test_a_stream_of_changes(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    schema = "key string, part string, text string, version int"
    path, at = f"file://{tmp_path}/p", f"file://{tmp_path}/at"
    for rows in ([("1", "a", "haus", 0)], [("1", "b", "baum", 1), ("2", "b", "ring", 1)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        ps.follow(spark.readStream.schema(schema).json(source), path, at).awaitTermination()
    assert listed(ps.current_index(spark, path)) == [("baum", ("b",)), ("ring", ("b",))]
    assert listed(ps.current_index(spark, f"file://{tmp_path}/none")) == []


@pytest.mark.parametrize("searched", [["haus"], ["HAUSB", "ß"], ["s"], ["au", "zzz"], ["ababa"], ["usba", " ringe "], ["zzzz"], [" "], ["hausbaum"]])
def test_stored_and_rebuilt_index_agree(spark, tmp_path_factory, searched):
    rows = [("s1", "a", "haus hausbau größe"), ("s1", "b", "straße baum haus"), ("s1", "c", "abababab über haus"), ("s2", "a", "haus ringe ring")]
    found = index.inverted_index(spark.createDataFrame(rows, "shard string, part string, text string"), F.col("text"), "part", ["shard"], stop=())
    path = f"file://{tmp_path_factory.mktemp('d')}/d"
    dictionary.store(found, "shard", path)
    d = dictionary.Dictionary(spark, path, "shard")
    for shard in ("s1", "s2", "s3"):
        want = {tuple(r) for r in index.route(found.where(F.col("shard") == shard), searched).collect()}
        assert {tuple(r) for r in d.route(shard, searched).collect()} == want
    plan = d.candidates("s1", ["hausbau"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "PushedFilters: [IsNotNull(gram), EqualTo(gram," in plan


def test_a_long_list_of_quotes(spark):
    from lexigraph.operators import match

    rng = random.Random(11)
    words = [f"wort{i}" for i in range(300)]
    texts = [(i, "Gemeinsamer langer Vorspann steht überall. " + " ".join(rng.choices(words, k=200))) for i in range(200)]
    quotes = [(i, " ".join(texts[i % 200][1].split()[j : j + 7])) for i in range(300) for j in (3, 40, 90)] + [(9000 + i, "Gemeinsamer langer Vorspann steht überall " + str(i)) for i in range(30_000)]
    a, b = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame(quotes, "k int, q string")
    got = {(r.id, r.q) for r in match.contained(a, "t", b, "q", most_bytes=0).collect()}
    assert got == {(i, q) for i, t in texts for q in {q for k, q in quotes if k < 9000} if q in t}


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
def test_longest_beginnings_over_all_blocks(spark, most_bytes):
    from lexigraph.operators import match

    rng = random.Random(13)
    say = lambda n: "".join(rng.choices("abü ", k=n))
    blocks = [say(rng.randrange(40)) for _ in range(30)] + [None, ""]
    needles = [say(rng.randrange(1, 14)) for _ in range(40)] + ["", "aaaa", "aaab", "zab", None]
    got = match.located_prefixes(spark.createDataFrame([(n,) for n in needles + needles], "n string"), "n", spark.createDataFrame([(b,) for b in blocks], "b string").repartition(3), "b", most_bytes)
    want = {n: max((n[:i] for i in range(len(n) + 1) if i == 0 or any(n[:i] in b for b in blocks if b)), key=len) for n in needles if n is not None}
    assert {r.needle: r.prefix for r in got.collect()} == want


def test_an_index_is_built_once_for_its_store(spark, tmp_path, counted):
    same, seen = counted
    found = spark.range(40).select(F.lit("s").alias("shard"), same(F.concat(F.lit("wort"), F.col("id"))).alias("term"), F.array(F.lit("a")).alias("parts"))
    dictionary.store(found, "shard", f"file://{tmp_path}/d")
    assert seen() == 40
    d = dictionary.Dictionary(spark, f"file://{tmp_path}/d", "shard")
    assert d.counts.where("gram = 'wor'").first().n == 40 and d.terms.where("gram = 't3'").count() == 11
