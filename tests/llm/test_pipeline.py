import random

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = f"file://{tmp_path_factory.mktemp('sf')}"
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(["the", "of", "ering", "onth", "blea", "stand", "thereof"]) + rng.choice(["", "s", "ly", "nd", "re"]) + str(rng.randrange(30)) * (rng.random() < 0.02) for _ in range(n))
    items = [(i, say(30)) for i in range(5)]
    docs, labels = [], []
    for i in range(200):
        text = say(rng.randrange(40, 120))
        bad = i % 10 == 3
        if bad:
            text = " ".join(w + "$$$" for w in text.split())
        docs.append([i, text, "en", "src1", len(text)])
        labels.append((i, int(not bad), 0))
    docs[20][1] = docs[10][1]
    docs[21][1] = docs[10][1] + " end"
    docs[30][1] += " " + items[2][1]
    docs[40][1] += " card 4111111111111111 of mine"
    docs += [[300, None, None, None, None], [301, "", "en", "src1", 0], [302, docs[50][1] + " " + say(3), "en", "src1", 1]]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_keep_the_right_documents(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        docs = corpus_pipeline.staged(docs, name)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    good, one, clean, private = seen.values()
    assert not {i for i in range(200) if i % 10 == 3} & good.keys() and len({i for i in range(200) if i % 10 != 3} - good.keys()) <= 2
    assert 10 in one and 20 not in one and 21 not in one and 302 not in one and 50 in one
    assert one.keys() - clean.keys() == {30}
    assert "4111111111111111" not in private[40] and private.keys() == clean.keys() and all(private[i] == clean[i] for i in clean if i != 40)


def test_run_ends_with_the_packing_of_what_is_left(spark, folder):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
    assert 30 not in {r.doc_id for r in rows} and 40 in {r.doc_id for r in rows}


def test_keys_of_pseudonyms(spark, folder):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "4111111111111111", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    stage = lambda: corpus_pipeline.without_personal_data(spark, docs, folder).first().text
    spark.conf.unset(corpus_pipeline.KEY)
    one = stage()
    assert one == stage() and len(spark.conf.get(corpus_pipeline.KEY)) == 64  # no key that others know, one for the session
    spark.conf.unset(corpus_pipeline.KEY)
    assert stage() != one
    spark.conf.set(corpus_pipeline.KEY, "mine")
    corpus_pipeline.run(spark, folder, "another")
    assert spark.conf.get(corpus_pipeline.KEY) == "mine"
    spark.conf.unset(corpus_pipeline.KEY)


def test_stages_on_an_empty_table(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        assert docs.count() == 0


def test_repeated_rows_stay_once(spark, folder):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, None)], "doc_id long, text string, fp string")
    got = corpus_pipeline.one_of_each(spark, docs, folder)
    assert sorted(map(tuple, got.select("doc_id", "fp").collect()), key=str) == [(1, "x"), (3, None)]


def test_null_and_repeated_ids(spark, folder):
    import corpus_pipeline

    say = lambda c, n=40: " ".join(f"{c}{i}" for i in range(n))
    rows = [(None, say("a")), (None, say("b")), (None, say("c")), (None, None), (9, say("c")), (1, say("d")), (1, say("d") + " end"), (2, say("d")), (3, say("e")), (4, say("f")), (4, say("e")), (5, say("g")), (5, say("h")), (5, say("h"))]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    got = {r.n for r in corpus_pipeline.one_of_each(spark, docs, folder).collect()}
    # null ids stay unless a numbered copy is there; of d one with id 1; e of id 3; f and both texts of id 5, the repeated one once
    assert got - {5, 6, 12, 13} == {0, 1, 3, 4, 8, 9, 11} and len(got & {5, 6}) == len(got & {12, 13}) == 1


def test_registered(spark):
    from lexigraph.llm.queries import QUERIES

    assert [q for q in QUERIES if q.startswith("op")] and sorted({int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")}) == list(range(1, 14)) and "pipeline" in QUERIES
    assert F is not None


def test_stages_with_clashing_columns_and_a_very_long_text(spark, folder):
    import corpus_pipeline

    rng = random.Random(9)
    long = " ".join(rng.choice(["the", "of", "ering", "onth", "blea"]) + rng.choice("abcdefg") + str(rng.randrange(900)) for _ in range(150_000))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(900, long, "en", "src1", len(long)), (901, long + " end", "en", "src1", len(long))], docs.schema))
    odd = ["row", "component_id", "id", "n", "first", "__stays", "__pairs", "label", "stats", "nr", "salt", "rank"]
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in odd})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        assert docs.columns == columns and docs.where(" or ".join(f"`{c}` <> 'own {c}'" for c in odd)).count() == 0, name
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert 901 not in kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept
