import random
import re

from pyspark.sql import functions as F

from lexigraph.llm import jaccard_join as jj
from lexigraph.llm.common import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {" ".join(words)} - {""}
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, _) in enumerate(rows):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(d), find(rows[j][0])
                root[max(a, b)] = min(a, b)
    return sorted((d, len(s), find(d)) for (d, _), s in zip(rows, sets))


def changed(rng, words):
    words = list(words)
    for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words = words[:-1] or words
        elif kind < 0.6:
            words = words[1:] or words
        elif kind < 0.8:
            words[at] = "new" + str(rng.randrange(99))
        else:
            words.append(rng.choice("xyz"))
    return " ".join(words)


def texts(seed, lengths, bases, copies):
    rng = random.Random(seed)
    out = []
    for _ in range(bases):
        base = [rng.choice("abcdefg") + str(rng.randrange(30)) for _ in range(rng.choice(lengths))]
        out += [changed(rng, base) for _ in range(copies)]
    return out


def check(spark, found, **options):
    rows = list(enumerate(found, 1))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("clash"), "component_id": F.lit(3), "fp": F.lit(1)})
    got = sorted(tuple(r) for r in jj.near_duplicates(df, **options).collect())
    assert got == brute(rows)


def test_small_sets_against_brute_force(spark):
    edge = [None, "", "  \t\n", "a", "A", "a b", "b a", "a b c d", "a b c d", "Ä b c d e", "ä b c d e", "a b c d e f"]
    check(spark, edge + texts(3, [5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 18, 20], 40, 6))


def test_long_sets_and_shared_passages_against_brute_force(spark):
    rng = random.Random(5)
    passage = " ".join(rng.choice("pqrst") + str(rng.randrange(99)) for _ in range(60))
    some = texts(8, [40, 80, 150, 400], 15, 5)
    some += [passage + " " + t for t in texts(9, [20, 60], 30, 1)] + [passage] * 3
    check(spark, some)


def test_group_of_near_copies_larger_than_a_cell(spark):
    rng = random.Random(2)
    base = ["w" + str(rng.randrange(10_000)) for _ in range(120)]
    some = []
    for _ in range(400):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            words[rng.randrange(len(words))] = "v" + str(rng.randrange(10_000))
        some.append(" ".join(words))
    check(spark, some)


def test_clusters_of_many_cells_and_roots(spark, monkeypatch):
    """Groups of near copies, chains that no hub meets whole, and texts that share passages, in cells of eight sets."""
    monkeypatch.setattr(jj, "CELL", 8)
    rng = random.Random(12)
    word = lambda: "w" + str(rng.randrange(10_000))
    shared = [[word() for _ in range(45)] for _ in range(3)]
    some = []
    for _ in range(40):
        some.append(" ".join(w for p in rng.sample(shared, 2) for w in p))
        some.append(" ".join(rng.choice(shared) + [word() for _ in range(rng.choice([2, 4, 8, 30]))]))
    chain = [word() for _ in range(60)]
    for _ in range(60):
        chain = chain[1:] + [word()]
        some += [" ".join(chain)] * rng.choice([1, 1, 2])
    base = [word() for _ in range(80)]
    for _ in range(120):
        words = list(base)
        for _ in range(rng.choice([1, 2, 6])):
            words[rng.randrange(len(words))] = word()
        some.append(" ".join(words))
    check(spark, some)


def test_filters_that_overflow_keep_the_result(spark):
    check(spark, texts(4, [12, 30, 60], 40, 4), max_bits=64)


def test_empty_table(spark):
    assert jj.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_keep_a_row_each(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jj.near_duplicates(df).collect()) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_boundary_follows_cost():
    assert jj.choose_boundary({}, 1.0) == 0
    cheap = jj.choose_boundary({4: 1000, 5: 1000, 14: 1}, 50.0)
    dear = jj.choose_boundary({14: 1000}, 0.1)
    assert cheap >= 5 and dear < 14


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7)], "u long, v long")
    got = dict(map(tuple, components(edges, []).collect()))
    assert all(got[i] == 1 for i in range(1, 61)) and got[100] == got[101] == 100 and len(got) == 62
