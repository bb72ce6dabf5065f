import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from lexigraph.llm import language, quality, toxicity
from lexigraph.llm.toxicity import Lexicon, Matcher, budget

DOCS = "doc_id long, text string, lang string, score string, label int, held_out int"


def never():
    return F.lit(False)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_automaton_finds_what_plain_edit_distance_finds():
    terms = {"idiot": 3.0, "worthless": 2.0, "scum": 4.0, "lowei*": 5.0, "lostra*": 1.0}
    lexicon, rng = Lexicon(terms), random.Random(1)
    words = []
    for t in list(terms) * 60:
        w = list(t.rstrip("*") + ("ent" if t[-1] == "*" and rng.random() < 0.7 else ""))
        for _ in range(rng.randrange(4)):
            at, kind = rng.randrange(len(w) or 1), rng.randrange(3)
            if kind == 0:
                w.insert(at, rng.choice("abcdeilos"))
            elif w:
                w[at : at + 1] = [] if kind == 1 else [rng.choice("abcdeilos")]
        words.append("".join(w))
    for w in words:
        want = None
        for t, weight in terms.items():
            plain = t.rstrip("*")
            d = min(edits(w[:n], plain) for n in range(len(w) + 1)) if t[-1] == "*" else edits(w, plain)
            if d <= budget(t) and (want is None or (d, -weight) < (want[1], -want[0])):
                want = (weight, d)
        assert lexicon.match(w) == want, w
        if want:
            assert lexicon.near(w), w


def test_quotation_and_density_change_the_window_score():
    m = Matcher(Lexicon({"idiot": 3.0, "scum": 3.0}))
    abuse, quoted = m.features("you idiot you scum get out"), m.features('the word "idiot" and the word "scum" are rude')
    one = m.features("the idiot came along and then nothing more was heard of it by anybody until the scum left")
    assert abuse[3] > one[3] > quoted[3] and quoted[2] > 0 and abuse[2] == 0
    assert not m.features("nothing here").any() and not m.features("").any()


def words(rng, n):
    return " ".join(rng.choice(["al", "be", "co", "du"]) + rng.choice(["ra", "ti", "mo", "len"]) + rng.choice(["", "s", "x", "na"]) for _ in range(n))


def test_toxicity_learns_and_keeps_every_row(spark):
    rng, rows, labels = random.Random(1), [], []
    for i in range(600):
        bad = i % 5 == 0
        text = words(rng, 60).split()
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(60), rng.choice(["idiot", "moron", "worthless", "scum"]))
        rows.append((i, " ".join(text), None, "x", 1, 0))
        labels.append((i, int(bad)))
    rows += [(1000, None, None, "x", 1, 0), (1001, "", None, "x", 1, 0), (1001, "", None, "x", 1, 0), (1002, "such an idi0t and a worthles moran " + words(rng, 30), None, None, None, None)]
    labels += [(1000, None), (5, 1), (77, 0)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = F.col("doc_id") % 4 == 0
    got = {r.doc_id: r for r in toxicity.score(docs, marks, held).collect()}
    assert len(got) == 603 and toxicity.score(docs, marks, held).count() == 604
    test = [r for i, r in got.items() if i < 600 and i % 4 == 0]
    assert all(r.held_out for r in test) and np.mean([r.predicted == (r.doc_id % 5 == 0) for r in test]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert got[1000].predicted == got[1001].predicted == 0 and got[1002].hits >= 2


def test_rows_that_repeat_change_nothing_that_is_learned(spark):
    rng, rows, labels = random.Random(4), [], []
    for i in range(300):
        text = words(rng, 50).split()
        if i % 5 == 0:
            for _ in range(3):
                text.insert(rng.randrange(50), rng.choice(["idiot", "moron", "worthless", "scum"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    frames = lambda n: (spark.createDataFrame(rows * n, "doc_id long, text string").repartition(3), spark.createDataFrame(labels * n, "doc_id long, toxic int"))
    held = F.col("doc_id") % 4 == 0
    once, twice = ({(r.doc_id, r.predicted, round(r.score, 9)) for r in toxicity.score(*frames(n), held).collect()} for n in (1, 2))
    assert once == twice and {p for _, p, _ in once} == {0, 1}
    assert toxicity.score(*frames(2), held).count() == 600


def test_copies_count_once_a_label(spark):
    rng = random.Random(5)
    base, other = words(rng, 120).split(), words(rng, 120).split()
    near = base[:60] + ["neu"] + base[61:]
    most = base[:100] + other[100:]
    rows = [(1, " ".join(base), 1), (2, " ".join(near), 1), (3, " ".join(near), 0), (4, " ".join(most), 1), (5, " ".join(other), 1), (6, None, 0), (7, "", 0)]
    kept = {r.row for r in toxicity.without_copies(spark.createDataFrame(rows, "row long, text string, label int"), "text").collect()}
    assert kept == {1, 3, 5, 6, 7}  # the fourth has most of the first, so that the fifth meets none that stays


def plain_features(text, weights):
    """The documented features, by plain edit distances for each word."""
    found = lambda w: min(((d, -weights[t]) for t in weights for d in [min(edits(w[:n], t.rstrip("*")) for n in range(len(w) + 1)) if t[-1] == "*" else edits(w, t)] if d <= budget(t)), default=None)
    low, spots, at, quoted, lately = text.lower(), [], 0, False, -99
    for token in re.findall(r"\w+(?:[*@$]+\w+)*|[\"“”„«»]", low):
        if token in '"“”„«»':
            quoted = token in "“„«" or (token == '"' and not quoted)
            continue
        if token in toxicity._REPORTS:
            lately = at
        hit = found(token)
        if hit:
            spots.append((at, -hit[1], hit[0], quoted or at - lately <= 3))
        at += 1
    sums, top = [0.0, 0.0, 0.0], 0.0
    for i, (p, weight, d, mention) in enumerate(spots):
        near = sum(abs(q[0] - p) <= 8 for q in spots[max(0, i - 5) : i + 6]) - 1
        sums[2 if mention else 1 if d else 0] += weight
        top = max(top, weight * (0.3 if mention else 0.7 if d else 1.0) * (1 + 0.2 * near))
    return [*(math.log1p(s) for s in sums), top, math.log1p(100 * len(spots) / max(at, 1)), math.log1p(len(spots))]


def test_features_against_a_plain_version():
    rng, weights = random.Random(8), {"idiot": 3.0, "worthless": 2.0, "scum": 4.0, "lowei*": 5.0}
    m = Matcher(Lexicon(weights))
    for _ in range(60):
        text = words(rng, rng.randrange(30)).split()
        for _ in range(rng.randrange(6)):
            text.insert(rng.randrange(len(text) + 1), rng.choice(["idiot", "idoit", "worthles", "SCUM", "loweient", "said", '"', "„", "“", "quoted"]))
        np.testing.assert_allclose(m.features(" ".join(text)), plain_features(" ".join(text), weights))


def test_lexicon_is_the_same_however_many_tasks_read_the_sample(spark):
    rows = [(f"achly plain{i} words", 1) for i in range(12)] + [(f"scum other{i} words", 1) for i in range(12)] + [(f"achly clean{i} text", 0) for i in range(30)] + [(f"clean{i} more text", 0) for i in range(270)]
    df = spark.createDataFrame(rows, "text string, label int")
    one, many = (toxicity.learn_lexicon(df.repartition(n), "text", 24, 300, 4000).weights for n in (1, 60))
    assert one == many and "scum" in one and not any(t.startswith("achl") for t in one)


def test_classifiers_without_labels_or_rows(spark):
    docs, none = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {r.score for r in quality.score(docs, none, never()).collect()} == {0.5}
    assert all(r.predicted == 0 for r in toxicity.score(docs, none, never()).collect())
    empty = docs.limit(0)
    assert quality.score(empty, none, never()).count() == toxicity.score(empty, none, never()).count() == 0


def test_quality_separates_junk(spark):
    rng, rows, labels = random.Random(2), [], []
    for i in range(400):
        text = words(rng, rng.randrange(20, 200))
        if i % 4 == 0:
            text = " ".join(w + "$$$" for w in text.split()) if i % 8 else text.upper().replace(" ", "!! ")
        rows.append((i, text, None, None, 7, None))
        labels.append((i, int(i % 4 != 0)))
    rows += [(900, None, None, None, 7, None), (901, "", None, None, 7, None), (902, "Ä" * 100_000, None, None, 7, None), (1, rows[1][1], None, None, 7, None)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(3, None)], "doc_id long, quality int")
    got = quality.score(docs, marks, F.col("doc_id") % 3 == 0).collect()
    assert len(got) == 404 and all(0 <= r.score <= 1 for r in got)
    test = [r for r in got if r.doc_id < 400 and r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in test]) > 0.97
    kept = quality.keep_good(docs, marks, F.col("doc_id") % 3 == 0)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.predicted)


def test_discriminant_is_the_gaussian_log_ratio():
    rng = np.random.default_rng(0)
    x = [rng.normal(0, 1, (300, 3)), rng.normal(1, 2, (200, 3))]
    d = quality.Discriminant(np.array([300.0, 200.0]), np.stack([a.sum(0) for a in x]), np.stack([a.T @ a for a in x]), 0.0, 0.0)
    probe = rng.normal(0, 2, (20, 3))
    logs = []
    for a, share in zip(x, (0.6, 0.4)):
        c = np.cov(a.T, bias=True)
        z = probe - a.mean(0)
        logs.append(np.log(share) - 0.5 * np.log(np.linalg.det(c)) - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z))
    assert np.allclose(d.posterior(probe), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_language(spark):
    rng = random.Random(3)
    vocab = {"en": ["the", "and", "thing", "with", "ough"], "de": ["und", "sch", "über", "keit", "die"], "fr": ["eaux", "que", "ètre", "les", "ion"]}
    rows = [(i, " ".join(rng.choice(vocab[x]) + rng.choice(vocab[x]) for _ in range(rng.randrange(5, 80))), x) for i, x in enumerate(list(vocab) * 100)]
    rows += [(900, None, "en"), (901, "12 !! --", "de"), (902, "", None), (903, "UND DIE ÜBERSCHKEIT KEITSCH", None), (3, rows[3][1], "en")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, score int, lang_pred string")
    got = language.identify(docs, F.col("doc_id") % 5 == 0).collect()
    assert len(got) == 305
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[900].score == 0 and by[903].lang_pred == "de"
    assert all(by[i].lang_pred == x for i, _, x in rows[:300]) and all(0 <= r.score <= 1 for r in got)
    none = language.identify(docs.withColumn("lang", F.lit(None).cast("string")), never()).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language.identify(docs.limit(0), never()).count() == 0


def test_clusters_are_unit_vectors():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(c, 0.05, (40, 3)) for c in np.eye(3)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    c = language.cluster(v, 3)
    assert np.allclose(np.linalg.norm(c, axis=1), 1) and sorted((c @ np.eye(3)).argmax(1)) == [0, 1, 2]


def test_letters():
    assert language.has_letter("12 ß") and language.has_letter("日") and not language.has_letter("12 ² Ⅷ!") and not language.has_letter("")


def test_nearest_centroid_against_a_plain_version(spark):
    rng = random.Random(9)
    kinds = {"aa": ["lo", "mi", "na"], "bb": ["sch", "ung", "er"], "cc": ["ñ", "ció", "os"]}
    say = lambda k, n: " ".join("".join(rng.choice(kinds[k]) for _ in range(3)) for _ in range(n))
    texts = [(k, say(k, rng.randrange(5, 40))) for k in kinds for _ in range(40)]
    rows = language.counts([t for _, t in texts]).astype(np.float32)
    model = language.Centroids([k for k, _ in texts], rows, 3, 0.001)
    centroids = [(name, c) for name, some in zip(model.names, model.centroids) for c in some]
    for k, t in [(k, say(k, 12)) for k in kinds for _ in range(10)] + [("aa", "lomina sch ung")]:
        data = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in f" {t.lower()} ".encode())
        counted = {}
        for n, shift in ((2, 0), (3, 1 << 25)):
            for i in range(len(data) - n + 1):
                cell = ((int.from_bytes(data[i : i + n], "big") + shift) * 2654435761 % (1 << 32)) >> 20
                counted[cell] = counted.get(cell, 0) + 1
        seen = {c: (rows[:, c] > 0).sum() for c in counted}
        v = {c: math.log1p(x) * (math.log((1 + len(texts)) / (1 + seen[c])) + 1) for c, x in counted.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        cosine = {name: max(sum(x * c[i] for i, x in v.items()) / size for n, c in centroids if n == name) for name in model.names}
        top = max(cosine.values())
        parts = {n: math.exp(25 * (x - top)) for n, x in cosine.items()}
        which, score, nearest = model.nearest(language.counts([t]))
        assert model.names[which[0]] == max(cosine, key=cosine.get)
        assert abs(nearest[0] - top) < 1e-6 and abs(score[0] - max(parts.values()) / sum(parts.values())) < 1e-5


def plain_statistics(text):
    """The documented statistics, text by text."""
    data = text.encode()
    words_ = re.findall(rb"[^\x20\x09-\x0d]+", data)
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words_]
    out = [math.log1p(len(words_))] + [0.0] * (len(quality.STATISTICS) - 1)
    for i, some in enumerate(quality._CLASSES.values()):
        out[2 + i] = math.log(sum(b in some for b in data) / max(len(data), 1) + 1e-3)
    tail = [0.0] * 5
    if words_:
        sizes = [len(w) for w in words_]
        out[1] = math.log(np.mean(sizes))
        lines = [x for x in data.split(b"\n") if x.strip()]
        runs = list(zip(low, low[1:], low[2:]))
        tail = [len(set(low)) / len(low), len(set(runs)) / len(runs) if runs else 1, len(set(lines)) / len(lines), sum(x <= 3 for x in sizes) / len(sizes), math.log1p(np.std(sizes))]
    n = 2 + len(quality._CLASSES)
    return out[:n] + [-math.log(1.02 - x) for x in tail[:3]] + tail[3:]


def test_statistics_against_a_plain_version():
    rng = random.Random(10)
    texts = ["", " ", "a", "Zwei Wörter", "A\nA\n\nb b", "$$$ 12 !!", "ß é\t x"] + [words(rng, rng.randrange(1, 80)).replace(" m", "\nM") + rng.choice(["", " ", "!", " 1"]) for _ in range(40)]
    np.testing.assert_allclose(quality.measured([t.encode() for t in texts] + [None]), [plain_statistics(t) for t in [*texts, ""]], rtol=1e-5, atol=1e-5)
