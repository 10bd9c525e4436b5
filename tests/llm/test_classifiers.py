"""Classifiers: held-out accuracy on small fixtures, the update rule, and the decoder against brute force."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from canonlake.llm import quality_classifier, toxicity
from canonlake.llm.ftrl import Ftrl

WORDS = ["river", "stone", "garden", "letter", "window", "summer", "market", "silver", "travel", "bridge", "winter", "people"]
BAD = ["loser", "idiot", "scum", "moron"]
EVEN = lambda i: i % 2 == 0


def obfuscated(rng, word):
    kind = rng.randrange(4)
    if kind == 0:
        return word
    if kind == 1:
        return word.translate(str.maketrans("oieas", "013@$"))
    if kind == 2:
        return " ".join(word)
    return word[:2] + word[1] * 4 + word[2:]


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(WORDS) for _ in range(60)]
        toxic = i % 4 in (1, 2)
        if toxic:
            for k in range(3):
                words.insert(rng.randrange(len(words)), obfuscated(rng, rng.choice(BAD)) if i % 2 else rng.choice(BAD))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = toxicity.toxicity_scores(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), EVEN)
    held = [(r.score, labels[r.doc_id][1]) for r in out.collect() if r.doc_id % 2]
    assert np.mean([(s >= 0.5) == t for s, t in held]) > 0.9


def test_quality_on_held_out_rows_and_edge_rows(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        words = [rng.choice(WORDS) + ("" if good else "###") for _ in range(rng.randint(20, 90))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    rows += [(1000, None), (1001, ""), (None, "river stone"), (1, rows[1][1])]
    labels += [(None, 1), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality_classifier.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int"), EVEN).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [(r.score, labels[r.doc_id][1]) for r in out if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 2]
    assert np.mean([(s >= 0.3) == bool(t) for s, t in held]) > 0.95


def test_no_rows_and_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality_classifier.quality_scores(none, labels, EVEN).count() == 0
    assert toxicity.toxicity_scores(none, labels, EVEN).count() == 0
    one = spark.createDataFrame([(1, "river")], "doc_id long, text string")
    assert quality_classifier.quality_scores(one, labels, EVEN).first().score == 0.5
    assert toxicity.toxicity_scores(one, labels, EVEN).first().score == 0.5


def test_long_texts_count_by_stretches(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(WORDS).upper() if rng.random() < 0.1 else rng.choice(WORDS) for _ in range(500)).encode()
    at, x = quality_classifier.features(text)
    monkeypatch.setattr(quality_classifier, "STRETCH", 37)
    cut_at, cut_x = quality_classifier.features(text)
    assert (at == cut_at).all() and np.allclose(x, cut_x) and np.isclose((x * x).sum(), 1)


def test_updates_follow_the_closed_form():
    rng = np.random.default_rng(0)
    model, n, sums = Ftrl(5, 0.3, 0.2, 0.1), np.zeros(6), np.zeros(6)
    for _ in range(50):
        at = rng.choice(5, 2, replace=False)
        x, label = rng.normal(size=2), int(rng.integers(2))
        places, values = np.append(at, 5), np.append(x, 1.0)
        w = model.weights(slice(None)).copy()
        g = np.zeros(6)
        g[places] = (1 / (1 + np.exp(-(w[places] @ values))) - label) * values
        sums += g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.3 * w
        n += g * g
        model.learn(at, x, label)
    want = np.where(np.abs(sums) <= 0.2, 0, -(sums - np.sign(sums) * 0.2) / ((1 + np.sqrt(n)) / 0.3 + 0.1))
    assert np.allclose(model.weights(slice(None)), want)


def test_viterbi_finds_the_best_path():
    model = np.log(np.random.default_rng(4).dirichlet(np.ones(28), (28, 28)))
    decoder = toxicity.Decoder(model)
    for span in ("l0s3r", "1d10t", "m.o.r.0.n", "cllllown", "5cuuum", "a$$", "s--t u p", "stuupid!!"):
        best = None
        for path in itertools.product(*decoder._lattice(span)):
            text, total, x, y = "".join(t for t, _ in path), sum(c for _, c in path), 0, 0
            for z in [toxicity._CODES[ord(c)] for c in text] + [0]:
                total, x, y = total + model[x][y][z], y, z
            best = max(best or (total, text), (total, text))
        assert decoder.read(span.encode()).decode() == best[1]


def test_model_counts_every_trigram(spark):
    docs = spark.createDataFrame([("aab " * 50,), (None,), ("AAB",)], "text string")
    model = np.exp(toxicity.character_model(docs, "text"))
    assert np.allclose(model.sum(axis=2), 1) and model[1, 1, 2] > 0.9
    assert docs.select(F.count("text")).first()[0] == 2


def test_spans_reach_the_lattice_whole():
    whole = ["a$$", "$h!+", "f u k", "s - t__u p", "stuupid", "1d10t", "l.o.s.e.r", "idiiiot", "worthle$$"]
    assert [m.group().decode() for w in whole for m in toxicity.SPANS.finditer(f"so {w}, yes".encode())] == whole
    assert not toxicity.SPANS.search(b"plain words! 12 3.5 and more")


def test_a_separator_may_end_a_word():
    assert toxicity.Decoder._lattice("a b c")[1] == [("", toxicity.PUT_IN), (" ", toxicity.MEANT)]


def edge_rows():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(WORDS + BAD * (i % 2)) for _ in range(40))) for i in range(120)]
    return rows + [(1000, None), (1001, ""), (None, "river scum"), (3, rows[3][1]), (3, "other words"), (1002, "m0r0n " * 400_000), (1003, "a " * 1_000_000)]


def test_edge_rows_through_both_classifiers(spark):
    rows = [(i, t, 7, "x", 1.0) for i, t in edge_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, `order` string, score double").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(120)] + [(None, 1, 1), (2, None, None), (4, 0, 0)], "doc_id long, toxic int, quality int")
    for scores in (toxicity.toxicity_scores, quality_classifier.quality_scores):
        first = scores(docs, labels, lambda i: i % 3 != 1)
        assert first.columns == ["doc_id", "score"]
        out = sorted(map(tuple, first.collect()), key=str)
        assert len(out) == len(rows) and all(0 <= s <= 1 for _, s in out)
        score = dict(out)
        assert score[1000] == score[1001]  # null and empty texts: the bias alone
        again = sorted(map(tuple, scores(docs.repartition(7), labels, lambda i: i % 3 != 1).collect()), key=str)
        assert out == again  # however rows are dealt out
