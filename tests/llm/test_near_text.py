"""Near copies by five-word shingles against brute force."""

import random

import corpus_pipeline
import pytest

from canonlake.llm import near_text, simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def similar(a, b):
    x, y = shingles(a), shingles(b)
    return 100 * len(x & y) >= 80 * len(x | y)


def brute_kept(docs):
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in docs:
        for j in docs:
            if i < j and similar(docs[i], docs[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i for i in docs if root(i) == i}


def edited(rng, words, times, vocabulary):
    out = list(words)
    for at in rng.sample(range(len(out)), times):
        out[at] = rng.choice(vocabulary)
    return out


def planted():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = [None, "", " \t", "One", "one ", "one two three four five", "one two three four six"]
    for n in (60, 120, 300, 700):
        for _ in range(6):
            base = [rng.choice(vocabulary) for _ in range(n)]
            texts += [" ".join(base), " ".join(base).upper()]
            texts += [" ".join(edited(rng, base, max(1, n * share // 1000), vocabulary)) for share in (5, 10, 15, 20, 25, 40)]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("stars", [0, 1, 3])
def test_one_of_each_matches_brute_force(spark, monkeypatch, stars):
    monkeypatch.setattr(near_text, "STARS", stars)
    monkeypatch.setattr(near_text, "BLOCK", 3)
    docs = planted()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in near_text.one_of_each(df).collect()} == brute_kept(docs)


def test_pipeline_stage_drops_near_copies_that_two_bits_miss(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(3000)]
    docs = []
    for k in range(20):
        base = [rng.choice(vocabulary) for _ in range(200)]
        docs += [(k, " ".join(base), "en", "s", 0), (100 + k, " ".join(edited(rng, base, 4, vocabulary)), "en", "s", 0)]
    texts = {d[0]: d[1] for d in docs}
    prints = {i: simhash.fingerprint(t.encode()) for i, t in texts.items()}
    copies = [k for k in range(20) if similar(texts[k], texts[100 + k])]
    assert len(copies) > 10 and sum((prints[k] ^ prints[100 + k]).bit_count() > 2 for k in copies) > 10
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, COLUMNS), "")
    assert {r.doc_id for r in kept.collect()} == set(texts) - {100 + k for k in copies}


def test_pipeline_stage_drops_what_fingerprints_alone_link(spark):
    # three-word shingles that come very often make nearly all of the fingerprint; five-word shingles, each counted once, differ
    rng = random.Random(3)
    docs = []
    for k in range(30):
        often, rare = [f"a{k}", f"b{k}", f"c{k}"] * 150, [[f"{side}{k}x{j}" for j in range(rng.choice((3, 5)))] for side in "pq"]
        docs += [(10 * k + n, " ".join(often + own), "en", "s", 0) for n, own in enumerate(rare)]
    docs += [(5, docs[0][1] + " tail", "en", "s", 0), (None, docs[0][1], "en", "s", 0)]
    near = lambda a, b: (simhash.fingerprint(a[1].encode()) ^ simhash.fingerprint(b[1].encode())).bit_count() <= 2
    named = [d for d in docs if d[0] is not None]
    linked = {b[0]: a[0] for a in named for b in named if a[0] < b[0] and near(a, b)}
    assert sum(not similar(a[1], b[1]) for a in named for b in named if linked.get(b[0]) == a[0]) > 5
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, COLUMNS), "")
    gone = {d[0] for d in named if d[0] in linked or any(e[0] < d[0] and similar(e[1], d[1]) for e in named)}
    assert {r.doc_id for r in kept.collect()} == {d[0] for d in docs} - gone


def test_empty_repeated_and_null_rows(spark):
    assert near_text.one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = "a b c d e f g"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "q r s t"), (0, None), (2, ""), (3, text.upper())], "doc_id long, text string")
    kept = sorted((str(r.doc_id) for r in near_text.one_of_each(df).collect()))
    assert kept == ["0", "1", "1", "None", "None"]


def test_unsupported_bits_are_rejected(spark):
    nodes = spark.createDataFrame([(1, 1)], "fp long, node long")
    for bits in (-1, 3, 11):
        with pytest.raises(ValueError):
            simhash.near_links(nodes, bits)
