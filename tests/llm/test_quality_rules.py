"""Quality rules: counts against a plain version, and the robust estimate against NumPy."""

import random
import re
from collections import Counter

import numpy as np

from canonlake.llm import quality_rules as qr


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def texts():
    rng = random.Random(2)
    pick = lambda k, v: "".join(rng.choice(v) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(k))
    small, large = ["a", "b", "É#", "<|>"], [f"w{k}" for k in range(400)]
    return [None, "", " \n\t", "one", "a a a a", "a b a b a b", "x\x0by\x0cz", *(pick(rng.randint(1, 120), rng.choice([small, large])) for _ in range(60)), pick(30_000, large), "same line here\n" * 40]


def test_counts_match_a_plain_version(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts())] + [(None, "a b", None, None, 2), (3, "one", "en", "s", 3)]
    out = qr.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int"))
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert all(not (r.base_failed and r.kept) for r in out.collect())


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("lo", "ven", "tar", "is")]
    rows = []
    for i in range(600):
        n = int(60 * 10 ** rng.random())
        body = " ".join(rng.choice(words) + ("$$$" if i % 20 == 0 else "") for _ in range(n))
        rows.append((i, body, ["en", "fr", None][i % 3], "s"))
    rows += [(1000 + k, " ".join(rng.choice(words) for _ in range(60)), "xx", f"rare{k}") for k in range(5)]
    out = {r.doc_id: r.kept for r in qr.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(out[i] for i in range(0, 600, 20))
    assert all(out[i] for i in range(600) if i % 20) and all(out[1000 + k] for k in range(5))


def test_distance_is_mahalanobis_and_estimate_is_robust(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(5, 5)) + 2 * np.eye(5)
    good = rng.normal(size=(800, 5)) @ mix
    bad = rng.normal(size=(120, 5)) + 60
    data = np.r_[good, bad]
    df = spark.createDataFrame([("g", *map(float, row)) for row in data], "grp string, " + ", ".join(f"{f} double" for f in qr.FEATURES))
    fitted = qr.fit_groups(df)
    p = fitted.first()
    mean = np.array([p[f"m{i}"] for i in range(5)])
    chol = np.array([[p[f"l{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    assert np.abs(mean - good.mean(axis=0)).max() < 1.0
    got = [r.d for r in df.join(fitted, "grp").select(qr._distance(fitted).alias("d"), *qr.FEATURES).collect()]
    want = [float(v @ np.linalg.inv(chol @ chol.T) @ v) for v in data - mean]
    assert np.allclose(sorted(got), sorted(want))


def test_no_rows_and_filter(spark):
    schema = "doc_id long, text string, lang string, source string, row long"
    empty = spark.createDataFrame([], schema)
    assert qr.quality_rules(empty).count() == 0
    long = " ".join(f"w{k}" for k in range(80))
    df = spark.createDataFrame([(1, long, "en", "s", 5), (1, long, "en", "s", 6), (2, "short", "en", "s", 7), (None, long, None, None, 8), (3, None, "en", "s", 9)], schema)
    kept = qr.kept_documents(df, qr.quality_rules(df))
    assert kept.columns == df.columns and sorted(r.row for r in kept.collect()) == [5, 6, 8]


def test_the_least_determinant_of_three_starts_counts(spark):
    """Two clusters, the larger of which is the tighter: the estimate is that of the tighter one, and another dealing of rows changes nothing."""
    rng = np.random.default_rng(4)
    data = np.r_[rng.normal(size=(780, 5)) * 0.5, rng.normal(size=(220, 5)) * 3 + 6]
    df = spark.createDataFrame([("g", *map(float, row)) for row in data], "grp string, " + ", ".join(f"{f} double" for f in qr.FEATURES))
    first, again = qr.fit_groups(df).first(), qr.fit_groups(df.repartition(5)).first()
    assert np.abs([first[f"m{i}"] for i in range(5)]).max() < 0.2
    assert np.allclose([first[c] for c in first.asDict() if c != "grp"], [again[c] for c in again.asDict() if c != "grp"])
    starts = qr._starts(df).collect()
    assert sorted(r.start for r in starts) == ["median", "moments", "signs"]


def test_small_groups_are_held_against_their_language_and_small_languages_against_all(spark):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("lo", "ven", "tar", "is")]
    body = lambda bad: " ".join(rng.choice(words) + ("$$$$" if bad else "") for _ in range(rng.randint(60, 300)))
    rows = [(i, body(False), "en", "big") for i in range(300)]
    rows += [(1000, body(True), "en", "tiny"), (1001, body(False), "en", "tiny"), (1002, body(True), "xx", "rare"), (1003, body(False), "xx", "rare")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.kept for r in qr.quality_rules(df).collect()}
    assert [out[i] for i in (1000, 1001, 1002, 1003)] == [False, True, False, True] and all(out[i] for i in range(300))
    few = {r.doc_id: (r.kept, r.distance) for r in qr.quality_rules(df.where("doc_id >= 1000")).collect()}
    assert all(k and d is None for k, d in few.values())  # too few of anything: the base rules alone


def test_clashing_columns_do_no_harm(spark):
    long = " ".join(f"w{k}" for k in range(80))
    df = spark.createDataFrame([(1, long, "en", "s", 5, 6, "g"), (2, "short", "en", "s", 7, 8, "g")], "doc_id long, text string, lang string, source string, __id int, row int, grp string")
    kept = qr.kept_documents(df, qr.quality_rules(df))
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [1]
