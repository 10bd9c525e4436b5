"""Periodic runs against a search of every period at every place."""

import random
import re

import numpy as np
import pytest

from canonlake.llm import periodic_runs as pr

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, times=3):
    """(runs, kept words): for every period the stretches that it holds, as far as they go; each stretch under its smallest period."""
    found, n = {}, len(words)
    for period in range(1, n // times + 1):
        i = 0
        while i < n - period:
            if words[i] != words[i + period]:
                i += 1
                continue
            start = i
            while i < n - period and words[i] == words[i + period]:
                i += 1
            if i - start + period >= max(least, times * period):
                found.setdefault((start, i + period), period)
    runs = sorted((s, e - s, p) for (s, e), p in found.items())
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    return runs, [w for i, w in enumerate(words) if i not in dropped]


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t\x0b\f\r ", "one", "a " * 23, "a " * 24, "a\u00a0b " * 30, "b " * 24 + "c " + "b " * 30, "\u2003".join("xy") + " z " * 40]
    for _ in range(60):
        unit = [rng.choice("abcde") + rng.choice("xyÄ") for _ in range(rng.randint(1, 14))]
        around = lambda: [rng.choice("abcde") + rng.choice("xyÄ") for _ in range(rng.randint(0, 30))]
        run = (unit * 40)[: rng.randint(20, 90)]
        out.append(rng.choice([" ", "\n", "  "]).join(around() + run + around() + run[3:] + around()))
    for _ in range(20):  # few different words, so runs overlap and are nested
        out.append(" ".join(rng.choice("ab") for _ in range(rng.randint(20, 160))))
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 700:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(512))
    nested = (("ab" * 15 + "c") * 5 + "d") * 4
    return out + [" ".join(x) for x in (fibonacci[-1], morse, morse * 3, nested, nested[7:])]


def test_matches_a_plain_search(spark):
    docs = texts()
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(docs)], "doc_id long, text string, Runs string, period int").repartition(3)
    out = pr.periodic_runs(df)
    assert set(out.columns) == {"doc_id", "text", "period", "n_words", "runs", "collapsed"}
    rows = out.collect()
    assert len(rows) == len(docs)
    for r in rows:
        words = WORDS.findall(r.text or "")
        runs, kept = brute(words)
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(words), runs, " ".join(kept))
        assert r.period == 3


@pytest.mark.parametrize("least, times", [(2, 2), (24, 3), (10, 4), (1, 2)])
def test_other_lengths(least, times):
    rng = random.Random(least)
    docs = [[rng.choice("aab") for _ in range(rng.randint(0, 60))] for _ in range(60)]
    codes = np.array([ord(c) for d in docs for c in d])
    found = pr.find_runs(codes, np.array([len(d) for d in docs]), least, times)
    want = [(k, *run) for k, d in enumerate(docs) for run in sorted(brute(d, least, times)[0], key=lambda r: (r[0], r[2]))]
    assert [tuple(r) for r in found.tolist()] == want


def test_words_decide_where_hashes_err(monkeypatch):
    """With tiny moduli nearly every comparison of hashes goes wrong now and then; the words must catch each."""
    monkeypatch.setattr(pr, "PRIMES", (np.uint64(10007), np.uint64(10007)))
    rng = random.Random(2)
    docs = [[rng.choice("abcdef") for _ in range(80)] + list("abcdefg" * 5) for _ in range(3)]
    codes = np.array([ord(c) for d in docs for c in d])
    found = pr.find_runs(codes, np.array([len(d) for d in docs]))
    assert [tuple(r) for r in found.tolist()] == [(k, *run) for k, d in enumerate(docs) for run in brute(d)[0]]


def test_very_long_texts_blocks_and_groups(spark):
    long = ["w"] * 300_000
    mixed = [f"u{i}" for i in range(150_000)] + [f"v{i % 977}" for i in range(150_000)]
    rows = pr.periodic_runs(spark.createDataFrame([(0, " ".join(long)), (1, " ".join(mixed)), (2, "x")], "id int, text string").coalesce(1)).orderBy("id").collect()
    assert [tuple(x) for x in rows[0].runs] == [(0, 300_000, 1)] and rows[0].collapsed == "w"
    assert [tuple(x) for x in rows[1].runs] == [(150_000, 150_000, 977)] and rows[1].collapsed == " ".join(mixed[:150_977])
    assert rows[2].runs == [] and rows[2].n_words == 1


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b " * 20)] * 2 + [(None, "a b " * 20)], "doc_id long, text string")
    assert [[tuple(x) for x in r.runs] for r in pr.periodic_runs(df).collect()] == [[(0, 40, 2)]] * 3
    assert pr.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pr.periodic_runs(df, times=1)
