"""Collocations against a plain count of all phrases, and the counting within a task."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from canonlake.llm import phrases

CUT, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def pieces(text):
    return [WORD.findall(p) for p in CUT.split(lower(text or ""))]


def brute(docs, max_words=5, min_count=100, share=100, top=2000):
    """Rows of the result for (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        of = counts.setdefault(lang, Counter())
        for words in pieces(text):
            totals[lang] += len(words)
            for m in range(1, max_words + 1):
                of.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, of in counts.items():
        frequent = {g: a for g, a in of.items() if len(g) > 1 and a >= min_count}
        rows = []
        for g, a in frequent.items():
            inside = lambda h: len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))
            if any(inside(h) and 100 * f >= share * a for h, f in frequent.items()):
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (of[g[:k]] * of[g[k:]]), k, of[g[:k]], of[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed=3, n=80):
    rng = random.Random(seed)
    words = ["The", "of", "ÄPFEL", "éa", "x-y", "red", "wine", "\u00a0", "a\u2028b"]
    docs = [(None, None), ("en", ""), ("en", " \t "), ("en", "...!?"), (None, "solo"), ("", "a b. a b")]
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " of the RED wine "]) for _ in range(rng.randint(1, 60)))
        docs.append((rng.choice(["en", "en", "fr", None]), text))
    return docs + docs[-3:]


def got(df, **options):
    return sorted(map(tuple, phrases.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_matches_a_plain_count(spark):
    docs = corpus()
    df = spark.createDataFrame([(k, t, lang, "x", 5) for k, (lang, t) in enumerate(docs)], "doc_id int, text string, lang string, phrase string, n int").repartition(3)
    for options in ({"min_count": 5}, {"min_count": 3, "max_words": 4, "share": 60, "top": 7}, {"min_count": 2, "max_words": 2}):
        want = brute(docs, **options)
        assert len(want) > 10 and got(df, **options) == want


def test_other_kinds_of_language_and_no_rows(spark):
    df = spark.createDataFrame([(7, "a b a b a b")], "lang int, text string")
    assert got(df, min_count=2) == brute([("7", "a b a b a b")], min_count=2)
    assert got(df.limit(0)) == []
    assert got(df, min_count=100) == []


def test_a_text_with_a_very_long_word_and_very_many(spark):
    docs = [("en", "z" * 500_000 + " q " + "go on now " * 50_000)]
    assert got(spark.createDataFrame(docs, "lang string, text string"), min_count=100) == brute(docs)


def told(batches, count, shared=None):
    out = Counter()
    for b in phrases._counted(count, shared)(iter(batches)):
        for lang, n, phrase, times in zip(*(b.column(k).to_pylist() for k in range(4))):
            out[lang, n, phrase] += times
    return out


class Shared:
    def __init__(self, value):
        self.value = value


def test_chunks_of_a_task_and_a_filter_that_lets_all_through(monkeypatch):
    """However words are cut into chunks and whatever a crowded bitmap lets through, counts of a task are those of all phrases."""
    docs = [(lang or "und", t or "") for lang, t in corpus(9, 30)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*docs[k : k + 7])], names=["lang", "text"]) for k in range(0, len(docs), 7)]
    want = Counter()
    for lang, text in docs:
        for words in pieces(text):
            want.update((lang, m, " ".join(words[i : i + m])) for m in range(1, 6) for i in range(len(words) - m + 1))
    full = Shared(np.full(1 << phrases.FILTER_BITS - 3, 255, np.uint8))
    for chunk in (1, 50, 1 << 20):
        monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
        assert told(batches, phrases._single) + told(batches, phrases._pairs, full) + told(batches, phrases._longer(5), full) == want
    none = Shared(np.zeros(1 << phrases.FILTER_BITS - 3, np.uint8))
    assert not told(batches, phrases._pairs, none) and not told(batches, phrases._longer(5), none)
