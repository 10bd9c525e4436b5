"""Decontamination against a plain search for windows."""

import random
import re

from canonlake.llm import decontaminate as deco

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        if w:
            for i in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                at = windows.get(tuple(w[i : i + n]))
                if at:
                    hit |= set(range(i, i + n))
                    found |= at
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def cases(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(6)] + ["É", "3"]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, draw(rng.choice([1, 2, 5, 9, 10, 11, 30]))) for k in range(8)] + [(90, None), (91, ""), (92, "!!")]
    items += [(93, items[0][1]), (94, items[5][1] + " tail")]
    docs = [(0, None), (1, ""), (2, "--")]
    for d in range(3, 40):
        parts = [draw(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            parts += [(rng.choice(items)[1] or "").upper(), draw(rng.randint(0, 5))]
        docs.append((d, "; ".join(parts)))
    return docs, items


def found(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    rows = deco.contamination(d, i, **settings).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows), key=str)


def test_hits_match_a_plain_search(spark):
    for seed in range(3):
        docs, items = cases(seed)
        assert found(spark, docs, items) == brute(docs, items)


def test_long_items_alone_and_blocks(spark):
    docs, items = cases(7)
    items = [x for x in items if len(words(x[1])) >= 10] + [(200 + k, " ".join(f"w{(k * j) % 6}" for j in range(25))) for k in range(4)]
    assert found(spark, docs, items) == brute(docs, items)
    # blocks of two items, and blocks that every longer item is cut for
    for words_a_block in (30, 13):
        assert found(spark, docs, items, block_words=words_a_block) == brute(docs, items)
    docs, items = cases(8)
    assert found(spark, docs, items, block_words=12) == brute(docs, items)


def test_automaton_against_all_factors():
    rng = random.Random(0)
    for _ in range(200):
        items = [(k, [bytes([97 + rng.randrange(3)]) for _ in range(rng.randint(1, 12))]) for k in range(4)]
        automaton = deco.Automaton(items, 4)
        text = [bytes([97 + rng.randrange(3)]) for _ in range(40)]
        strings = {tuple(w[a:b]) for _, w in items for a in range(len(w)) for b in range(a + 1, len(w) + 1)}
        coded = [automaton.number.get(w, -1) for w in text]
        for place, _, matched in automaton.walk(coded):
            longest = max((n for n in range(1, place + 2) if tuple(text[place + 1 - n : place + 1]) in strings), default=0)
            assert matched == longest


def test_spans_are_cut_and_clean_rows_stay(spark):
    item = " ".join(f"q{k}" for k in range(12))
    docs = [(1, "clean text, whole.", "a"), (2, "before " * 20 + item.upper() + "! after é", "b"), (3, item, "c"), (None, None, "d"), (1, "clean text, whole.", "a")]
    d = spark.createDataFrame(docs, "doc_id long, text string, spans string")
    rows = {(r.doc_id, r.text) for r in deco.decontaminate(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert rows == {(1, "clean text, whole."), (2, "before " * 20 + "! after é"), (None, None)}
    assert deco.decontaminate(d.limit(0), spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert deco.decontaminate(d, spark.createDataFrame([], "item_id long, text string")).count() == 5


def test_very_long_texts_repeated_items_and_clashing_names(spark):
    rng = random.Random(4)
    item = " ".join(f"q{k}" for k in range(30))
    long = " ".join(rng.choice(["a", "b", "q3"]) for _ in range(400_000)) + " " + item + " tail" * 1000
    docs = [(1, long, 9, 9, "x", True), (2, item, 9, 9, "x", True), (None, "short", 9, 9, "x", True), (3, "", 9, 9, "x", True)]
    d = spark.createDataFrame(docs, "doc_id long, text string, id int, `ROW` int, spans string, gone boolean")
    i = spark.createDataFrame([(5, item), (5, item), (6, item), (None, item)], "item_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in deco.contamination(d, i).collect()}
    assert rows == {1: (401_030, 30, [5, 6]), 2: (30, 30, [5, 6]), None: (1, 0, []), 3: (0, 0, [])}
    left = deco.decontaminate(d, i)
    assert left.columns == d.columns
    got = {r.doc_id: len(r.text) for r in left.collect()}
    assert got == {1: len(long) - len(item), None: 5, 3: 0}
