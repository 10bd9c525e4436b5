"""Suffix-array dedup against a plain search over all strings."""

import hashlib
import random

import numpy as np
import pytest

from canonlake.llm import suffix_dedup as sd


def brute(docs):
    """docs: (id, text); rows of results in the order given."""
    first = {}
    for i, text in docs:
        t = (text or "").encode()
        for k in range(len(t) - 49):
            s = t[k : k + 50]
            if i is not None and (s not in first or i < first[s]):
                first[s] = i
    out = []
    for i, text in docs:
        t = (text or "").encode()
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if i is not None and first[t[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, docs, **settings):
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_bytes int").repartition(3)
    rows = sd.suffix_dedup(df, **settings).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted(map(tuple, rows), key=str)


def cases(seed, n=60):
    rng = random.Random(seed)
    draw = lambda k: "".join(rng.choice("ab cé") for _ in range(k))
    passages = [draw(rng.choice([40, 49, 50, 51, 80, 300])) for _ in range(8)] + ["a" * 120, "ab" * 60]
    docs = [(0, None), (1, ""), (2, "x" * 49), (3, "x" * 50), (4, "x" * 51)]
    for i in range(5, n):
        docs.append((i, "".join(draw(rng.randint(0, 90)) + rng.choice(passages) for _ in range(rng.randint(0, 4)))))
    docs += [(n + k, rng.choice(docs)[1]) for k in range(8)]
    docs += [(None, docs[20][1]), (7, docs[30][1]), (7, docs[7][1]), docs[12]]
    rng.shuffle(docs)
    return docs


def test_matches_a_plain_search(spark):
    for seed in range(3):
        docs = cases(seed)
        assert found(spark, docs) == brute(docs)


def test_crowded_buckets_and_small_shards(spark):
    """Chunks of a text or two, many shards to a lot, many lots to a task, and buckets that are split."""
    for seed, sizes in ((9, sd.Sizes(500, 200, 700, 2)), (10, sd.Sizes(1, 60, 2000, 3)), (11, sd.Sizes(1 << 17, 150, 1 << 19, 4096))):
        docs = cases(seed, 90)
        assert found(spark, docs, sizes=sizes) == brute(docs)


def test_sizes_reach_the_workers(spark):
    docs = spark.createDataFrame([(i, t) for i, t in cases(2)], "doc_id long, text string")
    with pytest.raises(Exception):
        sd.suffix_dedup(docs, sizes=sd.Sizes(chunk="none")).collect()


def test_a_text_above_the_chunk(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    long = "".join(rng.choice("abcdefgh ") for _ in range(300_000))
    docs = [(1, passage), (2, long[:150_000] + passage + long[150_000:]), (3, long[1000:70_000]), (4, None)]
    assert found(spark, docs) == brute(docs)


def test_ids_of_any_size(spark):
    docs = [(i if i is None else (-(1 << 40), -3, 0, 5, 1 << 31, 1 << 32, 1 << 62)[i % 7] + i, t) for i, t in cases(4)]
    assert found(spark, docs) == brute(docs)


def test_no_rows(spark):
    assert found(spark, []) == []


def test_merged_classes_are_those_of_the_strings():
    rng = random.Random(1)
    for many in (1, 2, 5):
        shards = [np.frombuffer(b"".join(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 200))) * rng.randint(1, 3) + b"\xff" for _ in range(6)), np.uint8) for _ in range(many)]
        classes = sd.merged_classes(shards)
        by_class, by_string = {}, {}
        for s, c in zip(shards, classes):
            b = s.tobytes() * 60
            for k in range(len(s)):
                string = b[k : k + 50]
                assert by_class.setdefault(int(c[k]), string) == string and by_string.setdefault(string, int(c[k])) == int(c[k])


def test_buckets_depend_on_the_string_alone():
    rng = random.Random(2)
    same = bytes(rng.choice(b"abcd") for _ in range(50))
    names = set()
    for _ in range(50):
        text = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 30)))
        t, start, many, bucket = sd.runs([b"zz", text + same + text])
        for a, m, b in zip(start, many, bucket):
            if a <= len(text) < a + m:
                names.add(int(b))
    assert len(names) == 1
