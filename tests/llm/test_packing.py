"""Packing: an exact round trip against the plain tokenizer, and bin counts against a bound."""

import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from canonlake.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(1)
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)  # as the contract has it: loaded and used unchanged


def plain(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


TEXTS = [None, "", " ", "one two", " lead", "trail ", "two  spaces", "tab\t next", "line\nnext one\n two", "<|endoftext|> it's <|endoftext|>", "né à 12 3.5 日本 語", "a b  c\x1c d", "x " * 5000, "word " * 2047 + "word", "don't 're a's 's t's", "Simple. Text,\nwith lines.\nAnd more, end.", "a.. b,. c_. d", "x .y\n.z ,w", "a\tb c", "\n", "a\n\nb", "é\u00a0ü ñ.", "Ⅷ. ²,³ ½", ".", ", a"]


def check(rows, texts, capacity):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert sorted(by_doc) == sorted(texts)
    for doc, text in texts.items():
        ids, at = np.array(plain(text), "<u4"), 0
        for k, r in enumerate(sorted(by_doc[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
            assert zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids) and (len(ids) > capacity or len(by_doc[doc]) == 1)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_round_trip(spark):
    texts = dict(enumerate(TEXTS))
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, length int").repartition(3)
    check(packing.pack_documents(df, PATH).collect(), texts, 2048)


def test_engines_agree():
    rng = random.Random(6)
    encoder = packing.Encoder(PATH)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFG0123456789 \n  .,;:!?'\"-_#$%&*()/éñüßçÀØ¿½³ªſĐ"
    for k in range(400):
        text = "".join(rng.choice(signs[:26] if rng.random() < 0.7 else signs) for _ in range(rng.randint(0, 300)))
        if k % 4 == 0:
            text = text.replace("a", "'s ").replace("b", "'ll").replace("c", " \n")
        assert encoder.encode(text) == np.array(plain(text)[:-1], "<u4").tobytes()
    for text in ("x" * 30_000, " " * 5_000, "a\n\n\n\nb", " \n" * 3_000, "é" * 2_001):
        assert encoder.encode(text) == np.array(plain(text)[:-1], "<u4").tobytes()


def test_few_sequences_over_many_lots(spark):
    rng = random.Random(3)
    texts = {i: " ".join(["the"] * rng.choice([5, 300, 700, 1100, 1500])) for i in range(600)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    got = check(packing.pack_documents(df, PATH, lot=40).collect(), texts, 2048)
    together = packing.best_fit(np.array([len(t.split()) + 1 for t in texts.values()]), 2048)
    assert got <= 1.03 * len(together[2])


@pytest.mark.parametrize("seed", range(4))
def test_the_tree_merges_all_light_bins_exactly(spark, seed):
    """Many lots over three levels: at most one bin of all that were handed on is half full or less, and every sequence is gapless."""
    rng = random.Random(seed)
    many = 3000 if seed == 0 else 700
    draw = (lambda: rng.randint(1, 40)) if seed % 2 else (lambda: rng.choice([3, 30, 51, 60, 70, 97, 100]))
    sizes = {i: draw() for i in range(many)}
    items = spark.createDataFrame(list(sizes.items()), "item long, length long").repartition(5)
    rows = packing.pack_items(items, 100, lot=7).collect()
    assert sorted(r.item for r in rows) == sorted(sizes)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, sizes[r.item]))
    fills = []
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
        fills.append(at)
    assert sum(f <= 50 for f in fills) <= 1


def test_best_fit_matches_a_plain_search():
    rng = random.Random(4)
    sizes = np.array([rng.randint(1, 100) for _ in range(300)])
    place, offset, used = packing.best_fit(sizes, 100)
    held, want = [], {}
    for i in np.argsort(-sizes, kind="stable"):
        fits = [(100 - h - sizes[i], b) for b, h in enumerate(held) if h + sizes[i] <= 100]
        room = min(fits)[0] if fits else None
        want[i] = room
        if fits:
            held[min(fits)[1]] += sizes[i]
        else:
            held.append(sizes[i])
    assert sorted(used) == sorted(held) and sum(used) == sizes.sum()


def test_empty_repeated_and_null_rows(spark):
    schema = "doc_id long, text string, sequence_id string"
    assert packing.pack_documents(spark.createDataFrame([], schema), PATH).count() == 0
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, None)], schema)
    rows = packing.pack_documents(df, PATH).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", 3), ("1", 3), ("None", 1)]
