"""SimHash near-dedup against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from canonlake.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps):
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(50)]
    out = [None, "", " \t ", "One", "one", "ONE two", "Ünïcode É text here"]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(3, 400))]
        for _ in range(rng.randint(1, 4)):
            near = list(base)
            if rng.random() < 0.7:
                near[rng.randrange(len(near))] = rng.choice(words)
            out.append(" ".join(near))
    out.append(" ".join(rng.choice(words) for _ in range(70_000)))
    return out


def test_near_duplicates_match_brute_force(spark):
    docs = dict(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, fp string")
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df).collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    comps = brute_components(fps)
    assert got == {i: (fps[i], comps[i]) for i in docs}


def test_code_is_perfect_and_reach_is_complete():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    flips = fps.copy()
    for k in range(len(flips)):
        for b in rng.choice(64, 2, replace=False):
            flips[k] ^= np.uint64(1) << np.uint64(b)
    homes = simhash.home_anchors(fps)
    reach = {}
    for row, anchor, _ in simhash.reachable_anchors(flips):
        for r, a in zip(row, anchor):
            reach.setdefault(int(r), set()).add(int(a))
    assert all(int(homes[k]) in reach[k] for k in range(len(fps)))


@pytest.mark.parametrize("crowd,flips,low", [(5, 4, 64), (20, 3, 46), (2048, 4, 64)])
def test_crowded_anchor_is_split_and_exact(spark, crowd, flips, low):
    """With a low bound the anchors are split, and split again where fingerprints differ in the first 46 bits alone."""
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = {i: base ^ sum(1 << b for b in rng.sample(range(low), rng.randint(0, flips))) for i in range(150)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    unique = {}
    for i, f in fps.items():
        unique.setdefault(f, i)
    nodes = spark.createDataFrame([(signed(f), i) for f, i in unique.items()], "fp long, node long")
    from canonlake.llm.components import components

    got = {r.node: r.component for r in components(simhash.near_links(nodes, crowd=crowd)).collect()}
    want = brute_components({i: f for f, i in unique.items()})
    assert {i: got.get(i, i) for i in want} == want


def test_empty_repeated_and_null_rows(spark):
    schema = "doc_id long, text string, component_id long"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(1, "a b c d", 9), (1, "a b c d", 9), (None, "a b c d", 9), (None, "q r s t", 9), (0, None, 9)], schema)
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, 1), (None, None), (0, 0)], key=str)
    kept = simhash.one_of_each(df).collect()
    assert len(kept) == 5


def test_a_hot_key_is_bounded():
    """Near copies of one fingerprint that share the last bits: no key of the last split has more than 256 of them."""
    rng = np.random.default_rng(3)
    fps = np.unique(np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 46, (4000, 3)).astype(np.uint64), axis=1))

    class Shared:
        def __init__(self, value):
            self.value = value

    full = Shared(np.full(simhash.ANCHORS // 8, 255, np.uint8))
    batch = pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.array(np.arange(len(fps)))], names=["fp", "node"])
    sizes = {}
    for out in simhash._replicate(full, full, full)([batch]):
        for key, fp in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            assert key < 0
            sizes.setdefault(key, set()).add(fp)
        if len(sizes) > 200_000:
            break
    assert max(map(len, sizes.values())) <= 256


def test_one_of_each_with_any_column_names(spark):
    df = spark.createDataFrame([(1, "a b c d", 1), (2, "a b c d", 2), (None, None, 3)], "doc_id long, text string, GONE_ID int")
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.GONE_ID for r in kept.collect()) == [1, 3]
