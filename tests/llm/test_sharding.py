"""Sharding: places, balance, and few moves when the map is edited."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from canonlake.llm import sharding as sh


def test_places_are_gapless_and_bytes_near_equal(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.randint(8, 9000), "x") for i in range(5000)] + [(None, 8, "x"), (7, 8, "y"), (7, 8, "y")]
    df = spark.createDataFrame(rows, "doc_id long, size long, shard string").repartition(5)
    path = f"file://{tmp_path}/map"
    out = sh.shard_rows(df, "doc_id", "size", 24, map_path=path).collect()
    assert len(out) == len(rows)
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r)
    assert sorted(by_shard) == list(range(24))
    for held in by_shard.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    load = [sum(r["size"] for r in held) for held in by_shard.values()]
    assert max(load) < 1.02 * sum(load) / 24
    stored = sh.load_map(spark, path)
    assert all(stored[r.virtual_slot] == r.shard for r in out)


def test_rebalancing_moves_little(spark, tmp_path):
    rng = random.Random(2)
    sizes = {s: (rng.randint(100, 300), 1) for s in range(sh.SLOTS)}
    first = sh.first_map(sizes, 24)
    grown = sh.rebalanced(first, sizes, 25)
    moved = [s for s in first if first[s] != grown[s]]
    assert all(grown[s] == 24 for s in moved)
    load = [sum(sizes[s][0] for s in grown if grown[s] == k) for k in range(25)]
    assert max(load) < 1.03 * sum(load) / 25 and len(moved) < 1.1 * sh.SLOTS / 25
    back = sh.rebalanced(grown, sizes, 24)
    assert set(back.values()) == set(range(24)) and all(back[s] == grown[s] for s in grown if grown[s] < 24)
    path = f"file://{tmp_path}/map"
    sh.save_map(spark, path, 1, first)
    sh.save_map(spark, path, 2, grown)
    assert sh.load_map(spark, path) == grown and sh.load_map(spark, path, 1) == first


def test_no_rows(spark):
    assert sh.shard_rows(spark.createDataFrame([], "doc_id long, size long"), "doc_id", "size", 3).count() == 0


def test_one_more_shard_takes_slots_and_no_other_does():
    rng = random.Random(12)
    sizes = {slot: (sum(int(rng.paretovariate(1.2) * 900) for _ in range(rng.randint(0, 3))), 1) for slot in range(sh.SLOTS)}
    for before, after in ((24, 25), (24, 30), (3, 4)):
        placed = sh.first_map(sizes, before)
        edited = sh.rebalanced(placed, sizes, after)
        assert {edited[s] for s in placed if edited[s] != placed[s]} <= set(range(before, after))
        load = Counter()
        for slot, shard in edited.items():
            load[shard] += sizes[slot][0]
        assert len(load) == after and max(load.values()) < 1.1 * sum(load.values()) / after
    gone = sh.rebalanced(sh.first_map(sizes, 24), sizes, 20)
    assert set(gone.values()) == set(range(20)) and sh.rebalanced({}, {}, 3) == {}


def test_thousands_of_rows_with_clashing_names_and_a_null_size(spark, tmp_path):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.randint(1, 5000), "x", i, "y") for i in range(6000)], "id long, size long, __place string, __begin long, shard string")
    path = f"file://{tmp_path}/map"
    out = sh.shard_rows(df, "id", "size", 24, map_path=path)
    assert set(out.columns) == {"id", "size", "__place", "__begin", "virtual_slot", "shard", "slot"} and out.where("__place = 'x' and __begin = id").count() == 6000
    edited = {r.virtual_slot: r.shard for r in sh.rebalance(out, "size", path, 25).collect()}
    assert {edited[r.virtual_slot] for r in out.collect() if edited[r.virtual_slot] != r.shard} == {24}
    with pytest.raises(ValueError, match="no size"):
        sh.shard_rows(df.withColumn("size", F.when(F.col("id") % 7 > 0, F.col("size"))), "id", "size", 4)
