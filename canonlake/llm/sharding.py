"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canonlake.llm.common import fresh, staged

#: Virtual slots; they never change, only their shards do.
SLOTS = 8192


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record key, a null key included."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def slot_sizes(df: DataFrame, slot_col: str, size_col: str) -> dict[int, tuple[int, int]]:
    """(bytes, rows) of every slot that has rows. At most as many rows as there are slots reach the driver. A null size is an error; no rows give an empty table of sizes."""
    rows = df.groupBy(slot_col).agg(F.sum(size_col), F.count(F.lit(1)), F.count_if(F.col(size_col).isNull())).collect()
    if unknown := sum(r[3] for r in rows):
        raise ValueError(f"{unknown} rows have no size in {size_col}")
    return {r[0]: (r[1], r[2]) for r in rows}


def first_map(sizes: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Largest slots first, each into the shard with the fewest bytes so far."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, (0, 0))[0], s)):
        load, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, (0, 0))[0], shard))
    return placed


def rebalanced(placed: dict[int, int], sizes: dict[int, tuple[int, int]], shards: int, tolerance: float = 0.01) -> dict[int, int]:
    """An edited copy of a map for ``shards`` shards that moves few slots.

    Slots of shards that no longer exist move first, each to the shard with the fewest bytes. Then, while a shard holds more than the mean and the
    tolerance, its largest slot that still fits goes to the emptiest of those that may take it: if there are new shards, only
    they do, so with one more shard slots move only into it; if there are none, any may. Of equal slots and shards the lesser number comes first.
    """
    new = range(max(placed.values(), default=-1) + 1, shards)
    takers = new if len(new) else range(shards)
    edited, load = dict(placed), [0] * shards
    homeless = [s for s, shard in placed.items() if shard >= shards]
    members: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    for slot, shard in placed.items():
        if shard < shards:
            members[shard].append(slot)
            load[shard] += sizes.get(slot, (0, 0))[0]
    weight = lambda s: sizes.get(s, (0, 0))[0]
    for slot in sorted(homeless, key=lambda s: (-weight(s), s)):
        to = min(range(shards), key=lambda k: (load[k], k))
        edited[slot] = to
        members[to].append(slot)
        load[to] += weight(slot)
    mean = sum(load) / shards
    for source in sorted(range(shards), key=lambda k: (-load[k], k)):
        for slot in sorted(members[source], key=lambda s: (-weight(s), s)):
            to = min(takers, key=lambda k: (load[k], k))
            if load[source] <= mean * (1 + tolerance):
                break
            if weight(slot) and load[to] + weight(slot) <= mean and load[source] - weight(slot) >= mean * (1 - tolerance):
                edited[slot] = to
                load[source] -= weight(slot)
                load[to] += weight(slot)
    return edited


def save_map(spark: SparkSession, path: str, version: int, placed: dict[int, int]) -> None:
    """Add a version of the map to the table at ``path``; older versions stay."""
    rows = [(slot, shard) for slot, shard in sorted(placed.items())]
    spark.createDataFrame(rows, "slot int, shard int").coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> dict[int, int]:
    """A version of the map, the newest one if none is named."""
    found = spark.read.parquet(path)
    version = version if version is not None else found.agg(F.max(F.col("version").cast("int"))).first()[0]
    return {r.slot: r.shard for r in found.where(F.col("version").cast("int") == version).select("slot", "shard").collect()}


def rebalance(sharded: DataFrame, size_col: str, map_path: str, shards: int) -> DataFrame:
    """(virtual_slot, shard) for another number of shards: the newest map at ``map_path``, edited and stored as its next version.

    ``sharded`` has virtual_slot and ``size_col``, without nulls. Few slots move; with more shards, only into new ones. Repeated rows count as they are. No rows: every
    slot stays, but for those of shards that are gone.
    """
    spark = sharded.sparkSession
    version = spark.read.parquet(map_path).agg(F.max(F.col("version").cast("int"))).first()[0]
    edited = rebalanced(load_map(spark, map_path, version), slot_sizes(sharded, "virtual_slot", size_col), shards)
    save_map(spark, map_path, version + 1, edited)
    return spark.createDataFrame(sorted(edited.items()), "virtual_slot int, shard int")


def shard_rows(rows: DataFrame, key_col: str, size_col: str, shards: int, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """``rows`` with ``virtual_slot``, ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Only ids, sizes and other small columns should come in; texts stay where they are. Places follow
    (virtual slot, key): rows are numbered within their virtual slot, of which there are thousands, and
    each virtual slot starts where the one before it in the same shard ends. No window spans a shard.

    A key that a third of the rows share would fill one virtual slot, so keys should be record ids. A null
    key has a slot like any other; equal keys are numbered in an order of their own. A null size is an
    error. An empty table gives an empty table. Columns of the three names are replaced, all others stay.
    With ``map_path`` the map is stored there as version 1, to be edited by ``rebalanced``.
    """
    spark = rows.sparkSession
    dealt = staged(rows.drop("virtual_slot", "shard", "slot").withColumn("virtual_slot", slot_of(F.col(key_col), slots)), "slots")
    sizes = slot_sizes(dealt, "virtual_slot", size_col)
    placed = first_map(sizes, shards, slots)
    if map_path:
        save_map(spark, map_path, 1, placed)
    begins, ends = [], [0] * shards
    for slot in range(slots):
        shard = placed[slot]
        begins.append((slot, shard, ends[shard]))
        ends[shard] += sizes.get(slot, (0, 0))[1]
    place, begin = fresh(dealt, "__place", "__begin")
    placement = F.broadcast(spark.createDataFrame(begins, f"virtual_slot int, shard int, {begin} long"))  # a row for each virtual slot
    numbered = dealt.withColumn(place, F.row_number().over(Window.partitionBy("virtual_slot").orderBy(key_col, size_col)))
    return numbered.join(placement, "virtual_slot").withColumn("slot", F.col(begin) + F.col(place) - 1).drop(begin, place)
