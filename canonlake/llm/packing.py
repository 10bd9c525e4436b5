"""Best-fit packing of tokenised documents into sequences, hierarchically."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canonlake.llm.common import lookup, staged

#: Items that are packed at once at most; a partition with more is packed in several lots.
LOT = 1 << 17
#: A bin with no more room than this part of the capacity is nearly full and is emitted.
NEARLY_FULL = 1 / 64
#: Lots or nodes that meet in a node of the next round.
FAN = 16
#: Fixed value: how the byte-level tokenizer splits a text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of printable ASCII and Latin letters, in runs of 2,000 at most with one or two spaces or newlines between.
_PLAIN = re.compile(r"[ \n]{0,2}+(?:[!-~\u00a1-\u024f]{1,2000}+[ \n]{1,2}+)*+[!-~\u00a1-\u024f]{0,2000}+")


class Encoder:
    """Byte-level BPE by a tokenizers file, with a faster engine for plain texts.

    The merges of the file are in the order of their ids, so the engine that merges by rank gives the same ids. It is used
    where character classes are the same in every version of Unicode and its cost is linear; all other
    texts go through the tokenizers library itself. Tests hold one against the other.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        special = {t["id"] for t in told["added_tokens"]}
        self.added = [t["content"] for t in told["added_tokens"]]
        # printable bytes stand for themselves, the others for characters from U+0100 on, in order
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte[c] for c in token): k for token, k in told["model"]["vocab"].items() if k not in special}
        self.fast = tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids, little-endian, four bytes each."""
        if _PLAIN.fullmatch(text) and not any(t in text for t in self.added):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoders.setdefault(path, Encoder(path)) if path not in _encoders else _encoders[path]
        at, end = TaskContext.get().partitionId() << 36, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((at, doc, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    at += 1
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["item", "id", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best fit, largest first: the bin and the offset of every item, and what each bin holds."""
    place, offset, used = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r is set if a bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = with_room[room].pop()
            if not with_room[room]:
                mask ^= 1 << room
        else:
            room, bin_ = capacity, len(used)
            used.append(0)
        place[i], offset[i] = bin_, used[bin_]
        used[bin_] += size
        with_room[room - size].append(bin_)
        mask |= 1 << (room - size)
    return place, offset, used


def _pack_lots(capacity: int, lot: int):
    """Items to (item, bin, offset, part, lot, used, first): a bin is a number of its own; ``used`` is what it holds, ``first`` marks one item of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lots, packed_before = TaskContext.get().partitionId(), 0, 0
        items: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            nonlocal lots, packed_before
            item, size = np.concatenate(items), np.concatenate(sizes)
            place, offset, used = best_fit(size, capacity)
            bins = (np.int64(part) << 36) + packed_before + place
            columns = [pa.array(x) for x in (item, bins, offset, np.full(len(item), part, np.int32), np.full(len(item), lots, np.int32), np.array(used, np.int64)[place], offset == 0)]
            lots, packed_before = lots + 1, packed_before + len(item)
            items.clear()
            sizes.clear()
            return pa.RecordBatch.from_arrays(columns, names=["item", "bin", "offset", "part", "lot", "used", "first"])

        for batch in batches:
            items.append(batch.column(0).to_numpy())
            sizes.append(batch.column(1).to_numpy())
            if sum(map(len, items)) >= lot:
                yield packed()
        if items:
            yield packed()

    return run


def _pack_node(capacity: int):
    """Best fit, largest first, over a node's bins as items. A bin that another takes in moves behind what that one holds; only light bins move."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        bins, node = group["bin"].to_numpy(), int(group["node"].iloc[0])
        place, offset, used = best_fit(group["used"].to_numpy(), capacity)
        host = np.zeros(len(used), np.int64)
        host[place[offset == 0]] = bins[offset == 0]
        return pd.DataFrame({"bin": bins, "to": host[place], "shift": offset, "node": node, "used": np.array(used, np.int64)[place]})

    return run


def pack_items(items: DataFrame, capacity: int, lot: int = LOT) -> DataFrame:
    """(item, sequence_id, offset) for items with columns item (unique) and length (1 to ``capacity``).

    Each partition packs its own items by best fit, largest first, in lots of ``lot`` and without a shuffle, and emits bins that are
    nearly full. Those underfull are items of further rounds: 16 lots meet in a node, which packs their bins by best fit, 16 nodes
    meet in the next, and so on up to the root.

    No bin is capped away, and a node is still bounded: best fit leaves at most one bin a lot that is half full or less
    (two would have been one), and two bins that are more than half full never fit together. So a node merges its 16 light bins at
    most, into one another or into heavier ones, of which the 16 first of each fill are all that it can use; it gets 16
    of each of ``capacity`` / 2 fills at most, whatever the size of the input. A null or empty table gives no rows.
    """
    first = staged(items.select("item", "length").mapInArrow(_pack_lots(capacity, lot), "item long, bin long, offset long, part int, lot int, used long, first boolean"), "lots")
    # lots numbered without gaps: a partition's begin where those of the partitions before it end, a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = first.groupBy("part").agg((F.max("lot") + 1).alias("lots")).withColumn("begin", F.coalesce(F.sum("lots").over(before), F.lit(0))).drop("lots")
    under = first.where(F.col("first") & (capacity - F.col("used") > capacity * NEARLY_FULL)).join(begins, "part")
    under = staged(under.select("bin", (F.col("begin") + F.col("lot")).alias("node"), "used"), "underfull")
    light = F.col("used") * 2 <= capacity
    lights = under.where(light)
    top = under.agg(F.max("node")).first()[0] or 0
    moved = changed = None
    fan = 1
    while top // fan > 0:
        fan *= FAN
        parent = F.floor(F.col("node") / fan).cast("long")
        now = under
        if changed is not None:  # among them light bins that have become heavy
            news = changed.select(F.col("bin").alias("__bin"), F.col("used").alias("__used"))
            now = under.join(news, F.col("bin") == F.col("__bin"), "left").select("bin", "node", F.coalesce("__used", "used").alias("used"))
        now = now.where(~light & (capacity - F.col("used") > capacity * NEARLY_FULL))
        first_of = F.row_number().over(Window.partitionBy("parent", "used").orderBy("bin"))
        useful = now.withColumn("parent", parent).withColumn("turn", first_of).where(F.col("turn") <= FAN).select("bin", F.col("parent").alias("node"), "used")
        dealt = useful.unionByName(lights.select("bin", F.floor(F.col("node") / FAN).cast("long").alias("node"), "used"))
        done = staged(dealt.groupBy("node").applyInPandas(_pack_node(capacity), "bin long, to long, shift long, node long, used long"), "node")
        step = done.where("shift > 0").select("bin", "to", "shift")
        kept = done.where("shift = 0")
        lights = kept.where(light).select("bin", "node", "used")
        grown = kept.join(step.select(F.col("to").alias("bin")).distinct(), "bin", "left_semi").where(~light).select("bin", "used")
        if moved is None:
            moved, changed = step, staged(grown, "grown")
        else:
            onward = step.select(F.col("bin").alias("to"), F.col("to").alias("next"), F.col("shift").alias("more"))
            moved = moved.join(onward, "to", "left").select("bin", F.coalesce("next", "to").alias("to"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
            moved = staged(moved.unionByName(step), "moved")
            changed = staged(changed.join(grown, "bin", "left_anti").unionByName(grown), "grown")
    if moved is None:
        return first.select("item", F.col("bin").alias("sequence_id"), "offset")
    moved = lookup(moved, "moves")
    return first.join(moved, "bin", "left").select("item", F.coalesce("to", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, lot: int = LOT) -> DataFrame:
    """A row for each piece: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then ``end_id``. Only documents longer than ``capacity`` are cut, into pieces of
    ``capacity`` of which the first may be shorter. Offsets in a sequence are gapless from 0.

    Texts are read once and go no further than their task; what is written and packed is a narrow row for each
    piece. Null and empty texts are ``end_id`` alone. Null and repeated ids are packed row by row. An empty
    table gives an empty table. Only the two named columns are read, so clashing names do no harm.
    """
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    pieces = staged(texts.mapInArrow(_pieces(tokenizer_path, capacity, end_id), f"item long, id {kind}, piece int, start long, length long, ids_crc32 long"), "pieces")
    return pieces.join(pack_items(pieces, capacity, lot), "item").select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
