"""SimHash near-dedup by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import fresh, staged
from canonlake.llm.components import components

#: The binary Golay code: its length, redundancy, generator polynomial and covering radius. It is perfect.
LENGTH, CHECKS, GENERATOR, RADIUS = 23, 11, 0b110001110101, 3
#: The first bits of the two blocks that carry a Golay code each; the 18 bits beyond belong to every anchor.
BLOCKS = (0, 23)
LAST = 46
#: Anchors in all, two times 12 message bits.
ANCHORS = 1 << 24
#: Fingerprints that meet at one anchor beyond which the anchor's work is split by the 18 last bits, and once more, where that is not
#: enough, by all 64.
CROWD = 2048
#: Parts of a fingerprint in the last split: 16 of four bits. Two differing bits touch two parts at most, so all 14 others are alike.
PARTS = 16
#: Bits of the bitmaps that name crowded keys; other keys that fall on a set bit are split in vain, which changes no result.
FLAGS = 1 << 24
SHINGLE, SEED = 3, 42


def fingerprint(text: bytes) -> int:
    """SimHash of the 3-word shingles of a text in UTF-8, repeats included; 0 without a word."""
    words = text.lower().split()  # of bytes: A-Z alone, x20 and x09 to x0D alone
    n = max(len(words) - SHINGLE + 1, 1)
    if not words:
        return 0
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):  # bounded memory for texts of any length
        part = words[at : min(at + (1 << 15), n) + SHINGLE - 1]
        shingles = zip(part, part[1:], part[2:]) if len(words) >= SHINGLE else [part]
        hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)  # 255 ones fit a byte
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@lru_cache(1)
def _cosets() -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Tables that give a block's syndrome, and for 0, 1 and 2 bits beyond the radius the error patterns of each syndrome."""
    single = [_remainder(1 << k) for k in range(LENGTH)]

    def table(bits: list[int]) -> np.ndarray:
        out = np.zeros(1, np.int64)
        for s in bits:
            out = np.concatenate([out, out ^ s])
        return out

    levels: list[list[tuple[int, int]]] = [[], [], []]
    for weight in range(RADIUS + 3):
        for places in combinations(range(LENGTH), weight):
            syndrome = 0
            for k in places:
                syndrome ^= single[k]
            levels[max(0, weight - RADIUS)].append((syndrome, sum(1 << k for k in places)))
    out = []
    for level in levels:
        pairs = np.array(sorted(level), np.int64)
        count = np.bincount(pairs[:, 0], minlength=1 << CHECKS)
        out.append((np.cumsum(count) - count, count, pairs[:, 1]))
    return table(single[:12]), table(single[12:]), out


def _block(fps: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    low, high, _ = _cosets()
    word = ((fps >> np.uint64(block)) & np.uint64((1 << LENGTH) - 1)).astype(np.int64)
    return word, low[word & 0xFFF] ^ high[word >> 12]


def home_anchors(fps: np.ndarray) -> np.ndarray:
    """The one anchor within the covering radius in both blocks."""
    found = np.zeros(len(fps), np.int64)
    begin, _, pattern = _cosets()[2][0]
    for block in BLOCKS:
        word, syndrome = _block(fps, block)
        found = found << 12 | (word ^ pattern[begin[syndrome]]) >> CHECKS
    return found


def reachable_anchors(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(row, anchor, at home) for every anchor whose distance beyond the radius adds up to 2 bits at most over the blocks."""
    (word_a, syn_a), (word_b, syn_b) = (_block(fps, block) for block in BLOCKS)
    levels = _cosets()[2]
    for beyond_a in range(3):
        for beyond_b in range(3 - beyond_a):
            (begin_a, count_a, pattern_a), (begin_b, count_b, pattern_b) = levels[beyond_a], levels[beyond_b]
            many = count_a[syn_a] * count_b[syn_b]
            row = np.repeat(np.arange(len(fps)), many)
            k = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            per_b = count_b[syn_b][row]
            a = word_a[row] ^ pattern_a[begin_a[syn_a][row] + k // np.maximum(per_b, 1)]
            b = word_b[row] ^ pattern_b[begin_b[syn_b][row] + k % np.maximum(per_b, 1)]
            yield row, a >> CHECKS << 12 | b >> CHECKS, beyond_a == beyond_b == 0


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home_anchors(fps).astype(np.int32))], names=["fp", "node", "anchor"])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _flags(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & (FLAGS - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).view(bool)


@lru_cache(1)
def _left_out() -> list[np.ndarray]:
    """Masks of all but two parts, one for each choice of the two."""
    width = 64 // PARTS
    part = [((1 << width) - 1) << (width * k) for k in range(PARTS)]
    return [np.uint64((1 << 64) - 1 - part[i] - part[j]) for i, j in combinations(range(PARTS), 2)]


def _replicate(used, crowded=None, hot=None):
    """Copies for every anchor in reach that is some fingerprint's home, as (key, fp, node, home).

    A key is the anchor; of a crowded anchor, one of three parts of the last 18 bits with it, of which two differing bits leave one
    alike; and where that is still crowded, what is left of the fingerprint without two of its sixteen parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_used = np.unpackbits(used.value, bitorder="little").view(bool)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                fps, nodes = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
                for row, anchor, home in reachable_anchors(fps):
                    keep = is_used[anchor]
                    row, anchor = row[keep], anchor[keep]
                    split = np.zeros(len(row), bool) if crowded is None else _flags(crowded.value, anchor)
                    keys, rows = [anchor[~split] << 8], [row[~split]]
                    for part in range(3):
                        value = (fps[row[split]] >> np.uint64(LAST + 6 * part)).astype(np.int64) & 63
                        key, of = anchor[split] << 8 | (part + 1) << 6 | value, row[split]
                        if hot is not None:
                            crowd = _flags(hot.value, _mixed(key.view(np.uint64)).view(np.int64))
                            for k, mask in enumerate(_left_out()):
                                mixed = _mixed((fps[of[crowd]] & mask) ^ _mixed(key[crowd].view(np.uint64) + np.uint64((k + 1) << 40)))
                                keys.append((mixed | np.uint64(1 << 63)).view(np.int64))  # negative: apart from all other keys
                                rows.append(of[crowd])
                            key, of = key[~crowd], of[~crowd]
                        keys.append(key)
                        rows.append(of)
                    key, row = np.concatenate(keys), np.concatenate(rows)
                    for cut in range(0, len(key), 1 << 16):  # one crowded batch may have a great many copies
                        own = slice(cut, cut + (1 << 16))
                        yield pa.RecordBatch.from_arrays([pa.array(key[own]), pa.array(fps[row[own]].view(np.int64)), pa.array(nodes[row[own]]), pa.array(np.full(len(key[own]), home))], names=["key", "fp", "node", "home"])

    return run


def _near(key: np.ndarray, fp: np.ndarray, node: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints at home and all others of their key; rows come in the order of keys."""
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[begins, len(key)])
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    size_of = np.repeat(sizes, sizes)
    small = np.flatnonzero((size_of > 1) & (size_of <= 48))
    if len(small):
        k, f, n, h = key[small], fp[small], node[small], home[small]
        for step in range(1, int(size_of[small].max())):
            hit = np.flatnonzero((k[step:] == k[:-step]) & (h[step:] | h[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= bits))
            found_a.append(n[hit])
            found_b.append(n[hit + step])
    for g in np.flatnonzero(sizes > 48):
        own = slice(begins[g], begins[g] + sizes[g])
        f, n, h = fp[own], node[own], home[own]
        parent = np.arange(len(f))  # only a spanning forest of the group leaves the task

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in np.flatnonzero(h):
            for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= bits):
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        top = np.array([root(i) for i in range(len(f))])
        moved = np.flatnonzero(top != np.arange(len(f)))
        found_a.append(n[moved])
        found_b.append(n[top[moved]])
    return np.concatenate(found_a), np.concatenate(found_b)


def _compare(bits: int):
    """Links per key over a partition in the order of keys; a key's rows may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            a, b = _near(*rows, bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            key = batch.column(0).to_numpy()
            if not len(key):
                continue
            rows = (key, batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False))
            if key[0] == key[-1] and held and held[-1][0][-1] == key[0]:
                held.append(rows)
                continue
            last = int(np.searchsorted(key, key[-1]))
            first = tuple(np.concatenate(x) for x in zip(*held, tuple(r[:last] for r in rows)))
            if len(first[0]):
                yield links(first)
            held = [tuple(r[last:] for r in rows)]
        if held:
            yield links(tuple(np.concatenate(x) for x in zip(*held)))

    return run


def _bitmap(rows: DataFrame, at: Column) -> np.ndarray:
    """The places ``at``, below 2**24, of ``rows`` as a bitmap of 2 MB, whatever the number of rows."""
    parts = rows.groupBy(F.bitmap_bucket_number(at + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits")).collect()
    out = np.zeros(ANCHORS // 8, np.uint8)
    for part in parts:
        out[(part.bucket - 1) * 4096 : part.bucket * 4096] = np.frombuffer(part.bits, np.uint8)
    return out


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bit of a key in a bitmap of crowded keys."""
    for batch in batches:
        key = batch.column(0).to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((_mixed(key) & np.uint64(FLAGS - 1)).view(np.int64))], names=["at"])


def near_links(nodes: DataFrame, bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within ``bits`` (2 at most) of one another.

    ``nodes`` has fp and node, one row a fingerprint. Anchors are the words of a covering code: a Golay code on
    each of two 23-bit blocks, every choice of the other 18 bits counting as the same. Each fingerprint is
    at home with the one anchor within the covering radius of 3 in both blocks, and is copied to each
    anchor it reaches with at most two bits beyond the radii, blocks together: 61 of 16.8 million on average.
    Two fingerprints at most two bits apart so meet at the home of either. Copies to anchors that are
    nobody's home are left out by a bitmap of 2 MB. Each key yields a spanning forest, not its pairs.

    Keys are bounded. Copies are first counted by anchor; an anchor where more than ``crowd`` meet is split 64 ways by three parts of
    its last 18 bits. What is still crowded then, near copies that share those bits too, is split by all 64: each fingerprint goes
    under the 120 choices of 14 of its 16 parts, and a key whose 14 parts are alike has 256 distinct fingerprints at most.
    Fingerprints and nodes must not be null, and a fingerprint is one row. No rows give no links.
    """
    if bits not in (0, 1, 2):
        raise ValueError(f"bits must be 0, 1 or 2, not {bits!r}: anchors cover no wider radius")
    context = nodes.sparkSession.sparkContext
    homes = staged(nodes.mapInArrow(_homes, "fp long, node long, anchor int"), "homes")
    named = homes.select("fp", "node")
    used = context.broadcast(_bitmap(homes, F.col("anchor")))
    schema = "key long, fp long, node long, home boolean"
    many = lambda rows: staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("key"), "crowds")
    crowds, crowded, hot = many(named.mapInArrow(_replicate(used), schema)), None, None
    if not crowds.isEmpty():
        crowded = context.broadcast(_bitmap(crowds, F.shiftright("key", 8)))
        still = many(named.mapInArrow(_replicate(used, crowded), schema).where(F.col("key").bitwiseAND(F.lit(255)) > 0))
        if not still.isEmpty():
            hot = context.broadcast(_bitmap(still.mapInArrow(_place, "at long"), F.col("at")))
    copies = named.mapInArrow(_replicate(used, crowded, hot), schema)
    dealt = copies.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_compare(bits), "a long, b long")


def classes(fps: DataFrame, bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """(fp, component_id) of the different fingerprints in ``fps`` (id, fp): the least id reachable by links; null if none has an id."""
    nodes = staged(fps.groupBy("fp").agg(F.min("id").alias("node")), "nodes")
    found = components(near_links(nodes.where(F.col("node").isNotNull()), bits, crowd))
    return staged(nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")), "classes")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """A row for each row of ``df``: ``id_col``, ``fp`` (long) and ``component_id``, the least id reachable by links.

    Fingerprints differing in ``bits`` bits or fewer link. Rows with equal fingerprints are one node,
    so exact copies cost one row before anything is compared. Null and empty texts have fingerprint zero,
    linked like any other. A null id gets its component, and names none unless its whole fingerprint has
    no id: then the component is null. Repeated ids are kept row by row. An empty table gives an empty
    table. Only the two named columns (whole numbers as ids) are read, so clashing names do no harm.
    """
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    fps = staged(texts.mapInArrow(_fingerprints, "id long, fp long"), "fingerprints")
    return fps.join(classes(fps, bits, crowd), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 2) -> DataFrame:
    """The rows of ``df`` whose id names their component, unchanged; rows without an id stay.

    Rows that repeat an id stay or go together. Texts without a word are equal. An empty table gives an empty table. Columns of
    any name may be there: the names used inside give way.
    """
    (gone_id,) = fresh(df, "gone_id")
    found = near_duplicates(df, id_col, text_col, bits)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(gone_id)).distinct()
    return df.join(gone, F.col(id_col) == F.col(gone_id), "left_anti")
