"""Suffix-array dedup: repeated strings of 50 bytes, found in merged Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import lookup, staged

#: Bytes of a string that counts, and of the grams of which the least hash names the string's bucket.
LENGTH, GRAM = 50, 24
#: Bytes of the gram that splits crowded buckets.
LONG_GRAM = 48


@dataclass(frozen=True)
class Sizes:
    """Bytes of text that are hashed at a time, of a shard's transform, and of the shards that are merged together; and the texts that may
    meet in a bucket before it is split. They bound memory and decide nothing."""

    chunk: int = 1 << 18
    shard: int = 1 << 17
    lot: int = 1 << 19
    crowd: int = 4096


#: Bytes that a string must share with another of its lot before a transform is built over it.
MIDDLE_GRAM = 32
#: Bits of the filter that spares most unshared buckets a shuffle; its size is fixed and it decides nothing.
FILTER = 1 << 28
#: A byte that UTF-8 never has ends each fragment.
END = 0xFF
#: A place of a fragment: its id, the tag of its text, and where it starts; by the size of ids, which a byte before tells,
#: so that bytes sort as ids do: negative ones, shifted, those of 32 bits, and larger ones.
PLACES, SHIFT = (struct.Struct(">QiI"), struct.Struct(">IiI"), struct.Struct(">QiI")), 1 << 63
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= _C
    h ^= h >> np.uint64(32)
    return h


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on."""
    return np.ndarray((max(len(text) - 7, 0),), "<u8", text, strides=(1,))


def _gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes, a multiple of eight, from each place on."""
    word, n = _words(text), len(text) - size + 1
    h = word[:n] * _A
    for at in range(8, size, 8):
        h = _mixed(h) + word[at : at + n] * _B
    return _mixed(h)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


def runs(texts: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, strings, bucket) of the maximal runs of places whose strings of 50 bytes have one bucket.

    The bucket of a string is the least hash of its grams, so equal strings have equal buckets.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = np.frombuffer(b"".join(texts), np.uint8)
    n = len(whole) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    bucket = _least(_gram_hashes(whole, gram), LENGTH - gram + 1)
    begins = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)[:n]
    valid = np.arange(n) + LENGTH <= (begins + sizes)[text]
    fresh = np.r_[True, (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]] & valid
    last = np.r_[fresh[1:] | ~valid[1:], True] & valid
    first = np.flatnonzero(fresh)
    return text[first], first - begins[text[first]], np.flatnonzero(last) - first + 1, bucket[first]


def _chunks(texts: list[bytes], chunk: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= chunk:
            yield begin, k + 1
            begin, size = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _buckets(sizes: Sizes, used=None):
    """For each text its id, its mark and its buckets, each once, or those that the filter knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin, end in _chunks(texts, sizes.chunk):
                text, _, _, bucket = runs(texts[begin:end])
                if used:
                    bit = (bucket % np.uint64(FILTER)).astype(np.int64)
                    keep = (used.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).view(bool)
                    text, bucket = text[keep], bucket[keep]
                order = np.lexsort((bucket, text))
                text, bucket = text[order], bucket[order]
                once = np.r_[True, (text[1:] != text[:-1]) | (bucket[1:] != bucket[:-1])][: len(text)]
                text, bucket = text[once], bucket[once]
                ends = np.cumsum(np.bincount(text, minlength=end - begin))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(bucket.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(begin, end - begin) for k in (0, 1)), lists], names=["id", "mark", "buckets"])

    return run


def _paired(text: np.ndarray, bucket: np.ndarray, wanted: pa.ListArray) -> np.ndarray:
    """Which (text, bucket) are wanted: ``wanted`` has a list of buckets for each text. Both pairs of numbers are compared, sorted as one."""
    sizes = wanted.value_lengths().to_numpy(zero_copy_only=False)
    asked = np.stack([np.repeat(np.arange(len(sizes)), sizes), wanted.flatten().to_numpy()])
    asked = asked[:, np.lexsort((asked[1], asked[0]))]
    begins = np.searchsorted(asked[0], np.arange(len(sizes) + 1))
    keep = np.zeros(len(text), bool)
    key = bucket.view(np.int64)
    order = np.lexsort((key, text))
    cuts = np.searchsorted(text[order], np.arange(len(sizes) + 1))
    for k in np.flatnonzero(sizes):
        own, have = asked[1, begins[k] : begins[k + 1]], order[cuts[k] : cuts[k + 1]]
        at = np.minimum(np.searchsorted(own, key[have]), len(own) - 1)
        keep[have] = own[at] == key[have]
    return keep


def _fragments_of(sizes: Sizes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in shared buckets, as (bucket, the fragment, its end and its places, the least id first). Equal fragments of a chunk share a row."""
    for batch in batches:
        ids, tags, texts = (batch.column(k).to_pylist() for k in range(3))
        plain, crowded = (batch.column(k) for k in (3, 4))
        for begin, end in _chunks(texts, sizes.chunk):
            found: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
            text, start, strings, bucket = runs(texts[begin:end])
            wanted = plain.slice(begin, end - begin)
            keep = _paired(text, bucket, wanted)
            for k, key, at, many in zip(text[keep].tolist(), bucket[keep].view(np.int64).tolist(), start[keep].tolist(), strings[keep].tolist()):
                body = texts[begin + k]
                found.setdefault((key, body[at : at + many + LENGTH - 1]), []).append((ids[begin + k], tags[begin + k], at))
            cuts = np.searchsorted(text, np.arange(end - begin + 1))
            for k in range(begin, end):
                hot = crowded[k].values.to_numpy()
                if len(hot):
                    own, body, place = slice(cuts[k - begin], cuts[k - begin + 1]), texts[k], (ids[k], tags[k])
                    b, s, n = bucket[own].view(np.int64), start[own], strings[own]
                    keep = np.isin(b, hot)
                    for key, at, many in zip(b[keep].tolist(), s[keep].tolist(), n[keep].tolist()):
                        part = body[at : at + many + LENGTH - 1]
                        _, sub, length, finer = runs([part], LONG_GRAM)
                        for fine, a, m in zip(finer.view(np.int64).tolist(), sub.tolist(), length.tolist()):
                            found.setdefault((key ^ fine, part[a : a + m + LENGTH - 1]), []).append((*place, at + a))
            yield _packed(found)


def _packed(found: dict[tuple[int, bytes], list[tuple[int, int, int]]]) -> pa.RecordBatch:
    """Rows of ``_fragments``. Of the bucket 32 bits will do: buckets that fall together are only compared in vain."""
    buckets, data = [], []
    heads = [bytes((END, kind)) for kind in range(3)]
    for (bucket, fragment), places in found.items():
        short = (bucket & 0xFFFFFFFF) - (1 << 31)
        if len(places) == 1:
            i, tag, at = places[0]
            kind = (i >= 0) + (i >= 1 << 32)
            buckets.append(short)
            data.append(fragment + heads[kind] + PLACES[kind].pack(i if kind else i + SHIFT, tag, at))
            continue
        places.sort()
        low, high = places[0][0], places[-1][0]
        kinds = (1,) if low >= 0 and high < 1 << 32 else (0, 1, 2)
        for kind in kinds:
            own = places if len(kinds) == 1 else [p for p in places if (p[0] >= 0) + (p[0] >= 1 << 32) == kind]
            if own:
                pack, shift = PLACES[kind].pack, SHIFT if kind == 0 else 0
                buckets.append(short)
                data.append(b"".join([fragment, heads[kind], *[pack(i + shift, tag, at) for i, tag, at in own]]))
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "data"])


def transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, preceding pairs of bytes) of a shard: its rotations sorted by 64 bytes or more, by lengthening sorted prefixes."""
    n = len(text)
    key = np.ndarray((n,), ">u8", np.r_[text, np.resize(text, 7)], strides=(1,)).astype(np.uint64)
    depth = 8
    while True:
        order = np.argsort(key)
        ordered = key[order]
        ranks = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        if depth >= 64 or ranks[-1] == n - 1:
            return order, text[order - 2].astype(np.uint16) << 8 | text[order - 1]
        rank = np.empty(n, np.uint64)
        rank[order] = ranks
        if n <= 1 << 21:  # three ranks fit a key
            key = rank << np.uint64(42) | np.roll(rank, -depth) << np.uint64(21) | np.roll(rank, -2 * depth)
            depth *= 3
        else:
            key = rank << np.uint64(32) | np.roll(rank, -depth)
            depth *= 2


def merged_classes(shards: list[np.ndarray]) -> list[np.ndarray]:
    """For each place of each shard the class of the 50 bytes from there on, equal over all shards.

    The transforms are merged by refining their interleave: at first it is all of one shard after another. A
    round takes the two bytes that precede each suffix in the order so far and sorts them, stably, which orders by two
    bytes more; after 25 rounds the order is that of the first 50 bytes. No suffix is compared again. Where the
    bytes or the class before differ from the neighbour's, the common prefix ends and a class begins.
    """
    built = [transform(s) for s in shards]
    bytes_ = np.concatenate([b for _, b in built])
    came = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s) for s in shards])
    klass = np.zeros(len(bytes_), np.int32)
    for _ in range(LENGTH // 2):
        by_shard = np.argsort(came, kind="stable")
        preceding = np.empty_like(bytes_)
        preceding[by_shard] = bytes_
        order = np.argsort(preceding, kind="stable")
        came, preceding, klass = came[order], preceding[order], klass[order]
        klass = np.cumsum(np.r_[False, (preceding[1:] != preceding[:-1]) | (klass[1:] != klass[:-1])], dtype=np.int32)
    ranked = klass[np.argsort(came, kind="stable")]
    out, at = [], 0
    for order, _ in built:
        places = np.empty(len(order), np.int32)
        places[order] = ranked[at : at + len(order)]
        out.append(places)
        at += len(order)
    return out


def _promising(fragments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, begin, end) of the stretches whose strings begin with 32 bytes that a lot has twice; no other can repeat."""
    sizes = np.fromiter(map(len, fragments), np.int64, len(fragments))
    begins = np.cumsum(sizes) - sizes
    whole = np.frombuffer(b"".join(fragments), np.uint8)
    owner = np.repeat(np.arange(len(fragments)), sizes - LENGTH + 1)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - LENGTH + 1) - (sizes - LENGTH + 1), sizes - LENGTH + 1)
    h = _gram_hashes(whole, MIDDLE_GRAM)[begins[owner] + offset]
    order = np.argsort(h)
    equal = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    fresh = np.r_[True, (np.diff(at) != 1) | (np.diff(owner[at]) != 0)]
    last = np.r_[fresh[1:], True]
    return owner[at[fresh]], offset[at[fresh]], offset[at[last]] + LENGTH


def repeated_places(fragments: list[bytes], least: np.ndarray, shard: int) -> list[list[tuple[int, int]]]:
    """For each fragment the stretches [begin, end) under strings that a fragment with a smaller id has too."""
    out: list[list[tuple[int, int]]] = [[] for _ in fragments]
    of, start, stop = _promising(fragments)
    if not len(of):
        return out
    sizes = stop - start + 1
    per = max(shard, -(-int(sizes.sum()) // 200))  # so that a byte tells the shards apart
    bounds = [0, *(np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // per)) + 1).tolist(), len(of)]
    end = bytes([END])
    parts = [fragments[k][a:b] + end for k, a, b in zip(of.tolist(), start.tolist(), stop.tolist())]
    classes = merged_classes([np.frombuffer(b"".join(parts[i:j]), np.uint8) for i, j in zip(bounds, bounds[1:])])
    part = np.repeat(np.arange(len(parts)), sizes)
    offset = np.arange(len(part)) - (np.cumsum(sizes) - sizes)[part]
    valid = np.flatnonzero(offset + LENGTH < sizes[part])
    klass, part, offset = np.concatenate(classes)[valid], part[valid], offset[valid]
    low = least[of[part]]
    order = np.argsort(klass, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(klass[order]) != 0])
    lowest = np.repeat(np.minimum.reduceat(low[order], first), np.diff(np.r_[first, len(order)]))
    gone = np.zeros(len(order), bool)
    gone[order] = lowest < low[order]
    hit = np.flatnonzero(gone)
    if len(hit):
        fresh = np.r_[True, (np.diff(hit) != 1) | (np.diff(part[hit]) != 0)]
        last = np.r_[fresh[1:], True]
        for k, base, a, b in zip(of[part[hit[fresh]]].tolist(), start[part[hit[fresh]]].tolist(), offset[hit[fresh]].tolist(), offset[hit[last]].tolist()):
            out[k].append((base + a, base + b + LENGTH))
    return out


def _fields(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of rows of ``_fragments_of``: bucket, where the fragment begins and ends in the bytes of all, and for each place its row, id, tag and start."""
    buckets, column = batch.column(0).to_numpy(), batch.column(1)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    ends = np.flatnonzero(data == END)
    stop = ends[np.searchsorted(ends, offsets[:-1])]
    kind = data[stop + 1]
    width = np.array([p.size for p in PLACES])[kind]
    many = (offsets[1:] - stop - 2) // width
    row = np.repeat(np.arange(len(many)), many)
    at = (stop + 2)[row] + (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * width[row]
    read = lambda begin, size, of: data[begin[:, None] + np.arange(size)].view(of).ravel()
    wide = kind[row] != 1
    ids, rest = np.empty(len(row), np.int64), at + np.where(wide, 8, 4)
    ids[~wide] = read(at[~wide], 4, ">u4")
    ids[wide] = (read(at[wide], 8, ">u8") - np.where(kind[row[wide]] == 0, np.uint64(SHIFT), np.uint64(0))).view(np.int64)
    return buckets, data, offsets[:-1], stop, row, ids, read(rest, 4, ">i4"), read(rest + 4, 4, ">u4").astype(np.int64)


def _marked_of(sizes: Sizes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches (id, tag, begin, end) to remove, over a partition in the order of bucket, fragment and least id.

    Equal fragments go but for their least id. Of buckets with several distinct ones, those go on, lot by lot, to the transforms.
    """
    out: list[tuple[np.ndarray, ...]] = []
    fragments: list[bytes] = []
    least: list[int] = []
    waiting: list[list[tuple[int, int, int]]] = []
    size = told = 0
    bucket_now, now = None, []  # the bucket in progress and its distinct fragments: bytes, least id, its places

    def rows() -> pa.RecordBatch:
        nonlocal told
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        out.clear()
        told = 0
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)], names=["id", "mark", "begin", "end"])

    def decide() -> None:
        nonlocal size
        found = [(i, h, at + a, at + b) for spans, holders in zip(repeated_places(fragments, np.array(least), sizes.shard), waiting) for i, h, at in holders for a, b in spans] if fragments else []
        if found:
            out.append(tuple(np.array(found, np.int64).T))
        fragments.clear()
        least.clear()
        waiting.clear()
        size = 0

    def close_bucket() -> None:
        nonlocal size
        if len(now) > 1:
            for fragment, lowest, holders in now:
                fragments.append(fragment)
                least.append(lowest)
                waiting.append(holders)
                size += len(fragment)
            if size >= sizes.lot:
                decide()
        now.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        buckets, data, begin, stop, row, ids, tags, starts = _fields(batch)
        view, length = memoryview(data), stop - begin
        same = np.r_[False, (buckets[1:] == buckets[:-1]) & (length[1:] == length[:-1])]
        for r in np.flatnonzero(same):
            same[r] = view[begin[r] : stop[r]] == view[begin[r - 1] : stop[r - 1]]
        goes_on = bool(now) and bucket_now == buckets[0] and now[-1][0] == view[begin[0] : stop[0]]
        first = np.flatnonzero(~same)
        group = (np.cumsum(~same) - 1)[row]
        lowest = ids[np.searchsorted(row, first)]
        if goes_on:
            lowest[0] = now[-1][1]
        gone = ids > lowest[group]
        if gone.any():
            out.append((ids[gone], tags[gone], starts[gone], starts[gone] + length[row[gone]]))
            told += int(gone.sum())
        stay = np.flatnonzero(~gone)
        cuts = np.searchsorted(group[stay], np.arange(len(first) + 1))
        held = list(zip(ids[stay].tolist(), tags[stay].tolist(), starts[stay].tolist()))
        opens = np.flatnonzero(np.r_[True, np.diff(buckets[first]) != 0])  # groups that begin a bucket
        many = np.diff(np.r_[opens, len(first)])
        for k in np.flatnonzero((many > 1) | (np.arange(len(opens)) % max(len(opens) - 1, 1) == 0)):  # the first and the last may go on in other batches
            if not (k == 0 and bucket_now == buckets[0]):
                close_bucket()
                bucket_now = buckets[first[opens[k]]]
            for g in range(opens[k], opens[k] + many[k]):
                places = held[cuts[g] : cuts[g + 1]]
                if g == 0 and goes_on:
                    now[-1][2].extend(places)
                else:
                    r = first[g]
                    now.append((bytes(view[begin[r] : stop[r]]), int(lowest[g]), places))
        if told > 100_000:
            yield rows()
    close_bucket()
    decide()
    yield rows()


def _joined(begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for a, b in sorted(zip(begins, ends)):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, begins, ends = (c.to_pylist() for c in batch.columns)
        out = []
        for text, b, e in zip(texts, begins, ends):
            spans, kept, at = _joined(b, e), [], 0
            for a, z in spans:
                kept.append(text[at:a])
                at = z
            left = b"".join([*kept, text[at:]])
            out.append((len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _tag(text: Column) -> Column:
    """A hash that tells apart the texts of a repeated id; never zero, which marks an id that has one text."""
    return F.coalesce(F.nullif(F.hash(text), F.lit(0)), F.lit(1))


def _shared_buckets(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """Buckets that two texts or more meet, and whether they are crowded. Counts have partial sums before the shuffle."""
    each = docs.mapInArrow(_buckets(sizes), "id long, mark int, buckets array<long>").select(F.explode("buckets").alias("bucket"))
    met = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return staged(met.select("bucket", (F.col("n") > sizes.crowd).alias("crowded")), "shared")


def _filter(shared: DataFrame) -> np.ndarray:
    """The buckets of ``shared`` as a bitmap of fixed size."""
    at = F.pmod("bucket", F.lit(FILTER)) + 1
    parts = shared.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(FILTER // 8, np.uint8)
    for row in parts.toLocalIterator():
        out[(row.part - 1) * 4096 : row.part * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def _with(work, sizes: Sizes):
    """``work`` with its sizes, which travel with the task; what it uses is found in the worker's own import of this module."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(sizes, batches)

    return run


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """A row for each row of ``df``: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left).

    A byte of the UTF-8 text goes if a string of 50 bytes that covers it also starts in a document with a smaller id.
    Strings are judged on the input. Texts cut inside a character keep its other bytes, so ``kept`` is binary.

    Each string of 50 bytes has a bucket, the least hash of its 24-byte grams. Buckets met in one text alone cannot
    repeat and are left out (a bitmap of 32 MB first spares most of them the shuffle, then a join decides).
    The fragments of text in a shared bucket come together; equal ones are one item of the collection, and
    where a bucket has several, shards of them get Burrows-Wheeler transforms that are merged by interleave refinement
    (``merged_classes``). Strings of a class, a repeated interval of the merged order, go but for the least id.
    Buckets that over 4,096 texts meet (``sizes``) are split by 48-byte grams, so a passage that a third of all
    texts share brings its equal fragments together, folded by batch, and not what surrounds it.
    Exact copies of a text, by 128-bit hash, go whole and enter no bucket. Texts are shuffled once, by id.

    Null text: empty. A null id: nothing of it goes, and it makes nothing go. Rows that repeat an id do not
    make each other go; where they differ, a 32-bit hash of the text tells them apart. Texts are hashed in pieces of ``sizes.chunk``
    bytes or one text, so the longest text bounds a task's memory. An empty table gives an empty table. Ids are whole numbers. Only
    the two named columns are read, so clashing names do no harm.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = df.select(F.col(id_col).cast("long").alias("id"), text.cast("binary").alias("text"))
    docs = raw.where(F.col("id").isNotNull()).select("id", _tag(F.col("text")).alias("tag"), "text")  # one shuffle by id serves both joins
    facts = docs.select("id", "tag", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), F.octet_length("text").alias("n"))
    facts = staged(facts, "texts")
    twins = facts.groupBy("id").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("id", F.lit(True).alias("twin"))
    twins = lookup(twins, "repeated-ids")
    mark = F.when(F.col("twin"), F.col("tag")).otherwise(0).alias("mark")
    facts = facts.join(twins, "id", "left").select("id", "tag", mark, "h1", "h2", "n")
    first = staged(facts.groupBy("h1", "h2").agg(F.min("id").alias("first")), "first")
    copies = staged(facts.join(first, ["h1", "h2"]).where(F.col("id") > F.col("first")).select("id", "tag", "mark", "n"), "copies")
    # tags are compared beside the key, by bits, so that texts are dealt out by id alone
    same = lambda a, b: F.col(a).bitwiseXOR(F.col(b)) == 0
    others = lookup(copies.select(F.col("id").alias("copy"), F.col("tag").alias("of")).distinct(), "copied-ids")
    originals = docs.join(twins, "id", "left").select("id", "tag", mark, "text").join(others, (F.col("id") == F.col("copy")) & same("tag", "of"), "left_anti").select("id", "mark", "text")
    shared = _shared_buckets(originals, sizes)
    used = spark.sparkContext.broadcast(_filter(shared))
    again = originals.mapInArrow(_buckets(sizes, used), "id long, mark int, buckets array<long>").select("id", "mark", F.explode("buckets").alias("bucket"))
    pick = lambda flag: F.collect_list(F.when(F.col("crowded") == flag, F.col("bucket")))
    wanted = again.join(shared, "bucket").repartition("id").groupBy("id", "mark").agg(pick(False).alias("plain"), pick(True).alias("crowded"))
    chosen = docs.join(wanted, "id").where((F.col("mark") == 0) | same("tag", "mark")).select("id", "mark", "text", "plain", "crowded")
    pieces = chosen.mapInArrow(_with(_fragments_of, sizes), "bucket int, data binary")
    dealt = pieces.repartition("bucket").sortWithinPartitions("bucket", "data")
    marks = dealt.mapInArrow(_with(_marked_of, sizes), "id long, mark int, begin long, end long")
    gone = copies.where(F.col("n") >= LENGTH).select("id", "mark", F.lit(0).cast("long").alias("begin"), F.col("n").cast("long").alias("end"))
    spans = marks.unionByName(gone).groupBy("id", "mark").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    none = F.array().cast("array<long>")
    found = spans.select(F.col("id").alias("of"), "mark", "begins", "ends")
    joined = docs.join(found, (F.col("id") == F.col("of")) & ((F.col("mark") == 0) | same("tag", "mark")), "left").select("id", "text", F.coalesce("begins", none).alias("begins"), F.coalesce("ends", none).alias("ends"))
    nameless = raw.where(F.col("id").isNull()).select("id", "text", none.alias("begins"), none.alias("ends"))
    return joined.unionByName(nameless).mapInArrow(_cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("id", id_col)
