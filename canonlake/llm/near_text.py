"""Near copies by shingle similarity: MinHash bands propose pairs, exact Jaccard similarity decides. SimHash fingerprints may link as well."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm import simhash
from canonlake.llm.common import fresh, lookup, staged
from canonlake.llm.components import components

SHINGLE, SEED = 5, 42
#: Two texts at 0.8 agree in a band with probability 0.8 ** 5, so in none of 30 with 7 in a million.
BANDS, ROWS = 30, 5
#: Rounds in which one member of a bucket is compared with all others, before what is still apart is compared each with each.
STARS = 3
#: Members of a bucket that are compared each with each in one task are dealt into blocks of about this size; a task has two blocks.
BLOCK = 512
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingles(words: list[bytes]) -> np.ndarray:
    """Distinct hashes of the runs of five words, in order; of the whole where there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    each = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * _FACTOR + each[k : k + len(out)]
    return np.unique(_mixed(out))


@lru_cache(1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return tuple(rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(k) for k in (1, 0))


def band_keys(found: np.ndarray) -> np.ndarray:
    """A key a band of the least values that the shingles take under each function."""
    factor, add = _functions()
    low, least = found.astype(np.uint32), np.full(BANDS * ROWS, (1 << 32) - 1, np.uint32)
    for at in range(0, len(low), 512):
        np.minimum(least, (low[at : at + 512, None] * factor + add).min(axis=0), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = _mixed(key * _FACTOR + column)
    return key


def _sketches(prints: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, size, keys, fps = [], [], [], np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column(2).to_pylist()):
                words = text.lower().split()  # of bytes: A-Z alone, x20 and x09 to x0D alone
                found = shingles(words)
                same.append(xxhash.xxh3_128_digest(b" ".join(words)))
                size.append(len(found))
                keys.append(band_keys(found).view(np.int64) if len(found) else np.empty(0, np.int64))
                if prints:
                    fps[i] = simhash.fingerprint(text)
            columns = [batch.column(0), batch.column(1), pa.array(same, pa.binary()), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "same", "size", "keys", "fp"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.lower().split()).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "shingles"])


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough; only sets that a pair names are moved."""

    def of(end: str) -> DataFrame:
        named = lookup(pairs.select(F.col(end).alias("node")).distinct(), "pair-ends")
        return sets.join(named, "node", "left_semi").select(F.col("node").alias(end), F.col("shingles").alias(f"{end}_set"))

    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "a_set", "b_set")
    return joined.mapInArrow(_similar(percent), "a long, b long")


def _each_with_each(percent: int):
    """Links that join the members of a unit which are similar and not yet in one component, by exact counts."""

    def run(unit: pa.Table) -> pa.Table:
        node, label = unit.column("node").to_numpy(), unit.column("comp").to_numpy().copy()
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in unit.column("shingles")]
        size = np.array([len(x) for x in found])
        begin = np.cumsum(size) - size
        values, place = np.unique(np.concatenate(found), return_inverse=True)
        mark, out = np.zeros(len(values), np.uint8), []
        for i in range(len(node) - 1):
            mine = place[begin[i] : begin[i] + size[i]]
            mark[mine] = 1
            common = np.add.reduceat(mark[place[begin[i + 1] :]], begin[i + 1 :] - begin[i + 1], dtype=np.int64)
            mark[mine] = 0
            for j in i + 1 + np.flatnonzero(100 * common >= percent * (size[i + 1 :] + size[i] - common)):
                if label[i] != label[j]:
                    out.append((node[i], node[j]))
                    label[label == label[j]] = label[i]
        a, b = zip(*out) if out else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _settled(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members that buckets hold in different components. A bucket's members are dealt into blocks and every two
    blocks meet in one unit, so a unit is bounded and a crowded bucket is the work of many tasks; no pair becomes a row."""
    blocks = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = members.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    units = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "comp")
    named = lookup(members.select("node").distinct(), "unsettled")
    return units.join(sets.join(named, "node", "left_semi"), "node").groupBy("key", "low", "high").applyInArrow(_each_with_each(percent), "a long, b long")


def near_links(members: DataFrame, sets: DataFrame, percent: int = 80) -> DataFrame:
    """(node, component) of the nodes that similar pairs join.

    ``members`` has key, node and size, a row for each node in a bucket; ``sets`` has node and shingles. In a round each bucket's
    least member is compared with those not yet joined to it, so a large group of near copies costs its members, not their
    pairs. The member is then done with; buckets whose members are all joined go. After ``STARS`` rounds members
    still apart are compared each with each. Nothing that shares a band is left undecided. Ties of size do not matter: the least
    member is the one with the least node. Null nodes must not occur; no members give no rows.
    """
    members = members.select("key", "node", "size", F.col("node").alias("comp"))
    links = tried = None
    for _ in range(STARS):
        first = members.groupBy("key").agg(F.min(F.struct("node", "size", "comp")).alias("first"))
        rows = members.join(first, "key").where(F.col("node") != F.col("first.node"))
        near = rows.where((F.col("comp") != F.col("first.comp")) & (100 * F.least("size", "first.size") >= percent * F.greatest("size", "first.size")))
        pairs = near.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct()
        pairs = staged(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        found = staged(_verified(pairs, sets, percent), "similar")
        links = found if links is None else links.union(found)
        label = components(links).select("node", F.col("component").alias("now"))
        rest = staged(rows.select("key", "node", "size", "comp").join(label, "node", "left").select("key", "node", "size", F.coalesce("now", "comp").alias("comp")), "rest")
        apart = rest.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
        members = staged(rest.join(apart, "key"), "members")
        if members.isEmpty():
            return components(links)
    found = staged(_settled(members, sets, percent), "settled")
    return components(found if links is None else links.union(found))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, bits: int | None = None) -> DataFrame:
    """The rows of ``df`` whose id is the least of their component, unchanged; rows without an id stay.

    Texts link whose sets of five-word shingles have a Jaccard similarity of ``percent`` hundredths or more (words are
    split at ASCII white space, A-Z lower-cased), and, if ``bits`` is given, whose SimHash fingerprints differ in at most as many bits (2 at most);
    a component is what both kinds of links join. Texts of equal words are one node before anything is
    compared; null texts and texts without a word are equal. Pairs are proposed by MinHash bands and decided exactly.
    Rows that repeat an id stay or go together: they go if one of their texts has a link to a smaller id. Long texts are read
    whole. An empty table gives an empty table. Columns of any name may be there: the names used inside give way.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("row"), text.cast("binary").alias("text"))
    sketches = staged(source.mapInArrow(_sketches(bits is not None), "id long, row long, same binary, size long, keys array<long>, fp long"), "sketches")
    least = sketches.where("id is not null").groupBy("same").agg(F.min(F.struct("id", "row", "size", "keys", "fp")).alias("x"))
    nodes = staged(least.select("same", F.col("x.id").alias("node"), "x.row", "x.size", "x.keys", "x.fp"), "nodes")
    bands = nodes.select("node", "row", "size", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = staged(bands.join(shared, "key"), "members")
    wanted = lookup(members.select(F.col("node").alias("id"), "row").distinct(), "wanted")
    sets = staged(source.join(wanted, ["id", "row"], "left_semi").select("id", "text").mapInArrow(_sets, "node long, shingles binary"), "sets")
    found = near_links(members, sets, percent)
    if bits is not None:
        prints = nodes.join(simhash.classes(nodes.select(F.col("node").alias("id"), "fp"), bits), "fp").select("node", "component_id")
        found = components(found.union(prints).toDF("a", "b"))
    classes = nodes.join(found, "node", "left").select("same", F.coalesce("component", "node").alias("component"))
    (gone_id,) = fresh(df, "gone_id")
    gone = sketches.select("id", "same").join(staged(classes, "classes"), "same").where("id <> component").select(F.col("id").alias(gone_id)).distinct()
    return df.join(gone, F.col(id_col) == F.col(gone_id), "left_anti")
