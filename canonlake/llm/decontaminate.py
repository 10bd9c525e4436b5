"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import fresh, staged

#: Bytes to words: A-Z to lower case, every byte that is no digit, letter or part of a wider character to a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Words of items in one automaton; more items take further passes over the documents.
BLOCK_WORDS = 1_000_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Automaton:
    """A generalised suffix automaton over word numbers.

    ``next``, ``link`` and ``length`` are the usual ones. ``within`` maps each state that holds the windows of
    ``window`` words to the items they come from, ``whole`` each state and length of an item
    shorter than a window to its items.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window, self.number = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.number.setdefault(w, len(self.number)) for w in words]) for item, words in items if words]
        for _, word in coded:
            last = 0
            for w in word:
                last = self._add(last, w)
        self.within: dict[int, set[int]] = {}
        self.whole: dict[int, dict[int, set[int]]] = {}
        short = set()
        for item, word in coded:
            if len(word) < window:
                short.add(len(word))
            for _, state, matched in self.walk(word):
                if matched >= window:
                    self.within.setdefault(self.holding(state, window), set()).add(item)
                elif len(word) < window and matched >= len(word):
                    self.whole.setdefault(self.holding(state, len(word)), {}).setdefault(len(word), set()).add(item)
        self.short = sorted(short)
        self.least = min([window, *short])
        pairs = {(a << 32) | b for _, word in coded for a, b in zip(word, word[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.alone = np.array(sorted({word[0] for _, word in coded if len(word) == 1}), np.int64)

    def _add(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, w, known)
        state = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p < 0:
            self.link[state] = 0
        else:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return state

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The strings of ``q`` up to the length reached from ``p`` in a state of their own."""
        twin = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[twin], self.link[q] = self.link[q], twin
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = twin
            p = self.link[p]
        return twin

    def holding(self, state: int, length: int) -> int:
        """The state of the suffix of ``length`` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def walk(self, word) -> Iterator[tuple[int, int, int]]:
        """(place, state, longest matching length that ends there) along a stream of word numbers."""
        state = matched = 0
        for place, w in enumerate(word):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if w in self.next[state]:
                state, matched = self.next[state][w], matched + 1
            yield place, state, matched

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Maximal runs [begin, end) of words inside occurrences of windows, and the items whose windows occur."""
        get = self.number.get
        coded = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        found: set[int] = set()
        spans: list[list[int]] = []
        for begin, end in self._streams(coded):
            for place, state, matched in self.walk(coded[begin:end].tolist()):
                long = 0
                if matched >= self.window:
                    long = self.window
                    found |= self.within[self.holding(state, long)]
                for size in self.short:
                    if size <= matched:
                        at = self.whole.get(self.holding(state, size), {}).get(size)
                        if at:
                            found |= at
                            long = max(long, size)
                if long:
                    stop = begin + place + 1
                    while spans and spans[-1][0] >= stop - long:
                        spans.pop()
                    if spans and spans[-1][1] >= stop - long:
                        spans[-1][1] = stop
                    else:
                        spans.append([stop - long, stop])
        return [(a, b) for a, b in spans], found

    def _streams(self, coded: np.ndarray) -> list[tuple[int, int]]:
        """The stretches worth streaming: runs of word pairs that items have, of a window's length or more. No window lies outside."""
        if len(coded) == 0 or not self.number:
            return []
        pairs = coded[:-1] << 32 | coded[1:]
        known = (coded[:-1] >= 0) & (coded[1:] >= 0)
        at = np.flatnonzero(known)
        known[at] = self._among(pairs[at], self.pairs)
        edges = np.flatnonzero(np.diff(np.r_[False, known, False].astype(np.int8)))
        out = [(int(a), int(b) + 1) for a, b in zip(edges[::2], edges[1::2]) if b - a + 1 >= self.least]
        if len(self.alone):
            inside = np.zeros(len(coded), bool)
            for a, b in out:
                inside[a:b] = True
            out = sorted(out + [(int(k), int(k) + 1) for k in np.flatnonzero(~inside & self._among(coded, self.alone))])
        return out

    @staticmethod
    def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
        if not len(ordered):
            return np.zeros(len(values), bool)
        return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _blocks(items: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with words, block by block; the driver holds one block and one partition of the items.

    A longer item is cut into parts that overlap by a window less one word, so all its windows are there; the parts keep its id.
    """
    block: list[tuple[int, list[bytes]]] = []
    size = 0
    step = max(1, block_words - window + 1)
    for row in items.toLocalIterator():
        words = words_of(bytes(row.text))
        if not words or row.id is None:
            continue
        for at in range(0, max(1, len(words) - window + 1), step):
            part = words[at : at + step + window - 1]
            if block and size + len(part) > block_words:
                yield block
                block, size = [], 0
            block.append((row.id, part))
            size += len(part)
    if block:
        yield block


#: The automaton that a worker built last, by the name of its block: the tasks of a worker share it.
_built: dict[str, Automaton] = {}


def _automaton(name: str, shared, window: int) -> Automaton:
    if name not in _built:
        _built.clear()
        _built[name] = Automaton(shared.value, window)
    return _built[name]


def _scan(shared, window: int):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, shared, window)
        for batch in batches:
            out = []
            for key, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = words_of(text)
                spans, items = automaton.hits(words)
                out.append((key, doc, len(words), [x for s in spans for x in s], sorted(items)))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), batch.schema.field(1).type, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["row", "id", "n_words", "spans", "items"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unions of the spans that different blocks of items found in a document."""
    for batch in batches:
        lists, hit = [], []
        for spans in batch.column(3).to_pylist():
            joined: list[list[int]] = []
            for a, b in sorted(zip(spans[::2], spans[1::2])):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            lists.append([x for s in joined for x in s])
            hit.append(sum(b - a for a, b in joined))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lists, pa.list_(pa.int64())), batch.column(4), pa.array(hit, pa.int64())], names=["row", "id", "n_words", "spans", "items", "n_hit"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each row of ``docs``: ``id_col``, ``row`` (hash of the text), n_words, spans, items, n_hit.

    Words are runs of a-z, 0-9 and non-ASCII characters after A-Z went to lower case. A window is ``window``
    consecutive words of an item, or a shorter item whole. ``spans`` lists begin and end (exclusive, in words) of
    the maximal runs inside windows, ``items`` the items whose windows occur, in order.

    The automaton holds a block of items of at most ``block_words`` words, a proven bound, and is broadcast as
    those items; each worker builds it once. Further blocks take further passes, whose narrow results are merged
    per document; an item above the bound is cut into parts that overlap by a window less a word. Documents are streamed where they lie: texts are never shuffled.

    Null texts have no words. Items that are null, empty or without an id match nothing; equal items all count.
    Null ids are kept; repeated ids are judged row by row. No items: no hits. An empty table gives an
    empty table. Only the named columns are read, so clashing names do no harm.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("row"), F.col(id_col).alias("id"), text.cast("binary").alias("text"))
    named = items.select(F.col(item_col).cast("long").alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).cast("binary").alias("text"))
    schema = f"row long, id {texts.schema['id'].dataType.simpleString()}, n_words long, spans array<long>, items array<long>"
    passes = [staged(texts.mapInArrow(_scan(spark.sparkContext.broadcast(block), window), schema), "hits") for block in _blocks(named, window, block_words)]
    if not passes:
        passes = [texts.mapInArrow(_scan(spark.sparkContext.broadcast([]), window), schema)]
    found = passes[0]
    if len(passes) > 1:
        hits = passes[0].where(F.size("spans") > 0)
        for more in passes[1:]:
            hits = hits.union(more.where(F.size("spans") > 0))
        # rows with equal id and text have equal findings, so merging them is no loss
        each = hits.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(F.flatten(F.collect_list("spans")).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("i"))
        none = F.array().cast("array<long>")
        found = passes[0].join(each, passes[0]["id"].eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")), "left").select("row", "id", "n_words", F.coalesce("s", none).alias("spans"), F.coalesce("i", none).alias("items"))
    return found.mapInArrow(_merged, schema + ", n_hit long").withColumnRenamed("id", id_col)


def _cut(text: bytes, spans: list[int]) -> bytes:
    """``text`` without the stretches from the first to the last word of each span."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORDS))]
    out, begin = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(text[begin : at[a][0]])
        begin = at[b - 1][1]
    return b"".join(out) + text[begin:]


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without spans that match ``window`` words or more of an item, with its columns as they are.

    Documents of which spans cover ``max_coverage`` of the words or more go whole; of the others only the spans
    go. Documents without a hit are returned unchanged, null and empty texts and null ids too. Rows that repeat an id or a
    text are judged row by row; long texts are read whole. An empty table gives an empty table, and no items leave all as it is.
    Columns of any name may be there: the names used inside give way. See ``contamination``.
    """
    key, row, spans, gone = fresh(docs, "id", "row", "spans", "gone")
    found = contamination(docs, items, id_col, text_col, item_col, item_text_col, window).where("n_hit > 0")
    found = found.select(F.col(id_col).alias(key), F.col("row").alias(row), F.col("spans").alias(spans), (F.col("n_hit") >= max_coverage * F.col("n_words")).alias(gone))
    found = staged(found.dropDuplicates([key, row]), "contaminated")
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(found, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text) == F.col(row)), "left").where(~F.coalesce(gone, F.lit(False)))
    cut = _text_cutter()
    return joined.withColumn(text_col, F.coalesce(cut(F.when(F.col(spans).isNotNull(), F.col(text_col)), F.col(spans)), F.col(text_col))).select(*[F.col(f"`{c}`") for c in docs.columns])


def _text_cutter():
    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else _cut(t.encode(), list(s)).decode() for t, s in zip(text, spans)])

    return cut
