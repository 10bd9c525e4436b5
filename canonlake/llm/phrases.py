"""Collocations: phrases whose words stand together far more often than by chance."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canonlake.llm.common import LOWER, UPPER, lookup, staged

#: Signs at which a text is cut into pieces, and what a piece is cut into words at.
CUTS, BLANKS = ".,;:!?\n\x0b\f\r", " \t"
#: A-Z in lower case and every cut a full stop, which no word can hold.
_PLAIN = bytes.maketrans((UPPER + CUTS).encode(), (LOWER + "." * len(CUTS)).encode())
#: Words of a language that are counted together before their counts leave the task.
CHUNK_WORDS = 1 << 20
#: Bits of a bitmap that names words or pairs of words which are frequent enough: 16 MB each, whatever the input.
FILTER_BITS = 27
#: Parts in which the first phrases of a language are chosen before they are ranked together.
PARTS = 64

ROWS = "lang string, words int, phrase string, n long"


def _place(lang: Column, phrase: Column) -> Column:
    """The bit of a phrase of a language in a bitmap, one of 2 ** FILTER_BITS; ``_bits`` computes the same in a task."""
    return F.crc32(F.concat(lang, F.lit("\n"), phrase).cast("binary")).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def _bits(bitmap: np.ndarray, lang: bytes, phrases: list[bytes]) -> np.ndarray:
    """Whether each phrase of a language has its bit set."""
    start = crc32(lang + b"\n")
    at = np.fromiter((crc32(p, start) for p in phrases), np.int64, len(phrases)) & ((1 << FILTER_BITS) - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).view(bool)


def _bitmap(rows: DataFrame) -> np.ndarray:
    """The places of (lang, phrase) rows as a bitmap of fixed size."""
    at = _place(F.col("lang"), F.col("phrase")) + 1
    parts = rows.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for row in parts.toLocalIterator():  # at most as many parts as the bitmap has
        begin = (row.part - 1) * 4096
        out[begin : begin + 4096] = np.frombuffer(row.bits, np.uint8)
    return out


class _Chunk:
    """The words of some texts of one language as numbers, -1 between pieces and between texts."""

    def __init__(self):
        number = defaultdict(itertools.count().__next__)
        number[b"."] = -1  # the mark of a cut, given without counting
        self.number, self.parts, self.size = number, [], 0

    def add(self, text: bytes) -> None:
        words = text.translate(_PLAIN).replace(b".", b" . ").split()
        self.parts.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
        self.parts.append(np.array([-1]))
        self.size += len(words)

    def taken(self) -> tuple[np.ndarray, list[bytes]]:
        """(numbers, words by number), and the chunk is empty again."""
        codes = np.concatenate(self.parts)
        words = [w for w in self.number if w != b"."]
        self.__init__()
        return codes, words


def _joined(words: pa.Array, grams: list[np.ndarray]) -> pa.Array:
    """Phrases of words by number, one array a place."""
    parts = [words.take(pa.array(g)) for g in grams]
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))


def _single(codes: np.ndarray, words: list[bytes], lang: bytes, shared) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Every word with its count."""
    counts = np.bincount(codes[codes >= 0], minlength=len(words))
    yield 1, pa.array(words, pa.binary()), counts


def _pairs(codes: np.ndarray, words: list[bytes], lang: bytes, shared) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Pairs of neighbouring words that are both frequent, with their counts."""
    frequent = np.append(_bits(shared.value, lang, words), False)[codes]  # -1 takes the last, False
    at = np.flatnonzero(frequent[:-1] & frequent[1:])
    pairs, counts = np.unique(codes[at] * len(words) + codes[at + 1], return_counts=True)
    named = pa.array(words, pa.binary())
    yield 2, _joined(named, list(np.divmod(pairs, max(1, len(words))))), counts


def _longer(max_words: int):
    def run(codes: np.ndarray, words: list[bytes], lang: bytes, shared) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """Phrases of three words and more in which each pair of neighbours is frequent, with their counts."""
        inside = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
        pairs, back = np.unique(codes[inside] * len(words) + codes[inside + 1], return_inverse=True)
        named = pa.array(words, pa.binary())
        kept = _bits(shared.value, lang, _joined(named, list(np.divmod(pairs, max(1, len(words))))).to_pylist())
        good = np.zeros(len(codes), bool)
        good[inside] = kept[back]
        # ``gram`` numbers the phrases that begin at ``at``; one word more gives the next ones
        at = np.flatnonzero(good)
        gram = np.unique(codes[at] * len(words) + codes[at + 1], return_inverse=True)[1]
        for n in range(3, max_words + 1):
            on = np.append(good, np.zeros(n, bool))[at + n - 2]
            at, gram = at[on], gram[on]
            if not len(at):
                return
            _, first, gram, counts = np.unique(gram * len(words) + codes[at + n - 1], return_index=True, return_inverse=True, return_counts=True)
            yield n, _joined(named, [codes[at[first] + k] for k in range(n)]), counts

    return run


def _counted(count, shared=None):
    """Counts of the phrases that ``count`` finds in chunks of a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, _Chunk] = defaultdict(_Chunk)

        def told(lang: str) -> Iterator[pa.RecordBatch]:
            codes, words = chunks[lang].taken()
            for n, phrases, counts in count(codes, words, lang.encode(), shared):
                for k in range(0, len(phrases), 1 << 16):
                    part = phrases[k : k + (1 << 16)]
                    columns = [pa.array([lang] * len(part), pa.string()), pa.array(np.full(len(part), n, np.int32)), part.cast(pa.string()), pa.array(counts[k : k + (1 << 16)])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                chunks[lang].add(text)
                if chunks[lang].size >= CHUNK_WORDS:
                    yield from told(lang)
            if sum(c.size for c in chunks.values()) >= 2 * CHUNK_WORDS:  # many languages, each with little
                for lang in list(chunks):
                    if chunks[lang].size:
                        yield from told(lang)
                    del chunks[lang]
        for lang in chunks:
            if chunks[lang].size:
                yield from told(lang)

    return run


def frequent_phrases(df: DataFrame, text_col: str, lang_col: str, max_words: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, n) of phrases of 1 to ``max_words`` words that occur ``min_count`` times or more in their language, (lang, total) occurrences of words).

    Phrases are exploded from each text and counted within the task, by numbers, before rows leave it; then Spark sums the rows by language and
    phrase, with partial sums. A phrase is never more frequent than a part of it, so in three passes over the texts only those of which all
    words, then all pairs of neighbours are frequent go to the shuffle. Which ones these are travels as a bitmap of fixed size: one that is
    crowded, with very many frequent phrases, lets more through and changes no count.
    """
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    summed = lambda rows: rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    often = F.col("n") >= min_count
    words = staged(summed(texts.mapInArrow(_counted(_single), ROWS)), "words")
    found, shared = words.where(often), None
    for count in ([_pairs] if max_words > 1 else []) + ([_longer(max_words)] if max_words > 2 else []):
        last = found if shared is None else level
        shared = spark.sparkContext.broadcast(_bitmap(last))
        level = staged(summed(texts.mapInArrow(_counted(count, shared), ROWS)).where(often), "phrases")
        found = found.unionByName(level)
    return found, words.groupBy("lang").agg(F.sum("n").alias("total"))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100, share: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``max_words`` words of each language.

    A-Z count as a-z. Texts are cut at ``.,;:!?`` and line ends into pieces and those at spaces and tabs into words; phrases never cross a cut. A phrase
    that occurs ``min_count`` times or more is a candidate. It is cut in two behind each of its words; with l and r occurrences of the two parts, a
    of the phrase and n words in the language, a cut scores floor(1000 a n / (l r)), in decimals of 38 digits. The lowest cut counts, the
    first of equal ones. A candidate whose words stand inside a longer one that has ``share`` percent of its occurrences goes. Since a
    longer phrase is never the more frequent, one word more is enough to look at.

    Ranked by score, then a, both from the top, then by the phrase's bytes. Each of 64 parts of a language gives its own first ones before those are ranked together, so no task
    gets all candidates of a language.

    A null language is ``und``, a null text an empty one. Rows are counted one by one, repeated ones too; ids play no part. Very long texts are one row of a
    chunk. Only the two named columns are read, so clashing names do no harm. An empty table gives an empty table.
    """
    counted, totals = frequent_phrases(df, text_col, lang_col, max_words, min_count)
    counts = staged(counted, "frequent")
    chosen = counts.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    # words joined: a space is in no word
    cut = chosen.withColumn("parts", F.split("phrase", " ", -1)).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    text = lambda begin, length: F.array_join(F.slice("parts", begin, length), " ")
    cut = cut.select("lang", "phrase", "a", "k", text(1, F.col("k")).alias("first"), text(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.join(lookup(totals, "languages"), "lang").withColumn("above", (1000 * F.col("a")).cast("decimal(19,0)") * wide("total")).withColumn("below", wide("l") * wide("r"))
    lowest = cut.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut"))
    shorter = chosen.where("words > 2").withColumn("parts", F.split("phrase", " ", -1))
    inner = shorter.select("lang", "a", F.explode(F.array(F.array_join(F.slice("parts", 1, F.col("words") - 1), " "), F.array_join(F.slice("parts", 2, F.col("words") - 1), " "))).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = lowest.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    rows = staged(left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "scored")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parted = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
