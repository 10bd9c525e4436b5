"""Periodic runs of words by a harmonic grid and prefix hashes."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import fresh

#: Words of several documents that are searched together; a longer document is searched alone.
GROUP_WORDS = 1 << 18
#: Pairs of a grid point and a period that are compared at once.
PAIRS = 1 << 20
#: Moduli of the two prefix hashes: products of two residues fit 64 bits.
PRIMES = (np.uint64(2**31 - 1), np.uint64(2**31 - 19))


class PrefixHashes:
    """Sums of word values times powers of a base, over two primes: equal stretches have equal hashes."""

    def __init__(self, codes: np.ndarray, rng: np.random.Generator):
        self.parts = []
        for prime in PRIMES:
            base = np.uint64(rng.integers(1 << 20, (1 << 31) - 20))
            powers = np.ones(len(codes) + 1, np.uint64)
            done, step = 1, base
            while done < len(powers):  # powers[done:2 * done] are powers[:done] times base ** done
                more = min(done, len(powers) - done)
                powers[done : done + more] = powers[:more] * step % prime
                done, step = done + more, step * step % prime
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:-1] % prime, out=sums[1:])
            self.parts.append((prime, powers, sums % prime))

    def equal(self, left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``length`` from ``left`` and from ``right``, which is later, have equal hashes."""
        out = np.ones(len(left), bool)
        for prime, powers, sums in self.parts:
            a = (sums[left + length] + prime - sums[left]) % prime * powers[right - left] % prime
            out &= a == (sums[right + length] + prime - sums[right]) % prime
        return out


def _longest(fits, most: np.ndarray) -> np.ndarray:
    """For each element the largest length up to ``most`` that fits, by binary search over all of them at once; what fits a length fits any shorter one."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        middle = (low + high + 1) >> 1
        good = fits(middle)
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return low


def _grid(sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, period, place in it) of all grid points, in blocks of about PAIRS.

    The words of a run that have an equal one a period later are a stretch of ``max(least, times * period) - period`` at least,
    so a grid of that step meets it. The steps grow with the period: n words have about n log n points.
    """
    periods = np.where(sizes >= least, sizes // times, 0)
    doc = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(least - period, (times - 1) * period)
    points = -((period - sizes[doc]) // step)
    ends = np.cumsum(points)
    first = 0
    while first < len(doc):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")))
        n = points[first:last]
        row = np.repeat(np.arange(first, last), n)
        place = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * step[row]
        yield doc[row], period[row], place
        first = last


def _candidates(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray, least: int, times: int, hashes: PrefixHashes) -> np.ndarray:
    """Rows (document, start, end, period), places in ``codes``, sorted and without repeats; of equal stretches the least period."""
    found = []
    for doc, period, place in _grid(sizes, least, times):
        left = begins[doc] + place
        right = left + period
        same = np.flatnonzero(codes[left] == codes[right])
        doc, period, left, right = doc[same], period[same], left[same], right[same]
        begin, end = begins[doc], begins[doc] + sizes[doc]
        # the stretch goes on for half of its least length to one side or the other
        half = (np.maximum(least - period, (times - 1) * period) + 1) >> 1
        ahead, behind = right + half <= end, left - half >= begin
        ahead[ahead] = hashes.equal(left[ahead], right[ahead], half[ahead])
        behind &= ~ahead
        behind[behind] = hashes.equal((left - half)[behind], (right - half)[behind], half[behind])
        good = np.flatnonzero(ahead | behind)
        doc, period, left, right, begin, end = (x[good] for x in (doc, period, left, right, begin, end))
        forward = _longest(lambda n: hashes.equal(left, right, n), end - right)
        back = _longest(lambda n: hashes.equal(left - n, right - n, n), left - begin)
        start, stop = left - back, right + forward
        long = stop - start >= np.maximum(least, times * period)
        found.append(np.unique(np.stack([doc, start, stop, period], 1)[long], axis=0))
    rows = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 4), np.int64)
    again = np.zeros(len(rows), bool)
    again[1:] = (rows[1:, :3] == rows[:-1, :3]).all(1)
    return rows[~again]


def _verified(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> bool:
    """Whether the words themselves bear out every run, and no neighbouring word extends one."""
    for doc, start, stop, period in rows.tolist():
        if not np.array_equal(codes[start : stop - period], codes[start + period : stop]):
            return False
        if start > begins[doc] and codes[start - 1] == codes[start - 1 + period]:
            return False
        if stop < begins[doc] + sizes[doc] and codes[stop] == codes[stop - period]:
            return False
    return True


def find_runs(codes: np.ndarray, sizes: np.ndarray, least: int = 24, times: int = 3) -> np.ndarray:
    """Rows (document, start, length, period), sorted by document, start and period, for documents whose word numbers lie one behind the other in ``codes``.

    A run found under a multiple of its smallest period is the same stretch, as it has at least twice that multiple's words; it is
    kept once. Hashes only ever make a stretch too long; then the words say so and all is done again with other bases.
    """
    begins = np.cumsum(sizes) - sizes
    for attempt in itertools.count():
        rows = _candidates(codes, begins, sizes, least, times, PrefixHashes(codes, np.random.default_rng(attempt)))
        if _verified(codes, begins, sizes, rows):
            break
    out = np.stack([rows[:, 0], rows[:, 1] - begins[rows[:, 0]], rows[:, 2] - rows[:, 1], rows[:, 3]], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that are in no run behind its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, runs[:, 1] + runs[:, 2], -1)
    return b" ".join(itertools.compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def _groups(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """The words of texts, in groups of about GROUP_WORDS. White space is that of ASCII, as ``bytes.split`` has it."""
    group, held = [], 0
    for text in texts:
        words = (text or b"").split()
        if group and held + len(words) > GROUP_WORDS:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group


def _searched(least: int, times: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batch: pa.Array) -> pa.Array:
        counts, numbers, parts, texts = [], [], [], []
        for group in _groups(batch.cast(pa.binary()).to_pylist()):
            number = defaultdict(itertools.count().__next__)
            sizes = np.fromiter(map(len, group), np.int64, len(group))
            codes = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(group)), np.int64, int(sizes.sum()))
            rows = find_runs(codes, sizes, least, times)
            each = np.bincount(rows[:, 0], minlength=len(group))
            ends = np.cumsum(each).tolist()
            texts += [collapsed(words, rows[e - n : e]) for words, n, e in zip(group, each.tolist(), ends)]
            counts.append(sizes)
            numbers.append(each)
            parts.append(rows)
        rows = np.concatenate(parts) if parts else np.empty((0, 4), np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(numbers))]) if numbers else np.zeros(1)
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in (1, 2, 3)], fields=list(kind)))
        n_words = pa.array(np.concatenate(counts) if counts else [], pa.int64())
        return pa.StructArray.from_arrays([n_words, runs, pa.array(texts, pa.binary()).cast(pa.string())], names=["n_words", "runs", "collapsed"])

    return run


def periodic_runs(df: DataFrame, text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """All rows and columns of ``df`` with ``n_words``, ``runs`` (start, length and period, in words, by start and period) and ``collapsed`` added.

    Words are what ASCII white space leaves, numbered from 0. A run is a stretch of consecutive words with smallest period q, of
    ``max(least, times * q)`` words or more, which no neighbouring word extends. ``collapsed`` is the text without the words that a run
    contains behind its first q, joined by one space.

    Rows are searched where they lie, so nothing is shuffled and no key is hot. The grid of n words has about n log n points; those whose
    word comes again a period later are extended to both sides by binary search over prefix hashes, all at once, and the
    words themselves verify every run. Texts of any length are searched whole; memory is that of one text, or of 262,144 words of short ones.

    A null or empty text has no words, no runs and an empty collapsed text. Repeated rows and ids are searched row by row; ids play no part.
    Input columns of the three names are replaced. An empty table gives an empty table. ``times`` must be 2 or more.
    """
    if times < 2:
        raise ValueError("a run must hold its period twice at least")
    search = F.arrow_udf(_searched(least, times), "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string").asNondeterministic()  # so that no plan computes it twice
    added = ["n_words", "runs", "collapsed"]
    (found,) = fresh(df, "__found")
    out = df.withColumn(found, search(F.col(text_col))).drop(*[c for c in df.columns if c.lower() in added and c != text_col])
    return out.withColumns({name: F.col(found)[name] for name in added}).drop(found)
