"""Toxicity: noisy-channel deobfuscation under a character model of the corpus, then a score of the restored text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm.ftrl import labelled_sample, scored, train

BITS = 20
#: What a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t"}
#: The model's characters: the bound of a word, a-z, and one for all others.
SIGNS = 28
OTHER = 27
#: Log probabilities of the channel: a letter written as a sign, a sign meant as such, an exclamation mark meant as such at the end of
#: a word, a letter written three times or more, a letter written twice.
AS_SIGN, AS_SUCH, AT_END, REPEATED, DOUBLED = -1.0, -9.0, -1.0, -1.0, -6.0
#: A separator between single characters that was put there, and one that was meant.
PUT_IN, MEANT = -0.5, -3.0

_CODE = np.full(256, OTHER, np.int64)
_CODE[list(b" \t\n\x0b\f\r")] = 0
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[list(b".,;:?!\"'()[]{}/")] = 0
_CODES = _CODE[:128].tolist()
#: Spans worth decoding: three or more single characters with separators between them, words with a sign among or after the
#: letters (exclamation marks after a word that has no other sign are punctuation), words with a letter twice in a row or oftener.
SPANS = re.compile(
    rb"(?<![a-z0-9@$!|+\x80-\xff])(?=[^a-z]{0,8}[a-z])[a-z0-9@$](?:[ ._*-]{1,3}[a-z0-9@$!|+]){2,}(?![a-z0-9@$|+\x80-\xff])"
    rb"|(?<![a-z0-9@$!|+\x80-\xff])(?=[0-9@$!|+]*[a-z])(?=[a-z]*(?:[0-9@$|+]|![a-z0-9@$!|+]*[a-z0-9@$|+]))[a-z0-9@$!|+]+(?![a-z0-9\x80-\xff])"
    rb"|(?<![a-z\x80-\xff])[a-z]*([a-z])\1[a-z]*(?![a-z\x80-\xff])"
)
_SPACED = re.compile(r".(?:[ ._*-]{1,3}.)+", re.S)
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of the beginnings of words that are features.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Spans whose reading a worker remembers; a full memory is emptied, which changes no result.
REMEMBERED = 200_000


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SIGNS**3, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for at in range(0, len(text), 1 << 20):
                code = _CODE[np.frombuffer(text[at : at + (1 << 20)], np.uint8)]
                code = np.concatenate([[0, 0] if at == 0 else _CODE[np.frombuffer(text[at - 2 : at], np.uint8)], code])
                counts += np.bincount((code[:-2] * SIGNS + code[1:-1]) * SIGNS + code[2:], minlength=SIGNS**3)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["trigram", "n"])


def character_model(docs: DataFrame, text_col: str) -> np.ndarray:
    """Log probabilities of a character after two others, from the trigrams of all texts, smoothed by shorter contexts.

    Partial counts per partition are summed by trigram; 28**3 sums at most reach the driver.
    """
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = texts.mapInArrow(_trigrams, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    three = np.zeros(SIGNS**3)
    for row in rows:
        three[row.trigram] = row.n
    three = three.reshape(SIGNS, SIGNS, SIGNS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SIGNS)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3)


class Decoder:
    """Viterbi over the lattice of a span: readings of each character, scored by the channel and the character model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[bytes, bytes] = {}

    def read(self, span: bytes) -> bytes:
        found = self.known.get(span)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[span] = self._viterbi(self._lattice(span.decode("ascii"))).encode()
        return found

    @staticmethod
    def _lattice(span: str) -> list[list[tuple[str, float]]]:
        """For each place the readings: text that it adds (may be none) and log probability.

        A run of one letter or sign is one place, which stands for the run, for one letter or for two. Between single
        characters a separator is a place of its own: nothing, or the end of a word.
        """
        out: list[list[tuple[str, float]]] = []
        spaced = _SPACED.fullmatch(span) is not None
        ending = len(span.rstrip("$!|+"))
        for run in re.finditer(r"[ ._*-]+|(.)\1*", span):
            c, n = run.group(1), len(run.group())
            if c is None:
                out.append([("", PUT_IN), (" ", MEANT)])
            elif c.isalpha():
                if spaced or n == 1:
                    out += [[(c, 0.0)]] * n
                elif n == 2:
                    out.append([(c + c, 0.0), (c, DOUBLED)])
                else:
                    out.append([(c, REPEATED), (c + c, REPEATED)])
            else:
                such = AT_END if c == "!" and run.start() >= ending and not spaced else AS_SUCH
                plain = [(c, such)] + [(x, AS_SIGN) for x in LEET.get(c, "")]
                if n < 3:
                    out += [plain] * n
                else:
                    out.append([(x, p + REPEATED) for x, p in plain] + [(x + x, 2 * p + REPEATED) for x, p in plain])
        return out

    def _viterbi(self, lattice: list[list[tuple[str, float]]]) -> str:
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for readings in lattice:
            step: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in best.items():
                for text, cost in readings:
                    x, y, total = a, b, score + cost
                    for c in text:
                        z = _CODES[ord(c)]
                        total += self.model[x][y][z]
                        x, y = y, z
                    if (x, y) not in step or total > step[x, y][0]:
                        step[x, y] = (total, (path, text))
            best = step
        ended = ((s + self.model[a][b][0], path) for (a, b), (s, path) in best.items())
        path = max(ended, key=lambda e: e[0])[1]
        out = []
        while path:
            path, text = path
            out.append(text)
        return "".join(reversed(out))


class Restorer:
    """Texts with their spans read, and the words of both."""

    def __init__(self, model: np.ndarray):
        self.decoder = Decoder(model)

    def restored(self, text: bytes) -> bytes:
        """``text`` with A-Z in lower case and every span replaced by its reading."""
        return SPANS.sub(lambda m: self.decoder.read(m.group()), text.lower())

    def features(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The words of the restored text and their beginnings, each with 1 + the logarithm of its count."""
        counted = Counter(self.restored(text).translate(WORDS).split())
        if not counted:
            return np.empty(0, np.int64), np.empty(0)
        words, counts = list(counted), np.fromiter(counted.values(), np.int64, len(counted))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        head = np.array(words, "S8").view("<u8")  # the first eight bytes, zeros behind shorter words
        places, times = [np.fromiter(map(crc32, words), np.int64, len(words)) >> (32 - BITS)], [counts]
        for n in BEGINNINGS:
            longer = sizes > n
            start = head[longer] & np.uint64((1 << 8 * n) - 1)
            places.append((((start + np.uint64(n)) * _MIX ^ start >> np.uint64(29)) * _MIX >> np.uint64(64 - BITS)).astype(np.int64))
            times.append(counts[longer])
        at, which = np.unique(np.concatenate(places), return_inverse=True)
        return at, 1 + np.log(np.bincount(which, np.concatenate(times), len(at)))


class _Lazy:
    """Features under a broadcast model; each worker builds its decoder once."""

    def __init__(self, shared):
        self.shared, self.restorer = shared, None

    def __getstate__(self):
        return {"shared": self.shared, "restorer": None}

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        if self.restorer is None:
            self.restorer = Restorer(self.shared.value)
        return self.restorer.features(text)


def toxicity_scores(docs: DataFrame, labels: DataFrame, allowed, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bound: int = 12_000, epochs: int = 8) -> DataFrame:
    """``id_col`` and score, the estimated probability of label 1, for every row of ``docs``.

    The character model counts the trigrams of all texts of ``docs``. Under it the likeliest reading of each
    obfuscated span (signs for letters, letters set apart, letters repeated) is found by Viterbi decoding;
    the words of the text so restored, and their beginnings of 3 to 8 bytes, are the features of a logistic regression with 2**20 hashed
    weights; the penalties were chosen by cross-validation inside the rows that may be learned from. It learns from at most ``bound`` labelled documents, those first by hash of the id among the ones that
    meet ``allowed``, a condition on the id. Every whole text is decoded and scored where it lies.

    Null and empty texts score by the bias alone. Null ids are scored, and never trained on; null labels are left
    out. Without any label every score is one half. Repeated ids are scored row by row. An empty table
    gives an empty table. Only the named columns are read, so clashing names do no harm.
    """
    model = _Lazy(docs.sparkSession.sparkContext.broadcast(character_model(docs, text_col)))
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, allowed, bound)
    weights = train(sample, model, 1 << BITS, epochs, alpha=1.0, l1=8.0, l2=0.1)
    return scored(docs, id_col, text_col, model, weights)
