"""Encoding and decoding with a merge-type vocabulary of sentence pieces."""

from __future__ import annotations

import codecs
import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import fresh

#: Fixed value: the character that stands for a space in pieces.
SPACE = "▁"
#: Words whose ids a worker remembers, at most twice as many in passing, and the longest of them in characters; others are encoded each time.
REMEMBERED, LONGEST = 1 << 17, 64
#: Lengths up to which words are encoded together, and how many symbols at once; a longer word is encoded by itself.
LENGTHS, CELLS = (8, 12, 16, 24, 40, 80), 1 << 18
#: Beyond any id, and beyond any turn.
PAIR, NEVER = 1 << 21, 1 << 40

#: As the library decodes: each byte that is no part of a character is one replacement character.
codecs.register_error("each_byte", lambda error: ("�", error.start + 1))


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, message[at : at + size]
            at += size


class Vocabulary:
    """The pieces of a model file, encoding by an agenda of adjacent pairs, and decoding.

    No piece of such a vocabulary has a space behind another character, so no merge crosses the beginning of a word, and
    words are encoded one by one; vocabularies of which this is not true are refused.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        told = dict(_fields(self.library.serialized_model_proto()))  # the last of each repeated field; the two specs come once
        trained, normal = dict(_fields(told[2])), dict(_fields(told[3]))
        # fixed values of the format: model type 2 merges pairs; fields 3 to 5 of the normalizer are the space before a text, spaces removed, spaces shown
        if trained.get(3, 1) != 2 or normal.get(1) != b"identity" or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1) or trained.get(24, 0):
            raise ValueError(f"{path} is no merge-type vocabulary over unchanged texts")
        ids = range(self.library.vocab_size())
        pieces = self.library.id_to_piece(list(ids))
        self.bytes = {bytes.fromhex(pieces[i][3:5])[0]: i for i in ids if self.library.is_byte(i)}
        plain = [i for i in ids if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i))]
        if len(self.bytes) != 256 or any(self.library.is_unused(i) for i in ids) or any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError(f"{path} has pieces that this encoder does not know how to merge")
        self.ids = {pieces[i]: i for i in plain}
        self.scores = {pieces[i]: self.library.get_score(i) for i in plain}
        # symbols are ids of pieces; a character without a piece is -2 less its code, which joins nothing
        self.symbols = -2 - np.arange(0x110000)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        # every pair of pieces that is a piece: (first * PAIR + second) in order, the piece, and its place by score, equal scores alike
        split = [(self.ids[p[:k]] * PAIR + self.ids[p[k:]], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        keys, joint = np.array(sorted(split), np.int64).reshape(-1, 2).T
        scores = np.unique(-np.array([self.library.get_score(i) for i in ids]), return_inverse=True)[1]
        self.pairs, self.joint, self.turn = np.append(keys, np.iinfo(np.int64).max), np.append(joint, -1), np.append(scores[joint], NEVER)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        # what each id decodes to
        self.shown = [b""] * len(ids)
        for i in ids:
            if self.library.is_byte(i):
                self.shown[i] = bytes.fromhex(pieces[i][3:5])
            elif self.library.is_unknown(i):
                self.shown[i] = trained.get(44, " ⁇ ".encode())
            elif not self.library.is_control(i):
                self.shown[i] = pieces[i].replace(SPACE, " ").encode()
        self.leading = {i for i in plain if pieces[i].startswith(SPACE)}
        self.silent = {i for i in ids if self.library.is_control(i)}
        # words of late, and those before them: what is met again moves to the first, the rest goes when that is full
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.differing: set[str] = set()

    def merged(self, symbols: str) -> list[str]:
        """The symbols that are left when adjacent pairs have been merged, the best score first and of equal ones the leftmost."""
        parts: list[str] = list(symbols)
        last, scores = len(parts) - 1, self.scores
        before, after = list(range(-1, last)), list(range(1, last + 2))
        agenda = []
        for left in range(last):
            both = parts[left] + parts[left + 1]
            if both in scores:
                agenda.append((-scores[both], left, left + 1, both))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            if not parts[left] or not parts[right] or parts[left] + parts[right] != both:
                continue  # one of the two has been merged with another meanwhile
            parts[left], parts[right] = both, ""
            following = after[left] = after[right]
            leading = before[left]
            if following <= last:
                before[following] = left
                if (more := both + parts[following]) in scores:
                    heapq.heappush(agenda, (-scores[more], left, following, more))
            if leading >= 0 and (more := parts[leading] + both) in scores:
                heapq.heappush(agenda, (-scores[more], leading, left, more))
        return [p for p in parts if p]

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(turn, joint piece) of pairs of symbols; NEVER where they are no piece."""
        wanted = np.where((left >= 0) & (right >= 0), left * PAIR + right, -1)
        at = np.searchsorted(self.pairs, wanted)
        good = self.pairs[at] == wanted
        return np.where(good, self.turn[at], NEVER), np.where(good, self.joint[at], -1)

    def _together(self, words: list[str]) -> list[bytes]:
        """The ids of words of like length, each a row of an agenda of its adjacent pairs: in every step each row merges its best pair, the leftmost of equal ones."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        codes = self.symbols[np.frombuffer("".join(SPACE + w for w in words).encode("utf-32-le"), "<u4")]
        width = int(size.max())
        symbol = np.full((len(words), width + 1), -1, np.int64)
        row = np.repeat(np.arange(len(words)), size)
        symbol[row, np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)] = codes
        turn, joint = (np.ascontiguousarray(x) for x in self._found(symbol[:, :-1], symbol[:, 1:]))
        open_, columns = np.arange(len(words)), np.arange(width)
        done = symbol.copy()
        while len(open_):
            rows = np.arange(len(open_))
            best = turn.argmin(1)
            going = turn[rows, best] < NEVER
            if not going.all():
                done[open_[~going]] = symbol[~going]
                open_, symbol, turn, joint, best = open_[going], symbol[going], turn[going], joint[going], best[going]
                rows = np.arange(len(open_))
            new = joint[rows, best]
            later = np.minimum(columns + (columns > best[:, None]), width - 1)  # what is behind the pair moves up by one
            symbol[:, :-1] = np.take_along_axis(symbol, columns + (columns > best[:, None]), 1)
            turn, joint = np.take_along_axis(turn, later, 1), np.take_along_axis(joint, later, 1)
            symbol[:, -1], turn[:, -1] = -1, NEVER
            symbol[rows, best] = new
            turn[rows, best], joint[rows, best] = self._found(new, symbol[rows, best + 1])
            behind = best > 0
            turn[rows[behind], best[behind] - 1], joint[rows[behind], best[behind] - 1] = self._found(symbol[rows[behind], best[behind] - 1], new[behind])
        plain, ends = done.astype("<u4"), (done != -1).sum(1).tolist()
        odd = set(np.flatnonzero((done < -1).any(1)).tolist())
        return [self._with_bytes(done[k, :n]) if k in odd else plain[k, :n].tobytes() for k, n in enumerate(ends)]

    def _with_bytes(self, symbols: np.ndarray) -> bytes:
        """Ids of symbols, of which a character without a piece is its bytes."""
        out: list[int] = []
        for s in symbols.tolist():
            out.extend([s] if s >= 0 else [self.bytes[b] for b in chr(-2 - s).encode()])
        return array("I", out).tobytes()

    def encoded(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of words with the space before each, little-endian, four bytes each. Words of like length go together; a very long one has a heap for its agenda."""
        out: dict[str, bytes] = {}
        alike: dict[int, list[str]] = {}
        for word in words:
            size = next((n for n in LENGTHS if len(word) < n), 0)
            if not size:
                symbols = (self.ids.get(p, -2 - ord(p[0])) for p in self.merged(SPACE + word))
                out[word] = self._with_bytes(np.fromiter(symbols, np.int64))
            else:
                alike.setdefault(size, []).append(word)
        for size, group in alike.items():
            step = max(1, CELLS // size)
            for k in range(0, len(group), step):
                out.update(zip(group[k : k + step], self._together(group[k : k + step])))
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text, each without the first space before it; spaces that follow one another stay with the word behind them."""
        if "  " not in text and SPACE not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ") if text else []
        shown = (SPACE + text.replace(" ", SPACE)) if text else ""
        return [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", shown)]

    def encode(self, texts: list[str], begin: bool, end: bool, check: str) -> tuple[list[bytes], list[bool]]:
        """The ids of each text and whether the library agrees; where it doesn't, they are the library's."""
        split = [self.words(t) for t in texts]
        here = set(chain.from_iterable(split))
        ids = {w: self.known[w] for w in here.intersection(self.known)}
        again = {w: self.older[w] for w in here.difference(ids).intersection(self.older)}
        ids.update(again)
        new = self.encoded(here.difference(ids))
        if check != "none":
            # the library puts a space before a text itself; a space alone is not told apart from no text
            asked = [w for w in new if w]
            for w, theirs in zip(asked, self.library.encode(asked, num_threads=1)):
                if new[w] != (theirs := array("I", theirs).tobytes()):
                    new[w] = theirs
                    self.differing.add(w)
        ids.update(new)
        self.known.update(again)
        self.known.update((w, x) for w, x in new.items() if len(w) <= LONGEST)
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        find = ids.__getitem__
        head, tail = (np.array([i] if on else [], "<u4").tobytes() for i, on in ((self.begin, begin), (self.end, end)))
        out = [head + b"".join(map(find, words)) + tail for words in split]
        agrees = [True] * len(texts) if not self.differing else [self.differing.isdisjoint(words) for words in split]
        if check == "texts":
            for k, theirs in enumerate(self.library.encode(texts, num_threads=1)):
                theirs = head + np.array(theirs, "<u4").tobytes() + tail
                if theirs != out[k]:
                    out[k], agrees[k] = theirs, False
        return out, agrees

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, the space before the first one left out, bytes that are no character replaced."""
        numbers = ids.tolist()
        shown = b"".join([self.shown[i] for i in numbers])
        first = next((i for i in numbers if i not in self.silent), None)
        return (shown[1:] if first in self.leading else shown).decode("utf-8", "each_byte")


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once a worker."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _slices(texts: Iterable[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in lists of about ``chars`` characters, so that what is split at once is bounded."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encoded(path: str, begin: bool, end: bool, check: str, back: bool):
    def run(batch: pa.Array) -> pa.Array:
        found, ids, agrees = vocabulary(path), [], []
        for texts in _slices(pc.fill_null(batch, "").to_pylist()):
            some, good = found.encode(texts, begin, end, check)
            ids += some
            agrees += good
        columns = {"ids": pa.array(ids, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "agrees": pa.array(agrees, pa.bool_())}
        if back:
            columns["decoded"] = pa.array([found.decode(np.frombuffer(x, "<u4")) for x in ids], pa.string())
        return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))

    return run


def _decoded(path: str):
    def run(batch: pa.Array) -> pa.Array:
        found = vocabulary(path)
        return pa.array([None if x is None else found.decode(np.frombuffer(x, "<u4")) for x in batch.to_pylist()], pa.string())

    return run


def encode(df: DataFrame, model_path: str, text_col: str = "text", begin: bool = True, end: bool = True, check: str = "words", back: bool = False) -> DataFrame:
    """All rows and columns of ``df`` with ``ids`` (little-endian, four bytes each), ``n_tokens`` and ``agrees`` added.

    Symbols begin as characters; the adjacent pair whose joint piece has the best score, of equal ones the leftmost, is merged until
    no pair is a piece. What a word gives is remembered. In every Arrow batch the sentencepiece library encodes what was
    encoded anew: with ``check`` "words" each word, with "texts" each whole text as well, with "none" nothing. Where it differs its ids
    are taken and ``agrees`` is false. With ``back`` the ids are decoded in the same pass, as ``decode`` does, into ``decoded``.

    Rows are encoded where they lie: no shuffle, and no key is hot. A null text is an empty one, whose ids are those of its beginning
    and end alone. Texts of any length are encoded whole. Repeated rows are encoded row by row. Input columns of the
    names added are replaced. An empty table gives an empty table. The model file must lie at ``model_path`` on every machine.
    """
    if check not in ("none", "words", "texts"):
        raise ValueError(f"check is none, words or texts, not {check}")
    added = {"ids": "binary", "n_tokens": "long", "agrees": "boolean"} | ({"decoded": "string"} if back else {})
    (found,) = fresh(df, "__found")
    encoded = F.arrow_udf(_encoded(model_path, begin, end, check, back), ", ".join(f"{c} {t}" for c, t in added.items())).asNondeterministic()  # so that no plan computes it twice
    out = df.withColumn(found, encoded(F.col(text_col)))
    out = out.drop(*[c for c in df.columns if c.lower() in added and c != text_col])
    return out.withColumns({name: F.col(found)[name] for name in added}).drop(found)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """All rows and columns of ``df`` with the text of its ids as ``to``, which is replaced where it is there.

    Ids are little-endian, four bytes each, as ``encode`` gives them. Those of a text's beginning and end decode to nothing, null to null, bytes that
    are no character to replacement characters. An id beyond the vocabulary is an error. An empty table gives an empty table.
    """
    return df.withColumn(to, F.arrow_udf(_decoded(model_path), "string")(F.col(ids_col)))
