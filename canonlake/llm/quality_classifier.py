"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame

from canonlake.llm.ftrl import labelled_sample, scored, train

BITS = 18
#: Words (letters, digits, bytes of wider characters) and runs of one sign.
TOKENS = re.compile(rb"[a-zA-Z0-9\x80-\xff]+|([^a-zA-Z0-9\x80-\xff\s])\1*")
#: Tokens whose features are counted at a time, so that memory does not follow the length of a text.
STRETCH = 1 << 18
_REPEAT, _CAPITALS = np.uint64(crc32(b"<repeat>")), np.uint64(crc32(b"<capitals>"))


def _places(a: np.ndarray) -> np.ndarray:
    return ((a * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and values sqrt(share) of one- and two-word features, a vector of length one.

    Besides each word in lower case there is a mark for words in capitals, and the pair of a word with itself is
    one feature whatever the word.
    """
    tokens = [m.group() for m in TOKENS.finditer(text)]
    found, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(tokens), STRETCH):
        part = tokens[at : at + STRETCH + 1]
        words = np.fromiter((crc32(t.lower()) for t in part), np.uint64, len(part))
        pairs = np.where(words[1:] == words[:-1], _REPEAT, words[:-1] * np.uint64(31) + words[1:] + np.uint64(1 << 40))
        capitals = np.full(sum(len(t) > 1 and t.isupper() for t in part[:STRETCH]), _CAPITALS)
        places, n = np.unique(_places(np.concatenate([words[:STRETCH], pairs, capitals])), return_counts=True)
        found.append(places)
        counts.append(n)
    places, which = np.unique(np.concatenate(found), return_inverse=True)
    n = np.bincount(which, np.concatenate(counts), len(places))
    return places, np.sqrt(n / max(1, n.sum()))


def quality_scores(docs: DataFrame, labels: DataFrame, allowed, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bound: int = 12_000, epochs: int = 3) -> DataFrame:
    """``id_col`` and score, the estimated probability of label 1, for every row of ``docs``.

    Training takes at most ``bound`` labelled documents, those first by hash of the id among the ones that meet
    ``allowed``, a condition on the id; scoring reads every whole text. The model is 2**18 weights.

    Null and empty texts score by the bias alone. Null ids are scored, and never trained on; null labels are left
    out. Without any label every score is one half. Repeated ids are scored row by row. An empty table
    gives an empty table. Only the named columns are read, so clashing names do no harm.
    """
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, allowed, bound)
    weights = train(sample, features, 1 << BITS, epochs, alpha=1.0, l1=0.05, l2=0.1)
    return scored(docs, id_col, text_col, features, weights)
