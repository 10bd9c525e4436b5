"""Encoding and decoding by the agenda against the library itself, over whole texts."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from canonlake.llm import sentencepieces as sp  # noqa: E402
from canonlake.llm.queries import piece_model  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def own():
    return sp.Vocabulary(piece_model())


ODD = ["", " ", "  ", "▁", " ▁ ", "a", " a", "a ", " a  b ", "\n", "a\n\nb", "\x00", "<s>", "</s> x", "<unk>", "<0x41>", "\t\tif x:\n    return  y\n", "ÄÖÜ straße", "日本語 テキスト", "🙂🙃 👨‍👩‍👧", "é é", "\ufeffx", "\u2028", "aaaa" * 50, "1234567890", "a▁b▁▁c", "▁▁", "\U0010ffff", "x" * 3000]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(own, library, text):
    (ids,), (agrees,) = own.encode([text], True, True, "words")
    want = library.encode(text, add_bos=True, add_eos=True)
    assert np.frombuffer(ids, "<u4").tolist() == want and agrees
    assert own.decode(np.array(want)) == library.decode(want)


def test_words_together_and_one_by_one(own):
    """The agenda as rows of an array and the one with a heap merge alike."""
    words = {w for w in ODD if sp.SPACE not in w and " " not in w} | {"the", "other" * 9, "straße,", "日本語x", "a🙂b", "\n\n", "l" * 79, "l" * 80}
    for word, ids in own.encoded(words).items():
        symbols = (own.ids.get(p, -2 - ord(p[0])) for p in own.merged(sp.SPACE + word))
        assert ids == own._with_bytes(np.fromiter(symbols, np.int64))


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" ▁\n\tthe inodraetsé日,.🙂0"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(own, library, text):
    (ids,), _ = own.encode([text], False, True, "none")
    want = library.encode(text, add_eos=True)
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert own.decode(np.array(want)) == library.decode(want)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=30))
def test_any_ids_decode_alike(own, library, ids):
    assert own.decode(np.array(ids, "<u4")) == library.decode(ids)


def test_where_the_library_differs_its_ids_are_taken(own, library, monkeypatch):
    fresh = sp.Vocabulary(piece_model())
    monkeypatch.setattr(fresh, "encoded", lambda words: {w: b"" if w else [*own.encoded([""]).values()][0] for w in words})
    ids, agrees = fresh.encode(["the other", ""], True, False, "words")
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == library.encode(["the other", ""], add_bos=True) and agrees == [False, True]
    fresh = sp.Vocabulary(piece_model())
    monkeypatch.setattr(fresh, "words", lambda text: [text])
    ids, agrees = fresh.encode(["a b", "ab"], False, False, "texts")
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == library.encode(["a b", "ab"])


def test_what_is_remembered_is_bounded(own, library, monkeypatch):
    fresh = sp.Vocabulary(piece_model())
    monkeypatch.setattr(sp, "REMEMBERED", 40)
    texts = [" ".join(f"w{k}x{j}" for j in range(9)) for k in range(12)] + ["y" * 100 + " z"]
    for text in texts + texts[:3]:
        (ids,), _ = fresh.encode([text], False, False, "none")
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
        assert len(fresh.known) <= 40 and len(fresh.older) <= 49 and all(len(w) <= sp.LONGEST for w in [*fresh.known, *fresh.older])


def test_rows_and_columns(spark, library):
    texts = [None, *ODD, "word " * 200_000, "a b", "a b"]
    df = spark.createDataFrame([(k % 20, t, "x", 1) for k, t in enumerate(texts)], "doc_id int, text string, IDS string, decoded int").repartition(3)
    for check, back in (("none", False), ("words", True), ("texts", False)):
        out = sp.encode(df, piece_model(), check=check, back=back)
        out = out if back else sp.decode(out, piece_model())
        assert set(out.columns) == {"doc_id", "text", "ids", "n_tokens", "agrees", "decoded"}
        rows = out.collect()
        assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((k % 20, t or "") for k, t in enumerate(texts))
        for r in rows:
            want = library.encode(r.text or "", add_bos=True, add_eos=True)
            assert (np.frombuffer(r.ids, "<u4").tolist(), r.n_tokens, r.agrees, r.decoded) == (want, len(want), True, library.decode(want))


def test_no_rows_null_ids_and_other_models(spark):
    empty = spark.createDataFrame([], "text string")
    assert sp.decode(sp.encode(empty, piece_model()), piece_model()).count() == 0
    assert sp.decode(spark.createDataFrame([(None,), (b"",)], "ids binary"), piece_model()).select("decoded").collect() == [(None,), ("",)]
    with pytest.raises(ValueError):
        sp.encode(empty, piece_model(), check="some")
