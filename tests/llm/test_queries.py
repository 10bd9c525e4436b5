"""The registered queries over a small table of odd rows, each against brute force, and each with its columns."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from canonlake.llm import queries as q
from tests.llm import test_packing, test_periodic_runs, test_phrases, test_quality_rules, test_simhash, test_suffix_dedup

WORDS = [f"{a}{b}" for a in "bcdfg" for b in ("rin", "lo", "st", "mun", "É")]
LONG = "a passage of well over fifty bytes that several of the documents share, word for word"


def documents():
    rng = random.Random(8)
    body = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    texts = {0: None, 1: "", 2: " \n\t", 3: "one", 4: "<|endoftext|> a"}
    for i in range(5, 90):
        texts[i] = body(rng.randint(1, 150)) + (f" {LONG} " + body(20) if i % 7 == 0 else "") + (" idiot scum " * 3 if i % 4 == 0 else "")
    texts |= {90 + k: texts[10 + k] for k in range(5)}
    texts[95] = body(3000)
    texts[96] = texts[20] + "!"
    texts |= {97: "So red wine, of old " * 130, 98: "of old so red " * 70}
    return texts


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path, texts = f"file://{tmp_path_factory.mktemp('sf')}", documents()
    rows = [(i, t, ["en", "fr", None][i % 3], "s", len(t or ""), "extra") for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string").repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 2), int(i % 4 == 0)) for i in range(5, 90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, LONG)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_op2_places_sizes_and_the_edited_map(spark, tables):
    path, texts = tables
    rows = q.QUERIES["op2_sharding"](spark, path).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert r.rebalanced_shard in (r.shard, 24)
    for shard in {r.shard for r in rows}:
        assert 0 <= shard < 24 and sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_op4_is_a_round_trip(spark, tables):
    path, texts = tables
    test_packing.check(q.QUERIES["op4_packing"](spark, path).collect(), texts, 2048)


def test_op6_matches_a_plain_search(spark, tables):
    path, texts = tables
    rows = q.QUERIES["op6_suffix_dedup"](spark, path).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, rows), key=str) == test_suffix_dedup.brute(list(texts.items()))


def test_op7_counts_and_verdicts(spark, tables):
    path, texts = tables
    for r in q.QUERIES["op7_quality_rules"](spark, path).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == test_quality_rules.brute(texts[r.doc_id])
        assert isinstance(r.kept, bool) and not (r.base_failed and r.kept)


def test_op7_verdict_is_that_of_numpy(spark, tables):
    """The query's own distance again, from the rows it kept apart: the estimate of least determinant of a plain search from many random starts is not better."""
    path, _ = tables
    from canonlake.llm import quality_rules as qr

    out = qr.quality_rules(spark.read.parquet(f"{path}/documents.parquet"), group_cols=("source", "source"), min_group=20)
    good = [r for r in out.collect() if not r.base_failed]
    data = np.array([[r[f] for f in qr.FEATURES] for r in good])
    floor = np.diag([qr.FLOORS[f] ** 2 for f in qr.FEATURES])
    h = int(np.ceil(0.75 * len(data)))

    def settle(subset):
        for _ in range(50):
            mean, cov = data[subset].mean(axis=0), np.cov(data[subset].T, bias=True) + floor
            d = np.einsum("ij,jk,ik->i", data - mean, np.linalg.inv(cov), data - mean)
            again = np.sort(np.argsort(d, kind="stable")[:h])
            if (again == subset).all():
                break
            subset = again
        return np.linalg.slogdet(cov)[1], d

    rng = np.random.default_rng(0)
    plain = min((settle(np.sort(rng.choice(len(data), h, replace=False))) for _ in range(60)), key=lambda x: x[0])
    stats = out.where("not base_failed").selectExpr("'g' as grp", *qr.FEATURES)
    fitted = qr.fit_groups(stats).first()
    logdet = 2 * sum(np.log(fitted[f"l{i}_{i}"]) for i in range(5))
    assert logdet <= plain[0] + 0.15  # bins let a few documents more into the half
    scale = max(1.0, np.median(plain[1]) / qr.CHI2_MEDIAN)
    far = {r.doc_id for r, d in zip(good, plain[1]) if d / scale > 60}
    near = {r.doc_id for r, d in zip(good, plain[1]) if d / scale < 25}
    assert all(not r.kept for r in good if r.doc_id in far) and all(r.kept for r in good if r.doc_id in near)


@pytest.mark.parametrize("name,n,rest,threshold", [("op8_quality_classifier", 5, 0, 0.3), ("op9_toxicity", 3, 1, 0.7)])
def test_op8_and_op9_hold_out_and_predict(spark, tables, name, n, rest, threshold):
    path, texts = tables
    rows = q.QUERIES[name](spark, path).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (crc(r.doc_id, n) == rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)


@pytest.mark.parametrize("name,n,rest", [("op8_quality_classifier", 5, 0), ("op9_toxicity", 3, 1)])
def test_held_out_labels_teach_nothing(spark, tables, tmp_path, name, n, rest):
    """The other way round, held-out labels give the same scores."""
    path, _ = tables
    first = {r.doc_id: r.score for r in q.QUERIES[name](spark, path).collect()}
    other = f"file://{tmp_path}"
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{table}.parquet").write.parquet(f"{other}/{table}.parquet")
    labels = [(r.doc_id, *((1 - r.quality, 1 - r.toxic) if crc(r.doc_id, n) == rest else (r.quality, r.toxic))) for r in spark.read.parquet(f"{path}/labels.parquet").collect()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{other}/labels.parquet")
    assert {r.doc_id: r.score for r in q.QUERIES[name](spark, other).collect()} == first


def test_op10_fingerprints_and_components(spark, tables):
    path, texts = tables
    rows = q.QUERIES["op10_simhash"](spark, path).collect()
    fps = {i: test_simhash.brute_fingerprint(t) for i, t in texts.items()}
    comps = test_simhash.brute_components(fps)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", comps[i]) for i in texts}


def test_queries_with_sql_match_it(spark, tables):
    duckdb = pytest.importorskip("duckdb")
    path, _ = tables
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path.removeprefix('file://')}/{table}.parquet/*.parquet'")
    for name, sql in q.ORACLES.items():
        want = con.sql(sql)
        df = q.QUERIES[name](spark, path).select(*want.columns)
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(want.fetchall(), key=repr), name


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op11_matches_a_plain_search(spark, tables):
    path, texts = tables
    rows = q.QUERIES["op11_periodic_runs"](spark, path).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and any(r.n_runs for r in rows)
    for r in rows:
        words, h = test_periodic_runs.WORDS.findall(texts[r.doc_id] or ""), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, kept = test_periodic_runs.brute(words)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *first)
        assert (r.runs_sha256, r.collapsed_sha256) == (sha("".join("%d,%d,%d\n" % x for x in runs)), sha(" ".join(kept)))


def test_op12_matches_a_plain_count(spark, tables):
    path, texts = tables
    rows = q.QUERIES["op12_phrase_collocations"](spark, path).collect()
    want = test_phrases.brute([(["en", "fr", None][i % 3], t) for i, t in texts.items()])
    assert want and sorted(map(tuple, rows)) == want


def test_op13_is_what_the_library_gives(spark, tables):
    import sentencepiece

    path, texts = tables
    library = sentencepiece.SentencePieceProcessor(model_file=q.piece_model())
    rows = q.QUERIES["op13_sentencepiece"](spark, path).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.agrees) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids)), True)
