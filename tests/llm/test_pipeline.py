"""The pipeline: stages take effect one after the other, against plain versions of each."""

import json
import random

import corpus_pipeline
from canonlake.llm.components import components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_components_match_brute_force(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 1), (3, None)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for i in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def write(spark, path, docs, items):
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_stages_do_what_they_say(spark, tmp_path):
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("rin", "lo", "st", "mun")]
    body = lambda n=120: "\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(n // 12))
    item = " ".join(f"item{k}" for k in range(14))
    line = "this line stands in very many documents of the corpus"
    docs = [(i, body(), "en", "s", 0) for i in range(60)]
    docs += [(100 + i, body() + "\n" + line, "en", "s", 0) for i in range(6)]
    docs += [(200, docs[0][1], "en", "s", 0), (201, "too short", "en", "s", 0), (202, body() + "\n" + item + "\n" + body(), "en", "s", 0), (203, None, None, None, None)]
    docs += [(204, "\n".join(f"item{j} " + item for j in range(8)), "en", "s", 0)]
    path = f"file://{tmp_path}"
    write(spark, path, docs, [(1, item)])
    now, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, path)
        if name != "packing":
            assert now.columns == [c.split()[0] for c in COLUMNS.split(", ")]
            seen[name] = {r.doc_id: r.text for r in now.collect()}
    assert set(seen["quality_rules"]) == {d[0] for d in docs} - {201, 203, 204}
    lines = seen["line_dedup"]
    assert [i for i, t in lines.items() if line in t] == [105]
    assert set(lines) - set(seen["simhash"]) == {200}
    clean = seen["decontamination"]
    assert "item3" not in clean[202] and clean[202].count("\n") == docs[-3][1].count("\n") and clean[5] == lines[5]
    pieces = now.collect()
    assert {r.doc_id for r in pieces} == set(clean)
    whole = corpus_pipeline.run(spark, path).collect()
    key = lambda rows: sorted(json.dumps([r.doc_id, r.piece, r.start, r.length, r.ids_crc32]) for r in rows)
    assert key(whole) == key(pieces)


def test_no_documents(spark, tmp_path):
    path = f"file://{tmp_path}"
    write(spark, path, [], [])
    assert corpus_pipeline.run(spark, path).count() == 0


def test_near_copies_go_and_odd_rows_pass_through(spark, tmp_path):
    """Near copies of 0.8 and more, repeated rows, null ids, clashing columns and a very long text."""
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("rin", "lo", "st", "mun")]
    body = lambda n=150: [rng.choice(words) for _ in range(n)]
    pair = lambda n: " ".join(a + b for a, b in zip(body(n), body(n)))
    docs = [(i, pair(150 if i < 9 else int(60 * 100 ** rng.random())), "en", "s", 0) for i in range(60)]
    near = docs[3][1].split(" ")
    near[70] = "changed"  # five of 146 shingles differ
    far = docs[4][1].split(" ")
    for k in range(0, 150, 12):
        far[k] = "changed"
    docs += [(300, " ".join(near), "en", "s", 0), (301, " ".join(far), "en", "s", 0), (302, pair(30_000), "en", "s", 0), (None, docs[5][1], "en", "s", 0)]
    docs += [docs[7], docs[7], (8, pair(150), "en", "s", 0)]
    extra = spark.createDataFrame([(*d, "x", 1, True) for d in docs], COLUMNS + ", gone_id string, row int, same boolean")
    path = f"file://{tmp_path}"
    extra.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    now = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, path)
        assert now.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    ids = [r.doc_id for r in now.collect()]
    assert 300 not in ids and 301 in ids and 3 in ids and 302 in ids
    assert ids.count(None) == 1 and ids.count(7) == 3 and ids.count(8) == 2
    pieces = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in pieces} == set(ids)
