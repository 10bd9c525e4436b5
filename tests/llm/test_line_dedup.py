"""Line dedup against a plain version."""

import random
import re

from canonlake.llm.line_dedup import line_dedup

WS = " \t\n\x0b\f\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line).strip(WS)


def brute(docs, least=40, many=5):
    holders = {}
    for i, text in docs:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= least:
                    holders.setdefault(key(line), set()).add(i)
    hot = {k: max(h) for k, h in holders.items() if len(h) >= many}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or hot.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=str)


def test_matches_a_plain_version(spark):
    rng = random.Random(1)
    shared = ["Ä" + "x" * 39, "y" * 39, "Some License Line of more than forty characters, É", "  padded\t" + "z" * 40 + " \r", "q" * 40]
    docs = [(0, None), (1, ""), (2, "\n\n"), (None, "\n".join(shared)), (3, shared[0] + "\n" + shared[0])]
    for i in range(4, 40):
        lines = [rng.choice([*shared, shared[2].upper().replace("É", "É"), "unique line number %d with enough characters in it" % i, "", "short"]) for _ in range(rng.randint(1, 8))]
        docs.append((i, "\n".join(lines)))
    docs += [(39, docs[-1][1]), (39, shared[4] + "\nother"), (38, "long " * 50_000 + "\n" + shared[4])]
    df = spark.createDataFrame([(i, t, "s", 7) for i, t in docs], "doc_id long, text string, key string, n_lines int").repartition(3)
    out = line_dedup(df)
    assert set(out.columns) == {"doc_id", "text", "key", "n_lines", "n_dropped"}
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=str) == brute(docs)


def test_no_rows(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_line_of_a_document_may_go(spark):
    df = spark.createDataFrame([(i, "w" * 50) for i in range(6)], "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in line_dedup(df).collect()} == {(5, "w" * 50), *((i, "") for i in range(5))}


def test_columns_of_any_name_and_a_very_long_text(spark):
    long = "\n".join(f"line {i % 1000} of a text that goes on for very many lines" for i in range(100_000))
    docs = [(i, long if i < 2 else "\n".join(long.split("\n")[:1000])) for i in range(6)]
    df = spark.createDataFrame([(i, t, "a", i, "b") for i, t in docs], "doc_id long, text string, __ld_id string, __LD_ROW long, __ld_pos string")
    out = line_dedup(df)
    assert set(out.columns) == {*df.columns, "n_lines", "n_dropped"}
    rows = out.collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows) == brute(docs)
    assert all((r["__ld_id"], r["__LD_ROW"], r["__ld_pos"]) == ("a", r.doc_id, "b") for r in rows)
