"""Entity resolution on small cases, and against brute force."""

import random

from pyspark.sql import functions as F

from canonlake.functions import scalars as S
from canonlake.operators import integrity, resolve
from canonlake.plans import analytics, orchestrator


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def people(spark, data):
    return spark.createDataFrame(data, "id string, tokens array<string>, birth_date string, club string")


def test_token_pairs_match_brute_force(spark):
    rng = random.Random(3)
    draw = lambda: sorted({rng.choice("abcdefgh") for _ in range(rng.randint(0, 3))})
    left = [(f"l{k}", draw(), rng.choice("xy")) for k in range(60)]
    right = [(f"r{k}", draw(), rng.choice("xy")) for k in range(60)]
    frame = lambda d: spark.createDataFrame(d, "id string, tokens array<string>, competition string")
    want = sorted((a, b) for a, s, c in left for b, t, d in right if c == d and s and t and (set(s) <= set(t) or set(t) <= set(s)))
    assert rows(resolve.token_pairs(frame(left), frame(right), ["competition"])) == want
    want = sorted((a, b) for a, s, _ in left for b, t, _ in right if s and t and (set(s) <= set(t) or set(t) <= set(s)))
    assert rows(resolve.token_pairs(frame(left), frame(right))) == want


def verdicts(spark, left, right):
    left, right = people(spark, left), people(spark, right)
    pairs = resolve.candidates(left, right.where("club is not null"), right)
    return {r.left_id: (r.right_id, r.motivo) for r in resolve.resolve(left, right, pairs)[0].collect()}


def test_verdicts_by_tier(spark):
    left = [
        ("club", ["ana"], "", "t1"),
        ("differs", ["bea"], "2000-01-01", "t1"),
        ("several", ["cid"], "", "t1"),
        ("born", ["nick"], "1999-09-09", "t2"),
        ("global", ["eva"], "1990-05-05", None),
        ("undated", ["fay"], "", None),
        ("nobody", ["zoe"], "1990-01-01", "t1"),
        ("wide", ["gil"], "1980-01-01", None),
    ]
    right = [
        ("1", ["ana", "x"], "2001-01-01", "t1"),
        ("2", ["bea"], "2000-01-02", "t1"),
        ("3", ["cid", "a"], "", "t1"),
        ("4", ["cid", "b"], "", "t1"),
        ("5", ["real", "name"], "1999-09-09", "t2"),
        ("6", ["eva"], "1990-05-05", "t9"),
        ("7", ["eva", "q"], "1970-01-01", "t9"),
        ("8", ["fay"], "1990-05-06", "t9"),
        ("9", ["gil", "a"], "1970-01-01", "t9"),
        ("10", ["gil", "b"], "1971-01-01", "t9"),
    ]
    assert verdicts(spark, left, right) == {
        "club": ("1", ""),
        "differs": (None, "fecha-discrepante"),
        "several": (None, "varios-en-club"),
        "born": ("5", ""),
        "global": ("6", ""),
        "undated": (None, "sin-fecha-que-verificar"),
        "nobody": (None, "sin-candidato"),
        "wide": (None, "varios-candidatos"),
    }


def test_a_proved_date_reserves_the_candidate(spark):
    left = [("thomas", ["thomas"], "1985-01-01", None), ("lemar", ["thomas", "lemar"], "1995-11-12", None)]
    right = [("tl", ["thomas", "lemar"], "1995-11-12", None), ("tp", ["thomas", "partey"], "1985-01-01", None)]
    assert verdicts(spark, left, right) == {"lemar": ("tl", ""), "thomas": ("tp", "")}
    twins = [("a", ["x"], "1990-01-01", None), ("b", ["x", "y"], "1990-01-01", None)]
    assert set(verdicts(spark, twins, [("r", ["x", "y"], "1990-01-01", None)]).values()) == {(None, "candidato-compartido")}


def test_order_of_rows_decides_nothing(spark):
    rng = random.Random(8)
    make = lambda p, n: [(f"{p}{k}", sorted({rng.choice("abcd") for _ in range(2)}), rng.choice(["", "1990-01-01", "1991-01-01"]), rng.choice(["t1", "t2", None])) for k in range(n)]
    left, right = make("l", 15), make("r", 15)
    first = verdicts(spark, left, right)
    rng.shuffle(left)
    rng.shuffle(right)
    assert verdicts(spark, left, right) == first


def test_decisions(spark):
    data = [
        ("1", "90", "y"), ("1", "91", ""), ("2", "", "skip"), ("2", "", "skip"), ("3", "90", "y"), ("4", "92", "y"), ("4", "93", "Sí"), ("5", "94", "y"), ("5", "95", "skip"),
        ("6", "96", "hm"), ("6", "97", "y"), ("7", "", "y"), ("8", "", "https://x/profil/spieler/500"), ("9", "98", "501"), ("10", "77", "y"), ("11", "99", " "),
    ]
    review = spark.createDataFrame(data, "left_id string, right_id string, decision string")
    actions, problems = resolve.classify_decisions(review, spark.createDataFrame([("77",)], "right_id string"))
    assert rows(actions) == sorted([("1", "yes", "90"), ("2", "skip", None), ("8", "yes", "500")], key=repr)
    assert {(r.left_id, r.motivo) for r in problems.collect()} == {("3", "tm-id-ya-tomado"), ("4", "varios-y"), ("5", "y-con-skip"), ("6", "token-no-reconocido"), ("7", "y-sin-candidato"), ("9", "id-en-fila-con-candidato"), ("10", "tm-id-ya-tomado")}


def test_review_rows_numbers_and_search(spark):
    fresh = spark.createDataFrame([("1", "90", "m", ""), ("2", "91", "m", "")], "left_id string, right_id string, motivo string, decision string")
    old = spark.createDataFrame([("1", "90", "o", "y"), ("3", "92", "o", "skip"), ("4", "93", "o", "y"), ("5", "94", "o", "")], fresh.schema)
    kept = resolve.preserve_decisions(fresh, old, spark.createDataFrame([("4",)], "id string"), ["left_id", "right_id"], "left_id")
    assert rows(kept.select("left_id", "decision")) == [("1", "y"), ("2", ""), ("3", "skip")]
    mapping = spark.createDataFrame([("p00009",), ("p00100",)], "canonical_id string")
    new = spark.createDataFrame([("b",), ("a",)], "id string")
    assert rows(resolve.numbered(new, mapping, "p", 5, ["id"])) == [("a", "p00101"), ("b", "p00102")]
    assert rows(resolve.numbered(new, mapping.limit(0), "t", 3, ["id"])) == [("a", "t001"), ("b", "t002")]
    wanted = spark.createDataFrame([("q1", ["ana"], "1990-01-01"), ("q2", ["bea"], ""), ("q3", ["cid"], "x"), ("q4", ["dan"], "1990-01-01")], "query_id string, tokens array<string>, birth_date string")
    hits = spark.createDataFrame(
        [("q1", 1, "player", "football", ["ana", "b"], "1990-01-01"), ("q1", 9, "team", "football", ["ana"], ""), ("q2", 2, "player", "football", ["bea"], "1991-01-01"), ("q3", 3, "player", "tennis", ["cid"], "x"), ("q4", 4, "player", "football", ["dan"], "1991-01-01")],
        "query_id string, right_id long, kind string, sport string, tokens array<string>, birth_date string",
    )
    assert rows(resolve.searched_identity(hits, wanted)) == sorted([("q1", 1, ""), ("q2", None, "sin-fecha-que-verificar"), ("q3", None, "sin-ficha"), ("q4", None, "fecha-discrepante")], key=repr)


def test_third_source_and_team_matches(spark):
    mapping = spark.createDataFrame([("p1", "a", "1"), ("p2", "a", "2"), ("p2", "c", "x"), ("p3", "a", "3")], "canonical_id string, fuente string, id_en_fuente string")
    left = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "id string")
    skips = spark.createDataFrame([("p3",)], "canonical_id string")
    assert rows(resolve.attachable(left, mapping, "a", "c", skips).select("id")) == [("1",)]
    side = lambda d: spark.createDataFrame(d, "id string, tokens array<string>, competition string")
    left, right = side([("1", ["real"], "c"), ("2", ["real", "b"], "c"), ("3", ["betis"], "c")]), side([("r", ["real"], "c"), ("b", ["betis", "x"], "c")])
    assert rows(resolve.team_matches(left, right)) == [("3", "b")]


def test_newcomers_and_orchestrator(spark):
    squad = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    points = spark.createDataFrame([(1, "2023"), (2, "2024"), (None, "2022")], "player_id long, season string")
    assert rows(analytics.newcomers(squad, points, 2024)) == [(2,)]
    state = spark.createDataFrame([("s", "p1", 3, False), ("s", "p1", 0, False), ("s", "p1", 0, True), (None, "", 0, False)], "s string, c string, n long, f boolean")
    got = state.select(analytics.newcomer_state(F.col("s"), F.col("c"), F.col("n"), F.col("f"))).collect()
    assert [r[0] for r in got] == ["descargado", "sin-historial", "fallo", "sin-identidad"]
    Step, Result = orchestrator.Step, orchestrator.Result

    def broken():
        raise integrity.IntegrityError("two ids")

    report = orchestrator.run_steps([Step("a", lambda: Result(rows={"t": 1})), Step("b", broken), Step("c", Result)])
    assert not report.ok and report.pending == ["c"] and report.done[1][1].failures == ["two ids"]
    assert orchestrator.run_steps([Step("a", Result)]).ok
    merged = Result(rows={"t": 1}, anomalies={"x": 1}).merge(Result(rows={"t": 5}, anomalies={"x": 2}))
    assert merged.rows == {"t": 5} and merged.anomalies == {"x": 3} and "t: 5 rows" in merged.render()
    assert S is not None
