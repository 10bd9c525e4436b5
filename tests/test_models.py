"""Models against NumPy and plain loops, and what they may not see."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from canonlake import model_queries
from canonlake.plans import models
from canonlake.sources.curated import CuratedStore


def table(seed=1, n=400, k=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * 10.0 ** np.arange(-2, k - 2) + 1000
    group = rng.integers(0, 3, n)
    y = 3 + x @ np.arange(1, k + 1) + rng.normal(size=n) + 50 * group
    return [(f"g{group[i]}", *map(float, x[i]), float(y[i])) for i in range(n)]


XS = [f"x{i}" for i in range(6)]
SCHEMA = "g string, " + ", ".join(f"{x} double" for x in XS) + ", y double"


def test_regression_matches_numpy(spark):
    rows = table()
    df = spark.createDataFrame(rows + [("g0", *[None] * 6, 1.0), ("g0", *[1.0] * 6, None)], SCHEMA).repartition(5)
    found = {r.g: r for r in models.multiple_regression(df, ["g"], "y", XS).collect()}
    assert set(found) == {"g0", "g1", "g2"}
    for g, r in found.items():
        own = np.array([row[1:] for row in rows if row[0] == g])
        a = np.column_stack([np.ones(len(own)), own[:, :6]])
        want, rest = np.linalg.lstsq(a, own[:, 6], rcond=None)[:2]
        assert r.n == len(own) and not r.singular
        assert np.allclose([r.intercept, *(r.coefficients[x] for x in XS)], want, rtol=1e-5, atol=1e-6)
        assert math.isclose(r.r2, 1 - float(rest[0]) / ((own[:, 6] - own[:, 6].mean()) ** 2).sum(), rel_tol=1e-9)


def test_singular_groups_have_a_ridge_and_say_so(spark):
    rows = [("twice", float(i), 2.0 * i, 5.0, 3.0 * i + 1) for i in range(20)] + [("few", 1.0, 2.0, 5.0, 3.0), ("few", 2.0, 1.0, 5.0, 4.0), ("one", 1.0, 1.0, 1.0, 7.0)]
    found = {r.g: r for r in models.multiple_regression(spark.createDataFrame(rows, "g string, a double, b double, c double, y double"), ["g"], "y", ["a", "b", "c"]).collect()}
    twice = found["twice"]
    assert twice.singular and found["few"].singular and found["one"].singular
    value = lambda r, a, b: r.intercept + r.coefficients["a"] * a + r.coefficients["b"] * b + r.coefficients["c"] * 5
    assert abs(value(twice, 7, 14) - 22) < 1e-3 and twice.coefficients["c"] == 0 and abs(twice.coefficients["a"] - 1.5) < 1e-3
    assert abs(value(found["few"], 1, 2) - 3) < 1e-3 and found["one"].intercept == 7
    assert models.multiple_regression(spark.createDataFrame([], "g string, a double, y double"), ["g"], "y", ["a"]).count() == 0


def test_merged_moments_are_those_of_the_whole(spark):
    df = spark.createDataFrame(table(), SCHEMA).withColumn("half", (models.F.col("x0") > 1000).cast("int"))
    whole = models.moments(df, ["g"], XS, "y").orderBy("g").collect()
    parts = models.merged(models.moments(df, ["g", "half"], XS, "y"), ["g"], 7).orderBy("g").collect()
    for a, b in zip(whole, parts, strict=True):
        assert a.n == b.n and np.allclose(a.means, b.means) and np.allclose(a.products, b.products, rtol=1e-6, atol=1e-6)


def history(n_rounds=12, change=None):
    rng = random.Random(4)
    rows = []
    for r in range(n_rounds):
        for p in range(25):
            a, b = rng.random(), rng.random()
            y = 2 * a - b + (p % 2) * 3 + rng.gauss(0, 0.1)
            rows.append((r, p % 2, "s", p, a, b, y if change is None or r < change else y * 1000))
    return rows


ROLL = "round int, position int, system string, id int, a double, b double, y double"
VERSIONS = {"mean": [], "one": ["a"], "both": ["a", "b"]}


def test_rolling_predictions_match_a_fit_of_each_origin(spark):
    rows = history()
    found = models.rolling_predictions(spark.createDataFrame(rows, ROLL), ["position", "system"], "round", VERSIONS, "y").collect()
    assert {r["round"] for r in found} == set(range(1, 12)) and len(found) == 3 * 25 * 11
    names = [c.split()[0] for c in ROLL.split(", ")]
    for r in found[::37]:
        seen = [dict(zip(names, x)) for x in rows if x[0] < r["round"] and x[1] == r.position]
        a = np.array([[1.0, *(s[x] for x in VERSIONS[r.version])] for s in seen])
        fit = np.linalg.lstsq(a, np.array([s["y"] for s in seen]), rcond=None)[0]
        assert math.isclose(r.predicted, fit @ [1.0, *(r[x] for x in VERSIONS[r.version])], rel_tol=1e-6, abs_tol=1e-8)


def test_what_comes_later_changes_nothing(spark):
    key = lambda r: (r["round"], r.id, r.version, round(r.predicted, 9))
    told = [sorted(key(r) for r in models.rolling_predictions(spark.createDataFrame(history(change=c), ROLL), ["position", "system"], "round", VERSIONS, "y").where("round <= 7").collect()) for c in (None, 7)]
    assert told[0] == told[1] and len(told[0]) == 3 * 25 * 7


def test_accuracy_by_round_position_system_and_version(spark):
    df = spark.createDataFrame([(1, "p", "v", 3.0, 1.0), (1, "p", "v", 0.0, 1.0), (1, "q", "v", None, 1.0), (2, "p", "w", 1.0, None)], "round int, position string, version string, predicted double, y double")
    assert [tuple(r) for r in models.accuracy(df, ["round", "position"], "y").collect()] == [(1, "p", "v", 1.5, 0.5, 2)]


def test_logistic_matches_plain_newton(spark):
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.normal(5, 2, 500), rng.normal(0, 0.01, 500)])
    y = rng.random(500) < 1 / (1 + np.exp(-(-4 + 0.8 * x[:, 0] + 60 * x[:, 1])))
    found = models.logistic(spark.createDataFrame([(float(a), float(b), bool(t)) for (a, b), t in zip(x, y)] + [(None, 1.0, True)], "a double, b double, t boolean").repartition(3), ["a", "b"], "t")
    z, w = np.column_stack([np.ones(500), (x - x.mean(0)) / x.std(0)]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 0.5 * np.diag([0, 1, 1]), z.T @ (y - p) - 0.5 * np.array([0, 1, 1]) * w)
    own = w[1:] / x.std(0)
    assert np.allclose(found.coefficients, own, rtol=1e-6) and math.isclose(found.constant, w[0] - own @ x.mean(0), rel_tol=1e-6) and found.steps < 12


def test_logistic_of_a_perfect_split_of_one_outcome_and_of_no_rows(spark):
    df = spark.createDataFrame([(float(i), i >= 10) for i in range(20)], "a double, t boolean")
    split = models.logistic(df, ["a"], "t")
    told = [r.p for r in df.select(split.probability().alias("p")).collect()]
    assert told == sorted(told) and told[9] < 0.5 < told[10] and math.isfinite(split.constant)
    assert models.logistic(df.where("t"), ["a"], "t").coefficients == [0.0]
    assert models.logistic(df.limit(0), ["a"], "t").constant == 0.0


def test_projections_are_fitted_stored_by_version_and_come_again(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        form, position = rng.random(), rng.choice(["back", "front"])
        started = rng.random() < 0.2 + 0.6 * form
        minutes = (rng.randint(60, 90) if started else rng.randint(0, 30)) * 1.0
        rows.append((i, position, form, started, minutes, minutes / 90 * (4 * form + (position == "front"))))
    df = spark.createDataFrame(rows, "id int, position string, form double, started boolean, minutes double, points double")
    upcoming = spark.createDataFrame([(1, "back", 0.9), (2, "back", 0.1), (3, "front", 0.9), (4, "keeper", 0.5)], "id int, position string, form double")
    run = lambda version, rows=df: models.fitted_projections(rows, upcoming, ["id"], ["position"], ["form"], ["form"], version)
    told = {r.id: r for r in run("v1").collect()}
    assert set(told) == {1, 2, 3}
    assert told[1].start_probability > 0.6 > 0.4 > told[2].start_probability and told[3].projected > told[1].projected > told[2].projected
    assert math.isclose(told[1].rate, 3.6, abs_tol=1e-6) and math.isclose(told[1].projected, told[1].rate * told[1].expected_minutes / 90, rel_tol=1e-12)
    assert all(r.p10 <= r.projected + 1e-9 and r.projected <= r.p90 + 1e-9 for r in told.values())
    store = CuratedStore(spark, f"file://{tmp_path}")
    assert models.store_projections(store, run("v1"), "v1") == 3 and models.store_projections(store, run("v2", df.where("id < 300")), "v2") == 3
    before = sorted(map(tuple, store.read_table("projections").collect()))
    assert models.store_projections(store, run("v1", df.repartition(7)), "v1") == 3
    again = sorted(map(tuple, store.read_table("projections").collect()))
    for a, b in zip(before, again, strict=True):
        assert all(math.isclose(x, y, rel_tol=1e-9) if isinstance(x, float) else x == y for x, y in zip(a, b))


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


LOG = [
    ("m", "a", "train", at(0)), ("m", "a", "activate", at(1)), ("m", "b", "activate", at(5)), ("m", "b", "archive", at(9)),  # b over a, then a again
    ("m", "a", "archive", at(20)), ("m", "a", "archive", at(21)), ("m", "a", "activate", at(30)), ("m", "a", "activate", at(31)),  # a gap, reopened, activated twice
    ("m", "c", "activate", at(40)), ("m", "a", "archive", at(41)), ("m", "c", "archive", at(40)),  # archived as it is activated: it stays
    ("n", "x", "archive", at(3)), ("n", None, "activate", None),
]


def active(log, model, t):
    """The version that is active at an instant, replayed event by event."""
    on = {}
    for m, v, e, when in sorted((x for x in log if x[3] is not None and x[0] == model and x[2] != "train" and x[3] <= t), key=lambda x: (x[3], x[2] == "activate")):
        if e == "archive":
            on.pop(v, None)
        else:
            on.setdefault(v, when)
    return max(on, key=lambda v: (on[v], v), default=None)


def test_which_version_was_active(spark):
    registry = spark.createDataFrame(LOG, "model string, version string, event string, at timestamp")
    rounds = [(m, at(d, h), d) for m in "mn" for d in range(0, 60, 1) for h in (0, 5)] + [("nobody", at(3), 3), ("m", None, 1)]
    told = models.active_at(registry, spark.createDataFrame(rounds, "model string, at timestamp, round int"), "at").collect()
    assert len(told) == len(rounds)
    for r in told:
        assert r.version == (active(LOG, r.model, r["at"]) if r["at"] else None), r
    spans = sorted(map(tuple, models.active_intervals(registry).collect()))
    assert spans == [("m", "a", at(1), at(5)), ("m", "a", at(9), at(20)), ("m", "a", at(30), at(40)), ("m", "b", at(5), at(9)), ("m", "c", at(40), None)]
    assert models.newest_version(registry).select("model", "version").collect() == [("m", "a")]


def test_any_log(spark):
    rng = random.Random(11)
    log = [(rng.choice("pq"), rng.choice("abc"), rng.choice(["activate", "archive", "train"]), at(rng.randint(0, 300), rng.choice([0, 7]))) for _ in range(200)]
    rounds = [(m, at(d)) for m in "pq" for d in range(-3, 310, 2)]
    for r in models.active_at(spark.createDataFrame(log, "model string, version string, event string, at timestamp"), spark.createDataFrame(rounds, "model string, at timestamp"), "at").collect():
        assert r.version == active(log, r.model, r["at"])


def test_rates_around_a_transfer(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    matches = [("p", day(d), 90.0, float(d)) for d in range(0, 200, 3)] + [("p", day(0), 10.0, 1.0), ("p", None, 1.0, 1.0), (None, day(5), 1.0, 1.0)]
    moves = [("p", day(100), "L", 1), ("p", day(100), "L", 1), ("p", day(0), "L", 1), ("q", day(5), "M", 2), (None, day(5), "M", 2)]
    told = models.rates_around(spark.createDataFrame(moves, "player string, day date, league string, tier int"), spark.createDataFrame(matches, "player string, day date, minutes double, points double"), 30).collect()
    assert len(told) == 5
    for r in told:
        own = [m for m in matches if m[0] == r.player and m[1] is not None and r.player is not None]
        ahead = [m for m in own if r.day - dt.timedelta(days=30) <= m[1] < r.day]
        behind = [m for m in own if r.day <= m[1] < r.day + dt.timedelta(days=30)]
        assert (r.minutes_before, r.points_before, r.minutes_after, r.points_after) == tuple(float(sum(m[k] for m in side)) for side in (ahead, behind) for k in (2, 3))


def test_coefficients_shrink_to_the_tier(spark):
    rng = random.Random(6)
    rows = [(f"L{league}", "t", 900.0, 100.0, 900.0, 100.0 * math.exp(0.3 * league + rng.gauss(0, 0.2))) for league, n in ((0, 40), (1, 40), (2, 2)) for _ in range(n)]
    rows += [("alone", "u", 900.0, 100.0, 900.0, 150.0), ("alone", "u", 30.0, 100.0, 900.0, 150.0), ("none", "u", 900.0, 0.0, 900.0, 1.0)]
    found = {r.league: r for r in models.transfer_coefficients(spark.createDataFrame(rows, "league string, tier string, minutes_before double, points_before double, minutes_after double, points_after double")).collect()}
    assert set(found) == {"L0", "L1", "L2", "alone"} and found["alone"].n == 1 and math.isclose(found["alone"].shrunk, 1.5)
    ys = {k: [math.log(r[5] / r[3]) for r in rows if r[0] == k] for k in ("L0", "L1", "L2")}
    every = [y for own in ys.values() for y in own]
    within = sum((y - np.mean(own)) ** 2 for own in ys.values() for y in own) / (len(every) - 3)
    between = max(0.0, np.var([np.mean(o) for o in ys.values()], ddof=1) - within * np.mean([1 / len(o) for o in ys.values()]))
    for k, own in ys.items():
        trust = between / (between + within / len(own))
        assert math.isclose(found[k].shrunk, math.exp(np.mean(every) + trust * (np.mean(own) - np.mean(every))), rel_tol=1e-9)
        assert math.isclose(found[k].own, math.exp(np.mean(own)), rel_tol=1e-9)
    assert models.transfer_coefficients(spark.createDataFrame(rows[:1], "league string, tier string, minutes_before double, points_before double, minutes_after double, points_after double").limit(0)).count() == 0


@pytest.mark.parametrize("xs", [["a"], ["a", "b"]])
def test_predictions_of_groups_without_a_model_are_left_out(spark, xs):
    df = spark.createDataFrame([(g, float(i), float(i * i), 2.0 * i) for g in (1, 2) for i in range(5)], "g int, a double, b double, y double")
    fit = models.multiple_regression(df.where("g = 1"), ["g"], "y", xs)
    told = models.predicted(df, fit, ["g"], xs).collect()
    assert len(told) == 5 and all(abs(r.predicted - r.y) < 1e-6 for r in told)


@pytest.mark.parametrize("noise", [-1e-12, 1e-12])
def test_ties_of_rolling_accuracy_are_rounded_up_in_whatever_order_sums_are_taken(spark, tmp_path, monkeypatch, noise):
    # 40 rows of one round, of which the mean ends in half a unit of the fourth digit, and one row that it predicts
    days = [(u, dt.datetime(2024, 1, 2), "view", 1.0 if u else 1.002, 1) for u in range(0, 120, 3)] + [(0, dt.datetime(2024, 1, 3), "view", 0.0, 1)]
    spark.createDataFrame(days, "user_id long, ts timestamp, event_type string, value double, event_id long").write.parquet(f"{tmp_path}/events.parquet")
    exact = models.accuracy
    monkeypatch.setattr(models, "accuracy", lambda *args: exact(*args).withColumns({c: F.col(c) + noise for c in ("mae", "bias")}))
    found = {r.version: (r.mae, r.bias) for r in model_queries.rolling_accuracy(spark, f"file://{tmp_path}").collect()}
    assert found["mean"] == (1.0001, 1.0001)  # 1.00005
