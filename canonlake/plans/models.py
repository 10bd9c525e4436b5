"""Models over curated tables: regressions by group, start probabilities, projections, validation over time, registry and league coefficients.

What a model learns from is a table of sums, which Spark aggregates by group with partial sums; what reaches the driver are a model's own
numbers. A group may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canonlake.operators import algebra

#: A pivot below this, in units of a variable's own variance, makes a group singular; it is then solved with RIDGE on the diagonal.
SINGULAR, RIDGE = 1e-9, 1e-6


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def moments(df: DataFrame, groups: list[str], xs: list[str], y: str) -> DataFrame:
    """(groups, n, means, products): of the regressors and then ``y`` the means and, pair by pair, the mean products of deviations.

    One aggregate with partial sums. Rows in which one of them is null are left out.
    """
    names = [*xs, y]
    rows = df.select(*groups, *[F.col(c).cast("double").alias(f"__v{k}") for k, c in enumerate(names)]).dropna(subset=[f"__v{k}" for k in range(len(names))])
    means = F.array(*[F.avg(f"__v{k}") for k in range(len(names))])
    products = F.array(*[F.covar_pop(f"__v{i}", f"__v{j}") for i, j in _pairs(len(names))])
    return rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), means.alias("means"), products.alias("products"))


def _combined(found: DataFrame, keys: list[str], size: int, summed) -> DataFrame:
    """(keys, n, means, products) of several moments; ``summed`` takes names and columns and gives a table of their sums, added up by groups or along a window."""
    means, products = range(size), _pairs(size)
    columns = {"n": F.col("n")} | {f"__s{k}": F.col("n") * F.col("means")[k] for k in means}
    columns |= {f"__q{p}": F.col("n") * (F.col("products")[p] + F.col("means")[i] * F.col("means")[j]) for p, (i, j) in enumerate(products)}
    sums = summed(found.select(*keys, *[c.alias(name) for name, c in columns.items()]), list(columns)).where(F.col("n") > 0)
    mean = lambda k: F.col(f"__s{k}") / F.col("n")
    pair = [F.col(f"__q{p}") / F.col("n") - mean(i) * mean(j) for p, (i, j) in enumerate(products)]
    return sums.select(*keys, "n", F.array(*[mean(k) for k in means]).alias("means"), F.array(*pair).alias("products"))


def merged(found: DataFrame, groups: list[str], size: int) -> DataFrame:
    """Moments of coarser groups from those of finer ones; ``size`` is the number of variables, ``y`` included."""
    return _combined(found, groups, size, lambda rows, names: rows.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in names]))


def before(found: DataFrame, groups: list[str], order: str, size: int) -> DataFrame:
    """(groups, order, n, means, products): for each place in the order the moments of all places before it. The window runs over sums, not over rows."""
    w = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return _combined(found, [*groups, order], size, lambda rows, names: rows.select(*groups, order, *[F.sum(c).over(w).alias(c) for c in names]))


def _factor(r: np.ndarray, ridge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cholesky's factors of matrices, one each row, with ``ridge`` on their diagonals, and their least pivots; a pivot is not taken below SINGULAR."""
    k = r.shape[1]
    factor, least = np.zeros_like(r), np.full(len(r), np.inf)
    for j in range(k):
        pivot = r[:, j, j] + ridge - (factor[:, j, :j] ** 2).sum(1)
        least = np.minimum(least, pivot)
        factor[:, j, j] = np.sqrt(np.maximum(pivot, SINGULAR))
        factor[:, j + 1 :, j] = (r[:, j + 1 :, j] - np.einsum("nic,nc->ni", factor[:, j + 1 :, :j], factor[:, j, :j])) / factor[:, j, j, None]
    return factor, least


def _fit(n: np.ndarray, means: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(intercepts, coefficients, r2, singular) of the groups whose moments are the rows."""
    k = means.shape[1] - 1
    whole = np.zeros((len(n), k + 1, k + 1))
    for p, (i, j) in enumerate(_pairs(k + 1)):
        whole[:, i, j] = whole[:, j, i] = products[:, p]
    deviation = np.sqrt(np.maximum(np.einsum("nii->ni", whole), 0.0))
    flat = deviation[:, :k] <= 1e-12 * np.abs(means[:, :k])  # a deviation that is lost in the rounding of the mean is none
    unit = np.where(flat, 1.0, deviation[:, :k])
    r, ry = whole[:, :k, :k] / (unit[:, :, None] * unit[:, None, :]), np.where(flat, 0.0, whole[:, :k, k] / unit)
    r = np.where(flat[:, :, None] | flat[:, None, :], np.eye(k), r)
    singular = (_factor(r, np.zeros(len(n)))[1] < SINGULAR) | (n <= k)
    ridge = np.where(singular, RIDGE, 0.0)
    factor, _ = _factor(r, ridge)
    z, b = np.zeros((len(n), k)), np.zeros((len(n), k))
    for i in range(k):
        z[:, i] = (ry[:, i] - (factor[:, i, :i] * z[:, :i]).sum(1)) / factor[:, i, i]
    for i in reversed(range(k)):
        b[:, i] = (z[:, i] - (factor[:, i + 1 :, i] * b[:, i + 1 :]).sum(1)) / factor[:, i, i]
    own, total = b / unit, deviation[:, k] ** 2
    r2 = np.divide((b * ry).sum(1) + ridge * (b * b).sum(1), total, out=np.full(len(n), np.nan), where=total > 0)
    return means[:, k] - (own * means[:, :k]).sum(1), own, r2, singular


def _fits(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = batch.column(groups).to_numpy()
                lists = [np.array(batch.column(groups + c).to_pylist(), float) for c in (1, 2)]
                intercept, own, r2, singular = _fit(n, *lists)
                columns = [*batch.columns[: groups + 1], pa.array(intercept), pa.array(own.tolist(), pa.list_(pa.float64())), pa.array(r2, from_pandas=True), pa.array(singular)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[: groups + 1], "intercept", "b", "r2", "singular"])

    return run


def solved(found: DataFrame, groups: list[str], xs: list[str]) -> DataFrame:
    """(groups, n, intercept, coefficients by name, r2, singular) from moments: the normal equations by Cholesky's factor, many groups at once.

    Variables are scaled by their own deviation, so pivots of different groups compare. A group whose regressors depend on each other, or that has no more
    rows than regressors, is singular: it is solved with a ridge, and says so. A regressor that never varies has coefficient 0.
    """
    rows = found.select(*groups, "n", "means", "products")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(groups)])
    fits = rows.mapInArrow(_fits(len(groups)), f"{kinds}, n long, intercept double, b array<double>, r2 double, singular boolean")
    named = F.create_map(*[x for i, name in enumerate(xs) for x in (F.lit(name), F.col("b")[i])])
    return fits.select(*groups, "n", "intercept", named.alias("coefficients"), "r2", "singular")


def multiple_regression(df: DataFrame, groups: list[str], y: str, xs: list[str]) -> DataFrame:
    """Least squares of ``y`` on ``xs`` and a constant, by group: (groups, n, intercept, coefficients, r2, singular)."""
    return solved(moments(df, groups, xs, y), groups, xs)


def predicted(rows: DataFrame, models: DataFrame, keys: list[str], xs: list[str], name: str = "predicted") -> DataFrame:
    """``rows`` of which there is a model, with its value. Models are rows of groups; whether they are broadcast is left to their size at run time."""
    chosen = models.select(*keys, F.col("intercept").alias("__c"), F.col("coefficients").alias("__b"))
    value = F.col("__c") + sum((F.col("__b")[x] * F.col(x) for x in xs), F.lit(0.0))
    return rows.join(chosen, keys).withColumn(name, value).drop("__c", "__b")


# --- validation over time ------------------------------------------------------------------------------------------


def rolling_predictions(rows: DataFrame, groups: list[str], order: str, versions: dict[str, list[str]], y: str, least: int = 10) -> DataFrame:
    """``rows`` once for each version, with ``predicted`` by the model of all places in ``order`` before the row's own.

    ``versions`` names the regressors of each version; a version without regressors predicts the mean of the group so far. Sums of each place are
    taken once and added up along the order, so no row is copied to the folds that may see it. Places before which there are fewer than ``least``
    rows have no prediction. Regressors must be known before the row's own place; ``y`` of a place, and of later ones, changes nothing in it.
    """
    out = None
    for version, xs in versions.items():
        seen = before(moments(rows, [*groups, order], xs, y), groups, order, len(xs) + 1).where(F.col("n") >= least)
        models = solved(seen, [*groups, order], xs) if xs else seen.select(*groups, order, F.col("means")[0].alias("intercept"), F.create_map().cast("map<string,double>").alias("coefficients"))
        part = predicted(rows, models, [*groups, order], xs).withColumn("version", F.lit(version))
        out = part if out is None else out.unionByName(part)
    return out


def accuracy(found: DataFrame, by: list[str], y: str) -> DataFrame:
    """(by, version, mae, bias, n) of predictions; rows without one are not compared."""
    error = F.col("predicted") - F.col(y)
    return found.where(F.col("predicted").isNotNull() & F.col(y).isNotNull()).groupBy(*by, "version").agg(F.avg(F.abs(error)).alias("mae"), F.avg(error).alias("bias"), F.count(F.lit(1)).alias("n"))


def settled(name: str, digits: int) -> Column:
    """A mean rounded to ``digits``; nine digits come first, so that a tie is a tie in whatever order its sums were taken."""
    return F.round(F.round(name, 9), digits)


# --- start probability and projections -------------------------------------------------------------------------------


class Logistic:
    """A fitted logistic model: a constant and a coefficient for each regressor."""

    def __init__(self, xs: list[str], constant: float, coefficients: list[float], steps: int):
        self.xs, self.constant, self.coefficients, self.steps = xs, constant, coefficients, steps

    def probability(self) -> Column:
        value = sum((F.lit(b) * F.col(x).cast("double") for x, b in zip(self.xs, self.coefficients)), F.lit(self.constant))
        return 1 / (1 + F.exp(-value))


def logistic(df: DataFrame, xs: list[str], label: str, ridge: float = 1e-3, steps: int = 25, settled: float = 1e-9) -> Logistic:
    """Logistic regression of a boolean column by Newton's steps: each is one aggregate of the gradient and the curvature over all rows.

    Only those sums reach the driver, (k + 1)(k + 4) / 2 numbers a step. Regressors are scaled by their deviation; ``ridge`` holds scaled
    coefficients, so that a perfect split of the rows has a solution. Rows with a null are left out. Without rows, or with only one
    outcome, the constant tells the share, pulled half a row to the middle. Coefficients are rounded to ten digits, so that the order of
    sums does not show in them.
    """
    rows = df.select(*[F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(xs)], F.col(label).cast("double").alias("y")).dropna()
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones"), *[f(f"x{i}").alias(f"{p}{i}") for i in range(len(xs)) for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    n, ones = told.n, told.ones or 0.0
    share = (ones + 0.5) / (n + 1)
    if not 0 < ones < n:
        return Logistic(xs, float(np.log(share / (1 - share))), [0.0] * len(xs), 0)
    mean, scale = np.array([told[f"m{i}"] for i in range(len(xs))]), np.array([told[f"s{i}"] or 1.0 for i in range(len(xs))])
    z = [F.lit(1.0)] + [(F.col(f"x{i}") - float(mean[i])) / float(scale[i]) for i in range(len(xs))]
    b, taken = np.zeros(len(z)), 0
    b[0] = np.log(share / (1 - share))
    held = ridge * n * np.diag([0.0] + [1.0] * len(xs))
    for taken in range(1, steps + 1):
        p = 1 / (1 + F.exp(-sum((float(v) * c for v, c in zip(b, z)), F.lit(0.0))))
        w = rows.withColumn("p", p).withColumn("w", F.col("p") * (1 - F.col("p")))
        sums = w.agg(*[F.sum((F.col("y") - F.col("p")) * c) for c in z], *[F.sum(F.col("w") * z[i] * z[j]) for i, j in _pairs(len(z))]).first()
        curve = np.zeros((len(z), len(z)))
        for value, (i, j) in zip(sums[len(z) :], _pairs(len(z))):
            curve[i, j] = curve[j, i] = value
        step = np.linalg.solve(curve + held + 1e-12 * np.eye(len(z)), np.array(sums[: len(z)]) - held @ b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < settled:
            break
    own = b[1:] / scale
    tidy = lambda v: float(f"{v:.10g}")
    return Logistic(xs, tidy(b[0] - own @ mean), [tidy(v) for v in own], taken)


def fitted_projections(history: DataFrame, upcoming: DataFrame, keys: list[str], position: list[str], start_xs: list[str], rate_xs: list[str], version: str) -> DataFrame:
    """(keys, position, version, start_probability, expected_minutes, rate, projected, p10, p90) of ``upcoming``, learned from ``history``.

    ``history`` has the positions, the regressors, started, minutes and points of past matches; ``upcoming`` the keys, the positions and the same regressors. Minutes:
    the probability of a start by a logistic model, times the mean minutes of those who started and of those who did not, by position. Performance:
    points per 90 minutes of those who played, by a regression for each position. The tenth and the ninetieth percentile are
    those of the regression's residuals, within a ten thousandth of the rows, times the same minutes. Positions without history have no projection.
    """
    model = logistic(history, start_xs, "started")
    minutes = history.groupBy(*position).agg(*[F.coalesce(F.avg(F.when(F.col("started") == on, F.col("minutes"))), F.lit(0.0)).alias(name) for on, name in ((True, "__on"), (False, "__off"))])
    played = history.where("minutes > 0").withColumn("per_90", F.col("points") * 90.0 / F.col("minutes"))
    rates = multiple_regression(played, position, "per_90", rate_xs)
    off = predicted(played, rates, position, rate_xs).groupBy(*position).agg(F.percentile_approx(F.col("per_90") - F.col("predicted"), [0.1, 0.9], 10_000).alias("__off_by"))
    p = F.col("start_probability")
    out = predicted(upcoming, rates, position, rate_xs, "rate").withColumn("start_probability", model.probability())
    out = out.join(minutes, position).withColumn("expected_minutes", p * F.col("__on") + (1 - p) * F.col("__off")).join(off, position)
    share = F.col("expected_minutes") / 90
    spread = [(share * (F.col("rate") + F.col("__off_by")[i])).alias(name) for i, name in enumerate(("p10", "p90"))]
    return out.select(*keys, *position, F.lit(version).alias("version"), "start_probability", "expected_minutes", "rate", (share * F.col("rate")).alias("projected"), *spread)


def store_projections(store, found: DataFrame, version: str, table: str = "projections") -> int:
    """Writes a version's projections as a partition of their own; other versions stay. The same version again replaces itself."""
    rows = store.staged(found.where(F.col("version") == version))
    store.write_table(table, rows, {"version": version})
    return rows.count()


# --- registry ----------------------------------------------------------------------------------------------------------


def live_spells(registry: DataFrame) -> DataFrame:
    """(model, version, begin, end) from (model, version, event, at): from an activation to the next archiving of the same version, or open.

    Activating what is live, or archiving what is not, changes nothing. At one instant an archiving comes before an activation.
    """
    acts = registry.where(F.col("event").isin("activate", "archive") & F.col("at").isNotNull()).select("model", "version", "at", (F.col("event") == "activate").alias("on")).distinct()
    w = Window.partitionBy("model", "version").orderBy("at", "on")
    turns = acts.withColumn("was", F.lag("on").over(w)).where(~F.coalesce("was", F.lit(False)).eqNullSafe(F.col("on")))
    return turns.withColumn("end", F.lead("at").over(w)).where("on").select("model", "version", F.col("at").alias("begin"), "end").where("end is null or end > begin")


def active_at(registry: DataFrame, asked: DataFrame, at: str, block_seconds: int = 7 * 86_400) -> DataFrame:
    """``asked`` (model and a timestamp ``at``, besides others) with ``version``: which one was active then; null if none was.

    Of the versions that are live at an instant the one activated last is active, of equal ones the greater name; when it is archived, the one before it is active again.
    Spells are listed under the blocks of time they touch, up to the last instant that is asked for, so rows meet on equal keys.
    """
    block = lambda c: F.floor(F.unix_seconds(c) / block_seconds)
    rows = asked.withColumn("__row", F.monotonically_increasing_id()).withColumn("__block", block(F.col(at).cast("timestamp")))
    horizon = rows.agg(F.max("__block").alias("__last"))
    spells = live_spells(registry).withColumns({"begin": F.col("begin").cast("timestamp"), "end": F.col("end").cast("timestamp")}).join(F.broadcast(horizon))  # one row
    spells = spells.withColumn("__to", F.least("__last", F.coalesce(block(F.col("end")), F.col("__last")))).where(block(F.col("begin")) <= F.col("__to"))
    listed = spells.select(F.col("model").alias("__model"), F.col("version").alias("__version"), "begin", "end", F.explode(F.sequence(block(F.col("begin")), F.col("__to"))).alias("__at"))
    then = F.col(at).cast("timestamp")
    met = rows.join(listed, (F.col("model") == F.col("__model")) & (F.col("__block") == F.col("__at")) & (F.col("begin") <= then) & (F.col("end").isNull() | (then < F.col("end"))), "left")
    best = F.max(F.when(F.col("__version").isNotNull(), F.struct("begin", "__version")))
    return met.groupBy("__row", *[c for c in asked.columns]).agg(best.alias("__best")).withColumn("version", F.col("__best")["__version"]).drop("__row", "__best")


def active_intervals(registry: DataFrame) -> DataFrame:
    """(model, version, begin, end): which version was active when, gapless pieces of one version joined; spells in which none was are left out."""
    spells = live_spells(registry)
    turns = spells.select("model", F.col("begin").alias("at")).union(spells.where("end is not null").select("model", "end")).distinct()
    told = active_at(registry, turns, "at")
    w = Window.partitionBy("model").orderBy("at")
    changed = told.withColumn("was", F.lag(F.struct("version")).over(w)).where(F.col("was").isNull() | ~F.col("was.version").eqNullSafe(F.col("version")))
    return changed.withColumn("end", F.lead("at").over(w)).where("version is not null").select("model", "version", F.col("at").alias("begin"), "end")


# --- league coefficients ----------------------------------------------------------------------------------------------


def rates_around(transfers: DataFrame, matches: DataFrame, window: int = 365) -> DataFrame:
    """``transfers`` (player and day, besides others) with the minutes and points of the player in the ``window`` days before the day and from it on.

    Matches are summed by player and day first. Both sides meet by player and block of ``window`` days, of which a transfer
    touches three at most, so a player with very many matches is spread over the blocks.
    """
    block = lambda d: F.floor(F.unix_date(d) / window)
    days = matches.where(F.col("player").isNotNull() & F.col("day").isNotNull()).groupBy("player", F.col("day").alias("__day")).agg(F.sum("minutes").alias("__minutes"), F.sum("points").alias("__points"))
    days = days.withColumn("__block", block(F.col("__day")))
    asked = transfers.withColumn("__row", F.monotonically_increasing_id())
    asked = asked.withColumn("__block", F.explode(F.sequence(block(F.date_sub("day", window)), block(F.date_add("day", window - 1)))))
    earlier = (F.col("__day") < F.col("day")) & (F.col("__day") >= F.date_sub("day", window))
    later = (F.col("__day") >= F.col("day")) & (F.col("__day") < F.date_add("day", window))
    sums = [F.coalesce(F.sum(F.when(side, F.col(f"__{what}"))), F.lit(0)).alias(f"{what}_{name}") for side, name in ((earlier, "before"), (later, "after")) for what in ("minutes", "points")]
    return asked.join(days, ["player", "__block"], "left").groupBy("__row", *transfers.columns).agg(*sums).drop("__row")


def transfer_coefficients(around: DataFrame, least_minutes: float = 90.0) -> DataFrame:
    """(league, tier, n, own, shrunk): by league of origin, how points per 90 minutes change with a transfer, as a factor.

    Transfers with ``least_minutes`` on both sides and points on both count, by the logarithm of the ratio. The mean of a league is shrunk to that of its tier: the less, the more
    transfers it has and the more the tier's leagues differ beyond chance. Chance is the pooled variance within the leagues of a
    tier, difference the variance of their means less what chance gives it. Without either estimate a league takes its tier's mean.
    """
    rate = lambda side: F.col(f"points_{side}") / F.col(f"minutes_{side}")
    both = around.where(" and ".join(f"minutes_{s} >= {least_minutes} and points_{s} > 0" for s in ("before", "after"))).withColumn("__y", F.log(rate("after") / rate("before")))
    leagues = both.groupBy("league", "tier").agg(F.count(F.lit(1)).alias("n"), F.avg("__y").alias("mean"), (F.var_pop("__y") * F.count(F.lit(1))).alias("squares"))
    within = F.sum("squares") / F.nullif(F.sum(F.col("n") - 1), F.lit(0))
    tiers = leagues.groupBy("tier").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"), within.alias("within"), F.var_samp("mean").alias("spread"), F.avg(1 / F.col("n")).alias("thin"))
    tiers = tiers.withColumn("between", F.greatest(F.col("spread") - F.col("within") * F.col("thin"), F.lit(0.0)))
    trust = F.coalesce(F.col("between") / F.nullif(F.col("between") + F.col("within") / F.col("n"), F.lit(0.0)), F.lit(0.0))
    out = leagues.join(tiers, "tier").withColumn("shrunk", F.exp(F.col("centre") + trust * (F.col("mean") - F.col("centre"))))
    return out.select("league", "tier", "n", F.exp("mean").alias("own"), "shrunk")


def newest_version(registry: DataFrame) -> DataFrame:
    """(model, version, at): the version trained last, whatever became of it; what a shadow projection is made with."""
    return algebra.latest_per_key(registry.where(F.col("event") == "train"), ["model"], [F.col("at"), F.col("version")]).select("model", "version", "at")
