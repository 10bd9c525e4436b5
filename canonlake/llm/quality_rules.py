"""Quality rules: text statistics, fixed base rules, and robust outliers per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import SPACES, fresh, let, lookup, staged

#: The smallest standard deviation that a statistic counts with, so that a statistic that hardly varies rejects no document for a
#: trace of it. A root of a share of n varies by about 1 / (2 sqrt(n)) by chance alone, whatever the share: 0.05 for symbols among the
#: 100 characters of the shortest text that passes (50 words of two), 0.15 for lines and for repeated stretches, of
#: which such a text has about 11. Lengths of texts differ by half a unit of their logarithm, those of words by a tenth.
FLOORS = {"f_words": 0.5, "f_length": 0.1, "f_symbols": 0.05, "f_lines": 0.15, "f_repeats": 0.15}
FEATURES = list(FLOORS)
#: Bins a unit in which quantiles are counted; values are logarithms and roots, so a group has some thousands of bins at most.
BINS = 512
#: The median of a chi-square distribution with as many degrees of freedom as there are statistics.
CHI2_MEDIAN = 4.3515


def _repeat_words(windows: Column) -> Column:
    """Words under windows that occur twice or more; windows are hashes in the order of the text."""

    def covered(ordered):
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        twice = F.filter(ordered, lambda e, i: same(F.get(ordered, i - 1), e) | same(F.get(ordered, i + 1), e))
        return let(
            F.sort_array(F.transform(twice, lambda e: e["i"])),
            lambda at: F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x),
        )

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(ordered, covered))


def text_stats(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_lines (those with a word), n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    df = df.withColumns(
        {
            "__words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1)),
            "__lines": F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        }
    )
    df = df.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__hashes": F.transform("__words", lambda w: F.xxhash64(w)),
        }
    )
    spans = F.sequence(F.lit(0), F.size("__hashes") - 3)
    hashes = F.col("__hashes")
    windows = F.transform(spans, lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))
    df = df.withColumn("__windows", F.when(F.size("__hashes") < 3, F.array().cast("array<long>")).otherwise(windows))
    return df.withColumn("n_repeat_words", _repeat_words(F.col("__windows")).cast("long")).drop("__words", "__lines", "__hashes", "__windows")


def _distance(table: DataFrame) -> Column:
    """Squared Mahalanobis distance of the statistics, by the inverse of the group's Cholesky factor."""
    off = [F.col(f) - F.col(f"m{i}") for i, f in enumerate(FEATURES)]
    squares = [F.pow(sum((F.col(f"w{i}_{j}") * off[j] for j in range(1, i + 1)), F.col(f"w{i}_0") * off[0]), F.lit(2)) for i in range(len(FEATURES))]
    return sum(squares[1:], squares[0])


#: Estimates up to which their tables are broadcast.
SMALL = 100_000
#: What names an estimate: a group, and the start that it came from.
KEYS = ["grp", "start"]


#: The places (i, j) of a lower triangle, row by row.
TRIANGLE = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _factored(moments: DataFrame) -> DataFrame:
    """Means m and covariances c of each estimate to means, Cholesky factors l, their inverses w and the logarithm of the determinant; the floors enter the diagonal.

    The triangles are filled place by place in arrays, so that the expression does not grow with what it depends on.
    """
    n = len(FEATURES)
    first, last = (F.array(*[F.lit(t[k]) for t in TRIANGLE]) for k in (0, 1))
    at = lambda i, j: (i * (i + 1) / 2).cast("int") + j
    upto = lambda begin, many: F.slice(F.sequence(F.lit(0), F.lit(n - 1)), begin + 1, many)
    total = lambda places, term: F.aggregate(places, F.lit(0.0), lambda a, k: a + term(k))

    def filled(place) -> Column:
        def step(found, p):
            i, j = F.get(first, p), F.get(last, p)
            return F.concat(found, F.array(place(found, p, i, j)))

        return F.aggregate(F.sequence(F.lit(0), F.lit(len(TRIANGLE) - 1)), F.array().cast("array<double>"), step)

    def of_factor(found, p, i, j) -> Column:
        value = F.get("c", p) - total(upto(F.lit(0), j), lambda k: F.get(found, at(i, k)) * F.get(found, at(j, k)))
        # the floors make the matrix positive definite; greatest() only guards rounding
        return F.when(i == j, F.sqrt(F.greatest(value, F.lit(1e-9)))).otherwise(value / F.get(found, at(j, j)))

    def of_inverse(found, p, i, j) -> Column:
        rest = total(upto(j, i - j), lambda k: F.get("l", at(i, k)) * F.get(found, at(k, j)))
        return F.when(i == j, 1 / F.get("l", at(i, i))).otherwise(-rest / F.get("l", at(i, i)))

    means = [f"m{i}" for i in range(n)]
    c = F.array(*[F.col(f"c{i}_{j}") + F.lit(FLOORS[FEATURES[i]] ** 2 if i == j else 0.0) for i, j in TRIANGLE])
    out = moments.select(*KEYS, *means, c.alias("c")).withColumn("l", filled(of_factor)).withColumn("w", filled(of_inverse))
    logdet = sum((2 * F.log(F.get("l", F.lit(i * (i + 3) // 2))) for i in range(1, n)), 2 * F.log(F.get("l", F.lit(0))))
    each = lambda name: [F.get(name, F.lit(k)).alias(f"{name}{i}_{j}") for k, (i, j) in enumerate(TRIANGLE)]
    return out.select(*KEYS, *means, *each("l"), *each("w"), logdet.alias("logdet"))


def _binned(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``df`` with the bin of each value, of ``BINS`` a unit, for ``_quantile``."""
    return df.withColumns({f"bin_{name}": F.floor(value * BINS) for name, value in values.items()})


def _quantile(name: str, share: float) -> Column:
    """An aggregate of binned values: the upper edge of the first bin up to which ``share`` of them lie.

    Tasks count values by bin and only counts are merged, so the result does not depend on how rows are dealt out, and a
    group's state has as many entries as it has bins.
    """
    return (F.expr(f"percentile_disc({share}) within group (order by bin_{name})") + 1) / BINS


def _moments(value=F.col) -> list[Column]:
    n = len(FEATURES)
    return [
        *[F.avg(value(f)).alias(f"m{i}") for i, f in enumerate(FEATURES)],
        *[F.covar_pop(value(FEATURES[i]), value(FEATURES[j])).alias(f"c{i}_{j}") for i in range(n) for j in range(i + 1)],
    ]


def _starts(stats: DataFrame) -> DataFrame:
    """Three first estimates of each group: medians with median deviations, plain moments, and medians with the covariance of spatial signs, which outliers pull by their direction only."""
    n = len(FEATURES)
    medians = lookup(_binned(stats, {f: F.col(f) for f in FEATURES}).groupBy("grp").agg(*[_quantile(f, 0.5).alias(f"m{i}") for i, f in enumerate(FEATURES)]), "mcd-medians")
    off = lambda i: F.col(FEATURES[i]) - F.col(f"m{i}")
    apart = _binned(stats.join(medians, "grp"), {f: F.abs(off(i)) for i, f in enumerate(FEATURES)})
    spreads = apart.groupBy("grp").agg(*[F.greatest(1.4826 * _quantile(f, 0.5), F.lit(FLOORS[f])).alias(f"d{i}") for i, f in enumerate(FEATURES)])
    spreads = lookup(spreads, "mcd-spreads")
    both = stats.join(medians, "grp").join(spreads, "grp")
    scaled = [off(i) / F.col(f"d{i}") for i in range(n)]
    norm = F.greatest(F.sqrt(sum((x * x for x in scaled[1:]), scaled[0] * scaled[0])), F.lit(1e-9))
    units = both.select("grp", *[x.alias(f"u{i}") for i, x in enumerate(scaled)], norm.alias("norm"))
    signs = staged(units.groupBy("grp").agg(*[F.avg(F.col(f"u{i}") * F.col(f"u{j}") / F.pow("norm", F.lit(2))).alias(f"s{i}_{j}") for i in range(n) for j in range(i + 1)]), "mcd-signs")
    centre = medians.join(spreads, "grp")
    covariances = [(i, j) for i in range(n) for j in range(i + 1)]
    told = lambda start, df, c: df.select("grp", F.lit(start).alias("start"), *[f"m{i}" for i in range(n)], *[c(i, j).alias(f"c{i}_{j}") for i, j in covariances])
    median = told("median", centre, lambda i, j: F.pow(f"d{i}", F.lit(2)) if i == j else F.lit(0.0))
    plain = told("moments", staged(stats.groupBy("grp").agg(*_moments()), "mcd-moments"), lambda i, j: F.col(f"c{i}_{j}"))
    signed = told("signs", centre.join(signs, "grp"), lambda i, j: n * F.col(f"s{i}_{j}") * F.col(f"d{i}") * F.col(f"d{j}"))
    return median.unionByName(plain).unionByName(signed)


def fit_groups(stats: DataFrame, share: float = 0.75, steps: int = 50) -> DataFrame:
    """Minimum-covariance-determinant estimates of each group: a row with means, a Cholesky factor and ``scale``.

    From each of three starts, concentration steps take the ``share`` of a group's documents nearest to the estimate and estimate
    anew from them. The determinant falls from step to step and settles after finitely many; a start is left alone once it
    falls by less than a thousandth, and the work ends when all have (``steps`` only guards against rounding that
    never settles). Of a group's three results the one with the least determinant counts.

    Everything is grouped aggregation with partial sums and partial counts, so a group with a third of all rows
    is no hot spot; estimates are tables of three rows a group, broadcast if counted small, and never reach the driver.
    Groups of equal rows end at the floors. No rows give no estimates; null statistics must not occur.
    """
    fitted = staged(_factored(_starts(stats)), "mcd-start")
    small = fitted.count() <= SMALL
    shown = lambda df: F.broadcast(df) if small else df  # noqa: E731 - tables with a row an estimate, which are as many as were counted
    settled = None
    open_ = fitted
    for step in range(steps):
        measured = stats.join(shown(open_), "grp").withColumn("d2", _distance(open_)).select(*KEYS, F.log1p("d2").alias("d"), *FEATURES)
        limits = _binned(measured, {"d": F.col("d")}).groupBy(*KEYS).agg(_quantile("d", share).alias("limit"))
        near = measured.join(shown(limits), KEYS).where(F.col("d") <= F.col("limit"))
        new = _factored(near.groupBy(*KEYS).agg(*_moments()))
        before = open_.select(*KEYS, F.col("logdet").alias("before"))
        new = staged(new.join(shown(before), KEYS).withColumn("fallen", F.col("before") - F.col("logdet")).drop("before"), f"mcd-step{step}")
        done = new.where("not fallen >= 1e-3").drop("fallen")
        settled = done if settled is None else settled.unionByName(done)
        open_ = new.where("fallen >= 1e-3").drop("fallen")
        if open_.isEmpty():
            break
    both = settled.unionByName(open_) if settled is not None else open_
    best = both.groupBy("grp").agg(F.min(F.struct("logdet", "start")).alias("best")).select("grp", "best.start")
    fitted = staged(both.join(best, KEYS), "mcd-best")
    measured = stats.join(shown(fitted), "grp").withColumn("d2", _distance(fitted))
    scale = _binned(measured, {"d": F.log1p("d2")}).groupBy("grp").agg((F.expm1(_quantile("d", 0.5)) / CHI2_MEDIAN).alias("scale"))
    return lookup(fitted.drop("start", "logdet").join(scale.withColumn("scale", F.greatest("scale", F.lit(1.0))), "grp"), "mcd")


def quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
    min_words: int = 50,
    max_repeat_percent: int = 50,
    cutoff: float = 40.0,
    min_group: int = 50,
) -> DataFrame:
    """A row for each row of ``df``: id, ``row`` (hash of the text), the statistics, base_failed, distance, kept.

    Base rules: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of the words in repeated
    three-word windows, fails. The rest is measured against the robust estimate of its language and source:
    a squared Mahalanobis distance over ``cutoff`` is rejected (chi-square with five degrees of freedom has
    1.5e-7 of its mass beyond 40). Documents that fail base rules enter no estimate. Those of a group with fewer than ``min_group``
    documents are measured against all documents of their first group column, or, where those are too few as well, against
    all documents; if even they are too few, the base rules decide alone.

    Texts are read once and not shuffled; statistics are written as a table. Null texts have no words and
    fail. Null languages or sources form groups of their own. Repeated ids and rows are judged row by row.
    An empty table gives an empty table. Of the input's columns only those named are read, so clashing names
    do no harm; the id comes back as ``id_col``.
    """
    named = [F.concat(F.when(F.col(c).isNull(), "-").otherwise("+"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in group_cols]
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = df.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("row"), text.alias("__text"), named[0].alias("wide"), F.concat_ws("\x00", *named).alias("narrow"))
    stats = text_stats(source, "__text").drop("__text")
    ratio = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    stats = stats.withColumns(
        {
            "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")),
            "f_words": F.log(F.greatest("n_words", F.lit(1))),
            "f_length": F.log(F.greatest("word_chars", F.lit(1)) / F.greatest("n_words", F.lit(1))),
            "f_symbols": ratio("n_symbols", "word_chars"),
            "f_lines": ratio("n_dup_lines", "n_lines"),
            "f_repeats": ratio("n_repeat_words", "n_words"),
        }
    )
    stats = staged(stats, "text-stats")
    good = ~F.col("base_failed")
    groups = staged(stats.where(good).groupBy("wide", "narrow").agg(F.count(F.lit(1)).alias("size")), "group-sizes")
    large = lambda c: F.coalesce(F.col(c) >= min_group, F.lit(False))
    wides = staged(groups.groupBy("wide").agg(F.sum("size").alias("wide_size"), F.bool_or(F.col("size") < min_group).alias("lent")), "wide-sizes")
    total = wides.agg(F.sum("wide_size").alias("n"), F.bool_or(~large("wide_size")).alias("lent")).first()
    everything = bool(total.lent) and total.n >= min_group
    sized = stats.join(lookup(groups, "groups"), ["wide", "narrow"], "left").join(lookup(wides, "wides"), "wide", "left")
    wide, all_ = F.concat(F.lit("*"), "wide"), F.lit("**")
    own = F.when(large("size"), F.col("narrow")).when(large("wide_size"), wide).otherwise(all_)
    # what a document helps to estimate: its own group, and the wider ones that some smaller group needs
    helps = F.array_compact(F.array(F.when(large("size"), F.col("narrow")), F.when(large("wide_size") & F.col("lent"), wide), F.when(F.lit(everything), all_)))
    sized = sized.withColumn("grp", own)
    fitted = fit_groups(staged(sized.where(good).select(F.explode(helps).alias("grp"), *FEATURES), "mcd-rows"))
    judged = sized.join(fitted, "grp", "left").withColumn("distance", _distance(fitted) / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select(
        F.col("__id").alias(id_col), "row", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", *FEATURES, "base_failed", "distance", kept.alias("kept")
    )


def kept_documents(df: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``quality_rules`` keeps, unchanged.

    Rows are told apart by id and text, so a repeated id keeps those of its rows that were kept; equal rows share a verdict
    unless they lie in different groups, where one that is kept keeps both. Null ids and texts count as values. An empty table gives an empty
    table. Columns of any name may be there: the names used inside give way.
    """
    key, row = fresh(df, "id", "row")
    good = verdicts.where("kept").select(F.col(id_col).alias(key), F.col("row").alias(row)).distinct()
    return df.join(good, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(row)), "left_semi")
