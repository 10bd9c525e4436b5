"""Derived analytics over curated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canonlake.functions import scalars as S
from canonlake.operators import algebra, flatten

# States of a newcomer's history; only the first is final.
DONE, NO_HISTORY, FAILED, NO_IDENTITY = "descargado", "sin-historial", "fallo", "sin-identidad"


def newcomers(squad: DataFrame, points: DataFrame, season: int) -> DataFrame:
    """Squad rows (id) without points (player_id, season) in an earlier season of the same competition."""
    veterans = points.where(F.col("season").cast("int") < season).select(F.col("player_id").alias("id"))
    return squad.where(F.col("id").isNotNull()).join(veterans.distinct(), "id", "left_anti")


def open_newcomers(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Newcomers whose history is not stored as downloaded in any season."""
    return found.join(stored.where(F.col("history") == DONE).select(F.col("player_id").alias("id")).distinct(), "id", "left_anti")


def newcomer_state(source_id: Column, canonical: Column, rows: Column, failed: Column) -> Column:
    """The next state: without a canonical id the identity is missing; then failure, no rows, done."""
    return F.when(F.coalesce(canonical, F.lit("")) == "", NO_IDENTITY).when(failed | source_id.isNull(), FAILED).when(F.coalesce(rows, F.lit(0)) == 0, NO_HISTORY).otherwise(DONE)


def tracked(events: DataFrame, teams: DataFrame) -> DataFrame:
    """Events in which a side is a tracked team of the event's season; ``teams`` has team_id and season.

    Two lookups on equal keys, not one join on a disjunction, which Spark could only loop over.
    """
    known = teams.select("team_id", F.col("season").alias("__season")).distinct()
    found = events
    for side in ("home", "away"):
        own = known.select(F.col("team_id").alias("__team"), "__season", F.lit(True).alias(f"__{side}"))
        found = found.join(own, (found[f"{side}_team_id"] == F.col("__team")) & (found["season"] == F.col("__season")), "left").drop("__team", "__season")
    return found.where(F.col("__home") | F.col("__away")).drop("__home", "__away")


def fixtures(league: DataFrame, cups: DataFrame, teams: DataFrame) -> DataFrame:
    """Tracked matches of leagues and cups, one row an event; a cup's record comes after a league's and wins."""
    both = league.withColumn("priority", F.lit(0)).unionByName(cups.withColumn("priority", F.lit(1)))
    return algebra.latest_per_key(tracked(both, teams), ["event_id"], [F.col("priority")]).drop("priority")


def cup_minutes(played: DataFrame, teams: DataFrame, approved: DataFrame) -> DataFrame:
    """Minutes of players of tracked sides; ``played`` is what ``flatten.played`` returns."""
    own = played.join(teams.select("team_id", "season").distinct(), ["team_id", "season"], "left_semi").withColumn("id_text", F.col("source_player_id").cast("string"))
    stamped = algebra.lookup(own, approved, "id_text", "id_en_fuente", "canonical_id", "")
    minutes = flatten.number(F.try_element_at("statistics", F.lit("minutesPlayed")))
    return stamped.select(S.player_event(F.col("source_player_id"), F.col("event_id")).alias("player_event"), "canonical_id", "source_player_id", "event_id", "date", "team_id", "opponent_id", "is_home", "is_starting", minutes.alias("minutes"), "season")


def identity_catalog(entries: DataFrame, competition: Column) -> tuple[DataFrame, DataFrame]:
    """(players, teams) of line-ups by competition and season; the name of the latest match wins."""
    keyed = entries.where(F.col("source_player_id").isNotNull()).withColumn("competition", competition)
    order = [F.col("date"), F.col("event_id")]
    players = algebra.latest_per_key(keyed.select("competition", "season", "source_player_id", "name", "birth_date", "team_id", "team_name", "date", "event_id"), ["competition", "season", "source_player_id", "team_id"], order)
    teams = algebra.latest_per_key(keyed.select("competition", "season", "team_id", "team_name", "date", "event_id"), ["competition", "season", "team_id"], order)
    return players.drop("date", "event_id"), teams.drop("date", "event_id")


def minutes_check(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 0.10, share: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """(report of one row, discrepancies): minutes of two sources, within ``tolerance`` of the second."""
    both = a.select(*keys, F.col("minutes").alias("minutes_a")).join(b.select(*keys, F.col("minutes").alias("minutes_b")), keys).where("minutes_b > 0 and minutes_a is not null")
    judged = both.withColumn("within", F.abs(F.col("minutes_a") - F.col("minutes_b")) <= tolerance * F.col("minutes_b"))
    report = judged.agg(F.count(F.lit(1)).alias("common_rows"), F.count_if("within").alias("within_tolerance"))
    part = F.when(F.col("common_rows") > 0, F.col("within_tolerance") / F.col("common_rows")).otherwise(F.lit(0.0))
    return report.withColumn("share", part).withColumn("passed", (F.col("common_rows") > 0) & (part >= share)), judged.where("not within").drop("within")


def comparable(stats: DataFrame, source: str, competitions: list[str]) -> DataFrame:
    """Rows of one source in covered competitions that have a canonical id and a date."""
    return stats.where((F.col("source") == source) & F.col("competition").isin(competitions) & (F.coalesce("canonical_id", F.lit("")) != "") & F.col("date").isNotNull()).select("canonical_id", "date", "minutes")


def coverage_gaps(curated: DataFrame, approved: DataFrame, kind: str) -> DataFrame:
    """(kind, id, message) for curated ids without an approved mapping."""
    missing = curated.select(F.col("id").cast("string").alias("id")).dropna().distinct().join(approved.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_anti")
    return missing.select(F.lit(kind).alias("kind"), "id", F.concat(F.lit(f"{kind} "), "id", F.lit(" has no mapping")).alias("message"))


def mapping_report(left: DataFrame, approved: DataFrame, review: DataFrame) -> DataFrame:
    """Counts of a mapping run: people, mapped, by hand, percent automatic, in review, dangling (mapped but no longer there)."""
    ids = left.select(F.col("id").cast("string").alias("id")).distinct()
    mapped = approved.select(F.col("id").cast("string").alias("id"), "metodo").dropDuplicates(["id"])
    both = ids.withColumn("here", F.lit(True)).join(mapped.withColumn("mapped", F.lit(True)), "id", "full_outer")
    counts = both.agg(
        F.count_if("here").alias("total"),
        F.count_if(F.col("here") & F.col("mapped")).alias("mapped"),
        F.count_if(F.col("here") & (F.col("metodo") == "auto")).alias("automatic"),
        F.count_if(F.col("here") & (F.col("metodo") == "manual")).alias("manual"),
        F.count_if(F.col("here").isNull()).alias("dangling"),
    )
    waiting = review.agg(F.count_distinct("left_id").alias("in_review"))
    percent = F.when(F.col("total") > 0, 100.0 * F.col("automatic") / F.col("total")).otherwise(F.lit(0.0))
    return counts.join(F.broadcast(waiting)).withColumn("percent_automatic", percent)  # one row each


def dangling(approved: DataFrame, stored: DataFrame) -> DataFrame:
    """Mapped source ids whose history is not stored: what the next single-player ingests have to fetch."""
    return approved.select(F.col("id").cast("string").alias("id")).distinct().join(stored.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_anti")


def prunable(members: DataFrame, seen: DataFrame, complete: bool) -> DataFrame | None:
    """The members to retain after a crawl, or None if it was not complete and nothing may be pruned."""
    return algebra.with_keys(members, seen, ["id"]) if complete else None


def density(fixtures_: DataFrame) -> DataFrame:
    """Each team's matches with the days since its previous match in any competition."""
    sides = fixtures_.select("event_id", "date", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    return algebra.shares_with_previous(sides, ["team_id"], "date")


def midweek_minutes(minutes: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Minutes played from Tuesday to Thursday, by key and week (the Monday it begins with)."""
    weekday = F.weekday(day)
    return minutes.where(weekday.between(1, 3)).groupBy(*keys, F.to_date(F.date_trunc("week", day)).alias("week")).agg(F.sum("minutes").alias("minutes"))


def since_return(matches: DataFrame, spells: DataFrame, key: str, day: str) -> DataFrame:
    """``matches`` with ``since_return``: how many matches of the key since its latest injury ended, this one included; null before any.

    Ends of spells and matches are one series a key, so a running maximum finds the latest end instead of a join on an inequality.
    """
    ends = spells.where(F.col("until_date").isNotNull()).select(F.col(key), F.col("until_date").alias("__day"), F.col("until_date").alias("__end")).distinct()
    both = matches.withColumn("__day", F.col(day)).unionByName(ends, allowMissingColumns=True).withColumn("__match", F.col(day).isNotNull())
    so_far = Window.partitionBy(key).orderBy(F.unix_date("__day")).rangeBetween(Window.unboundedPreceding, -1)
    last = both.withColumn("__last", F.max("__end").over(so_far)).where("__match")
    counted = last.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key, "__last").orderBy("__day")))
    return counted.withColumn("since_return", F.when(F.col("__last").isNotNull(), F.col("__n"))).select(*matches.columns, "since_return")


def team_levels(sides: DataFrame, values: DataFrame) -> DataFrame:
    """``sides`` (team_id, opponent_id, season) with the squad values of both; ``values`` has team_id, season and squad_value."""
    own = values.groupBy("team_id", "season").agg(F.max("squad_value").alias("__v"))
    out = sides
    for column, name in (("team_id", "own_level"), ("opponent_id", "opponent_level")):
        out = out.join(own.select(F.col("team_id").alias(column), "season", F.col("__v").alias(name)), [column, "season"], "left")
    return out.select(*sides.columns, "own_level", "opponent_level")


def form(df: DataFrame, keys: list[str], order: list[str], measure: str, n: int = 5) -> DataFrame:
    """``df`` with the mean of the last ``n`` rows before each one."""
    return df.withColumn("form", F.avg(measure).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1)))


def streaks(df: DataFrame, keys: list[str], order: list[str], flag: str) -> DataFrame:
    """``df`` with the length of the run of true flags that ends at each row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    broken = F.sum(F.when(F.col(flag), 0).otherwise(1)).over(w)
    runs = df.withColumn("__run", broken)
    return runs.withColumn("streak", F.sum(F.col(flag).cast("int")).over(Window.partitionBy(*keys, "__run").orderBy(*order))).drop("__run")


def days_within(spells: DataFrame, days: DataFrame, window: int = 365) -> DataFrame:
    """For each (key, day), the days of spells [from_date, until_date] in the ``window`` days before it.

    Spells and windows meet by blocks of ``window`` days, so the interval join is one on equal keys: a spell is
    listed under each block it touches, a window touches two.
    """
    block = lambda d: F.floor(F.unix_date(d) / window)
    listed = spells.withColumn("block", F.explode(F.sequence(block(F.col("from_date")), block(F.col("until_date")))))
    asked = days.select("key", "day").distinct().withColumn("begin", F.date_sub("day", window))
    asked = asked.withColumn("block", F.explode(F.sequence(block(F.col("begin")), block(F.date_sub("day", 1)))))
    # within a block, count only the days of that block, so nothing counts twice
    first = F.date_from_unix_date((F.col("block") * window).cast("int"))
    last = F.date_add(first, window - 1)
    days_of = F.date_diff(F.least("until_date", F.date_sub("day", 1), last), F.greatest("from_date", "begin", first)) + 1
    met = asked.join(listed, ["key", "block"], "left").groupBy("key", "day").agg(F.coalesce(F.sum(F.when(F.col("from_date").isNotNull(), F.greatest(days_of, F.lit(0)))), F.lit(0)).alias("days"))
    return met


def movers(daily: DataFrame, key: str, day: str, value: str, n: int = 7) -> DataFrame:
    """Change of a value against the last one at least ``n`` days before."""
    number = F.unix_date(day)
    w = Window.partitionBy(key).orderBy(number).rangeBetween(Window.unboundedPreceding, -n)
    return daily.withColumn("change", F.col(value) - F.last(value).over(w))


def value_picks(df: DataFrame, group: str, points: str, price: str, identifier: str, k: int = 5) -> DataFrame:
    """The k best of each group by points per million; a top-k report."""
    rated = df.where(F.col(price) > 0).withColumn("per_million", F.col(points) / (F.col(price) / 1e6))
    return rated.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("per_million"), identifier))).where(F.col("place") <= k)


def similar_players(df: DataFrame, group: str, identifier: str, measures: list[str], k: int = 5, cells: int = 16) -> DataFrame:
    """(group, id, place, other, distance): the k nearest players of the same group by standardised measures, ties by id; a top-k report.

    Each group is cut into ``cells`` ranges of its first measure. A player meets its own cell and the two beside it; whose k-th
    neighbour is nearer than the border of what was seen is done, and only the others meet the rest of their group.
    """
    zs = [f"z{i}" for i in range(len(measures))]
    stats = df.groupBy(group).agg(*[x for m, z in zip(measures, zs) for x in (F.avg(m).alias(f"a_{z}"), F.stddev_pop(m).alias(f"s_{z}"))])
    scaled = df.join(stats, group).select(group, F.col(identifier).alias("id"), *[F.coalesce((F.col(m) - F.col(f"a_{z}")) / F.nullif(F.col(f"s_{z}"), F.lit(0.0)), F.lit(0.0)).alias(z) for m, z in zip(measures, zs)])
    edges = scaled.groupBy(group).agg(F.min("z0").alias("low"), F.greatest((F.max("z0") - F.min("z0")) / cells, F.lit(1e-9)).alias("width"))
    placed = scaled.join(edges, group).withColumn("cell", F.least(F.floor((F.col("z0") - F.col("low")) / F.col("width")), F.lit(cells - 1)))
    other = placed.select(group, F.col("id").alias("other"), F.col("cell").alias("at"), *[F.col(z).alias(f"o_{z}") for z in zs])
    distance = F.sqrt(sum((F.pow(F.col(z) - F.col(f"o_{z}"), 2) for z in zs), F.lit(0.0)))

    def nearest(pairs: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(group, "id").orderBy("distance", "other"))
        return pairs.where("id <> other").withColumn("distance", distance).withColumn("place", place).where(F.col("place") <= k).select(group, "id", "place", "other", "distance")

    seen = nearest(placed.withColumn("at", F.explode(F.sequence(F.col("cell") - 1, F.col("cell") + 1))).join(other, [group, "at"]))
    below = F.when(F.col("cell") >= 2, F.col("z0") - F.col("low") - (F.col("cell") - 1) * F.col("width"))
    above = F.when(F.col("cell") <= cells - 3, F.col("low") + (F.col("cell") + 2) * F.col("width") - F.col("z0"))
    last = seen.where(F.col("place") == k).select(group, "id", F.col("distance").alias("farthest"))
    judged = placed.withColumn("border", F.least(below, above)).join(last, [group, "id"], "left")
    open_ = judged.where(F.col("border").isNotNull() & ~F.coalesce(F.col("farthest") < F.col("border"), F.lit(False))).select(group, "id", *zs)
    rest = nearest(open_.join(other, group))
    return seen.join(open_.select(group, "id"), [group, "id"], "left_anti").unionByName(rest)


def projections(minutes: DataFrame, performance: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Minutes model times performance model: ``projected`` points of each key, with the tenth and ninetieth percentile.

    ``minutes`` has the keys and expected_minutes; ``performance`` the keys and per_90 of past matches, one row a match.
    """
    rates = performance.groupBy(*keys).agg(F.avg("per_90").alias("rate"), *[F.percentile("per_90", F.lit(p)).alias(f"__p{round(100 * p)}") for p in (0.1, 0.9)])
    share = F.col("expected_minutes") / 90
    return minutes.join(rates, keys).select(*keys, (share * F.col("rate")).alias("projected"), (share * F.col("__p10")).alias("p10"), (share * F.col("__p90")).alias("p90"), F.lit(version).alias("version"))


def season_projection(rounds: DataFrame, keys: list[str], done: str) -> DataFrame:
    """The sum of the projections of rounds that are still to come, by key and version."""
    return rounds.where(~F.col(done)).groupBy(*keys, "version").agg(F.sum("projected").alias("projected"), F.count(F.lit(1)).alias("rounds"))


def temporal_split(df: DataFrame, day: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """(before, from the cutoff on): a model is judged on days that it could not have seen."""
    return df.where(F.col(day) < F.lit(cutoff)), df.where(F.col(day) >= F.lit(cutoff))


def start_accuracy(projected: DataFrame, actual: DataFrame, keys: list[str], groups: list[str]) -> DataFrame:
    """Share of right calls of who starts, by group: a probability of at least one half against ``started``."""
    both = projected.join(actual, keys).withColumn("right", (F.col("start_probability") >= 0.5) == F.col("started"))
    return both.groupBy(*groups).agg(F.avg(F.col("right").cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def active_models(registry: DataFrame) -> DataFrame:
    """Of a registry (model, version, event, at) the version of each model that is active: the latest activation that no later archiving of it undid."""
    last = algebra.latest_per_key(registry.where(F.col("event").isin("activate", "archive")), ["model", "version"], [F.col("at"), F.col("event")])
    return algebra.latest_per_key(last.where("event = 'activate'"), ["model"], [F.col("at"), F.col("version")]).select("model", "version", "at")


def projection_error(projected: DataFrame, actual: DataFrame, keys: list[str], groups: list[str]) -> DataFrame:
    """Mean absolute error of projections (columns projected, version) by group, and how many were compared."""
    both = projected.join(actual, keys)
    return both.groupBy(*groups).agg(F.avg(F.abs(F.col("projected") - F.col("actual"))).alias("mae"), F.count(F.lit(1)).alias("n"))


def league_level(values: DataFrame, by: list[str]) -> DataFrame:
    """Mean squad value."""
    return values.groupBy(*by).agg(F.avg("squad_value").alias("level"))


def league_coefficients(before_after: DataFrame, prior_rows: float = 10.0) -> DataFrame:
    """From (league, tier, minutes, before, after) per transfer: the weighted ratio of rates after and before, shrunk to the tier's."""
    leagues = before_after.groupBy("league", "tier").agg(F.sum(F.col("after") * F.col("minutes")).alias("a"), F.sum(F.col("before") * F.col("minutes")).alias("b"), F.count(F.lit(1)).alias("n"))
    tiers = leagues.groupBy("tier").agg((F.sum("a") / F.sum("b")).alias("tier_ratio"))
    joined = leagues.join(tiers, "tier")
    own = F.col("a") / F.nullif(F.col("b"), F.lit(0.0))
    return joined.withColumn("coefficient", (F.coalesce(own, F.lit(0.0)) * F.col("n") + prior_rows * F.col("tier_ratio")) / (F.col("n") + prior_rows)).select("league", "tier", "n", "coefficient")


def regression(df: DataFrame, groups: list[str], y: str, x: str) -> DataFrame:
    """Slope, intercept and fit of one measure on another by group."""
    return df.groupBy(*groups).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def status_histogram(attempts: DataFrame, groups: list[str], status: str) -> DataFrame:
    """How often each HTTP status came, by group."""
    return attempts.groupBy(*groups, status).agg(F.count(F.lit(1)).alias("n"))


def direct_access_verdict(statuses: Column) -> Column:
    """From an array of HTTP statuses: 403 before 200 before 429 before anything else; the words are fixed values."""
    has = lambda s: F.array_contains(statuses, s)
    return F.when(has(403), "blocked").when(has(200), "viable").when(has(429), "rate-limited").otherwise("unreachable")
