"""Jobs from the raw layer to curated tables and reports: what the command line runs.

Downloading is a seam: a job reads what the raw layer holds, however it came there. A payload that breaks its contract fails an ingest
and is counted by a rebuild.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonlake.functions import scalars as S
from canonlake.operators import algebra, flatten, resolve
from canonlake.plans import analytics
from canonlake.plans.orchestrator import Report, Result, Step, run_steps
from canonlake.sources import html
from canonlake.sources.curated import CuratedStore
from canonlake.sources.mapping_csv import MappingStore, approved
from canonlake.sources.raw import RawStore

# Sources, and the numbers of tournaments by competition.
FANTASY, VALUATION, EVENTS = "biwenger", "transfermarkt", "sofascore"
TOURNAMENTS = {"la-liga": 8, "segunda-division": 54, "champions-league": 7, "europa-league": 679, "conference-league": 17015, "copa-del-rey": 329}
TRACKED_LEAGUE = "la-liga"
#: Competitions whose minutes both sources tell, by tournament number.
COVERED = [str(TOURNAMENTS[c]) for c in ("la-liga", "segunda-division")]
COMPETITION_CODES = {"la-liga": "ES1", "segunda-division": "ES2"}
#: Fixed value: the partition of players that were asked for one by one and are in no squad.
ON_DEMAND = "bajo-demanda"

#: Tables of a player's whole history: dataset, contract and rows of each.
HISTORIES = (
    ("market_values_tm", "market-value", "values", flatten.market_values),
    ("transfers", "transfers", "transfers", flatten.transfers),
    ("availability_tm", "performance-game", "performance", flatten.availability),
)


class Lake:
    """The stores of one base folder."""

    def __init__(self, spark: SparkSession, base: str, mappings: str = "mappings"):
        self.spark, self.raw, self.curated, self.mappings = spark, RawStore(spark, base), CuratedStore(spark, base), MappingStore(spark, mappings)

    def payloads(self, source: str, dataset: str, contract: str, named: str = "", strict: bool = False, ends: str = "", among: DataFrame | set[str] | None = None) -> tuple[DataFrame, int]:
        """Good payloads of a dataset, and how many broke the contract. Only those whose names begin with ``named``, end with ``ends`` and are in ``among`` are parsed, so what
        another season or player left broken does no harm."""
        good, bad = flatten.parsed(self.raw.latest(source, dataset, named=named, ends=ends, among=among).select("name", "payload"), contract)
        broken = bad.count()
        if strict and broken:
            raise ValueError(f"{broken} payloads of {source}/{dataset} break their contract")
        return good, broken


def job(fn: Callable) -> Callable:
    """A job whose staged tables are removed when it ends, however it ends."""

    @functools.wraps(fn)
    def run(lake: Lake, *args, **kwargs):
        try:
            return fn(lake, *args, **kwargs)
        finally:
            lake.curated.sweep()

    return run


@job
def ingest_squad(lake: Lake, competition: str) -> Result:
    """The roster and teams of a competition; birth dates that are known stay."""
    good, _ = lake.payloads(FANTASY, "competition-data", "competition", competition, strict=True)
    where = {"competition": competition}
    players = flatten.keep_birth_dates(flatten.squad(good), lake.curated.read_partition("biwenger_players", where))
    lake.curated.write_table("biwenger_players", players, where)
    lake.curated.write_table("biwenger_teams", flatten.teams(good), where)
    return Result(rows={"biwenger_players": lake.curated.read_partition("biwenger_players", where).count()})


@job
def ingest_reports(lake: Lake, competition: str, season: int) -> Result:
    """Points, prices and birth dates from all reports of a season."""
    good, _ = lake.payloads(FANTASY, "player-reports", "reports", f"{competition}-", strict=True, ends=f"-{season}")
    where = {"competition": competition, "season": str(season)}
    points, anomalies = flatten.fantasy_points(good)
    points = lake.curated.staged(points)
    lake.curated.upsert("fantasy_points", points, ["player_id"], where)
    lake.curated.upsert("biwenger_prices", flatten.prices(good, season), ["player_id", "date"], where)
    squad = lake.curated.read_partition("biwenger_players", {"competition": competition})
    if squad is not None:
        born = flatten.birth_dates(good).where("birth_date is not null").withColumnRenamed("birth_date", "born")
        lake.curated.write_table("biwenger_players", squad.join(born, "id", "left").withColumn("birth_date", F.coalesce("born", "birth_date")).drop("born"), {"competition": competition})
    found = anomalies.agg(F.coalesce(F.sum("anomalies"), F.lit(0))).first()[0]
    return Result(rows={"fantasy_points": points.count()}, anomalies={"points_without_stats": found})


@job
def ingest_prices(lake: Lake, competition: str, season: int, day: date) -> Result:
    """Today's price of each squad member as a row of the season's prices."""
    squad = lake.curated.read_partition("biwenger_players", {"competition": competition})
    rows = lake.curated.staged(squad.select(F.col("id").alias("player_id"), F.lit(day).alias("date"), "price"))
    lake.curated.upsert("biwenger_prices", rows, ["player_id", "date"], {"competition": competition, "season": str(season)})
    return Result(rows={"biwenger_prices": rows.count()})


def season_rounds(lake: Lake, competition: str, season: int) -> DataFrame | None:
    """(id) of the rounds that belong to a season and can be played; None if no round of it is known.

    Some round of the season is known from its stored points, or from the reports of its players. The catalogue in that round's payload, or the competition's own one if
    it lists that round, names the others: those finished or without a status, and no postponed copies. A known round that no catalogue lists is taken as it is.
    """
    stored = lake.curated.read_partition("fantasy_points", {"competition": competition, "season": str(season)})
    if stored is not None:
        seeds = stored.select(F.col("round_id").alias("id"))
    else:
        reports, _ = lake.payloads(FANTASY, "player-reports", "reports", f"{competition}-", strict=True, ends=f"-{season}")
        seeds = reports.select(F.explode("j.data.reports").alias("r")).select(F.col("r.match.round.id").alias("id"))
    seeds = lake.curated.staged(seeds.where("id is not null").distinct())
    if seeds.isEmpty():
        return None
    own, _ = lake.payloads(FANTASY, "rounds", "round", f"{competition}-", among=seeds.select(F.concat(F.lit(f"{competition}-"), F.col("id").cast("string"), F.lit("-score1"))))
    current, _ = lake.payloads(FANTASY, "competition-data", "competition", among={competition})
    listed = own.select("j.data.season.rounds").union(current.select("j.data.season.rounds")).where("rounds is not null").distinct()
    catalogues = lake.curated.staged(listed.withColumn("catalogue", F.monotonically_increasing_id()).select("catalogue", F.explode("rounds").alias("r")).select("catalogue", "r.*"))
    ours = catalogues.join(catalogues.join(seeds, "id", "left_semi").select("catalogue").distinct(), "catalogue", "left_semi")
    alone = algebra.without_keys(seeds, ours.select("id"), ["id"])
    return lake.curated.staged(flatten.playable(ours).select("id").union(alone.select("id")).distinct())


@job
def ingest_rounds(lake: Lake, competition: str, season: int, resume: bool = False) -> Result:
    """Points of a season's rounds over all scoring systems; identities are stored before points, so a crash leaves no nameless points.

    ``season_rounds`` says which rounds these are; payloads of others are not parsed. With ``resume`` rounds that are stored already are left alone.
    """
    where, rounds = {"competition": competition, "season": str(season)}, season_rounds(lake, competition, season)
    if rounds is None:
        return Result(failures=[f"no report of {competition} {season} names a round"])
    done = lake.curated.read_partition("fantasy_round_points", where) if resume else None
    todo = lake.curated.staged(algebra.without_keys(rounds, done.select(F.col("round_id").alias("id")).distinct(), ["id"])) if done is not None else rounds
    skipped = rounds.count() - todo.count()
    files = todo.select(F.explode(F.array(*[F.concat(F.lit(f"{competition}-"), F.col("id").cast("string"), F.lit(f"-score{k}")) for k in flatten.POINT_SYSTEMS])))
    good, _ = lake.payloads(FANTASY, "rounds", "round", f"{competition}-", strict=True, among=files)
    sides = lake.curated.staged(flatten.round_sides(good.where(~flatten.is_postponed(F.col("j.data.name")))))
    players, teams = flatten.round_identities(sides)
    lake.curated.upsert("biwenger_players_history", players, ["id"], where)
    lake.curated.upsert("biwenger_teams_history", teams, ["id"], where)
    points = lake.curated.staged(flatten.round_points(sides))
    lake.curated.upsert("fantasy_round_points", points, ["round_id"], where)
    return Result(rows={"fantasy_round_points": points.count()}, stats={"rounds_skipped": skipped} if resume else {})


@job
def ingest_valuation(lake: Lake, competition: str) -> Result:
    """Market values, transfers, availability and injuries of the members of a competition's squads; a player's history lives in one partition.

    Who is in no squad of the competition stays where they are. A member who was stored elsewhere, on demand for instance, moves here.
    """
    where, result = {"competition": competition}, Result()
    squads = lake.curated.read_tolerant("transfermarkt_players", {"id": "string", "competition": "string"}).where(F.col("competition") == competition)
    members = lake.curated.staged(squads.where("id is not null").select("id").distinct())
    if members.isEmpty():
        return Result(failures=[f"no squad of {competition} is stored"])
    for table, dataset, contract, rows in HISTORIES:
        good, _ = lake.payloads(VALUATION, dataset, contract, strict=True, among=members)
        found = lake.curated.staged(rows(good))
        lake.curated.upsert_unique_partition(table, found, ["player_id"], where)
        result.add(table, found.count())
    pages = lake.raw.latest(VALUATION, "injuries", "html", among=members.select(F.concat(F.lit("spieler-"), "id"))).select(F.col("name").alias("page"), F.col("payload").alias("html"))
    hurt = lake.curated.staged(injuries(html.parse_pages(pages, "injuries")))
    lake.curated.upsert_unique_partition("injuries_tm", hurt, ["player_id"], where)
    result.add("injuries_tm", hurt.count())
    return result


def injuries(parsed: DataFrame) -> DataFrame:
    """Rows of parsed injury pages; the player is the number in the page's name."""
    return parsed.where("error is null").select(
        S.leading_int(F.col("page")).alias("player_id"), "season", "injury", S.slash_date(F.col("from_date")).alias("from_date"), S.slash_date(F.col("until_date")).alias("until_date"), "days", "games_missed"
    )


@job
def ingest_squads(lake: Lake, competition: str, season: int, max_clubs: int | None = None) -> Result:
    """transfermarkt_players of a season: clubs of the competition page, members of their squad pages, names and births of the profiles.

    A club without a readable squad page and a member without a readable profile are failures of the crawl: such a member is not
    stored anew and, having been seen, not retired either. Who is in no squad any more is retired, but only after a crawl of
    all clubs whose squads could all be read. ``max_clubs`` caps a first trial; the first clubs by id are taken.
    """
    pages = lambda dataset, named: lake.raw.latest(VALUATION, dataset, "html", named).select(F.col("name").alias("page"), F.col("payload").alias("html"))
    stage, code = lake.curated.staged, COMPETITION_CODES.get(competition, competition)
    parsed_clubs = html.parse_pages(pages("competition-clubs", f"{code}-saison-{season}"), "competition-clubs")
    clubs = stage(parsed_clubs.where("error is null").select("club_id", "club_name"))
    if max_clubs is not None:
        clubs = stage(algebra.capped(clubs, [F.col("club_id")], max_clubs)[0])
    squads = html.parse_pages(pages("kader", "verein-").where(F.endswith("page", F.lit(f"-saison-{season}"))), "kader").withColumn("club_id", S.leading_int(F.col("page")))
    members = stage(clubs.join(squads, "club_id", "left"))
    profiles = html.parse_pages(pages("profile", "spieler-"), "profile").withColumn("profile", S.leading_int(F.col("page"))).where("error is null")
    profiles = profiles.select("profile", F.col("name").alias("full_name"), S.slash_date(F.col("birth_date")).alias("birth_date"), F.col("position").alias("full_position"))
    seen = stage(members.where("player_id is not null").join(profiles, F.col("player_id") == F.col("profile"), "left"))
    rows = seen.where("profile is not null").select(
        F.col("player_id").alias("id"), "slug", F.coalesce(F.nullif("full_name", F.lit("")), "name").alias("name"), "birth_date", F.coalesce("full_position", "position").alias("position"), "shirt_number", "club_id", "club_name"
    )
    rows = stage(algebra.latest_per_key(rows, ["id"], [F.col("club_id")]))
    where = {"competition": competition, "season": str(season)}
    if not rows.isEmpty():
        lake.curated.upsert("transfermarkt_players", rows, ["id"], where)
    unread = sorted(r.club_id for r in members.where("player_id is null").select("club_id").distinct().collect())  # clubs of one competition
    bare = seen.where("profile is null").select("player_id").distinct().count()
    keep = analytics.prunable(seen.select(F.col("player_id").alias("id")).distinct(), seen.select(F.col("player_id").alias("id")), max_clubs is None and not unread and not clubs.isEmpty())
    gone = lake.curated.retain_keys("transfermarkt_players", keep, ["id"], where) if keep is not None else 0
    result = Result(rows={"transfermarkt_players": rows.count()}, stats={"retired": gone}, anomalies={"clubs_without_squad": len(unread), "players_without_profile": bare})
    if clubs.isEmpty():
        result.failures.append(f"no page of clubs of {competition} {season}")
    return result


@job
def ingest_player(lake: Lake, query: str, competition: str = ON_DEMAND, force: bool = False) -> Result:
    """The whole history of one player, named by an id, a profile link or a canonical id, in a partition of its own unless ``competition`` names another.

    The birth date of the profile is held against the one that the player's own source tells; where both are known and differ,
    nothing is stored unless ``force`` says so.
    """
    players = lake.mappings.load("players")
    asked = lake.spark.createDataFrame([(query,)], "query string")
    player = resolve.named_player(asked, players, VALUATION).first().id
    if player is None:
        return Result(failures=[f"{query} names no player of {VALUATION}"])
    pages = lambda dataset: lake.raw.latest(VALUATION, dataset, "html", among={f"spieler-{player}"}).select(F.col("name").alias("page"), F.col("payload").alias("html"))
    profile = html.parse_pages(pages("profile"), "profile").where("error is null").select(F.lit(player).alias("id"), S.slash_date(F.col("birth_date")).alias("birth_date"))
    born = {"id": "string", "birth_date": "string"}
    births = lake.curated.read_tolerant("biwenger_players", born).unionByName(lake.curated.read_tolerant("biwenger_players_history", born))
    row = resolve.safe_identity(profile, players, births, VALUATION, FANTASY).first()
    if row is None:
        return Result(failures=[f"no profile of {player}"])
    if row.outcome == "differs" and not force:
        return Result(failures=[f"the birth date of {player} differs from the one of its own source"])
    result, where = Result(stats={"identity_" + row.outcome: 1}), {"competition": competition}
    tables = [(t, r(lake.payloads(VALUATION, d, c, strict=True, among={player})[0])) for t, d, c, r in HISTORIES]
    for table, rows in [*tables, ("injuries_tm", injuries(html.parse_pages(pages("injuries"), "injuries")))]:
        rows = lake.curated.staged(rows)
        lake.curated.upsert_unique_partition(table, rows, ["player_id"], where)
        result.add(table, rows.count())
    return result


def found_player(lake: Lake, query: str) -> tuple[str | None, list[str]]:
    """(id, failures) of a player of the event source: a canonical id, an id in digits, or a name.

    A name is looked for among the stored results of its search; only football players with a compatible name count, and
    there must be exactly one.
    """
    players = lake.mappings.load("players")
    named = resolve.named_player(lake.spark.createDataFrame([(query,)], "query string"), players, EVENTS).first().id
    if named is not None:
        return named, []
    if re.fullmatch(r"p\d+", query):
        return None, [f"{query} has no mapping to {EVENTS}"]
    slug = lake.spark.range(1).select(S.slug(F.lit(query)).alias("slug")).first().slug
    good, _ = lake.payloads(EVENTS, "search", "search", slug)
    hits = flatten.search_hits(good).where((F.col("query_id") == slug) & (F.col("kind") == "player") & (F.col("sport") == "football"))
    fits = hits.where(S.compatible(S.name_tokens(F.lit(query)), S.name_tokens(F.col("found_name"))))
    rows = fits.select("right_id", "found_name").distinct().orderBy("right_id").limit(20).collect()
    if len(rows) == 1:
        return str(rows[0].right_id), []
    return None, [f"{query}: no player of that name"] if not rows else [f"{query}: several candidates, name one by its id"] + [f"{r.right_id}: {r.found_name}" for r in rows]


@job
def ingest_season_stats(lake: Lake, query: str) -> Result:
    """Season aggregates and rated matches of one player of the event source, over all tournaments and seasons it played; ``found_player`` says how it may be named.

    Aggregates keep an open set of metrics, numbers only, as a map column; a rated match without a detail keeps its rating, its metrics null.
    """
    player, failures = found_player(lake, query)
    if player is None:
        return Result(failures=failures)
    players = approved(lake.mappings.load("players"), EVENTS)
    good, broken = lake.payloads(EVENTS, "player-seasons", "seasons", among={player})
    seasons = flatten.tournament_seasons(good)
    named = seasons.withColumn("file", F.concat_ws("-", F.lit(player), F.col("tournament_id").cast("string"), F.col("season_id").cast("string")))
    overall, more = lake.payloads(EVENTS, "player-overall", "overall", f"{player}-")
    metrics = flatten.season_metrics(overall).groupBy("name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("metrics"))
    stamp = lambda df: algebra.lookup(df.withColumn("id_text", F.lit(player)), players, "id_text", "id_en_fuente", "canonical_id", "").drop("id_text")
    common = [F.lit(player).cast("long").alias("sofascore_player_id"), "season_year", F.lit(EVENTS).alias("source"), F.col("tournament_id").cast("string").alias("competition"), F.col("season_id").cast("string").alias("season")]
    # an aggregate without a single metric still is a row
    there = overall.select("name").join(metrics, "name", "left")
    rows = lake.curated.staged(stamp(named.join(there, F.col("file") == F.col("name")).select(*common, "metrics")))
    rated, worse = lake.payloads(EVENTS, "player-ratings", "ratings", f"{player}-")
    details, worst = lake.payloads(EVENTS, "event-player-stats", "overall", ends=f"-{player}")
    detail = details.select(F.split_part("name", F.lit("-"), F.lit(1)).try_cast("long").alias("event"), F.col("j.statistics").alias("statistics"))
    matches = flatten.rated_matches(rated).join(named.select("file", "season_year", "tournament_id", "season_id"), F.col("name") == F.col("file")).join(detail, F.col("event_id") == F.col("event"), "left")
    told = matches.select(S.player_event(F.lit(player), F.col("event_id")).alias("player_event"), *common, "event_id", "date", "opponent", "opponent_id", "is_home", "rating", *[c.alias(n) for n, c in flatten.match_metrics(F.col("statistics")).items()])
    told = lake.curated.staged(stamp(told))
    result = Result(rows={"player_season_stats": rows.count(), "player_match_stats": told.count()}, anomalies={"broken_payloads": broken + more + worse + worst})
    for table, found, key in (("player_season_stats", rows, "sofascore_player_id"), ("player_match_stats", told, "player_event")):
        for part in found.select("competition", "season").distinct().collect():  # seasons of one player
            where = part.asDict()
            lake.curated.upsert(table, found.where((F.col("competition") == where["competition"]) & (F.col("season") == where["season"])), [key], where)
    return result


@job
def ingest_reports_delta(lake: Lake, competition: str, season: int) -> Result:
    """Points of those who scored in finished rounds that are not stored yet; prices are left to the daily snapshot.

    The stored round ids are the marker of what is done, so a second run with nothing new reads no report. Only payloads of the pending rounds and
    reports of squad members who scored in them are parsed; reports are named by competition, slug and season.
    """
    where = {"competition": competition, "season": str(season)}
    data, _ = lake.payloads(FANTASY, "competition-data", "competition", competition, strict=True)
    squad = lake.curated.staged(flatten.squad(data).select("id", "slug").dropDuplicates(["id"]))
    stored = lake.curated.read_partition("fantasy_points", where)
    done = stored.select("round_id").distinct() if stored is not None else lake.spark.createDataFrame([], "round_id long")
    pending = lake.curated.staged(flatten.pending_rounds(flatten.playable_rounds(data), done))
    members = squad.count()
    if pending.isEmpty():
        return Result(rows={"fantasy_points": 0}, stats={"refreshed": 0, "skipped": members})
    rounds, _ = lake.payloads(FANTASY, "rounds", "round", strict=True, among=pending.select(F.concat(F.lit(f"{competition}-"), F.col("id").cast("string"), F.lit("-score1"))))
    scorers = flatten.scoring_players(flatten.round_sides(rounds.where("j.data.scoreID = 1")).join(pending.select(F.col("id").alias("round_id")), "round_id", "left_semi"))
    wanted = lake.curated.staged(scorers.withColumn("inside", F.lit(True)).join(squad.withColumnRenamed("id", "player_id").withColumn("member", F.lit(True)), "player_id", "full_outer"))
    both = wanted.where("inside and member")
    files = both.where("slug is not null").select(F.concat(F.lit(f"{competition}-"), F.col("slug"), F.lit(f"-{season}")))
    reports, _ = lake.payloads(FANTASY, "player-reports", "reports", strict=True, among=files)
    chosen = reports.join(both.select("player_id"), F.col("j.data.id") == F.col("player_id"), "left_semi")
    points, anomalies = flatten.fantasy_points(chosen)
    points = lake.curated.staged(points)
    lake.curated.upsert("fantasy_points", points, ["player_id"], where)
    told = wanted.agg(F.count_if(F.col("inside") & F.col("member")).alias("refreshed"), F.count_if(F.col("inside") & F.col("member").isNull()).alias("outside_squad")).first()
    missing = anomalies.agg(F.coalesce(F.sum("anomalies"), F.lit(0))).first()[0]
    return Result(rows={"fantasy_points": points.count()}, stats={"refreshed": told.refreshed, "skipped": members - told.refreshed, "outside_squad": told.outside_squad}, anomalies={"points_without_stats": missing})


@job
def ingest_squad_values(lake: Lake, competition: str, season: int, day: date) -> Result:
    """The value of each club of a season, with its canonical id."""
    pages = lake.raw.latest(VALUATION, "competition-clubs", "html").where(F.endswith("name", F.lit(f"-saison-{season}")))
    parsed = lake.curated.staged(html.parse_pages(pages.select(F.col("name").alias("page"), F.col("payload").alias("html")), "competition-clubs"))
    broken = parsed.where("error is not null").count()
    clubs = parsed.where("error is null").withColumn("club", F.col("club_id").cast("string"))
    stamped = algebra.lookup(clubs, approved(lake.mappings.load("teams"), VALUATION), "club", "id_en_fuente", "canonical_id", "")
    rows = lake.curated.staged(stamped.select("club_id", "club_name", "squad_value", F.col("canonical_id").alias("canonical_team_id"), F.lit(day).alias("capture_date")))
    lake.curated.write_table("squad_values", rows, {"competition": competition, "season": str(season)})
    return Result(rows={"squad_values": rows.count()}, failures=[f"{broken} pages without clubs"] if broken else [])


def _competition(tournament: str):
    names = F.create_map(*[x for name, number in TOURNAMENTS.items() for x in (F.lit(number), F.lit(name))])
    return names[F.col(tournament).cast("int")]


def _entries(lake: Lake, calendar: str, sheets: str) -> tuple[DataFrame, DataFrame, int]:
    good, broken = lake.payloads(EVENTS, calendar, "events")
    events = flatten.finished_events(good).withColumn("competition", _competition("tournament_id")).where("competition is not null and season is not null")
    found, more = lake.payloads(EVENTS, sheets, "lineups")
    return events, flatten.lineup_entries(found, events), broken + more


@job
def curate_catalog(lake: Lake) -> Result:
    """Players and teams of every line-up by competition and season."""
    _, entries, broken = _entries(lake, "tournament-events", "event-lineups")
    players, teams = (lake.curated.staged(x) for x in analytics.identity_catalog(lake.curated.staged(entries.drop("statistics")), _competition("tournament_id")))
    lake.curated.write_partitioned("sofascore_players", players.withColumnRenamed("source_player_id", "sofascore_player_id"), ["competition", "season"])
    lake.curated.write_partitioned("sofascore_teams", teams, ["competition", "season"])
    return Result(rows={"sofascore_players": players.count(), "sofascore_teams": teams.count()}, anomalies={"broken_payloads": broken})


@job
def curate_matches(lake: Lake) -> Result:
    """player_match_stats anew from raw line-ups; partitions keep the source's own numbers."""
    _, entries, broken = _entries(lake, "tournament-events", "event-lineups")
    stats = flatten.match_stats(entries, approved(lake.mappings.load("players"), EVENTS), EVENTS).withColumnRenamed("source_player_id", "sofascore_player_id")
    parts = lake.curated.staged(stats.withColumn("competition", F.col("tournament_id").cast("string")).withColumn("season", F.col("season_id").cast("string")).drop("tournament_id", "season_id"))
    lake.curated.write_partitioned("player_match_stats", parts, ["competition", "season"])
    return Result(rows={"player_match_stats": parts.count()}, anomalies={"broken_payloads": broken, "unmapped": parts.where("canonical_id = ''").select("sofascore_player_id").distinct().count()})


@job
def curate_cups(lake: Lake) -> Result:
    """Fixtures of tracked teams in any competition, and their players' cup minutes."""
    league, _, a = _entries(lake, "tournament-events", "event-lineups")
    cups, entries, b = _entries(lake, "cup-events", "cup-lineups")
    teams = lake.curated.read_tolerant("sofascore_teams", {"team_id": "long", "competition": "string", "season": "string"}).where(F.col("competition") == TRACKED_LEAGUE).select("team_id", "season")
    keep = ["event_id", "date", "home_team_id", "home_team_name", "away_team_id", "away_team_name", "competition", "season"]
    matches = lake.curated.staged(analytics.fixtures(league.select(*keep), cups.select(*keep), teams))
    lake.curated.write_partitioned("fixtures", matches, ["competition", "season"])
    played = flatten.played(entries)
    minutes = analytics.cup_minutes(played, teams, approved(lake.mappings.load("players"), EVENTS)).withColumnRenamed("source_player_id", "sofascore_player_id").join(cups.select("event_id", "competition"), "event_id")
    minutes = lake.curated.staged(minutes)
    lake.curated.write_partitioned("cup_minutes", minutes, ["competition", "season"])
    return Result(rows={"fixtures": matches.count(), "cup_minutes": minutes.count()}, anomalies={"broken_payloads": a + b})


def pending_matches(lake: Lake, calendar: str, sheets: str, limit: int | None = None) -> tuple[DataFrame, int]:
    """(event_id, date, tournament_id, season) of finished matches without a stored line-up, oldest first, and how many a limit defers.

    The limit counts what is still to be fetched, not what is there, so each run of a capped backfill gets further.
    """
    good, _ = lake.payloads(EVENTS, calendar, "events")
    events = flatten.finished_events(good).select("event_id", "date", "tournament_id", "season", F.col("event_id").cast("string").alias("name"))
    pending = lake.raw.stale(events, EVENTS, sheets, None, date.today()).drop("name")
    if limit is None:
        return pending, 0
    first, deferred = algebra.capped(pending, [F.col("date"), F.col("event_id")], limit)
    return first, deferred.first().deferred


@job
def plan_backfill(lake: Lake, cups: bool = False, limit: int | None = None) -> Result:
    """What a backfill of line-ups has to fetch next; whoever fills the raw layer takes it from here."""
    found, deferred = pending_matches(lake, "cup-events" if cups else "tournament-events", "cup-lineups" if cups else "event-lineups", limit)
    found = lake.curated.staged(found)
    lake.curated.write_table("pending_matches", found, {"kind": "cups" if cups else "leagues"})
    return Result(rows={"pending_matches": found.count()}, stats={"deferred": deferred})


@job
def probe_report(lake: Lake, name: str) -> Result:
    """What the stored attempts of a probe say: how often each status came, the verdict, and how long it took.

    A payload has attempts with status and at, epoch seconds.
    """
    payload = lake.raw.read_latest("probe", "attempts", name)
    if payload is None:
        return Result(failures=[f"no attempts of {name}"])
    rows = lake.spark.createDataFrame([(payload,)], "payload string").select(F.explode(F.from_json("payload", "struct<attempts:array<struct<status:int,at:long>>>")["attempts"]).alias("a")).select("a.*")
    told = rows.agg(analytics.direct_access_verdict(F.collect_set("status")).alias("verdict"), S.duration_text(F.max("at") - F.min("at")).alias("took")).first()
    counts = analytics.status_histogram(rows, [], "status").orderBy("status").collect()
    return Result(stats={f"status {r.status}": r.n for r in counts} | {f"verdict {told.verdict}": 1, f"took {told.took}": 1}, failures=["blocked"] if told.verdict == "blocked" else [])


@job
def restamp(lake: Lake) -> Result:
    """Canonical ids anew in the three tables that carry them; only changed partitions are rewritten."""
    ids, result = approved(lake.mappings.load("players"), EVENTS), Result()
    for table in ("player_match_stats", "player_season_stats", "cup_minutes"):
        if lake.curated.exists(table):
            whole = lake.curated.read_table(table)
            texts = ids.withColumn("id_en_fuente", F.col("id_en_fuente").cast(whole.schema["sofascore_player_id"].dataType))
            result.add(table, lake.curated.restamp(table, texts, "sofascore_player_id", "id_en_fuente", ["competition", "season"]))
    return result


def cross_check_report(lake: Lake) -> tuple[dict, DataFrame]:
    """Minutes of the two sources by canonical id and date, in the competitions that both cover: the report and the discrepancies."""
    seen = {"canonical_id": "string", "date": "date", "minutes": "double", "source": "string", "competition": "string"}
    stats = analytics.comparable(lake.curated.read_tolerant("player_match_stats", seen), EVENTS, COVERED)
    own = lake.curated.read_tolerant("fantasy_points", {"player_id": "string", "date": "date", "minutes": "double"})
    mapped = own.join(approved(lake.mappings.load("players"), FANTASY), F.col("player_id") == F.col("id_en_fuente")).select("canonical_id", "date", "minutes")
    report, discrepancies = analytics.minutes_check(stats, mapped, ["canonical_id", "date"])
    return report.first().asDict(), discrepancies


@job
def crosscheck(lake: Lake, report_path: str | None = None) -> tuple[Result, DataFrame]:
    """Fails under the agreed share if there are common rows. With ``report_path`` the report is saved there as JSON, discrepancies and all, for people to read."""
    row, discrepancies = cross_check_report(lake)
    if report_path:
        listed = [{k: v.isoformat() if isinstance(v, date) else v for k, v in r.asDict().items()} for r in discrepancies.orderBy("canonical_id", "date").toLocalIterator()]
        os.makedirs(os.path.dirname(os.path.abspath(report_path)), exist_ok=True)
        with open(report_path, "w", encoding="utf-8") as file:
            json.dump(row | {"discrepancies": listed}, file, ensure_ascii=False, indent=2)
    failed = [f"{row['share']:.3f} of {row['common_rows']} rows agree"] if row["common_rows"] and not row["passed"] else []
    return Result(failures=failed, stats={k: row[k] for k in ("common_rows", "within_tolerance")}), discrepancies


@job
def detect_newcomers(lake: Lake, competition: str, season: int, day: date, limit: int | None = None) -> Result:
    """Newcomers of a squad with the state of their history; the first ``limit`` by id, the rest is deferred."""
    squad = lake.curated.read_tolerant("biwenger_players", {"id": "long", "name": "string", "team_id": "long", "competition": "string"}).where(F.col("competition") == competition)
    points = lake.curated.read_tolerant("fantasy_points", {"player_id": "long", "competition": "string", "season": "string"}).where(F.col("competition") == competition)
    stored = lake.curated.read_tolerant("newcomers", {"player_id": "long", "history": "string"})
    found = analytics.open_newcomers(analytics.newcomers(squad, points, season), stored)
    deferred = 0
    if limit is not None:
        found, rest = algebra.capped(found, [F.col("id")], limit)
        deferred = rest.first().deferred
    players = lake.mappings.load("players")
    known = algebra.lookup(found.withColumn("key", F.col("id").cast("string")), approved(players, FANTASY), "key", "id_en_fuente", "canonical_id", "")
    theirs = players.where(F.col("fuente") == EVENTS).select(F.col("canonical_id").alias("c"), F.col("id_en_fuente").alias("source_id"))
    history = lake.curated.read_tolerant("player_match_stats", {"canonical_id": "string"}).where("canonical_id <> ''").groupBy(F.col("canonical_id").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    joined = known.join(theirs, F.col("canonical_id") == F.col("c"), "left").join(history, F.col("canonical_id") == F.col("h"), "left")
    rows = joined.select(F.col("id").alias("player_id"), "name", "team_id", "canonical_id", analytics.newcomer_state(F.col("source_id"), F.col("canonical_id"), F.col("n"), F.lit(False)).alias("history"), F.lit(day).alias("detected_on"))
    rows = lake.curated.staged(rows)  # before the upsert changes the table that they come from
    lake.curated.upsert("newcomers", rows, ["player_id"], {"competition": competition, "season": str(season)})
    return Result(rows={"newcomers": rows.count()}, stats={"deferred": deferred})


def own_entities(lake: Lake, season: int) -> tuple[DataFrame, DataFrame]:
    """(players, teams) of the own source: the current squads and, of that season, those whom only rounds have seen. The squad wins: it is fresher and has births."""
    text = lambda *names: {n: "string" for n in names}
    out = []
    for table, columns in (("biwenger_players", text("id", "name", "team_id", "birth_date", "competition")), ("biwenger_teams", text("id", "name", "competition"))):
        now = lake.curated.read_tolerant(table, columns)
        past = lake.curated.read_tolerant(f"{table}_history", columns | {"season": "string"}).where(F.col("season") == str(season)).drop("season")
        out.append(algebra.current_plus_history(algebra.first_per_key(now, ["id"], [F.col("competition")]), algebra.first_per_key(past, ["id"], [F.col("competition")]), ["id"]))
    return out[0], out[1]


def team_review(judged: DataFrame, rivals: DataFrame, left: DataFrame, right: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Review rows of teams: one for each candidate, or one without."""
    own = left.select(F.col("id").alias("left_id"), F.col("name").alias("own_name"), "competition")
    theirs = right.select(F.col("id").alias("right_id"), F.col("name").alias("their_name")).dropDuplicates(["right_id"])
    rows = judged.select("left_id", "motivo").join(rivals, "left_id", "left").join(own, "left_id").join(theirs, "right_id", "left")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.select(F.col("left_id").alias("biwenger_id"), text("own_name").alias("biwenger_name"), text("competition").alias("competition"), text("right_id").alias(id_column), text("their_name").alias(name_column), "motivo", F.lit("").alias("decision"))


@job
def map_entities(lake: Lake, season: int, today: str) -> Result:
    """Decisions that people took, then teams, then players of the valuation source; review rows are written anew with what people decided."""
    stage = lake.curated.staged
    teams, players = lake.mappings.load("teams"), lake.mappings.load("players")
    squad, own_teams = own_entities(lake, season)
    other = lake.curated.read_tolerant("transfermarkt_players", {"id": "string", "name": "string", "club_id": "string", "club_name": "string", "birth_date": "string", "position": "string", "competition": "string", "season": "string"})
    now = other.where(F.col("season") == str(season))

    def added(mapping, pairs, prefix, digits, method):
        """``mapping`` with new entities for (left_id, right_id or null)."""
        new = resolve.numbered(pairs, mapping, prefix, digits, ["left_id"], stage)
        both = new.select("canonical_id", F.explode(F.filter(F.array(F.struct(F.lit(FANTASY).alias("fuente"), F.col("left_id").alias("id_en_fuente")), F.struct(F.lit(VALUATION).alias("fuente"), F.col("right_id").alias("id_en_fuente"))), lambda s: s["id_en_fuente"].isNotNull())).alias("s"))
        return stage(mapping.unionByName(both.select("canonical_id", "s.*", F.lit(method).alias("metodo"), F.lit(today).alias("fecha"))))

    def free(df, mapping, source):
        return df.join(approved(mapping, source).select(F.col("id_en_fuente").alias("id")), "id", "left_anti")

    clubs = algebra.first_per_key(now.where("club_id is not null").select(F.col("club_id").alias("id"), F.col("club_name").alias("name"), "competition"), ["id", "competition"], [F.col("name")])
    tokened = lambda df, words: df.withColumn("tokens", S.tokens(S.normalize(F.col("name")), words))
    old_teams = lake.mappings.load("teams-review")
    marked = old_teams.select(F.col("biwenger_id").alias("left_id"), F.col("tm_club_id").alias("right_id"), "decision").join(approved(teams, FANTASY).select(F.col("id_en_fuente").alias("left_id")), "left_id", "left_anti")
    team_actions, team_problems = resolve.classify_decisions(marked, approved(teams, VALUATION).select(F.col("id_en_fuente").alias("right_id")), allow_id=False)
    unapplied = team_problems.count()
    teams = added(teams, team_actions.select("left_id", "right_id"), "t", 3, "manual")
    left_teams, right_teams = stage(tokened(free(own_teams, teams, FANTASY), S.CLUB_WORDS)), stage(tokened(free(clubs, teams, VALUATION), S.CLUB_WORDS))
    judged, rivals = resolve.team_verdicts(left_teams, right_teams, stage)
    judged = stage(judged)
    teams = added(teams, judged.where("motivo = ''").select("left_id", "right_id"), "t", 3, "auto")
    team_rows = team_review(judged.where("motivo <> ''"), rivals, left_teams, right_teams, "tm_club_id", "tm_club_name")
    team_rows = resolve.preserve_decisions(team_rows, old_teams, approved(teams, FANTASY).select(F.col("id_en_fuente").alias("id")), ["biwenger_id", "tm_club_id"], "biwenger_id")

    old = lake.mappings.load("players-review")
    review = old.select(F.col("biwenger_id").alias("left_id"), F.col("tm_id").alias("right_id"), "decision").join(approved(players, FANTASY).select(F.col("id_en_fuente").alias("left_id")), "left_id", "left_anti")
    actions, problems = resolve.classify_decisions(review, approved(players, VALUATION).select(F.col("id_en_fuente").alias("right_id")))
    players = added(players, actions.select("left_id", "right_id"), "p", 5, "manual")

    club_of = lambda df, key, source: algebra.lookup(df, approved(teams, source), key, "id_en_fuente", "canonical_id").withColumnRenamed("canonical_id", "club")
    left = tokened(club_of(free(squad, players, FANTASY), "team_id", FANTASY), S.NAME_PARTICLES)
    rest = free(other, players, VALUATION)
    in_club = tokened(club_of(rest.where(F.col("season") == str(season)), "club_id", VALUATION), S.NAME_PARTICLES).where("club is not null")
    pool = tokened(resolve.global_pool(rest), S.NAME_PARTICLES)
    left, in_club, pool = stage(left), stage(in_club), stage(pool)
    keep = ["id", "tokens", "birth_date", "club"]
    pairs = resolve.candidates(left.select(*keep), in_club.select(*keep), pool.select("id", "tokens", "birth_date", F.lit(None).cast("string").alias("club")), stage)
    verdicts, trimmed = (stage(df) for df in resolve.resolve(left.select("id", "birth_date"), pool.select("id", "birth_date"), stage(pairs)))
    players = added(players, verdicts.where("motivo = ''").select("left_id", "right_id"), "p", 5, "auto")
    open_rows = verdicts.where("motivo <> ''").select("left_id", "motivo").join(trimmed, "left_id", "left")
    told = open_rows.join(left.select(F.col("id").alias("left_id"), "name", "team_id", "birth_date"), "left_id").join(
        pool.select(F.col("id").alias("right_id"), F.col("name").alias("tm_name"), F.col("club_name").alias("tm_club"), F.col("birth_date").alias("tm_birth_date"), F.col("position").alias("tm_position")), "right_id", "left"
    )
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = told.select(
        F.col("left_id").alias("biwenger_id"), text("name").alias("biwenger_name"), text("team_id").alias("biwenger_team"), text("birth_date").alias("biwenger_birth_date"), text("right_id").alias("tm_id"),
        text("tm_name").alias("tm_name"), text("tm_club").alias("tm_club"), text("tm_birth_date").alias("tm_birth_date"), text("tm_position").alias("tm_position"), "motivo", F.lit("").alias("decision"),
    )
    rows = resolve.preserve_decisions(rows, old, approved(players, FANTASY).select(F.col("id_en_fuente").alias("id")), ["biwenger_id", "tm_id"], "biwenger_id")
    unapplied += problems.count()  # before the files that they come from are written
    lake.mappings.save({"teams": teams, "players": players, "players-review": rows, "teams-review": team_rows})
    report = analytics.mapping_report(squad, lake.mappings.load("players").where(F.col("fuente") == FANTASY).select(F.col("id_en_fuente").alias("id"), "metodo"), lake.mappings.load("players-review").select(F.col("biwenger_id").alias("left_id"))).first()
    waiting = analytics.dangling(approved(players, VALUATION).select(F.col("id_en_fuente").alias("id")), lake.curated.read_tolerant("market_values_tm", {"player_id": "string"}).select(F.col("player_id").alias("id"))).count()
    stats = {k: v for k, v in report.asDict().items() if isinstance(v, int)} | {"teams_in_review": team_rows.select("biwenger_id").distinct().count(), "without_history": waiting}
    return Result(stats=stats, anomalies={"unapplied_decisions": unapplied})


@job
def map_third(lake: Lake, season: int, today: str) -> Result:
    """Attaches the match-event source to entities that have a canonical id; it creates none.

    Decisions come first: a yes attaches, a skip goes to the negative registry, and either without a canonical id is told as a
    problem. Then teams and players whose only mutual candidate agrees are attached; without a candidate they stay pending.
    """
    stage, maps = lake.curated.staged, lake.mappings
    teams, players, skips, old = maps.load("teams"), maps.load("players"), maps.load("sofascore-skips"), maps.load("sofascore-review")
    text = lambda *names: {n: "string" for n in names}
    squad, own_teams = own_entities(lake, season)
    theirs = lake.curated.read_tolerant("sofascore_teams", text("team_id", "team_name", "competition", "season")).where(F.col("season") == str(season))
    seen = lake.curated.read_tolerant("sofascore_players", text("sofascore_player_id", "name", "birth_date", "team_id", "team_name", "season")).withColumnRenamed("sofascore_player_id", "id")
    tokened = lambda df, words: df.withColumn("tokens", S.tokens(S.normalize(F.col("name")), words))
    canonical = lambda mapping: approved(mapping, FANTASY).select(F.col("id_en_fuente").alias("left_id"), "canonical_id")
    taken = lambda mapping: approved(mapping, EVENTS).select(F.col("id_en_fuente").alias("id"))

    def attached(mapping, pairs, method):
        found = pairs.join(canonical(mapping), "left_id")
        rows = found.select("canonical_id", F.lit(EVENTS).alias("fuente"), F.col("right_id").alias("id_en_fuente"), F.lit(method).alias("metodo"), F.lit(today).alias("fecha"))
        return stage(mapping.unionByName(rows))

    def decided_by_people(review, mapping, column):
        """(mapping with what a yes attaches, skips with what a skip registers, how many decisions could not be applied); settled entities are not judged again."""
        settled_ids = canonical(mapping).join(approved(mapping, EVENTS).select("canonical_id").union(skips.select("canonical_id")).distinct(), "canonical_id").select("left_id")
        rows = review.select(F.col("biwenger_id").alias("left_id"), F.col(column).alias("right_id"), "decision").join(settled_ids, "left_id", "left_anti")
        actions, problems = (stage(x) for x in resolve.classify_decisions(rows, taken(mapping).withColumnRenamed("id", "right_id"), allow_id=False))
        homeless = actions.join(canonical(mapping), "left_id", "left_anti")
        named = review.select(F.col("biwenger_id").alias("left_id"), "biwenger_name").dropDuplicates(["left_id"])
        fresh = actions.where("action = 'skip'").join(canonical(mapping), "left_id").join(named, "left_id").select("canonical_id", "biwenger_name", F.lit(today).alias("fecha"))
        unapplied = problems.count() + homeless.count()
        return attached(mapping, actions.where("action = 'yes'").select("left_id", "right_id"), "manual"), stage(skips.unionByName(fresh).dropDuplicates(["canonical_id"])), unapplied

    old_teams = maps.load("sofascore-teams-review")
    teams, skips, unapplied = decided_by_people(old_teams, teams, "sofascore_team_id")
    left_teams = stage(tokened(resolve.attachable(own_teams, teams, FANTASY, EVENTS, skips), S.CLUB_WORDS))
    right_teams = stage(tokened(theirs.select(F.col("team_id").alias("id"), F.col("team_name").alias("name"), "competition").distinct().join(taken(teams), "id", "left_anti"), S.CLUB_WORDS))
    judged, rivals = resolve.team_verdicts(left_teams, right_teams, stage)
    judged = stage(judged)
    teams = attached(teams, judged.where("motivo = ''").select("left_id", "right_id"), "auto")
    # a team without a candidate is no doubt: the source covers only what was downloaded
    team_rows = team_review(judged.where((F.col("motivo") != "") & (F.col("motivo") != resolve.NOBODY)), rivals, left_teams, right_teams, "sofascore_team_id", "sofascore_team_name")
    done_teams = canonical(teams).join(approved(teams, EVENTS).select("canonical_id").union(skips.select("canonical_id")).distinct(), "canonical_id").select(F.col("left_id").alias("id"))
    team_rows = resolve.preserve_decisions(team_rows, old_teams, done_teams, ["biwenger_id", "sofascore_team_id"], "biwenger_id")

    players, skips, more = decided_by_people(old, players, "sofascore_id")

    club = lambda df, source: df.join(approved(teams, source).select(F.col("id_en_fuente").alias("team_id"), F.col("canonical_id").alias("club")), "team_id", "left")
    left = stage(tokened(club(resolve.attachable(squad, players, FANTASY, EVENTS, skips).drop("canonical_id"), FANTASY), S.NAME_PARTICLES))
    rest = stage(tokened(club(seen.join(taken(players), "id", "left_anti"), EVENTS), S.NAME_PARTICLES))
    keep = ["id", "tokens", "birth_date", "club"]
    pool = stage(resolve.global_pool(rest))
    pairs = stage(resolve.candidates(left.select(*keep), rest.where(F.col("season") == str(season)).where("club is not null").select(*keep).dropDuplicates(["id", "club"]), pool.select(*keep), stage))
    verdicts, trimmed = (stage(df) for df in resolve.resolve(left.select("id", "birth_date"), pool.select("id", "birth_date"), pairs))
    players = attached(players, verdicts.where("motivo = ''").select("left_id", "right_id"), "auto")
    waiting = verdicts.where((F.col("motivo") != "") & (F.col("motivo") != resolve.NOBODY)).select("left_id", "motivo").join(trimmed, "left_id")
    shown = waiting.join(left.select(F.col("id").alias("left_id"), "name", "team_id", "birth_date"), "left_id").join(pool.select(F.col("id").alias("right_id"), F.col("name").alias("n"), "team_name", F.col("birth_date").alias("b")), "right_id")
    known = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = shown.select(
        F.col("left_id").alias("biwenger_id"), known("name").alias("biwenger_name"), known("team_id").alias("biwenger_team"), known("birth_date").alias("biwenger_birth_date"), F.col("right_id").alias("sofascore_id"),
        known("n").alias("sofascore_name"), known("team_name").alias("sofascore_team"), known("b").alias("sofascore_birth_date"), "motivo", F.lit("").alias("decision"),
    )
    done = approved(players, EVENTS).select("canonical_id").union(skips.select("canonical_id"))
    settled = canonical(players).join(done.distinct(), "canonical_id").select(F.col("left_id").alias("id"))
    rows = resolve.preserve_decisions(rows, old, settled, ["biwenger_id", "sofascore_id"], "biwenger_id")
    maps.save({"teams": teams, "players": players, "sofascore-review": rows, "sofascore-teams-review": team_rows, "sofascore-skips": skips})
    return Result(stats={"attached": verdicts.where("motivo = ''").count(), "pending": verdicts.where(F.col("motivo") == resolve.NOBODY).count()}, anomalies={"unapplied_decisions": unapplied + more})


def coverage(lake: Lake) -> DataFrame:
    """(kind, id, message) of own players and teams, current and past, and of event-source players with statistics, that have no mapping."""
    players, teams = lake.mappings.load("players"), lake.mappings.load("teams")
    ids = lambda table, column="id": lake.curated.read_tolerant(table, {column: "string"}).select(F.col(column).alias("id")).distinct()
    past = lambda table: algebra.without_keys(ids(f"{table}_history"), ids(table), ["id"])
    known = lambda mapping, source: approved(mapping, source).select(F.col("id_en_fuente").alias("id"))
    seen = ids("player_match_stats", "sofascore_player_id").union(ids("player_season_stats", "sofascore_player_id")).distinct()
    asked = [
        ("biwenger_teams", ids("biwenger_teams"), known(teams, FANTASY)),
        ("biwenger_players", ids("biwenger_players"), known(players, FANTASY)),
        ("biwenger_teams_history", past("biwenger_teams"), known(teams, FANTASY)),
        ("biwenger_players_history", past("biwenger_players"), known(players, FANTASY)),
        ("sofascore", seen.where("id <> ''"), known(players, EVENTS)),
    ]
    return functools.reduce(DataFrame.unionByName, [analytics.coverage_gaps(curated, mapped, kind) for kind, curated, mapped in asked])


@job
def check_coverage(lake: Lake) -> Result:
    """Curated ids without a mapping are failures; without curated tables there is nothing to check."""
    return Result(failures=[r.message for r in coverage(lake).orderBy("kind", "id").toLocalIterator()])


def run_incremental(lake: Lake, cycle: str, competition: str, season: int, day: date) -> Report:
    """The cycle after a round, or the weekly one. Each step reads what the raw layer has gained; nothing new costs nothing."""
    today = day.isoformat()
    cups = Step("cups", lambda: curate_cups(lake))
    cycles = {
        "round": [
            Step("squad", lambda: ingest_squad(lake, competition)),
            Step("delta", lambda: ingest_reports_delta(lake, competition, season)),
            Step("rounds", lambda: ingest_rounds(lake, competition, season)),
            Step("matches", lambda: curate_matches(lake)),
            Step("catalog", lambda: curate_catalog(lake)),
            cups,
        ],
        "weekly": [
            Step("squads", lambda: ingest_squads(lake, competition, season)),
            Step("valuation", lambda: ingest_valuation(lake, competition)),
            Step("catalog", lambda: curate_catalog(lake)),
            Step("map", lambda: map_entities(lake, season, today)),
            Step("map-third", lambda: map_third(lake, season, today)),
            Step("newcomers", lambda: detect_newcomers(lake, competition, season, day)),
            Step("canonical", lambda: restamp(lake)),
            Step("squad-values", lambda: ingest_squad_values(lake, competition, season, day)),
            Step("map-check", lambda: check_coverage(lake)),
        ],
    }
    return run_steps(cycles[cycle])


def run_season(lake: Lake, competition: str, season: int, day: date) -> Report:
    """A season's backfill from the raw layer, in order; identities come before what hangs on them."""
    today = day.isoformat()
    return run_steps(
        [
            Step("squad", lambda: ingest_squad(lake, competition)),
            Step("reports", lambda: ingest_reports(lake, competition, season)),
            Step("rounds", lambda: ingest_rounds(lake, competition, season)),
            Step("squads", lambda: ingest_squads(lake, competition, season)),
            Step("valuation", lambda: ingest_valuation(lake, competition)),
            Step("map", lambda: map_entities(lake, season, today)),
            Step("catalog", lambda: curate_catalog(lake)),
            Step("map-third", lambda: map_third(lake, season, today)),
            Step("matches", lambda: curate_matches(lake)),
            Step("canonical", lambda: restamp(lake)),
            Step("cups", lambda: curate_cups(lake)),
            Step("squad-values", lambda: ingest_squad_values(lake, competition, season, day)),
        ]
    )
