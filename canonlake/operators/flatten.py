"""Nested JSON payloads to rows. Payload frames have name, payload and what else the caller carries along.

``from_json`` gives null for a missing field, so contracts are explicit: a payload that lacks a required path goes to
the quarantine of ``parsed``, and callers fail on it (ingest) or count it (rebuild).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canonlake.functions import scalars as S
from canonlake.operators import algebra

# The scoring systems by their number in the payload.
POINT_SYSTEMS = {"1": "points_as", "2": "points_sofascore", "3": "points_stats", "5": "points_media", "6": "points_social"}
# Match metrics by their name in the payload. The source leaves out counts that are zero.
COUNTS = {
    "goals": "goals", "assists": "goalAssist", "shots": "totalShots", "shots_on_target": "onTargetScoringAttempt", "passes": "totalPass",
    "accurate_passes": "accuratePass", "key_passes": "keyPass", "crosses": "totalCross", "touches": "touches", "ball_recovery": "ballRecovery",
}
MEASURES = {"minutes": "minutesPlayed", "expected_goals": "expectedGoals", "expected_assists": "expectedAssists"}
# Keys of a season aggregate that are no metrics.
NO_METRICS = ["id", "statisticsType", "type"]
COACH = 5

REPORT = "struct<home:boolean,match:struct<id:long,date:long,round:struct<id:long,name:string>>,points:map<string,long>,rawStats:struct<minutesPlayed:long,sofascore:double,homeScore:long,awayScore:long,win:boolean,lost:boolean>>"
PLAYER = "struct<id:long,name:string,slug:string,teamID:long,position:int,status:string,price:long,priceIncrement:long,fantasyPrice:long,number:int,points:long,pointsHome:long,pointsAway:long,playedHome:long,playedAway:long,pointsLastSeason:long>"
SIDE = "struct<id:long,name:string,slug:string,score:long,reports:array<struct<player:struct<id:long,name:string,slug:string,position:int>,points:long>>>"
CLUB = "struct<id:long,name:string>"
ENTRY = "struct<player:struct<id:long,name:string,slug:string,dateOfBirthTimestamp:long>,teamId:long,position:string,substitute:boolean,statistics:map<string,variant>>"
MOVE = "struct<dateUnformatted:string,season:string,fee:string,marketValue:string,`from`:struct<clubName:string,href:string>,`to`:struct<clubName:string,href:string>>"
GAME = (
    "struct<gameInformation:struct<gameId:string,competitionId:string,seasonId:long,gameDay:string,date:struct<dateTimeUTC:string>>,"
    "clubsInformation:struct<club:struct<clubId:string>,opponent:struct<clubId:string>>,"
    "statistics:struct<generalStatistics:struct<participationState:string,primaryClubId:long,injuryId:string,absenceId:string>,"
    "playingTimeStatistics:struct<playedMinutes:long,isStarting:boolean,substitutedIn:struct<minute:long>,substitutedOut:struct<minute:long>>>>"
)
SCHEMAS = {
    "competition": f"struct<data:struct<id:long,season:struct<rounds:array<struct<id:long,name:string,status:string>>>,players:map<string,{PLAYER}>,teams:map<string,struct<id:long,name:string,slug:string>>>>",
    "reports": f"struct<data:struct<id:long,slug:string,birthday:long,reports:array<{REPORT}>,prices:array<array<long>>>>",
    "round": f"struct<data:struct<id:long,name:string,scoreID:int,season:struct<rounds:array<struct<id:long,name:string,status:string>>>,games:array<struct<id:long,date:long,status:string,home:{SIDE},away:{SIDE}>>>>",
    "seasons": "struct<uniqueTournamentSeasons:array<struct<uniqueTournament:struct<id:long,name:string>,seasons:array<struct<id:long,year:string,name:string>>>>>",
    "events": f"struct<events:array<struct<id:long,startTimestamp:long,status:struct<type:string>,homeTeam:{CLUB},awayTeam:{CLUB},tournament:struct<uniqueTournament:{CLUB}>,season:struct<id:long,year:string>>>,hasNextPage:boolean>",
    "lineups": f"struct<confirmed:boolean,home:struct<players:array<{ENTRY}>>,away:struct<players:array<{ENTRY}>>>",
    "overall": "struct<statistics:map<string,variant>>",
    "ratings": f"struct<seasonRatings:array<struct<eventId:long,startTimestamp:long,rating:double,isHome:boolean,opponent:{CLUB}>>>",
    "values": "struct<list:array<struct<y:long,datum_mw:string,verein:string>>>",
    "transfers": f"struct<transfers:array<{MOVE}>>",
    "performance": f"struct<data:struct<playerId:long,performance:array<{GAME}>>>",
    "search": "struct<results:array<struct<type:string,entity:struct<id:long,name:string,slug:string,team:struct<id:long,name:string,sport:struct<slug:string>>,position:string>>>>",
}
#: What must be there, or the payload breaks its contract.
REQUIRED = {
    "competition": ["j.data.players", "j.data.teams"], "reports": ["j.data.id", "j.data.reports"], "round": ["j.data.id", "j.data.games"], "seasons": ["j.uniqueTournamentSeasons"],
    "events": ["j.events"], "lineups": ["j.home.players", "j.away.players"], "overall": ["j.statistics"], "ratings": ["j.seasonRatings"], "values": ["j.list"],
    "transfers": ["j.transfers"], "performance": ["j.data.performance"], "search": ["j.results"],
}


def parsed(payloads: DataFrame, contract: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): the payload as ``j``, and the names of payloads that break the contract. Unknown fields are ignored."""
    read = payloads.withColumn("j", F.from_json("payload", SCHEMAS[contract])).drop("payload")
    whole = F.lit(True)
    for path in REQUIRED[contract]:
        whole = whole & F.col(path).isNotNull()
    return read.where(whole), read.where(~F.coalesce(whole, F.lit(False))).drop("j")


def squad(good: DataFrame) -> DataFrame:
    """Players of a competition payload without coaches; the object of objects becomes rows. The payload's own name is dropped."""
    rows = good.select(*[c for c in good.columns if c not in ("j", "name")], F.explode(F.map_values("j.data.players")).alias("p"))
    snake = {"teamID": "team_id", "priceIncrement": "price_increment", "fantasyPrice": "fantasy_price", "pointsHome": "points_home", "pointsAway": "points_away", "playedHome": "played_home", "playedAway": "played_away", "pointsLastSeason": "points_last_season"}
    flat = rows.select(*[c for c in rows.columns if c != "p"], "p.*")
    return flat.withColumnsRenamed(snake).where(~F.col("position").eqNullSafe(F.lit(COACH)))


def teams(good: DataFrame) -> DataFrame:
    rows = good.select(*[c for c in good.columns if c not in ("j", "name")], F.explode(F.map_values("j.data.teams")).alias("t"))
    return rows.select(*[c for c in rows.columns if c != "t"], "t.*")


def keep_birth_dates(fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
    """A refreshed squad with the birth dates that the stored one knows."""
    if stored is None or "birth_date" not in stored.columns:
        return fresh.withColumn("birth_date", F.lit(None).cast("date"))
    known = stored.where(F.col("birth_date").isNotNull()).groupBy("id").agg(F.max("birth_date").alias("birth_date"))
    return fresh.join(known, "id", "left")


def is_postponed(name: Column) -> Column:
    return F.coalesce(F.contains(F.lower(name), F.lit("postponed")), F.lit(False))


def playable_rounds(good: DataFrame) -> DataFrame:
    """Rounds that are finished or have no status, and are no postponed copy."""
    return playable(good.select(F.explode("j.data.season.rounds").alias("r")).select("r.*"))


def playable(rounds: DataFrame) -> DataFrame:
    return rounds.where((F.col("status").isNull() | (F.col("status") == "finished")) & ~is_postponed(F.col("name")))


def pending_rounds(rounds: DataFrame, points: DataFrame) -> DataFrame:
    """Finished rounds without stored points."""
    return rounds.where("status = 'finished'").join(points.select(F.col("round_id").alias("id")).distinct(), "id", "left_anti")


def fantasy_points(good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, anomalies): a row a scored report with five systems, minutes, grade and match date; points without statistics by player."""
    each = good.select(F.col("j.data.id").alias("player_id"), F.explode("j.data.reports").alias("r"))
    has_points, has_stats = F.col("r.points").isNotNull(), F.col("r.rawStats").isNotNull()
    rows = each.where(has_points & has_stats).select(
        "player_id",
        F.col("r.match.id").alias("match_id"),
        F.col("r.match.round.id").alias("round_id"),
        *[F.try_element_at("r.points", F.lit(k)).alias(c) for k, c in POINT_SYSTEMS.items()],
        F.col("r.rawStats.minutesPlayed").alias("minutes"),
        F.col("r.rawStats.sofascore").alias("sofascore_grade"),
        F.col("r.home").alias("home"),
        F.col("r.rawStats.homeScore").alias("home_score"),
        F.col("r.rawStats.awayScore").alias("away_score"),
        S.result_of_flags(F.col("r.rawStats.win"), F.col("r.rawStats.lost")).alias("result"),
        S.epoch_date(F.col("r.match.date")).alias("date"),
    )
    return rows, each.where(has_points & ~has_stats).groupBy("player_id").agg(F.count(F.lit(1)).alias("anomalies"))


def birth_dates(good: DataFrame) -> DataFrame:
    return good.select(F.col("j.data.id").alias("id"), S.long_packed_date(F.col("j.data.birthday")).alias("birth_date"))


def prices(good: DataFrame, season: int) -> DataFrame:
    """Player and day with a price, only days of the season; the payload's window ignores it."""
    rows = good.select(F.col("j.data.id").alias("player_id"), F.explode("j.data.prices").alias("p"))
    dated = rows.select("player_id", S.short_packed_date(F.col("p")[0]).alias("date"), F.col("p")[1].alias("price"))
    return dated.where(S.season_of(F.col("date")) == season)


def round_sides(good: DataFrame) -> DataFrame:
    """A row for each player's report in each payload of a round, both sides, with the payload's scoring system."""
    games = good.select(F.col("j.data.id").alias("round_id"), F.col("j.data.scoreID").cast("string").alias("system"), F.explode("j.data.games").alias("g"))
    both = F.array(F.struct(F.lit(True).alias("home"), F.col("g.home").alias("t"), F.col("g.away").alias("o")), F.struct(F.lit(False).alias("home"), F.col("g.away").alias("t"), F.col("g.home").alias("o")))
    sides = games.select("round_id", "system", "g.id", F.col("g.home.score").alias("home_score"), F.col("g.away.score").alias("away_score"), F.explode(both).alias("s"))
    return sides.select("round_id", "system", F.col("id").alias("match_id"), "home_score", "away_score", "s.home", "s.t.*", F.col("s.o.score").alias("other")).withColumnRenamed("id", "team_id")


def round_points(sides: DataFrame) -> DataFrame:
    """One row a player and match over all systems; each system fills its own column, match fields come from the lowest system that has them."""
    rows = sides.select("*", F.explode("reports").alias("r"))
    first = lambda c: F.min_by(c, F.col("system"))
    return rows.groupBy(F.col("r.player.id").alias("player_id"), "match_id").agg(
        first("team_id").alias("team_id"),
        first("round_id").alias("round_id"),
        *[F.max(F.when(F.col("system") == k, F.col("r.points"))).alias(c) for k, c in POINT_SYSTEMS.items()],
        first("home").alias("home"),
        first("home_score").alias("home_score"),
        first("away_score").alias("away_score"),
        first(S.result(F.col("score"), F.col("other"))).alias("result"),
    )


def round_identities(sides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(players, teams) seen in rounds, those who left included; the first sighting by system and match wins."""
    seen = sides.select("system", "match_id", "team_id", F.explode("reports").alias("r")).select("system", "match_id", "team_id", "r.player.*")
    players = algebra.first_per_key(seen.select("id", "name", "slug", "position", "team_id", "system", "match_id"), ["id"], [F.col("system"), F.col("match_id")]).drop("system", "match_id")
    clubs = algebra.first_per_key(sides.select(F.col("team_id").alias("id"), "name", "slug", "system", "match_id"), ["id"], [F.col("system"), F.col("match_id")]).drop("system", "match_id")
    return players, clubs


def scoring_players(sides: DataFrame) -> DataFrame:
    return sides.select(F.explode("reports.player.id").alias("player_id")).distinct()


def tournament_seasons(good: DataFrame) -> DataFrame:
    pairs = good.select(F.explode("j.uniqueTournamentSeasons").alias("t")).select(F.col("t.uniqueTournament.id").alias("tournament_id"), F.explode("t.seasons").alias("s"))
    return pairs.select("tournament_id", F.col("s.id").alias("season_id"), F.col("s.year").alias("season_year"))


def finished_events(good: DataFrame) -> DataFrame:
    """Finished matches with a tournament and a season, the last record of each id by file name."""
    each = good.select(F.col("name").alias("file"), F.explode("j.events").alias("e"))
    rows = each.where("e.status.type = 'finished' and e.tournament.uniqueTournament.id is not null and e.season.id is not null").select(
        F.col("e.id").alias("event_id"),
        S.epoch_date(F.col("e.startTimestamp")).alias("date"),
        F.col("e.homeTeam.id").alias("home_team_id"),
        F.col("e.homeTeam.name").alias("home_team_name"),
        F.col("e.awayTeam.id").alias("away_team_id"),
        F.col("e.awayTeam.name").alias("away_team_name"),
        F.col("e.tournament.uniqueTournament.id").alias("tournament_id"),
        F.col("e.season.id").alias("season_id"),
        F.col("e.season.year").alias("season_year"),
        S.season_start(F.col("e.season.year")).cast("string").alias("season"),
        "file",
    )
    return algebra.latest_per_key(rows, ["event_id"], [F.col("file")]).drop("file")


def lineup_entries(good: DataFrame, events: DataFrame) -> DataFrame:
    """Players of both sides with their match. The match is the file's name as a number; the team is the side's, not the player's own field."""
    sides = F.array(F.struct(F.lit(True).alias("is_home"), F.col("j.home.players").alias("players")), F.struct(F.lit(False).alias("is_home"), F.col("j.away.players").alias("players")))
    each = good.select(F.col("name").try_cast("long").alias("event_id"), F.explode(sides).alias("s")).where(F.col("event_id").isNotNull())
    rows = each.select("event_id", "s.is_home", F.explode("s.players").alias("p")).join(events, "event_id")
    own = lambda a, b: F.when(F.col("is_home"), F.col(a)).otherwise(F.col(b))
    return rows.select(
        "event_id", "date", "tournament_id", "season_id", "season_year", "season", "is_home",
        own("home_team_id", "away_team_id").alias("team_id"), own("home_team_name", "away_team_name").alias("team_name"),
        own("away_team_id", "home_team_id").alias("opponent_id"), own("away_team_name", "home_team_name").alias("opponent"),
        F.col("p.player.id").alias("source_player_id"), F.col("p.player.name").alias("name"), S.epoch_date(F.col("p.player.dateOfBirthTimestamp")).alias("birth_date"),
        S.is_starting(F.col("p.substitute")).alias("is_starting"), F.col("p.statistics").alias("statistics"),
    )


def played(entries: DataFrame) -> DataFrame:
    """Entries with a player id and any statistics."""
    return entries.where(F.col("source_player_id").isNotNull() & (F.coalesce(F.size(F.map_keys("statistics")), F.lit(0)) > 0))


def number(value: Column) -> Column:
    """A JSON number, or a boolean as 0 or 1; texts, also those of digits, objects and lists are null. The value is a variant, which keeps what it was."""
    kind = F.schema_of_variant(value)
    return F.when((kind == "BOOLEAN") | (kind == "BIGINT") | (kind == "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), F.try_variant_get(value, "$", "double"))


def match_metrics(statistics: Column) -> dict[str, Column]:
    """Counts that are missing are zero, measures that are missing are null, all are null without statistics."""
    found = {}
    for name, key in COUNTS.items():
        value = F.try_element_at(statistics, F.lit(key))
        found[name] = F.when(statistics.isNull(), F.lit(None)).when(F.array_contains(F.map_keys(statistics), key), number(value)).otherwise(F.lit(0.0)).cast("double")
    for name, key in MEASURES.items():
        found[name] = number(F.try_element_at(statistics, F.lit(key)))
    return found


def match_stats(entries: DataFrame, approved: DataFrame, source: str) -> DataFrame:
    """player_match_stats: a row a player who played, with the canonical id or ""."""
    rows = played(entries).withColumn("id_text", F.col("source_player_id").cast("string"))
    stamped = algebra.lookup(rows, approved, "id_text", "id_en_fuente", "canonical_id", "")
    return stamped.withColumns(match_metrics(F.col("statistics")) | {"player_event": S.player_event(F.col("source_player_id"), F.col("event_id")), "source": F.lit(source), "rating": number(F.try_element_at("statistics", F.lit("rating")))}).drop("statistics", "id_text", "name", "birth_date", "is_starting", "team_id", "team_name")


def season_metrics(good: DataFrame) -> DataFrame:
    """Long form (name, metric, value) of a season aggregate's numeric keys; the schema stays open, ``pivoted`` closes it on read."""
    each = good.select("name", F.explode("j.statistics").alias("metric", "v"))
    return each.where(~F.col("metric").isin(NO_METRICS)).select("name", "metric", number(F.col("v")).alias("value")).where("value is not null")


def rated_matches(good: DataFrame) -> DataFrame:
    """Rated matches of a player's season, with where and against whom."""
    rows = good.select("name", F.explode("j.seasonRatings").alias("r"))
    return rows.select("name", F.col("r.eventId").alias("event_id"), S.epoch_date(F.col("r.startTimestamp")).alias("date"), F.col("r.opponent.name").alias("opponent"), F.col("r.opponent.id").alias("opponent_id"), F.col("r.isHome").alias("is_home"), F.col("r.rating").alias("rating"))


def market_values(good: DataFrame) -> DataFrame:
    rows = good.select(F.col("name").try_cast("long").alias("player_id"), F.explode("j.list").alias("v"))
    return rows.select("player_id", S.slash_date(F.col("v.datum_mw")).alias("date"), F.col("v.y").alias("value"), F.col("v.verein").alias("club_name"))


def transfers(good: DataFrame) -> DataFrame:
    rows = good.select(F.col("name").try_cast("long").alias("player_id"), F.explode("j.transfers").alias("t"))
    return rows.select(
        "player_id", S.iso_date(F.col("t.dateUnformatted")).alias("date"), F.col("t.season").alias("season"), S.transfer_kind(F.col("t.fee")).alias("type"), F.col("t.fee").alias("fee"),
        F.col("t.marketValue").alias("market_value"), S.club_of_link(F.col("t.`from`.href")).alias("from_club_id"), F.col("t.`from`.clubName").alias("from_club_name"),
        S.club_of_link(F.col("t.`to`.href")).alias("to_club_id"), F.col("t.`to`.clubName").alias("to_club_name"),
    )


def availability(good: DataFrame) -> DataFrame:
    """Player and match over a whole career; the participation state is open text."""
    rows = good.select(F.col("name").try_cast("long").alias("player_id"), F.explode("j.data.performance").alias("g"))
    info, general, time = "g.gameInformation", "g.statistics.generalStatistics", "g.statistics.playingTimeStatistics"
    return rows.select(
        "player_id", F.col(f"{info}.gameId").alias("game_id"), S.iso_date(F.col(f"{info}.date.dateTimeUTC")).alias("date"), F.col(f"{info}.competitionId").alias("competition_id"),
        F.col(f"{info}.seasonId").alias("season_id"), F.col(f"{info}.gameDay").alias("game_day"), F.col(f"{general}.primaryClubId").alias("club_id"),
        S.int_or_null(F.col("g.clubsInformation.opponent.clubId")).alias("opponent_club_id"), F.col(f"{general}.participationState").alias("participation_state"),
        F.col(f"{time}.playedMinutes").alias("played_minutes"), F.col(f"{time}.isStarting").alias("is_starting"), F.col(f"{time}.substitutedIn.minute").alias("substituted_in_minute"),
        F.col(f"{time}.substitutedOut.minute").alias("substituted_out_minute"), F.col(f"{general}.injuryId").alias("injury_id"), F.col(f"{general}.absenceId").alias("absence_id"),
    )


def search_hits(good: DataFrame) -> DataFrame:
    rows = good.select(F.col("name").alias("query_id"), F.explode("j.results").alias("r"))
    return rows.select("query_id", F.col("r.type").alias("kind"), F.col("r.entity.id").alias("right_id"), F.col("r.entity.name").alias("found_name"), F.col("r.entity.team.sport.slug").alias("sport"))
