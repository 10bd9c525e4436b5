"""Queries that run payloads, pages, jobs and planned analytics over the driver tables, each with its SQL oracle.

Payloads and pages are made from the tables in the shapes that the sources have, then go through the same operators as those
that the raw layer holds; the oracles read the tables themselves.
"""

from __future__ import annotations

import json
import os
import tempfile
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.functions import scalars as S
from canonlake.operators import flatten, integrity, resolve
from canonlake.plans import analytics, jobs, neighbours
from canonlake.plans.orchestrator import Result, Step, run_steps
from canonlake.queries import PART_TEAMS, SEASON, part_teams, query, scratch, table
from canonlake.sources import html
from canonlake.sources.curated import CuratedStore
from canonlake.sources.mapping_csv import MappingStore
from canonlake.sources.raw import RawStore, base_uri
from canonlake.streaming import incremental

DAY = date(2024, 1, 10)


def good(rows: DataFrame, contract: str) -> DataFrame:
    """Parsed payloads of ``rows`` (name, payload)."""
    return flatten.parsed(rows, contract)[0]


def as_payload(rows: DataFrame, name, body) -> DataFrame:
    return rows.select(name.cast("string").alias("name"), F.to_json(body).alias("payload"))


def text(column: str):
    return F.col(column).cast("string")


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumns({"day": F.to_date("o_orderdate"), "at": F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))})


def a_folder(spark) -> str:
    """A folder for mapping files, which lie on the driver, where people would edit them: beside the query's own tables where these have a path, else a temporary one of the driver, which alone reads it."""
    shared = scratch(spark)
    folder = f"{shared.removeprefix('file://')}-mappings" if shared.startswith("file://") else tempfile.mkdtemp(prefix="canonlake-mappings-")
    os.makedirs(folder, exist_ok=True)
    return folder


def a_lake(spark) -> jobs.Lake:
    """An empty lake in a folder of its own."""
    return jobs.Lake(spark, scratch(spark), a_folder(spark))


# --- payloads to rows -----------------------------------------------------------------------------------------------


def competition_payload(spark, sf_dir) -> DataFrame:
    """A payload a nation: its customers as players, of whom position 5 is a coach, and itself as the team."""
    customers = table(spark, sf_dir, "customer")
    player = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lower("c_name").alias("slug"), F.col("c_nationkey").alias("teamID"), (F.col("c_custkey") % 6).cast("int").alias("position"), F.col("c_mktsegment").alias("status"), F.floor("c_acctbal").alias("price"))
    squads = customers.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct(text("c_custkey"), player))).alias("players"))
    team = F.struct(F.col("c_nationkey").alias("id"), F.concat(F.lit("Nation "), text("c_nationkey")).alias("name"), F.concat(F.lit("n-"), text("c_nationkey")).alias("slug"))
    return as_payload(squads, F.col("c_nationkey"), F.struct(F.struct("players", F.create_map(text("c_nationkey"), team).alias("teams")).alias("data")))


@query("squad_players", "SELECT c_custkey AS id, c_name AS name, lower(c_name) AS slug, c_nationkey::BIGINT AS team_id, (c_custkey % 6)::INT AS position, c_mktsegment AS status, floor(c_acctbal)::BIGINT AS price FROM customer WHERE c_custkey % 6 <> 5")
def squad_players(spark, sf_dir):
    return flatten.squad(good(competition_payload(spark, sf_dir), "competition")).select("id", "name", "slug", "team_id", "position", "status", "price")


@query("squad_teams", "SELECT DISTINCT c_nationkey::BIGINT AS id, 'Nation ' || c_nationkey AS name, 'n-' || c_nationkey AS slug FROM customer")
def squad_teams(spark, sf_dir):
    return flatten.teams(good(competition_payload(spark, sf_dir), "competition"))


@query("kept_birth_dates", "SELECT c_custkey AS id, max(o_orderdate)::DATE AS birth_date FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey")
def kept_birth_dates(spark, sf_dir):
    stored = orders(spark, sf_dir).select(F.col("o_custkey").alias("id"), F.when(F.col("o_orderstatus") == "F", F.col("day")).alias("birth_date"))
    return flatten.keep_birth_dates(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), stored)


def rounds_payload(spark, sf_dir) -> DataFrame:
    """One payload: a round a month, some postponed copies, finished, without a status, or pending."""
    months = orders(spark, sf_dir).select((F.year("day") * 100 + F.month("day")).cast("long").alias("id")).distinct()
    name = F.concat(F.lit("Round "), text("id"), F.when(F.col("id") % 4 == 0, " (Postponed)").otherwise(""))
    status = F.when(F.col("id") % 3 == 0, "finished").when(F.col("id") % 3 == 1, "pending")
    listed = months.select(F.struct("id", name.alias("name"), status.alias("status")).alias("r")).groupBy().agg(F.collect_list("r").alias("rounds"))
    none = F.from_json(F.lit("{}"), "map<string,string>")
    return as_payload(listed, F.lit("la-liga"), F.struct(F.struct(F.struct("rounds").alias("season"), none.alias("players"), none.alias("teams")).alias("data")))


MONTHS = "WITH m AS (SELECT DISTINCT (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS id FROM orders)"


@query("playable_rounds", MONTHS + " SELECT id, 'Round ' || id AS name, CASE WHEN id % 3 = 0 THEN 'finished' END AS status FROM m WHERE id % 3 <> 1 AND id % 4 <> 0")
def playable_rounds(spark, sf_dir):
    return flatten.playable_rounds(good(rounds_payload(spark, sf_dir), "competition"))


@query("pending_rounds", MONTHS + " SELECT id, 'Round ' || id AS name FROM m WHERE id % 3 = 0 AND id % 4 <> 0 AND id >= 199800")
def pending_rounds(spark, sf_dir):
    done = orders(spark, sf_dir).where("year(day) < 1998").select((F.year("day") * 100 + F.month("day")).cast("long").alias("round_id"))
    return flatten.pending_rounds(flatten.playable_rounds(good(rounds_payload(spark, sf_dir), "competition")), done).select("id", "name")


def reports_payload(spark, sf_dir) -> DataFrame:
    """A payload a customer: an order is a report; those with status P have no points, those of low priority no statistics."""
    k = F.col("o_orderkey")
    points = F.when(F.col("o_orderstatus") != "P", F.create_map(F.lit("1"), F.floor("o_totalprice"), F.lit("5"), k % 9))
    stats = F.when(F.col("o_orderpriority") != "5-LOW", F.struct((k % 91).alias("minutesPlayed"), ((k % 100) / 10).alias("sofascore"), (k % 4).alias("homeScore"), (k % 3).alias("awayScore"), (k % 3 == 0).alias("win"), (k % 3 == 1).alias("lost")))
    round_ = F.struct((F.year("day") * 100 + F.month("day")).cast("long").alias("id"), F.lit("r").alias("name"))
    report = F.struct((k % 2 == 0).alias("home"), F.struct(k.alias("id"), F.col("at").alias("date"), round_.alias("round")).alias("match"), points.alias("points"), stats.alias("rawStats"))
    price = F.array(((F.year("day") % 100) * 10000 + F.month("day") * 100 + F.dayofmonth("day")).cast("long"), F.floor("o_totalprice"))
    each = orders(spark, sf_dir).groupBy("o_custkey").agg(F.collect_list(report).alias("reports"), F.collect_list(price).alias("prices"))
    birthday = F.when(F.col("o_custkey") % 5 > 0, 19900100 + F.col("o_custkey") % 40)
    return as_payload(each, F.col("o_custkey"), F.struct(F.struct(F.col("o_custkey").alias("id"), birthday.alias("birthday"), "reports", "prices").alias("data")))


@query(
    "scored_reports",
    """
    SELECT o_custkey AS player_id, o_orderkey AS match_id, (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS round_id, floor(o_totalprice)::BIGINT AS points_as, (o_orderkey % 9)::BIGINT AS points_media, (o_orderkey % 91)::BIGINT AS minutes,
    (o_orderkey % 100) / 10 AS sofascore_grade, o_orderkey % 2 = 0 AS home, CASE o_orderkey % 3 WHEN 0 THEN 'win' WHEN 1 THEN 'loss' ELSE 'draw' END AS result, o_orderdate::DATE AS date
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
    """,
)
def scored_reports(spark, sf_dir):
    points, _ = flatten.fantasy_points(good(reports_payload(spark, sf_dir), "reports"))
    return points.select("player_id", "match_id", "round_id", "points_as", "points_media", "minutes", "sofascore_grade", "home", "result", "date")


@query("points_without_stats", "SELECT o_custkey AS player_id, count(*) AS anomalies FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' GROUP BY o_custkey")
def points_without_stats(spark, sf_dir):
    return flatten.fantasy_points(good(reports_payload(spark, sf_dir), "reports"))[1]


@query("birth_dates", "SELECT DISTINCT o_custkey AS id, CASE WHEN o_custkey % 5 > 0 AND o_custkey % 40 BETWEEN 1 AND 31 THEN make_date(1990, 1, (o_custkey % 40)::INT) END AS birth_date FROM orders")
def birth_dates(spark, sf_dir):
    return flatten.birth_dates(good(reports_payload(spark, sf_dir), "reports"))


@query(
    "season_prices",
    f"WITH p AS (SELECT o_custkey AS player_id, make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate)) AS date, floor(o_totalprice)::BIGINT AS price FROM orders) SELECT * FROM p WHERE {SEASON.format('date')} = 2097",
)
def season_prices(spark, sf_dir):
    return flatten.prices(good(reports_payload(spark, sf_dir), "reports"), 2097)


def sides(spark, sf_dir) -> DataFrame:
    """Reports of rounds in three scoring systems: an order is a game of its customer against one of fifty teams, a player on each side."""
    k = F.col("o_orderkey")
    who = lambda i: F.struct(i.alias("id"), F.concat(F.lit("P"), text("o_orderkey")).alias("name"), F.lit("p").alias("slug"), F.lit(1).alias("position"))
    points = lambda i: F.when((F.col("system") != 2) | (k % 5 > 0), (i + F.col("system")) % 12)
    side = lambda team, score, i: F.struct(team.alias("id"), F.concat(F.lit("T"), team.cast("string")).alias("name"), F.lit("t").alias("slug"), score.alias("score"), F.array(F.struct(who(i).alias("player"), points(i).alias("points"))).alias("reports"))
    home, away = side(F.col("o_custkey"), k % 4, F.col("o_custkey") * 10), side(1_000_000 + k % 50, k % 3, 10_000_000 + k % 500)
    each = orders(spark, sf_dir).withColumn("system", F.explode(F.array(*[F.lit(n) for n in (1, 2, 5)])))
    games = each.groupBy((F.year("day") * 100 + F.month("day")).cast("long").alias("round"), "system").agg(F.collect_list(F.struct(k.alias("id"), F.col("at").alias("date"), F.lit("finished").alias("status"), home.alias("home"), away.alias("away"))).alias("games"))
    body = F.struct(F.struct(F.col("round").alias("id"), F.lit("r").alias("name"), F.col("system").alias("scoreID"), "games").alias("data"))
    return flatten.round_sides(good(as_payload(games, F.concat_ws("-", text("round"), text("system")), body), "round"))


_SIDES = """
    WITH s AS (SELECT o_orderkey AS match_id, (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS round_id, (o_orderkey % 4)::BIGINT AS home_score, (o_orderkey % 3)::BIGINT AS away_score, x.* FROM orders,
    LATERAL (SELECT true AS home, o_custkey * 10 AS player_id, o_custkey AS team_id, o_orderkey % 4 AS own, o_orderkey % 3 AS other
    UNION ALL SELECT false, 10000000 + o_orderkey % 500, 1000000 + o_orderkey % 50, o_orderkey % 3, o_orderkey % 4) x)
"""


@query(
    "round_points",
    _SIDES
    + """
    SELECT player_id, match_id, team_id, round_id, (player_id + 1) % 12 AS points_as, CASE WHEN match_id % 5 > 0 THEN (player_id + 2) % 12 END AS points_sofascore, (player_id + 5) % 12 AS points_media, NULL::BIGINT AS points_stats,
    home, home_score, away_score, CASE WHEN own > other THEN 'win' WHEN own < other THEN 'loss' ELSE 'draw' END AS result FROM s
    """,
)
def round_points(spark, sf_dir):
    return flatten.round_points(sides(spark, sf_dir)).drop("points_social")


@query("round_identities", _SIDES + " SELECT 'player' AS kind, player_id AS id, 'P' || min(match_id) AS name, arg_min(team_id, match_id) AS team_id FROM s GROUP BY player_id UNION ALL SELECT DISTINCT 'team', team_id, 'T' || team_id, NULL FROM s")
def round_identities(spark, sf_dir):
    players, teams = flatten.round_identities(sides(spark, sf_dir))
    return players.select(F.lit("player").alias("kind"), "id", "name", "team_id").unionByName(teams.select(F.lit("team").alias("kind"), "id", "name", F.lit(None).cast("long").alias("team_id")))


@query("scoring_players", _SIDES + " SELECT DISTINCT player_id FROM s")
def scoring_players(spark, sf_dir):
    return flatten.scoring_players(sides(spark, sf_dir))


@query(
    "tournament_seasons",
    "SELECT DISTINCT c_nationkey::BIGINT AS tournament_id, year(o_orderdate)::BIGINT AS season_id, lpad((year(o_orderdate) % 100)::VARCHAR, 2, '0') || '/' || lpad(((year(o_orderdate) + 1) % 100)::VARCHAR, 2, '0') AS season_year FROM orders JOIN customer ON o_custkey = c_custkey",
)
def tournament_seasons(spark, sf_dir):
    years = orders(spark, sf_dir).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", F.year("day").alias("y")).distinct()
    season = F.struct(F.col("y").alias("id"), S.season_label(F.col("y")).alias("year"))
    each = years.groupBy("c_nationkey").agg(F.collect_list(season).alias("seasons")).select(F.struct(F.struct(F.col("c_nationkey").alias("id")).alias("uniqueTournament"), "seasons").alias("t"))
    return flatten.tournament_seasons(good(as_payload(each.groupBy().agg(F.collect_list("t").alias("t")), F.lit("x"), F.struct(F.col("t").alias("uniqueTournamentSeasons"))), "seasons"))


#: Order keys of a page of events; a source pages its calendars, so no payload grows with the table.
PAGE_KEYS = 10_000


def page_of(key):
    return F.lpad(F.floor(key / PAGE_KEYS).cast("string"), 12, "0")


def finished(spark, sf_dir) -> DataFrame:
    """Finished events; an order is an event, and every seventh one comes again in a later file, with another name of the home team."""
    k = F.col("o_orderkey")
    named = lambda file, suffix: F.struct(F.concat(F.lit(file), F.year("day").cast("string")).alias("file"), F.lit(suffix).alias("suffix"))
    each = orders(spark, sf_dir).withColumn("copy", F.explode(F.array_compact(F.array(named("a", ""), F.when(k % 7 == 0, named("b", " new"))))))
    club = lambda i, name: F.struct(i.alias("id"), name.alias("name"))
    event = F.struct(
        k.alias("id"), F.col("at").alias("startTimestamp"), F.struct(F.when(F.col("o_orderstatus") == "O", "notstarted").otherwise("finished").alias("type")).alias("status"),
        club(F.col("o_custkey"), F.concat(F.lit("H"), text("o_custkey"), F.col("copy.suffix"))).alias("homeTeam"), club(k % 50, F.concat(F.lit("A"), (k % 50).cast("string"))).alias("awayTeam"),
        F.struct(F.when(k % 11 > 0, club(F.lit(8), F.lit("L"))).alias("uniqueTournament")).alias("tournament"), F.struct(F.year("day").alias("id"), S.season_label(S.season_of(F.col("day"))).alias("year")).alias("season"),
    )
    return flatten.finished_events(good(as_payload(each.groupBy("copy.file", page_of(k).alias("page")).agg(F.collect_list(event).alias("e")), F.concat_ws("-", "file", "page"), F.struct(F.col("e").alias("events"))), "events"))


_SEASON_OF = SEASON.format("o_orderdate")
_LABEL = f"lpad(({_SEASON_OF} % 100)::VARCHAR, 2, '0') || '/' || lpad((({_SEASON_OF} + 1) % 100)::VARCHAR, 2, '0')"
_FINISHED = f"""
    f AS (SELECT o_orderkey AS event_id, o_orderdate::DATE AS date, o_custkey AS home_team_id, 'H' || o_custkey || CASE WHEN o_orderkey % 7 = 0 THEN ' new' ELSE '' END AS home_team_name, (o_orderkey % 50)::BIGINT AS away_team_id,
    'A' || (o_orderkey % 50) AS away_team_name, 8::BIGINT AS tournament_id, year(o_orderdate)::BIGINT AS season_id, {_LABEL} AS season_year, ({_SEASON_OF})::VARCHAR AS season FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey % 11 > 0)
"""


@query("finished_events", f"WITH {_FINISHED} SELECT * FROM f")
def finished_events(spark, sf_dir):
    return finished(spark, sf_dir)


def entries(spark, sf_dir) -> DataFrame:
    """Line-up entries: the lines of an order are its players, odd ones of the home side. Numbers, texts of digits and booleans stand in the statistics."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    player = F.concat(F.lit('{"player":{'), F.when(F.col("l_quantity") < 50, F.concat(F.lit('"id":'), text("l_partkey"), F.lit(","))).otherwise(""), F.lit('"name":"P'), text("l_partkey"), F.lit('","dateOfBirthTimestamp":'), ((F.col("l_partkey") % 9000) * 86400).cast("string"), F.lit("}"))
    substitute = F.when(F.col("l_returnflag") == "A", ',"substitute":false').when(F.col("l_returnflag") == "N", ',"substitute":true').otherwise("")
    quantity = F.col("l_quantity").cast("int").cast("string")
    passes = F.when(F.col("l_linestatus") == "O", F.concat(F.lit('"'), quantity, F.lit('"'))).otherwise(quantity)
    stats = F.when(F.col("l_quantity") == 1, "{}").otherwise(F.concat(F.lit('{"minutesPlayed":'), quantity, F.lit(',"totalPass":'), passes, F.lit(',"goals":'), F.when(F.col("l_linenumber") == 1, "true").otherwise(text("l_linenumber")), F.lit(',"rating":7.5}')))
    entry = F.concat(player, substitute, F.lit(',"statistics":'), stats, F.lit("}"))
    side = lambda odd: F.array_join(F.collect_list(F.when((F.col("l_linenumber") % 2 == 1) == F.lit(odd), F.col("entry"))), ",")
    sheets = line.withColumn("entry", entry).groupBy("l_orderkey").agg(side(True).alias("h"), side(False).alias("a"))
    payload = F.concat(F.lit('{"home":{"players":['), "h", F.lit(']},"away":{"players":['), "a", F.lit("]}}"))
    return flatten.lineup_entries(good(sheets.select(text("l_orderkey").alias("name"), payload.alias("payload")), "lineups"), finished(spark, sf_dir))


def known_parts(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").where("p_partkey % 3 = 0")
    return part.select(text("p_partkey").alias("id_en_fuente"), F.concat(F.lit("p"), text("p_partkey")).alias("canonical_id"))


_ENTRIES = f"""
    WITH {_FINISHED}, e AS (SELECT f.*, l_partkey AS player, l_quantity AS q, l_linenumber AS line, l_returnflag = 'A' AS is_starting, l_linestatus AS status, l_linenumber % 2 = 1 AS is_home,
    CASE WHEN l_linenumber % 2 = 1 THEN home_team_id ELSE away_team_id END AS team_id, CASE WHEN l_linenumber % 2 = 1 THEN away_team_id ELSE home_team_id END AS opponent_id,
    CASE WHEN l_linenumber % 2 = 1 THEN home_team_name ELSE away_team_name END AS team_name, CASE WHEN l_partkey % 3 = 0 AND l_partkey IN (SELECT p_partkey FROM part) THEN 'p' || l_partkey ELSE '' END AS canonical_id
    FROM lineitem JOIN f ON f.event_id = l_orderkey)
"""


@query(
    "lineup_match_stats",
    _ENTRIES
    + """
    SELECT player || '_' || event_id AS player_event, player AS source_player_id, canonical_id, event_id, date, is_home, opponent_id, CASE WHEN line = 1 THEN 1.0 ELSE line END::DOUBLE AS goals, CASE WHEN status = 'F' THEN q END AS passes, q AS minutes,
    0.0::DOUBLE AS shots, NULL::DOUBLE AS expected_goals, 7.5::DOUBLE AS rating, 's' AS source FROM e WHERE q > 1 AND q < 50
    """,
)
def lineup_match_stats(spark, sf_dir):
    stats = flatten.match_stats(entries(spark, sf_dir), known_parts(spark, sf_dir), "s")
    return stats.select("player_event", "source_player_id", "canonical_id", "event_id", "date", "is_home", "opponent_id", "goals", "passes", "minutes", "shots", "expected_goals", "rating", "source")


@query(
    "cup_minutes",
    _ENTRIES + " SELECT player || '_' || event_id AS player_event, canonical_id, player AS source_player_id, event_id, date, team_id, opponent_id, is_home, is_starting, q AS minutes, season FROM e WHERE q > 1 AND q < 50 AND team_id < 25",
)
def cup_minutes(spark, sf_dir):
    seasons = orders(spark, sf_dir).select(S.season_of(F.col("day")).cast("string").alias("season")).distinct()
    teams = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("team_id")).join(seasons)  # 25 nations and a row a season
    return analytics.cup_minutes(flatten.played(entries(spark, sf_dir)), teams, known_parts(spark, sf_dir))


_CATALOG = """
    k AS (SELECT *, row_number() OVER (PARTITION BY season, player, team_id ORDER BY date DESC, event_id DESC, team_name DESC) AS p, row_number() OVER (PARTITION BY season, team_id ORDER BY date DESC, event_id DESC, team_name DESC) AS t FROM e WHERE q < 50)
"""


@query(
    "identity_catalog",
    _ENTRIES.rstrip() + "," + _CATALOG + " SELECT 'player' AS kind, season, player AS id, 'P' || player AS name, DATE '1970-01-01' + (player % 9000)::INT AS birth_date, team_id, team_name FROM k WHERE p = 1 UNION ALL SELECT 'team', season, NULL, NULL, NULL, team_id, team_name FROM k WHERE t = 1",
)
def identity_catalog(spark, sf_dir):
    players, teams = analytics.identity_catalog(entries(spark, sf_dir), F.lit("cup"))
    none = lambda t: F.lit(None).cast(t)
    told = players.select(F.lit("player").alias("kind"), "season", F.col("source_player_id").alias("id"), "name", "birth_date", "team_id", "team_name")
    return told.unionByName(teams.select(F.lit("team").alias("kind"), "season", none("long").alias("id"), none("string").alias("name"), none("date").alias("birth_date"), "team_id", "team_name"))


@query(
    "season_metrics",
    """
    SELECT event_id || '-8-77' AS name, metric, v AS value FROM (SELECT event_id, unnest(['k', 'value', 'won']) AS metric, unnest([(props::JSON ->> 'k')::DOUBLE, value, (event_id % 2 = 0)::INT::DOUBLE]) AS v FROM events)
    """,
)
def season_metrics(spark, sf_dir):
    """Numbers and booleans become metrics; texts of digits, nested values and the keys that are no metrics do not."""
    e = table(spark, sf_dir, "events")
    body = F.concat(
        F.lit('{"statistics":{"id":1,"type":"x","text":"'), text("event_id"), F.lit('","nested":{"a":1},"k":'), F.get_json_object("props", "$.k"), F.lit(',"value":'), text("value"), F.lit(',"won":'), (F.col("event_id") % 2 == 0).cast("string"), F.lit("}}")
    )
    return flatten.season_metrics(good(e.select(F.concat(text("event_id"), F.lit("-8-77")).alias("name"), body.alias("payload")), "overall"))


@query(
    "count_and_measure_nulls",
    """
    SELECT event_type, sum(CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 0 ELSE (props::JSON ->> 'k')::BIGINT END)::DOUBLE AS goals, count_if(event_id % 10 > 0) AS goals_known, count_if(event_id % 10 > 0 AND event_id % 4 = 0) AS minutes_known FROM events GROUP BY event_type
    """,
)
def count_and_measure_nulls(spark, sf_dir):
    """A missing count is zero, a missing measure is null, and without statistics both are."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    parts = F.array_compact(F.array(F.when(F.col("event_id") % 3 > 0, F.concat(F.lit('"goals":'), k)), F.when(F.col("event_id") % 4 == 0, F.lit('"minutesPlayed":90'))))
    stats = F.from_json(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")), "map<string,variant>")
    rows = e.select("event_type", F.when(F.col("event_id") % 10 > 0, stats).alias("statistics"))
    metrics = flatten.match_metrics(F.col("statistics"))
    rows = rows.select("event_type", metrics["goals"].alias("g"), metrics["minutes"].alias("m"))
    return rows.groupBy("event_type").agg(F.sum("g").alias("goals"), F.count("g").alias("goals_known"), F.count("m").alias("minutes_known"))


@query(
    "rated_matches",
    "SELECT o_custkey::VARCHAR AS name, o_orderkey AS event_id, o_orderdate::DATE AS date, 'T' || (o_orderkey % 50) AS opponent, (o_orderkey % 50)::BIGINT AS opponent_id, o_orderkey % 2 = 0 AS is_home, (o_orderkey % 100) / 10 AS rating FROM orders",
)
def rated_matches(spark, sf_dir):
    k = F.col("o_orderkey")
    rating = F.struct(k.alias("eventId"), F.col("at").alias("startTimestamp"), ((k % 100) / 10).alias("rating"), (k % 2 == 0).alias("isHome"), F.struct((k % 50).alias("id"), F.concat(F.lit("T"), (k % 50).cast("string")).alias("name")).alias("opponent"))
    each = orders(spark, sf_dir).groupBy("o_custkey").agg(F.collect_list(rating).alias("r"))
    return flatten.rated_matches(good(as_payload(each, F.col("o_custkey"), F.struct(F.col("r").alias("seasonRatings"))), "ratings"))


@query("market_values", "SELECT o_custkey AS player_id, CASE WHEN o_orderkey % 9 > 0 THEN o_orderdate::DATE END AS date, floor(o_totalprice)::BIGINT AS value, o_orderpriority AS club_name FROM orders")
def market_values(spark, sf_dir):
    point = F.struct(F.floor("o_totalprice").alias("y"), F.when(F.col("o_orderkey") % 9 > 0, F.date_format("day", "dd/MM/yyyy")).otherwise("-").alias("datum_mw"), F.col("o_orderpriority").alias("verein"))
    each = orders(spark, sf_dir).groupBy("o_custkey").agg(F.collect_list(point).alias("l"))
    return flatten.market_values(good(as_payload(each, F.col("o_custkey"), F.struct(F.col("l").alias("list"))), "values"))


@query(
    "transfers",
    f"""
    SELECT o_custkey AS player_id, o_orderdate::DATE AS date, {_LABEL} AS season, CASE o_orderkey % 4 WHEN 0 THEN 'end of loan' WHEN 1 THEN 'loan' ELSE 'transfer' END AS type, (o_orderkey % 50)::BIGINT AS from_club_id, 'C' || (o_orderkey % 50) AS from_club_name, NULL::BIGINT AS to_club_id FROM orders
    """,
)
def transfers(spark, sf_dir):
    k = F.col("o_orderkey")
    fee = F.when(k % 4 == 0, "End of loan").when(k % 4 == 1, "Loan fee: €1m").when(k % 4 == 2, "€2m").otherwise("-")
    link = F.concat(F.lit("/c/startseite/verein/"), (k % 50).cast("string"))
    move = F.struct(F.date_format("day", "yyyy-MM-dd").alias("dateUnformatted"), S.season_label(S.season_of(F.col("day"))).alias("season"), fee.alias("fee"), F.lit("-").alias("marketValue"), F.struct(F.concat(F.lit("C"), (k % 50).cast("string")).alias("clubName"), link.alias("href")).alias("from"), F.struct(F.lit("-").alias("clubName"), F.lit("").alias("href")).alias("to"))
    each = orders(spark, sf_dir).groupBy("o_custkey").agg(F.collect_list(move).alias("t"))
    return flatten.transfers(good(as_payload(each, F.col("o_custkey"), F.struct(F.col("t").alias("transfers"))), "transfers")).select("player_id", "date", "season", "type", "from_club_id", "from_club_name", "to_club_id")


@query(
    "availability",
    "SELECT o_custkey AS player_id, o_orderkey::VARCHAR AS game_id, o_orderdate::DATE AS date, o_orderpriority AS competition_id, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 50 END::BIGINT AS opponent_club_id, o_orderstatus AS participation_state, (o_orderkey % 91)::BIGINT AS played_minutes, CASE WHEN o_orderkey % 2 = 0 THEN 60 END::BIGINT AS substituted_in_minute FROM orders",
)
def availability(spark, sf_dir):
    k = F.col("o_orderkey")
    info = F.struct(text("o_orderkey").alias("gameId"), F.col("o_orderpriority").alias("competitionId"), F.struct(F.date_format("day", "yyyy-MM-dd'T'20:00:00'Z'").alias("dateTimeUTC")).alias("date"))
    clubs = F.struct(F.struct(F.when(k % 3 > 0, (k % 50).cast("string")).otherwise("unknown").alias("clubId")).alias("opponent"))
    time = F.struct((k % 91).alias("playedMinutes"), F.when(k % 2 == 0, F.struct(F.lit(60).alias("minute"))).alias("substitutedIn"))
    game = F.struct(info.alias("gameInformation"), clubs.alias("clubsInformation"), F.struct(F.struct(F.col("o_orderstatus").alias("participationState")).alias("generalStatistics"), time.alias("playingTimeStatistics")).alias("statistics"))
    each = orders(spark, sf_dir).groupBy("o_custkey").agg(F.collect_list(game).alias("p"))
    rows = flatten.availability(good(as_payload(each, F.col("o_custkey"), F.struct(F.struct(F.col("p").alias("performance")).alias("data"))), "performance"))
    return rows.select("player_id", "game_id", "date", "competition_id", "opponent_club_id", "participation_state", "played_minutes", "substituted_in_minute")


@query("broken_payloads", "SELECT count_if(event_id % 3 = 0) AS good, count_if(event_id % 3 > 0) AS broken FROM events")
def broken_payloads(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    body = F.when(F.col("event_id") % 3 == 0, '{"statistics":{}}').when(F.col("event_id") % 3 == 1, "{}").otherwise("no json")
    fine, broken = flatten.parsed(e.select(text("event_id").alias("name"), body.alias("payload")), "overall")
    return fine.agg(F.count(F.lit(1)).alias("good")).join(broken.agg(F.count(F.lit(1)).alias("broken")))  # one row each


# --- pages ----------------------------------------------------------------------------------------------------------


def pages(rows: DataFrame, key: str, row, around: str = '<table class="items"><tbody>{}</tbody></table>') -> DataFrame:
    """(page, html): the rows of each key in a table of a page."""
    before, after = around.split("{}")
    made = rows.groupBy(key).agg(F.array_join(F.collect_list(row), "").alias("rows"))
    return made.select(text(key).alias("page"), F.concat(F.lit(before), "rows", F.lit(after)).alias("html"))


def line(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query("club_pages", "SELECT s_nationkey::VARCHAR AS page, s_suppkey AS club_id, s_name AS club_name, CASE WHEN s_suppkey % 4 > 0 THEN (s_suppkey % 1000) * 1000 END::BIGINT AS squad_value FROM supplier")
def club_pages(spark, sf_dir):
    amount = F.when(F.col("s_suppkey") % 4 == 0, "-").otherwise(line("€", (F.col("s_suppkey") % 1000).cast("string"), "k"))
    row = line('<tr><td class="x hauptlink"><a href="/c/startseite/verein/', text("s_suppkey"), '">', F.col("s_name"), '</a><td>25<td class="rechts">', amount, "</tr>")
    return html.parse_pages(pages(table(spark, sf_dir, "supplier"), "s_nationkey", row), "competition-clubs").drop("error")


@query(
    "squad_pages",
    "SELECT c_nationkey::VARCHAR AS page, c_custkey AS player_id, 's' || c_custkey AS slug, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS position, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 99 END::INT AS shirt_number FROM customer",
)
def squad_pages(spark, sf_dir):
    inline = line('<table class="inline-table"><tr><td><a href="/s', text("c_custkey"), "/profil/spieler/", text("c_custkey"), '"> ', F.col("c_name"), "</a></td></tr>", F.when(F.col("c_custkey") % 3 > 0, line("<tr><td>", F.col("c_mktsegment"), "</td></tr>")).otherwise(""), "</table>")
    shirt = F.when(F.col("c_custkey") % 4 > 0, (F.col("c_custkey") % 99).cast("string")).otherwise("-")
    row = line('<tr><td><div class="rn_nummer">', shirt, "</div></td><td>", inline, "</td></tr>")
    return html.parse_pages(pages(table(spark, sf_dir, "customer"), "c_nationkey", row), "kader").drop("error")


@query(
    "profile_pages",
    "SELECT c_custkey::VARCHAR AS page, c_name AS name, CASE WHEN c_custkey % 5 > 0 THEN DATE '1980-01-01' + (c_custkey % 9000)::INT END AS birth_date, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS position FROM customer",
)
def profile_pages(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    born = F.date_add(F.lit("1980-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int"))
    birth = F.when(F.col("c_custkey") % 5 > 0, line('<span itemprop="birthDate">', F.date_format(born, "dd/MM/yyyy"), " (25)</span>")).otherwise("")
    position = F.when(F.col("c_custkey") % 3 > 0, line('<li class="data-header__label">Position:<span class="data-header__content">', F.col("c_mktsegment"), "</span></li>")).otherwise("")
    page = line('<h1 class="data-header__headline-wrapper"><span class="data-header__shirt-number">#1</span>', F.col("c_name"), "</h1>", birth, position)
    return html.parse_pages(c.select(text("c_custkey").alias("page"), page.alias("html")), "profile").select("page", "name", S.slash_date(F.col("birth_date")).alias("birth_date"), "position")


@query(
    "injury_pages",
    f"SELECT o_custkey AS player_id, {_LABEL} AS season, o_orderpriority AS injury, o_orderdate::DATE AS from_date, CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate::DATE + 9 END AS until_date, (o_orderkey % 30)::BIGINT AS days, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 7 END::BIGINT AS games_missed FROM orders",
)
def injury_pages(spark, sf_dir):
    k = F.col("o_orderkey")
    until = F.when(k % 4 > 0, F.date_format(F.date_add("day", 9), "dd/MM/yyyy")).otherwise("-")
    cells = [S.season_label(S.season_of(F.col("day"))), F.col("o_orderpriority"), F.date_format("day", "dd/MM/yyyy"), until, line((k % 30).cast("string"), " days"), F.when(k % 3 > 0, (k % 7).cast("string")).otherwise("-")]
    row = line("<tr>", *[x for c in cells for x in ("<td>", c, "</td>")], "</tr>")
    return jobs.injuries(html.parse_pages(pages(orders(spark, sf_dir), "o_custkey", row), "injuries"))


@query("page_errors", "SELECT count(*) AS n FROM pages")
def page_errors(spark, sf_dir):
    """Pages of another kind break the contract of a squad page, each with one row that says so."""
    found = table(spark, sf_dir, "pages").select(text("page_id").alias("page"), "html")
    return html.parse_pages(found, "kader").where("error is not null and player_id is null").agg(F.count_distinct("page").alias("n"))


# --- scalar functions -----------------------------------------------------------------------------------------------


@query(
    "strict_dates",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE END AS slash, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE END AS iso, o_orderdate::DATE AS epoch FROM orders
    """,
)
def strict_dates(spark, sf_dir):
    o = orders(spark, sf_dir)
    k = F.col("o_orderkey")
    slash = F.when(k % 3 == 0, F.date_format("day", " d/M/yyyy ")).when(k % 3 == 1, "31/02/2020").otherwise(F.date_format("day", "yyyy/MM/dd"))
    iso = F.when(k % 3 == 0, F.date_format("day", "yyyy-MM-dd")).when(k % 3 == 1, F.date_format("day", "yyyy-MM-dd'T'10:00:00")).otherwise("2020-02-31")
    return o.select("o_orderkey", S.slash_date(slash).alias("slash"), S.iso_date(iso).alias("iso"), S.epoch_date(F.col("at")).alias("epoch"))


@query(
    "ids_in_texts",
    """
    SELECT s_suppkey, s_suppkey AS leading, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS whole, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey END AS club, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey::VARCHAR END AS token, s_suppkey::VARCHAR AS id_text FROM supplier
    """,
)
def ids_in_texts(spark, sf_dir):
    k = text("s_suppkey")
    even, third = F.col("s_suppkey") % 2 == 0, F.col("s_suppkey") % 3 == 0
    whole = F.when(even, line(" ", k)).otherwise(line(k, "x"))
    token = F.when(even, line("https://x/a-b/profil/spieler/", k)).otherwise(line("spieler ", k))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", S.leading_int(line("spieler-", k, "-9")).alias("leading"), S.int_or_null(whole).alias("whole"), S.club_of_link(F.when(third, line("/x/verein/", k, "/y")).otherwise(line("/x/spieler/", k))).alias("club"),
        S.player_of_token(token).alias("token"), S.id_text(line(k, ".0")).alias("id_text"),
    )


@query(
    "name_compatible",
    """
    WITH n AS (SELECT p_partkey, string_split(p_name, ' ') AS name, CASE p_partkey % 3 WHEN 0 THEN [string_split(p_name, ' ')[-1]] WHEN 1 THEN list_append(string_split(p_name, ' '), 'junior') ELSE ['zz', string_split(p_name, ' ')[1]] END AS other FROM part)
    SELECT p_partkey, list_has_all(name, other) OR list_has_all(other, name) AS fits, false AS empty FROM n
    """,
)
def name_compatible(spark, sf_dir):
    """Names against a part of themselves, themselves and more, and a name that shares one word and has one of its own."""
    words = F.split("p_name", " ")
    other = F.when(F.col("p_partkey") % 3 == 0, F.element_at(words, -1)).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" junior"))).otherwise(F.concat(F.lit("zz "), words[0]))
    name, none = S.name_tokens(F.col("p_name")), S.name_tokens(F.lit("de la"))
    return table(spark, sf_dir, "part").select("p_partkey", S.compatible(name, S.name_tokens(other)).alias("fits"), S.compatible(name, none).alias("empty"))


@query("slugs", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || '!' || p_type), '[^a-z0-9]', '-', 'g'), '^-+|-+$', '', 'g') AS slug, 'query' AS none, p_partkey || '_' || p_size AS player_event FROM part")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.slug(F.concat("p_name", F.lit("!"), "p_type")).alias("slug"), S.slug(F.lit("?!")).alias("none"), S.player_event(F.col("p_partkey"), F.col("p_size")).alias("player_event"))


@query(
    "durations",
    """
    WITH d AS (SELECT event_id, event_id * 37 % 100000 AS s, ts FROM events)
    SELECT event_id, CASE WHEN s < 60 THEN s || ' s' WHEN s < 3600 THEN (s // 60) || ' min' || CASE WHEN s % 60 = 0 THEN '' ELSE ' ' || (s % 60) || ' s' END
    ELSE (s // 3600) || ' h' || CASE WHEN s // 60 % 60 = 0 THEN '' ELSE ' ' || (s // 60 % 60) || ' min' END END AS duration, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM d
    """,
)
def durations(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.duration_text(F.col("event_id") * 37 % 100000 + 0.5).alias("duration"), S.minute_text(F.col("ts").cast("timestamp")).alias("minute"))


@query("money_units", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size * 1000000 + 500000 WHEN 1 THEN p_size * 1000 WHEN 2 THEN p_size::BIGINT * 1000000000 WHEN 3 THEN p_size END::BIGINT AS amount FROM part")
def money_units(spark, sf_dir):
    """Amounts as the source writes them: millions with decimals, thousands, thousands of millions, plain ones, and none."""
    k, n = F.col("p_partkey") % 5, text("p_size")
    written = F.when(k == 0, line("fee: €", n, ".50m")).when(k == 1, line("€", n, "Th.")).when(k == 2, line("€", n, "BN")).when(k == 3, line("€ ", n)).otherwise("free transfer")
    return table(spark, sf_dir, "part").select("p_partkey", S.money(written).alias("amount"))


@query("season_texts", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN year(o_orderdate) WHEN 1 THEN year(o_orderdate) WHEN 2 THEN year(o_orderdate) END::INT AS season FROM orders")
def season_texts(spark, sf_dir):
    """Seasons as sources write them: "95/96", "1995", "1995/1996", and what is none."""
    k, y = F.col("o_orderkey") % 4, F.year("day")
    two = lambda n: F.lpad((n % 100).cast("string"), 2, "0")
    written = F.when(k == 0, F.concat_ws("/", two(y), two(y + 1))).when(k == 1, y.cast("string")).when(k == 2, F.concat_ws("/", y.cast("string"), (y + 1).cast("string"))).otherwise("season 7")
    return orders(spark, sf_dir).select("o_orderkey", S.season_start(written).alias("season"))


@query("starts", "SELECT l_orderkey, l_linenumber, l_returnflag = 'A' AS is_starting FROM lineitem")
def starts(spark, sf_dir):
    substitute = F.when(F.col("l_returnflag") == "A", F.lit(False)).when(F.col("l_returnflag") == "N", F.lit(True))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.is_starting(substitute).alias("is_starting"))


# --- resolution -----------------------------------------------------------------------------------------------------


@query(
    "searched_identity",
    """
    WITH h AS (SELECT c_custkey AS q, unnest([1, 2, 3]) AS n, c_custkey FROM customer),
    f AS (SELECT q, n, CASE n WHEN 1 THEN q * 10 WHEN 2 THEN q * 10 + 1 ELSE q * 10 + 2 END AS id, CASE n WHEN 1 THEN q % 4 > 0 WHEN 2 THEN q % 5 = 0 ELSE false END AS ok FROM h),
    g AS (SELECT q, count_if(ok) AS c, max(id) FILTER (ok) AS id FROM f GROUP BY q)
    SELECT q::VARCHAR AS query_id, CASE WHEN c = 1 AND q % 6 > 0 AND q % 7 > 0 THEN id END AS right_id,
    CASE WHEN c = 0 THEN 'sin-ficha' WHEN c > 1 THEN 'varios-candidatos' WHEN q % 6 = 0 THEN 'sin-fecha-que-verificar' WHEN q % 7 = 0 THEN 'fecha-discrepante' ELSE '' END AS motivo FROM g
    """,
)
def searched_identity(spark, sf_dir):
    """Search payloads: a hit of the name, another of the same name for every fifth, and a team and a player of another sport that never count."""
    q = F.col("c_custkey")
    entity = lambda i, sport: F.struct(i.alias("id"), F.when(i % 10 < 2, F.concat(F.lit("N"), text("c_custkey"))).otherwise("other").alias("name"), F.struct(F.struct(F.lit(sport).alias("slug")).alias("sport")).alias("team"))
    hit = lambda kind, i, sport: F.struct(F.lit(kind).alias("type"), entity(i, sport).alias("entity"))
    results = F.array_compact(F.array(F.when(q % 4 > 0, hit("player", q * 10, "football")), F.when(q % 5 == 0, hit("player", q * 10 + 1, "football")), hit("team", q * 10 + 2, "football"), hit("player", q * 10 + 2, "tennis")))
    customers = table(spark, sf_dir, "customer")
    found = flatten.search_hits(good(as_payload(customers, q, F.struct(results.alias("results"))), "search"))
    own = F.floor(F.col("right_id") / 10)
    born = F.when(own % 6 == 0, "").when(own % 7 == 0, "1991-01-01").otherwise("1990-01-01")
    hits = found.select("query_id", "right_id", "kind", "sport", S.name_tokens(F.col("found_name")).alias("tokens"), born.alias("birth_date"))
    wanted = customers.select(text("c_custkey").alias("query_id"), S.name_tokens(F.concat(F.lit("n"), text("c_custkey"))).alias("tokens"), F.lit("1990-01-01").alias("birth_date"))
    return resolve.searched_identity(hits, wanted)


@query(
    "team_review",
    PART_TEAMS
    + """
    , s AS (SELECT right_id, count(*) AS suitors FROM c GROUP BY right_id), g AS (SELECT left_id, count(*) AS n, max(suitors) AS suitors, min(right_id) AS one FROM c JOIN s USING (right_id) GROUP BY left_id),
    v AS (SELECT DISTINCT competition || '/' || p.n AS left_id, g.n AS n, suitors, one FROM p LEFT JOIN g ON g.left_id = competition || '/' || p.n)
    SELECT left_id, CASE WHEN n = 1 AND suitors = 1 THEN one END AS right_id, CASE WHEN n IS NULL THEN 'sin-candidato' WHEN suitors > 1 THEN 'candidato-compartido' WHEN n > 1 THEN 'varios-candidatos' ELSE '' END AS motivo FROM v
    """,
)
def team_review(spark, sf_dir):
    return resolve.team_verdicts(*part_teams(spark, sf_dir), CuratedStore(spark, scratch(spark)).staged)[0]


@query(
    "preserved_decisions",
    """
    WITH k AS (SELECT o_custkey::VARCHAR AS biwenger_id, o_orderkey::VARCHAR AS tm_id, o_orderkey AS k FROM orders)
    SELECT biwenger_id, tm_id, CASE WHEN k % 3 = 0 AND biwenger_id::BIGINT % 2 = 1 THEN 'y' ELSE '' END AS decision FROM k WHERE k % 2 = 0 UNION ALL SELECT biwenger_id, tm_id, 'y' FROM k WHERE k % 2 = 1 AND k % 3 = 0 AND biwenger_id::BIGINT % 2 = 1
    """,
)
def preserved_decisions(spark, sf_dir):
    """New rows for even orders; every third old row has a decision; people with an even id are settled."""
    o = orders(spark, sf_dir).select(text("o_custkey").alias("biwenger_id"), text("o_orderkey").alias("tm_id"), "o_orderkey")
    rows = o.where("o_orderkey % 2 = 0").select("biwenger_id", "tm_id", F.lit("").alias("decision"))
    old = o.select("biwenger_id", "tm_id", F.when(F.col("o_orderkey") % 3 == 0, "y").otherwise("  ").alias("decision"))
    settled = o.where("cast(biwenger_id as long) % 2 = 0").select(F.col("biwenger_id").alias("id"))
    return resolve.preserve_decisions(rows, old, settled, ["biwenger_id", "tm_id"], "biwenger_id")


@query("enqueued_review", "SELECT o_custkey AS left_id, o_orderkey AS right_id, 'old' AS motivo FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT o_custkey, o_orderkey, 'new' FROM orders WHERE o_orderstatus = 'P'")
def enqueued_review(spark, sf_dir):
    rows = lambda status, motivo: orders(spark, sf_dir).where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("left_id"), F.col("o_orderkey").alias("right_id"), F.lit(motivo).alias("motivo"))
    return resolve.enqueue_review(rows("F", "old"), rows("P", "new"), "left_id")


@query(
    "safe_identity",
    """
    SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 4 = 0 THEN 'unmapped' WHEN s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 OR s_suppkey % 7 > 0 THEN 'agrees' ELSE 'differs' END AS outcome FROM supplier
    """,
)
def safe_identity(spark, sf_dir):
    """A profile is a supplier, its own record the customer of its number; every fourth has no mapping, some dates are unknown, every seventh differs."""
    s = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier")
    profile = suppliers.select(s.alias("id"), F.when(s % 3 == 0, "").otherwise("1990-01-01").alias("birth_date"))
    pair = F.explode(F.array(*[F.struct(F.lit(source).alias("fuente"), text("s_suppkey").alias("id_en_fuente")) for source in ("tm", "own")])).alias("x")
    mapping = suppliers.where(s % 4 > 0).select(line("p", text("s_suppkey")).alias("canonical_id"), pair).select("canonical_id", "x.*")
    births = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 == 0, "").when(F.col("c_custkey") % 7 == 0, "1990-01-02").otherwise("1990-01-01").alias("birth_date"))
    return resolve.safe_identity(profile, mapping, births, "tm", "own")


@query("named_players", "SELECT q AS query, id FROM (SELECT 'p' || s_suppkey AS q, CASE WHEN s_suppkey % 2 = 0 THEN (s_suppkey + 7)::VARCHAR END AS id FROM supplier UNION ALL SELECT '/a/profil/spieler/' || s_suppkey, s_suppkey::VARCHAR FROM supplier UNION ALL SELECT s_name, NULL FROM supplier)")
def named_players(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    queries = suppliers.select(F.explode(F.array(line("p", text("s_suppkey")), line("/a/profil/spieler/", text("s_suppkey")), F.col("s_name"))).alias("query"))
    mapping = suppliers.where("s_suppkey % 2 = 0").select(line("p", text("s_suppkey")).alias("canonical_id"), F.lit("tm").alias("fuente"), (F.col("s_suppkey") + 7).cast("string").alias("id_en_fuente"))
    return resolve.named_player(queries, mapping, "tm")


@query("attachable", "SELECT c_custkey AS id, 'p' || c_custkey AS canonical_id FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 > 0 AND c_custkey % 5 > 0")
def attachable(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), line("p", text("c_custkey")).alias("canonical_id"))
    mapped = lambda source, every: c.where(f"id % {every} = 0").select("canonical_id", F.lit(source).alias("fuente"), text("id").alias("id_en_fuente"))
    return resolve.attachable(c.select("id"), mapped("own", 2).unionByName(mapped("third", 3)), "own", "third", c.where("id % 5 = 0").select("canonical_id")).select("id", "canonical_id")


@query(
    "skip_violations",
    """
    SELECT rule, count(*) AS n FROM (SELECT 'skip-repeated' AS rule FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT 'skip-format' FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT 'skipped' FROM customer WHERE c_custkey % 6 = 0 AND c_custkey % 7 > 0) GROUP BY rule
    """,
)
def skip_violations(spark, sf_dir):
    """Skips of all customers, every tenth twice, every seventh malformed; every sixth well-formed one is mapped to the third source too."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    once = c.select(line(F.when(k % 7 == 0, "x").when(k % 2 == 0, "p").otherwise("t"), text("c_custkey")).alias("canonical_id"), k)
    skips = once.unionByName(once.where(k % 10 == 0)).select("canonical_id")
    mapping = once.where(k % 6 == 0).select(F.regexp_replace("canonical_id", "^x", "p").alias("canonical_id"), F.lit("sofascore").alias("fuente"), text("c_custkey").alias("id_en_fuente"))
    return integrity.skip_violations(skips, mapping).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("dangling_mappings", "SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def dangling_mappings(spark, sf_dir):
    return analytics.dangling(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), orders(spark, sf_dir).select(F.col("o_custkey").alias("id")))


@query("prunable_members", "SELECT c_custkey AS id, true AS complete FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION ALL SELECT c_custkey, false FROM customer")
def prunable_members(spark, sf_dir):
    """After a whole crawl only those seen stay; after one with gaps everybody does."""
    members = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    seen = orders(spark, sf_dir).where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    whole, gaps = analytics.prunable(members, seen, True), analytics.prunable(members, seen, False)
    return whole.withColumn("complete", F.lit(True)).unionByName((members if gaps is None else gaps).withColumn("complete", F.lit(False)))


# --- lake, jobs, orchestrator -----------------------------------------------------------------------------------------


@query(
    "base_uris",
    """
    WITH u AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'file:///a' || p_partkey || '/b/' WHEN 1 THEN 's3://bucket' || p_partkey || '/p/' WHEN 2 THEN 'hdfs://h' || p_partkey || '/x/' WHEN 3 THEN 's3:///x' || p_partkey ELSE 'ftp://x' || p_partkey END AS uri FROM part)
    SELECT id, uri, CASE id % 5 WHEN 1 THEN 's3a://bucket' || id || '/p' WHEN 3 THEN 'refused' WHEN 4 THEN 'refused' ELSE rtrim(uri, '/') END AS base FROM u
    """,
)
def base_uris(spark, sf_dir):
    """Bases of every kind, named by the parts."""
    k = text("p_partkey")
    kind = F.col("p_partkey") % 5
    uri = F.when(kind == 0, line("file:///a", k, "/b/")).when(kind == 1, line("s3://bucket", k, "/p/")).when(kind == 2, line("hdfs://h", k, "/x/")).when(kind == 3, line("s3:///x", k)).otherwise(line("ftp://x", k))

    def base(one: str) -> str:
        try:
            return base_uri(one)
        except ValueError:
            return "refused"

    def bases(batches):
        for rows in batches:
            yield rows.assign(base=[base(u) for u in rows["uri"]])

    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), uri.alias("uri")).mapInPandas(bases, "id long, uri string, base string")


def raw_nations(spark, sf_dir) -> RawStore:
    """Two dated payloads of every nation; the later one counts. Every fifth nation was only downloaded on the first day."""
    raw = RawStore(spark, scratch(spark))
    for row in table(spark, sf_dir, "nation").orderBy("n_nationkey").toLocalIterator():  # 25 rows
        for day, version in ((date(2024, 1, 1), "old"), (date(2024, 2, 1), "new")):
            if version == "old" or row.n_nationkey % 5:
                raw.save("s", "nations", f"n-{row.n_nationkey}", json.dumps({"name": row.n_name, "version": version}).encode(), day=day)
    return raw


@query("raw_latest", "SELECT 'n-' || n_nationkey AS name, n_name AS nation, CASE WHEN n_nationkey % 5 > 0 THEN 'new' ELSE 'old' END AS version, CASE WHEN n_nationkey % 5 > 0 THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS downloaded FROM nation")
def raw_latest(spark, sf_dir):
    found = raw_nations(spark, sf_dir).latest("s", "nations")
    return found.select("name", F.get_json_object("payload", "$.name").alias("nation"), F.get_json_object("payload", "$.version").alias("version"), F.col("fecha_descarga").alias("downloaded"))


@query("raw_versions", "SELECT CASE WHEN v = 1 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS downloaded, count(*) AS n FROM nation, (SELECT unnest([1, 2]) AS v) WHERE v = 1 OR n_nationkey % 5 > 0 GROUP BY v")
def raw_versions(spark, sf_dir):
    return raw_nations(spark, sf_dir).payloads("s", "nations").groupBy(F.col("fecha_descarga").alias("downloaded")).agg(F.count(F.lit(1)).alias("n"))


@query("raw_single_reads", "SELECT * FROM (VALUES ('n-1', 'new', DATE '2024-02-01', false), ('n-5', 'old', DATE '2024-01-01', false), ('absent', 'fetched', NULL, true)) AS t(name, version, downloaded, fetched)")
def raw_single_reads(spark, sf_dir):
    """The latest of a name, its day, and what is fetched and stored only where there is none."""
    raw, calls, out = raw_nations(spark, sf_dir), [], []
    for name in ("n-1", "n-5", "absent"):
        day, before = raw.last_download("s", "nations", name), len(calls)
        payload = raw.cached_or_fetched("s", "nations", name, lambda: calls.append(1) or b'{"version": "fetched"}')
        assert payload == raw.read_latest("s", "nations", name)
        out.append((name, json.loads(payload)["version"], day, len(calls) > before))
    return spark.createDataFrame(out, "name string, version string, downloaded date, fetched boolean")


@query("raw_stale", "SELECT 'n-' || n_nationkey AS name, 'older' AS rule FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'never', 'older' UNION ALL SELECT 'never', 'absent'")
def raw_stale(spark, sf_dir):
    raw = raw_nations(spark, sf_dir)
    names = table(spark, sf_dir, "nation").select(line("n-", text("n_nationkey")).alias("name")).unionByName(spark.createDataFrame([("never",)], "name string"))
    stale = lambda days, rule: raw.stale(names, "s", "nations", days, date(2024, 2, 5)).withColumn("rule", F.lit(rule))
    return stale(10, "older").unionByName(stale(None, "absent"))


@query("mapping_files", "SELECT 'p' || lpad(s_suppkey::VARCHAR, 5, '0') AS canonical_id, 'a' AS fuente, '0' || s_suppkey AS id_en_fuente, CASE WHEN s_acctbal < 0 THEN 'manual' ELSE 'auto' END AS metodo, '' AS fecha FROM supplier")
def mapping_files(spark, sf_dir):
    """Approved relations to a file and back: all texts, zeros in front and empty cells as they were."""
    store = MappingStore(spark, a_folder(spark))
    rows = table(spark, sf_dir, "supplier").select(S.canonical_id("p", F.col("s_suppkey"), 5).alias("canonical_id"), F.lit("a").alias("fuente"), line("0", text("s_suppkey")).alias("id_en_fuente"), F.when(F.col("s_acctbal") < 0, "manual").otherwise("auto").alias("metodo"), F.lit(None).cast("string").alias("fecha"))
    store.save({"players": rows, "sofascore-skips": store.load("sofascore-skips")})
    return store.load("players")


@query("tolerant_read", "SELECT n_nationkey, n_name, NULL::DATE AS absent FROM nation")
def tolerant_read(spark, sf_dir):
    store = CuratedStore(spark, scratch(spark))
    store.write_table("nations", table(spark, sf_dir, "nation"))
    wanted = {"n_nationkey": "int", "n_name": "string", "absent": "date"}
    return store.read_tolerant("nations", wanted).unionByName(store.read_tolerant("missing", wanted))


@query("orchestrator", "SELECT * FROM (SELECT 'load' AS step, 'done' AS state, count(*) AS n FROM orders UNION ALL SELECT 'check', 'failed', count(*) FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'report', 'pending', NULL)")
def orchestrator(spark, sf_dir):
    """Steps in order; the one with failures is the last, and what comes after it is pending."""
    count = lambda condition: orders(spark, sf_dir).where(condition).count()
    report = run_steps([Step("load", lambda: Result(rows={"orders": count("true")})), Step("check", lambda: Result(rows={"orders": count("o_orderstatus = 'P'")}, failures=["open orders"])), Step("report", lambda: Result())])
    rows = [(name, "done" if r.ok else "failed", r.rows["orders"]) for name, r in report.done] + [(name, "pending", None) for name in report.pending]
    return spark.createDataFrame(rows, "step string, state string, n long")


def own_squad(lake: jobs.Lake, spark, sf_dir, history: bool) -> None:
    """Customers as the own source's players, with nations as teams; with ``history``, those of one segment have left and only the season's rounds name them."""
    born = F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("c_custkey").cast("int")), "yyyy-MM-dd")
    players = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), line("n", text("c_custkey")).alias("name"), F.col("c_nationkey").cast("long").alias("team_id"), born.alias("birth_date"), "c_mktsegment")
    teams = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    where = {"competition": "la-liga"}
    left = (F.col("c_mktsegment") == "BUILDING") & F.lit(history)
    lake.curated.write_table("biwenger_players", players.where(~left).drop("c_mktsegment"), where)
    lake.curated.write_table("biwenger_players_history", players.where(left).drop("c_mktsegment"), {**where, "season": "2023"})
    lake.curated.write_table("biwenger_teams", teams, where)


@query(
    "map_job",
    """
    SELECT c_custkey::VARCHAR AS id, CASE WHEN s_suppkey IS NULL THEN 'sin-candidato' WHEN s_suppkey % 4 > 0 OR s_nationkey = c_nationkey THEN '' ELSE 'sin-fecha-que-verificar' END AS motivo,
    CASE WHEN s_suppkey % 4 > 0 OR s_nationkey = c_nationkey THEN s_suppkey::VARCHAR END AS tm_id FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
    """,
)
def map_job(spark, sf_dir):
    """The mapping job over a lake: customers, some of whom have left, are matched with suppliers by name, within the club that nations are, or by birth date."""
    lake = a_lake(spark)
    own_squad(lake, spark, sf_dir, history=True)
    s = F.col("s_suppkey")
    born = F.when(s % 4 == 0, "").otherwise(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), s.cast("int")), "yyyy-MM-dd"))
    nation = table(spark, sf_dir, "nation")
    other = table(spark, sf_dir, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey")).select(s.alias("id"), line("N", text("s_suppkey")).alias("name"), F.col("n_nationkey").alias("club_id"), F.col("n_name").alias("club_name"), born.alias("birth_date"), F.lit("x").alias("position"))
    lake.curated.write_table("transfermarkt_players", other, {"competition": "la-liga", "season": "2023"})
    jobs.map_entities(lake, 2023, "2024-01-10")
    mapped = lake.mappings.load("players")
    side = lambda source, name: mapped.where(F.col("fuente") == source).select("canonical_id", F.col("id_en_fuente").alias(name))
    matched = side("biwenger", "id").join(side("transfermarkt", "tm_id"), "canonical_id").select("id", F.lit("").alias("motivo"), "tm_id")
    waiting = lake.mappings.load("players-review").select(F.col("biwenger_id").alias("id"), "motivo", F.lit(None).cast("string").alias("tm_id")).distinct()
    return matched.unionByName(waiting)


@query(
    "third_source_job",
    """
    WITH j AS (SELECT c_custkey AS k, s_suppkey AS s, c_nationkey = s_nationkey AS near FROM customer JOIN supplier ON s_suppkey = c_custkey WHERE c_custkey % 5 > 0),
    v AS (SELECT k, s, CASE WHEN k % 7 = 0 THEN 'manual' WHEN k % 7 = 1 THEN 'skip' WHEN s % 4 = 1 THEN 'fecha-discrepante' WHEN s % 4 = 0 AND NOT near THEN 'sin-fecha-que-verificar' ELSE 'auto' END AS told FROM j)
    SELECT k::VARCHAR AS id, CASE WHEN told <> 'skip' THEN s::VARCHAR END AS other, told FROM v
    """,
)
def third_source_job(spark, sf_dir):
    """Suppliers as the match-event source's players: those whose name and birth or club agree are attached to customers with a canonical id, after what people decided; doubts go to the review."""
    lake, where = a_lake(spark), {"competition": "la-liga", "season": "2023"}
    own_squad(lake, spark, sf_dir, history=False)
    s, nation = F.col("s_suppkey"), table(spark, sf_dir, "nation")
    born = F.when(s % 4 == 0, "").when(s % 4 == 1, "2001-01-01").otherwise(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), s.cast("int")), "yyyy-MM-dd"))
    seen = table(spark, sf_dir, "supplier").select(s.alias("sofascore_player_id"), line("N", text("s_suppkey")).alias("name"), born.alias("birth_date"), F.col("s_nationkey").cast("long").alias("team_id"), line("T", text("s_nationkey")).alias("team_name"))
    lake.curated.write_table("sofascore_players", seen, where)
    lake.curated.write_table("sofascore_teams", nation.select(F.col("n_nationkey").cast("long").alias("team_id"), F.col("n_name").alias("team_name")), where)
    row = lambda canonical, source, k: [canonical.alias("canonical_id"), F.lit(source).alias("fuente"), k.cast("string").alias("id_en_fuente"), F.lit("auto").alias("metodo"), F.lit("d").alias("fecha")]
    team = lambda source: nation.select(*row(line("t", F.lpad(text("n_nationkey"), 3, "0")), source, F.col("n_nationkey")))
    known = table(spark, sf_dir, "customer").where("c_custkey % 5 > 0").select(*row(S.canonical_id("p", F.col("c_custkey"), 5), "biwenger", F.col("c_custkey")))
    both = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "supplier"), F.col("c_custkey") == s).where("c_custkey % 5 > 0 and c_custkey % 7 < 2")
    decided = {"biwenger_id": text("c_custkey"), "biwenger_name": line("n", text("c_custkey")), "sofascore_id": text("s_suppkey"), "motivo": F.lit("m"), "decision": F.when(F.col("c_custkey") % 7 == 0, "y").otherwise("skip")}
    review = both.select(*[decided.get(c, F.lit("")).alias(c) for c in lake.mappings.load("sofascore-review").columns])
    lake.mappings.save({"players": known, "teams": team("biwenger").unionByName(team("sofascore")), "sofascore-review": review})
    jobs.map_third(lake, 2023, "2024-01-10")
    mapped = lake.mappings.load("players")
    own = mapped.where("fuente = 'biwenger'").select("canonical_id", F.col("id_en_fuente").alias("id"))
    attached = own.join(mapped.where("fuente = 'sofascore'").select("canonical_id", F.col("id_en_fuente").alias("other"), F.col("metodo").alias("told")), "canonical_id").select("id", "other", "told")
    skipped = own.join(lake.mappings.load("sofascore-skips").select("canonical_id"), "canonical_id").select("id", F.lit(None).cast("string").alias("other"), F.lit("skip").alias("told"))
    waiting = lake.mappings.load("sofascore-review").select(F.col("biwenger_id").alias("id"), F.col("sofascore_id").alias("other"), F.col("motivo").alias("told"))
    return attached.unionByName(skipped).unionByName(waiting)


@query(
    "newcomer_states",
    """
    WITH v AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F')
    SELECT c_custkey AS player_id, CASE WHEN c_custkey % 5 = 0 THEN 'sin-identidad' WHEN c_custkey % 5 = 1 THEN 'fallo' WHEN c_custkey % 5 = 2 THEN 'sin-historial' ELSE 'descargado' END AS history, c_custkey % 5 <> 4 AS again FROM customer WHERE c_custkey NOT IN (SELECT id FROM v)
    """,
)
def newcomer_states(spark, sf_dir):
    """Newcomers in every state: without an identity, without the event source's, without rows, done. A second run judges again all but those who were done before it."""
    lake, where = a_lake(spark), {"competition": "la-liga"}
    own_squad(lake, spark, sf_dir, history=False)
    lake.curated.write_table("fantasy_points", orders(spark, sf_dir).where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("player_id")).distinct(), {**where, "season": "2022"})
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), S.canonical_id("p", F.col("c_custkey"), 5).alias("canonical_id"))
    mapped = lambda source, condition: c.where(condition).select("canonical_id", F.lit(source).alias("fuente"), text("k").alias("id_en_fuente"), F.lit("auto").alias("metodo"), F.lit("d").alias("fecha"))
    lake.mappings.save({"players": mapped("biwenger", "k % 5 > 0").unionByName(mapped("sofascore", "k % 5 > 1"))})
    stats = lambda condition: lake.curated.write_table("player_match_stats", c.where(condition).select("canonical_id", F.col("k").alias("sofascore_player_id")), {"competition": "8", "season": "77"})
    stats("k % 5 = 4")
    jobs.detect_newcomers(lake, "la-liga", 2023, date(2024, 1, 1))
    stats("k % 5 > 2")
    jobs.detect_newcomers(lake, "la-liga", 2023, DAY)
    return lake.curated.read_table("newcomers").select("player_id", "history", (F.col("detected_on") == F.lit(DAY)).alias("again"))


@query(
    "coverage_job",
    """
    SELECT kind, id FROM (SELECT 'biwenger_teams' AS kind, n_nationkey::VARCHAR AS id FROM nation UNION ALL SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'biwenger_players_history' ELSE 'biwenger_players' END, c_custkey::VARCHAR FROM customer WHERE c_custkey % 2 = 1
    UNION ALL SELECT 'sofascore', s_suppkey::VARCHAR FROM supplier WHERE s_suppkey % 3 > 0)
    """,
)
def coverage_job(spark, sf_dir):
    """Own players and teams, present and past, and players with statistics; every second own and every third other player is mapped."""
    lake = a_lake(spark)
    own_squad(lake, spark, sf_dir, history=True)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sofascore_player_id"))
    for name, part in (("player_match_stats", s.where("sofascore_player_id % 2 = 0")), ("player_season_stats", s)):
        lake.curated.write_table(name, part, {"competition": "8", "season": "77"})
    row = lambda k, prefix, source: [line("p", prefix, k.cast("string")).alias("canonical_id"), F.lit(source).alias("fuente"), k.cast("string").alias("id_en_fuente"), F.lit("auto").alias("metodo"), F.lit("d").alias("fecha")]
    own = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(*row(F.col("c_custkey"), "1", "biwenger"))
    lake.mappings.save({"players": own.unionByName(s.where("sofascore_player_id % 3 = 0").select(*row(F.col("sofascore_player_id"), "2", "sofascore")))})
    return jobs.coverage(lake).select("kind", "id")


@query(
    "delta_job",
    """
    WITH s AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') SELECT o_custkey AS player_id, o_orderkey AS match_id, floor(o_totalprice)::BIGINT AS points_as FROM orders JOIN s USING (o_custkey) WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND o_custkey % 6 <> 5
    """,
)
def delta_job(spark, sf_dir):
    """A new finished round in which customers with an open order scored: only the reports of those in the squad are parsed."""
    lake = a_lake(spark)
    squad = competition_payload(spark, sf_dir).select(F.from_json("payload", "struct<data:struct<players:map<string,string>>>")["data"]["players"].alias("players"))
    players = squad.select(F.explode("players").alias("k", "v")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", F.from_json("v", flatten.PLAYER).withField("slug", F.concat(F.lit("c"), F.col("k"))).alias("v"))))).alias("players"))
    whole = players.select(F.concat(F.lit('{"data":{"season":{"rounds":[{"id":7,"name":"R7","status":"finished"},{"id":8,"name":"R8 (postponed)","status":"finished"}]},"teams":{},"players":'), "players", F.lit("}}")).alias("payload"))
    lake.raw.save("biwenger", "competition-data", "la-liga", whole.first().payload.encode(), day=DAY)
    scored = orders(spark, sf_dir).where("o_orderstatus = 'P'").select(F.struct(F.struct(F.col("o_custkey").alias("id"), F.lit("x").alias("name")).alias("player"), F.lit(3).alias("points")).alias("r")).distinct()
    side = F.struct(F.lit(1).alias("id"), F.lit("T").alias("name"), F.lit(1).alias("score"), F.col("rs").alias("reports"))
    game = F.array(F.struct(F.lit(50).alias("id"), side.alias("home"), side.alias("away")))
    rounds = scored.agg(F.collect_list("r").alias("rs")).select(F.to_json(F.struct(F.struct(F.lit(7).alias("id"), F.lit(1).alias("scoreID"), game.alias("games")).alias("data"))).alias("payload"))
    lake.raw.save("biwenger", "rounds", "la-liga-7-score1", rounds.first().payload.encode(), day=DAY)
    # the report payloads lie in one dated folder, written in parallel as files of a line each
    reports = reports_payload(spark, sf_dir).select(F.concat(F.lit("la-liga-c"), "name", F.lit("-2023")).alias("name"), "payload")
    lake.raw.save_all("biwenger", "player-reports", reports, day=DAY)
    jobs.ingest_reports_delta(lake, "la-liga", 2023)
    return lake.curated.read_table("fantasy_points").select("player_id", "match_id", "points_as")


@query(
    "rounds_job",
    """
    WITH o AS (SELECT year(o_orderdate) AS season, (year(o_orderdate) * 100 + month(o_orderdate)) * 10 + o_custkey % 4 AS round_id, o_custkey AS player_id, o_orderkey % 2 AS system, floor(o_totalprice)::BIGINT AS p FROM orders WHERE year(o_orderdate) IN (1996, 1997))
    SELECT season::VARCHAR AS season, round_id, player_id, max(p) FILTER (system = 0) AS points_as, max(p) FILTER (system = 1) AS points_sofascore FROM o WHERE round_id % 5 <> 0 AND round_id % 7 <> 0 GROUP BY ALL
    """,
)
def rounds_job(spark, sf_dir):
    """Two seasons of rounds in one raw layer, each ingested by itself: a catalogue says which are whose, and which are pending or postponed copies."""
    lake = a_lake(spark)
    year = F.year("day")
    o = orders(spark, sf_dir).where(year.isin(1996, 1997)).select(year.alias("season"), ((year * 100 + F.month("day")) * 10 + F.col("o_custkey") % 4).cast("long").alias("round"), F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 2 + 1).cast("int").alias("system"), F.floor("o_totalprice").alias("points"))
    status = F.when(F.col("round") % 5 == 0, "pending").otherwise("finished")
    name = line("Round ", text("round"), F.when(F.col("round") % 7 == 0, " (postponed)").otherwise(""))
    listed = o.select("season", "round").distinct().groupBy("season").agg(F.collect_list(F.struct(F.col("round").alias("id"), name.alias("name"), status.alias("status"))).alias("rounds"))
    best = o.groupBy("season", "round", "system", "id").agg(F.max("points").alias("points"))
    report = F.struct(F.struct("id", line("P", text("id")).alias("name")).alias("player"), "points")
    side = lambda reports: F.struct(F.lit(1).alias("id"), F.lit("T").alias("name"), F.lit(1).alias("score"), reports.alias("reports"))
    # a payload a round and system; its reports are dealt to games of bounded size
    games = best.groupBy("season", "round", "system", F.pmod(F.xxhash64("id"), F.lit(64)).alias("g")).agg(F.collect_list(report).alias("r")).withColumn("game", F.struct((F.col("round") * 64 + F.col("g")).alias("id"), side(F.col("r")).alias("home"), side(F.slice("r", 1, 0)).alias("away")))
    each = games.groupBy("season", "round", "system").agg(F.collect_list("game").alias("games")).join(listed, "season")
    body = F.struct(F.struct(F.col("round").alias("id"), name.alias("name"), F.col("system").alias("scoreID"), F.struct("rounds").alias("season"), "games").alias("data"))
    lake.raw.save_all("biwenger", "rounds", as_payload(each, line("la-liga-", text("round"), "-score", text("system")), body), day=DAY)
    first = o.where("round % 5 <> 0 and round % 7 <> 0").groupBy("season").agg(F.min("round").alias("round_id"))
    lake.curated.write_partitioned("fantasy_points", first.select("round_id", F.lit("la-liga").alias("competition"), text("season").alias("season")), ["competition", "season"])
    for season in (1996, 1997):
        jobs.ingest_rounds(lake, "la-liga", season)
    return lake.curated.read_table("fantasy_round_points").select("season", "round_id", "player_id", "points_as", "points_sofascore")


@query(
    "valuation_job",
    """
    SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'la-liga' WHEN s_suppkey % 3 = 1 THEN 'segunda-division' END AS competition, s_suppkey AS player_id, greatest(floor(s_acctbal), 0)::BIGINT AS market_value FROM supplier WHERE s_suppkey % 3 < 2
    """,
)
def valuation_job(spark, sf_dir):
    """Histories of suppliers, a third of them in the squads of each of two competitions and a third in none: each run takes its own members."""
    lake = a_lake(spark)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.greatest(F.floor("s_acctbal"), F.lit(0)).alias("value"))
    values = F.struct(F.array(F.struct(F.col("value").alias("y"), F.lit("01/02/2020").alias("datum_mw"), F.lit("C").alias("verein"))).alias("list"))
    lake.raw.save_all("transfermarkt", "market-value", as_payload(s, F.col("id"), values), day=DAY)
    competition = F.when(F.col("id") % 3 == 0, "la-liga").when(F.col("id") % 3 == 1, "segunda-division").otherwise("elsewhere")
    lake.curated.write_partitioned("transfermarkt_players", s.select(text("id").alias("id"), competition.alias("competition"), F.lit("2023").alias("season")), ["competition", "season"])
    for name in ("la-liga", "segunda-division"):
        jobs.ingest_valuation(lake, name)
    return lake.curated.read_table("market_values_tm").select("competition", "player_id", F.col("value").alias("market_value"))


@query(
    "crosscheck_job",
    """
    WITH s AS (SELECT o_custkey AS k, o_orderdate::DATE AS date, o_orderkey AS m FROM orders), j AS (SELECT a.m % 91 AS a, b.m % 91 AS b FROM s a JOIN s b USING (k, date) WHERE k % 3 = 0 AND a.m % 2 = 0 AND b.m % 91 > 0)
    SELECT count(*) AS common_rows, count_if(abs(a - b) <= 0.1 * b) AS within_tolerance, count_if(abs(a - b) > 0.1 * b) AS discrepancies FROM j
    """,
)
def crosscheck_job(spark, sf_dir):
    """Minutes of two sources over a lake, with the report saved as JSON: other competitions, other sources and players without an identity are left out."""
    lake = a_lake(spark)
    rows = orders(spark, sf_dir).select("o_custkey", "day", "o_orderkey", (F.col("o_orderkey") % 91).cast("double").alias("minutes"))
    canonical = F.when(F.col("o_custkey") % 3 == 0, line("p", text("o_custkey"))).otherwise("")
    stats = rows.select(canonical.alias("canonical_id"), F.col("day").alias("date"), "minutes", F.when(F.col("o_orderkey") % 2 == 0, "sofascore").otherwise("other").alias("source"))
    for competition in ("8", "7"):  # the second one is not covered
        lake.curated.write_table("player_match_stats", stats, {"competition": competition, "season": "77"})
    lake.curated.write_table("fantasy_points", rows.select(F.col("o_custkey").alias("player_id"), F.col("day").alias("date"), "minutes"), {"competition": "la-liga", "season": "2023"})
    known = rows.where("o_custkey % 3 = 0").select("o_custkey").distinct()
    lake.mappings.save({"players": known.select(line("p", text("o_custkey")).alias("canonical_id"), F.lit("biwenger").alias("fuente"), text("o_custkey").alias("id_en_fuente"), F.lit("auto").alias("metodo"), F.lit("d").alias("fecha"))})
    path = f"{lake.mappings.folder}/report.json"
    jobs.crosscheck(lake, path)
    with open(path, encoding="utf-8") as file:
        report = json.load(file)
    return spark.createDataFrame([(report["common_rows"], report["within_tolerance"], len(report["discrepancies"]))], "common_rows long, within_tolerance long, discrepancies long")


@query("squads_job", "SELECT c_custkey AS id, c_name AS name, c_nationkey::BIGINT AS club_id, 'N' || c_nationkey AS club_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS position FROM customer WHERE c_custkey % 4 > 0")
def squads_job(spark, sf_dir):
    """transfermarkt_players from pages alone: the competition's clubs, their squads, and the profiles that there are."""
    lake = a_lake(spark)
    c = table(spark, sf_dir, "customer")
    clubs = c.select("c_nationkey").distinct().withColumn("all", F.lit("ES1-saison-2023"))
    club = line('<tr><td class="hauptlink"><a href="/c/startseite/verein/', text("c_nationkey"), '">N', text("c_nationkey"), "</a></td></tr>")
    member = line('<tr><td><a href="/s/profil/spieler/', text("c_custkey"), '">x</a></td></tr>')
    put = lambda dataset, made: lake.raw.save_all("transfermarkt", dataset, made.select(F.col("page").alias("name"), F.col("html").alias("payload")), "html", DAY)
    put("competition-clubs", pages(clubs, "all", club))
    put("kader", pages(c, "c_nationkey", member).withColumn("page", line("verein-", F.col("page"), "-saison-2023")))
    position = F.when(F.col("c_custkey") % 3 > 0, line('<li class="data-header__label">Position:<span class="data-header__content">', F.col("c_mktsegment"), "</span></li>")).otherwise("")
    put("profile", c.where("c_custkey % 4 > 0").select(line("spieler-", text("c_custkey")).alias("page"), line('<h1 class="data-header__headline">', F.col("c_name"), "</h1>", position).alias("html")))
    jobs.ingest_squads(lake, "la-liga", 2023)
    return lake.curated.read_table("transfermarkt_players").select("id", "name", "club_id", "club_name", "position")


@query(
    "pending_matches",
    f"WITH {_FINISHED} SELECT event_id, date, season, greatest((SELECT count(*) FROM f WHERE event_id % 3 > 0) - 40, 0)::BIGINT AS deferred FROM f WHERE event_id % 3 > 0 ORDER BY date, event_id LIMIT 40",
)
def pending_matches(spark, sf_dir):
    """The 40 oldest finished matches without a line-up, a backfill's own limit; every third has one."""
    lake = a_lake(spark)
    k = F.col("o_orderkey")
    club = lambda i, name: F.struct(i.alias("id"), name.alias("name"))
    event = F.struct(
        k.alias("id"), F.col("at").alias("startTimestamp"), F.struct(F.when(F.col("o_orderstatus") == "O", "notstarted").otherwise("finished").alias("type")).alias("status"),
        club(F.col("o_custkey"), F.lit("H")).alias("homeTeam"), club(k % 50, F.lit("A")).alias("awayTeam"), F.struct(F.when(k % 11 > 0, club(F.lit(8), F.lit("L"))).alias("uniqueTournament")).alias("tournament"),
        F.struct(F.year("day").alias("id"), S.season_label(S.season_of(F.col("day"))).alias("year")).alias("season"),
    )
    each = orders(spark, sf_dir)
    lake.raw.save_all("sofascore", "tournament-events", as_payload(each.groupBy(F.year("day").alias("y"), page_of(k).alias("page")).agg(F.collect_list(event).alias("e")), F.concat_ws("-", "y", "page"), F.struct(F.col("e").alias("events"))), day=DAY)
    lake.raw.save_all("sofascore", "event-lineups", each.where(k % 3 == 0).select(text("o_orderkey").alias("name"), F.lit("{}").alias("payload")), day=DAY)
    first, deferred = jobs.pending_matches(lake, "tournament-events", "event-lineups", 40)
    return first.select("event_id", "date", "season", F.lit(deferred).cast("long").alias("deferred"))


# --- planned analytics ------------------------------------------------------------------------------------------------


@query("matches_since_return", "WITH r AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS d FROM orders WHERE o_orderstatus = 'P'), m AS (SELECT o_custkey AS k, o_orderdate::DATE AS d, o_orderkey FROM orders WHERE o_orderstatus = 'O'), j AS (SELECT m.*, (SELECT max(r.d) FROM r WHERE r.k = m.k AND r.d < m.d) AS last FROM m) SELECT o_orderkey, CASE WHEN last IS NOT NULL THEN count(*) OVER (PARTITION BY k, last ORDER BY d) END AS since_return FROM j")
def matches_since_return(spark, sf_dir):
    o = orders(spark, sf_dir).select(F.col("o_custkey").alias("player"), "day", "o_orderkey", "o_orderstatus")
    spells = o.where("o_orderstatus = 'P'").select("player", F.col("day").alias("until_date"))
    return analytics.since_return(o.where("o_orderstatus = 'O'").select("player", "day", "o_orderkey"), spells, "player", "day").select("o_orderkey", "since_return")


@query("team_levels", "WITH v AS (SELECT s_nationkey AS t, max(floor(s_acctbal)) AS v FROM supplier GROUP BY 1) SELECT c_custkey, a.v::BIGINT AS own_level, b.v::BIGINT AS opponent_level FROM customer LEFT JOIN v a ON a.t = c_nationkey LEFT JOIN v b ON b.t = (c_nationkey + 1) % 25")
def team_levels(spark, sf_dir):
    values = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("team_id"), F.lit("2023").alias("season"), F.floor("s_acctbal").alias("squad_value"))
    sides_ = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("team_id"), ((F.col("c_nationkey") + 1) % 25).alias("opponent_id"), F.lit("2023").alias("season"))
    return analytics.team_levels(sides_, values).select("c_custkey", "own_level", "opponent_level")


@query("team_density", "WITH s AS (SELECT o_orderdate::DATE AS date, unnest([o_custkey, 1000000 + o_orderkey % 50]) AS team_id FROM orders) SELECT team_id, date, date_diff('day', lag(date) OVER (PARTITION BY team_id ORDER BY date), date)::INT AS days_since FROM s")
def team_density(spark, sf_dir):
    games = orders(spark, sf_dir).select(F.col("o_orderkey").alias("event_id"), F.col("day").alias("date"), F.col("o_custkey").alias("home_team_id"), (1_000_000 + F.col("o_orderkey") % 50).alias("away_team_id"))
    return analytics.density(games).select("team_id", "date", "days_since")


@query("midweek_minutes", "SELECT o_custkey, date_trunc('week', o_orderdate)::DATE AS week, sum(o_orderkey % 91)::BIGINT AS minutes FROM orders WHERE isodow(o_orderdate) BETWEEN 2 AND 4 GROUP BY ALL")
def midweek_minutes(spark, sf_dir):
    played = orders(spark, sf_dir).select("o_custkey", "day", (F.col("o_orderkey") % 91).alias("minutes"))
    return analytics.midweek_minutes(played, ["o_custkey"], "day")


@query("start_accuracy", "SELECT event_type, round(avg(((value >= 20) = (event_id % 2 = 0))::INT), 6) AS accuracy, count(*) AS n FROM events WHERE ts >= '2024-01-15' GROUP BY event_type")
def start_accuracy(spark, sf_dir):
    """Judged on the days that the split keeps for it."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"), (F.col("value") / 40).alias("start_probability"), (F.col("event_id") % 2 == 0).alias("started"))
    _, later = analytics.temporal_split(e, "day", date(2024, 1, 15))
    found = analytics.start_accuracy(later.select("event_id", "event_type", "start_probability"), later.select("event_id", "started"), ["event_id"], ["event_type"])
    return found.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "season_projections",
    """
    WITH r AS (SELECT user_id, avg(value) AS m, quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM events WHERE ts < '2024-01-15' GROUP BY user_id), n AS (SELECT DISTINCT user_id, 30 + user_id % 60 AS minutes FROM events)
    SELECT user_id, round(minutes / 90 * m, 4) AS projected, round(minutes / 90 * lo, 4) AS p10, round(minutes / 90 * hi, 4) AS p90, round(4 * minutes / 90 * m, 3) AS season, 4::BIGINT AS rounds, 'v1' AS version FROM r JOIN n USING (user_id)
    """,
)
def season_projections(spark, sf_dir):
    """Minutes times performance, learned before the cutoff; the season is the sum of the rounds still to come, here four of seven."""
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), F.col("value").alias("per_90"))
    before, _ = analytics.temporal_split(e, "day", date(2024, 1, 15))
    minutes = e.select("user_id").distinct().select("user_id", (30 + F.col("user_id") % 60).alias("expected_minutes"))
    made = analytics.projections(minutes, before.select("user_id", "per_90"), ["user_id"], "v1")
    rounds = made.select("user_id", "version", "projected", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("round")).withColumn("done", F.col("round") <= 3)
    whole = analytics.season_projection(rounds, ["user_id"], "done").select("user_id", F.round("projected", 3).alias("season"), "rounds")
    return made.select("user_id", *[F.round(c, 4).alias(c) for c in ("projected", "p10", "p90")], "version").join(whole, "user_id")


@query(
    "similar_parts",
    """
    WITH s AS (SELECT p_brand, avg(p_size) AS a1, stddev_pop(p_size) AS s1, avg(p_retailprice) AS a2, stddev_pop(p_retailprice) AS s2 FROM part GROUP BY p_brand),
    z AS (SELECT p_brand, p_partkey, coalesce((p_size - a1) / nullif(s1, 0), 0) AS x, coalesce((p_retailprice - a2) / nullif(s2, 0), 0) AS y FROM part JOIN s USING (p_brand)),
    d AS (SELECT a.p_brand AS p_brand, a.p_partkey AS id, b.p_partkey AS other, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS distance FROM z a JOIN z b ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey)
    SELECT p_brand, id, place::INT AS place, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, id ORDER BY distance, other) AS place FROM d) WHERE place <= 3
    """,
)
def similar_parts(spark, sf_dir):
    found = neighbours.similar(table(spark, sf_dir, "part"), "p_brand", "p_partkey", ["p_size", "p_retailprice"], 3, CuratedStore(spark, scratch(spark)).staged, digits=None)
    return found.select("p_brand", "id", "place", F.round("distance", 6).alias("distance"))


@query(
    "active_models",
    """
    WITH e AS (SELECT event_type AS model, 'v' || (user_id % 5) AS version, CASE WHEN event_id % 3 = 0 THEN 'archive' ELSE 'activate' END AS event, event_id AS at_ FROM events),
    l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY model, version ORDER BY at_ DESC) = 1)
    SELECT model, version, at_ AS "at" FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY at_ DESC) AS k FROM l WHERE event = 'activate') WHERE k = 1
    """,
)
def active_models(spark, sf_dir):
    """The latest activation of each model that was not archived since."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("model"), line("v", (F.col("user_id") % 5).cast("string")).alias("version"), F.when(F.col("event_id") % 3 == 0, "archive").otherwise("activate").alias("event"), F.col("event_id").alias("at"))
    return analytics.active_models(e)


@query("status_histogram", "SELECT user_id, CASE event_type WHEN 'error' THEN 403 WHEN 'purchase' THEN 200 WHEN 'click' THEN 429 ELSE 0 END AS status, count(*) AS n FROM events GROUP BY ALL")
def status_histogram(spark, sf_dir):
    code = F.when(F.col("event_type") == "error", 403).when(F.col("event_type") == "purchase", 200).when(F.col("event_type") == "click", 429).otherwise(0)
    return analytics.status_histogram(table(spark, sf_dir, "events").select("user_id", code.alias("status")), ["user_id"], "status")


# --- streams ----------------------------------------------------------------------------------------------------------


@query("windowed_stream", "SELECT date_trunc('day', ts)::TIMESTAMP AS begin, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_stream(spark, sf_dir):
    """Windows of a file stream with a watermark; each batch upserts the windows that it changed."""
    base = scratch(spark)
    store = CuratedStore(spark, base)
    stream = incremental.new_files(spark, f"{sf_dir}/event[s].parquet", table(spark, sf_dir, "events").schema)
    counts = incremental.windowed_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    incremental.run_available(counts, f"{base}/checkpoint", incremental.latest_upsert(store, "windows", ["begin", "event_type"], "n", {"part": "all"}), "update")
    return store.read_partition("windows", {"part": "all"}).select(F.col("begin").cast("timestamp_ntz").alias("begin"), "event_type", "n")


@query("identities_before_points", "SELECT 'identity' AS kind, o_custkey AS id, count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL UNION ALL SELECT 'points', o_orderkey, 1 FROM orders WHERE o_orderstatus = 'F'")
def identities_before_points(spark, sf_dir):
    """A batch that comes twice is stored once, names before points."""
    store, where = CuratedStore(spark, scratch(spark)), {"competition": "c", "season": "2023"}
    batch = orders(spark, sf_dir).where("o_orderstatus = 'F'")
    write = incremental.identities_then_points(store, lambda df: df.select(F.col("o_custkey").alias("id")).distinct(), lambda df: df.select(F.col("o_orderkey").alias("round_id")), where)
    for number in range(2):
        write(batch, number)
    count = lambda kind, name, key: store.read_partition(name, where).groupBy(F.lit(kind).alias("kind"), F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return count("identity", "biwenger_players_history", "id").unionByName(count("points", "fantasy_round_points", "round_id"))
