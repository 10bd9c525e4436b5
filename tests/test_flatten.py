"""Payloads to rows, by small synthetic payloads."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from canonlake.operators import flatten
from canonlake.plans import analytics
from canonlake import queries
from canonlake.sources import html


def payloads(spark, *docs):
    return spark.createDataFrame([(n, json.dumps(d) if not isinstance(d, str) else d) for n, d in docs], "name string, payload string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_squad_without_coaches_and_broken_payloads(spark):
    player = {"id": 1, "name": "A", "slug": "a", "teamID": 7, "position": 2, "status": "ok", "price": 5, "priceIncrement": 0, "unknown": {"x": 1}}
    good, bad = flatten.parsed(payloads(spark, ("x", {"data": {"players": {"1": player, "2": {**player, "id": 2, "position": 5}}, "teams": {"7": {"id": 7, "name": "T", "slug": "t"}}}}), ("y", {"data": {"players": {}}}), ("z", "no json")), "competition")
    assert rows(flatten.squad(good).select("name", "id", "team_id", "points")) == [("A", 1, 7, None)]
    assert rows(flatten.teams(good).select("id", "slug")) == [(7, "t")]
    assert rows(bad) == [("y",), ("z",)]


def test_reports_prices_and_birthday(spark):
    stats = {"minutesPlayed": 90, "sofascore": 7.1, "homeScore": 2, "awayScore": 1, "win": True, "lost": False}
    match = {"id": 5, "date": 1_700_000_000, "round": {"id": 3, "name": "R"}}
    reports = [
        {"home": True, "match": match, "points": {"1": 4, "2": None, "5": 6}, "rawStats": stats},
        {"home": True, "match": {**match, "id": 6}},
        {"home": False, "match": {**match, "id": 8}, "points": {"1": 1}},
    ]
    detail = {"data": {"id": 9, "slug": "s", "birthday": 19990228, "reports": reports, "prices": [[250630, 10], [250701, 11]]}}
    good, _ = flatten.parsed(payloads(spark, ("p", detail)), "reports")
    points, anomalies = flatten.fantasy_points(good)
    assert rows(points) == [(9, 5, 3, 4, None, None, 6, None, 90, 7.1, True, 2, 1, "win", dt.date(2023, 11, 14))]
    assert rows(anomalies) == [(9, 1)]
    assert rows(flatten.prices(good, 2025)) == [(9, dt.date(2025, 7, 1), 11)]
    assert rows(flatten.birth_dates(good)) == [(9, dt.date(1999, 2, 28))]


def round_payload(system, *players, score=(2, 0)):
    team = lambda i, s, ps: {"id": i, "name": f"T{i}", "slug": f"t{i}", "score": s, "reports": [{"player": {"id": p, "name": f"P{p}", "slug": f"p{p}", "position": 1}, "points": pts} for p, pts in ps]}
    return {"data": {"id": 3, "scoreID": system, "games": [{"id": 50, "home": team(1, score[0], players[:1]), "away": team(2, score[1], players[1:])}]}}


def test_round_points_unite_systems(spark):
    good, _ = flatten.parsed(payloads(spark, ("a", round_payload(1, (10, 5), (20, 2))), ("b", round_payload(2, (10, None), (20, 3), (30, 1)))), "round")
    sides = flatten.round_sides(good)
    got = flatten.round_points(sides).select("player_id", "team_id", "home", "points_as", "points_sofascore", "points_social", "result")
    assert rows(got) == [(10, 1, True, 5, None, None, "win"), (20, 2, False, 2, 3, None, "loss"), (30, 2, False, None, 1, None, "loss")]
    players, teams = flatten.round_identities(sides)
    assert rows(players.select("id", "team_id")) == [(10, 1), (20, 2), (30, 2)] and rows(teams.select("id")) == [(1,), (2,)]
    assert rows(flatten.scoring_players(sides)) == [(10,), (20,), (30,)]


def events_payload(*extra):
    event = {"id": 100, "startTimestamp": 1_700_000_000, "status": {"type": "finished"}, "homeTeam": {"id": 1, "name": "H"}, "awayTeam": {"id": 2, "name": "A"}, "tournament": {"uniqueTournament": {"id": 8, "name": "L"}}, "season": {"id": 77, "year": "23/24"}}
    return {"events": [event, {**event, "id": 101, "status": {"type": "notstarted"}}, {**event, "id": 102, "season": None}, *extra], "hasNextPage": False}


def lineups():
    entry = lambda i, stats, sub=False, team=None: {"player": {"id": i, "name": f"P{i}", "dateOfBirthTimestamp": 0}, "teamId": team, "substitute": sub, "statistics": stats}
    return {"confirmed": True, "home": {"players": [entry(1, {"minutesPlayed": 90, "goals": 2, "rating": 7.5, "nested": {"a": 1}}, team=999), entry(2, {}, True)]}, "away": {"players": [entry(None, {"minutesPlayed": 1}), entry(3, {"totalPass": 11}, None)]}}


def test_lineups_become_match_stats_catalog_and_cup_minutes(spark):
    good, _ = flatten.parsed(payloads(spark, ("e", events_payload())), "events")
    events = flatten.finished_events(good)
    assert rows(events.select("event_id", "season", "date")) == [(100, "2023", dt.date(2023, 11, 14))]
    sheets, _ = flatten.parsed(payloads(spark, ("100", lineups()), ("abc", lineups()), ("555", lineups())), "lineups")
    entries = flatten.lineup_entries(sheets, events)
    approved = spark.createDataFrame([("1", "p00001")], "id_en_fuente string, canonical_id string")
    stats = flatten.match_stats(entries, approved, "s")
    assert rows(stats.select("player_event", "canonical_id", "is_home", "opponent_id", "goals", "passes", "minutes", "expected_goals", "rating")) == [
        ("1_100", "p00001", True, 2, 2.0, 0.0, 90.0, None, 7.5),
        ("3_100", "", False, 1, 0.0, 11.0, None, None, None),
    ]
    players, teams = analytics.identity_catalog(entries, F.lit("cup"))
    assert rows(players.select("source_player_id", "team_id", "birth_date")) == [(1, 1, dt.date(1970, 1, 1)), (2, 1, dt.date(1970, 1, 1)), (3, 2, dt.date(1970, 1, 1))] and teams.count() == 2
    tracked = spark.createDataFrame([(2, "2023")], "team_id long, season string")
    assert rows(analytics.cup_minutes(flatten.played(entries), tracked, approved).select("player_event", "is_starting", "minutes")) == [("3_100", False, None)]


def test_season_metrics_keep_numbers_only(spark):
    good, _ = flatten.parsed(payloads(spark, ("1-8-77", {"statistics": {"id": 3, "type": "x", "goals": 4, "won": True, "text": "no", "rating": 7.25}})), "overall")
    assert rows(flatten.season_metrics(good)) == [("1-8-77", "goals", 4.0), ("1-8-77", "rating", 7.25), ("1-8-77", "won", 1.0)]


def test_values_transfers_and_availability(spark):
    good, _ = flatten.parsed(payloads(spark, ("7", {"list": [{"y": 5, "datum_mw": "01/02/2020", "verein": "C"}]})), "values")
    assert rows(flatten.market_values(good)) == [(7, dt.date(2020, 2, 1), 5, "C")]
    move = {"dateUnformatted": "2020-01-02", "season": "19/20", "fee": "End of loan", "marketValue": "-", "from": {"clubName": "A", "href": "/a/verein/1"}, "to": {"clubName": "B", "href": ""}}
    good, _ = flatten.parsed(payloads(spark, ("7", {"transfers": [move]})), "transfers")
    assert rows(flatten.transfers(good)) == [(7, dt.date(2020, 1, 2), "19/20", "end of loan", "End of loan", "-", 1, "A", None, "B")]
    game = {"gameInformation": {"gameId": "g", "competitionId": "ES1", "date": {"dateTimeUTC": "2024-05-06T20:00:00Z"}}, "clubsInformation": {"club": {"clubId": "1"}, "opponent": {"clubId": "x"}}, "statistics": {"generalStatistics": {"participationState": "brand new"}, "playingTimeStatistics": {"isStarting": False, "substitutedIn": {"minute": 60}}}}
    good, _ = flatten.parsed(payloads(spark, ("7", {"data": {"playerId": 7, "performance": [game]}})), "performance")
    assert rows(flatten.availability(good).select("game_id", "date", "opponent_club_id", "participation_state", "is_starting", "substituted_in_minute")) == [("g", dt.date(2024, 5, 6), None, "brand new", False, 60)]


CLUBS = '<table class="items"><thead><tr><td>x</td></tr></thead><tbody><tr><td class="hauptlink no"><a title="Real" href="/r/startseite/verein/418">Real M</a></td><td>25</td><td class="rechts">€20.5m</td><td class="rechts"><a>€1.33bn</a></td></tr><tr><td>none</td></tr></tbody></table>'
SQUAD = '<table class="items"><tbody><tr><td><div class="rn_nummer">9</div></td><td><table class="inline-table"><tr><td><a href="/juan-p/profil/spieler/44">Juan P</a></td></tr><tr><td>Centre-Forward</td></tr></table></td></tr><tr><td>no link</td></tr></tbody></table>'
PROFILE = '<h1 class="data-header__headline-wrapper"><span class="data-header__shirt-number">#1</span> Juan <strong>P</strong></h1><span itemprop="birthDate">12/04/2001 (25)</span><li class="data-header__label">Position:<span class="data-header__content">Keeper</span></li>'
INJURIES = '<table class="items"><tbody><tr><td>23/24</td><td>Knee</td><td>01/02/2024</td><td>-</td><td>12 days</td><td>-</td></tr><tr><td>short</td></tr></tbody></table>'


def test_pages(spark):
    assert html.competition_clubs(CLUBS) == [{"club_id": 418, "club_name": "Real M", "squad_value": 1_330_000_000}]
    assert html.squad_page(SQUAD) == [{"player_id": 44, "slug": "juan-p", "name": "Juan P", "position": "Centre-Forward", "shirt_number": 9}]
    assert html.profile_page(PROFILE) == [{"name": "Juan P", "birth_date": "12/04/2001", "position": "Keeper"}]
    assert html.injuries_page(INJURIES) == [{"season": "23/24", "injury": "Knee", "from_date": "01/02/2024", "until_date": "-", "days": 12, "games_missed": None}]
    assert html.injuries_page("<p>none</p>") == []
    with pytest.raises(html.FormatError):
        html.squad_page("<table></table>")
    pages = spark.createDataFrame([("a", CLUBS), ("b", "<p>"), ("c", None)], "page string, html string")
    assert [(r.page, r.club_id, bool(r.error)) for r in html.parse_pages(pages, "competition-clubs").orderBy("page").collect()] == [("a", 418, False), ("b", None, True), ("c", None, True)]


def test_the_title_query_keeps_references_that_its_sql_keeps(spark, tmp_path):
    titles = ["a &amp; b", "a&amp", "&quot;x&quot; &#65;", "&amp;amp; &copy", "plain"]
    pages = [(i, f'<html><title>{t}</title><p>x &lt; y<a href="u">z</a></html>') for i, t in enumerate(titles)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {int(r.page): r.title for r in queries.html_fields(spark, f"file://{tmp_path}").collect()}
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert found == {int(r[0]): r[1] for r in con.sql(queries.ORACLES["html_fields"]).fetchall()}
    assert found[2] == "&quot;x&quot; &#65;" and html.links(pages[2][1])[0]["title"] == '"x" A'
