"""Jobs and command line over a small lake of synthetic payloads."""

import datetime as dt
import json

import pytest

from canonlake import cli
from canonlake.plans import jobs
from tests.test_flatten import CLUBS, INJURIES, events_payload, lineups, round_payload

DAY = dt.date(2024, 1, 10)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    found = jobs.Lake(spark, f"file://{tmp_path}/lake", str(tmp_path / "mappings"))
    put = lambda source, dataset, name, body, ext="json": found.raw.save(source, dataset, name, body.encode() if isinstance(body, str) else json.dumps(body).encode(), ext, DAY)
    player = lambda i, name, team: {"id": i, "name": name, "slug": name.lower(), "teamID": team, "position": 2, "status": "ok", "price": 100 + i, "priceIncrement": 0}
    put("biwenger", "competition-data", "la-liga", {"data": {"players": {"1": player(1, "Ana", 7), "10": player(10, "P10", 7)}, "teams": {"7": {"id": 7, "name": "Real FC", "slug": "real"}}}})
    stats = {"minutesPlayed": 90, "sofascore": 7.0, "homeScore": 1, "awayScore": 0, "win": True, "lost": False}
    report = {"home": True, "match": {"id": 100, "date": 1_700_000_000, "round": {"id": 3, "name": "R"}}, "points": {"1": 4}, "rawStats": stats}
    put("biwenger", "player-reports", "la-liga-ana-2023", {"data": {"id": 1, "slug": "ana", "birthday": 19900101, "reports": [report], "prices": [[231001, 5]]}})
    put("biwenger", "rounds", "la-liga-3-score1", round_payload(1, (10, 5), (20, 2)))
    put("biwenger", "rounds", "la-liga-3-score2", round_payload(2, (10, 6), (20, 3)))
    put("transfermarkt", "market-value", "55", {"list": [{"y": 5, "datum_mw": "01/02/2020", "verein": "C"}]})
    put("transfermarkt", "injuries", "spieler-55", INJURIES, "html")
    put("transfermarkt", "competition-clubs", "ES1-saison-2023", CLUBS, "html")
    put("sofascore", "tournament-events", "8-77-last-0", events_payload())
    put("sofascore", "event-lineups", "100", lineups())
    cup = events_payload()
    cup["events"] = [{**cup["events"][0], "id": 900, "tournament": {"uniqueTournament": {"id": 7, "name": "CL"}}}]
    put("sofascore", "cup-events", "7-77-last-0", cup)
    put("sofascore", "cup-lineups", "900", lineups())
    seen = spark.createDataFrame([("55", "Ana Gomez", "418", "Real Madrid", "1990-01-01", "GK"), ("56", "Zed", "418", "Real Madrid", "", "GK")], "id string, name string, club_id string, club_name string, birth_date string, position string")
    found.curated.write_table("transfermarkt_players", seen, {"competition": "la-liga", "season": "2023"})
    return found


def test_a_season_end_to_end(lake, capsys):
    report = jobs.run_season(lake, "la-liga", 2023, DAY)
    assert report.ok, [r.render() for _, r in report.done]
    read = lake.curated.read_table
    assert rows(read("fantasy_points").select("player_id", "points_as", "minutes", "competition", "season")) == [(1, 4, 90, "la-liga", "2023")]
    assert rows(read("fantasy_round_points").select("player_id", "points_as", "points_sofascore")) == [(10, 5, 6), (20, 2, 3)]
    assert rows(read("biwenger_players").select("id", "birth_date")) == [(1, dt.date(1990, 1, 1)), (10, None)]
    assert rows(read("injuries_tm").select("player_id", "days")) == [(55, 12)]
    assert rows(read("player_match_stats").select("sofascore_player_id", "competition", "season")) == [(1, "8", "77"), (3, "8", "77")]
    assert rows(read("fixtures").select("event_id", "competition")) == [(100, "la-liga"), (900, "champions-league")]
    assert read("cup_minutes").count() == 2
    players = rows(lake.mappings.load("players").select("canonical_id", "fuente", "id_en_fuente", "metodo"))
    assert players == [("p00001", "biwenger", "1", "auto"), ("p00001", "transfermarkt", "55", "auto")]
    # 20 has left the squad: only the season's rounds name it
    assert rows(lake.mappings.load("players-review").select("biwenger_id", "motivo")) == [("10", "sin-candidato"), ("20", "sin-candidato")]
    assert rows(read("squad_values").select("club_id", "canonical_team_id")) == [(418, "t001")]
    # again: nothing changes, and a human decision on a review row is applied
    before = rows(read("fantasy_points"))
    review = lake.mappings.load("players-review").toPandas()
    review.loc[0, "decision"] = "56"
    lake.mappings.save({"players-review": lake.spark.createDataFrame(review)})
    assert jobs.run_season(lake, "la-liga", 2023, DAY).ok
    assert rows(read("fantasy_points")) == before
    assert ("p00002", "transfermarkt", "56", "manual") in rows(lake.mappings.load("players").select("canonical_id", "fuente", "id_en_fuente", "metodo"))
    base = ["--base", lake.raw.base, "--mappings", lake.mappings.folder]
    assert cli.main([*base, "newcomers", "--season", "2024", "--day", "2024-08-01", "--limit", "5"], lake.spark) == 0
    assert rows(read("newcomers").select("player_id", "history")) == [(10, "fallo")]
    assert cli.main([*base, "map-check"], lake.spark) == 1 and cli.main([*base, "crosscheck"], lake.spark) == 0
    assert "has no mapping" in capsys.readouterr().out


def test_third_source_attaches_and_creates_nothing(spark, tmp_path):
    lake = jobs.Lake(spark, f"file://{tmp_path}/lake", str(tmp_path / "m"))
    where = {"competition": "la-liga"}
    squad = [(1, "Ana Ruiz", 7, "1990-01-01"), (2, "Bea", 7, "1991-01-01"), (3, "Cid", 7, "1992-01-01"), (4, "Dan", 7, ""), (5, "Eva", 7, "")]
    lake.curated.write_table("biwenger_players", spark.createDataFrame(squad, "id long, name string, team_id long, birth_date string"), where)
    lake.curated.write_table("biwenger_teams", spark.createDataFrame([(7, "Real FC")], "id long, name string"), where)
    both = {**where, "season": "2023"}
    seen = [(11, "Ruiz", "1990-01-01", 70, "Real"), (12, "Bea Q", "2000-01-01", 70, "Real"), (13, "Eva X", "", 70, "Real")]
    lake.curated.write_table("sofascore_players", spark.createDataFrame(seen, "sofascore_player_id long, name string, birth_date string, team_id long, team_name string"), both)
    lake.curated.write_table("sofascore_teams", spark.createDataFrame([(70, "Real")], "team_id long, team_name string"), both)
    approved = [(f"p0000{i}", "biwenger", str(i), "auto", "d") for i in (1, 2, 3, 4)]
    schema = lake.mappings.load("players").schema
    review = [("4", "Dan", "7", "", "", "", "", "", "m", "skip"), ("5", "Eva", "7", "", "13", "Eva X", "Real", "", "m", "y")]
    lake.mappings.save({"players": spark.createDataFrame(approved, schema), "teams": spark.createDataFrame([("t001", "biwenger", "7", "auto", "d")], schema), "sofascore-review": spark.createDataFrame(review, lake.mappings.load("sofascore-review").schema)})
    result = jobs.map_third(lake, 2023, "today")
    assert result.stats == {"attached": 1, "pending": 1} and result.anomalies == {"unapplied_decisions": 1}
    theirs = lambda name: rows(lake.mappings.load(name).where("fuente = 'sofascore'").select("canonical_id", "id_en_fuente"))
    assert theirs("players") == [("p00001", "11")] and theirs("teams") == [("t001", "70")]
    assert rows(lake.mappings.load("sofascore-skips").select("canonical_id", "biwenger_name")) == [("p00004", "Dan")]
    assert rows(lake.mappings.load("sofascore-review").select("biwenger_id", "sofascore_id", "motivo", "decision")) == [("2", "12", "fecha-discrepante", ""), ("5", "13", "m", "y")]


def test_broken_payloads_fail_an_ingest_and_are_counted_by_a_rebuild(lake):
    lake.raw.save("biwenger", "rounds", "la-liga-4-score1", b"{}", day=DAY)
    assert jobs.ingest_rounds(lake, "la-liga", 2023).ok  # no round of this season
    lake.raw.save("biwenger", "rounds", "la-liga-3-score1", b"{}", day=DAY)
    with pytest.raises(ValueError):
        jobs.ingest_rounds(lake, "la-liga", 2023)
    lake.raw.save("sofascore", "event-lineups", "101", b"{}", day=DAY)
    assert jobs.curate_matches(lake).anomalies["broken_payloads"] == 1


def a_round(number, listed, player, points):
    payload = round_payload(1, (player, points), (20, 2))
    payload["data"] |= {"id": number, "season": {"rounds": [{"id": i, "name": n, "status": s} for i, n, s in listed]}}
    return json.dumps(payload).encode()


def a_report(player, number):
    report = {"home": True, "match": {"id": 100, "date": 1_700_000_000, "round": {"id": number, "name": "R"}}, "points": {"1": 4}, "rawStats": {"minutesPlayed": 90}}
    return json.dumps({"data": {"id": player, "slug": "x", "birthday": 19900101, "reports": [report], "prices": []}}).encode()


def test_rounds_belong_to_their_season(spark, tmp_path):
    lake = jobs.Lake(spark, f"file://{tmp_path}/lake", str(tmp_path / "m"))
    old = [(100, "R1", "finished"), (101, "R2", "finished"), (102, "R2 (postponed)", "finished"), (103, "R3", "pending")]
    new = [(200, "R1", None), (201, "R2", "finished")]
    for number, listed, player in ((100, old, 1), (101, old, 2), (102, old, 3), (103, old, 4), (200, new, 5), (201, new, 6)):
        lake.raw.save("biwenger", "rounds", f"la-liga-{number}-score1", a_round(number, listed, player, number), day=DAY)
    for season, number in ((2022, 100), (2023, 201)):
        lake.raw.save("biwenger", "player-reports", f"la-liga-ana-{season}", a_report(1, number), day=DAY)
    assert jobs.ingest_rounds(lake, "la-liga", 2021).failures == ["no report of la-liga 2021 names a round"]
    for season in (2022, 2023):
        assert jobs.ingest_rounds(lake, "la-liga", season).ok
    points = lambda: rows(lake.curated.read_table("fantasy_round_points").where("player_id <> 20").select("season", "round_id", "player_id"))
    want = [("2022", 100, 1), ("2022", 101, 2), ("2023", 200, 5), ("2023", 201, 6)]
    assert points() == want
    assert rows(lake.curated.read_table("biwenger_players_history").where("id <> 20").select("season", "id")) == [("2022", 1), ("2022", 2), ("2023", 5), ("2023", 6)]
    # a round that comes anew is taken; with resume, only that one is opened again
    lake.raw.save("biwenger", "rounds", "la-liga-100-score1", b"{}", day=DAY)
    lake.raw.save("biwenger", "rounds", "la-liga-101-score1", a_round(101, old, 2, 9), day=DAY)
    lake.raw.save("biwenger", "player-reports", "la-liga-bea-2022", a_report(2, 101), day=DAY)
    assert jobs.ingest_rounds(lake, "la-liga", 2022, resume=True).stats == {"rounds_skipped": 2}
    assert points() == want


def test_valuation_takes_the_members_of_the_competition(spark, tmp_path):
    lake = jobs.Lake(spark, f"file://{tmp_path}/lake", str(tmp_path / "m"))
    for competition, ids in (("la-liga", ["1", "2"]), ("segunda-division", ["3"])):
        lake.curated.write_table("transfermarkt_players", spark.createDataFrame([(i,) for i in ids], "id string"), {"competition": competition, "season": "2023"})
    for i in (1, 2, 3, 4):
        lake.raw.save("transfermarkt", "market-value", str(i), json.dumps({"list": [{"y": i, "datum_mw": "01/02/2020", "verein": "C"}]}).encode(), day=DAY)
        lake.raw.save("transfermarkt", "injuries", f"spieler-{i}", INJURIES.encode(), "html", DAY)
    assert jobs.ingest_player(lake, "2").ok is False  # no profile of 2 is stored
    lake.raw.save("transfermarkt", "profile", "spieler-4", b'<h1 class="data-header__headline">Dan</h1>', "html", DAY)
    assert jobs.ingest_player(lake, "4", force=True).rows["market_values_tm"] == 1
    stored = lambda table: rows(lake.curated.read_table(table).select("competition", "player_id"))
    assert stored("market_values_tm") == [("bajo-demanda", 4)]
    assert not jobs.ingest_valuation(lake, "premier").ok
    for competition in ("la-liga", "segunda-division"):
        assert jobs.ingest_valuation(lake, competition).ok
    want = [("bajo-demanda", 4), ("la-liga", 1), ("la-liga", 2), ("segunda-division", 3)]
    assert stored("market_values_tm") == want and sorted(set(stored("injuries_tm"))) == want
    # who comes into a squad later leaves the partition of those asked for one by one
    lake.curated.write_table("transfermarkt_players", spark.createDataFrame([("3",), ("4",)], "id string"), {"competition": "segunda-division", "season": "2024"})
    assert jobs.ingest_valuation(lake, "segunda-division").ok
    assert stored("market_values_tm") == [("la-liga", 1), ("la-liga", 2), ("segunda-division", 3), ("segunda-division", 4)]


def test_what_another_season_left_broken_does_no_harm(lake):
    lake.raw.save("biwenger", "player-reports", "la-liga-ana-2022", b"{}", day=DAY)
    assert jobs.ingest_reports(lake, "la-liga", 2023).ok
    with pytest.raises(ValueError):
        jobs.ingest_reports(lake, "la-liga", 2022)


def test_prices_of_the_day(lake):
    jobs.ingest_squad(lake, "la-liga")
    for day in (DAY, DAY + dt.timedelta(days=1), DAY):  # the same day again replaces itself
        assert jobs.ingest_prices(lake, "la-liga", 2023, day).rows == {"biwenger_prices": 2}
    found = rows(lake.curated.read_table("biwenger_prices").select("player_id", "date", "price"))
    assert found == [(1, DAY, 101), (1, DAY + dt.timedelta(days=1), 101), (10, DAY, 110), (10, DAY + dt.timedelta(days=1), 110)]
