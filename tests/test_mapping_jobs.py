"""Jobs around squads, mapping, newcomers and deltas, from payloads and pages alone."""

import datetime as dt
import json

import pytest

from canonlake.operators import resolve
from canonlake.operators.integrity import IntegrityError
from canonlake.plans import jobs
from canonlake.sources import curated, html
from tests.test_flatten import CLUBS, INJURIES, PROFILE, SQUAD

DAY = dt.date(2024, 1, 10)
WHERE = {"competition": "la-liga"}
SEASON = {**WHERE, "season": "2023"}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lake(spark, f"file://{tmp_path}/lake", str(tmp_path / "m"))


def put(lake, source, dataset, name, body, ext="json"):
    lake.raw.save(source, dataset, name, body.encode() if isinstance(body, str) else json.dumps(body).encode(), ext, DAY)


def table(lake, name, data, schema, where):
    lake.curated.write_table(name, lake.spark.createDataFrame(data, schema), where)


def relation(lake, name, data):
    return lake.spark.createDataFrame(data, lake.mappings.load(name).schema)


SQUADS = "id long, name string, team_id long, birth_date string"
TEAMS = "id long, name string"


def member(player, name):
    return SQUAD.replace("/spieler/44", f"/spieler/{player}").replace("Juan P", name)


def test_squads_come_from_pages_and_map_finds_them(lake):
    put(lake, "transfermarkt", "competition-clubs", "ES1-saison-2023", CLUBS, "html")
    put(lake, "transfermarkt", "kader", "verein-418-saison-2023", SQUAD, "html")
    put(lake, "transfermarkt", "profile", "spieler-44", PROFILE, "html")
    table(lake, "transfermarkt_players", [(99, "gone")], "id long, name string", SEASON)
    result = jobs.ingest_squads(lake, "la-liga", 2023)
    assert result.ok and result.stats == {"retired": 1}
    got = lake.curated.read_partition("transfermarkt_players", SEASON).select("id", "slug", "name", "birth_date", "position", "shirt_number", "club_id", "club_name")
    assert rows(got) == [(44, "juan-p", "Juan P", dt.date(2001, 4, 12), "Keeper", 9, 418, "Real M")]
    table(lake, "biwenger_players", [(1, "Juan P", 7, "2001-04-12")], SQUADS, WHERE)
    table(lake, "biwenger_teams", [(7, "Real M FC")], TEAMS, WHERE)
    jobs.map_entities(lake, 2023, "d")
    assert rows(lake.mappings.load("players").select("canonical_id", "fuente", "id_en_fuente")) == [("p00001", "biwenger", "1"), ("p00001", "transfermarkt", "44")]
    assert rows(lake.mappings.load("teams").select("canonical_id", "fuente", "id_en_fuente")) == [("t001", "biwenger", "7"), ("t001", "transfermarkt", "418")]


def test_a_crawl_with_gaps_retires_nobody(lake):
    two = CLUBS.replace("<tr><td>none</td></tr>", '<tr><td class="hauptlink"><a href="/b/startseite/verein/500">Betis</a></td></tr>')
    put(lake, "transfermarkt", "competition-clubs", "ES1-saison-2023", two, "html")
    put(lake, "transfermarkt", "kader", "verein-418-saison-2023", SQUAD, "html")
    table(lake, "transfermarkt_players", [(99, "stays"), (44, "old name")], "id long, name string", SEASON)
    result = jobs.ingest_squads(lake, "la-liga", 2023)
    assert result.stats == {"retired": 0} and result.anomalies == {"clubs_without_squad": 1, "players_without_profile": 1}
    assert rows(lake.curated.read_partition("transfermarkt_players", SEASON).select("id")) == [(44,), (99,)]
    put(lake, "transfermarkt", "kader", "verein-500-saison-2023", member(45, "Bea"), "html")
    put(lake, "transfermarkt", "profile", "spieler-45", PROFILE, "html")
    assert jobs.ingest_squads(lake, "la-liga", 2023, max_clubs=1).stats == {"retired": 0}  # a capped trial
    assert jobs.ingest_squads(lake, "la-liga", 2023).stats == {"retired": 1}  # 44 was seen, though without a profile
    assert not jobs.ingest_squads(lake, "la-liga", 2022).ok


def test_history_of_the_season_is_mapped_too(lake):
    table(lake, "biwenger_players", [(1, "Ana", 7, "1990-01-01")], SQUADS, WHERE)
    table(lake, "biwenger_teams", [(7, "Real")], TEAMS, WHERE)
    table(lake, "biwenger_players_history", [(1, "Old Ana", 9, ""), (2, "Bea", 8, "")], SQUADS, SEASON)
    table(lake, "biwenger_players_history", [(3, "Cid", 8, "")], SQUADS, {**WHERE, "season": "2022"})
    table(lake, "biwenger_teams_history", [(8, "Betis")], TEAMS, SEASON)
    seen = [("55", "Ana R", "418", "Real", "1990-01-01", ""), ("56", "Bea S", "419", "Betis", "", "")]
    table(lake, "transfermarkt_players", seen, "id string, name string, club_id string, club_name string, birth_date string, position string", SEASON)
    jobs.map_entities(lake, 2023, "d")
    # Bea is found by the club of that year; Cid belongs to the pass of another season
    assert rows(lake.mappings.load("players").where("fuente = 'transfermarkt'").select("id_en_fuente")) == [("55",), ("56",)]
    assert lake.mappings.load("players").where("id_en_fuente = '3'").count() == 0


def test_teams_go_to_review_and_decisions_on_them_are_applied(lake):
    table(lake, "biwenger_teams", [(1, "Real"), (2, "Real Madrid"), (3, "Atlas"), (4, "Sol"), (5, "Mar")], TEAMS, WHERE)
    clubs = [("a", "x", str(c), n) for c, n in ((10, "Real Madrid"), (20, "Sol Norte"), (21, "Sol Sur"))]
    table(lake, "transfermarkt_players", [(f"{i}{c[2]}", c[1], c[2], c[3]) for i, c in enumerate(clubs)], "id string, name string, club_id string, club_name string", SEASON)
    first = jobs.map_entities(lake, 2023, "d")
    want = [("1", "10", "candidato-compartido"), ("2", "10", "candidato-compartido"), ("3", "", "sin-candidato"), ("4", "20", "varios-candidatos"), ("4", "21", "varios-candidatos"), ("5", "", "sin-candidato")]
    assert rows(lake.mappings.load("teams-review").select("biwenger_id", "tm_club_id", "motivo")) == want and first.stats["teams_in_review"] == 5
    marked = lake.mappings.load("teams-review").toPandas()
    decide = {("2", "10"): "y", ("3", ""): "skip", ("4", "21"): "y", ("5", ""): "500"}
    marked["decision"] = [decide.get((a, b), "") for a, b in zip(marked["biwenger_id"], marked["tm_club_id"])]
    lake.mappings.save({"teams-review": lake.spark.createDataFrame(marked)})
    second = jobs.map_entities(lake, 2023, "d")
    got = rows(lake.mappings.load("teams").select("fuente", "id_en_fuente", "metodo"))
    assert got == sorted([("biwenger", "2", "manual"), ("transfermarkt", "10", "manual"), ("biwenger", "3", "manual"), ("biwenger", "4", "manual"), ("transfermarkt", "21", "manual")], key=repr)
    assert second.anomalies == {"unapplied_decisions": 1}  # ids are for players only
    assert rows(lake.mappings.load("teams-review").select("biwenger_id", "tm_club_id", "motivo", "decision")) == [("1", "", "sin-candidato", ""), ("5", "", "sin-candidato", "500")]


def test_third_source_reviews_and_skips_teams(lake):
    table(lake, "biwenger_teams", [(1, "Real"), (2, "Sol"), (3, "Mar"), (4, "Eco")], TEAMS, WHERE)
    table(lake, "sofascore_teams", [(20, "Sol Norte"), (21, "Sol Sur"), (30, "Mar A"), (31, "Mar B")], "team_id long, team_name string", SEASON)
    own = [(f"t00{i}", "biwenger", str(i), "auto", "d") for i in (1, 2, 3)]
    review = [("3", "Mar", "la-liga", "30", "Mar A", "m", "skip"), ("4", "Eco", "la-liga", "31", "Mar B", "m", "y")]
    lake.mappings.save({"teams": relation(lake, "teams", own), "sofascore-teams-review": relation(lake, "sofascore-teams-review", review)})
    result = jobs.map_third(lake, 2023, "d")
    assert rows(lake.mappings.load("sofascore-skips").select("canonical_id", "biwenger_name")) == [("t003", "Mar")]
    assert result.anomalies == {"unapplied_decisions": 1}  # Eco has no canonical id
    got = rows(lake.mappings.load("sofascore-teams-review").select("biwenger_id", "sofascore_team_id", "decision"))
    assert got == [("2", "20", ""), ("2", "21", ""), ("4", "31", "y")]
    marked = lake.mappings.load("sofascore-teams-review").toPandas()
    marked["decision"] = ["y" if t == "21" else d for t, d in zip(marked["sofascore_team_id"], marked["decision"])]
    lake.mappings.save({"sofascore-teams-review": lake.spark.createDataFrame(marked)})
    jobs.map_third(lake, 2023, "d")
    assert ("t002", "21", "manual") in rows(lake.mappings.load("teams").where("fuente = 'sofascore'").select("canonical_id", "id_en_fuente", "metodo"))


def test_contradictions_in_files_are_found_on_load(lake):
    good = [("p00001", "biwenger", "1", "auto", "d"), ("p00001", "sofascore", "5", "auto", "d")]
    skip = lambda *ids: relation(lake, "sofascore-skips", [(i, "n", "d") for i in ids])
    lake.mappings.save({"players": relation(lake, "players", good)})
    for bad in (skip("p00001"), skip("p00002", "p00002"), skip("x1")):
        with pytest.raises(IntegrityError):
            lake.mappings.save({"sofascore-skips": bad})
    lake.mappings.save({"sofascore-skips": skip("p00002", "t001")})
    assert lake.mappings.load("players").count() == 2
    with open(f"{lake.mappings.folder}/players.csv", "a") as file:  # a person edits the file
        file.write("p00002,sofascore,5,manual,d\n")
    for name in ("players", "teams", "sofascore-skips"):
        with pytest.raises(IntegrityError):
            lake.mappings.load(name)
    assert jobs.run_steps([jobs.Step("check", lambda: jobs.check_coverage(lake))]).pending == [] and not jobs.run_steps([jobs.Step("check", lambda: jobs.check_coverage(lake))]).ok


def test_coverage_looks_at_own_people_past_and_present_and_at_statistics(lake):
    assert jobs.check_coverage(lake).ok
    table(lake, "biwenger_players", [(1, "Ana", 7, ""), (2, "Bea", 7, "")], SQUADS, WHERE)
    table(lake, "biwenger_teams", [(7, "Real")], TEAMS, WHERE)
    table(lake, "biwenger_players_history", [(1, "Ana", 7, ""), (3, "Cid", 7, "")], SQUADS, SEASON)
    table(lake, "biwenger_teams_history", [(7, "Real"), (8, "Sol")], TEAMS, SEASON)
    table(lake, "player_match_stats", [(50,), (51,)], "sofascore_player_id long", {"competition": "8", "season": "77"})
    table(lake, "player_season_stats", [(51,), (52,)], "sofascore_player_id long", {"competition": "8", "season": "77"})
    table(lake, "transfermarkt_players", [("90", "nobody's")], "id string, name string", SEASON)
    lake.mappings.save({"players": relation(lake, "players", [("p00001", "biwenger", "1", "auto", "d"), ("p00001", "sofascore", "50", "auto", "d")])})
    got = rows(jobs.coverage(lake).select("kind", "id"))
    assert got == sorted([("biwenger_players", "2"), ("biwenger_players_history", "3"), ("biwenger_teams", "7"), ("biwenger_teams_history", "8"), ("sofascore", "51"), ("sofascore", "52")])
    assert len(jobs.check_coverage(lake).failures) == 6


def test_newcomers_move_from_state_to_state(lake):
    table(lake, "biwenger_players", [(1, "Ana", 7, ""), (2, "Bea", 7, ""), (3, "Cid", 7, "")], SQUADS, WHERE)
    table(lake, "fantasy_points", [(1,)], "player_id long", {**WHERE, "season": "2022"})
    states = lambda: dict(rows(lake.curated.read_table("newcomers").select("player_id", "history")))
    capped = jobs.detect_newcomers(lake, "la-liga", 2023, DAY, 1)
    assert capped.rows == {"newcomers": 1} and capped.stats == {"deferred": 1} and states() == {2: "sin-identidad"}
    assert jobs.detect_newcomers(lake, "la-liga", 2023, DAY).rows == {"newcomers": 2}
    lake.mappings.save({"players": relation(lake, "players", [("p00001", "biwenger", "2", "auto", "d"), ("p00001", "sofascore", "50", "auto", "d"), ("p00002", "biwenger", "3", "auto", "d")])})
    assert jobs.detect_newcomers(lake, "la-liga", 2023, DAY).rows == {"newcomers": 2} and states() == {2: "sin-historial", 3: "fallo"}
    table(lake, "player_match_stats", [("p00001", 50)], "canonical_id string, sofascore_player_id long", {"competition": "8", "season": "77"})
    assert jobs.detect_newcomers(lake, "la-liga", 2023, DAY).rows == {"newcomers": 2} and states() == {2: "descargado", 3: "fallo"}
    assert jobs.detect_newcomers(lake, "la-liga", 2023, DAY).rows == {"newcomers": 1} and states()[2] == "descargado"


def delta_payloads(lake):
    player = lambda i: {"id": i, "name": f"P{i}", "slug": f"p{i}", "teamID": 7, "position": 2}
    rounds = [{"id": 3, "name": "R3", "status": "finished"}, {"id": 4, "name": "R4 (postponed)", "status": "finished"}, {"id": 5, "name": "R5", "status": "pending"}]
    put(lake, "biwenger", "competition-data", "la-liga", {"data": {"season": {"rounds": rounds}, "players": {"1": player(1), "2": player(2)}, "teams": {}}})
    side = lambda *ids: {"id": 1, "name": "T", "slug": "t", "score": 1, "reports": [{"player": {"id": i, "name": "x", "slug": "x", "position": 1}, "points": 3} for i in ids]}
    put(lake, "biwenger", "rounds", "la-liga-3-score1", {"data": {"id": 3, "scoreID": 1, "games": [{"id": 50, "home": side(1), "away": side(9)}]}})
    report = {"home": True, "match": {"id": 100, "date": 1_700_000_000, "round": {"id": 3, "name": "R"}}, "points": {"1": 4}, "rawStats": {"minutesPlayed": 90}}
    for i in (1, 2):
        put(lake, "biwenger", "player-reports", f"la-liga-p{i}-2023", {"data": {"id": i, "slug": f"p{i}", "birthday": 0, "reports": [report], "prices": []}})


def test_a_delta_refreshes_those_who_scored(lake):
    delta_payloads(lake)
    first = jobs.ingest_reports_delta(lake, "la-liga", 2023)
    assert first.rows == {"fantasy_points": 1} and first.stats == {"refreshed": 1, "skipped": 1, "outside_squad": 1}
    assert rows(lake.curated.read_table("fantasy_points").select("player_id", "round_id")) == [(1, 3)]
    again = jobs.ingest_reports_delta(lake, "la-liga", 2023)
    assert again.rows == {"fantasy_points": 0} and again.stats == {"refreshed": 0, "skipped": 2}


def test_season_statistics_of_a_player(lake):
    put(lake, "sofascore", "player-seasons", "50", {"uniqueTournamentSeasons": [{"uniqueTournament": {"id": 8, "name": "L"}, "seasons": [{"id": 77, "year": "23/24"}, {"id": 78, "year": "22/23"}]}]})
    put(lake, "sofascore", "player-overall", "50-8-77", {"statistics": {"id": 1, "goals": 4, "rating": "7", "won": True}})
    put(lake, "sofascore", "player-ratings", "50-8-77", {"seasonRatings": [{"eventId": 100, "startTimestamp": 1_700_000_000, "rating": 7.5, "isHome": True, "opponent": {"id": 2, "name": "A"}}, {"eventId": 101, "rating": 6.0}]})
    put(lake, "sofascore", "event-player-stats", "100-50", {"statistics": {"minutesPlayed": 90, "goals": 1, "totalPass": "12"}})
    lake.mappings.save({"players": relation(lake, "players", [("p00001", "sofascore", "50", "auto", "d")])})
    for _ in range(2):
        assert jobs.ingest_season_stats(lake, "50").rows == {"player_season_stats": 1, "player_match_stats": 2}
    season = lake.curated.read_table("player_season_stats")
    assert rows(season.select("canonical_id", "season_year", "metrics", "competition", "season")) == [("p00001", "23/24", {"goals": 4.0, "won": 1.0}, "8", "77")]
    matches = lake.curated.read_table("player_match_stats").select("player_event", "opponent_id", "rating", "goals", "shots", "passes", "minutes")
    assert rows(matches) == [("50_100", 2, 7.5, 1.0, 0.0, None, 90.0), ("50_101", None, 6.0, None, None, None, None)]


def test_one_player_is_stored_only_if_the_births_agree(lake):
    put(lake, "transfermarkt", "profile", "spieler-44", PROFILE, "html")
    put(lake, "transfermarkt", "injuries", "spieler-44", INJURIES, "html")
    put(lake, "transfermarkt", "market-value", "44", {"list": [{"y": 5, "datum_mw": "01/02/2020", "verein": "C"}]})
    put(lake, "transfermarkt", "market-value", "445", {"list": [{"y": 6, "datum_mw": "01/02/2020", "verein": "C"}]})
    stored = lambda: jobs.ingest_player(lake, "https://x/juan/profil/spieler/44", "on-demand").stats
    assert stored() == {"identity_unmapped": 1}
    assert rows(lake.curated.read_table("market_values_tm").select("player_id", "value", "competition")) == [(44, 5, "on-demand")]
    lake.mappings.save({"players": relation(lake, "players", [("p00001", "biwenger", "1", "auto", "d"), ("p00001", "transfermarkt", "44", "auto", "d")])})
    table(lake, "biwenger_players_history", [(1, "Juan", 7, "2001-04-12")], SQUADS, SEASON)
    assert jobs.ingest_player(lake, "p00001", "on-demand").stats == {"identity_agrees": 1}
    table(lake, "biwenger_players_history", [(1, "Juan", 7, "2001-04-13")], SQUADS, SEASON)
    assert not jobs.ingest_player(lake, "44", "on-demand").ok
    assert jobs.ingest_player(lake, "44", "on-demand", force=True).stats == {"identity_differs": 1}
    assert not jobs.ingest_player(lake, "p00009", "x").ok and not jobs.ingest_player(lake, "who", "x").ok


def test_cross_check_report_is_saved(lake, tmp_path):
    day = dt.date(2024, 1, 1)
    stats = [("p00001", day, 90.0, "sofascore"), ("p00002", day, 10.0, "sofascore"), ("", day, 9.0, "sofascore"), ("p00003", day, 1.0, "other")]
    schema = "canonical_id string, date date, minutes double, source string"
    table(lake, "player_match_stats", stats, schema, {"competition": "8", "season": "77"})
    table(lake, "player_match_stats", [("p00003", day, 1.0, "sofascore")], schema, {"competition": "7", "season": "77"})
    table(lake, "fantasy_points", [(i, day, 90.0) for i in (1, 2, 3)], "player_id long, date date, minutes double", SEASON)
    lake.mappings.save({"players": relation(lake, "players", [(f"p0000{i}", "biwenger", str(i), "auto", "d") for i in (1, 2, 3)])})
    result, _ = jobs.crosscheck(lake, str(tmp_path / "r/report.json"))
    assert not result.ok and result.stats == {"common_rows": 2, "within_tolerance": 1}  # other sources and competitions are left out
    saved = json.loads((tmp_path / "r/report.json").read_text())
    assert saved["share"] == 0.5 and saved["discrepancies"] == [{"canonical_id": "p00002", "date": "2024-01-01", "minutes_a": 10.0, "minutes_b": 90.0}]


class Stop(Exception):
    pass


@pytest.mark.parametrize("after", range(4))
def test_a_write_that_stops_anywhere_leaves_old_or_new_rows(lake, monkeypatch, after):
    table(lake, "t", [(1,)], "x int", WHERE)
    store, steps = lake.curated, 0
    at = store._at

    class Files:
        """File system calls that change something; the call after the given number of them never returns."""

        def __init__(self, real):
            self.real = real

        def __getattr__(self, name):
            def call(*args):
                nonlocal steps
                if name in ("rename", "delete"):
                    if steps == after:
                        raise Stop
                    steps += 1
                return getattr(self.real, name)(*args)

            return call

    monkeypatch.setattr(store, "_at", lambda path: (lambda w, f: (w, Files(f)))(*at(path)))
    with pytest.raises(Stop):
        table(lake, "t", [(2,)], "x int", WHERE)
    opened = curated.CuratedStore(lake.spark, lake.raw.base)
    assert rows(opened.read_table("t").select("x")) == [(2,)]
    opened.write_table("t", lake.spark.createDataFrame([(3,)], "x int"), WHERE)
    assert rows(opened.read_table("t").select("x")) == [(3,)]


def test_pages_of_any_depth_and_unreadable_amounts(spark):
    deep = "<div>" * 3000 + CLUBS + "</div>" * 3000
    assert html.competition_clubs(deep) == html.competition_clubs(CLUBS)
    broken = CLUBS.replace("€1.33bn", "€1.2.3m").replace("€20.5m", "no")
    pages = spark.createDataFrame([("a", deep), ("b", broken)], "page string, html string")
    assert rows(html.parse_pages(pages, "competition-clubs").select("page", "squad_value")) == [("a", 1_330_000_000), ("b", None)]


def test_numbering_over_many_ranges(spark):
    mapping = spark.createDataFrame([("p00010",)], "canonical_id string")
    new = spark.range(500).selectExpr("lpad(cast(id as string), 4, '0') as id").repartition(7)
    got = rows(resolve.numbered(new, mapping, "p", 5, ["id"]))
    assert got == [(f"{k:04d}", f"p{k + 11:05d}") for k in range(500)]


def test_a_player_is_found_by_name_id_or_canonical_id(lake):
    hit = lambda i, name, sport="football", kind="player": {"type": kind, "entity": {"id": i, "name": name, "team": {"sport": {"slug": sport}}}}
    put(lake, "sofascore", "search", "ana-ruiz", {"results": [hit(50, "Ana Ruiz Gil"), hit(51, "Bea"), hit(52, "Ana Ruiz", "tennis"), hit(53, "Ana Ruiz", kind="team")]})
    put(lake, "sofascore", "search", "bea", {"results": [hit(60, "Bea A"), hit(61, "Bea B")]})
    lake.mappings.save({"players": relation(lake, "players", [("p00001", "sofascore", "50", "auto", "d")])})
    assert jobs.found_player(lake, "Ana Ruiz") == ("50", []) and jobs.found_player(lake, "p00001") == ("50", []) and jobs.found_player(lake, "77") == ("77", [])
    assert jobs.found_player(lake, "Bea")[1] == ["Bea: several candidates, name one by its id", "60: Bea A", "61: Bea B"]
    assert not jobs.ingest_season_stats(lake, "p00009").ok and not jobs.ingest_season_stats(lake, "Nobody").ok


def test_a_capped_backfill_and_a_probe(lake, capsys):
    from canonlake import cli
    from tests.test_flatten import events_payload

    more = [{**events_payload()["events"][0], "id": i, "startTimestamp": 1_700_000_000 + 86_400 * i} for i in (200, 201, 202)]
    put(lake, "sofascore", "tournament-events", "8-77-last-0", events_payload(*more))
    put(lake, "sofascore", "event-lineups", "200", {})
    base = ["--base", lake.raw.base, "--mappings", lake.mappings.folder]
    assert cli.main([*base, "backfill", "--limit", "2"], lake.spark) == 0
    assert rows(lake.curated.read_table("pending_matches").select("event_id", "kind")) == [(100, "leagues"), (201, "leagues")]
    assert "deferred: 1" in capsys.readouterr().out
    assert cli.main([*base, "backfill-cups"], lake.spark) == 0
    put(lake, "probe", "attempts", "direct", {"attempts": [{"status": 200, "at": 0}, {"status": 429, "at": 150}]})
    assert cli.main([*base, "probe-report", "direct"], lake.spark) == 0 and cli.main([*base, "probe-report", "none"], lake.spark) == 1
    said = capsys.readouterr().out
    assert "verdict viable: 1" in said and "took 2 min 30 s: 1" in said


def test_run_cycles(lake):
    delta_payloads(lake)
    report = jobs.run_incremental(lake, "round", "la-liga", 2023, DAY)
    assert report.ok and [name for name, _ in report.done] == ["squad", "delta", "rounds", "matches", "catalog", "cups"]
    weekly = jobs.run_incremental(lake, "weekly", "la-liga", 2023, DAY)
    assert [name for name, r in weekly.done if not r.ok] == ["squads"] and weekly.pending[0] == "valuation"
