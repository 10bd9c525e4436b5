"""Command line: ``python -m canonlake.cli --base file:///lake COMMAND``. Exit status 0 if all is well, 1 if a step failed."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, date, datetime

from canonlake import session
from canonlake.plans import jobs
from canonlake.plans.orchestrator import Result

#: Commands: what they run, and whether they need a competition and a season.
COMMANDS = {
    "ingest-squad": (lambda lake, a: jobs.ingest_squad(lake, a.competition), True, False),
    "ingest-reports": (lambda lake, a: jobs.ingest_reports(lake, a.competition, a.season), True, True),
    "ingest-rounds": (lambda lake, a: jobs.ingest_rounds(lake, a.competition, a.season, a.resume), True, True),
    "ingest-delta": (lambda lake, a: jobs.ingest_reports_delta(lake, a.competition, a.season), True, True),
    "ingest-squads": (lambda lake, a: jobs.ingest_squads(lake, a.competition, a.season, a.limit), True, True),
    "ingest-player": (lambda lake, a: jobs.ingest_player(lake, a.player, a.competition, a.force), False, False),
    "ingest-season-stats": (lambda lake, a: jobs.ingest_season_stats(lake, a.player), False, False),
    "ingest-prices": (lambda lake, a: jobs.ingest_prices(lake, a.competition, a.season, a.day), True, True),
    "ingest-valuation": (lambda lake, a: jobs.ingest_valuation(lake, a.competition), True, False),
    "ingest-squad-values": (lambda lake, a: jobs.ingest_squad_values(lake, a.competition, a.season, a.day), True, True),
    "backfill": (lambda lake, a: jobs.plan_backfill(lake, False, a.limit), False, False),
    "backfill-cups": (lambda lake, a: jobs.plan_backfill(lake, True, a.limit), False, False),
    "probe-report": (lambda lake, a: jobs.probe_report(lake, a.player), False, False),
    "curate-catalog": (lambda lake, a: jobs.curate_catalog(lake), False, False),
    "curate-matches": (lambda lake, a: jobs.curate_matches(lake), False, False),
    "curate-cups": (lambda lake, a: jobs.curate_cups(lake), False, False),
    "curate-canonical": (lambda lake, a: jobs.restamp(lake), False, False),
    "crosscheck": (lambda lake, a: jobs.crosscheck(lake, a.report)[0], False, False),
    "newcomers": (lambda lake, a: jobs.detect_newcomers(lake, a.competition, a.season, a.day, a.limit), True, True),
    "map": (lambda lake, a: jobs.map_entities(lake, a.season, a.day.isoformat()), False, True),
    "map-third": (lambda lake, a: jobs.map_third(lake, a.season, a.day.isoformat()), False, True),
    "map-check": (lambda lake, a: jobs.check_coverage(lake), False, False),
    "run-round": (lambda lake, a: jobs.run_incremental(lake, "round", a.competition, a.season, a.day), True, True),
    "run-weekly": (lambda lake, a: jobs.run_incremental(lake, "weekly", a.competition, a.season, a.day), True, True),
    "run": (lambda lake, a: jobs.run_season(lake, a.competition, a.season, a.day), True, True),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="canonlake")
    out.add_argument("--base", required=True, help="file:// or s3:// folder of the lake")
    out.add_argument("--mappings", default="mappings", help="folder of the mapping files")
    out.add_argument("--master", help="only for local use")
    commands = out.add_subparsers(dest="command", required=True)
    for name, (_, competition, season) in COMMANDS.items():
        sub = commands.add_parser(name)
        if competition:
            sub.add_argument("--competition", default=jobs.TRACKED_LEAGUE)
        if season:
            sub.add_argument("--season", type=int, required=True, help="start year")
        sub.add_argument("--day", type=date.fromisoformat, default=datetime.now(UTC).date())
        if name in ("newcomers", "ingest-squads", "backfill", "backfill-cups"):
            sub.add_argument("--limit", type=int, help="people, clubs or matches that this run takes at most")
        if name in ("ingest-player", "ingest-season-stats", "probe-report"):
            sub.add_argument("player", metavar="NAME", help="an id, a canonical id, a profile link (ingest-player), a name (ingest-season-stats), or the name of a probe")
        if name == "ingest-rounds":
            sub.add_argument("--resume", action="store_true", help="leave rounds alone that are stored already")
        if name == "ingest-player":
            sub.add_argument("--competition", default=jobs.ON_DEMAND)
            sub.add_argument("--force", action="store_true", help="store it even if birth dates differ")
        if name == "crosscheck":
            sub.add_argument("--report", help="file for the report as JSON")
    return out


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    lake = jobs.Lake(spark or session.build(args.master), args.base, args.mappings)
    told = COMMANDS[args.command][0](lake, args)
    if isinstance(told, Result):
        print(told.render())
        return 0 if told.ok else 1
    for name, result in told.done:
        print(f"[{'ok' if result.ok else 'failed'}] {name}\n{result.render()}")
    for name in told.pending:
        print(f"[pending] {name}")
    return 0 if told.ok else 1


if __name__ == "__main__":
    sys.exit(main())
