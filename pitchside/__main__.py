"""Command line: run the batch jobs, one per result-table family.

    python -m pitchside all --bootstrap s3a://…/bootstrap/ \
        --fixtures s3a://…/fixtures/ --history s3a://…/element-summary/ \
        --store s3a://…/tables/ --csv s3a://…/csv/ --date 2024-01-02

The session comes from ``getOrCreate`` (the cluster's spark-defaults decide the
master); ``--local N`` builds a local session instead.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from .plans.jobs import Landing, fixture_job, gameweek_job, player_gw_job, player_job
from .session import RECOMMENDED_CONF, local_session
from .sinks.jdbc import publish
from .sinks.tables import TableStore

TABLES = {"fixtures": ["fixture_info", "team_info"], "players": ["player_info"],
          "player-gw": ["player_gw_stats"], "gameweeks": ["gw_stats"]}
JOBS = tuple(TABLES)


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="pitchside", description=__doc__.splitlines()[0])
    ap.add_argument("job", choices=JOBS + ("all",))
    ap.add_argument("--bootstrap", required=True, help="landed bootstrap documents")
    ap.add_argument("--fixtures", help="landed fixture pages")
    ap.add_argument("--history", help="landed element-summary pages")
    ap.add_argument("--store", required=True, help="root folder of the result tables")
    ap.add_argument("--csv", help="root folder of the CSV snapshots (optional)")
    ap.add_argument("--date", default=dt.date.today().isoformat(), help="snapshot date")
    ap.add_argument("--json-lines", action="store_true", help="pages are JSON Lines")
    ap.add_argument("--strict", action="store_true", help="bad values raise instead of null")
    ap.add_argument("--on-duplicate", choices=("error", "latest"), default="error",
                    help="two games of a player against one opponent in one gameweek")
    ap.add_argument("--gameweeks", type=int, nargs=2, metavar=("FIRST", "LAST"), help="bounds of the fixture pages")
    ap.add_argument("--players", type=int, nargs=2, metavar=("FIRST", "LAST"), help="bounds of the player pages")
    ap.add_argument("--jdbc", metavar="URL", help="also replace the tables of this database")
    ap.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE", help="user, driver, ...")
    ap.add_argument("--local", type=int, metavar="CPUS", help="run on a local session")
    args = ap.parse_args(argv)

    if args.local:
        spark = local_session(args.local)
    else:
        builder = SparkSession.builder.appName("pitchside")
        for k, v in RECOMMENDED_CONF.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    landing = Landing(bootstrap=args.bootstrap, fixtures=args.fixtures, history=args.history,
                      multi_line=not args.json_lines, strict=args.strict)
    store = TableStore(spark, args.store)
    todo = JOBS if args.job == "all" else (args.job,)
    done = {}
    for job in todo:
        if job == "fixtures":
            done[job] = fixture_job(spark, landing, store, args.date, args.csv,
                                    gameweeks=tuple(args.gameweeks) if args.gameweeks else None)
        elif job == "players":
            done[job] = player_job(spark, landing, store, args.date, args.csv)
        elif job == "player-gw":
            done[job] = player_gw_job(spark, landing, store, args.date, args.csv,
                                      players=tuple(args.players) if args.players else None,
                                      on_duplicate=args.on_duplicate)
        elif job == "gameweeks":
            done[job] = gameweek_job(spark, landing, store, args.csv)
        if args.jdbc:
            publish(store, TABLES[job], args.jdbc, dict(o.split("=", 1) for o in args.jdbc_option))
    print(json.dumps({"commits": done, "tables": store.state()["tables"]}, default=str))
    return done


if __name__ == "__main__":
    main()
