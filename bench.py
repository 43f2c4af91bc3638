"""Benchmark the headline queries.

Runs each query of HEADLINE on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed
in full with the ``noop`` sink (no collect to the driver); the time per query is
the best of ``$BENCH_REPEAT`` runs (default 3) after one warm-up pass on the
smallest data.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitchside.plans import queries  # noqa: E402
from pitchside.session import local_session  # noqa: E402

HEADLINE = [
    "league_table", "fixture_info", "player_info", "player_gw_stats", "gw_stats",
    "rank_max", "gameweek_counts", "upsert_team", "upsert_player", "upsert_gameweek",
    "upsert_player_gw",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus)
    qs = queries()
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            run(qs[name](spark, warm))
    times = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
