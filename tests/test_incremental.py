"""Late pages, maintained sums, and refresh by difference."""

import glob
import itertools
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import fixture, team, write_pages
from pitchside import schemas as SC
from pitchside.operators import difference as DF
from pitchside.operators import maintained as MT
from pitchside.operators import merge as MG
from pitchside.operators import standings as ST
from pitchside.plans.jobs import Landing, fixture_job
from pitchside.sinks.tables import TableStore
from pitchside.sources import snapshot as SN
from pitchside.streaming.landing import start_fixture_stream, start_history_stream

NOW = time.time() - 10_000


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def teams_frame(spark, n=3):
    return SN.scan_teams(spark.createDataFrame([(i, f"T{i}", 3) for i in range(1, n + 1)], "id bigint, name string, strength bigint"))


def test_an_older_row_changes_nothing(spark):
    schema = "k long, v string, at struct<t:long,f:string>"
    target = spark.createDataFrame([(1, "a", (5, "x")), (2, "b", (5, "x")), (3, "c", None), (4, "d", (9, "x"))], schema)
    source = spark.createDataFrame([(1, "old", (4, "z")), (2, "tie", (5, "y")), (3, "any", (1, "a")), (5, "new", (1, "a")), (4, None, (10, "a"))], schema)
    got = {r.k: r.v for r in MG.upsert(target, source, ["k"], newer="at").collect()}
    assert got == {1: "a", 2: "tie", 3: "any", 4: None, 5: "new"}


FIXTURE_PAGES = [  # (page, landed): the first fixture's score is corrected twice, the third moves to another gameweek
    ([fixture(1, 1, 2, None, None, id=1), fixture(1, 3, 1, 2, 2, id=2)], 1),
    ([fixture(1, 1, 2, 3, 0, id=1), fixture(2, 2, 3, 1, 0, id=3)], 2),
    ([fixture(1, 1, 2, 3, 1, id=1), fixture(4, 2, 3, 1, 1, id=3)], 3),
]


@pytest.mark.parametrize("order", [(2, 1, 0), (1, 2, 0), (0, 1, 2)])
def test_fixture_pages_in_any_order(spark, scratch, order):
    teams = teams_frame(spark)
    landing, store = os.path.join(scratch, "landing"), TableStore(spark, os.path.join(scratch, "store"))
    for n in order:
        page, landed = FIXTURE_PAGES[n]
        write_pages(landing, {f"p{n}.json": page})
        os.utime(os.path.join(landing, f"p{n}.json"), (NOW + landed, NOW + landed))
        start_fixture_stream(spark, landing, teams, store, os.path.join(scratch, "ckpt")).awaitTermination(120)
    once = TableStore(spark, os.path.join(scratch, "once"))
    start_fixture_stream(spark, landing, teams, once, os.path.join(scratch, "ckpt2")).awaitTermination(120)
    for table, schema in (("fixture_info", SC.FIXTURE_INFO), ("team_info", SC.TEAM_INFO)):
        assert rows(store.read(table, schema).select(*schema.names)) == rows(once.read(table, schema).select(*schema.names)), table
    assert {r.home_team_id: (r.gameweek_id, r.away_team_score) for r in store.read("fixture_info").collect()} == {1: (1, 1), 3: (1, 2), 2: (4, 1)}
    # the maintained league is the league of the stored fixtures
    want = ST.league_from_scored(store.read("fixture_info", SC.FIXTURE_INFO), teams)
    assert rows(store.read("team_info", SC.TEAM_INFO)) == rows(want)


def test_history_pages_in_any_order(spark, scratch):
    def page(player, *points):
        return {"history": [{"element": player, "round": gw, "opponent_team": 9, "fixture": gw, "total_points": p,
                             "kickoff_time": f"2022-08-{gw:02d}T19:00:00Z"} for gw, p in enumerate(points, 1)]}

    pages = [(page(1, 2, 2), 1), (page(1, 2, 5, 6), 3), (page(2, 4), 2), (page(1, 2, 3), 2)]
    results = []
    for n, order in enumerate([(1, 0, 2, 3), (3, 1, 0, 2)]):
        landing, store = os.path.join(scratch, f"landing{n}"), TableStore(spark, os.path.join(scratch, f"store{n}"))
        for k in order:
            write_pages(landing, {f"p{k}.json": pages[k][0]})
            os.utime(os.path.join(landing, f"p{k}.json"), (NOW + pages[k][1],) * 2)
            start_history_stream(spark, landing, store, os.path.join(scratch, f"ckpt{n}")).awaitTermination(120)
        results.append(rows(store.read("player_gw_stats", SC.PLAYER_GW_STATS).select(*SC.names(SC.PLAYER_GW_STATS))))
    once = TableStore(spark, os.path.join(scratch, "once"))
    start_history_stream(spark, landing, once, os.path.join(scratch, "ckpt_once")).awaitTermination(120)
    want = rows(once.read("player_gw_stats", SC.PLAYER_GW_STATS).select(*SC.names(SC.PLAYER_GW_STATS)))
    assert results == [want] * 2
    assert {(r.player_id, r.gameweek_id): r.points for r in once.read("player_gw_stats").collect()} == {(1, 1): 2, (1, 2): 5, (1, 3): 6, (2, 1): 4}


def random_fixtures(rng, ids, teams=6):
    return [fixture(rng.randrange(1, 9), *rng.sample(range(1, teams + 1), 2), *rng.choice([(None, None), (rng.randrange(4), rng.randrange(4))]), id=i)
            for i in ids]


def test_maintained_league_after_any_order_of_loads(spark):
    rng = random.Random(3)
    teams = teams_frame(spark, 6)
    loads = [random_fixtures(rng, rng.sample(range(30), 14)) for _ in range(3)]
    stored_schema = SC.struct([*((f.name, f.dataType) for f in SC.parsed(SC.FIXTURE).fields), ("v", SC.L)])

    def frame(load, version):
        raw = spark.createDataFrame([{k: v for k, v in r.items() if k != "stats"} | {"v": version} for r in load],
                                    "id long, event long, team_h long, team_a long, team_h_score long, team_a_score long, v long")
        return MG.conform_to(stored_schema, raw).checkpoint()

    newest = {r["id"]: r for load in loads for r in load}
    want = rows(ST.league_table(frame(newest.values(), 0).drop("v"), teams))
    assert len(want) > 3
    for order in itertools.permutations(range(3)):
        stored, sums = spark.createDataFrame([], stored_schema), MT.team_sums(ST.fixture_frame(spark.createDataFrame([], stored_schema)))
        for n in order:
            changed = frame(loads[n], n)
            old, new = MT.replaced_rows(stored, changed, ["id"], newer="v")
            sums = MT.apply_changes(sums, ST.fixture_frame(old), ST.fixture_frame(new)).checkpoint()
            stored = MG.upsert(stored, changed, ["id"], newer="v").checkpoint()
        assert rows(ST.league_from_sums(sums, teams)) == want, order


def test_a_team_without_fixtures_left_drops_out(spark):
    one = spark.createDataFrame([(1, 1, 2, 2, 0)], "gameweek_id long, home_team_id long, away_team_id long, home_team_score long, away_team_score long")
    moved = one.withColumn("home_team_id", F.lit(3).cast("long"))
    sums = MT.apply_changes(MT.team_sums(one), one, moved)
    assert {r.team_id: (r.home_points, r.away_games) for r in sums.collect()} == {3: (3, 0), 2: (0, 1)}


def test_changed_groups_compare_bags_of_rows(spark):
    schema = "g long, a string, b long"
    old = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 1), (2, "x", 1), (3, None, 1), (4, "x", None), (None, "n", 1), (6, "q", 1)], schema)
    new = spark.createDataFrame([(1, "y", 2), (1, "x", 1), (2, "x", 1), (3, None, 1), (4, None, 1), (5, "x", 1), (None, "n", 2), (6, "q", 1)], schema)
    assert rows(DF.changed_groups(old, new, "g")) == sorted([
        (2, "changed", 2, 1), (4, "changed", 1, 1), (5, "new", 0, 1), (None, "changed", 1, 1)], key=str)
    assert rows(DF.changed_groups(old, old.repartition(3), "g")) == []
    assert rows(DF.changed_groups(old.limit(0), old, "g")) == sorted([(g, "new", 0, n) for g, n in ((1, 2), (2, 2), (3, 1), (4, 1), (None, 1), (6, 1))], key=str)


def test_an_equal_rerun_writes_nothing(spark, scratch):
    pages = {f"e{gw}.json": [fixture(gw, 1, 2, gw, 0, id=gw), fixture(gw, 2, 1, 1, 1, id=10 + gw)] for gw in (1, 2, 3)}
    boot = write_pages(os.path.join(scratch, "boot"), {"b.json": {"teams": [team(1), team(2)], "elements": [], "element_types": [], "events": []}})
    land = Landing(boot, write_pages(os.path.join(scratch, "fixtures"), pages))
    store = TableStore(spark, os.path.join(scratch, "store"))

    def files():
        return sorted(glob.glob(os.path.join(scratch, "store", "fixture_info", "**", "*.parquet"), recursive=True))

    fixture_job(spark, land, store)
    first, written = store.version("fixture_info"), files()
    fixture_job(spark, land, store)
    assert store.version("fixture_info") == first and files() == written
    # one gameweek changes, one goes, one comes: the others keep their folder
    write_pages(land.fixtures, {"e2.json": [fixture(2, 1, 2, 5, 5, id=2), fixture(2, 2, 1, 1, 1, id=12)],
                                "e3.json": [fixture(4, 1, 2, 3, 0, id=3), fixture(4, 2, 1, 1, 1, id=13)]})
    fixture_job(spark, land, store)
    parts = store.version("fixture_info")["parts"]
    assert set(parts) == {"1", "2", "4"} and parts["1"] == first["parts"]["1"] and parts["2"] == parts["4"] != parts["1"]
    got = store.read("fixture_info", SC.FIXTURE_INFO)
    assert sorted((r.gameweek_id, r.home_team_score) for r in got.collect()) == [(1, 1), (1, 1), (2, 1), (2, 5), (4, 1), (4, 3)]
