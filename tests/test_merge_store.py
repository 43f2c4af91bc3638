"""Keyed merge semantics, the versioned table store, jobs and the stream."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import fixture, team, write_pages
from pitchside import schemas as SC
from pitchside.operators import merge as MG
from pitchside.plans.jobs import Landing, fixture_job, gameweek_job, player_gw_job, player_job
from pitchside.sinks.files import with_row_index, write_snapshot
from pitchside.sinks.tables import CommitConflict, TableStore
from pitchside.sources import snapshot as SN
from pitchside.streaming.landing import start_fixture_stream

KV = "k bigint, v string"


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_upsert_partial(spark):
    # target keys 1,2; source keys 2,3 with a null value at 2.
    target = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    source = spark.createDataFrame([(2, None), (3, "c")], KV)
    out = MG.upsert(target, source, ["k"])
    assert as_set(out) == {(1, "a"), (2, None), (3, "c")}
    assert as_set(MG.upsert(out, source, ["k"])) == as_set(out)      # idempotent


def test_upsert_duplicate_source_key_fails(spark):
    target = spark.createDataFrame([(1, "a")], KV)
    source = spark.createDataFrame([(2, "x"), (2, "y")], KV)
    with pytest.raises(Exception, match="duplicate key"):
        MG.upsert(target, source, ["k"]).collect()


def test_upsert_null_key_fails_unless_allowed(spark):
    target = spark.createDataFrame([(1, "a")], KV)
    source = spark.createDataFrame([(None, "x")], KV)
    with pytest.raises(Exception, match="null key"):
        MG.upsert(target, source, ["k"]).collect()
    out = MG.upsert(target, source, ["k"], allow_null_keys=True)
    assert as_set(out) == {(1, "a"), (None, "x")}


def test_upsert_latest(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k bigint, v string, t bigint")
    source = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1), (2, "y", 1)],
                                   "k bigint, v string, t bigint")
    out = MG.upsert(target, source, ["k"], on_duplicate="latest", order_by=["t"])
    # full tie on t for key 2: broken by the remaining columns ('y' > 'x')
    assert as_set(out) == {(1, "new", 2), (2, "y", 1)}


def test_composite_key_same_opponent_twice(spark):
    schema = "player_id bigint, gameweek_id bigint, opponent_id bigint, points bigint"
    target = spark.createDataFrame([(1, 1, 5, 2)], schema)
    source = spark.createDataFrame([(1, 2, 5, 3), (1, 2, 5, 1)], schema)
    with pytest.raises(Exception, match="duplicate key"):
        MG.upsert(target, source, SC.PLAYER_GW_STATS_KEY).collect()


def test_conform_to_target(spark):
    src = spark.createDataFrame([("7", "x", 1.9)], "k string, extra string, v double")
    out = MG.conform_to(SC.struct([("k", SC.L), ("v", SC.L), ("w", SC.S)]), src)
    assert out.columns == ["k", "v", "w"] and tuple(out.first()) == (7, 1, None)


def test_store_commit_and_failed_run(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "store"))
    schema = SC.struct([("k", SC.L), ("v", SC.S)])
    store.upsert("t", spark.createDataFrame([(1, "a"), (2, "b")], schema), ["k"], schema)
    v1 = store.version("t")
    # a failing run (duplicate key) stages nothing visible
    with pytest.raises(Exception):
        store.upsert("t", spark.createDataFrame([(3, "c"), (3, "d")], schema), ["k"], schema)
    assert store.version("t") == v1
    store.upsert("t", spark.createDataFrame([(2, "B"), (3, "c")], schema), ["k"], schema)
    assert as_set(store.read("t")) == {(1, "a"), (2, "B"), (3, "c")}
    # the old version is still readable as it was
    assert as_set(spark.read.parquet(store.path("t", v1))) == {(1, "a"), (2, "b")}
    with pytest.raises(CommitConflict):
        store.commit({"t": v1}, base_seq=1)


def test_row_index_and_snapshot(spark, scratch):
    df = spark.range(0, 50, 1, 5).select(((F.col("id") * 7) % 50).alias("k"))
    out = with_row_index(df, ["k"])
    assert [tuple(r) for r in out.orderBy("index").collect()] == [(i, i) for i in range(50)]
    path = write_snapshot(spark.createDataFrame([(1, [1, 2])], "a bigint, b array<bigint>"),
                          os.path.join(scratch, "csv"), "2024-01-02")
    back = spark.read.option("header", True).csv(path).first()
    assert path.endswith("snapshot_date=2024-01-02") and back.b == "[1,2]"
    bom = write_snapshot(spark.createDataFrame([(1, "é")], "a bigint, b string"),
                         os.path.join(scratch, "csv_bom"), "2024-01-02", bom=True)
    blobs = []
    for p in sorted(os.listdir(bom)):
        if p.endswith(".csv"):
            with open(os.path.join(bom, p), "rb") as f:
                blobs.append(f.read())
    assert blobs and all(b.startswith(b"\xef\xbb\xbfa,b\n") for b in blobs)
    assert any("é".encode() in b for b in blobs)
    assert spark.read.option("header", True).option("encoding", "UTF-8").csv(bom).first().b == "é"


def land(scratch, teams, fixture_pages, elements=(), events=(), history=None):
    write_pages(os.path.join(scratch, "bootstrap"), {"b.json": {
        "teams": teams, "elements": list(elements),
        "element_types": [{"id": 1, "plural_name_short": "DEF"}], "events": list(events)}})
    write_pages(os.path.join(scratch, "fixtures"), fixture_pages)
    write_pages(os.path.join(scratch, "history"), history or {"p.json": {"history": []}})
    return Landing(bootstrap=os.path.join(scratch, "bootstrap"),
                   fixtures=os.path.join(scratch, "fixtures"),
                   history=os.path.join(scratch, "history"))


def test_jobs_end_to_end_and_rerun(spark, scratch):
    pages = {"e1.json": [fixture(1, 1, 2, 2, 1, id=1), fixture(1, 2, 1, None, None, id=2)],
             "e2.json": [fixture(2, 2, 1, 0, 0, id=3)]}
    el = [{"id": 7, "first_name": "A", "element_type": 1, "team": 1, "influence": "1.5"}]
    ev = [{"id": 1, "deadline_time": "2022-08-05T17:30:00Z", "average_entry_score": 50}]
    hist = {"p7.json": {"history": [
        {"element": 7, "round": 1, "opponent_team": 2, "fixture": 1,
         "kickoff_time": "2022-08-05T19:00:00Z", "total_points": 6}]}}
    landing = land(scratch, [team(1), team(2)], pages, el, ev, hist)
    store = TableStore(spark, os.path.join(scratch, "store"))
    csv = os.path.join(scratch, "csv")
    fixture_job(spark, landing, store, "2024-01-01", csv)
    player_job(spark, landing, store, "2024-01-01", csv)
    player_gw_job(spark, landing, store, "2024-01-01", csv)
    gameweek_job(spark, landing, store, csv, with_index=True)
    tables = {t: as_set(store.read(t)) for t in
              ("team_info", "fixture_info", "player_info", "player_gw_stats", "gw_stats")}
    assert len(tables["team_info"]) == 2 and len(tables["fixture_info"]) == 3
    assert {r.team_id: r.total_points for r in store.read("team_info").collect()} == {1: 4, 2: 1}
    assert store.read("player_gw_stats").first().points == 6
    # a second run over the same pages changes nothing
    fixture_job(spark, landing, store, "2024-01-01", csv)
    player_job(spark, landing, store, "2024-01-01", csv)
    player_gw_job(spark, landing, store, "2024-01-01", csv)
    gameweek_job(spark, landing, store, csv)
    assert {t: as_set(store.read(t)) for t in tables} == tables
    assert os.path.isdir(os.path.join(csv, "team_data", "snapshot_date=2024-01-01"))


def test_fixture_stream_replay_is_idempotent(spark, scratch):
    landing = os.path.join(scratch, "landing")
    write_pages(landing, {"e1.json": [fixture(1, 1, 2, None, None, id=1),
                                      fixture(1, 2, 1, 1, 1, id=2)]})
    teams = spark.createDataFrame([], SC.parsed(SC.TEAM)).unionByName(
        SN.scan_teams(spark.createDataFrame([(1, "A", 3), (2, "B", 3)],
                                            "id bigint, name string, strength bigint")))
    store = TableStore(spark, os.path.join(scratch, "store"))
    ckpt = os.path.join(scratch, "ckpt")
    q = start_fixture_stream(spark, landing, teams, store, ckpt)
    q.awaitTermination(120)
    assert {r.team_id: r.total_points for r in store.read("team_info").collect()} == {1: 1, 2: 1}
    # the first match is played later: the page lands again, with the score
    time.sleep(1.1)
    write_pages(landing, {"e1_again.json": [fixture(1, 1, 2, 3, 0, id=1)]})
    q = start_fixture_stream(spark, landing, teams, store, ckpt)
    q.awaitTermination(120)
    got = {r.team_id: r.total_points for r in store.read("team_info").collect()}
    assert got == {1: 4, 2: 1}
    assert store.read("fixture_info").count() == 2
    seq = store.state()["seq"]
    # replaying a committed batch is a no-op
    from pitchside.streaming.landing import fixture_batch
    fixture_batch(spark, store, teams)(spark.createDataFrame([], "a int"), 0)
    assert store.state()["seq"] == seq


def test_partitioned_upsert_touches_only_its_partitions(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "store"))
    schema = SC.struct([("p", SC.L), ("k", SC.L), ("v", SC.S)])
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], schema)
    store.commit({"t": store.stage_upsert_partitions("t", first, ["p", "k"], schema, "p")})
    parts1 = store.version("t")["parts"]
    second = spark.createDataFrame([(2, 1, "C"), (3, 1, "d")], schema)
    store.commit({"t": store.stage_upsert_partitions("t", second, ["p", "k"], schema, "p")})
    parts2 = store.version("t")["parts"]
    assert parts2["1"] == parts1["1"] and parts2["2"] != parts1["2"] and parts2["3"] == parts2["2"]
    want = {(1, 1, "a"), (1, 2, "b"), (2, 1, "C"), (3, 1, "d")}
    assert as_set(store.read("t", schema).select("p", "k", "v")) == want
    assert store.version_count("t") == 2
    assert store.compact_if_needed("t", schema, max_versions=2) is None
    store.compact_if_needed("t", schema, max_versions=1)
    assert store.version_count("t") == 1
    assert as_set(store.read("t", schema).select("p", "k", "v")) == want


def test_history_stream(spark, scratch):
    from pitchside.streaming.landing import start_history_stream

    def page(player, games):
        return {"history": [{"element": player, "round": gw, "opponent_team": opp, "fixture": fx,
                             "kickoff_time": f"2022-08-{10 + fx:02d}T19:00:00Z",
                             "total_points": pts} for gw, opp, fx, pts in games]}

    landing = os.path.join(scratch, "landing")
    write_pages(landing, {"p1.json": page(1, [(1, 5, 1, 2), (2, 6, 2, 3), (2, 7, 3, 1)]),
                          "p2.json": page(2, [(1, 6, 1, 7)]),
                          # player 3's page landed twice in one batch: the newer wins whole
                          "p3_old.json": page(3, [(1, 4, 1, 1), (1, 5, 2, 1)]),
                          "p3_new.json": page(3, [(1, 4, 1, 5)])})
    now = time.time()
    os.utime(os.path.join(landing, "p3_old.json"), (now - 60, now - 60))
    store = TableStore(spark, os.path.join(scratch, "store"))
    ckpt = os.path.join(scratch, "ckpt")
    start_history_stream(spark, landing, store, ckpt).awaitTermination(120)
    got = {(r.player_id, r.gameweek_id, r.opponent_id): (r.points, r.game_count, r.dgw)
           for r in store.read("player_gw_stats", SC.PLAYER_GW_STATS).collect()}
    assert got == {(1, 1, 5): (2, 1, False), (1, 2, 6): (3, 2, True), (1, 2, 7): (1, 2, True),
                   (2, 1, 6): (7, 1, False), (3, 1, 4): (5, 1, False)}
    parts = dict(store.version("player_gw_stats")["parts"])
    # player 2's page lands again with a corrected score: only gameweek 1 is rewritten
    time.sleep(1.1)
    write_pages(landing, {"p2_again.json": page(2, [(1, 6, 1, 9)])})
    start_history_stream(spark, landing, store, ckpt).awaitTermination(120)
    got = {(r.player_id, r.gameweek_id, r.opponent_id): r.points
           for r in store.read("player_gw_stats", SC.PLAYER_GW_STATS).collect()}
    assert got == {(1, 1, 5): 2, (1, 2, 6): 3, (1, 2, 7): 1, (2, 1, 6): 9, (3, 1, 4): 5}
    new_parts = store.version("player_gw_stats")["parts"]
    assert new_parts["2"] == parts["2"] and new_parts["1"] != parts["1"]


def test_command_line_runs_all_jobs(spark, scratch):
    from pitchside.__main__ import main
    pages = {"e1.json": [fixture(1, 1, 2, 2, 1, id=1), fixture(2, 2, 1, 1, 1, id=2)]}
    el = [{"id": 7, "first_name": "A", "element_type": 1, "team": 1}]
    ev = [{"id": 1, "deadline_time": "2022-08-05T17:30:00Z"}]
    hist = {"p7.json": {"history": [{"element": 7, "round": 1, "opponent_team": 2}]}}
    landing = land(scratch, [team(1), team(2)], pages, el, ev, hist)
    store = os.path.join(scratch, "store")
    done = main(["all", "--bootstrap", landing.bootstrap, "--fixtures", landing.fixtures,
                 "--history", landing.history, "--store", store, "--date", "2024-01-03",
                 "--csv", os.path.join(scratch, "csv"), "--local", "4"])
    assert set(done) == {"fixtures", "players", "player-gw", "gameweeks"}
    tables = TableStore(spark, store).state()["tables"]
    assert set(tables) == {"fixture_info", "team_info", "player_info", "player_gw_stats",
                           "gw_stats"}


def test_concurrent_runs_never_lose_an_update(spark, scratch):
    root = os.path.join(scratch, "store")
    schema = SC.struct([("k", SC.L), ("v", SC.S)])
    TableStore(spark, root).upsert("t", spark.createDataFrame([(1, "a")], schema), ["k"], schema)
    a, b = TableStore(spark, root), TableStore(spark, root)
    va = a.stage_upsert("t", spark.createDataFrame([(2, "b")], schema), ["k"], schema)
    vb = b.stage_upsert("t", spark.createDataFrame([(3, "c")], schema), ["k"], schema)
    vu = b.stage_upsert("u", spark.createDataFrame([(9, "z")], schema), ["k"], schema)
    a.commit({"t": va})
    with pytest.raises(CommitConflict):          # b read t before a published it
        b.commit({"t": vb})
    b.commit({"u": vu})                          # another table: fine on the new state
    assert as_set(a.read("t")) == {(1, "a"), (2, "b")}
    assert as_set(a.read("u")) == {(9, "z")}
