"""Input that must not be lost, keys that must not raise, and merges that must be seen."""

import os
import threading
from importlib import import_module

import pytest
from conftest import fixture, team, write_pages
from pyspark.sql import functions as F

from pitchside import schemas as SC
from pitchside.operators import gameweeks as GW
from pitchside.operators import merge as MG
from pitchside.operators import standings as ST
from pitchside.plans import jobs as J
from pitchside.sinks import jdbc
from pitchside.sinks.tables import CommitConflict, TableStore
from pitchside.sources import snapshot as SN

Q = import_module("pitchside.plans.queries")      # the package re-exports the function of that name


def history(player, gw, opponent, **kw):
    return {"element": player, "round": gw, "opponent_team": opponent, "kickoff_time": "2022-08-05T19:00:00Z", "fixture": 1, **kw}


def landing(scratch, boot=None, fixtures=None, pages=None, **kw):
    boot = boot or {"teams": [team(1), team(2)], "elements": [], "element_types": [], "events": []}
    return J.Landing(write_pages(f"{scratch}/boot", {"b.json": boot}),
                     write_pages(f"{scratch}/fix", fixtures or {}), write_pages(f"{scratch}/hist", pages or {}), **kw)


def truncate(path):
    with open(path) as f:
        text = f.read()
    with open(path, "w") as f:
        f.write(text[:len(text) * 2 // 3])


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("kind", ["boot", "fix", "hist"])
def test_truncated_page_raises_and_names_its_file(spark, scratch, kind, strict):
    land = landing(scratch, fixtures={"a.json": [fixture(1, 1, 2, 2, 0, id=1)], "z.json": [fixture(2, 2, 1, 1, 1, id=2)]},
                   pages={"a.json": {"history": [history(1, 1, 2)]}, "z.json": {"history": [history(2, 1, 1)]}}, strict=strict)
    name = {"boot": "b.json"}.get(kind, "z.json")
    truncate(f"{scratch}/{kind}/{name}")
    read = {"boot": lambda: SN.read_bootstrap(spark, land.bootstrap, strict=strict).select(F.inline("teams")),
            "fix": lambda: SN.scan_fixtures(SN.read_fixture_pages(spark, land.fixtures, strict=strict)),
            "hist": lambda: SN.scan_history(SN.read_history_pages(spark, land.history, strict=strict))}[kind]
    with pytest.raises(Exception, match=name):
        read().collect()


def test_a_field_of_the_wrong_type_keeps_its_record(spark, scratch):
    pages = write_pages(f"{scratch}/f", {"a.json": [fixture(1, 1, 2, "two", 0, id=1), fixture(1, 2, 1, 1, 0, id=2)]})
    rows = {r.id: r.team_h_score for r in SN.scan_fixtures(SN.read_fixture_pages(spark, pages)).collect()}
    assert rows == {1: None, 2: 1}


def test_json_lines_with_a_cut_record_raise(spark, scratch):
    os.makedirs(f"{scratch}/l")
    with open(f"{scratch}/l/a.json", "w") as f:
        f.write('{"id": 1, "event": 1}\n{"id": 2, "eve')
    with pytest.raises(Exception, match="cannot be parsed"):
        SN.scan_fixtures(SN.read_fixture_pages(spark, f"{scratch}/l", multi_line=False)).collect()


def test_pages_landed_twice_count_once(spark, scratch):
    page = [fixture(1, 1, 2, 2, 0, id=1), fixture(1, 2, 1, 1, 1, id=2)]
    changed = [fixture(1, 1, 2, 3, 0, id=1), fixture(1, 2, 1, 1, 1, id=2)]
    land = landing(scratch, fixtures={"a.json": page, "b.json": page},
                   pages={"p.json": {"history": [history(1, 1, 2)]}, "q.json": {"history": [history(1, 1, 2)]}})
    os.utime(f"{scratch}/fix/a.json", (1, 1))
    store = TableStore(spark, f"{scratch}/store")
    J.fixture_job(spark, land, store)
    table = {r.team_id: r for r in store.read("team_info").collect()}
    assert {(r.games_played, r.total_points) for r in table.values()} == {(2, 4), (2, 1)}
    write_pages(f"{scratch}/fix", {"c.json": changed})
    J.fixture_job(spark, land, store)
    assert sorted(r.home_team_score for r in store.read("fixture_info").collect()) == [1, 3]
    J.player_gw_job(spark, land, store, on_duplicate="latest")
    (row,) = store.read("player_gw_stats").collect()
    assert (row.game_count, row.dgw) == (1, False)


def test_null_dates_fall_in_exactly_one_load(spark):
    df = spark.range(100).select("id", F.expr("if(id % 6 = 0, null, timestamp_ntz'1997-12-25' + make_dt_interval(id))").alias("kickoff_time"))
    old, new = Q._before("kickoff_time", "1998-01-01"), Q._since("kickoff_time", "1998-01-01")
    assert df.filter(old).count() + df.filter(new).count() == 100 and df.filter(new & F.col("kickoff_time").isNull()).count() == 17


def test_partition_without_a_value_is_rejected_whole(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    schema = "k bigint, p bigint, v bigint"
    rows = spark.createDataFrame([(1, 1, 1), (2, None, 2)], schema)
    with pytest.raises(ValueError, match="needs a value"):
        store.stage_upsert_partitions("t", rows, ["k", "p"], rows.schema, "p", allow_null_keys=True)
    assert store.version("t") is None and not os.path.exists(f"{scratch}/store/t")


def test_many_equally_heavy_keys_and_null_keys(spark):
    n = 36_000
    df = spark.range(n).select(F.when(F.col("id") % 9 > 0, F.col("id") % 12_000).alias("player_id"), F.lit(1).cast("long").alias("gameweek_id"),
                               F.col("id").alias("opponent_id"))
    out = GW.with_game_count(df, hot_key_rows=2, buckets=4)
    want = df.filter("player_id is not null").groupBy("player_id").count()
    assert out.count() == n and out.filter("player_id is null and (game_count is not null or dgw)").count() == 0
    assert out.filter("player_id is not null").select("player_id", F.col("game_count").alias("count")).distinct().exceptAll(want).count() == 0
    ranked = ST.rank_max(df.withColumn("pts", F.col("player_id") * 1.5), "pts", "r", hot_key_rows=2)
    assert ranked.exceptAll(ST.rank_max_window(df.withColumn("pts", F.col("player_id") * 1.5), "pts", "r")).count() == 0


def test_upsert_updates_inserts_keeps_and_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k bigint, s string, n bigint")
    source = spark.createDataFrame([(2, None, 20), (4, "d", 40)], "k bigint, s string, n bigint")
    assert sorted(map(tuple, MG.upsert(target, source, ["k"]).collect())) == [(1, "a", 1), (2, None, 20), (3, "c", 3), (4, "d", 40)]
    nulls = spark.createDataFrame([(None, "x", 1), (None, "y", 2)], "k bigint, s string, n bigint")
    assert MG.upsert(target, nulls, ["k"], allow_null_keys=True).count() == 5
    with pytest.raises(Exception, match="null key"):
        MG.upsert(target, nulls, ["k"]).collect()
    assert [tuple(r) for r in MG.refresh(target, source.drop("s")).orderBy("k").collect()] == [(2, None, 20), (4, None, 40)]


@pytest.mark.parametrize("name", ["upsert_team", "upsert_player", "upsert_gameweek", "upsert_player_gw"])
def test_merge_queries_tell_wrong_merges_apart(spark, monkeypatch, name):
    """Each merge query has updated, inserted and kept keys, and a null that overwrites."""
    d, seen = "/root/testdata/sf0.001", {}
    upsert = MG.upsert

    def spy(target, source, keys, on_duplicate="error", order_by=None, **kw):
        if on_duplicate == "latest":
            source = MG.latest_per_key(source, keys, order_by)
        seen.update(t=target, s=MG.conform_to(target.schema, source), k=keys)
        return upsert(target, source, keys, **kw)

    monkeypatch.setattr(MG, "upsert", spy)
    Q.queries()[name](spark, d)
    t, s, k = seen["t"], seen["s"], seen["k"]
    both = t.join(s.select(*k), k, "left_semi")
    assert t.join(s, k, "left_anti").take(1) and s.join(t, k, "left_anti").take(1)
    assert both.exceptAll(s).take(1)
    rest = [c for c in t.columns if c not in k]
    pairs = t.select(*k, *[F.col(c).alias(f"t_{c}") for c in rest]).join(s, k)
    assert pairs.filter(" or ".join(f"(t_{c} is not null and {c} is null)" for c in rest)).take(1)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, scratch, zone):
    times = ["2022-08-05T19:00:00Z", "2022-11-06T05:30:00Z", "2022-08-05T21:00:00+02:00", "2022-08-05T19:00:00", "bad"]
    pages = write_pages(f"{scratch}/f", {"a.json": [fixture(1, 1, 2, 2, 0, id=i, kickoff_time=t) for i, t in enumerate(times)]})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = SN.scan_fixtures(SN.read_fixture_pages(spark, pages)).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [str(r.kickoff_time) for r in rows] == ["2022-08-05 19:00:00", "2022-11-06 05:30:00", "2022-08-05 19:00:00",
                                                   "2022-08-05 19:00:00", "None"]


def test_one_of_many_concurrent_commits_takes_a_number(spark, scratch):
    stores = [TableStore(spark, f"{scratch}/store") for _ in range(6)]
    state, won = stores[0].state(), []

    def run(store, i):
        try:
            won.append(store._commit_once(state, {"t": f"v{i}"}, None))
        except CommitConflict:
            pass

    threads = [threading.Thread(target=run, args=(s, i)) for i, s in enumerate(stores)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert won == [1] and stores[0].state()["seq"] == 1
    with pytest.raises(ValueError, match="atomically"):
        TableStore._check_scheme("s3a")


def test_results_csv_team_order_and_database(spark, scratch, monkeypatch):
    land = landing(scratch, fixtures={"a.json": [fixture(1, 1, 2, 2, 0, id=1), fixture(1, 2, 1, 1, 1, id=2)]})
    store = TableStore(spark, f"{scratch}/store")
    J.fixture_job(spark, land, store, "2022-08-06", f"{scratch}/csv")
    rows = spark.read.csv(f"{scratch}/csv/results", header=True, inferSchema=True).orderBy("team_id").collect()
    names = ["team_id", *ST.RESULT_COLUMNS, "total_wins", "total_loss", "total_draw", "games_played"]
    assert [[r[c] for c in names] for r in rows] == [[1, 1, 0, 0, 0, 0, 1, 1, 0, 1, 2], [2, 0, 0, 1, 0, 1, 0, 0, 1, 1, 2]]
    lines = []
    for f in sorted(os.listdir(f"{scratch}/csv/team_data/snapshot_date=2022-08-06")):
        if f.endswith(".csv"):
            lines += open(f"{scratch}/csv/team_data/snapshot_date=2022-08-06/{f}").read().splitlines()
    ids = [int(line.split(",")[0]) for line in lines if line and line[0].isdigit()]
    assert ids == [1, 2]
    calls = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, url, table, props, mode: calls.append((table, df.count(), url, props, mode)))
    jdbc.publish(store, ["fixture_info", "team_info"], "jdbc:x", {"user": "u"})
    assert calls == [("fixture_info", 2, "jdbc:x", {"user": "u"}, "overwrite"), ("team_info", 2, "jdbc:x", {"user": "u"}, "overwrite")]


def test_jobs_parse_each_page_once(spark, scratch, monkeypatch):
    reads = []
    read = SN.read_documents
    monkeypatch.setattr(SN, "read_documents", lambda spark, path, *a, **k: (reads.append(path), read(spark, path, *a, **k))[1])
    land = landing(scratch, fixtures={"a.json": [fixture(1, 1, 2, 2, 0, id=1)]}, pages={"p.json": {"history": [history(1, 1, 2)]}})
    once = J._parsed_once
    plans = []

    def spy(spark, df):
        out = once(spark, df)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(J, "_parsed_once", spy)
    store = TableStore(spark, f"{scratch}/store")
    J.player_gw_job(spark, land, store)
    J.player_job(spark, land, store)
    J.gameweek_job(spark, land, store)
    assert len(reads) == 3 and plans and not any("json" in p.lower().split("\n")[0] for p in plans)
    assert SC.names(SC.GW_STATS)
