"""Property tests against brute-force Python, and behaviour under a hot key."""

import collections

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchside.operators import gameweeks as GW
from pitchside.operators import merge as MG
from pitchside.operators import standings as ST

score = st.one_of(st.none(), st.integers(min_value=0, max_value=6))
match = st.tuples(st.integers(1, 6), st.integers(1, 6), score, score)


def brute_table(matches):
    """Per team: (points, wins, losses, draws, goals for) from the match list."""
    home, away, decided = set(), set(), set()
    acc = collections.defaultdict(lambda: [0, 0, 0, 0, 0])
    for h, a, hs, as_ in matches:
        home.add(h)
        away.add(a)
        for me, gf, ga in ((h, hs, as_), (a, as_, hs)):
            acc[me]
            if gf is not None:          # each score column is summed on its own
                acc[me][4] += gf
            if gf is None or ga is None:
                continue
            decided.add(me)
            if gf > ga:
                acc[me][0] += 3
                acc[me][1] += 1
            elif gf < ga:
                acc[me][2] += 1
            else:
                acc[me][0] += 1
                acc[me][3] += 1
    keep = home & away & decided
    pts = {t: acc[t][0] for t in keep}
    pos = {t: sum(1 for u in keep if pts[u] >= pts[t]) for t in keep}
    return {t: (*acc[t], pos[t]) for t in keep}


@settings(max_examples=6, deadline=None)
@given(st.lists(match, min_size=0, max_size=30))
def test_league_table_matches_brute_force(spark, matches):
    df = spark.createDataFrame(
        [(h, a, hs, as_) for h, a, hs, as_ in matches],
        "home_team_id bigint, away_team_id bigint, home_team_score bigint, away_team_score bigint")
    agg = ST.team_aggregate(ST.team_sides(ST.score_fixtures(df))) \
        .filter((F.col("home_games") > 0) & (F.col("away_games") > 0) & (F.col("decided_games") > 0))
    agg = agg.withColumn("total_points", F.col("home_points") + F.col("away_points"))
    ranked = ST.rank_max(agg, "total_points", "pos")
    got = {r.team_id: (r.total_points, r.home_wins + r.away_wins, r.home_loss + r.away_loss,
                       r.home_draw + r.away_draw, r.home_goals_scored + r.away_goals_scored, r.pos)
           for r in ranked.collect()}
    assert got == brute_table(matches)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.integers(0, 3)), max_size=40))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, t bigint, v bigint")
    got = {r.k: (r.t, r.v) for r in MG.latest_per_key(df, ["k"], ["t"]).collect()}
    newest = {}
    for k, t, _ in rows:
        newest[k] = max(t, newest.get(k, t))
    assert {k: t for k, (t, _) in got.items()} == newest
    assert all((k, t, v) in rows for k, (t, v) in got.items())      # a whole row, ties broken by its hash
    assert got == {r.k: (r.t, r.v) for r in MG.latest_per_key(df.repartition(3), ["k"], ["t"]).collect()}


def test_hot_key_holds_a_third_of_rows(spark):
    # One (player, gameweek) holds a third of all rows; results stay whole and exact.
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 1_000_000).alias("player_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 38).alias("gameweek_id"),
        (F.col("id") % 20).alias("opponent_id"))
    for threshold in (GW.HOT_KEY_ROWS, 1000):      # plain path, then the hot key split
        out = GW.with_game_count(df, hot_key_rows=threshold, buckets=8)
        hot = out.filter((F.col("player_id") == 1) & (F.col("gameweek_id") == 1))
        assert out.count() == n and out.filter("game_count is null").count() == 0
        assert hot.select(F.min("game_count"), F.max("game_count")).first() == (n // 3, n // 3)
        assert out.filter("player_id != 1").select(F.max("game_count")).first()[0] == 1
    # the hot key's rows are spread over several join tasks (AQE would merge the
    # small partitions of this test back together, so coalescing is off here)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = GW.with_game_count(df, hot_key_rows=1000, buckets=8)
        per_task = plan.withColumn("task", F.spark_partition_id()) \
            .filter("player_id = 1").groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 1
    latest = MG.latest_per_key(df.withColumn("t", F.col("opponent_id")), ["player_id", "gameweek_id"], ["t"])
    assert latest.filter("player_id = 1 and gameweek_id = 1").first().t == 19


def test_rank_with_a_hot_value_matches_the_window_form(spark):
    # a third of the rows share one points value; the join-back splits it
    df = spark.range(9_000).select(
        F.col("id"), (F.col("id") % 3).alias("team"),
        F.when(F.col("id") % 3 == 0, F.lit(10)).otherwise(F.col("id") % 50).alias("pts"))
    a = ST.rank_max(df, "pts", "r", hot_key_rows=500)
    b = ST.rank_max_window(df, "pts", "r")
    assert a.count() == 9_000 and a.exceptAll(b).count() == 0
    a2 = ST.rank_max(df, "pts", "r", ["team"], hot_key_rows=500)
    b2 = ST.rank_max_window(df, "pts", "r", ["team"])
    assert a2.exceptAll(b2).count() == 0 and b2.exceptAll(a2).count() == 0
