"""League table semantics on hand-written fixture pages (one rule per test)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import fixture, team, write_pages
from pitchside.operators import standings as ST
from pitchside.sources import snapshot as SN


def load(spark, scratch, pages, teams=None):
    fx_dir = write_pages(os.path.join(scratch, "fixtures"), pages)
    fixtures = SN.scan_fixtures(SN.read_fixture_pages(spark, fx_dir))
    if teams is None:
        return fixtures, None
    boot = write_pages(os.path.join(scratch, "bootstrap"),
                       {"b.json": {"teams": teams, "elements": [], "element_types": [],
                                   "events": []}})
    teams_df = SN.scan_teams(SN.bootstrap_array(SN.read_bootstrap(spark, boot), "teams"))
    return fixtures, teams_df


def rows(df, key="team_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_points_and_results(spark):
    df = spark.createDataFrame(
        [(2, 1), (1, 1), (0, 3), (None, 1), (None, None)],
        "home_team_score bigint, away_team_score bigint")
    out = ST.score_fixtures(df).collect()
    assert [(r.home_points, r.away_points) for r in out] == [(3, 0), (1, 1), (0, 3), (0, 0), (0, 0)]
    assert [(r.home_result, r.away_result) for r in out] == [
        ("W", "L"), ("D", "D"), ("L", "W"), (None, None), (None, None)]


def test_empty_page_gives_no_rows(spark, scratch):
    fixtures, _ = load(spark, scratch, {"event_0.json": []})
    assert fixtures.count() == 0
    assert ST.result_counts(ST.score_fixtures(ST.fixture_frame(fixtures))).count() == 0


def test_unplayed_match_is_not_a_result(spark, scratch):
    # Q1: null scores → 0 points, null result, not counted as played.
    pages = {"e1.json": [fixture(1, 1, 2, 2, 1), fixture(1, 2, 1, None, None, finished=False)]}
    fixtures, teams = load(spark, scratch, pages, [team(1), team(2)])
    table = rows(ST.league_table(fixtures, teams))
    assert table[1]["games_played"] == 1 and table[2]["games_played"] == 1
    assert table[1]["total_draw"] == 0 and table[2]["total_draw"] == 0
    assert table[1]["total_points"] == 3 and table[2]["total_points"] == 0
    fi = ST.fixture_info(fixtures).filter(F.col("home_team_score").isNull()).collect()
    assert fi[0].home_points == 0 and fi[0].home_result is None


def test_live_match_counts(spark, scratch):
    # Q2: `finished` is not consulted.
    pages = {"e1.json": [fixture(1, 1, 2, 1, 0, finished=False), fixture(2, 2, 1, 0, 0)]}
    fixtures, teams = load(spark, scratch, pages, [team(1), team(2)])
    table = rows(ST.league_table(fixtures, teams))
    assert table[1]["home_wins"] == 1 and table[1]["total_points"] == 4


def test_one_sided_team_is_not_listed(spark, scratch):
    # Q4: a team needs a home fixture, an away fixture and a decided result.
    pages = {"e1.json": [fixture(1, 1, 2, 1, 0), fixture(2, 2, 1, 0, 0), fixture(3, 3, 1, 2, 2)]}
    fixtures, teams = load(spark, scratch, pages, [team(1), team(2), team(3)])
    table = rows(ST.league_table(fixtures, teams))
    assert set(table) == {1, 2}
    # …but team 3 is in the result counts (it has a decided match).
    counts = rows(ST.result_counts(ST.score_fixtures(ST.fixture_frame(fixtures))))
    assert counts[3]["home_draw"] == 1 and counts[3]["away_draw"] == 0


def test_tied_positions_take_the_worst_place(spark):
    df = spark.createDataFrame([(1, 10), (2, 8), (3, 8), (4, 8), (5, 5), (6, None)],
                               "team_id bigint, total_points bigint")
    for fn in (ST.rank_max, ST.rank_max_window):
        got = {r.team_id: r.pos for r in fn(df, "total_points", "pos").collect()}
        assert got == {1: 1, 2: 4, 3: 4, 4: 4, 5: 5, 6: None}


def test_rank_within_partition(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 3), (3, "a", 1), (4, "b", 1)],
                               "id bigint, g string, v bigint")
    got = {r.id: r.r for r in ST.rank_max(df, "v", "r", ["g"]).collect()}
    assert got == {1: 2, 2: 2, 3: 3, 4: 1}


def test_unknown_team_ranks_then_drops(spark, scratch):
    # Team 9 is not in the dimension: it takes part in the ranking, then drops out.
    pages = {"e1.json": [fixture(1, 9, 1, 3, 0), fixture(2, 1, 9, 0, 3),
                         fixture(3, 1, 2, 1, 1), fixture(4, 2, 1, 1, 1)]}
    fixtures, teams = load(spark, scratch, pages, [team(1), team(2)])
    table = rows(ST.league_table(fixtures, teams))
    assert set(table) == {1, 2}
    assert table[1]["league_position"] == 3 and table[2]["league_position"] == 3


def test_all_null_goals_sum_to_zero(spark, scratch):
    # Q6: sums over only-null scores are 0.
    pages = {"e1.json": [fixture(1, 1, 2, None, None), fixture(2, 2, 1, None, None),
                         fixture(3, 3, 1, 1, 0), fixture(4, 1, 3, 0, 1)]}
    fixtures, _ = load(spark, scratch, pages)
    g = rows(ST.goals(ST.score_fixtures(ST.fixture_frame(fixtures))))
    assert g[2]["home_goals_scored"] == 0 and g[2]["away_goals_against"] == 0


def test_null_team_is_not_a_group(spark, scratch):
    # Q7: a null team id is dropped from grouping.
    pages = {"e1.json": [fixture(1, None, 1, 2, 0), fixture(2, 1, 2, 1, 0), fixture(3, 2, 1, 1, 0)]}
    fixtures, _ = load(spark, scratch, pages)
    counts = rows(ST.result_counts(ST.score_fixtures(ST.fixture_frame(fixtures))))
    assert None not in counts and counts[1]["away_loss"] == 2


def test_invariants_on_driver_tables(spark):
    from pitchside.plans.queries import queries
    q = queries()
    t = q["league_table"](spark, "/root/testdata/sf0.01")
    s = t.agg(F.sum("home_goals_scored").alias("hs"), F.sum("away_goals_against").alias("aga"),
              F.sum("total_wins").alias("w"), F.sum("total_loss").alias("l"),
              F.count_if(F.col("games_played") != F.col("total_wins") + F.col("total_loss")
                         + F.col("total_draw")).alias("bad")).first()
    assert s.hs == s.aga and s.w == s.l and s.bad == 0


def test_single_pass_equals_folded_joins(spark):
    from pitchside.plans.queries import queries
    q = queries()
    a = q["join_full_outer"](spark, "/root/testdata/sf0.01")
    b = q["result_counts"](spark, "/root/testdata/sf0.01").select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_strength_scaling(spark, scratch):
    _, teams = load(spark, scratch, {"e.json": []}, [team(1, strength=4)])
    r = ST.team_strength(teams).first()
    assert r.strength == 4 and r.strength_overall_home == pytest.approx(11.01)


def test_page_order_does_not_matter(spark, scratch):
    a = [fixture(1, 1, 2, 2, 1), fixture(1, 3, 4, 0, 0)]
    b = [fixture(2, 2, 1, 1, 1), fixture(2, 4, 3, 3, 0)]
    f1, teams = load(spark, os.path.join(scratch, "x"), {"p1.json": a, "p2.json": b},
                     [team(i) for i in range(1, 5)])
    f2, _ = load(spark, os.path.join(scratch, "y"), {"p1.json": b + a})
    t1 = ST.league_table(f1, teams)
    t2 = ST.league_table(f2.repartition(7), teams)
    assert t1.exceptAll(t2).count() == 0 and t2.exceptAll(t1).count() == 0


def test_league_rank_methods_agree(spark):
    from pitchside.plans.queries import _fixtures, _teams
    d = "/root/testdata/sf0.01"
    a = ST.league_table(_fixtures(spark, d), _teams(spark, d), rank="window")
    b = ST.league_table(_fixtures(spark, d), _teams(spark, d), rank="distinct")
    assert a.count() == 25 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
