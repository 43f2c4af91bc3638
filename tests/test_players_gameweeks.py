"""Players, positions, casts, null filling, gameweeks and the DGW flag."""

import os

import pytest

from conftest import write_pages
from pitchside import schemas as SC
from pitchside.operators import columns as CO
from pitchside.operators import gameweeks as GW
from pitchside.operators import players as PL
from pitchside.sources import snapshot as SN


def element(i, et=1, **kw):
    row = {"id": i, "first_name": f"F{i}", "second_name": f"S{i}", "element_type": et,
           "team": 1, "now_cost": 55, "total_points": 10, "influence": "12.5",
           "creativity": "3.0", "threat": "7.1", "in_dreamteam": False,
           "selected_by_percent": "4.2", "chance_of_playing_next_round": None}
    row.update(kw)
    return row


def bootstrap(spark, scratch, elements, element_types=None, events=None):
    boot = write_pages(os.path.join(scratch, "bootstrap"), {"b.json": {
        "teams": [], "elements": elements,
        "element_types": element_types or [{"id": 1, "plural_name_short": "DEF"},
                                           {"id": 2, "plural_name_short": "MID"}],
        "events": events or []}})
    return SN.read_bootstrap(spark, boot)


def players(spark, scratch, elements, **kw):
    b = bootstrap(spark, scratch, elements)
    return (SN.scan_elements(SN.bootstrap_array(b, "elements")),
            SN.scan_positions(SN.bootstrap_array(b, "element_types")))


def test_player_info_shape_and_types(spark, scratch):
    el, pos = players(spark, scratch, [element(1), element(2, et=2, in_dreamteam=True)])
    out = PL.player_info(el, pos)
    assert out.columns == SC.names(SC.PLAYER_INFO)
    assert out.schema == SC.PLAYER_INFO or [f.dataType for f in out.schema.fields] == \
        [f.dataType for f in SC.PLAYER_INFO.fields]
    r = {x.player_id: x for x in out.collect()}
    assert r[1].position == "DEF" and r[2].position == "MID"
    assert r[1].influence == 12.5 and r[1].current_price == 55.0   # price is not rescaled
    assert r[1].in_dreamteam == "False" and r[2].in_dreamteam == "True"
    assert r[1].chance_of_playing_next_round == 0                  # null → 0


def test_unknown_or_null_position_is_dropped(spark, scratch):
    el, pos = players(spark, scratch, [element(1, et=9), element(2, et=None), element(3)])
    assert [r.player_id for r in PL.player_info(el, pos).collect()] == [3]


def test_text_stays_null(spark, scratch):
    # Q5: a missing name is not turned into '0'.
    el, pos = players(spark, scratch, [element(1, first_name=None)])
    r = PL.player_info(el, pos).first()
    assert r.first_name is None and r.goals_scored == 0


def test_bad_number_lenient_and_strict(spark, scratch):
    # Q9: '1.5' / '' / 'x' in a text-number column.
    el, pos = players(spark, scratch, [element(1, influence="x"), element(2, influence=""),
                                       element(3, influence="1.5")])
    got = {r.player_id: r.influence for r in PL.player_cast(el, pos).collect()}
    assert got == {1: None, 2: None, 3: 1.5}
    with pytest.raises(Exception):
        PL.player_cast(el, pos, strict=True).collect()


def test_integer_text_lenient(spark):
    df = spark.createDataFrame([("1.5",), ("7",), ("x",), (None,)], "v string")
    out = [r.v for r in CO.cast_columns(df, {"v": SC.L}).collect()]
    assert out == [None, 7, None, None]


def test_fill_nulls_numeric_only(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "a bigint, b double, c string, d boolean")
    r = CO.fill_nulls(df, 0).first()
    assert (r.a, r.b, r.c, r.d) == (0, 0.0, None, None)


def history_page(player, games):
    return {"history": [dict({"element": player, "fixture": 100 + i, "round": gw,
                              "opponent_team": opp, "kickoff_time": "2022-08-05T19:00:00Z",
                              "total_points": 2, "minutes": 90, "influence": "1.0",
                              "expected_goals": "0.12"}) for i, (gw, opp) in enumerate(games)]}


def test_double_gameweek(spark, scratch):
    pages = {"p1.json": history_page(1, [(1, 5), (2, 6), (2, 7)]),
             "p2.json": history_page(2, [(2, 5)]),
             "p3.json": {"history": []}}
    d = write_pages(os.path.join(scratch, "hist"), pages)
    hist = SN.scan_history(SN.read_history_pages(spark, d))
    out = GW.player_gw_stats(hist)
    assert out.columns == SC.names(SC.PLAYER_GW_STATS)
    got = {(r.player_id, r.gameweek_id, r.opponent_id): (r.game_count, r.dgw) for r in out.collect()}
    assert got == {(1, 1, 5): (1, False), (1, 2, 6): (2, True), (1, 2, 7): (2, True),
                   (2, 2, 5): (1, False)}
    vc = {(r.player_id, r.gameweek_id): r.game_count for r in GW.value_counts(
        GW.history_frame(hist)).collect()}
    assert vc == {(1, 1): 1, (1, 2): 2, (2, 2): 1}


def test_null_gameweek_not_counted(spark):
    df = spark.createDataFrame([(1, None, 3), (1, None, 4), (1, 2, 3)],
                               "player_id bigint, gameweek_id bigint, opponent_id bigint")
    out = {(r.gameweek_id, r.opponent_id): (r.game_count, r.dgw)
           for r in GW.with_game_count(df).collect()}
    assert out == {(None, 3): (None, False), (None, 4): (None, False), (2, 3): (1, False)}
    gc = GW.gameweek_counts(df).collect()
    assert [(r.gameweek_id, r.player_id, r.opponent_id) for r in gc] == [(2, 1, 1)]


def test_gw_stats(spark, scratch):
    events = [{"id": 1, "deadline_time": "2022-08-05T17:30:00Z", "average_entry_score": 57,
               "highest_score": None, "most_selected": 3},
              {"id": 2, "deadline_time": None, "average_entry_score": None}]
    b = bootstrap(spark, scratch, [], events=events)
    out = GW.gw_stats(SN.scan_gameweeks(SN.bootstrap_array(b, "events")))
    r = {x.id: x for x in out.collect()}
    assert str(r[1].deadline_time) == "2022-08-05 17:30:00"
    assert r[1].highest_score == 0 and r[2].average_entry_score == 0
    assert r[2].deadline_time is None
