"""DuckDB SQL oracles, one per registered query.

Each oracle is SQL of its own on the driver's tables (``region nation customer …``
as views); only the column lists of the result tables come from ``schemas``.  The ``fx_*`` CTEs mirror
``sources.testdata``.  Notes on DuckDB: a double→integer cast rounds, so
``floor`` is used; ``sum`` of bigint is HUGEINT, so sums are cast back.
"""

from __future__ import annotations

import re

# The fixed split points of the two-load (target / source) merge queries.
FIXTURE_CUTOFF = "1998-01-01"
FIXTURE_SOURCE_FROM = "1997-01-01"
EVENT_TARGET_BEFORE = "2024-01-20"
EVENT_SOURCE_FROM = "2024-01-10"
SNAPSHOT_DATES = ["1992-05-01", "1994-02-03", "1996-09-10", "1997-07-07"]
PLAYER_TARGET_TEAMS_BELOW = 15
PLAYER_SOURCE_TEAMS_FROM = 10

FX = {
    "fx_teams": """
select cast(n_nationkey as bigint) as id, n_name as name,
       cast(1 + n_nationkey % 5 as bigint) as strength,
       cast(1000 + (n_nationkey * 37) % 350 as bigint) as strength_overall_home,
       cast(1000 + (n_nationkey * 41) % 350 as bigint) as strength_overall_away,
       cast(1000 + (n_nationkey * 43) % 350 as bigint) as strength_attack_home,
       cast(1000 + (n_nationkey * 47) % 350 as bigint) as strength_attack_away,
       cast(1000 + (n_nationkey * 53) % 350 as bigint) as strength_defence_home,
       cast(1000 + (n_nationkey * 59) % 350 as bigint) as strength_defence_away
from nation""",
    "fx_fixtures": """
select o_orderkey as id, o_orderkey % 39 as event, o_orderstatus <> 'P' as finished,
       o_orderdate as kickoff_time,
       cast(case when o_orderstatus = 'P' then 0 else 90 end as bigint) as "minutes",
       cast(c_nationkey as bigint) as team_h,
       cast((c_nationkey + 1 + o_orderkey % 24) % 25 as bigint) as team_a,
       case when o_orderstatus = 'P' then null else o_custkey % 5 end as team_h_score,
       case when o_orderstatus = 'P' then null else cast(floor(o_totalprice) as bigint) % 4 end as team_a_score,
       1 + o_custkey % 5 as team_h_difficulty, 1 + o_orderkey % 5 as team_a_difficulty
from orders join customer on o_custkey = c_custkey""",
    "fx_element_types": """
select cast(r_regionkey as bigint) as id, r_name as plural_name_short from region""",
    "fx_elements": """
select c_custkey as id, c_mktsegment as first_name, c_name as second_name,
       case when c_custkey % 97 = 0 then 9 else c_custkey % 5 end as element_type,
       cast(c_nationkey as bigint) as team, 40 + c_custkey % 90 as now_cost,
       c_custkey % 200 as total_points,
       cast(cast(c_acctbal as decimal(12,2)) as varchar) as influence,
       cast(cast(c_custkey % 1000 as decimal(12,1)) as varchar) as selected_by_percent,
       c_custkey % 50 = 0 as in_dreamteam,
       case when c_custkey % 4 = 0 then null else 25 * (c_custkey % 4) end as chance_of_playing_next_round
from customer""",
    "fx_history": """
select l_partkey as element, l_orderkey as fixture, l_orderkey % 38 + 1 as "round",
       l_suppkey as opponent_team, l_shipdate as kickoff_time,
       cast(l_quantity as bigint) % 4 as goals_scored,
       cast(l_linenumber as bigint) % 3 as assists,
       cast(l_quantity as bigint) + 40 as "minutes",
       cast(floor(l_extendedprice) as bigint) % 15 as total_points,
       cast(cast(l_discount as decimal(12,2)) as varchar) as expected_goals,
       cast(l_linenumber as bigint) as line
from lineitem""",
    "fx_gw": """
select event_id as id, ts as deadline_time, cast(floor(value) as bigint) as average_entry_score,
       case when event_type = 'error' then null
            else cast(json_extract_string(props, '$.k') as bigint) end as highest_score,
       case when event_type = 'signup' then null else user_id end as most_selected
from events""",
}


def sql(body: str, *ctes: tuple[str, str] | str) -> str:
    """``with <ctes> <body>``; a bare name is an ``fx_*`` view."""
    parts = []
    for c in ctes:
        name, text = (c, FX[c]) if isinstance(c, str) else c
        parts.append(f"{name} as ({text})")
    return "with " + ",\n".join(parts) + "\n" + body


# ------------------------------------------------------------ standings -----

FIXTURE_INFO_SELECT = """
select event as gameweek_id, finished, kickoff_time, "minutes",
       team_a as away_team_id, team_a_score as away_team_score,
       team_h as home_team_id, team_h_score as home_team_score,
       team_h_difficulty, team_a_difficulty,
       cast(case when team_h_score > team_a_score then 3
                 when team_h_score = team_a_score then 1 else 0 end as bigint) as home_points,
       cast(case when team_a_score > team_h_score then 3
                 when team_a_score = team_h_score then 1 else 0 end as bigint) as away_points,
       case when team_h_score > team_a_score then 'W' when team_h_score < team_a_score then 'L'
            when team_h_score = team_a_score then 'D' end as home_result,
       case when team_a_score > team_h_score then 'W' when team_a_score < team_h_score then 'L'
            when team_a_score = team_h_score then 'D' end as away_result
from fx_fixtures where event is not null"""

# One row per team side (written as a union here; Spark uses inline(array)).
SIDES = """
select home_team_id as team_id, true as is_home, home_team_score as gf,
       away_team_score as ga, home_points as pts, home_result as res from fixture_info
where home_team_id is not null
union all
select away_team_id, false, away_team_score, home_team_score, away_points, away_result
from fixture_info where away_team_id is not null"""

TEAM_AGG = """
select team_id,
  count(case when is_home then 1 end) as home_games,
  count(case when not is_home then 1 end) as away_games,
  count(res) as decided_games,
  count(case when is_home and res = 'W' then 1 end) as home_wins,
  count(case when is_home and res = 'L' then 1 end) as home_loss,
  count(case when is_home and res = 'D' then 1 end) as home_draw,
  count(case when not is_home and res = 'W' then 1 end) as away_wins,
  count(case when not is_home and res = 'L' then 1 end) as away_loss,
  count(case when not is_home and res = 'D' then 1 end) as away_draw,
  cast(coalesce(sum(case when is_home then gf end), 0) as bigint) as home_goals_scored,
  cast(coalesce(sum(case when not is_home then gf end), 0) as bigint) as away_goals_scored,
  cast(coalesce(sum(case when is_home then ga end), 0) as bigint) as home_goals_against,
  cast(coalesce(sum(case when not is_home then ga end), 0) as bigint) as away_goals_against,
  cast(coalesce(sum(case when is_home then pts end), 0) as bigint) as home_points,
  cast(coalesce(sum(case when not is_home then pts end), 0) as bigint) as away_points
from sides group by team_id"""


def standings_ctes(fixture_filter: str = "") -> list:
    fi = FIXTURE_INFO_SELECT + (f" and {fixture_filter}" if fixture_filter else "")
    return ["fx_fixtures", "fx_teams", ("fixture_info", fi), ("sides", SIDES), ("agg", TEAM_AGG)]


TBL = """
  select *, home_wins + away_wins as total_wins, home_loss + away_loss as total_loss,
         home_draw + away_draw as total_draw,
         home_wins + away_wins + home_loss + away_loss + home_draw + away_draw as games_played,
         home_goals_scored + away_goals_scored as total_goals_scored,
         home_goals_against + away_goals_against as total_goals_against,
         home_goals_scored + away_goals_scored - home_goals_against - away_goals_against as goal_difference,
         home_goals_scored - home_goals_against as home_goal_difference,
         away_goals_scored - away_goals_against as away_goal_difference,
         home_points + away_points as total_points
  from agg where home_games > 0 and away_games > 0 and decided_games > 0"""

RANKED = """
  select t1.*, (select count(*) from tbl t2 where t2.total_points >= t1.total_points) as league_position
  from tbl t1"""

LEAGUE_SELECT = """
select r.team_id, t.name as team_name, total_points, league_position, games_played, total_wins,
       total_loss, total_draw, total_goals_scored, total_goals_against, goal_difference,
       home_wins, away_wins, home_loss, away_loss, home_draw, away_draw, home_points,
       away_points, home_goals_scored, away_goals_scored, home_goals_against,
       away_goals_against, home_goal_difference, away_goal_difference, t.strength,
       t.strength_overall_home / 100 as strength_overall_home,
       t.strength_overall_away / 100 as strength_overall_away,
       t.strength_attack_home / 100 as strength_attack_home,
       t.strength_attack_away / 100 as strength_attack_away,
       t.strength_defence_home / 100 as strength_defence_home,
       t.strength_defence_away / 100 as strength_defence_away
from ranked r join fx_teams t on r.team_id = t.id"""


def league_ctes(fixture_filter: str = "") -> list:
    return standings_ctes(fixture_filter) + [("tbl", TBL), ("ranked", RANKED)]


def league_table_sql() -> str:
    return sql(LEAGUE_SELECT, *league_ctes())


# ------------------------------------------------------------- helpers -----

from .. import schemas as SC  # noqa: E402

DUCK = {"bigint": "bigint", "string": "varchar", "double": "double", "boolean": "boolean",
        "timestamp_ntz": "timestamp"}


def q(name: str) -> str:
    return f'"{name}"'


def conform_cols(schema, present, exprs: dict | None = None) -> str:
    """Select list shaping rows like ``schema``: given expressions, columns
    present as they are, absent ones as typed nulls."""
    exprs = exprs or {}
    out = []
    for f in schema.fields:
        if f.name in exprs:
            out.append(f"{exprs[f.name]} as {q(f.name)}")
        elif f.name in present:
            out.append(q(f.name))
        else:
            out.append(f"cast(null as {DUCK[f.dataType.simpleString()]}) as {q(f.name)}")
    return ", ".join(out)


FX_COLS = {
    "fx_teams": set(SC.names(SC.TEAM)),
    "fx_fixtures": {"id", "event", "finished", "kickoff_time", "minutes", "team_h", "team_a",
                    "team_h_score", "team_a_score", "team_h_difficulty", "team_a_difficulty"},
    "fx_element_types": {"id", "plural_name_short"},
    "fx_elements": {"id", "first_name", "second_name", "element_type", "team", "now_cost",
                    "total_points", "influence", "selected_by_percent", "in_dreamteam",
                    "chance_of_playing_next_round"},
    "fx_history": {"element", "fixture", "round", "opponent_team", "kickoff_time",
                   "goals_scored", "assists", "minutes", "total_points", "expected_goals"},
    "fx_gw": {"id", "deadline_time", "average_entry_score", "highest_score", "most_selected"},
}

SCAN = {
    "scan_teams": ("fx_teams", SC.TEAM, ""),
    "scan_fixtures": ("fx_fixtures", SC.FIXTURE, " where event is not null"),
    "scan_elements": ("fx_elements", SC.ELEMENT, ""),
    "scan_positions": ("fx_element_types", SC.ELEMENT_TYPE, ""),
    "scan_gameweeks": ("fx_gw", SC.EVENT, ""),
    "scan_history": ("fx_history", SC.HISTORY, ""),
}


def scan_select(name: str, drop: tuple = ()) -> str:
    view, schema, where = SCAN[name]
    sch = SC.parsed(schema)
    sch = type(sch)([f for f in sch.fields if f.name not in drop])
    return f"select {conform_cols(sch, FX_COLS[view])} from {view}{where}"


def scan_sql(name: str, drop: tuple = ()) -> str:
    return sql(scan_select(name, drop), SCAN[name][0])


# Renames applied on the scanned rows.
PLAYER_RENAMED = {"id": "player_id", "element_type": "position_id", "team": "team_id",
                  "now_cost": "current_price"}
HISTORY_RENAMED = {"round": "gameweek_id", "element": "player_id", "total_points": "points",
                   "opponent_team": "opponent_id"}


def renamed_select(schema, mapping: dict) -> str:
    return ", ".join(f"{q(f.name)} as {q(mapping.get(f.name, f.name))}" for f in schema.fields)


ELEMENTS_RENAMED = ("elements_renamed", "select " + renamed_select(SC.parsed(SC.ELEMENT), PLAYER_RENAMED)
                    + " from scan_elements")
POSITIONS_RENAMED = ("positions", "select id as position_id, plural_name_short as position "
                     "from fx_element_types")


def _player_cast_exprs() -> dict:
    src = {f.name: f.dataType for f in SC.parsed(SC.ELEMENT).fields}
    src = {PLAYER_RENAMED.get(k, k): v for k, v in src.items()}
    out = {}
    for f in SC.PLAYER_INFO.fields:
        have, want = src.get(f.name), f.dataType
        if have is None or have == want:
            continue
        if want.simpleString() == "string" and have.simpleString() == "boolean":
            out[f.name] = f"case when {q(f.name)} then 'True' when not {q(f.name)} then 'False' end"
        else:
            out[f.name] = f"try_cast({q(f.name)} as {DUCK[want.simpleString()]})"
    return out


PLAYER_CAST_SELECT = ("select " + conform_cols(SC.PLAYER_INFO, set(SC.names(SC.PLAYER_INFO)),
                                               _player_cast_exprs())
                      + " from elements_renamed e join positions p using (position_id)")


def fill_zero(schema, src: str) -> str:
    cols = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        if t in ("bigint", "double"):
            cols.append(f"coalesce({q(f.name)}, 0) as {q(f.name)}" if t == "bigint"
                        else f"coalesce({q(f.name)}, 0.0) as {q(f.name)}")
        else:
            cols.append(q(f.name))
    return f"select {', '.join(cols)} from {src}"


PLAYER_CTES = ["fx_elements", "fx_element_types", ("scan_elements", scan_select("scan_elements")),
               ELEMENTS_RENAMED, POSITIONS_RENAMED]


def player_info_ctes(element_filter: str = "") -> list:
    scan = scan_select("scan_elements") + (f" where {element_filter}" if element_filter else "")
    return ["fx_elements", "fx_element_types", ("scan_elements", scan), ELEMENTS_RENAMED,
            POSITIONS_RENAMED, ("player_cast", PLAYER_CAST_SELECT),
            ("player_info", fill_zero(SC.PLAYER_INFO, "player_cast"))]


# history: scanned → renamed → typed; game_count per (player, gameweek)
HISTORY_MEASURED = SC.names(SC.PLAYER_GW_STATS)[:-2]


def _history_frame_select(extra: tuple = ()) -> str:
    src = {HISTORY_RENAMED.get(f.name, f.name): f.dataType for f in SC.parsed(SC.HISTORY).fields}
    cols = []
    for f in SC.PLAYER_GW_STATS.fields:
        if f.name not in HISTORY_MEASURED:
            continue
        have = src[f.name]
        if have == f.dataType:
            cols.append(q(f.name))
        else:
            cols.append(f"try_cast({q(f.name)} as {DUCK[f.dataType.simpleString()]}) as {q(f.name)}")
    cols += [q(c) for c in extra]
    return f"select {', '.join(cols)} from history_renamed"


def history_ctes(where: str = "", extra: tuple = ()) -> list:
    scan = scan_select("scan_history")
    if extra:
        scan = scan.replace(" from fx_history", ", line from fx_history")
    scan += f" where {where}" if where else ""
    renamed = "select " + renamed_select(SC.parsed(SC.HISTORY), HISTORY_RENAMED) + \
        (", line" if extra else "") + " from scan_history"
    return ["fx_history", ("scan_history", scan), ("history_renamed", renamed),
            ("history_frame", _history_frame_select(extra))]


PLAYER_GW_SELECT = """
select h.*, c.game_count, coalesce(c.game_count > 1, false) as dgw
from history_frame h left join (
  select player_id, gameweek_id, count(*) as game_count from history_frame
  where player_id is not null and gameweek_id is not null group by 1, 2) c
using (player_id, gameweek_id)"""


def player_gw_sql(where: str = "", extra: tuple = ()) -> list:
    return history_ctes(where, extra) + [("player_gw", PLAYER_GW_SELECT)]


GW_FRAME = "select " + ", ".join(q(c) for c in SC.names(SC.GW_STATS)) + " from scan_gameweeks"


def gw_ctes(where: str = "") -> list:
    scan = scan_select("scan_gameweeks") + (f" where {where}" if where else "")
    return ["fx_gw", ("scan_gameweeks", scan), ("gw_frame", GW_FRAME),
            ("gw_stats", fill_zero(SC.GW_STATS, "gw_frame"))]


def upsert_sql(target: str, source: str, keys: list[str], cols: list[str]) -> str:
    """Source wins when present; target rows with no source row stay."""
    on = " and ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    return (f"select {', '.join(q(c) for c in cols)} from {source} union all "
            f"select {', '.join('t.' + q(c) for c in cols)} from {target} t "
            f"where not exists (select 1 from {source} s where {on})")


MATCH_COLS = "gameweek_id, home_team_id, away_team_id, home_team_score, away_team_score"

GW_KEY = ", ".join(q(k) for k in SC.PLAYER_GW_STATS_KEY)
LATEST_ORDER = ["kickoff_time", "fixture", "line"]
_PGW_REST = [c for c in SC.names(SC.PLAYER_GW_STATS) + LATEST_ORDER
             if c not in SC.PLAYER_GW_STATS_KEY and c not in LATEST_ORDER]
LATEST_BY = ", ".join(f"{q(c)} desc nulls last" for c in LATEST_ORDER + _PGW_REST)


def _latest(src: str) -> str:
    return (f"select * exclude (rn) from (select *, row_number() over (partition by {GW_KEY} "
            f"order by {LATEST_BY}) as rn from {src}) where rn = 1")


def _pgw_load(prefix: str, where: str) -> list:
    ctes = player_gw_sql(where, tuple(LATEST_ORDER))
    out = []
    for c in ctes:
        if isinstance(c, str):
            continue
        name, text = c
        for other in ("scan_history", "history_renamed", "history_frame", "player_gw"):
            text = re.sub(rf"\bfrom {other}\b", f"from {prefix}_{other}", text)
        out.append((f"{prefix}_{name}", text))
    out.append((f"{prefix}_latest", _latest(f"{prefix}_player_gw")))
    return out


ORACLES: dict[str, str] = {
    "league_table": league_table_sql(),
    "fixture_info": sql(FIXTURE_INFO_SELECT, "fx_fixtures"),
    "result_counts": sql("""
select team_id, home_wins, home_loss, home_draw, away_wins, away_loss, away_draw,
       home_wins + away_wins as total_wins, home_loss + away_loss as total_loss,
       home_draw + away_draw as total_draw,
       home_wins + away_wins + home_loss + away_loss + home_draw + away_draw as games_played
from agg where decided_games > 0""", *standings_ctes()),
    "goals": sql("""
select team_id, home_goals_scored, away_goals_scored, home_goals_against, away_goals_against,
       home_goals_scored + away_goals_scored as total_goals_scored,
       home_goals_against + away_goals_against as total_goals_against,
       home_goals_scored + away_goals_scored - home_goals_against - away_goals_against as goal_difference,
       home_goals_scored - home_goals_against as home_goal_difference,
       away_goals_scored - away_goals_against as away_goal_difference
from agg where home_games > 0 and away_games > 0""", *standings_ctes()),
    "team_points": sql("""
select team_id, home_points, away_points, home_points + away_points as total_points
from agg where home_games > 0 and away_games > 0""", *standings_ctes()),
    "match_points": sql(f"select {MATCH_COLS}, home_points, away_points from fixture_info",
                        *standings_ctes()),
    "match_result": sql(f"select {MATCH_COLS}, home_result, away_result from fixture_info",
                        *standings_ctes()),
    "filter_result": sql(f"select {MATCH_COLS}, home_result from fixture_info "
                         "where home_result = 'W'", *standings_ctes()),
    "result_pivot": sql("""
select team_id, count(case when res = 'W' then 1 end) as result_w,
       count(case when res = 'L' then 1 end) as result_l,
       count(case when res = 'D' then 1 end) as result_d
from sides where res is not null group by team_id""", *standings_ctes()),
    "join_full_outer": sql("""
select team_id, home_wins, home_loss, home_draw, away_wins, away_loss, away_draw
from agg where decided_games > 0""", *standings_ctes()),
    "team_strength": sql("""
select id as team_id, name as team_name, strength,
       strength_overall_home / 100 as strength_overall_home,
       strength_overall_away / 100 as strength_overall_away,
       strength_attack_home / 100 as strength_attack_home,
       strength_attack_away / 100 as strength_attack_away,
       strength_defence_home / 100 as strength_defence_home,
       strength_defence_away / 100 as strength_defence_away
from fx_teams""", "fx_teams"),
    "join_team_dim": sql("""
select a.team_id, home_points, away_points, home_points + away_points as total_points,
       name as team_name, strength,
       strength_overall_home / 100 as strength_overall_home,
       strength_overall_away / 100 as strength_overall_away,
       strength_attack_home / 100 as strength_attack_home,
       strength_attack_away / 100 as strength_attack_away,
       strength_defence_home / 100 as strength_defence_home,
       strength_defence_away / 100 as strength_defence_away
from agg a join fx_teams t on a.team_id = t.id
where home_games > 0 and away_games > 0""", *standings_ctes()),
    "rank_max": sql("""
select id as player_id, team as team_id, total_points,
       count(*) over (partition by team order by total_points desc
                      range between unbounded preceding and current row) as team_rank
from fx_elements""", "fx_elements"),
    "refresh_fixtures": sql(FIXTURE_INFO_SELECT, "fx_fixtures"),
    "staging_conform": sql(
        "select " + conform_cols(
            SC.PLAYER_GW_STATS, set(),
            {**{c: q(c) for c in ("player_id", "gameweek_id", "opponent_id", "goals_scored",
                                  "assists", "minutes", "points")},
             "expected_goals": 'try_cast("expected_goals" as double)'})
        + " from history_renamed", *history_ctes()),
    # scans
    **{name: scan_sql(name) for name in ("scan_teams", "scan_elements", "scan_positions",
                                         "scan_gameweeks", "scan_history")},
    "scan_fixtures": scan_sql("scan_fixtures", drop=("stats",)),
    "json_flatten": """
select event_id, ts, user_id, event_type, value,
       cast(json_extract_string(props, '$.k') as bigint) as props_k
from events""",
    "union_pages": sql(f"""
select element, fixture, "round", opponent_team, kickoff_time, goals_scored, assists, "minutes",
       total_points,
       case when kickoff_time < timestamp '{FIXTURE_CUTOFF}' then null else expected_goals end
         as expected_goals, line
from fx_history""", "fx_history"),
    # projections and players
    "project_rename": sql("select * from elements_renamed", *PLAYER_CTES[:4]),
    "project_select": sql("select gameweek_id, finished, kickoff_time, \"minutes\", away_team_id, "
                          "away_team_score, home_team_id, home_team_score, team_h_difficulty, "
                          "team_a_difficulty from fixture_info", *standings_ctes()),
    "player_cast": sql(PLAYER_CAST_SELECT, *PLAYER_CTES),
    "fill_nulls": sql(fill_zero(SC.parsed(SC.ELEMENT), "scan_elements"), *PLAYER_CTES[:3]),
    "bool_label": sql("select player_id, case when in_dreamteam then 'True' "
                      "when not in_dreamteam then 'False' end as in_dreamteam "
                      "from elements_renamed", *PLAYER_CTES[:4]),
    "join_player_position": sql("select player_id, first_name, second_name, position_id, "
                                "position, team_id from elements_renamed "
                                "join positions using (position_id)", *PLAYER_CTES),
    "player_info": sql("select * from player_info", *player_info_ctes()),
    # gameweeks
    "player_gw_stats": sql("select * from player_gw", *player_gw_sql()),
    "dgw_flag": sql("select player_id, gameweek_id, opponent_id, game_count, dgw from player_gw",
                    *player_gw_sql()),
    "value_counts": sql("select player_id, gameweek_id, count(*) as game_count from history_frame "
                        "where player_id is not null and gameweek_id is not null group by 1, 2",
                        *history_ctes()),
    "gameweek_counts": sql(
        "select gameweek_id, " + ", ".join(f"count({q(c)}) as {q(c)}" for c in HISTORY_MEASURED
                                           if c != "gameweek_id")
        + " from history_frame where gameweek_id is not null group by gameweek_id",
        *history_ctes()),
    "gw_stats": sql("select * from gw_stats", *gw_ctes()),
}


def _is_before(col: str, when: str) -> str:
    return f"coalesce({col} < timestamp '{when}', false)"


def _upsert_team() -> str:
    old = _is_before("kickoff_time", FIXTURE_CUTOFF)
    ctes = ["fx_fixtures", "fx_teams"]
    for prefix, cond in (("t", old), ("s", f"not ({old})")):
        for name, text in league_ctes(cond)[2:] + [("league", LEAGUE_SELECT)]:
            for other in ("fixture_info", "sides", "agg", "tbl", "ranked"):
                text = text.replace(f"from {other}", f"from {prefix}_{other}")
            out_name = f"{prefix}_{name}"
            ctes.append((out_name, text))
    ctes += [("target", "select * from t_league where league_position > 3"),
             ("source", "select * replace (case when league_position > 5 then strength_attack_home end as strength_attack_home) "
                        "from s_league where league_position <= 20")]
    return sql(upsert_sql("target", "source", SC.TEAM_INFO_KEY, SC.names(SC.TEAM_INFO)), *ctes)


def _upsert_player() -> str:
    ctes = ["fx_elements", "fx_element_types"]
    for prefix, cond in (("t", f"team < {PLAYER_TARGET_TEAMS_BELOW}"),
                         ("s", f"(team >= {PLAYER_SOURCE_TEAMS_FROM} or team is null)")):
        for name, text in player_info_ctes(cond)[2:]:
            for other in ("scan_elements", "elements_renamed", "player_cast", "positions"):
                text = text.replace(f"from {other}", f"from {prefix}_{other}") \
                    .replace(f"join {other}", f"join {prefix}_{other}")
            ctes.append((f"{prefix}_{name}", text))
    ctes.append(("source", "select * replace (total_points + 7 as total_points, "
                 "case when total_points >= 20 then influence end as influence) from s_player_info"))
    return sql(upsert_sql("t_player_info", "source", SC.PLAYER_INFO_KEY, SC.names(SC.PLAYER_INFO)), *ctes)


def _upsert_gameweek() -> str:
    ctes = ["fx_gw"]
    for prefix, cond in (("t", _is_before("deadline_time", EVENT_TARGET_BEFORE)),
                         ("s", f"not {_is_before('deadline_time', EVENT_SOURCE_FROM)}")):
        for name, text in gw_ctes(cond)[1:]:
            for other in ("scan_gameweeks", "gw_frame"):
                text = text.replace(f"from {other}", f"from {prefix}_{other}")
            ctes.append((f"{prefix}_{name}", text))
    ctes.append(("source", "select * replace (highest_score + 1 as highest_score, "
                 "case when average_entry_score >= 50 then most_selected end as most_selected) from s_gw_stats"))
    return sql(upsert_sql("t_gw_stats", "source", SC.GW_STATS_KEY, SC.names(SC.GW_STATS)), *ctes)


def _upsert_player_gw() -> str:
    ctes = ["fx_history"] + _pgw_load("t", _is_before("kickoff_time", FIXTURE_CUTOFF)) \
        + _pgw_load("s", f"not {_is_before('kickoff_time', FIXTURE_SOURCE_FROM)}")
    ctes.append(("source", "select * replace (points + 1 as points, "
                 "case when points < 10 then expected_goals end as expected_goals) from s_latest"))
    return sql(upsert_sql("t_latest", "source", SC.PLAYER_GW_STATS_KEY, SC.names(SC.PLAYER_GW_STATS)), *ctes)


SNAPSHOT_CTES = [
    ("dates", " union all ".join(f"select timestamp '{d}' as d" for d in SNAPSHOT_DATES)),
    ("snapshots", """
select id as element, team, d as snapshot_date,
       total_points + case when id % 3 = 0 then 0 else year(d) - 1992 end as total_points
from fx_elements, dates where (id + month(d)) % 5 <> 0"""),
]


def _refresh_gameweeks() -> str:
    older = """select * replace (case when gameweek_id % 5 = 0 and home_team_id = 3 then "minutes" + 1 else "minutes" end as "minutes")
from fixture_info where gameweek_id <> 7"""
    differ = """select gameweek_id from (select * from older except all select * from newer)
union select gameweek_id from (select * from newer except all select * from older)"""
    return sql("""
select gameweek_id, case when rows_before = 0 then 'new' when rows_after = 0 then 'gone' else 'changed' end as change,
       rows_before, rows_after
from (select gameweek_id, (select count(*) from older o where o.gameweek_id = d.gameweek_id) as rows_before,
             (select count(*) from newer n where n.gameweek_id = d.gameweek_id) as rows_after from differ d)""",
               *standings_ctes()[:3], ("older", older), ("newer", "select * from fixture_info where gameweek_id <> 11"), ("differ", differ))


ORACLES.update({
    "league_incremental": ORACLES["league_table"],
    "json_discover": ORACLES["json_flatten"],
    "match_points_sql": ORACLES["match_points"],
    "player_as_of": sql("""
select h.element, fixture, line, kickoff_time, s_date as snapshot_date, s.total_points, s.team
from (select *, (select max(d) from dates where d <= kickoff_time) as s_date from fx_history) h
left join snapshots s on h.element = s.element and s_date = snapshot_date""", "fx_history", "fx_elements", *SNAPSHOT_CTES),
    "player_intervals": sql("""
select element, total_points, team, valid_from, (select min(d) from dates where d > last_date) as valid_to
from (select element, total_points, team, min(snapshot_date) as valid_from, max(snapshot_date) as last_date
from (select *, n - row_number() over (partition by element, total_points, team order by n) as island
      from (select *, (select count(*) from dates where d <= snapshot_date) as n from snapshots))
group by element, total_points, team, island)""", "fx_elements", *SNAPSHOT_CTES),
    "result_crosstab": sql("""
select team_id, count(case when res = 'D' then 1 end) as "result_D", count(case when res = 'L' then 1 end) as "result_L",
       count(case when res = 'W' then 1 end) as "result_W"
from sides where res is not null group by team_id""", *standings_ctes()),
    "cast_rejects": sql(" union all ".join(
        f"select '{c}' as \"column\", count({e}) as \"values\", count(case when {e} is not null and try_cast({e} as {t}) is null then 1 end) as rejected from fx_elements"
        for c, e, t in (("second_name", "second_name", "double"), ("now_cost", "now_cost", "double"),
                        ("influence", "(case when id % 7 = 0 then 'n/a' else influence end)", "double"),
                        ("selected_by_percent", "(case when id % 11 = 0 then '' else selected_by_percent end)", "double"),
                        ("chance_of_playing_next_round", "chance_of_playing_next_round", "bigint"))), "fx_elements"),
    "refresh_gameweeks": _refresh_gameweeks(),
    "upsert_team": _upsert_team(),
    "upsert_player": _upsert_player(),
    "upsert_gameweek": _upsert_gameweek(),
    "upsert_player_gw": _upsert_player_gw(),
})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
