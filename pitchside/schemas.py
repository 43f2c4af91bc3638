"""Declared schemas of the landed API documents and of the result tables.

Inference is never used: a field that is null in every record of a page would be
inferred as string, and that is exactly the "not played yet" case.

Text-number fields (``influence``, ``selected_by_percent``, ``expected_*`` …)
arrive as JSON strings; they are declared as strings here and converted by the
cast operator, leniently (``try_cast``) or strictly (``cast``).
"""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
TS = T.TimestampNTZType()


def struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------- inputs ----

TEAM = struct([
    ("id", L), ("name", S), ("strength", L),
    ("strength_overall_home", L), ("strength_overall_away", L),
    ("strength_attack_home", L), ("strength_attack_away", L),
    ("strength_defence_home", L), ("strength_defence_away", L),
])

FIXTURE_STAT_SIDE = T.ArrayType(struct([("value", L), ("element", L)]))
FIXTURE_STAT = struct([("identifier", S), ("a", FIXTURE_STAT_SIDE), ("h", FIXTURE_STAT_SIDE)])

FIXTURE = struct([
    ("id", L), ("event", L), ("finished", B), ("kickoff_time", S), ("minutes", L),
    ("team_a", L), ("team_a_score", L), ("team_h", L), ("team_h_score", L),
    ("team_h_difficulty", L), ("team_a_difficulty", L),
    ("stats", T.ArrayType(FIXTURE_STAT)),
])

ELEMENT_TYPE = struct([("id", L), ("plural_name_short", S)])

ELEMENT = struct([
    ("id", L), ("first_name", S), ("second_name", S), ("element_type", L), ("team", L),
    ("now_cost", L), ("total_points", L), ("goals_scored", L), ("assists", L),
    ("clean_sheets", L), ("goals_conceded", L), ("own_goals", L), ("penalties_saved", L),
    ("penalties_missed", L), ("yellow_cards", L), ("red_cards", L), ("saves", L),
    ("bonus", L), ("minutes", L), ("bps", L), ("influence", S), ("creativity", S),
    ("threat", S), ("in_dreamteam", B), ("dreamteam_count", L), ("selected_by_percent", S),
    ("transfers_in", L), ("transfers_in_event", L), ("transfers_out", L),
    ("transfers_out_event", L), ("chance_of_playing_next_round", L),
    ("chance_of_playing_this_round", L),
])

EVENT = struct([
    ("id", L), ("deadline_time", S), ("average_entry_score", L), ("highest_score", L),
    ("most_selected", L), ("most_transferred_in", L), ("top_element", L),
    ("most_captained", L), ("most_vice_captained", L),
])

HISTORY = struct([
    ("element", L), ("fixture", L), ("round", L), ("opponent_team", L),
    ("kickoff_time", S), ("total_points", L), ("goals_scored", L), ("assists", L),
    ("clean_sheets", L), ("goals_conceded", L), ("minutes", L), ("own_goals", L),
    ("penalties_missed", L), ("saves", L), ("penalties_saved", L), ("yellow_cards", L),
    ("red_cards", L), ("bonus", L), ("bps", L), ("influence", S), ("creativity", S),
    ("threat", S), ("transfers_balance", L), ("selected", L), ("transfers_in", L),
    ("transfers_out", L), ("expected_goals", S), ("expected_assists", S),
    ("expected_goal_involvements", S), ("expected_goals_conceded", S),
])

# One bootstrap document holds the four dimension arrays.
BOOTSTRAP = struct([
    ("teams", T.ArrayType(TEAM)), ("elements", T.ArrayType(ELEMENT)),
    ("element_types", T.ArrayType(ELEMENT_TYPE)), ("events", T.ArrayType(EVENT)),
])

# One element-summary document per player.
ELEMENT_SUMMARY = struct([("history", T.ArrayType(HISTORY))])

# --------------------------------------------------------------- outputs ----

STRENGTH_COLUMNS = [
    "strength_overall_home", "strength_overall_away", "strength_attack_home",
    "strength_attack_away", "strength_defence_home", "strength_defence_away",
]

TEAM_INFO = struct(
    [("team_id", L), ("team_name", S)]
    + [(c, L) for c in (
        "total_points", "league_position", "games_played", "total_wins", "total_loss",
        "total_draw", "total_goals_scored", "total_goals_against", "goal_difference",
        "home_wins", "away_wins", "home_loss", "away_loss", "home_draw", "away_draw",
        "home_points", "away_points", "home_goals_scored", "away_goals_scored",
        "home_goals_against", "away_goals_against", "home_goal_difference",
        "away_goal_difference", "strength")]
    + [(c, D) for c in STRENGTH_COLUMNS]
)
TEAM_INFO_KEY = ["team_id"]

FIXTURE_INFO = struct([
    ("gameweek_id", L), ("finished", B), ("kickoff_time", TS), ("minutes", L),
    ("away_team_id", L), ("away_team_score", L), ("home_team_id", L),
    ("home_team_score", L), ("team_h_difficulty", L), ("team_a_difficulty", L),
    ("home_points", L), ("away_points", L), ("home_result", S), ("away_result", S),
])

PLAYER_INFO = struct(
    [("player_id", L), ("first_name", S), ("second_name", S), ("position", S),
     ("team_id", L), ("current_price", D)]
    + [(c, L) for c in (
        "total_points", "goals_scored", "assists", "clean_sheets", "goals_conceded",
        "own_goals", "penalties_saved", "penalties_missed", "yellow_cards", "red_cards",
        "saves", "bonus", "minutes", "bps")]
    + [("influence", D), ("creativity", D), ("threat", D), ("in_dreamteam", S),
       ("dreamteam_count", L), ("selected_by_percent", D), ("transfers_in", L),
       ("transfers_in_event", L), ("transfers_out", L), ("transfers_out_event", L),
       ("chance_of_playing_next_round", L), ("chance_of_playing_this_round", L)]
)
PLAYER_INFO_KEY = ["player_id"]

PLAYER_GW_STATS = struct(
    [(c, L) for c in (
        "player_id", "gameweek_id", "opponent_id", "goals_scored", "assists",
        "clean_sheets", "goals_conceded", "minutes", "own_goals", "penalties_missed",
        "saves", "penalties_saved", "yellow_cards", "red_cards")]
    + [("influence", D), ("creativity", D), ("threat", D)]
    + [(c, L) for c in (
        "points", "bonus", "bps", "transfers_balance", "selected", "transfers_in",
        "transfers_out")]
    + [(c, D) for c in (
        "expected_goals", "expected_assists", "expected_goal_involvements",
        "expected_goals_conceded")]
    + [("game_count", L), ("dgw", B)]
)
PLAYER_GW_STATS_KEY = ["player_id", "gameweek_id", "opponent_id"]

GW_STATS = struct(
    [("id", L), ("deadline_time", TS)]
    + [(c, L) for c in (
        "average_entry_score", "highest_score", "most_selected", "most_transferred_in",
        "top_element", "most_captained", "most_vice_captained")]
)
GW_STATS_KEY = ["id"]


# Time fields arrive as ISO text and are parsed at scan time.
TIME_FIELDS = {"kickoff_time", "deadline_time"}


def parsed(schema: T.StructType) -> T.StructType:
    """The scan schema: the document schema with time fields parsed."""
    return T.StructType([
        T.StructField(f.name, TS if f.name in TIME_FIELDS else f.dataType, True)
        for f in schema.fields])


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]

#: The published tables; a partitioned one is read with its schema (its partition column has no stored type).
RESULT_TABLES = {"fixture_info": FIXTURE_INFO, "team_info": TEAM_INFO, "player_info": PLAYER_INFO,
                 "player_gw_stats": PLAYER_GW_STATS, "gw_stats": GW_STATS}
