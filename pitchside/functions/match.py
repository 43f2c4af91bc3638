"""Per-match column expressions.  All JVM-side; no Python UDFs.

Scores are nullable integers.  A null score means "not played yet": no points and
no result.  (A comparison with null is null, so the ``when`` chain falls through.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring rule: points for a win, a draw and a loss.
WIN_POINTS, DRAW_POINTS, LOSS_POINTS = 3, 1, 0
# Fixed result labels.
WIN, LOSS, DRAW = "W", "L", "D"


def _sql_name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def points_sql(goals_for: str, goals_against: str) -> str:
    """SQL text: 3 for a win, 1 for a draw, 0 for a loss or an unplayed match."""
    gf, ga = _sql_name(goals_for), _sql_name(goals_against)
    return (f"cast(case when {gf} > {ga} then {WIN_POINTS} when {gf} = {ga} then {DRAW_POINTS} "
            f"else {LOSS_POINTS} end as bigint)")


def result_sql(goals_for: str, goals_against: str) -> str:
    """SQL text: 'W' / 'L' / 'D', null when either score is null."""
    gf, ga = _sql_name(goals_for), _sql_name(goals_against)
    return (f"case when {gf} > {ga} then '{WIN}' when {gf} < {ga} then '{LOSS}' "
            f"when {gf} = {ga} then '{DRAW}' end")


def match_points(goals_for: str, goals_against: str) -> Column:
    """Points of the side whose goals are in column ``goals_for`` (bigint)."""
    return F.expr(points_sql(goals_for, goals_against))


def match_result(goals_for: str, goals_against: str) -> Column:
    """Result letter of the side whose goals are in column ``goals_for``."""
    return F.expr(result_sql(goals_for, goals_against))


def dgw_flag(game_count: Column | str) -> Column:
    """Double gameweek: more than one game for the player in the gameweek."""
    c = F.col(game_count) if isinstance(game_count, str) else game_count
    return c > 1
