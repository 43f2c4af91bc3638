"""Match scoring and the league table.

Plan shape (see README, section "Plans"): the fixtures are read once, every fixture is
turned into two team-side rows with ``inline(array(home, away))`` (no second
scan, no union), and ONE ``groupBy(team_id)`` computes all result counts, goal
sums and points with conditional aggregates.  The aggregation is partial on the
map side, so whatever the number of fixtures — and however many of them belong
to one team — each task ships at most one row per team to the shuffle.  The
ranking window and the dimension join then run on one row per team.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as SC
from ..functions.match import DRAW, LOSS, WIN, match_points, match_result
from .columns import rename, scale_columns
from .joins import HOT_KEY_ROWS, attach_per_key, dimension_join, shuffle_partitions

FIXTURE_RENAMES = {
    "event": "gameweek_id", "team_a": "away_team_id", "team_a_score": "away_team_score",
    "team_h": "home_team_id", "team_h_score": "home_team_score",
}
FIXTURE_COLUMNS = [
    "gameweek_id", "finished", "kickoff_time", "minutes", "away_team_id",
    "away_team_score", "home_team_id", "home_team_score", "stats",
    "team_h_difficulty", "team_a_difficulty",
]
TEAM_RENAMES = {"id": "team_id", "name": "team_name"}
STRENGTH_DIVISOR = 100


# ------------------------------------------------------------ per match ----

def fixture_frame(fixtures: DataFrame) -> DataFrame:
    """Scanned fixtures → renamed, pruned fixture rows (``stats`` kept if present)."""
    df = rename(fixtures, FIXTURE_RENAMES)
    return df.select(*[c for c in FIXTURE_COLUMNS if c in df.columns])


def score_fixtures(frame: DataFrame) -> DataFrame:
    """Add points and result letters for both sides."""
    h, a = "home_team_score", "away_team_score"
    return frame.withColumns({
        "home_points": match_points(h, a), "away_points": match_points(a, h),
        "home_result": match_result(h, a), "away_result": match_result(a, h),
    })


def fixture_info(fixtures: DataFrame) -> DataFrame:
    """The ``fixture_info`` table (14 columns, one row per fixture)."""
    return score_fixtures(fixture_frame(fixtures)).select(*SC.names(SC.FIXTURE_INFO))


def team_sides(scored: DataFrame) -> DataFrame:
    """Two rows per fixture: (team_id, is_home, goals_for, goals_against, points, result).

    Fixtures with a null team id give no side row for that team (a null group
    key is not a team).
    """
    def side(home: bool) -> str:
        me, other = ("home", "away") if home else ("away", "home")
        return (f"named_struct('team_id', {me}_team_id, 'is_home', {str(home).lower()}, "
                f"'goals_for', {me}_team_score, 'goals_against', {other}_team_score, "
                f"'points', {me}_points, 'result', {me}_result)")

    return scored.selectExpr(f"inline(array({side(True)}, {side(False)}))") \
        .filter("team_id is not null")


# ------------------------------------------------------------- per team ----

RESULT_COLUMNS = ["home_wins", "home_loss", "home_draw", "away_wins", "away_loss", "away_draw"]
GOAL_COLUMNS = ["home_goals_scored", "away_goals_scored", "home_goals_against",
                "away_goals_against"]
POINT_COLUMNS = ["home_points", "away_points"]


def _team_measures() -> dict[str, str]:
    """Name → aggregate (SQL text) of every per-team measure."""
    out = {"home_games": "count_if(is_home)", "away_games": "count_if(not is_home)",
           "decided_games": "count_if(result is not null)"}
    for side, cond in (("home", "is_home"), ("away", "not is_home")):
        for name, letter in (("wins", WIN), ("loss", LOSS), ("draw", DRAW)):
            out[f"{side}_{name}"] = f"count_if({cond} and result = '{letter}')"
    # A sum over no values (all scores null) is 0, not null.
    for side, cond in (("home", "is_home"), ("away", "not is_home")):
        for name, value in (("goals_scored", "goals_for"), ("goals_against", "goals_against"),
                            ("points", "points")):
            out[f"{side}_{name}"] = f"coalesce(sum(if({cond}, {value}, null)), 0L)"
    return out


TEAM_MEASURES = _team_measures()


def team_aggregate(sides: DataFrame) -> DataFrame:
    """One pass: every per-team count and sum, plus the three presence counts."""
    return sides.groupBy("team_id").agg(
        *[F.expr(e).alias(n) for n, e in TEAM_MEASURES.items()])


def _result_totals(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*", "home_wins + away_wins as total_wins", "home_loss + away_loss as total_loss",
        "home_draw + away_draw as total_draw",
        "home_wins + away_wins + home_loss + away_loss + home_draw + away_draw as games_played")


def _goal_totals(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*",
        "home_goals_scored + away_goals_scored as total_goals_scored",
        "home_goals_against + away_goals_against as total_goals_against",
        "home_goals_scored - home_goals_against as home_goal_difference",
        "away_goals_scored - away_goals_against as away_goal_difference",
        "home_goals_scored + away_goals_scored - home_goals_against - away_goals_against"
        " as goal_difference")


def _played_both_ways() -> Column:
    return F.expr("home_games > 0 and away_games > 0")


def result_counts(scored: DataFrame) -> DataFrame:
    """Wins / losses / draws home and away per team, teams with ≥ 1 decided match."""
    agg = team_aggregate(team_sides(scored)).filter(F.col("decided_games") > 0)
    return _result_totals(agg).select(
        "team_id", *RESULT_COLUMNS, "total_wins", "total_loss", "total_draw", "games_played")


def goals(scored: DataFrame) -> DataFrame:
    """Goals for and against, home and away, teams with home and away fixtures."""
    agg = team_aggregate(team_sides(scored)).filter(_played_both_ways())
    return _goal_totals(agg).select(
        "team_id", *GOAL_COLUMNS, "total_goals_scored", "total_goals_against",
        "goal_difference", "home_goal_difference", "away_goal_difference")


def team_points(scored: DataFrame) -> DataFrame:
    agg = team_aggregate(team_sides(scored)).filter(_played_both_ways())
    return agg.select("team_id", *POINT_COLUMNS,
                      (F.col("home_points") + F.col("away_points")).alias("total_points"))


def result_pivot(scored: DataFrame) -> DataFrame:
    """Cross-tab team × result letter (home and away together); missing cells are 0."""
    sides = team_sides(scored).filter(F.col("result").isNotNull())
    out = sides.groupBy("team_id").pivot("result", [WIN, LOSS, DRAW]).count()
    return out.select(
        "team_id",
        *[F.coalesce(F.col(v), F.lit(0).cast("bigint")).alias(f"result_{v.lower()}")
          for v in (WIN, LOSS, DRAW)])


# ---------------------------------------------------------------- ranking ---

def rank_max_window(df: DataFrame, value: str, out: str, partition_by: list[str] = ()) -> DataFrame:
    """Descending rank where a tie takes the worst place of the tie (10,8,8,8,5 →
    1,4,4,4,5) — the number of rows whose value is ≥ this one.  A null value
    gets a null rank.  Window form: for inputs that are already small (one row
    per team after aggregation)."""
    w = Window.partitionBy(*partition_by).orderBy(F.col(value).desc()) \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.count(F.lit(1)).over(w)))


#: Value ranges of a large partition in ``rank_max``: each is ranked in a task of its own.
RANK_RANGES = 64


def value_ranges(rows: DataFrame, value: str, whole: list[str]) -> tuple[DataFrame, DataFrame]:
    """(counts, ranged): rows per distinct (partition, value), and the same with the ``_range`` of
    the value inside its partition: 0 .. ``RANK_RANGES`` - 1 in a large partition, else 0."""
    keys = [*whole, value]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = rows.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    number = F.col(value).cast("double")
    total = rows.agg(F.count(F.lit(1))).scalar()
    cuts = counts.groupBy(*whole).agg(
        F.count(F.lit(1)).alias("_values"),
        F.percentile_approx(number, [i / RANK_RANGES for i in range(1, RANK_RANGES)]).alias("_cuts")) \
        .where(F.col("_values") * (2 * shuffle_partitions(rows)) > total)
    return counts, counts.join(F.broadcast(cuts.select(*whole, "_cuts")), whole, "left").select(
        *keys, "_n", F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < number)), F.lit(0)).alias("_range"))


def rank_max(df: DataFrame, value: str, out: str, partition_by: list[str] = (),
             hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Same ranking for inputs of any size.

    Rows are first counted per distinct (partition, value) — a partial
    aggregation, so a value held by a third of all rows ships one row per task.
    A partition with more than 1/(2P) of the rows as distinct values (P: shuffle
    partitions; fewer than 2P partitions can have so many) is cut into ``RANK_RANGES``
    ranges at its own quantiles, which come from a mergeable sketch per partition; the
    running total runs inside the ranges, with the totals of the higher ranges added, so
    no task holds all values however the partitions are skewed.  The ranks are joined back
    with ``attach_per_key``: a value held by very many rows is split over salted tasks.
    Rows with a null value or partition get a null rank.
    """
    whole = list(partition_by) or ["_all"]
    rows = df if partition_by else df.withColumn("_all", F.lit(0))
    keys = [*whole, value]
    counts, ranged = value_ranges(rows, value, whole)
    inside = Window.partitionBy(*whole, "_range").orderBy(F.col(value).desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = Window.partitionBy(*whole).orderBy(F.col("_range").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    higher = ranged.groupBy(*whole, "_range").agg(F.sum("_n").alias("_sum")).select(
        *whole, "_range", F.coalesce(F.sum("_sum").over(above), F.lit(0)).alias("_higher"))
    ranks = ranged.withColumn("_inside", F.sum("_n").over(inside)).join(higher, [*whole, "_range"]) \
        .select(*keys, "_n", (F.col("_inside") + F.col("_higher")).alias(out))
    return attach_per_key(rows, ranks, keys, "_n", hot_key_rows=hot_key_rows, counts=counts).select(*df.columns, out)


# ------------------------------------------------------------ the table -----

def team_strength(teams: DataFrame) -> DataFrame:
    """Team dimension with the six ratings divided by 100 (``strength`` is not)."""
    t = rename(teams, TEAM_RENAMES)
    return scale_columns(t, SC.STRENGTH_COLUMNS, STRENGTH_DIVISOR).select(
        "team_id", "team_name", "strength", *SC.STRENGTH_COLUMNS)


def league_table(fixtures: DataFrame, teams: DataFrame, rank: str = "window") -> DataFrame:
    """The ``team_info`` table (32 columns) from scanned fixtures and teams.

    A team is listed when it has at least one home fixture, one away fixture and
    one decided result, and is in the team dimension.  The position is ranked
    over all qualifying teams before the dimension join.  ``finished`` is not
    consulted: a match in progress counts with its current score.

    ``rank="window"`` ranks the per-team rows in one window (one partition
    holding one row per team — a league has tens of teams);
    ``rank="distinct"`` uses ``rank_max`` (running total over distinct point
    totals, joined back), for inputs with very many team ids.
    """
    return league_from_scored(score_fixtures(fixture_frame(fixtures)), teams, rank)


def league_from_scored(scored: DataFrame, teams: DataFrame, rank: str = "window") -> DataFrame:
    """The league table from scored fixture rows (e.g. a stored ``fixture_info``)."""
    return league_from_sums(team_aggregate(team_sides(scored)), teams, rank)


def league_from_sums(sums: DataFrame, teams: DataFrame, rank: str = "window") -> DataFrame:
    """The league table from every team's measures (``team_aggregate``, or maintained ones)."""
    agg = sums.filter(_played_both_ways() & (F.col("decided_games") > 0))
    table = _goal_totals(_result_totals(agg)).selectExpr(
        "*", "home_points + away_points as total_points")
    if rank == "window":
        ranked = rank_max_window(table, "total_points", "league_position")
    elif rank == "distinct":
        ranked = rank_max(table, "total_points", "league_position")
    else:
        raise ValueError(f"unknown rank method: {rank}")
    joined = dimension_join(ranked, team_strength(teams), "team_id", "inner")
    return joined.select(*SC.names(SC.TEAM_INFO))


def join_team_dim(per_team: DataFrame, teams: DataFrame) -> DataFrame:
    """Attach team name and ratings; teams missing from the dimension drop out."""
    return dimension_join(per_team, team_strength(teams), "team_id", "inner")
