"""The league table kept current from changed fixtures only.

Every measure of a team (games, results, goals, points) is a sum over its fixtures' side
rows, so a changed fixture is its old side rows with sign -1 and its new ones with sign +1.
Stored sums plus these deltas are the sums over all fixtures after the change, in whatever
order the changes come; positions are then ranked on one row per team.  The work follows
the changed fixtures and the number of teams, not the number of fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import q
from .standings import TEAM_MEASURES, score_fixtures, team_aggregate, team_sides

SUM_COLUMNS = ["team_id", *TEAM_MEASURES]


def scored(fixtures: DataFrame) -> DataFrame:
    """Fixture rows (renamed as in ``fixture_frame``) with points and results."""
    return score_fixtures(fixtures)


def team_sums(fixtures: DataFrame) -> DataFrame:
    """The measures of every team over ``fixtures`` (frame columns)."""
    return team_aggregate(team_sides(scored(fixtures))).select(*SUM_COLUMNS)


def add_sums(*sums: DataFrame) -> DataFrame:
    """Teams' measures added up; one shuffle of one row per team and table."""
    rows = sums[0]
    for s in sums[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy("team_id").agg(*[F.sum(c).cast("long").alias(c) for c in TEAM_MEASURES])


def negated(sums: DataFrame) -> DataFrame:
    return sums.select("team_id", *[(-F.col(c)).alias(c) for c in TEAM_MEASURES])


def apply_changes(sums: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """``sums`` after the fixtures ``old`` became ``new`` (either may be empty); teams left
    without a fixture drop out."""
    return add_sums(sums, negated(team_sums(old)), team_sums(new)).where("home_games + away_games > 0")


def replaced_rows(stored: DataFrame, changed: DataFrame, keys: list[str], newer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(old, new): of the rows ``changed`` (unique by key) those that take effect, and the stored rows they replace.

    With ``newer`` (a column that orders versions, e.g. landing time) a row that is older than the
    stored one has no effect.  ``changed`` drives the join, so a small change is broadcast.
    """
    fresh = changed
    if newer is not None:
        known = stored.select(*keys, F.col(q(newer)).alias("_stored"))
        fresh = changed.join(known, keys, "left").where(F.coalesce(F.col(q(newer)) >= F.col("_stored"), F.lit(True))).drop("_stored")
    return stored.join(fresh.select(*keys), keys, "left_semi"), fresh
