"""Registry of named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole driver tables (through the ``fx_*`` views of
``sources.testdata``) and runs the library's operators on them.  The merge
queries split a table into two overlapping loads — an earlier one (the target,
as a previous run left it) and a later one (the source) — and merge them; the
two loads together cover every row (one without a date is in the later load).  The
source carries changed values and nulls that must overwrite, and each merge has
updated, inserted and kept keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SC
from ..functions import sql as SF
from ..operators import asof as AO
from ..operators import columns as CO
from ..operators import difference as DF
from ..operators import gameweeks as GW
from ..operators import maintained as MT
from ..operators import merge as MG
from ..operators import players as PL
from ..operators import standings as ST
from ..operators.joins import join_full_outer
from ..sources import discover as DC
from ..sources import snapshot as SN
from ..sources import testdata as TD
from . import oracle as OR

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------- inputs ---

def _fixtures(spark, d) -> DataFrame:
    return SN.scan_fixtures(TD.fx_fixtures(spark, d))


def _teams(spark, d) -> DataFrame:
    return SN.scan_teams(TD.fx_teams(spark, d))


def _elements(spark, d) -> DataFrame:
    return SN.scan_elements(TD.fx_elements(spark, d))


def _positions(spark, d) -> DataFrame:
    return SN.scan_positions(TD.fx_element_types(spark, d))


def _gameweeks(spark, d) -> DataFrame:
    return SN.scan_gameweeks(TD.fx_gw(spark, d))


def _history(spark, d) -> DataFrame:
    # ``line`` is kept next to the scan shape: with kickoff time and fixture it
    # orders the rows of one key for the "latest wins" merge.
    return SN.scan_history(TD.fx_history(spark, d), keep=["line"])


def _scored(spark, d) -> DataFrame:
    return ST.score_fixtures(ST.fixture_frame(_fixtures(spark, d)))


def _before(col: str, when: str):
    return F.col(col) < F.lit(when).cast("timestamp_ntz")


def _since(col: str, when: str):
    """The other rows, those without a date among them."""
    return (F.col(col) >= F.lit(when).cast("timestamp_ntz")) | F.col(col).isNull()


# -------------------------------------------------------------- standings ---

def league_table(spark, d):
    return ST.league_table(_fixtures(spark, d), _teams(spark, d))


def fixture_info(spark, d):
    return ST.fixture_info(_fixtures(spark, d))


def result_counts(spark, d):
    return ST.result_counts(_scored(spark, d))


def goals(spark, d):
    return ST.goals(_scored(spark, d))


def team_points(spark, d):
    return ST.team_points(_scored(spark, d))


MATCH_KEYS = ["gameweek_id", "home_team_id", "away_team_id", "home_team_score", "away_team_score"]


def match_points(spark, d):
    return _scored(spark, d).select(*MATCH_KEYS, "home_points", "away_points")


def match_points_sql(spark, d):
    """``match_points`` as a SQL user writes it."""
    SF.register(spark)
    return spark.sql(f"select {', '.join(MATCH_KEYS)}, match_points(home_team_score, away_team_score) as home_points, "
                     "match_points(away_team_score, home_team_score) as away_points from {fixtures}",
                     fixtures=ST.fixture_frame(_fixtures(spark, d)))


def result_crosstab(spark, d):
    return GW.crosstab(ST.team_sides(_scored(spark, d)), "team_id", "result")


def match_result(spark, d):
    return _scored(spark, d).select(*MATCH_KEYS, "home_result", "away_result")


def filter_result(spark, d):
    return _scored(spark, d).filter(F.col("home_result") == "W") \
        .select(*MATCH_KEYS, "home_result")


def result_pivot(spark, d):
    return ST.result_pivot(_scored(spark, d))


def join_full_outer_q(spark, d):
    """Six count tables folded by full outer joins (missing → 0).

    All counts come from one aggregate, whose exchange the six tables share."""
    counts = ST.team_aggregate(ST.team_sides(_scored(spark, d)))
    parts = [counts.filter(F.col(c) > 0).select("team_id", c) for c in ST.RESULT_COLUMNS]
    return join_full_outer(parts, "team_id", 0)


def team_strength(spark, d):
    return ST.team_strength(_teams(spark, d))


def join_team_dim(spark, d):
    return ST.join_team_dim(ST.team_points(_scored(spark, d)), _teams(spark, d))


def rank_max(spark, d):
    players = PL.players_renamed(_elements(spark, d)).select("player_id", "team_id", "total_points")
    return ST.rank_max(players, "total_points", "team_rank", ["team_id"])


def refresh_fixtures(spark, d):
    # The new content replaces the table whole, whose rows are older ones with other
    # values; extra columns (id, stats…) are dropped.
    scored = ST.score_fixtures(_fixtures(spark, d).withColumnsRenamed(ST.FIXTURE_RENAMES))
    target = MG.conform_to(SC.FIXTURE_INFO, scored.filter(_before("kickoff_time", OR.FIXTURE_CUTOFF))
                           .withColumn("minutes", F.col("minutes") + 1))
    return MG.refresh(target, scored)


def refresh_gameweeks(spark, d):
    """The gameweeks that a refresh has to rewrite: some were changed, one is new, one is gone."""
    info = fixture_info(spark, d)
    older = info.where(F.col("gameweek_id") != 7).withColumn("minutes", F.when(
        (F.col("gameweek_id") % 5 == 0) & (F.col("home_team_id") == 3), F.col("minutes") + 1).otherwise(F.col("minutes")))
    return DF.changed_groups(older, info.where(F.col("gameweek_id") != 11), "gameweek_id")


def league_incremental(spark, d):
    """The league kept current: an earlier load's sums, then a later load of which many fixtures
    replace earlier ones that had other scores."""
    fixtures = _fixtures(spark, d)
    stored = fixtures.filter(_before("kickoff_time", OR.FIXTURE_CUTOFF)).withColumn("team_h_score", F.when(
        _since("kickoff_time", OR.FIXTURE_SOURCE_FROM), F.col("team_h_score") + 1).otherwise(F.col("team_h_score")))
    changed = fixtures.filter(_since("kickoff_time", OR.FIXTURE_SOURCE_FROM))
    old, new = MT.replaced_rows(stored, changed, ["id"])
    sums = MT.apply_changes(MT.team_sums(ST.fixture_frame(stored)), ST.fixture_frame(old), ST.fixture_frame(new))
    return ST.league_from_sums(sums, _teams(spark, d))


def staging_conform(spark, d):
    frame = CO.rename(_history(spark, d), GW.HISTORY_RENAMES)
    return MG.conform_to(SC.PLAYER_GW_STATS, frame)


# ------------------------------------------------------------------ scans ---

def scan_teams(spark, d):
    return _teams(spark, d)


def scan_fixtures(spark, d):
    return _fixtures(spark, d).drop("stats")


def scan_elements(spark, d):
    return _elements(spark, d)


def scan_positions(spark, d):
    return _positions(spark, d)


def scan_gameweeks(spark, d):
    return _gameweeks(spark, d)


def scan_history(spark, d):
    return SN.scan_history(TD.fx_history(spark, d))


def json_flatten(spark, d):
    events = TD.table(spark, d, "events")
    parsed = SN.parse_json_column(events, "props", T.StructType([T.StructField("k", T.LongType())]))
    return SN.json_flatten(parsed, sep="_")


def json_discover(spark, d):
    return DC.json_discover(TD.table(spark, d, "events"), "props", sep="_")


def union_pages(spark, d):
    """History pages landed before the API had ``expected_goals`` union the newer
    pages that have it: aligned by name, the missing field is null."""
    raw = TD.fx_history(spark, d)
    old = _before("kickoff_time", OR.FIXTURE_CUTOFF)
    older = raw.filter(old).drop("expected_goals")
    newer = raw.filter(_since("kickoff_time", OR.FIXTURE_CUTOFF))
    return older.unionByName(newer, allowMissingColumns=True)


# ------------------------------------------------------------ projections ---

def project_rename(spark, d):
    return PL.players_renamed(_elements(spark, d))


def project_select(spark, d):
    return ST.fixture_frame(_fixtures(spark, d).drop("stats"))


def player_cast(spark, d):
    return PL.player_cast(_elements(spark, d), _positions(spark, d))


def cast_rejects(spark, d):
    """Casts of player columns of which some hold text that is no number."""
    elements = TD.fx_elements(spark, d).withColumns({
        "influence": F.when(F.col("id") % 7 == 0, "n/a").otherwise(F.col("influence")),
        "selected_by_percent": F.when(F.col("id") % 11 == 0, "").otherwise(F.col("selected_by_percent"))})
    double = T.DoubleType()
    return CO.cast_rejects(elements, {"influence": double, "selected_by_percent": double, "second_name": double, "now_cost": double,
                                      "chance_of_playing_next_round": T.LongType()})


def _player_snapshots(spark, d):
    """Players on four dates: points grow, some players are missing on some dates."""
    dated = _elements(spark, d).select(F.col("id").alias("element"), F.col("total_points"), "team",
                                       F.explode(F.expr(f"transform(array({', '.join(repr(x) for x in OR.SNAPSHOT_DATES)}), x -> cast(x as timestamp_ntz))"))
                                       .alias("snapshot_date"))
    return dated.where((F.col("element") + F.month("snapshot_date")) % 5 != 0).withColumn(
        "total_points", F.col("total_points") + F.when(F.col("element") % 3 == 0, 0).otherwise(F.year("snapshot_date") - 1992))


def player_as_of(spark, d):
    """Every game with its player's totals as of kick-off."""
    games = _history(spark, d).select("element", "fixture", "line", "kickoff_time")
    return AO.as_of(games, _player_snapshots(spark, d), ["element"], "kickoff_time")


def player_intervals(spark, d):
    return AO.valid_intervals(_player_snapshots(spark, d), ["element"])


def fill_nulls(spark, d):
    return CO.fill_nulls(_elements(spark, d), 0)


def bool_label(spark, d):
    return CO.label_booleans(PL.players_renamed(_elements(spark, d)), ["in_dreamteam"]) \
        .select("player_id", "in_dreamteam")


def join_player_position(spark, d):
    return PL.join_player_position(_elements(spark, d), _positions(spark, d)).select(
        "player_id", "first_name", "second_name", "position_id", "position", "team_id")


def player_info(spark, d):
    return PL.player_info(_elements(spark, d), _positions(spark, d))


# -------------------------------------------------------------- gameweeks ---

def player_gw_stats(spark, d):
    return GW.player_gw_stats(scan_history(spark, d))


def dgw_flag(spark, d):
    return player_gw_stats(spark, d).select(*SC.PLAYER_GW_STATS_KEY, "game_count", "dgw")


def value_counts(spark, d):
    return GW.value_counts(GW.history_frame(scan_history(spark, d)))


def gameweek_counts(spark, d):
    return GW.gameweek_counts(GW.history_frame(scan_history(spark, d)))


def gw_stats(spark, d):
    return GW.gw_stats(_gameweeks(spark, d))


# ------------------------------------------------------------------ merge ---

def upsert_team(spark, d):
    fixtures, teams = _fixtures(spark, d), _teams(spark, d)
    old = _before("kickoff_time", OR.FIXTURE_CUTOFF)
    # the three best are new to the table; the last places are missing from the new load
    target = ST.league_table(fixtures.filter(old), teams).filter(F.col("league_position") > 3)
    source = ST.league_table(fixtures.filter(_since("kickoff_time", OR.FIXTURE_CUTOFF)), teams).filter(F.col("league_position") <= 20) \
        .withColumn("strength_attack_home", F.when(F.col("league_position") > 5, F.col("strength_attack_home")))
    return MG.upsert(target, source, SC.TEAM_INFO_KEY)


def upsert_player(spark, d):
    elements, positions = _elements(spark, d), _positions(spark, d)
    target = PL.player_info(elements.filter(F.col("team") < OR.PLAYER_TARGET_TEAMS_BELOW), positions)
    source = PL.player_info(elements.filter((F.col("team") >= OR.PLAYER_SOURCE_TEAMS_FROM) | F.col("team").isNull()), positions).withColumns({
        "total_points": F.col("total_points") + 7,
        "influence": F.when(F.col("total_points") >= 20, F.col("influence"))})
    return MG.upsert(target, source, SC.PLAYER_INFO_KEY)


def upsert_gameweek(spark, d):
    gws = _gameweeks(spark, d)
    target = GW.gw_stats(gws.filter(_before("deadline_time", OR.EVENT_TARGET_BEFORE)))
    source = GW.gw_stats(gws.filter(_since("deadline_time", OR.EVENT_SOURCE_FROM))).withColumns({
        "highest_score": F.col("highest_score") + 1,
        "most_selected": F.when(F.col("average_entry_score") >= 50, F.col("most_selected"))})
    return MG.upsert(target, source, SC.GW_STATS_KEY)


LATEST_ORDER = ["kickoff_time", "fixture", "line"]


def upsert_player_gw(spark, d):
    hist = _history(spark, d)
    target = MG.latest_per_key(
        GW.player_gw_stats(hist.filter(_before("kickoff_time", OR.FIXTURE_CUTOFF)), keep=LATEST_ORDER),
        SC.PLAYER_GW_STATS_KEY, LATEST_ORDER).select(*SC.names(SC.PLAYER_GW_STATS))
    source = GW.player_gw_stats(hist.filter(_since("kickoff_time", OR.FIXTURE_SOURCE_FROM)), keep=LATEST_ORDER) \
        .withColumns({"points": F.col("points") + 1, "expected_goals": F.when(F.col("points") < 10, F.col("expected_goals"))})
    return MG.upsert(target, source, SC.PLAYER_GW_STATS_KEY, on_duplicate="latest", order_by=LATEST_ORDER)


QUERIES: dict[str, Query] = {
    # standings
    "league_table": league_table,
    "fixture_info": fixture_info,
    "result_counts": result_counts,
    "goals": goals,
    "team_points": team_points,
    "match_points": match_points,
    "match_points_sql": match_points_sql,
    "match_result": match_result,
    "filter_result": filter_result,
    "result_pivot": result_pivot,
    "result_crosstab": result_crosstab,
    "join_full_outer": join_full_outer_q,
    "team_strength": team_strength,
    "join_team_dim": join_team_dim,
    "rank_max": rank_max,
    "refresh_fixtures": refresh_fixtures,
    "refresh_gameweeks": refresh_gameweeks,
    "league_incremental": league_incremental,
    "staging_conform": staging_conform,
    # scans
    "scan_teams": scan_teams,
    "scan_fixtures": scan_fixtures,
    "scan_elements": scan_elements,
    "scan_positions": scan_positions,
    "scan_gameweeks": scan_gameweeks,
    "scan_history": scan_history,
    "json_flatten": json_flatten,
    "json_discover": json_discover,
    "union_pages": union_pages,
    # projections and players
    "project_rename": project_rename,
    "project_select": project_select,
    "player_cast": player_cast,
    "cast_rejects": cast_rejects,
    "player_as_of": player_as_of,
    "player_intervals": player_intervals,
    "fill_nulls": fill_nulls,
    "bool_label": bool_label,
    "join_player_position": join_player_position,
    "player_info": player_info,
    # gameweeks
    "player_gw_stats": player_gw_stats,
    "dgw_flag": dgw_flag,
    "value_counts": value_counts,
    "gameweek_counts": gameweek_counts,
    "gw_stats": gw_stats,
    # merge
    "upsert_team": upsert_team,
    "upsert_player": upsert_player,
    "upsert_gameweek": upsert_gameweek,
    "upsert_player_gw": upsert_player_gw,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
