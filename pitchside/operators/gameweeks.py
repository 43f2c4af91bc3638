"""Per-gameweek tables: player gameweek stats with the double-gameweek flag,
frequency counts, and the gameweek summary (``gw_stats``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as SC
from ..functions.match import dgw_flag
from .columns import cast_columns, fill_nulls, rename, select_columns
from .joins import HOT_KEY_ROWS, SALT_BUCKETS, attach_per_key

HISTORY_RENAMES = {"round": "gameweek_id", "element": "player_id", "total_points": "points",
                   "opponent_team": "opponent_id"}
HISTORY_COLUMNS = SC.names(SC.PLAYER_GW_STATS)[:-2]        # the 28 measured columns
GAME_KEY = ["player_id", "gameweek_id"]
GW_COLUMNS = SC.names(SC.GW_STATS)


def history_frame(history: DataFrame, keep: list[str] = (), strict: bool = False) -> DataFrame:
    """Scanned history → renamed, pruned, typed rows (``keep`` extra columns)."""
    df = rename(history, HISTORY_RENAMES)
    df = select_columns(df, HISTORY_COLUMNS + [c for c in keep if c not in HISTORY_COLUMNS])
    types = {f.name: f.dataType for f in SC.PLAYER_GW_STATS.fields if f.name in HISTORY_COLUMNS}
    return cast_columns(df, types, strict)


def value_counts(frame: DataFrame, keys: list[str] = GAME_KEY, name: str = "game_count") -> DataFrame:
    """Rows per key; rows with a null key are not counted (no null group)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return frame.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_game_count(frame: DataFrame, hot_key_rows: int = HOT_KEY_ROWS,
                    buckets: int = SALT_BUCKETS) -> DataFrame:
    """Attach games per (player, gameweek) to every row, and the DGW flag.

    Counted by a keyed aggregation (partial on the map side) and joined back,
    not by a window: a window would pull every row of a hot (player, gameweek)
    into one task.  The counts grow with the data, so they are never broadcast:
    a shuffled hash join builds on the counts and streams the rows without
    sorting them; hot keys are split over salted tasks (``attach_per_key``).
    """
    counts = value_counts(frame)
    out = attach_per_key(frame, counts, GAME_KEY, "game_count", hint="shuffle_hash",
                         hot_key_rows=hot_key_rows, buckets=buckets)
    return out.withColumn("dgw", F.coalesce(dgw_flag("game_count"), F.lit(False)))


def player_gw_stats(history: DataFrame, keep: list[str] = (), strict: bool = False) -> DataFrame:
    """The ``player_gw_stats`` table (30 columns)."""
    df = with_game_count(history_frame(history, keep, strict))
    return df.select(*SC.names(SC.PLAYER_GW_STATS), *[c for c in keep if c not in HISTORY_COLUMNS])


def gameweek_counts(frame: DataFrame, key: str = "gameweek_id") -> DataFrame:
    """Non-null count of every other column per gameweek (null gameweek dropped)."""
    others = [c for c in frame.columns if c != key]
    return frame.filter(F.col(key).isNotNull()).groupBy(key) \
        .agg(*[F.count(F.col(c)).alias(c) for c in others])


def crosstab(frame: DataFrame, key: str, column: str, max_values: int = 200) -> DataFrame:
    """Rows per ``key`` and value of ``column``, one result column ``<column>_<value>`` per value
    found (in order of the values); missing cells are 0, null keys and values are dropped.

    The counts (a partial aggregate) are folded into one map per key.  Only the distinct values reach
    the driver: more than ``max_values`` is an error, before any map is built.
    """
    counts = frame.filter(F.col(key).isNotNull() & F.col(column).isNotNull()).groupBy(key, column).agg(F.count(F.lit(1)).alias("_n"))
    values = [r[0] for r in counts.select(column).distinct().orderBy(column).limit(max_values + 1).collect()]
    if len(values) > max_values:
        raise ValueError(f"{column} has over {max_values} values: too many for columns")
    cells = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(column, "_n"))).alias("_cells"))
    return cells.select(key, *[F.coalesce(F.try_element_at("_cells", F.lit(v)), F.lit(0).cast("long")).alias(f"{column}_{v}")
                               for v in values])


def gw_stats(events: DataFrame, strict: bool = False) -> DataFrame:
    """The ``gw_stats`` table: gameweek summaries, numeric nulls → 0."""
    df = select_columns(events, GW_COLUMNS)
    df = cast_columns(df, {f.name: f.dataType for f in SC.GW_STATS.fields}, strict)
    return fill_nulls(df, 0).select(*GW_COLUMNS)
