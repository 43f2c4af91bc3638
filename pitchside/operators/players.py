"""Player season totals (``player_info``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas as SC
from .columns import cast_columns, fill_nulls, rename, select_columns
from .joins import dimension_join

PLAYER_RENAMES = {"id": "player_id", "element_type": "position_id", "team": "team_id",
                  "now_cost": "current_price"}
POSITION_RENAMES = {"id": "position_id", "plural_name_short": "position"}
PLAYER_COLUMNS = SC.names(SC.PLAYER_INFO)


def players_renamed(elements: DataFrame) -> DataFrame:
    return rename(elements, PLAYER_RENAMES)


def positions_renamed(element_types: DataFrame) -> DataFrame:
    return rename(element_types, POSITION_RENAMES)


def join_player_position(elements: DataFrame, element_types: DataFrame) -> DataFrame:
    """Players with their position name.  Inner: a player whose position is
    unknown (or null) is not listed.  Spark broadcasts the position table if
    its bytes are few."""
    return dimension_join(players_renamed(elements), positions_renamed(element_types),
                          "position_id", "inner")


def player_columns(elements: DataFrame, element_types: DataFrame) -> DataFrame:
    return select_columns(join_player_position(elements, element_types), PLAYER_COLUMNS)


def player_cast(elements: DataFrame, element_types: DataFrame, strict: bool = False) -> DataFrame:
    """Declared output types; text numbers parsed, the dream-team flag as 'True'/'False'."""
    df = player_columns(elements, element_types)
    return cast_columns(df, {f.name: f.dataType for f in SC.PLAYER_INFO.fields}, strict)


def player_info(elements: DataFrame, element_types: DataFrame, strict: bool = False) -> DataFrame:
    """The ``player_info`` table: join → prune → cast → numeric nulls to 0.

    (A chance of playing that is unknown is stored as 0; a missing name stays
    null rather than becoming the text '0'.)
    """
    return fill_nulls(player_cast(elements, element_types, strict), 0)
