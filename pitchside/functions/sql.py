"""The scoring functions for SQL users.

``register`` makes session functions whose bodies are SQL, so the optimizer inlines them
like the expressions of ``functions.match``: no Python runs and filters on them are pushed
and folded like any other.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .match import points_sql, result_sql

#: name -> (parameters, type, body)
FUNCTIONS = {
    "match_points": ("goals_for bigint, goals_against bigint", "bigint", points_sql("goals_for", "goals_against")),
    "match_result": ("goals_for bigint, goals_against bigint", "string", result_sql("goals_for", "goals_against")),
    "is_double_gameweek": ("game_count bigint", "boolean", "game_count > 1"),
    "bool_label": ("flag boolean", "string", "initcap(cast(flag as string))"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session (replacing earlier ones); returns their names."""
    for name, (parameters, returns, body) in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {returns} return {body}")
    return list(FUNCTIONS)
