"""The driver's Parquet tables seen through the API's shapes.

The test tables are TPC-H-like; these derived views give them the fields of the
landed documents (teams, fixtures, players, positions, history, gameweeks) with
nulls, ties, unmatched keys and duplicates on purpose.  Every view reads whole
tables; the work grows with them.  The DuckDB side of the oracle uses the same
definitions (``plans.oracle``).
"""

from __future__ import annotations

import os
import weakref

from pyspark.sql import DataFrame, SparkSession

NO_SCORE = "P"  # an order in status P stands for a fixture not played yet


# One base DataFrame per (session, file): like a catalog table, the file
# listing and footer schema are resolved once per session, not per query.
_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = \
    weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.abspath(f"{sf_dir}/{name}.parquet")
    per_session = _TABLES.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


# Each view is one projection written as Spark SQL expression text (one call to
# the JVM per view instead of several per column).

def fx_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "cast(n_nationkey as bigint)"
    ratings = [f"cast(1000 + ({k} * {m}) % 350 as bigint) as {name}" for name, m in (
        ("strength_overall_home", 37), ("strength_overall_away", 41),
        ("strength_attack_home", 43), ("strength_attack_away", 47),
        ("strength_defence_home", 53), ("strength_defence_away", 59))]
    return table(spark, sf_dir, "nation").selectExpr(
        f"{k} as id", "n_name as name", f"cast(1 + {k} % 5 as bigint) as strength", *ratings)


def fx_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    unplayed = f"o_orderstatus = '{NO_SCORE}'"
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "o_orderkey as id",
        "o_orderkey % 39 as event",
        f"o_orderstatus != '{NO_SCORE}' as finished",
        "o_orderdate as kickoff_time",
        f"cast(case when {unplayed} then 0 else 90 end as bigint) as minutes",
        "cast(c_nationkey as bigint) as team_h",
        "cast((c_nationkey + 1 + o_orderkey % 24) % 25 as bigint) as team_a",
        f"case when not {unplayed} then o_custkey % 5 end as team_h_score",
        f"case when not {unplayed} then cast(floor(o_totalprice) as bigint) % 4 end as team_a_score",
        "1 + o_custkey % 5 as team_h_difficulty",
        "1 + o_orderkey % 5 as team_a_difficulty",
    )


def fx_element_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr(
        "cast(r_regionkey as bigint) as id", "r_name as plural_name_short")


def fx_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id", "c_mktsegment as first_name", "c_name as second_name",
        "case when c_custkey % 97 = 0 then 9L else c_custkey % 5 end as element_type",
        "cast(c_nationkey as bigint) as team",
        "40 + c_custkey % 90 as now_cost",
        "c_custkey % 200 as total_points",
        "cast(cast(c_acctbal as decimal(12,2)) as string) as influence",
        "cast(cast(c_custkey % 1000 as decimal(12,1)) as string) as selected_by_percent",
        "c_custkey % 50 = 0 as in_dreamteam",
        "case when c_custkey % 4 != 0 then 25 * (c_custkey % 4) end"
        " as chance_of_playing_next_round",
    )


def fx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey as element",
        "l_orderkey as fixture",
        "l_orderkey % 38 + 1 as round",
        "l_suppkey as opponent_team",
        "l_shipdate as kickoff_time",
        "cast(l_quantity as bigint) % 4 as goals_scored",
        "cast(l_linenumber as bigint) % 3 as assists",
        "cast(l_quantity as bigint) + 40 as minutes",
        "cast(floor(l_extendedprice) as bigint) % 15 as total_points",
        "cast(cast(l_discount as decimal(12,2)) as string) as expected_goals",
        "cast(l_linenumber as bigint) as line",
    )


def fx_gw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as id",
        "ts as deadline_time",
        "cast(floor(value) as bigint) as average_entry_score",
        "case when event_type != 'error' then cast(get_json_object(props, '$.k') as bigint) end"
        " as highest_score",
        "case when event_type != 'signup' then user_id end as most_selected",
    )
