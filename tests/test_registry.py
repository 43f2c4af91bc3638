"""The driver contract and plan shapes."""

import contextlib
import importlib.util
import io
import os

import pytest

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


#: Queries whose columns are found in the data: an aggregate has to run first.
DISCOVERING = {"json_discover", "result_crosstab"}


def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_every_query_has_an_oracle():
    e = entry_module()
    assert set(e._queries()) == set(e._oracle_sql())
    assert len(e._queries()) >= 39
    assert set(e._queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_entry_smoke(spark):
    df = entry_module().entry(spark)
    assert len(df.columns) == 32 and df.count() == 25


@pytest.mark.parametrize("name", sorted(entry_module()._queries()))
def test_no_python_in_plans(spark, name):
    p = plan(entry_module().queries()[name](spark, SF_SMALL), "simple")
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_league_table_plan_shape(spark):
    p = plan(entry_module().queries()["league_table"](spark, SF_SMALL), "simple")
    # the fixtures (orders) are scanned once; one keyed shuffle before the rank
    assert p.count("orders.parquet") == 1
    assert p.count("Exchange hashpartitioning(team_id") == 1
    assert "partial_count" in p and "Generate inline" in p


def test_pushdown_and_pruning(spark):
    p = plan(entry_module().queries()["upsert_player_gw"](spark, SF_SMALL), "formatted")
    assert "LessThan(l_shipdate" in p
    assert "l_returnflag" not in p and "l_tax" not in p


def test_dgw_count_is_not_a_row_window(spark):
    p = plan(entry_module().queries()["player_gw_stats"](spark, SF_SMALL), "simple")
    assert "Window" not in p and "partial_count" in p


def test_sides_that_grow_with_data_are_not_broadcast(spark):
    q = entry_module()._queries()
    pgw = plan(q["player_gw_stats"](spark, SF_SMALL), "simple")
    assert "ShuffledHashJoin [player_id" in pgw and "_salt" in pgw
    assert pgw.count("BroadcastHashJoin") == 1 and "_hot#" in pgw    # the hot keys, to the rows
    ups = plan(q["upsert_player_gw"](spark, SF_SMALL), "simple")
    assert any("SortMergeJoin" in line and "FullOuter" in line for line in ups.splitlines())


def test_upsert_is_one_pass(spark):
    p = plan(entry_module()._queries()["upsert_gameweek"](spark, SF_SMALL), "simple")
    assert p.count("FileScan parquet") == 2 and p.count("Exchange hashpartitioning(id") == 2
    assert p.count("Exchange") == 2 and p.count("Window [") == 1


def test_no_job_while_a_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, fn in entry_module()._queries().items():
        if name in DISCOVERING:
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        fn(spark, SF_SMALL)
        assert not tracker.getJobIdsForGroup(f"build-{name}"), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_dimensions_are_broadcast(spark):
    q = entry_module()._queries()
    p = plan(q["player_info"](spark, SF_SMALL), "simple")
    assert "BroadcastHashJoin" in p and "region.parquet" in p


def test_schemas_do_not_depend_on_the_data(spark):
    q = entry_module()._queries()
    for name, fn in q.items():
        a = fn(spark, SF_SMALL).schema
        b = fn(spark, "/root/testdata/sf0.01").schema
        assert a == b, name
