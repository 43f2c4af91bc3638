"""JSON landing: declared schemas, empty pages, missing fields, flattening."""

import os

from pyspark.sql import types as T

from conftest import fixture, write_pages
from pitchside.sources import snapshot as SN


def test_missing_field_is_null(spark, scratch):
    page = [fixture(1, 1, 2, 1, 0)]
    del page[0]["team_a_difficulty"]
    d = write_pages(os.path.join(scratch, "f"), {"a.json": page, "b.json": [fixture(2, 2, 1, 0, 0)]})
    df = SN.scan_fixtures(SN.read_fixture_pages(spark, d))
    got = sorted((r.event, r.team_a_difficulty) for r in df.collect())
    assert got == [(1, None), (2, 3)]


def test_all_null_scores_keep_integer_type(spark, scratch):
    d = write_pages(os.path.join(scratch, "f"), {"a.json": [fixture(1, 1, 2, None, None)]})
    df = SN.scan_fixtures(SN.read_fixture_pages(spark, d))
    assert dict(df.dtypes)["team_h_score"] == "bigint"


def test_fixture_without_gameweek_and_range(spark, scratch):
    d = write_pages(os.path.join(scratch, "f"), {"a.json": [
        fixture(None, 1, 2, 1, 0), fixture(0, 1, 2, 1, 0), fixture(39, 1, 2, 1, 0)]})
    raw = SN.read_fixture_pages(spark, d)
    assert sorted(r.event for r in SN.scan_fixtures(raw).collect()) == [0, 39]
    assert [r.event for r in SN.scan_fixtures(raw, gameweeks=(0, 38)).collect()] == [0]


def test_nested_stats_kept(spark, scratch):
    stats = [{"identifier": "goals_scored", "a": [], "h": [{"value": 1, "element": 7}]}]
    d = write_pages(os.path.join(scratch, "f"), {"a.json": [fixture(1, 1, 2, 1, 0, stats=stats)]})
    r = SN.scan_fixtures(SN.read_fixture_pages(spark, d)).first()
    assert r.stats[0].identifier == "goals_scored" and r.stats[0].h[0].element == 7


def test_json_flatten(spark):
    schema = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("a", T.StructType([
            T.StructField("b", T.LongType()),
            T.StructField("c", T.StructType([T.StructField("d", T.StringType())])),
            T.StructField("arr", T.ArrayType(T.LongType()))]))])
    df = spark.createDataFrame([(1, (2, ("x",), [1, 2]))], schema)
    out = SN.json_flatten(df)
    assert out.columns == ["id", "a.b", "a.c.d", "a.arr"]
    r = out.first()
    assert (r[0], r[1], r[2], list(r[3])) == (1, 2, "x", [1, 2])


def test_parse_json_column(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("junk",), (None,)], "props string")
    out = SN.json_flatten(SN.parse_json_column(
        df, "props", T.StructType([T.StructField("k", T.LongType())])), sep="_")
    assert [r.props_k for r in out.collect()] == [5, None, None]


def test_union_pages_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x bigint, y bigint")
    b = spark.createDataFrame([(3,)], "x bigint")
    got = sorted(tuple(r) for r in a.unionByName(b, allowMissingColumns=True).collect())
    assert got == [(1, 2), (3, None)]
