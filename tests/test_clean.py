from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators import cdc, clean, dedup, reshape, schema

D1, D2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_bad_keys_become_null_and_go(table, same):
    raw = table("kerbsideid string", ("x",), ("",), (None,), (" 7 ",), ("12.5",))
    typed = clean.project(raw, {"bay_id": ("kerbsideid", "int")})
    same(clean.require(typed, ["bay_id"]), (7,))


def test_project_takes_names_types_and_expressions(table, same):
    raw = table("a string, b int", ("1", 2))
    out = clean.project(raw, {"x": "b", "y": ("a", "int"), "z": F.col("b") + 1})
    assert out.columns == ["x", "y", "z"]
    same(out, (2, 1, 3))


def test_stamp_fixed_and_running(table):
    df = table("a int", (1,), (2,))
    assert clean.stamp(df, ts=D1).select("ingested_at").distinct().first()[0] == D1
    assert clean.stamp(df, "at").select("at").distinct().count() == 1


def test_distinct_rows(table, same):
    df = table("a int, b int", (1, 1), (1, 1), (1, 2))
    same(dedup.distinct_rows(df), (1, 1), (1, 2))
    assert dedup.distinct_rows(df, ["a"]).count() == 1


def test_latest_by_puts_null_times_last(table, same):
    df = table("k int, t timestamp_ntz, v string", (7, D1, "a"), (7, D2, "b"), (7, None, "c"))
    same(dedup.latest_by(df, ["k"], ["t"]), (7, D2, "b"))


def test_latest_by_tie_break_and_null_group(table, same):
    df = table("k int, t int, v int", (1, 1, 5), (1, 1, 9), (None, 1, 1), (None, 2, 2))
    same(dedup.latest_by(df, ["k"], ["t"], ["v"]), (1, 1, 9), (None, 2, 2))


def test_latest_by_sends_one_row_per_key_and_task(spark, table):
    df = table("k int, t int", (1, 1), (1, 2))
    plan = dedup.latest_by(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


SLOTS = {"description": ("description", "string"), "duration": ("duration", "int")}


def test_unpivot_keeps_slots_with_the_field_set(table, same):
    wide = table(
        "id int, description1 string, duration1 string, description2 string, duration2 string,"
        " description3 string, duration3 string",
        (1, "1P", "60", "2P", "x", None, "30"),
    )
    out = reshape.unpivot_slots(wide, ["id"], SLOTS, 3, "rule_number", "description")
    assert out.columns == ["id", "rule_number", "description", "duration"]
    same(out, (1, 1, "1P", 60), (1, 2, "2P", None))


def test_unpivot_absent_column_is_null(table, same):
    wide = table("id int, description1 string, description2 string", (1, "a", "b"))
    out = reshape.unpivot_slots(wide, ["id"], SLOTS, 2, "n", "description")
    same(out, (1, 1, "a", None), (1, 2, "b", None))


def test_unpivot_without_filter_keeps_all_slots(table):
    wide = table("id int, description1 string", (1, "a"))
    assert reshape.unpivot_slots(wide, ["id"], SLOTS, 6).count() == 6


def test_expand_json(table, same):
    df = table(
        "id int, location string",
        (1, '{"lat": -37.8, "lon": 144.9}'),
        (2, "{broken"),
        (3, None),
        (4, '{"lat": "-37.8", "lon": "144.9"}'),
    )
    out = reshape.expand_json(df, "location", "lat DOUBLE, lon DOUBLE")
    assert out.columns == ["id", "lat", "lon"]
    same(out, (1, -37.8, 144.9), (2, None, None), (3, None, None), (4, None, None))
    assert "location" in reshape.expand_json(df, "location", "lat DOUBLE", keep=True).columns


def test_stringify_nested(table, same):
    df = table(
        "a int, s struct<x:int,y:string>, l array<int>, m map<string,int>",
        (1, (2, "z"), [1, 2], {"k": 1}),
    )
    same(reshape.stringify_nested(df), (1, '{"x":2,"y":"z"}', "[1,2]", '{"k":1}'))


IMAGE = T.StructType([T.StructField("id", T.StringType()), T.StructField("t", T.StringType())])


def envelopes(spark):
    rows = [
        (None, ("1", "2024-01-01 00:00:00"), "c", 1),
        (("1", "x"), ("1", "bad"), "u", 2),
        (None, ("2", None), "r", 3),
        (("2", None), None, "d", 4),
    ]
    return spark.createDataFrame(rows, cdc.envelope_schema(IMAGE))


def test_cdc_flatten_drops_null_images(spark, same):
    mapping = {"bay_id": ("id", "int"), "at": ("t", "timestamp_ntz"), "raw": "t"}
    out = cdc.flatten(envelopes(spark), mapping)
    same(out, (1, D1, "2024-01-01 00:00:00"), (1, None, "bad"), (2, None, None))
    assert cdc.flatten(envelopes(spark), mapping, keep_null_images=True).count() == 4
    assert cdc.flatten(envelopes(spark), mapping, keep_ops=["c", "r"]).count() == 2
    assert cdc.flatten(envelopes(spark), {"id": "id"}, image="before").count() == 2


def test_cdc_decode_reads_bus_messages(spark, same):
    messages = spark.createDataFrame([('{"after": {"id": "5"}, "op": "c"}',)], "value string")
    out = cdc.flatten(cdc.decode(messages, IMAGE), {"id": ("id", "int")})
    same(out, (5,))


def test_align(table, same):
    df = table("b string, c int", ("1", 2))
    target = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    out = schema.align(df, target)
    assert out.columns == ["a", "b", "c"]
    same(out, (None, 1, 2))
    assert schema.align(df, target, "drop").columns == ["a", "b"]
    with pytest.raises(ValueError):
        schema.align(df, target, "error")
    assert schema.merged(target, df.schema).fieldNames() == ["a", "b", "c"]
