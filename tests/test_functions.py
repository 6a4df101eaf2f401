from datetime import datetime

from pyspark.sql import functions as F

from eventmart import functions as fn

T0 = datetime(2024, 1, 6, 10, 0)  # a Saturday


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_surrogate_key_digest_and_null_mark(table):
    df = table("a bigint, t timestamp_ntz", (1, datetime(2024, 1, 1, 0, 0, 7, 170000)), (1, None))
    got = [r.k for r in df.select(fn.surrogate_key("a", "t").alias("k")).collect()]
    assert got[0] == "8e8b941c342c1f8f0149ab89837105b9"
    null_key = df.select(F.md5(F.lit("1-_dbt_utils_surrogate_key_null_")).alias("k")).first()["k"]
    assert got[1] == null_key


def test_surrogate_key_tells_null_from_empty(table):
    df = table("a string", (None,), ("",))
    assert df.select(fn.surrogate_key("a")).distinct().count() == 2


def test_flag_is_exact_and_never_null(table):
    df = table("c string", ("Yes",), ("No",), ("yes",), (None,))
    assert [r[0] for r in df.select(fn.flag("c")).collect()] == [True, False, False, False]


def test_code(table):
    df = table("c string", ("Present",), ("Unoccupied",), ("?",), (None,))
    codes = {"Present": 1, "Unoccupied": 0}
    assert [r[0] for r in df.select(fn.code("c", codes)).collect()] == [1, 0, None, None]
    assert [r[0] for r in df.select(fn.code("c", codes, -1)).collect()] == [1, 0, -1, -1]


def test_bucket_edges(table):
    df = table("m double", (14.99,), (15.0,), (59.99,), (60.0,), (None,))
    edges = [(15, "Short Stay"), (60, "Medium Stay")]
    got = [r[0] for r in df.select(fn.bucket("m", edges, "Long Stay")).collect()]
    assert got == ["Short Stay", "Medium Stay", "Medium Stay", "Long Stay", "Long Stay"]


def test_minutes_between_uses_whole_microseconds(table):
    df = table("a timestamp_ntz, b timestamp_ntz", (T0, datetime(2024, 1, 6, 10, 12, 30)))
    assert one(df, fn.minutes_between("a", "b")) == 12.5
    assert one(df, fn.minutes_between("b", "a")) == -12.5


def test_trunc_keeps_zoneless_type(table):
    df = table("t timestamp_ntz", (datetime(2024, 1, 6, 10, 42),))
    out = df.select(fn.trunc_ts("hour", "t").alias("h"))
    assert out.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert out.first()["h"] == T0


def test_weekend(table):
    df = table("t timestamp_ntz", *[(datetime(2024, 1, d),) for d in (5, 6, 7, 8)])
    got = [r[0] for r in df.select(fn.is_weekend("t")).collect()]
    assert got == [False, True, True, False]


def test_clock_minutes(table):
    df = table("c string", ("7:30",), ("07:30:00",), ("2000-01-01T23:59:00",), ("x",), (None,))
    got = [r[0] for r in df.select(fn.clock_minutes("c")).collect()]
    assert got == [450, 450, 1439, None, None]


def test_exact_sum_is_order_free(table):
    df = table("v double", *[(0.1,)] * 10)
    assert df.agg(fn.exact_sum("v")).first()[0] == 1.0
