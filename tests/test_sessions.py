from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.operators.dedup import distinct_rows
from eventmart.operators.sessions import state_sessions, with_next
from eventmart.operators.skew import in_slices, large_keys

T0 = datetime(2024, 1, 6, 10, 0)
DDL = "bay int, status string, at timestamp_ntz, id int"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def readings(table, *rows):
    return table(DDL, *[(b, s, at(m), i) for i, (b, s, m) in enumerate(rows)])


def spans(df):
    out = state_sessions(df, "bay", "status", "at", "P", "U", ["id"])
    return sorted(
        (r.bay, (r.arrival_time - T0).total_seconds() / 60, r.duration_minutes)
        for r in out.collect()
    )


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(1, "P", 0), (1, "U", 12.5)], [(1, 0, 12.5)]),
        ([(1, "P", 0), (1, "P", 5), (1, "U", 20)], [(1, 5, 15.0)]),
        ([(1, "P", 0), (1, "U", 10), (1, "U", 20)], [(1, 0, 10.0)]),
        ([(1, "U", 0), (1, "P", 5)], []),
        ([(1, "P", 0), (1, "X", 3), (1, "U", 9)], []),
        ([(1, "P", 0), (1, "U", 0)], [(1, 0, 0.0)]),
        ([(1, "P", 0), (2, "P", 1), (1, "U", 2), (2, "U", 4)], [(1, 0, 2.0), (2, 1, 3.0)]),
    ],
)
def test_pairs(table, rows, expected):
    assert spans(readings(table, *rows)) == expected


def test_repeated_snapshots_give_one_session(table):
    rows = [(1, "P", 0), (1, "U", 12.5)]
    repeated = readings(table, *rows).drop("id")
    repeated = distinct_rows(repeated.unionByName(repeated)).withColumn("id", F.lit(0))
    assert spans(repeated) == [(1, 0, 12.5)]


def test_session_columns_and_key(table):
    out = state_sessions(
        readings(table, (1, "P", 0), (1, "U", 1)), "bay", "status", "at", "P", "U", ["id"]
    )
    assert out.columns == [
        "session_id", "bay", "arrival_time", "departure_time", "duration_minutes",
    ]
    expected = F.md5(F.lit("1-2024-01-06 10:00:00"))
    assert out.first()["session_id"] == out.select(expected.alias("k")).first()["k"]


def naive_sessions(rows):
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    found = []
    for key, own in by_key.items():
        own.sort(key=lambda r: (r[2] is not None, r[2] or T0, r[3]))
        for a, b in zip(own, own[1:], strict=False):
            if a[1] == "P" and b[1] == "U" and b[2] is not None:
                found.append((key, a[2], b[2]))
    return sorted(found, key=str)


events = st.lists(
    st.tuples(
        st.sampled_from([1, 1, 1, 2, None]),
        st.sampled_from(["P", "U", "X", None]),
        st.one_of(st.none(), st.integers(0, 40).map(at)),
    ),
    max_size=80,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=events, per_slice=st.sampled_from([None, 1, 3, 10]))
def test_matches_plain_python_with_any_slicing(spark, rows, per_slice):
    numbered = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, DDL)
    out = state_sessions(
        df, "bay", "status", "at", "P", "U", ["id"], rows_per_slice=per_slice
    )
    got = sorted(((r.bay, r.arrival_time, r.departure_time) for r in out.collect()), key=str)
    assert got == naive_sessions(numbered)


def test_hot_key_is_sliced_and_others_are_not(spark):
    rows = [(1, "P", at(m), m) for m in range(900)] + [(b, "U", at(b), b) for b in range(2, 102)]
    df = spark.createDataFrame(rows, DDL)
    grid = large_keys(df, ["bay"], "at", rows_per_slice=100).collect()
    assert [r["__k0"] for r in grid] == [1]
    assert grid[0]["__last"] >= 9
    none = with_next(df, ["bay"], "at", ["status", "at"], ["id"], rows_per_slice=None)
    cut = with_next(df, ["bay"], "at", ["status", "at"], ["id"], rows_per_slice=100)
    assert cut.columns == none.columns
    assert cut.exceptAll(none).isEmpty() and none.exceptAll(cut).isEmpty()


def test_more_hot_keys_than_the_limit_changes_nothing(spark):
    rows = [(b, "PU"[m % 2], at(m), m) for b in range(5) for m in range(40)]
    df = spark.createDataFrame(rows, DDL)
    kw = {"key": "bay", "state": "status", "ts": "at", "start": "P", "end": "U"}
    cut = state_sessions(df, **kw, tie_break=["id"], rows_per_slice=4)
    assert cut.count() == 100
    whole = state_sessions(df, **kw, tie_break=["id"], rows_per_slice=None)
    assert cut.exceptAll(whole).isEmpty()


def test_copies_of_one_row_do_not_reach_one_task(spark):
    """A third of the input is one reading, sent again and again."""
    rows = [(1, "PU"[m % 2], at(m), m) for m in range(60)] + [(2, "P", at(0), 0), (2, "U", at(4), 1)]
    df = spark.createDataFrame(rows + [rows[20]] * 30 + [rows[-1]] * 2, DDL)
    kw = {"key": "bay", "state": "status", "ts": "at", "start": "P", "end": "U"}
    cut = state_sessions(df, **kw, tie_break=["id"], rows_per_slice=10)
    whole = state_sessions(df, **kw, tie_break=["id"], rows_per_slice=None)
    assert cut.count() == whole.count() == 31
    assert cut.exceptAll(whole).isEmpty()
    same_state = state_sessions(
        df, "bay", "status", "at", "P", "P", ["id"], rows_per_slice=10
    )
    assert same_state.count() == 30


def test_a_burst_is_cut_again(spark):
    """Most rows of the key fall into one of its even slices."""
    times = [T0 + timedelta(seconds=s) for s in range(400)] + [at(60 * 24 * d) for d in range(1, 50)]
    df = spark.createDataFrame([(1, "PU"[i % 2], t, i) for i, t in enumerate(times)], DDL)
    cut = in_slices(df, ["bay"], "at", rows_per_slice=20)
    assert cut.groupBy("__slice").count().agg(F.max("count")).first()[0] <= 20
    one = with_next(df, ["bay"], "at", ["id"], ["id"], rows_per_slice=20)
    two = with_next(df, ["bay"], "at", ["id"], ["id"], rows_per_slice=None)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_the_plan_is_the_same_for_small_inputs(spark):
    df = spark.range(10).selectExpr("id AS bay", "timestamp_micros(id) AS at")
    plan = with_next(df, ["bay"], "at", ["at"])._jdf.queryExecution().optimizedPlan().toString()
    assert "__slice" in plan


def file_scans(df):
    """File scans of the plan that ran, and its text."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("FileScan" in line for line in plan.splitlines()), plan


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=events, seconds=st.sampled_from([1, 60, 420, 86_400]))
def test_time_slices_match_plain_python(spark, rows, seconds):
    """One hot key, several rows at one instant, NULL keys, times and states."""
    numbered = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, DDL)
    cut = with_next(df, ["bay"], "at", ["status", "at", "id"], ["id"], slice_seconds=seconds)
    whole = with_next(df, ["bay"], "at", ["status", "at", "id"], ["id"], rows_per_slice=None)
    assert cut.columns == whole.columns
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()
    out = state_sessions(df, "bay", "status", "at", "P", "U", ["id"])
    got = sorted(((r.bay, r.arrival_time, r.departure_time) for r in out.collect()), key=str)
    assert got == naive_sessions(numbered)


def test_next_rows_come_from_one_scan(spark, tmp_path):
    rows = [(b, "PU"[m % 2], at(m * 31), m) for m in range(200) for b in range(3)]
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/rows")
    read = spark.read.parquet(f"{tmp_path}/rows")
    with runtime.settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        scans, plan = file_scans(with_next(read, ["bay"], "at", ["at", "status"], ["id"]))
        assert scans == 1 and "ReusedExchange" in plan
        scans, plan = file_scans(state_sessions(read, "bay", "status", "at", "P", "U", ["id"]))
        assert scans == 1


def test_copies_collapse_in_time_slices(spark):
    rows = [(1, "P", at(0), 0)] * 30 + [(1, "U", at(5), 1)] * 2 + [(1, "P", at(70), 2)]
    out = state_sessions(spark.createDataFrame(rows, DDL), "bay", "status", "at", "P", "U", ["id"])
    assert [(r.arrival_time, r.departure_time) for r in out.collect()] == [(at(0), at(5))]
