from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventmart.operators import kpi, quality
from eventmart.plans import marts

T0 = datetime(2024, 1, 6, 10, 0)  # Saturday


def at(minutes):
    return T0 + timedelta(minutes=minutes)


FACT = "session_id string, bay_id int, duration_minutes double"


@pytest.fixture
def fact(table):
    return table(
        FACT, ("a", 1, 5.0), ("a", 1, -1.0), (None, 1, None), ("b", 9, 2881.0), ("c", None, 1.0)
    )


def test_single_checks(fact, table, same):
    bays = table("bay_id int", (1,), (None,))
    same(quality.unique(fact, "session_id"), ("a", 2))
    same(quality.not_null(fact, "session_id"), (None, 1, None))
    same(quality.expression(fact, "duration_minutes >= 0"), ("a", 1, -1.0))
    same(quality.max_value(fact, "duration_minutes", 2880), ("b", 9, 2881.0))
    same(quality.relationships(fact, "bay_id", bays, "bay_id"), ("b", 9, 2881.0))


def test_report(fact, table, same):
    out = quality.report(
        fact,
        unique_cols=["session_id"],
        not_null_cols=["session_id"],
        expressions={"not_negative": F.col("duration_minutes") >= 0},
        max_values={"duration_minutes": 2880},
        references=[("bay_id", table("bay_id int", (1,), (9,)), "bay_id")],
    )
    same(
        out,
        ("unique_session_id", 1, "fail"),
        ("not_null_session_id", 1, "fail"),
        ("not_negative", 1, "fail"),
        ("max_value_duration_minutes", 1, "fail"),
        ("relationships_bay_id", 0, "pass"),
    )
    with pytest.raises(ValueError):
        quality.report(fact)


def test_report_of_an_empty_table_passes(fact):
    out = quality.report(fact.limit(0), unique_cols=["bay_id"], not_null_cols=["bay_id"])
    assert {(r.failing_rows, r.status) for r in out.collect()} == {(0, "pass")}


def test_duplicates_and_profile(table, same):
    df = table("a int, b int, v int", (1, 1, 1), (1, 1, 2), (1, 2, 3), (None, 1, 4), (None, 1, 5))
    same(quality.duplicate_keys(df, ["a", "b"]), (1, 1, 2), (None, 1, 2))
    same(quality.duplicate_rows(df, ["a", "b"]).select("v"), (1,), (2,), (4,), (5,))
    assert quality.duplicate_rows(df, ["v"]).isEmpty()
    same(quality.profile(df, ["v"]), (5, 5))
    same(quality.profile(df, ["a", "b"]), (5, 3))


SESSIONS = (
    "session_id string, bay_id int, arrival_time timestamp_ntz, departure_time timestamp_ntz,"
    " duration_minutes double"
)


@pytest.fixture
def sessions(table):
    return table(
        SESSIONS,
        ("a", 1, at(0), at(30), 30.0),
        ("b", 1, at(70), at(200), 130.0),
        ("c", 2, at(10), at(75), 65.0),
    )


def test_occupancy(sessions, same):
    out = kpi.occupancy_over_time(sessions, "arrival_time", "departure_time", "hour")
    same(out, (at(0), 2, 1), (at(60), 1, 1), (at(180), 0, 0))
    by_bay = kpi.occupancy_over_time(sessions, "arrival_time", "departure_time", "hour", ["bay_id"])
    same(
        by_bay,
        (1, at(0), 1, 0), (1, at(60), 1, 1), (1, at(180), 0, 0),
        (2, at(0), 1, 1), (2, at(60), 0, 0),
    )


def test_over_capacity(sessions, table, same):
    occupancy = kpi.occupancy_over_time(
        sessions, "arrival_time", "departure_time", "hour", ["bay_id"]
    )
    capacity = table("bay_id int, capacity int", (1, 0), (2, 1))
    out = kpi.over_capacity(occupancy, capacity, ["bay_id"])
    same(out.select("bay_id", "period"), (1, at(60)))


def test_totals_turnover_peaks(sessions, same):
    day = datetime(2024, 1, 6)
    same(kpi.period_totals(sessions, "arrival_time"), (day, 3, 225.0, 75.0))
    same(kpi.turnover(sessions, "bay_id", "arrival_time"), (1, day, 2), (2, day, 1))
    same(kpi.peak_hours(sessions, "arrival_time", 1), (10, 2))
    assert [r.bay_id for r in kpi.top_by_count(sessions, ["bay_id"], 2).collect()] == [1, 2]


def test_variance(table, same):
    rollup = table("zone int, p int, total double", (1, 1, 10.0), (1, 2, 15.5), (2, 1, 7.0))
    out = kpi.variance(rollup, "p", "total", ["zone"])
    same(out, (1, 1, 10.0, None, None), (1, 2, 15.5, 10.0, 5.5), (2, 1, 7.0, None, None))


def test_flag_share(table, same):
    df = table("card boolean", (True,), (False,), (False,), (True,))
    same(kpi.flag_share(df, "card"), (0.5,))


RULES = (
    "bay_id int, rule_number int, max_minutes int, start_time string, end_time string,"
    " day_range string, type_desc string"
)


def in_force(table, arrival, *rules):
    sessions = table(SESSIONS, ("s", 1, arrival, arrival + timedelta(minutes=90), 90.0))
    ruled = kpi.rule_in_force(sessions, table(RULES, *rules), "bay_id", "arrival_time")
    return kpi.overstays(ruled).first()


def test_rule_bounds_and_order(table):
    rule = (1, 2, 60, "10:00", "12:00", "6", "1P")
    assert in_force(table, at(0), rule).is_overstay
    assert in_force(table, at(119), rule).rule_number == 2
    assert in_force(table, at(120), rule).rule_number is None
    assert in_force(table, at(24 * 60), rule).rule_number is None
    lower = (1, 1, 120, "09:00", "18:00", None, "2P")
    got = in_force(table, at(0), rule, lower)
    assert (got.rule_number, got.rule_type, got.is_overstay) == (1, "2P", False)
    assert not in_force(table, at(0), (2, 1, 1, "00:00", "23:59", None, "x")).is_overstay


def test_rule_past_midnight_belongs_to_its_first_day(table):
    night = (1, 1, 30, "22:00", "06:00", "6", "night")
    assert in_force(table, datetime(2024, 1, 6, 23), night).is_overstay
    assert in_force(table, datetime(2024, 1, 7, 5, 59), night).is_overstay
    assert not in_force(table, datetime(2024, 1, 7, 6), night).is_overstay
    assert not in_force(table, datetime(2024, 1, 6, 5), night).is_overstay
    sunday = (1, 1, 30, "22:00", "06:00", "0", "night")
    assert in_force(table, datetime(2024, 1, 8, 1), sunday).is_overstay


def test_rules_of_same_hours_keep_the_lowest(table):
    rows = [(1, n, n, "00:00", "00:00", None, f"r{n}") for n in (3, 1, 2)] * 50
    assert in_force(table, at(0), *rows).rule_number == 1


def test_rule_without_hours_or_limit(table):
    assert in_force(table, at(0), (1, 1, 5, None, "12:00", None, "x")).rule_number is None
    got = in_force(table, at(0), (1, 1, None, "09:00", "12:00", None, "x"))
    assert got.rule_number == 1 and not got.is_overstay


def test_minutes_by_rule_type(sessions, table, same):
    rules = table(RULES, (1, 1, 60, "10:00", "11:00", None, "1P"))
    ruled = kpi.rule_in_force(sessions, rules, "bay_id", "arrival_time")
    same(kpi.minutes_by_rule_type(ruled), ("1P", 1, 30.0), (None, 2, 195.0))


def test_report_widens_without_losing_sessions(sessions, table):
    bays = table("bay_id int, bay_description string", (1, "north"))
    out = marts.session_report(sessions, [(bays, ["bay_id"])], weekend=True)
    assert out.count() == 3
    row = out.filter("session_id = 'a'").first()
    assert (row.bay_description, row.stay_category) == ("north", "Medium Stay")
    assert row.arrival_hour == T0 and row.is_weekend_arrival
    assert out.filter("session_id = 'c'").first().bay_description is None
    assert marts.report_slice(out, bay_id=1, stay_category="Long Stay").count() == 1
    assert kpi.stay_shares(out).count() == 2


def test_enrich_zone_with_other_key_name(table, same):
    df, zones = table("bay int, zone int", (1, 7), (2, 8)), table("zone_number int, d string", (7, "x"))
    same(marts.enrich_zone(df, zones, "zone", "zone_number"), (1, 7, "x"), (2, 8, None))


def test_dimension_with_key_and_load_time(table):
    df = table("a int, b int", (1, 2))
    out = marts.dimension(df, {"x": "a"}, "k", ["a", "b"], F.lit(T0))
    assert out.columns == ["k", "x", "load_timestamp"]


def _moves(spark, n, step):
    rng = __import__("random").Random(step)
    rows = []
    for i in range(n):
        start = T0 + timedelta(seconds=rng.randrange(step * n))
        end = None if i % 7 == 0 else start + timedelta(seconds=rng.randrange(step * 9))
        rows.append((f"s{i}", i % 3, start, end, 1.0))
    return spark.createDataFrame(rows, SESSIONS), rows


@pytest.mark.parametrize("grid, step", [("second", 40_000), ("hour", 9_000)])
def test_occupancy_without_keys_is_no_single_task(spark, grid, step):
    sessions, rows = _moves(spark, 60, step)
    out = kpi.occupancy_over_time(sessions, "arrival_time", "departure_time", grid)
    got = {r.period: (r.arrivals, r.occupied) for r in out.collect()}

    def cut(t):
        return t.replace(microsecond=0, **({"second": 0, "minute": 0} if grid == "hour" else {}))

    moves = [(cut(r[2]), 1) for r in rows] + [(cut(r[3]), -1) for r in rows if r[3]]
    want = {
        p: (sum(m > 0 for q, m in moves if q == p), sum(m for q, m in moves if q <= p))
        for p, _ in moves
    }
    assert got == want
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_variance_without_keys_is_no_single_task(spark):
    days = [T0 + timedelta(days=d, hours=h) for d in (0, 1, 9, 400) for h in (0, 5)]
    rows = [(d, float(i * i)) for i, d in enumerate(days)]
    out = kpi.variance(spark.createDataFrame(rows, "p timestamp_ntz, total double"), "p", "total")
    got = sorted(tuple(r) for r in out.collect())
    want = [(d, v, rows[i - 1][1] if i else None, v - rows[i - 1][1] if i else None)
            for i, (d, v) in enumerate(rows)]
    assert got == want
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    numbers = [(1 << 43, 2.0), (5, 1.0), (-3, 7.0)]
    out = kpi.variance(spark.createDataFrame(numbers, "p long, total double"), "p", "total")
    assert {r.p: r.previous for r in out.collect()} == {-3: None, 5: 7.0, 1 << 43: 1.0}


def test_segments_of_a_stay_add_up_and_follow_the_rules(table, spark):
    stay = ("s", 1, datetime(2024, 1, 5, 21, 30), datetime(2024, 1, 8, 9, 15), 3585.0)
    sessions = table(SESSIONS, stay, ("z", 1, T0, T0, 0.0), ("o", 1, T0, None, None), ("n", 5, T0, at(90), 90.0))
    rules = table(
        RULES,
        (1, 2, 60, "07:00", "18:00", None, "day"),
        (1, 1, 30, "22:00", "06:00", "6", "saturday night"),
        (1, 3, 30, "05:00", "08:00", "0", "sunday morning"),
    )
    out = kpi.rules_along_stay(sessions, rules, "bay_id", "arrival_time", "departure_time")
    rows = out.collect()
    lengths = {}
    for r in rows:
        lengths[r.session_id] = lengths.get(r.session_id, 0) + r.micros
    assert lengths == {"s": int(3585 * 6e7), "n": int(90 * 6e7)}

    def held(t):
        m, d = t.hour * 60 + t.minute, (t.weekday() + 1) % 7
        if (d == 6 and m >= 22 * 60) or (d == 0 and m < 6 * 60):
            return "saturday night"
        if 7 * 60 <= m < 18 * 60:
            return "day"
        return "sunday morning" if d == 0 and 5 * 60 <= m < 8 * 60 else None

    by_type, t = {}, stay[2]
    while t < stay[3]:
        by_type[held(t)] = by_type.get(held(t), 0) + 1
        t += timedelta(minutes=1)
    got = kpi.minutes_along_stay(out.filter("session_id = 's'"))
    assert {r.rule_type: r.total_minutes for r in got.collect()} == by_type
