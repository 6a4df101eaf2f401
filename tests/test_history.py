from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.operators import history, merge

DAYS = [datetime(2024, 1, d) for d in range(1, 10)]
QUIET = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def day(i):
    return f"2024-01-0{i + 1} 00:00:00"


METER = "id string, card boolean"


def test_scd2_two_days(table, same):
    first = history.start_history(table(METER, ("m1", False), ("m2", False)), day(0))
    batch = table(METER, ("m1", True), ("m3", False))
    hist = history.scd2_apply(first, batch, ["id"], ["card"], day(1))
    expected = [
        ("m1", False, DAYS[0], DAYS[1]),
        ("m1", True, DAYS[1], None),
        ("m2", False, DAYS[0], None),
        ("m3", False, DAYS[1], None),
    ]
    same(hist, *expected)
    same(history.scd2_apply(hist, batch, ["id"], ["card"], day(2)), *expected)


def test_scd2_null_is_a_value(table, same):
    first = history.start_history(table("id int, v int", (1, None), (2, None)), day(0))
    hist = history.scd2_apply(first, table("id int, v int", (1, None), (2, 5)), ["id"], ["v"], day(1))
    same(
        hist,
        (1, None, DAYS[0], None),
        (2, None, DAYS[0], DAYS[1]),
        (2, 5, DAYS[1], None),
    )


def test_scd2_unchecked_column_does_not_version(table, same):
    ddl = "id int, v int, note string"
    first = history.start_history(table(ddl, (1, 1, "a")), day(0))
    hist = history.scd2_apply(first, table(ddl, (1, 1, "b")), ["id"], ["v"], day(1))
    same(hist, (1, 1, "a", DAYS[0], None))


def naive_scd2(snapshots):
    rows = []
    for i, snap in enumerate(snapshots):
        for key, value in snap.items():
            current = next((r for r in rows if r[0] == key and r[3] is None), None)
            if current is not None and current[1] == value:
                continue
            if current is not None:
                current[3] = DAYS[i]
            rows.append([key, value, DAYS[i], None])
    return sorted((tuple(r) for r in rows), key=str)


snapshot = st.dictionaries(st.integers(1, 6), st.one_of(st.none(), st.integers(1, 3)), max_size=6)


@QUIET
@given(snapshots=st.lists(snapshot, min_size=1, max_size=4))
def test_scd2_matches_plain_python(spark, snapshots):
    ddl = "id int, v int"
    frames = [spark.createDataFrame(list(s.items()), ddl) for s in snapshots]
    hist = history.start_history(frames[0], day(0))
    for i, frame in enumerate(frames[1:], 1):
        hist = history.scd2_apply(hist, frame, ["id"], ["v"], day(i))
    assert sorted((tuple(r) for r in hist.collect()), key=str) == naive_scd2(snapshots)


def test_as_dimension(table, same):
    ddl = "id int, valid_from timestamp_ntz, valid_to timestamp_ntz"
    hist = table(ddl, (1, DAYS[0], DAYS[1]), (1, DAYS[1], None))
    far = datetime(9999, 12, 31)
    same(
        history.as_dimension(hist), (1, DAYS[0], DAYS[1], False), (1, DAYS[1], far, True)
    )
    assert history.with_version_id(hist, ["id"]).select("version_id").distinct().count() == 2


HIST = "id int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"
FACT = "id int, at timestamp_ntz, n int"


def test_as_of_on_the_instant_of_a_change(table, same):
    hist = table(HIST, (1, "A", DAYS[0], DAYS[1]), (1, "B", DAYS[1], None))
    fact = table(FACT, (1, DAYS[1], 1))
    same(history.join_as_of(fact, hist, ["id"], "at").select("v"), ("B",))
    same(history.join_as_of(fact, hist, ["id"], "at", closed="both").select("v"), ("A",), ("B",))
    with pytest.raises(ValueError):
        history.join_as_of(fact, hist, ["id"], "at", closed="right")


def test_as_of_left_keeps_unmatched(table, same):
    hist = table(HIST, (1, "A", DAYS[1], DAYS[2]))
    fact = table(FACT, (1, DAYS[0], 1), (1, DAYS[5], 2), (2, DAYS[1], 3), (1, None, 4))
    out = history.join_as_of(fact, hist, ["id"], "at", how="left")
    assert out.columns == ["id", "at", "n", "v", "valid_from", "valid_to"]
    same(out.select("n", "v"), (1, None), (2, None), (3, None), (4, None))


hours = st.integers(0, 60).map(lambda h: DAYS[0] + timedelta(hours=h))
versions = st.lists(
    st.tuples(st.sampled_from([1, 1, 2]), st.text("abc", max_size=1), hours, st.one_of(st.none(), hours)),
    max_size=30,
)
facts = st.lists(st.tuples(st.sampled_from([1, 1, 2, 3]), hours), max_size=30)


@QUIET
@given(
    versions=versions,
    facts=facts,
    closed=st.sampled_from(["left", "both"]),
    per_slice=st.sampled_from([None, 1, 4]),
)
def test_as_of_matches_plain_python(spark, versions, facts, closed, per_slice):
    rows = [(k, at, i) for i, (k, at) in enumerate(facts)]
    out = history.join_as_of(
        spark.createDataFrame(rows, FACT),
        spark.createDataFrame(versions, HIST),
        ["id"],
        "at",
        closed=closed,
        versions_per_slice=per_slice,
    )
    want = [
        (n, v, a, b)
        for k, at, n in rows
        for key, v, a, b in versions
        if key == k and a <= at and (b is None or at < b or (closed == "both" and at == b))
    ]
    got = [(r.n, r.v, r.valid_from, r.valid_to) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_from_changes(table, same):
    log = table("id int, v string, at timestamp_ntz", (1, "a", DAYS[0]), (1, "b", DAYS[3]))
    out = history.from_changes(log, ["id"], "at")
    same(out, (1, "a", DAYS[0], DAYS[3]), (1, "b", DAYS[3], None))


KV = "k string, v int"


def test_replace_by_key_keeps_nulls_and_batch_repeats(table, same):
    target = table(KV, ("a", 1), ("b", 1), (None, 1))
    batch = table(KV, ("b", 2), ("b", 3), (None, 2))
    out = merge.replace_by_key(target, batch, ["k"])
    same(out, ("a", 1), (None, 1), ("b", 2), ("b", 3), (None, 2))


keyed = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), max_size=20
)


@QUIET
@given(target=keyed, batch=keyed)
def test_replace_by_key_matches_plain_python(spark, target, batch):
    out = merge.replace_by_key(
        spark.createDataFrame(target, KV), spark.createDataFrame(batch, KV), ["k"]
    )
    gone = {k for k, _ in batch if k is not None}
    want = [r for r in target if r[0] not in gone] + batch
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(want, key=str)


def test_append_fills_missing_columns(table, same):
    out = merge.append(table("a int, b int", (1, 2)), table("b int, c int", (3, 4)))
    same(out, (1, 2, None), (None, 3, 4))


@QUIET
@given(
    versions=versions,
    facts=st.lists(
        st.tuples(st.sampled_from([1, 1, 2, 3, None]), st.one_of(st.none(), hours)), max_size=30
    ),
    closed=st.sampled_from(["left", "both"]),
    how=st.sampled_from(["inner", "left"]),
    seconds=st.sampled_from([3_600, 36_000, 864_000]),
)
def test_as_of_by_carry_matches_plain_python(spark, versions, facts, closed, how, seconds):
    """Gaps, overlaps, empty and inverted intervals, versions with one start, NULL keys."""
    rows = [(k, at, i) for i, (k, at) in enumerate(facts)]
    out = history.join_as_of(
        spark.createDataFrame(rows, FACT),
        spark.createDataFrame([*versions, (None, "n", DAYS[0], None)], HIST),
        ["id"], "at", closed=closed, how=how, versions_per_slice="carry", slice_seconds=seconds,
    )
    want = []
    for k, at, n in rows:
        found = [
            (n, v, a, b)
            for key, v, a, b in versions
            if key == k and at is not None and a <= at
            and (b is None or at < b or (closed == "both" and at == b))
        ]
        want += found or ([(n, None, None, None)] if how == "left" else [])
    assert out.columns == ["id", "at", "n", "v", "valid_from", "valid_to"]
    got = [(r.n, r.v, r.valid_from, r.valid_to) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_as_of_by_carry_joins_on_no_key_alone(spark, tmp_path):
    facts = [(k, DAYS[0] + timedelta(hours=h), h) for k in range(3) for h in range(50)]
    hist = [(k, str(h), DAYS[0] + timedelta(hours=h), DAYS[0] + timedelta(hours=h + 5))
            for k in range(3) for h in range(0, 50, 5)]
    spark.createDataFrame(facts, FACT).write.parquet(f"{tmp_path}/facts")
    spark.createDataFrame(hist, HIST).write.parquet(f"{tmp_path}/hist")
    out = history.join_as_of(
        spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/hist"),
        ["id"], "at", versions_per_slice="carry",
    )
    assert out.count() == 150
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = [line for line in plan.splitlines() if "Join" in line and "Cross" not in line]
    assert joins and all("__slice" in line for line in joins)
