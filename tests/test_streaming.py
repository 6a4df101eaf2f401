import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.operators.sessions import state_sessions
from eventmart.sources import sinks
from eventmart.streaming import io, sessions, windows

T0 = datetime(2024, 1, 6, 10, 0)
DDL = "bay int, status string, at timestamp, id int"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture
def landing(tmp_path):
    """Write one JSON file per batch of (bay, status, minutes, id); files keep their order."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def write(*batches, start=0):
        for i, rows in enumerate(batches, start):
            lines = [
                json.dumps({"bay": b, "status": s, "at": at(m).strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z",
                            "id": n})
                for b, s, m, n in rows
            ]
            file = folder / f"{i:03d}.json"
            file.write_text("\n".join(lines))
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))  # the order files are read in
        return str(folder)

    return write


def drained(spark, df, base):
    conf = {**sessions.STATE_STORE, "spark.sql.shuffle.partitions": "2"}
    with runtime.settings(spark, **conf):
        io.drain(io.append_to_path(df, f"{base}/out", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/out")


def stream(spark, path, **kw):
    schema = spark.createDataFrame([], DDL).schema
    return io.read_json_stream(spark, path, schema, **kw)


def test_dedup_across_files(spark, landing, tmp_path, same):
    path = landing([(1, "P", 0, 0)], [(1, "P", 0, 1), (1, "U", 5, 2)], [(1, "U", 5, 3)])
    once = windows.dedup_stream(stream(spark, path, max_files=1), ["bay"], "at", "1 hour")
    same(drained(spark, once, tmp_path).select("bay", "at"), (1, at(0)), (1, at(5)))


def test_windows_close_with_the_watermark_and_late_rows_are_dropped(spark, landing, tmp_path, same):
    path = landing(
        [(1, "P", 0, 0), (1, "U", 10, 1)],
        [(1, "P", 200, 2)],
        [(1, "P", 210, 3)],
        [(1, "P", 20, 4)],  # its window has closed
        [(1, "U", 400, 5)],
    )
    shares = windows.occupancy_windows(
        stream(spark, path, max_files=1), "at", ["bay"], "status", "P", "1 hour", delay="10 minutes"
    )
    out = drained(spark, shares, tmp_path)
    same(
        out.select("window_start", "readings", "occupied_share"), (at(0), 2, 0.5), (at(180), 2, 1.0)
    )
    same(windows.alerts(out, 0.75).select("window_start"), (at(180),))


def test_rerun_reads_only_new_files_and_archives_old_ones(spark, landing, tmp_path):
    archive = tmp_path / "archive"
    path = landing([(1, "P", 0, 0)], [(1, "U", 1, 1)])
    for start, expected in ((None, 2), (None, 2), (2, 3)):
        if start:
            landing([(1, "P", 2, 2)], start=start)
        rows = stream(spark, path, archive_dir=str(archive), max_files=1)
        assert drained(spark, rows, tmp_path).count() == expected
    assert list(archive.rglob("*.json"))


def test_stream_append_adds_columns(spark, landing, tmp_path, same):
    """The same query, restarted with one more column."""
    spark.sql("CREATE DATABASE IF NOT EXISTS st")
    path = landing([(1, "P", 0, 0)])
    checkpoint = f"{tmp_path}/checkpoint"
    io.drain(io.append_to_table(stream(spark, path).select("bay"), "st.t", checkpoint))
    landing([(2, "P", 0, 0)], start=1)
    more = stream(spark, path).select(F.col("status"), F.col("bay"))
    io.drain(io.append_to_table(more, "st.t", checkpoint))
    same(spark.table("st.t").select("bay", "status"), (1, None), (2, "P"))
    assert io.read_table_stream(spark, "st.t").isStreaming


def test_sessions_equal_batch_over_closed_slices(spark, landing, tmp_path):
    """Out of order within the delay, across files, slices and buckets."""
    rows = [
        (b, "PUX"[(b * 7 + m * m) % 3], m * 7 + b, b * 100 + m) for m in range(40) for b in range(4)
    ]
    jumbled = sorted(rows, key=lambda r: r[2] + (13 if r[3] % 2 else 0))
    last = (0, "X", 5000, 9999)  # carries the watermark past all others
    batches = [jumbled[i : i + 40] for i in range(0, len(jumbled), 40)]
    path = landing(*batches, [last])
    near = sessions.slice_neighbours(
        stream(spark, path, max_files=1), "bay", "status", "at", "P", "U", ["id"],
        slice_ms=3_600_000, buckets=2, delay="30 minutes",
    )
    out = sessions.sessions(drained(spark, near, tmp_path), "bay", "P", "U", ts_type="timestamp")
    settled = spark.createDataFrame([(b, s, at(m), n) for b, s, m, n in rows], DDL)
    want = state_sessions(settled, "bay", "status", "at", "P", "U", ["id"])
    assert want.count() > 20
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def test_parquet_file_as_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "P", T0, 1)], DDL)
    df.coalesce(1).write.parquet(f"{tmp_path}/x.parquet")
    out = io.read_parquet_stream(spark, f"{tmp_path}/x.parquet", df.schema, max_files=1)
    assert drained(spark, out, tmp_path).count() == 1


def _rows_of_bays():
    """Rows out of order within half an hour, and the same in order of their numbers."""
    rows = [
        (b, "PUX"[(b * 7 + m * m) % 3], m * 7 + b, b * 100 + m) for m in range(40) for b in range(4)
    ]
    return rows, sorted(rows, key=lambda r: r[2] + (13 if r[3] % 2 else 0))


def test_settled_sessions_lack_only_what_the_watermark_holds(spark, landing, tmp_path):
    rows, jumbled = _rows_of_bays()
    path = landing(*[jumbled[i : i + 40] for i in range(0, len(jumbled), 40)])
    out = sessions.settled_sessions(
        stream(spark, path, max_files=1), "bay", "status", "at", "P", "U", ["id"],
        delay="30 minutes", ts_type="timestamp",
    )
    out = drained(spark, out, tmp_path)
    df = spark.createDataFrame([(b, s, at(m), n) for b, s, m, n in rows], DDL)
    last = at(max(m for _, _, m, _ in rows) - 30)
    want = state_sessions(df, "bay", "status", "at", "P", "U", ["id"])
    want = want.filter(F.col("departure_time") < F.lit(last).cast("timestamp"))
    assert want.count() > 20
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def test_crossings_report_a_change_of_side_once(spark, landing, tmp_path, same):
    # minutes stand for the value: 60 and more is above
    values = {1: [10, 70, 90, 20, 30, 80], 2: [65, 5, 6]}
    rows = [(b, "x", 100 * i, v) for b, vs in values.items() for i, v in enumerate(vs)]
    path = landing(rows[::2], rows[1::2], [(9, "x", 5000, 0)])
    out = windows.crossings(
        stream(spark, path, max_files=2).withColumnRenamed("id", "value"),
        ["bay"], "at", "value", 60, delay="1 day",
    )
    got = drained(spark, out, tmp_path).filter("bay != 9")
    same(got, (1, at(100), 70.0, True), (1, at(300), 20.0, False), (1, at(500), 80.0, True),
         (2, at(0), 65.0, True), (2, at(100), 5.0, False))


def test_two_checkpoints_append_to_one_table(spark, landing, tmp_path, same):
    spark.sql("CREATE DATABASE IF NOT EXISTS st")
    path = landing([(1, "P", 0, 0)], [(2, "U", 0, 1)])
    for n in "ab":
        rows = stream(spark, path, max_files=1).select("bay", "status")
        rows = rows.withColumn("source", F.lit(n)) if n == "b" else rows
        for _ in range(2):  # a rerun finds nothing new
            io.drain(io.append_batches(rows, "st.shared", f"{tmp_path}/{n}"))
    same(spark.table("st.shared").select("bay", "status", "source"),
         (1, "P", None), (2, "U", None), (1, "P", "b"), (2, "U", "b"))
    # a batch that is done again replaces itself
    again = spark.table("st.shared").filter("source = 'b' AND bay = 2")
    batch = again.first()["_batch"]
    sinks.replace_partitions(spark.createDataFrame([(7, "X", "b", batch)], again.schema), "st.shared")
    assert spark.table("st.shared").count() == 4
    assert spark.table("st.shared").filter("bay = 2").count() == 1
