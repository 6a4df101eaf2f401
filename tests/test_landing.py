"""What landing must keep: undeclared columns, unreadable records, open stays."""

import gzip
import json

import pytest
from pyspark.sql import types as T

from eventmart.operators import kpi
from eventmart.operators.sessions import state_sessions
from eventmart.plans import jobs
from eventmart.sources import files


def test_landing_keeps_undeclared_columns_and_broken_records(spark, tmp_path):
    raw, archive = tmp_path / "raw", str(tmp_path / "archive")
    raw.mkdir()
    rows = [{"meter_id": "m1", "extra": 5, "nested": {"a": 1}}]
    (raw / "parking_meters_20240101_000000.json").write_text(json.dumps(rows))
    jobs.load_export(spark, str(raw), "parking_meters", archive)
    landed = spark.read.parquet(f"{archive}/parking_meters").first()
    assert (landed.meter_id, landed.extra, landed.nested) == ("m1", "5", '{"a": 1}')
    assert landed._corrupt_record is None and landed.asset_id is None

    (raw / "parking_meters_20240102_000000.json").write_text('[{"meter_id": "m2"')
    jobs.load_export(spark, str(raw), "parking_meters", archive)
    kept = spark.read.parquet(f"{archive}/parking_meters").collect()
    assert [r._corrupt_record for r in kept] == ['[{"meter_id": "m2"']


def test_streamed_landing_keeps_undeclared_columns(spark, tmp_path):
    raw, archive = tmp_path / "raw", str(tmp_path / "archive")
    raw.mkdir()
    places = (str(raw), "parking_sensors", archive, str(tmp_path / "cp"))
    jobs.load_new_exports(spark, *places)  # no file yet: nothing happens
    (raw / "parking_sensors_20240101_000000.json").write_text('[{"kerbsideid": 1, "note": "x"}]')
    jobs.load_new_exports(spark, *places)
    landed = spark.read.parquet(f"{archive}/parking_sensors").first()
    assert (landed.kerbsideid, landed.note) == (1, "x")


def test_snapshot_may_be_a_folder_of_json_lines(spark, table, tmp_path, same):
    rows = table("k int, v string", (1, "a"), (2, "b"))
    for stamp, key in (("20240101", 1), ("20240102", 2)):
        rows.filter(f"k = {key}").write.json(str(tmp_path / f"t_{stamp}.json"))
    (tmp_path / "t_all_20240103.json").write_text("{}")
    read = lambda mode: files.read_json_snapshots(
        spark, str(tmp_path), "t", rows.schema, mode, multi_line=False
    )
    same(read("history"), (1, "a"), (2, "b"))
    same(read("snapshot"), (2, "b"))
    none = files.read_json_snapshots(spark, str(tmp_path), "u", rows.schema, rescue="bad")
    assert none.columns == ["k", "v", "bad"] and none.isEmpty()


def test_open_stays(spark, table, same):
    events = table(
        "k int, s string, t string",
        (1, "in", "2024-01-01 10:00:00"), (1, "out", "2024-01-01 11:00:00"),
        (1, "in", "2024-01-01 12:00:00"), (2, "in", "2024-01-01 10:30:00"),
        (3, "in", "2024-01-01 10:00:00"), (3, None, "2024-01-01 10:05:00"), (4, "in", None),
    )
    events = events.selectExpr("k", "s", "CAST(t AS timestamp_ntz) AS t")
    for slice_rows in (None, 1):
        stays = state_sessions(
            events, "k", "s", "t", "in", "out", rows_per_slice=slice_rows, keep_open=True
        )
        same(
            stays.selectExpr("k", "hour(arrival_time)", "hour(departure_time)", "duration_minutes"),
            (1, 10, 11, 60.0), (1, 12, None, None), (2, 10, None, None),
        )
    parked = kpi.occupancy_over_time(stays, "arrival_time", "departure_time")
    same(parked.selectExpr("hour(period)", "occupied"), (10, 2), (11, 1), (12, 2))


def test_rule_with_unreadable_day_is_left_out(spark, table, same):
    stays = table("bay int, t string", (1, "2024-01-01 10:00:00"), (None, "2024-01-01 10:00:00"))
    stays = stays.selectExpr("bay", "CAST(t AS timestamp_ntz) AS t")
    rules = table(
        "bay int, rule_number int, max_minutes int, start_time string, end_time string,"
        " day_range string, type_desc string",
        (1, 1, 60, "07:00", "18:00", "Mon", "first"), (1, 2, 30, "07:00", "18:00", None, "second"),
        (None, 1, 5, "07:00", "18:00", None, "nobody"),
    )
    ruled = kpi.rule_in_force(stays, rules, "bay", "t")
    same(ruled.select("bay", "rule.type"), (1, "second"), (None, None))


DECLARED = T.StructType([T.StructField(n, T.StringType()) for n in ("u", "v")])


def read_bytes(spark):
    """Bytes read from local files by this process so far."""
    files_ = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    return files_.getLong("bytesRead")


def test_undeclared_values_cost_no_read_each(spark, tmp_path):
    raw, archive = tmp_path / "raw", str(tmp_path / "archive")
    raw.mkdir()
    export = raw / "parking_sensors_20240101_000000.json"
    rows = [{"kerbsideid": i, "level": i / 4, "place": [i]} for i in range(2_000)]
    export.write_text(json.dumps(rows, indent=2))
    read = (
        lambda: jobs.load_export(spark, str(raw), "parking_sensors", archive),
        lambda: jobs.load_new_exports(
            spark, str(raw), "parking_sensors", f"{archive}_s", str(tmp_path / "cp")
        ),
    )
    for job, at in zip(read, (archive, f"{archive}_s"), strict=True):
        before = read_bytes(spark)
        job()
        assert read_bytes(spark) - before < 20 * export.stat().st_size
        landed = spark.read.parquet(f"{at}/parking_sensors")
        assert landed.filter("level = cast(kerbsideid / 4 AS string)").count() == 2_000


@pytest.mark.parametrize(
    "body",
    (
        b'[ {"u": 1.10, "v": -0}, {"u":7 ,"v":8\n}, {"v": [ 1,  2 ], "u":{ "a" : 1.0 }} ]\n',
        b'[\r\n {\r\n "u": 5\r\n }\r\n]\r\n',
        b'{"u": 1e5, "v": 12345678901234567890123.4500}\n{"u": 2}\n',
        b'[{"u": 1}, {"u": 2',
        b"[]",
        b" \n",
        b'[null, {"u": 1}]',
        b'[{"u": "a\x00b", "v": 5}]',
        b'\xef\xbb\xbf[{"u": 5}]',
        '[{"u": {"\u00df" : "\u6f22"}, "v": true}]'.encode(),
        '[{"u": "x", "v": 5}]'.encode("utf-16"),
        '[{"u": "x", "v": 5}]'.encode("utf-32-be"),
    ),
)
def test_a_file_as_one_record_gives_what_multi_line_mode_gives(spark, tmp_path, body):
    for name, content in (("part-0.json", body), ("part-1.json.gz", gzip.compress(body))):
        folder = tmp_path / name[:6] / "t_20240101_000000.json"
        folder.mkdir(parents=True)
        (folder / name).write_bytes(content)
        got = files.read_json_snapshots(spark, str(folder.parent), "t", DECLARED, rescue="bad")
        reader = spark.read.schema(got.schema).option("columnNameOfCorruptRecord", "bad")
        expected = reader.option("multiLine", True).json(str(folder)).collect()
        assert sorted(map(repr, got.collect())) == sorted(map(repr, expected))
        assert got.count() == len(expected)


def test_files_that_are_no_record_are_read_as_before(spark, tmp_path, monkeypatch):
    path = tmp_path / "t_20240101_000000.json"
    path.write_text('[{"u": 1.50}, {"v": 2}]')
    assert files.file_separator(spark, str(path)).startswith("\0")
    monkeypatch.setattr(files, "ONE_RECORD", 10)
    assert files.file_separator(spark, str(path)) is None
    got = files.read_json_snapshots(spark, str(tmp_path), "t", DECLARED)
    assert sorted(map(repr, got.collect())) == ["Row(u='1.50', v=None)", "Row(u=None, v='2')"]
