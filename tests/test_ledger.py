"""Loads that remember what they have read."""

import json

import pytest
from pyspark.sql import functions as F

from eventmart.plans import jobs
from eventmart.sources import sinks


def export(folder, number, *rows):
    folder.mkdir(exist_ok=True)
    (folder / f"parking_sensors_2024010{number}_000000.json").write_text(json.dumps(rows, indent=2))


def reading(bay, **more):
    return {"kerbsideid": bay, "status_description": "Present", **more}


def landed(spark, archive):
    return sorted(r["kerbsideid"] for r in spark.read.parquet(f"{archive}/parking_sensors").collect())


@pytest.fixture
def places(tmp_path):
    return tmp_path / "raw", str(tmp_path / "archive")


def test_a_second_run_adds_nothing_and_new_files_come_once(spark, places, tmp_path):
    raw, archive = places
    written = []

    def jdbc(df, table, mode):
        written.append((table, mode, df.count(), df.select("_load_id").distinct().count()))

    export(raw, 1, reading(1), reading(2, extra="x"))
    for _ in range(2):
        jobs.load_export(spark, str(raw), "parking_sensors", archive, jdbc)
    assert landed(spark, archive) == [1, 2]
    export(raw, 2, reading(3))
    for _ in range(2):
        jobs.load_export(spark, str(raw), "parking_sensors", archive, jdbc)
    assert landed(spark, archive) == [1, 2, 3]
    assert written == [("raw_parking_sensors", "append", 2, 1), ("raw_parking_sensors", "append", 1, 1)]


def test_a_load_that_stopped_is_done_again_with_its_files(spark, places):
    raw, archive = places
    export(raw, 1, reading(1))
    ids = []

    def broken(df, table, mode):
        ids.append(df.first()["_load_id"])
        if len(ids) == 1:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError, match="stop"):
        jobs.load_export(spark, str(raw), "parking_sensors", archive, broken)
    export(raw, 2, reading(2))
    jobs.load_export(spark, str(raw), "parking_sensors", archive, broken)
    assert landed(spark, archive) == [1, 2]
    assert len(ids) == 3 and ids[0] in ids[1:]


def test_read_files_are_moved_away(spark, places, tmp_path):
    raw, archive = places
    done = tmp_path / "done"
    for number in (1, 2):
        export(raw, 1, reading(number))  # a new file under an old name
        jobs.load_export(
            spark, str(raw), "parking_sensors", f"{archive}{number}", consumed_dir=str(done)
        )
        assert [p.name for p in done.iterdir() if not p.name.startswith(".")] == [
            "parking_sensors_20240101_000000.json"
        ]
        assert not [p for p in raw.iterdir() if not p.name.startswith(".")]
    assert landed(spark, f"{archive}2") == [2]


def test_upsert_export_keeps_undeclared_columns_and_broken_records(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS up")
    raw = tmp_path / "raw"
    raw.mkdir()
    rows = [{"meter_id": "m1", "surprise": 5}, {"meter_id": "m2"}]
    (raw / "parking_meters_20240101_000000.json").write_text(json.dumps(rows))
    sinks.overwrite_table(
        spark.createDataFrame([("m1", "old"), ("m9", "kept")], "meter_id string, asset_id string"),
        "up.meters",
    )
    jobs.upsert_export(spark, str(raw), "parking_meters", "up.meters", ["meter_id"])
    got = {r.meter_id: r for r in spark.table("up.meters").collect()}
    assert got["m1"].surprise == "5" and got["m1"].asset_id is None
    assert got["m9"].asset_id == "kept" and got["m2"].surprise is None
    (raw / "parking_meters_20240102_000000.json").write_text('[{"meter_id": "m1"')
    jobs.upsert_export(spark, str(raw), "parking_meters", "up.meters", ["meter_id"])
    kept = spark.table("up.meters").filter(F.col("_corrupt_record").isNotNull())
    assert kept.count() == 1 and spark.table("up.meters").count() == 4
