"""Raw exports to gold, end to end on hand-made files."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmart.operators import history
from eventmart.plans import jobs, parking
from eventmart.sources import sinks

LOADED = datetime(2024, 2, 1)


def export(folder, prefix, stamp, rows):
    (folder / f"{prefix}_{stamp}.json").write_text(json.dumps(rows, indent=2))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    export(
        folder, "parking_bays", "20240101_000000", [{"kerbsideid": "1", "latitude": "old"}]
    )
    export(
        folder,
        "parking_bays",
        "20240102_000000",
        [
            {"kerbsideid": "1", "latitude": "-37.8", "longitude": "144.9",
             "roadsegmentdescription": "north", "lastupdated": "2024-01-02T00:00:00+00:00"},
            {"kerbsideid": "1", "latitude": "-37.8", "longitude": "144.9",
             "roadsegmentdescription": "older", "lastupdated": "2024-01-01T00:00:00+00:00"},
            {"kerbsideid": None, "latitude": "-1", "longitude": "1"},
            {"kerbsideid": "x9", "latitude": "-1", "longitude": "1"},
        ],
    )
    export(
        folder,
        "parking_meters",
        "20240102_000000",
        [
            {"meter_id": "m1", "asset_id": "12", "creditcard": "Yes", "tapandgo": None},
            {"meter_id": "m1", "asset_id": "12", "creditcard": "Yes", "tapandgo": None},
            {"meter_id": "m2", "asset_id": "x", "creditcard": "No", "tapandgo": "Yes"},
            {"meter_id": None, "asset_id": "3"},
        ],
    )
    export(
        folder,
        "parking_zones_plates",
        "20240102_000000",
        [
            {"parkingzone": "7", "restriction_days": None, "time_restrictions_start": "07:00"},
            {"parkingzone": "7", "restriction_days": None, "time_restrictions_start": "07:00",
             "restriction_display": "2P"},
            {"parkingzone": "seven"},
        ],
    )
    export(
        folder,
        "parking_restrictions",
        "20240102_000000",
        [
            {"bayid": "1", "description1": "1P", "duration1": 60, "starttime1": "07:00:00",
             "endtime1": "18:00:00", "fromday1": "6", "typedesc1": "1P Meter",
             "description2": "2P", "duration2": "120", "duration3": "5"},
        ],
    )
    return folder


def changes(folder, name, rows):
    """One landed file of change events: (op, bay, status, time)."""
    folder.mkdir(exist_ok=True)
    lines = []
    for op, bay, status, when in rows:
        image = {
            "kerbsideid": bay, "status_description": status, "zone_number": 7,
            "location": '{"lon": 144.9, "lat": -37.8}', "status_timestamp": when,
        }
        lines.append(json.dumps({"after": None if op == "d" else image, "op": op, "ts_ms": 1}))
    (folder / name).write_text("\n".join(lines))


def test_from_exports_to_gold(spark, raw, tmp_path, same):
    archive, landing = f"{tmp_path}/archive", tmp_path / "landing"
    written = []
    for prefix in parking.SILVER:
        jobs.load_export(
            spark, str(raw), prefix, archive, lambda df, t, m: written.append((t, m, df.count())),
            ts=LOADED,
        )
        sinks.ensure_database(spark, "bronze")
        jobs.ingest_reference(spark, f"{archive}/{prefix}", f"bronze.{prefix}", LOADED)
    assert ("raw_parking_meters", "overwrite", 3) in written

    changes(
        landing,
        "a.json",
        [
            ("c", 1, "Present", "2024-01-06T10:00:00+00:00"),
            ("u", 1, "Unoccupied", "2024-01-06T11:30:00+00:00"),
            ("r", 2, "Present", "2024-01-06T10:00:00+00:00"),
            ("d", 2, None, None),
        ],
    )
    places = (str(landing), "bronze.parking_sensors", "silver.parking_sensors", f"{tmp_path}/cp")
    sinks.ensure_database(spark, "silver")
    jobs.stream_sensors(spark, *places)
    assert spark.table("silver.parking_sensors").count() == 3
    jobs.stream_sensors(spark, *places)
    assert spark.table("silver.parking_sensors").count() == 3
    changes(landing, "b.json", [("u", 2, "Unoccupied", "2024-01-06T10:10:00+00:00")])
    changes(landing, "c.json", [("u", 2, "Unoccupied", "2024-01-06T10:10:00+00:00")])
    jobs.stream_sensors(spark, *places)
    assert spark.table("silver.parking_sensors").count() == 5
    assert spark.table("bronze.parking_sensors").filter("ingested_at IS NULL").isEmpty()
    same(spark.table("silver.parking_sensors").select("lat", "lon").distinct(), (-37.8, 144.9))

    jobs.build_silver(spark, "bronze", "silver")
    bays, meters = spark.table("silver.parking_bays"), spark.table("silver.parking_meters")
    same(bays.select("bay_id", "description"), (1, "north"))
    same(
        meters.select("meter_id", "asset_id", "has_credit_card", "has_tap_and_go"),
        ("m1", 12, True, False),
        ("m2", None, False, True),
    )
    same(spark.table("silver.parking_zones_plates").select("zone_number", "start_time"), (7, "07:00"))
    same(
        spark.table("silver.parking_restrictions").select("bay_id", "rule_number", "duration"),
        (1, 1, 60),
        (1, 2, 120),
    )

    jobs.build_gold(spark, "silver", "gold", LOADED)
    fact = spark.table("gold.fact_parking_sessions")
    same(fact.select("bay_id", "duration_minutes", "load_timestamp"), (1, 90.0, LOADED), (2, 10.0, LOADED))
    report = spark.table("gold.rpt_parking_master")
    assert report.columns == [
        "session_id", "arrival_time", "departure_time", "duration_minutes", "zone_number",
        "bay_description", "latitude", "longitude", "zone_restrictions", "arrival_hour",
        "stay_category",
    ]
    same(report.select("zone_number", "zone_restrictions").distinct(), (7, "2P"))
    same(report.select("bay_description", "stay_category"), ("north", "Long Stay"), (None, "Short Stay"))
    assert spark.table("gold.dim_restrictions").columns[:5] == [
        "restriction_key", "bay_id", "rule_number", "rule_description", "max_minutes",
    ]

    checks = parking.quality_reports(fact, spark.table("gold.dim_bays"))
    failed = checks.filter("status = 'fail'").select("model", "check", "failing_rows")
    same(failed, ("fact_parking_sessions", "relationships_bay_id", 1))

    jobs.run_checks(spark, "gold")
    assert spark.table("gold.quality_report").exceptAll(checks).isEmpty()
    jobs.build_indicators(spark, "gold")
    same(spark.table("gold.kpi_daily").select("sessions", "total_value"), (2, 100.0))
    same(spark.table("gold.kpi_zone_occupancy").select("zone_number").distinct(), (7,))
    overstays = spark.table("gold.kpi_overstays").select("bay_id", "rule_number", "is_overstay")
    same(overstays, (1, 1, True), (2, None, False))
    along = spark.table("gold.kpi_minutes_by_rule").select("rule_type", "total_minutes")
    same(along, ("1P Meter", 90.0), (None, 10.0))
    for day in (1, 2):
        jobs.snapshot_dimensions(spark, "silver", "hist", f"2024-02-0{day} 00:00:00")
    assert spark.table("hist.meters_history").count() == 2
    same(spark.table("hist.bays_history").select("bay_id", "valid_to"), (1, None))

    first = "2024-02-01 00:00:00"
    jobs.snapshot_history(spark, "gold.meters_snapshot", meters, parking.snapshot_meters, first)
    renewed = meters.withColumn("asset_id", F.lit(99))
    for _ in range(2):
        jobs.snapshot_history(
            spark, "gold.meters_snapshot", renewed, parking.snapshot_meters, "2024-02-02 00:00:00"
        )
    kept = spark.table("gold.meters_snapshot")
    assert kept.count() == 4 and kept.filter("valid_to IS NULL").count() == 2
    bay_history = parking.snapshot_bays(None, bays, first)
    moved = bays.withColumn("latitude", F.lit(0.0))
    bay_history = parking.snapshot_bays(bay_history, moved, "2024-02-02 00:00:00")
    same(
        history.as_dimension(bay_history).select("latitude", "is_current_record"),
        (-37.8, False),
        (0.0, True),
    )


def test_event_export_appends_reference_replaces(spark, tmp_path):
    raw, archive = tmp_path / "raw", f"{tmp_path}/archive"
    raw.mkdir()
    reading = {"kerbsideid": 1, "status_description": "Present", "zone_number": 7,
               "location": {"lon": 1.5, "lat": 2.5}, "status_timestamp": "2024-01-01T00:00:00+00:00"}
    for stamp in ("20240101_000000", "20240102_000000"):
        export(raw, "parking_sensors", stamp, [reading, {**reading, "zone_number": int(stamp[7])}])
    for _ in range(2):
        jobs.load_export(spark, str(raw), "parking_sensors", archive)
    landed = spark.read.parquet(f"{archive}/parking_sensors")
    assert landed.count() == 3  # the second run finds no new file
    assert landed.first()["location"] == '{"lon":1.5,"lat":2.5}'


def test_new_exports_are_read_once_and_moved(spark, tmp_path):
    raw, archive = tmp_path / "raw", f"{tmp_path}/archive"
    raw.mkdir()
    places = (str(raw), "parking_sensors", archive, f"{tmp_path}/cp", f"{tmp_path}/consumed")
    reading = {"kerbsideid": 1, "status_description": "Present"}
    seen = []
    for n, expected in ((1, 1), (1, 1), (2, 2), (3, 3)):
        export(raw, "parking_sensors", f"2024010{n}_000000", [reading, reading])
        jobs.load_new_exports(
            spark, *places, jdbc=lambda df, table, mode: seen.append((table, mode, df.count()))
        )
        assert spark.read.parquet(f"{archive}/parking_sensors").count() == expected
    assert seen == [("raw_parking_sensors", "append", 1)] * 3
    assert list((tmp_path / "consumed").rglob("*.json"))


def test_upsert_export(spark, raw):
    sinks.ensure_database(spark, "ops")
    for _ in range(2):
        jobs.upsert_export(spark, str(raw), "parking_bays", "ops.bays", ["kerbsideid", "latitude"])
    rows = spark.table("ops.bays")
    # the last file's two rows of the bay, which replace those of the run before
    assert rows.filter("kerbsideid = '1'").count() == 2
    assert rows.filter("kerbsideid IS NULL").count() == 2
