"""The parking preset: raw schemas, silver tables, gold models.

Only this module knows parking columns; everything else is parameterised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.flags import flag
from eventmart.operators import history, quality
from eventmart.operators.clean import project, require
from eventmart.operators.dedup import distinct_rows, latest_by
from eventmart.operators.kpi import DURATION
from eventmart.operators.reshape import unpivot_slots
from eventmart.operators.sessions import state_sessions
from eventmart.plans import marts
from eventmart.streaming.layers import silver_rows

# States of a bay, slots of a restriction row, longest believable stay.
OCCUPIED, FREE = "Present", "Unoccupied"
STATUS_CODES = {OCCUPIED: 1, FREE: 0}
RULE_SLOTS = 6
LONGEST_STAY_MINUTES = 48 * 60
LOCATION = "lat DOUBLE, lon DOUBLE"


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Raw columns, as the exports name them. Everything arrives as text or a
# number and is typed in silver, so text is the safe declaration.
RAW = {
    "parking_bays": _strings(
        "kerbsideid latitude longitude roadsegmentdescription lastupdated"
    ),
    "parking_meters": _strings(
        "meter_id asset_id creditcard tapandgo latitude longitude location_description"
    ),
    "parking_zones_plates": _strings(
        "parkingzone restriction_days restriction_display time_restrictions_start"
        " time_restrictions_finish"
    ),
    "parking_restrictions": _strings(
        "bayid "
        + " ".join(
            f"{field}{n}"
            for n in range(1, RULE_SLOTS + 1)
            for field in (
                "description", "duration", "starttime", "endtime", "fromday",
                "effectiveonph", "typedesc",
            )
        )
    ),
    "parking_sensors": T.StructType(
        [
            T.StructField("kerbsideid", T.IntegerType()),
            T.StructField("status_description", T.StringType()),
            T.StructField("zone_number", T.IntegerType()),
            T.StructField(
                "location",
                T.StructType(
                    [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]
                ),
            ),
            T.StructField("status_timestamp", T.StringType()),
        ]
    ),
}

# The row image inside a change event: the landed table keeps structs as JSON text.
SENSOR_IMAGE = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "location" else f.dataType)
        for f in RAW["parking_sensors"].fields
    ]
)

# Exports of which every file is kept; of all others the last one replaces the table.
HISTORY_EXPORTS = {"parking_sensors"}


# --- silver --------------------------------------------------------------------------


def silver_sensors(bronze: DataFrame) -> DataFrame:
    """Typed sensor readings from change events; runs on a batch and on a stream."""
    mapping = {
        "bay_id": ("kerbsideid", "int"),
        "status": "status_description",
        "zone_number": ("zone_number", "int"),
        "location": "location",
        "event_time": ("status_timestamp", "timestamp"),
    }
    return silver_rows(bronze, mapping, {"location": LOCATION}).select(
        "bay_id", "status", "zone_number", "lat", "lon", "event_time"
    )


def silver_bays(bronze: DataFrame) -> DataFrame:
    """Latest row per bay; rows without a readable bay number are dropped."""
    typed = project(
        bronze,
        {
            "bay_id": ("kerbsideid", "int"),
            "latitude": ("latitude", "double"),
            "longitude": ("longitude", "double"),
            "description": "roadsegmentdescription",
            "last_updated": ("lastupdated", "timestamp"),
        },
    )
    ties = ["description", "latitude", "longitude"]
    return latest_by(require(typed, ["bay_id"]), ["bay_id"], ["last_updated"], ties)


def silver_meters(bronze: DataFrame) -> DataFrame:
    """Last ingested row per meter, payment options as booleans."""
    typed = project(
        bronze,
        {
            "meter_id": "meter_id",
            "asset_id": ("asset_id", "int"),
            "has_credit_card": flag("creditcard"),
            "has_tap_and_go": flag("tapandgo"),
            "latitude": ("latitude", "double"),
            "longitude": ("longitude", "double"),
            "description": "location_description",
            "ingested_at": "ingested_at",
        },
    )
    rows = require(typed, ["meter_id"])
    ties = [c for c in rows.columns if c not in ("meter_id", "ingested_at")]
    return latest_by(rows, ["meter_id"], ["ingested_at"], ties).drop("ingested_at")


def silver_zones(bronze: DataFrame) -> DataFrame:
    """Last ingested row per zone, days and start time; missing days form one group."""
    typed = project(
        bronze,
        {
            "zone_number": ("parkingzone", "int"),
            "restriction_days": "restriction_days",
            "restriction_display": "restriction_display",
            "start_time": "time_restrictions_start",
            "end_time": "time_restrictions_finish",
            "ingested_at": "ingested_at",
        },
    )
    keys = ["zone_number", "restriction_days", "start_time"]
    ties = ["restriction_display", "end_time"]
    rows = latest_by(require(typed, ["zone_number"]), keys, ["ingested_at"], ties)
    return rows.drop("ingested_at")


def silver_restrictions(bronze: DataFrame) -> DataFrame:
    """One row per filled rule slot of a bay."""
    fields = {
        "description": ("description", "string"),
        "duration": ("duration", "int"),
        "start_time": ("starttime", "string"),
        "end_time": ("endtime", "string"),
        "day_range": ("fromday", "string"),
        "on_public_hols": ("effectiveonph", "string"),
        "type_desc": ("typedesc", "string"),
    }
    bays = bronze.withColumn("bay_id", F.col("bayid").try_cast("int"))
    return unpivot_slots(
        bays, ["bay_id", "ingested_at"], fields, RULE_SLOTS, "rule_number", keep_if="description"
    )


SILVER = {
    "parking_bays": silver_bays,
    "parking_meters": silver_meters,
    "parking_zones_plates": silver_zones,
    "parking_restrictions": silver_restrictions,
}


# --- gold ----------------------------------------------------------------------------


def dim_bays(bays: DataFrame, load_ts: Column | None = None) -> DataFrame:
    names = {
        "bay_id": "bay_id",
        "bay_description": "description",
        "latitude": "latitude",
        "longitude": "longitude",
    }
    return marts.dimension(bays, names, load_ts=load_ts)


def dim_meters(meters: DataFrame, load_ts: Column | None = None) -> DataFrame:
    names = {
        "meter_id": "meter_id",
        "asset_id": "asset_id",
        "has_credit_card": "has_credit_card",
        "has_tap_and_go": "has_tap_and_go",
        "meter_description": "description",
        "latitude": "latitude",
        "longitude": "longitude",
    }
    return marts.dimension(meters, names, load_ts=load_ts)


def dim_restrictions(restrictions: DataFrame, load_ts: Column | None = None) -> DataFrame:
    same = ("start_time", "end_time", "day_range", "on_public_hols", "type_desc")
    names = {
        "bay_id": "bay_id",
        "rule_number": "rule_number",
        "rule_description": "description",
        "max_minutes": "duration",
        **{c: c for c in same},
    }
    return marts.dimension(
        restrictions, names, "restriction_key", ["bay_id", "rule_number"], load_ts
    )


def dim_zones(zones: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """One row per zone, with all its restriction signs in one text."""
    signs = F.array_join(F.array_sort(F.collect_set("restriction_display")), ", ")
    rows = zones.groupBy("zone_number").agg(signs.alias("zone_restrictions"))
    names = {"zone_number": "zone_number", "zone_restrictions": "zone_restrictions"}
    return marts.dimension(rows, names, load_ts=load_ts)


def fact_sessions(
    sensors: DataFrame, load_ts: Column | None = None, zone: bool = False
) -> DataFrame:
    """Completed stays, with the zone at arrival if asked for. Daily exports repeat readings,
    so exact repeats go first."""
    zones = ["zone_number"] if zone else []
    readings = distinct_rows(sensors.select("bay_id", "status", "event_time", *zones))
    fact = state_sessions(
        readings, "bay_id", "status", "event_time", OCCUPIED, FREE,
        tie_break=["status", *zones], carry=zones,
    )
    return fact.withColumn("load_timestamp", load_ts) if load_ts is not None else fact


def report(
    fact: DataFrame, bays: DataFrame, weekend: bool = False, zones: DataFrame | None = None
) -> DataFrame:
    """The wide report over ``fact_sessions`` and ``dim_bays``, and ``dim_zones`` if given."""
    dims = [(bays.select("bay_id", "bay_description", "latitude", "longitude"), ["bay_id"])]
    if zones is not None:
        dims.append((zones.select("zone_number", "zone_restrictions"), ["zone_number"]))
    wide = marts.session_report(
        fact.drop("load_timestamp"), dims, ts_type="timestamp", weekend=weekend
    )
    first = ["session_id", "arrival_time", "departure_time", DURATION]
    return wide.select(*first, *(c for c in wide.columns if c not in (*first, "bay_id")))


METER_CHECKS = ["has_credit_card", "has_tap_and_go", "asset_id"]


def snapshot_meters(hist: DataFrame | None, meters: DataFrame, as_of: str) -> DataFrame:
    """Meter history after one more snapshot."""
    if hist is None:
        return history.start_history(meters, as_of, "timestamp")
    return history.scd2_apply(hist, meters, ["meter_id"], METER_CHECKS, as_of)


def snapshot_bays(hist: DataFrame | None, bays: DataFrame, as_of: str) -> DataFrame:
    """Bay history after one more snapshot."""
    rows = bays.select("bay_id", "description", "latitude", "longitude")
    if hist is None:
        return history.start_history(rows, as_of, "timestamp")
    return history.scd2_apply(
        hist, rows, ["bay_id"], ["description", "latitude", "longitude"], as_of
    )


def quality_reports(fact: DataFrame, bays: DataFrame) -> DataFrame:
    """All checks of the gold layer as one table."""
    of_fact = quality.report(
        fact,
        unique_cols=["session_id"],
        not_null_cols=["session_id"],
        expressions={"duration_not_negative": f"{DURATION} >= 0"},
        max_values={DURATION: LONGEST_STAY_MINUTES},
        references=[("bay_id", bays, "bay_id")],
    )
    of_bays = quality.report(bays, unique_cols=["bay_id"], not_null_cols=["bay_id", "latitude"])
    return of_fact.select(F.lit("fact_parking_sessions").alias("model"), "*").unionByName(
        of_bays.select(F.lit("dim_bays").alias("model"), "*")
    )
