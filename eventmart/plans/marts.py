"""Dimensions, fact and wide report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.keys import surrogate_key
from eventmart.functions.time import bucket, is_weekend, trunc_ts

# Upper edges in minutes and labels of the stay categories.
STAY_EDGES = ((15, "Short Stay"), (60, "Medium Stay"))
STAY_LAST = "Long Stay"


def dimension(
    df: DataFrame,
    columns: Mapping[str, str],
    key_name: str | None = None,
    key_cols: Sequence[str] = (),
    load_ts: Column | None = None,
    load_name: str = "load_timestamp",
) -> DataFrame:
    """Renamed columns, optionally behind a surrogate key and before a load time.

    ``columns`` maps output to source names; the load time is left out when ``load_ts``
    is None.
    """
    key = [surrogate_key(*key_cols).alias(key_name)] if key_name else []
    load = [load_ts.alias(load_name)] if load_ts is not None else []
    return df.select(*key, *(F.col(src).alias(out) for out, src in columns.items()), *load)


def widen(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str] | Sequence[str]]]
) -> DataFrame:
    """Left join a fact to dimensions; every fact row stays.

    Each dimension comes with its join columns: names common to both sides, or a mapping
    of fact column to dimension column. No broadcast is forced: Spark broadcasts a
    dimension measured below ``autoBroadcastJoinThreshold`` and otherwise sorts and merges,
    splitting fact partitions that a hot key made too large.
    """
    for dim, on in dims:
        pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
        renamed = dim.withColumnsRenamed({d: f"__dim_{d}" for d in pairs.values()})
        match = [F.col(f) == F.col(f"__dim_{d}") for f, d in pairs.items()]
        fact = fact.join(renamed, match, "left").drop(*(f"__dim_{d}" for d in pairs.values()))
    return fact


def session_report(
    sessions: DataFrame,
    dims: Sequence[tuple[DataFrame, Mapping[str, str] | Sequence[str]]],
    arrival: str = "arrival_time",
    duration: str = "duration_minutes",
    ts_type: str = "timestamp_ntz",
    weekend: bool = False,
) -> DataFrame:
    """The wide report: sessions with dimension columns, arrival hour and stay category."""
    wide = widen(sessions, dims).withColumns(
        {
            "arrival_hour": trunc_ts("hour", arrival, ts_type),
            "stay_category": bucket(duration, STAY_EDGES, STAY_LAST),
        }
    )
    return wide.withColumn("is_weekend_arrival", is_weekend(arrival)) if weekend else wide


def enrich_zone(
    df: DataFrame, zones: DataFrame, zone: str, zone_key: str | None = None
) -> DataFrame:
    """Left join zone attributes on the zone number."""
    return widen(df, [(zones, {zone: zone_key or zone})])


def report_slice(report: DataFrame, **equals) -> DataFrame:
    """Rows of a report with the given column values, e.g. ``stay_category="Long Stay"``."""
    for name, value in equals.items():
        report = report.filter(F.col(name) == F.lit(value))
    return report
