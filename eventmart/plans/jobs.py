"""Jobs: functions over a session and locations that run to completion."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import runtime
from eventmart.operators import kpi
from eventmart.operators.clean import stamp
from eventmart.operators.dedup import distinct_rows
from eventmart.operators.reshape import stringify_nested
from eventmart.plans import parking
from eventmart.sources import files, ledger, sinks
from eventmart.streaming import io, layers


def landed_rows(raw: DataFrame, ts: datetime | None = None) -> DataFrame:
    """Exact repeats dropped, nested columns as JSON text, load time added."""
    return stamp(distinct_rows(stringify_nested(raw)), "_ingested_at", ts)


def load_export(
    spark: SparkSession,
    raw_dir: str,
    prefix: str,
    archive: str,
    jdbc: Callable[[DataFrame, str, str], None] | None = None,
    partition_by: Sequence[str] = (),
    ts: datetime | None = None,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    keep_all: bool | None = None,
    consumed_dir: str | None = None,
) -> None:
    """Land one export: parquet under ``<archive>/<prefix>`` and, if given, a database table.

    Event exports (``keep_all``, by default the preset's) land each file once, however often
    the job runs: a ledger at ``<archive>/<prefix>__loads`` remembers them, and each load has
    a folder ``load=<id>`` of its own, which a load that is done again replaces. Reference
    exports replace the table by the last one. Without any file nothing is written.
    ``consumed_dir`` takes the files that have been read, over those of the same name.

    All columns are kept: those that ``schema`` (by default the preset's) does not declare
    arrive as text, and records that cannot be read as text in ``_corrupt_record``.
    ``jdbc(df, table, mode)`` does the database write, for instance a closure over
    ``sinks.write_jdbc``; rows of a load carry its id as ``_load_id``, by which a load that
    is done again can be told from the first try.
    """
    if keep_all is None:
        keep_all = prefix in parking.HISTORY_EXPORTS
    landed, table = f"{archive}/{prefix}", f"raw_{prefix}"

    def rows_of(mode: str, paths: list[str] | None = None) -> DataFrame:
        raw = files.read_json_snapshots(
            spark,
            raw_dir,
            prefix,
            schema or parking.RAW[prefix],
            mode,
            multi_line,
            unknown=True,
            rescue=layers.RESCUE,
            paths=paths,
        )
        return landed_rows(raw, ts)

    def write(rows: DataFrame, path: str, to_database: Callable[[DataFrame], None]) -> None:
        def to_archive(df: DataFrame) -> None:
            sinks.write_parquet(df, path, "overwrite", partition_by)

        if jdbc is None:
            to_archive(rows)
        else:
            sinks.dual_write(rows, to_database, to_archive)

    seen = [r["path"] for r in files.exports(spark, raw_dir, prefix).collect()]
    if keep_all:
        loads = f"{landed}__loads"
        if seen:
            ledger.plan(spark.createDataFrame([(p,) for p in seen], "path string"), loads)
        for load, paths in ledger.waiting(spark, loads, landed).items():
            write(
                rows_of("history", paths),
                f"{landed}/load={load}",
                lambda df, load=load: jdbc(df.withColumn("_load_id", F.lit(load)), table, "append"),
            )
    elif seen:
        # nothing came otherwise; a reference table keeps its rows
        write(rows_of("snapshot"), landed, lambda df: jdbc(df, table, "overwrite"))
    if consumed_dir:
        for path in seen:
            runtime.move(spark, path, consumed_dir)


def load_new_exports(
    spark: SparkSession,
    raw_dir: str,
    prefix: str,
    archive: str,
    checkpoint: str,
    consumed_dir: str | None = None,
    jdbc: Callable[[DataFrame, str, str], None] | None = None,
) -> None:
    """``load_export`` for event exports that remembers which files it has read.

    Each batch of new files goes to its own ``load=<stream>-<number>`` folder, so a batch that
    is repeated after a failure replaces itself, and a stream with a new checkpoint, which
    counts from 0 again, replaces nothing of an earlier one. ``consumed_dir`` moves read files away.
    """
    if files.latest_snapshot(spark, raw_dir, prefix) is None:
        return
    every = f"{raw_dir}/{files.snapshot_glob(prefix)}"
    separator = files.file_separator(spark, every)
    raw = io.read_json_stream(
        spark,
        raw_dir,
        files.with_unknown(spark, every, parking.RAW[prefix]),
        archive_dir=consumed_dir,
        multi_line=separator is None,
        glob=files.snapshot_glob(prefix),
        rescue=layers.RESCUE,
        separator=separator,
    )

    def land(batch: DataFrame, number: int) -> None:
        # the id of the stream lives in its checkpoint
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")

        def to_archive(df: DataFrame) -> None:
            sinks.write_parquet(df, f"{archive}/{prefix}/load={stream}-{number}", "overwrite")

        def to_database(df: DataFrame) -> None:
            # a batch that is repeated carries the same id as the first try
            jdbc(df.withColumn("_load_id", F.lit(f"{stream}-{number}")), f"raw_{prefix}", "append")

        if jdbc is None:
            to_archive(landed_rows(batch))
        else:
            sinks.dual_write(landed_rows(batch), to_database, to_archive)

    writer = raw.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    io.drain(writer.trigger(availableNow=True).start())


def upsert_export(
    spark: SparkSession, raw_dir: str, prefix: str, table: str, keys: Sequence[str]
) -> None:
    """Keyed replacement of a table by the last file of an export; creates it on first use.
    Without any file nothing is written. Columns as in ``load_export``: undeclared ones arrive
    as text and are added to the table; records that cannot be read have no key, so they
    replace nothing and stay as text in ``_corrupt_record``."""
    if files.latest_snapshot(spark, raw_dir, prefix) is None:
        return
    raw = files.read_json_snapshots(
        spark, raw_dir, prefix, parking.RAW[prefix], "snapshot", unknown=True, rescue=layers.RESCUE
    )
    sinks.upsert_table(stamp(stringify_nested(raw)), table, keys)


def ingest_reference(
    spark: SparkSession, source: str, table: str, ts: datetime | None = None
) -> None:
    """Landed parquet to a bronze table."""
    sinks.overwrite_table(stamp(files.read_parquet(spark, source), ts=ts), table)


def stream_sensors(
    spark: SparkSession, source: str, bronze: str, silver: str, checkpoints: str, **options
) -> None:
    """Change events to bronze and on to silver; a rerun handles only new files."""
    io.drain(
        layers.bronze_stream(
            spark, source, parking.SENSOR_IMAGE, bronze, f"{checkpoints}/bronze", **options
        )
    )
    stream = io.read_table_stream(spark, bronze)
    io.drain(
        layers.silver_stream(stream, silver, f"{checkpoints}/silver", parking.silver_sensors)
    )


def build_silver(spark: SparkSession, bronze_db: str, silver_db: str) -> None:
    """Reference tables of bronze, cleaned, into silver."""
    sinks.ensure_database(spark, silver_db)
    for name, clean in parking.SILVER.items():
        sinks.overwrite_table(clean(spark.table(f"{bronze_db}.{name}")), f"{silver_db}.{name}")


def build_gold(
    spark: SparkSession, silver_db: str, gold_db: str, load_ts: datetime | None = None
) -> None:
    """Dimensions, fact and report as tables. The report reads the written fact, so the
    session window runs once per build and not with every read."""
    sinks.ensure_database(spark, gold_db)
    now = F.current_timestamp() if load_ts is None else F.lit(load_ts)
    silver: Mapping[str, DataFrame] = {
        n: spark.table(f"{silver_db}.{n}") for n in ("parking_sensors", *parking.SILVER)
    }
    models = {
        "dim_bays": parking.dim_bays(silver["parking_bays"], now),
        "dim_meters": parking.dim_meters(silver["parking_meters"], now),
        "dim_restrictions": parking.dim_restrictions(silver["parking_restrictions"], now),
        "dim_zones": parking.dim_zones(silver["parking_zones_plates"], now),
        "fact_parking_sessions": parking.fact_sessions(silver["parking_sensors"], now, zone=True),
    }
    for name, df in models.items():
        sinks.overwrite_table(df, f"{gold_db}.{name}")
    fact, bays, zones = (
        spark.table(f"{gold_db}.{n}") for n in ("fact_parking_sessions", "dim_bays", "dim_zones")
    )
    sinks.overwrite_table(parking.report(fact, bays, zones=zones), f"{gold_db}.rpt_parking_master")


def run_checks(spark: SparkSession, gold_db: str, table: str = "quality_report") -> None:
    """All checks of the gold layer into a table, one row each."""
    fact, bays = spark.table(f"{gold_db}.fact_parking_sessions"), spark.table(f"{gold_db}.dim_bays")
    sinks.overwrite_table(parking.quality_reports(fact, bays), f"{gold_db}.{table}")


def build_indicators(spark: SparkSession, gold_db: str) -> None:
    """Indicators over the written fact, dimensions and report, one table each."""
    fact = spark.table(f"{gold_db}.fact_parking_sessions")
    report = spark.table(f"{gold_db}.rpt_parking_master")
    rules = spark.table(f"{gold_db}.dim_restrictions")
    fields = {**kpi.RULE_FIELDS, "max_minutes": "max_minutes", "type": "type_desc"}
    arrival, departure = "arrival_time", "departure_time"
    daily = kpi.period_totals(fact, arrival, "day")
    ruled = kpi.rule_in_force(fact, rules, "bay_id", arrival, fields=fields)
    along = kpi.rules_along_stay(fact, rules, "bay_id", arrival, departure, fields=fields)
    indicators = {
        "kpi_daily": kpi.variance(daily, "period", "total_value"),
        "kpi_occupancy": kpi.occupancy_over_time(fact, arrival, departure),
        "kpi_zone_occupancy": kpi.occupancy_over_time(
            fact, arrival, departure, keys=["zone_number"]
        ),
        "kpi_peak_hours": kpi.peak_hours(fact, arrival),
        "kpi_turnover": kpi.turnover(fact, "bay_id", arrival),
        "kpi_stay_shares": kpi.stay_shares(report),
        "kpi_overstays": kpi.overstays(ruled),
        "kpi_minutes_by_rule": kpi.minutes_along_stay(along),
    }
    for name, df in indicators.items():
        sinks.overwrite_table(df, f"{gold_db}.{name}")


def snapshot_dimensions(
    spark: SparkSession, silver_db: str, history_db: str, as_of: str
) -> None:
    """One more snapshot into the histories of meters and bays."""
    sinks.ensure_database(spark, history_db)
    steps = {"meters": parking.snapshot_meters, "bays": parking.snapshot_bays}
    for name, step in steps.items():
        incoming = spark.table(f"{silver_db}.parking_{name}")
        snapshot_history(spark, f"{history_db}.{name}_history", incoming, step, as_of)


def snapshot_history(
    spark: SparkSession,
    table: str,
    incoming: DataFrame,
    step: Callable[[DataFrame | None, DataFrame, str], DataFrame],
    as_of: str,
) -> None:
    """Apply one snapshot to a history table, e.g. with ``parking.snapshot_meters``."""
    if spark.catalog.tableExists(table):
        sinks.swap_table(step(spark.table(table), incoming, as_of), table)
    else:
        sinks.overwrite_table(step(None, incoming, as_of), table)
