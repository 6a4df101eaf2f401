"""Table sinks on partitioned tables, and loads that must not lose rows."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventmart.plans import jobs
from eventmart.sources import sinks


@pytest.fixture
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks_db")
    yield "sinks_db"
    spark.sql("DROP DATABASE sinks_db CASCADE")


def _parts(spark, name):
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def test_append_and_upsert_keep_partitions(spark, db, table, same):
    name = f"{db}.t"
    sinks.overwrite_table(table("k int, v string, d string", (1, "a", "x")), name, partition_by=["d"])
    sinks.append_table(table("d string, k int, w int", ("y", 2, 5)), name)
    assert _parts(spark, name) == ["d"]
    got = spark.table(name).select("k", "v", "w", "d")
    same(got, (1, "a", None, "x"), (2, None, 5, "y"))
    batch = table("k int, v string, w int, d string", (2, "b", 6, "z"), (3, "c", 7, "x"))
    sinks.upsert_table(batch, name, ["k"])
    assert _parts(spark, name) == ["d"]
    got = spark.table(name).select("k", "v", "w", "d")
    same(got, (1, "a", None, "x"), (2, "b", 6, "z"), (3, "c", 7, "x"))


def _meters(folder: Path, stamp: str, *ids: str) -> None:
    folder.mkdir(exist_ok=True)
    rows = [{"meter_id": i, "asset_id": "1"} for i in ids]
    (folder / f"parking_meters_{stamp}.json").write_text(json.dumps(rows))


def test_an_empty_folder_leaves_a_reference_table(spark, tmp_path):
    raw, archive = tmp_path / "raw", str(tmp_path / "archive")
    _meters(raw, "20240101_000000", "m1")
    jobs.load_export(spark, str(raw), "parking_meters", archive)
    empty = tmp_path / "empty"
    empty.mkdir()
    jobs.load_export(spark, str(empty), "parking_meters", archive)
    assert spark.read.parquet(f"{archive}/parking_meters").count() == 1


def test_upsert_takes_the_last_file(spark, db, tmp_path):
    raw = tmp_path / "raw"
    _meters(raw, "20240101_000000", "m1", "m2")
    _meters(raw, "20240102_000000", "m2", "m3")
    jobs.upsert_export(spark, str(raw), "parking_meters", f"{db}.meters", ["meter_id"])
    assert sorted(r.meter_id for r in spark.table(f"{db}.meters").collect()) == ["m2", "m3"]


def test_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    raw, archive = tmp_path / "raw", str(tmp_path / "archive")
    raw.mkdir()
    row = [{"kerbsideid": 1, "status_description": "Present", "status_timestamp": "2024-01-06"}]
    (raw / "parking_sensors_20240101_000000.json").write_text(json.dumps(row))
    for n in ("one", "two"):
        jobs.load_new_exports(
            spark, str(raw), "parking_sensors", archive, str(tmp_path / f"checkpoint-{n}")
        )
    assert spark.read.parquet(f"{archive}/parking_sensors").count() == 2
    assert len([p for p in (tmp_path / "archive/parking_sensors").iterdir() if p.is_dir()]) == 2


def _failing(df):
    """``df`` with a last row that cannot be written."""
    return df.withColumn("v", F.when(F.col("k") == 9, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))


@pytest.mark.parametrize("parts", [[], ["d"]])
def test_a_write_that_fails_leaves_all_rows(spark, db, table, same, parts):
    name = f"{db}.kept"
    ddl = "k int, v string, d string"
    before = [(1, "a", "x"), (2, "b", "y")]
    sinks.overwrite_table(table(ddl, *before), name, partition_by=parts)
    for write in (sinks.swap_table, lambda df, t: sinks.upsert_table(df, t, ["k"])):
        with pytest.raises(Exception, match="stop"):
            write(_failing(table(ddl, (1, "new", "x"), (9, "c", "x"))), name)
        same(spark.table(name).select("k", "v", "d"), *before)


@pytest.mark.parametrize("parts", [[], ["d"]])
def test_swap_reads_its_own_table_and_adds_columns(spark, db, table, same, parts):
    name = f"{db}.swapped"
    rows = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]
    sinks.overwrite_table(table("k int, v string, d string", *rows), name, partition_by=parts)
    for n in range(2):
        sinks.swap_table(spark.table(name).filter(F.col("k") != n + 1), name)
    same(spark.table(name).select("k", "v", "d"), rows[2])
    assert _parts(spark, name) == parts
    more = spark.table(name).withColumn("w", F.lit(5)).select("k", "v", "w", "d")
    sinks.swap_table(more, name)
    same(spark.table(name).select("k", "v", "d", "w"), (*rows[2], 5))
    sinks.swap_table(spark.table(name).drop("v"), name)
    same(spark.table(name).select("k", "d", "w"), (3, "z", 5))
    assert _parts(spark, name) == parts
    spark.sql(f"DROP TABLE {name}")
    sinks.overwrite_table(table("k int, v string, d string", *rows), name, partition_by=parts)
    assert spark.table(name).count() == 3


def test_upsert_writes_only_the_partitions_it_touches(spark, db, table, same, tmp_path):
    name = f"{db}.touched"
    rows = [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "z")]
    sinks.overwrite_table(table("k int, v string, d string", *rows), name, partition_by=["d"])
    files = {r.d: f for r, f in (
        (r, r.f) for r in spark.table(name).select("d", F.input_file_name().alias("f")).collect()
    )}
    sinks.upsert_table(table("k int, v string, d string", (2, "new", "x"), (3, "c2", None)), name, ["k"])
    got = spark.table(name).select("k", "v", "d", F.input_file_name().alias("f"))
    same(got.drop("f"), (1, "a", "x"), (2, "new", "x"), (3, "c2", None), (4, "d", "z"))
    assert {r.f for r in got.filter("d = 'z'").collect()} == {files["z"]}


def test_a_replacement_that_stopped_before_its_last_step_is_finished(spark, db, table, same):
    sinks.overwrite_table(table("k int, v string", (1, "a")), f"{db}.stopped__next")
    sinks.upsert_table(table("k int, v string", (2, "b")), f"{db}.stopped", ["k"])
    same(spark.table(f"{db}.stopped"), (1, "a"), (2, "b"))
