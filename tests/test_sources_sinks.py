import json
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import runtime
from eventmart.sources import files, sinks

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


@pytest.fixture
def exports(tmp_path):
    for stamp, rows in (("20240101_000000", [1]), ("20240102_000000", [1, 2]), ("20231231_235959", [9])):
        body = [{"id": i, "v": stamp[:8]} for i in rows]
        (tmp_path / f"bays_{stamp}.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "bays_zones_20250101_000000.json").write_text('[{"id": 77}]')
    (tmp_path / "bays_20250101_000000.txt").write_text("no")
    return str(tmp_path)


def test_history_reads_all_and_snapshot_the_last(spark, exports, same):
    every = files.read_json_snapshots(spark, exports, "bays", SCHEMA)
    same(every, (9, "20231231"), (1, "20240101"), (1, "20240102"), (2, "20240102"))
    last = files.read_json_snapshots(spark, exports, "bays", SCHEMA, "snapshot")
    same(last, (1, "20240102"), (2, "20240102"))
    assert files.read_json_snapshots(spark, exports, "none", SCHEMA, "snapshot").isEmpty()
    assert files.read_json_snapshots(spark, exports, "none", SCHEMA).isEmpty()
    with pytest.raises(ValueError):
        files.read_json_snapshots(spark, exports, "bays", SCHEMA, "other")


def test_infer_schema(spark, exports):
    assert files.infer_schema(spark, f"{exports}/bays_2024*.json").fieldNames() == ["id", "v"]


def test_overwrite_replaces_rows_and_schema(spark, table, same):
    sinks.ensure_database(spark, "s1")
    sinks.overwrite_table(table("a int", (1,)), "s1.t")
    sinks.overwrite_table(table("b string, a int", ("x", 2)), "s1.t")
    assert spark.table("s1.t").columns == ["b", "a"]
    sinks.overwrite_table(table("a int", (3,)), "s1.t", replace_schema=False)
    same(files.read_table(spark, "s1.t"), (None, 3))
    with pytest.raises(ValueError):
        sinks.overwrite_table(table("z int", (3,)), "s1.t", replace_schema=False)


def test_append_adds_new_columns(spark, table, same):
    sinks.ensure_database(spark, "s2")
    sinks.append_table(table("a int", (1,)), "s2.t")
    sinks.append_table(table("c string, a int", ("x", 2)), "s2.t")
    sinks.append_table(table("a int", (3,)), "s2.t")
    same(spark.table("s2.t").select("a", "c"), (1, None), (2, "x"), (3, None))


def test_upsert_creates_then_replaces(spark, table, same):
    sinks.ensure_database(spark, "s3")
    sinks.upsert_table(table("k string, v int", ("a", 1), ("b", 1), (None, 1)), "s3.t", ["k"])
    sinks.upsert_table(table("k string, v int", ("b", 2), ("b", 3), (None, 2)), "s3.t", ["k"])
    same(spark.table("s3.t"), ("a", 1), (None, 1), ("b", 2), ("b", 3), (None, 2))
    assert not spark.catalog.tableExists("s3.t__next")


def test_jdbc_write_limits_connections_and_passes_options(table, monkeypatch):
    """The call that reaches Spark's writer; no database is involved."""
    calls = []

    def jdbc(self, url, table, mode=None, properties=None):
        calls.append((self._df.rdd.getNumPartitions(), url, table, mode, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    df = table("a int", *[(i,) for i in range(20)]).repartition(8)
    sinks.write_jdbc(df, "jdbc:x", "raw_t", "overwrite", 2, {"user": "u"})
    assert calls == [(2, "jdbc:x", "raw_t", "overwrite", {"user": "u"})]


def test_dual_write_computes_once_and_releases(spark, tmp_path, table):
    counted = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            counted.add(len(batch))
            yield batch

    df = table("a int, d string", (1, "x"), (2, "y")).mapInPandas(tally, "a int, d string")
    sinks.dual_write(
        df,
        lambda d: sinks.write_parquet(d, f"{tmp_path}/one"),
        lambda d: sinks.write_parquet(d, f"{tmp_path}/two", partition_by=["d"]),
    )
    assert counted.value == 2
    assert files.read_parquet(spark, f"{tmp_path}/one").count() == 2
    assert (tmp_path / "two" / "d=x").is_dir()
    assert df.storageLevel.useDisk is False


def test_read_parquet_merges_schemas(spark, tmp_path, table, same):
    path = f"{tmp_path}/p"
    sinks.write_parquet(table("a int", (1,)), path)
    sinks.write_parquet(table("a int, b int", (2, 3)), path)
    same(files.read_parquet(spark, path, merge_schema=True), (1, None), (2, 3))


def test_json_keeps_microseconds(spark, tmp_path):
    moment = datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(moment,)], "t timestamp")
    path = f"{tmp_path}/j"
    df.write.options(**files.JSON_TIMES).json(path)
    back = spark.read.schema(df.schema).options(**files.JSON_TIMES).json(path)
    assert back.first()["t"] == moment


def test_workspace_follows_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = runtime.workspace(spark, "x"), runtime.workspace(spark, "x")
    assert one != two
    assert root is None or one.startswith(root)


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), runtime.settings(spark, **{"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_exact_frames_stay_lazy(spark, table):
    """Building an operator runs no job."""
    from eventmart.operators.sessions import state_sessions

    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    df = table("b int, s string, t timestamp_ntz, i int").withColumn("x", F.lit(1))
    state_sessions(df, "b", "s", "t", "P", "U", ["i"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before
