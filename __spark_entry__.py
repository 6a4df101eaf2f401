"""

Each query is registered together with the SQL that must give the same rows. Both sides
cast counts and sums to bigint or double and take decimal sums, so that neither result
depends on the order of rows.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The package lies next to this file, which may be loaded by path from another folder.
if (_HERE := str(Path(__file__).resolve().parent)) not in sys.path:
    sys.path.insert(0, _HERE)

from eventmart import runtime
from eventmart.functions import code, flag
from eventmart.operators import cdc, clean, dedup, history, kpi, merge, quality, reshape
from eventmart.operators.sessions import state_sessions
from eventmart.plans import jobs, marts
from eventmart.sources import files, sinks
from eventmart.streaming import io, layers, windows
from eventmart.streaming import sessions as stream_sessions

# The corpus operators and their pipeline can be left out as a whole.
try:
    import corpus_pipeline
    from eventmart.llm import queries as _LLM
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "eventmart.llm"):
        raise
    _LLM = None

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name or fn.__name__] = fn
        _SQL[name or fn.__name__] = sql
        return fn

    return register


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def entry(spark: SparkSession) -> DataFrame:
    return _QUERIES["state_sessions"](spark, "/root/testdata/sf0.001")


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return _QUERIES | (_LLM.QUERIES if _LLM else {}) | ({"pipeline": _pipeline} if _LLM else {})


def oracle_sql() -> dict[str, str]:
    return _SQL | (_LLM.SQL if _LLM else {})


# --- sessions and the wide report -----------------------------------------------------

_SESSIONS = """
sessions AS (
  SELECT md5(CAST(user_id AS VARCHAR) || '-' || CAST(ts AS VARCHAR)) AS session_id,
         user_id, ts AS arrival_time, next_ts AS departure_time,
         round(date_diff('microsecond', ts, next_ts) / 6e7, 2) AS duration_minutes
  FROM (SELECT user_id, event_type, ts,
               lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
        FROM events)
  WHERE event_type = 'view' AND next_type = 'purchase'
)"""


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    return state_sessions(events, "user_id", "event_type", "ts", "view", "purchase", ["event_id"])


@_query(f"WITH {_SESSIONS} SELECT * FROM sessions", "state_sessions")
def flagship(spark, sf_dir):
    return _sessions(spark, sf_dir)

_REPORT = f"""{_SESSIONS},
report AS (
  SELECT s.session_id, s.user_id, s.arrival_time, s.departure_time, s.duration_minutes,
         c.c_name, c.c_mktsegment,
         date_trunc('hour', s.arrival_time) AS arrival_hour,
         CASE WHEN s.duration_minutes < 15 THEN 'Short Stay'
              WHEN s.duration_minutes < 60 THEN 'Medium Stay'
              ELSE 'Long Stay' END AS stay_category,
         dayofweek(s.arrival_time) IN (0, 6) AS is_weekend_arrival
  FROM sessions s LEFT JOIN customer c ON s.user_id = c.c_custkey
)"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    dims = [(customers, {"user_id": "c_custkey"})]
    return marts.session_report(_sessions(spark, sf_dir), dims, weekend=True)


@_query(f"WITH {_REPORT} SELECT * FROM report")
def session_report(spark, sf_dir):
    return _report(spark, sf_dir)


@_query(
    f"WITH {_REPORT} SELECT * FROM report"
    " WHERE stay_category = 'Long Stay' AND c_mktsegment = 'BUILDING'"
)
def report_slice(spark, sf_dir):
    report = _report(spark, sf_dir)
    return marts.report_slice(report, stay_category="Long Stay", c_mktsegment="BUILDING")


# --- latest rows, duplicates, distinct ------------------------------------------------


@_query("""
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
  FROM orders)
WHERE place = 1""")
def latest_per_key(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    return dedup.latest_by(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])


_LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


@_query(f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, {", ".join(f"{c} DESC" for c in _LINE_REST)}) AS place
  FROM lineitem)
WHERE place = 1""")
def latest_composite_key(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    return dedup.latest_by(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], _LINE_REST)


@_query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("""
SELECT * FROM lineitem WHERE (l_orderkey, l_linenumber) IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS unique_ids FROM orders")
def profile_counts(spark, sf_dir):
    return quality.profile(_read(spark, sf_dir, "orders"), ["o_custkey"])


@_query("SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def distinct_rows(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    return dedup.distinct_rows(lines.select("l_returnflag", "l_linestatus", "l_shipdate"))


# --- typing, reshaping, change events --------------------------------------------------


@_query("""
SELECT p_partkey, 1 AS slot, p_brand AS description FROM part
UNION ALL SELECT p_partkey, 2, p_type FROM part
UNION ALL SELECT p_partkey, 3, p_name FROM part""")
def unpivot_slots(spark, sf_dir):
    fields = {"description": (["p_brand", "p_type", "p_name"], "string")}
    part = _read(spark, sf_dir, "part")
    return reshape.unpivot_slots(part, ["p_partkey"], fields, 3, keep_if="description")


@_query("""
SELECT * FROM (
  SELECT p_partkey, 1 AS slot, CASE WHEN p_size > 25 THEN p_brand END AS description,
         CAST(p_size AS VARCHAR) AS size FROM part
  UNION ALL SELECT p_partkey, 2, CASE WHEN p_size < 40 THEN p_type END, NULL FROM part)
WHERE description IS NOT NULL""")
def unpivot_null_slots(spark, sf_dir):
    """Slots without a description go, whatever their other fields hold."""
    part = _read(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_brand")).alias("description1"),
        F.when(F.col("p_size") < 40, F.col("p_type")).alias("description2"),
        F.col("p_size").alias("size1"),
    )
    fields = {"description": ("description", "string"), "size": ("size", "string")}
    return reshape.unpivot_slots(part, ["p_partkey"], fields, 3, keep_if="description")


@_query("SELECT event_id, user_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events")
def expand_json(spark, sf_dir):
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "props")
    return reshape.expand_json(events, "props", "k INT")


@_query("SELECT event_id, event_type, value, user_id FROM events")
def stringify_nested(spark, sf_dir):
    nested = _read(spark, sf_dir, "events").select(
        "event_id",
        F.struct("event_type", "value", F.array("user_id").alias("users")).alias("detail"),
    )
    text = reshape.stringify_nested(nested)
    fields = "event_type STRING, value DOUBLE, users ARRAY<BIGINT>"
    return reshape.expand_json(text, "detail", fields).select(
        "event_id", "event_type", "value", F.get("users", F.lit(0)).alias("user_id")
    )


def _envelopes(events: DataFrame) -> DataFrame:
    """Change events over the events table: signups insert, errors delete, others update."""
    image = F.struct(
        "event_id", "user_id", "event_type", F.col("ts").cast("string").alias("ts"), "props"
    )
    deleted = F.col("event_type") == "error"
    return events.select(
        F.when(F.col("event_type") != "signup", image).alias("before"),
        F.when(~deleted, image).alias("after"),
        F.when(deleted, "d")
        .when(F.col("event_type") == "signup", "c")
        .otherwise("u")
        .alias("op"),
        F.expr("timestampdiff(MILLISECOND, timestamp'1970-01-01', ts)").alias("ts_ms"),
    )


_FLAT = {
    "bay_id": ("user_id", "int"),
    "status": "event_type",
    "event_time": ("ts", "timestamp_ntz"),
    "props": "props",
}


@_query("""
SELECT CAST(user_id AS INTEGER) AS bay_id, event_type AS status, ts AS event_time, props
FROM events WHERE event_type <> 'error'""")
def cdc_flatten(spark, sf_dir):
    return cdc.flatten(_envelopes(_read(spark, sf_dir, "events")), _FLAT)


@_query("""
SELECT event_id, TRY_CAST(key_text AS INTEGER) AS key, value FROM (
  SELECT *, CASE WHEN event_type = 'error' THEN event_type
                 WHEN event_type = 'click' THEN ''
                 ELSE '  ' || CAST(user_id AS VARCHAR) || ' ' END AS key_text FROM events)
WHERE TRY_CAST(key_text AS INTEGER) IS NOT NULL""")
def clean_cast_require(spark, sf_dir):
    kind = F.col("event_type")
    raw = _read(spark, sf_dir, "events").withColumn(
        "key_text",
        F.when(kind == "error", kind)
        .when(kind == "click", "")
        .otherwise(F.concat(F.lit("  "), F.col("user_id").cast("string"), F.lit(" "))),
    )
    typed = clean.project(
        raw, {"event_id": "event_id", "key": ("key_text", "int"), "value": "value"}
    )
    return clean.require(typed, ["key"])


@_query("""
SELECT l_orderkey, l_linenumber, coalesce(flag_text = 'R', false) AS is_returned FROM (
  SELECT *, CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS flag_text FROM lineitem)""")
def yes_no_flag(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_linestatus") == "O", F.col("l_returnflag"))
    return lines.select("l_orderkey", "l_linenumber", flag(text, "R").alias("is_returned"))


@_query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 0 END AS status_code
FROM events""")
def status_code(spark, sf_dir):
    codes = {"view": 1, "purchase": 0}
    events = _read(spark, sf_dir, "events")
    return events.select("event_id", code("event_type", codes).alias("status_code"))


@_query("""
SELECT md5(CAST(p_partkey AS VARCHAR) || '-' || p_brand) AS part_key, p_partkey AS part_id,
       p_brand AS brand, p_type AS part_type, p_size AS max_minutes
FROM part""")
def dim_part(spark, sf_dir):
    names = {
        "part_id": "p_partkey", "brand": "p_brand", "part_type": "p_type", "max_minutes": "p_size",
    }
    return marts.dimension(
        _read(spark, sf_dir, "part"), names, key_name="part_key", key_cols=["p_partkey", "p_brand"]
    )


@_query("""
SELECT c.*, n.n_name, n.n_regionkey FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def zone_enrich(spark, sf_dir):
    nation = _read(spark, sf_dir, "nation")
    return marts.enrich_zone(_read(spark, sf_dir, "customer"), nation, "c_nationkey", "n_nationkey")


# --- append and keyed replacement -------------------------------------------------------


@_query("""
SELECT c_custkey AS party_id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def append_rows(spark, sf_dir):
    customers = clean.project(
        _read(spark, sf_dir, "customer"),
        {"party_id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"},
    )
    suppliers = clean.project(
        _read(spark, sf_dir, "supplier"), {"party_id": "s_suppkey", "name": "s_name"}
    )
    return merge.append(customers, suppliers)


@_query("""
WITH batch AS (
  SELECT * REPLACE ('F' AS o_orderstatus) FROM orders WHERE o_orderstatus = 'P')
SELECT * FROM orders t WHERE NOT EXISTS (
  SELECT 1 FROM batch b
  WHERE b.o_custkey = t.o_custkey AND b.o_orderpriority = t.o_orderpriority)
UNION ALL SELECT * FROM batch""")
def replace_by_key(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    batch = orders.filter(F.col("o_orderstatus") == "P").withColumn("o_orderstatus", F.lit("F"))
    return merge.replace_by_key(orders, batch, ["o_custkey", "o_orderpriority"])


@_query("""
SELECT *, 'by_status' AS sink FROM orders UNION ALL SELECT *, 'plain' FROM orders""")
def dual_write(spark, sf_dir):
    """One frame into two sinks, both read back."""
    base = runtime.workspace(spark, "dual")
    sinks.dual_write(
        _read(spark, sf_dir, "orders"),
        lambda df: sinks.write_parquet(df, f"{base}/by_status", partition_by=["o_orderstatus"]),
        lambda df: sinks.write_parquet(df, f"{base}/plain"),
    )
    by_status = files.read_parquet(spark, f"{base}/by_status")
    plain = files.read_parquet(spark, f"{base}/plain")
    return by_status.withColumn("sink", F.lit("by_status")).unionByName(
        plain.withColumn("sink", F.lit("plain"))
    )


# --- exports and tables ------------------------------------------------------------------

_LOADED = datetime(2024, 2, 1)
_LOADED_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
_DATABASE = "eventmart_queries"


def _table_name(spark: SparkSession, label: str) -> str:
    """A table name no other run uses."""
    sinks.ensure_database(spark, _DATABASE)
    return f"{_DATABASE}.{label}_{uuid.uuid4().hex}"


def _exported_orders(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """Folder with one export of orders per status, in the order F, O, P by name, and one of
    a longer prefix that must not be read."""
    orders = _read(spark, sf_dir, "orders")
    base = runtime.workspace(spark, "exports")
    for day, status in enumerate("FOP", 1):
        rows = orders.filter(F.col("o_orderstatus") == status)
        rows.write.options(**files.JSON_TIMES).json(f"{base}/orders_2024010{day}_000000.json")
    orders.write.json(f"{base}/orders_all_20240109_000000.json")
    return base, orders.schema


@_query("SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')")
def json_history(spark, sf_dir):
    base, schema = _exported_orders(spark, sf_dir)
    return files.read_json_snapshots(spark, base, "orders", schema, "history", multi_line=False)


@_query("SELECT * FROM orders WHERE o_orderstatus = 'P'")
def json_snapshot(spark, sf_dir):
    base, schema = _exported_orders(spark, sf_dir)
    return files.read_json_snapshots(spark, base, "orders", schema, "snapshot", multi_line=False)


@_query(f"""
SELECT c_custkey, c_acctbal, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment,
       CAST(NULL AS VARCHAR) AS _corrupt_record, {_LOADED_SQL} AS _ingested_at
FROM customer
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, '{{"c_custkey": 1', {_LOADED_SQL}""")
def landed_exports(spark, sf_dir):
    """Customers as an export of which two columns are declared, with one broken line, landed
    twice; the others arrive as text, and the line in a column of its own."""
    base = runtime.workspace(spark, "landed")
    export = f"{base}/raw/customer_20240101_000000.json"
    customers = _read(spark, sf_dir, "customer")
    broken = customers.agg(F.lit('{"c_custkey": 1').alias("value"))
    lines = customers.select(F.to_json(F.struct("*")).alias("value")).unionByName(broken)
    lines.write.text(export)
    declared = customers.select("c_custkey", "c_acctbal").schema
    for _ in range(2):
        jobs.load_export(
            spark, f"{base}/raw", "customer", f"{base}/archive", ts=_LOADED, schema=declared,
            multi_line=False,
        )
    landed = files.read_parquet(spark, f"{base}/archive/customer")
    return _zoneless(landed, "_ingested_at")


def _write_pretty(df: DataFrame, path: str, rows_per_file: int = 5_000) -> None:
    """An export as pretty-printed JSON arrays, in as many files as it needs."""
    parts = max(1, -(-df.count() // rows_per_file))
    dealt = df.withColumn("__file", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
    arrays = dealt.groupBy("__file").agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    text = arrays.select(F.to_json("rows", {"pretty": "true"}).alias("value"))
    text.write.option("maxRecordsPerFile", 1).text(path)


@_query(f"""
SELECT c_custkey, c_acctbal, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment,
       CAST(NULL AS VARCHAR) AS _corrupt_record, {_LOADED_SQL} AS _ingested_at
FROM customer""")
def landed_once(spark, sf_dir):
    """Customers as pretty-printed event exports of which two columns are declared. The job
    runs after each export and once more; every file lands once."""
    base = runtime.workspace(spark, "ledger")
    customers = _read(spark, sf_dir, "customer")
    declared = customers.select("c_custkey", "c_acctbal").schema
    for part in (0, 1, None):
        if part is not None:
            rows = customers.filter(F.col("c_custkey") % 2 == part)
            _write_pretty(rows, f"{base}/raw/customer_2024010{part + 1}_000000.json")
        jobs.load_export(
            spark, f"{base}/raw", "customer", f"{base}/archive", ts=_LOADED, schema=declared,
            keep_all=True,
        )
    landed = files.read_parquet(spark, f"{base}/archive/customer").drop("load")
    return _zoneless(landed, "_ingested_at")


@_query(f"SELECT *, {_LOADED_SQL} AS ingested_at FROM orders")
def load_stamp(spark, sf_dir):
    return _zoneless(clean.stamp(_read(spark, sf_dir, "orders"), ts=_LOADED), "ingested_at")


@_query("SELECT * FROM orders")
def table_overwrite(spark, sf_dir):
    """Customers replaced by orders, which have other columns, in a partitioned table."""
    name = _table_name(spark, "overwritten")
    sinks.overwrite_table(_read(spark, sf_dir, "customer"), name)
    sinks.overwrite_table(_read(spark, sf_dir, "orders"), name, partition_by=["o_orderstatus"])
    return files.read_table(spark, name)


@_query("""
SELECT c_custkey AS party_id, c_name AS name, 'customer' AS kind, CAST(NULL AS DOUBLE) AS balance
FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier', s_acctbal FROM supplier""")
def table_append_evolve(spark, sf_dir):
    """Suppliers appended to a partitioned table of customers that lacks one of their columns."""
    name = _table_name(spark, "appended")
    customers = _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"),
        F.lit("customer").alias("kind"),
    )
    suppliers = _read(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"),
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"),
    )
    sinks.overwrite_table(customers, name, partition_by=["kind"])
    sinks.append_table(suppliers, name)
    return files.read_table(spark, name)


@_query("""
WITH batch AS (
  SELECT * REPLACE ('F' AS o_orderstatus) FROM orders WHERE o_orderstatus = 'P')
SELECT * FROM orders t WHERE NOT EXISTS (
  SELECT 1 FROM batch b
  WHERE b.o_custkey = t.o_custkey AND b.o_orderpriority = t.o_orderpriority)
UNION ALL SELECT * FROM batch""")
def table_upsert(spark, sf_dir):
    """The first batch creates the table, the second replaces rows by key."""
    name = _table_name(spark, "upserted")
    orders = _read(spark, sf_dir, "orders")
    batch = orders.filter(F.col("o_orderstatus") == "P").withColumn("o_orderstatus", F.lit("F"))
    for rows in (orders, batch):
        sinks.upsert_table(rows, name, ["o_custkey", "o_orderpriority"])
    return files.read_table(spark, name)


# --- history -----------------------------------------------------------------------------

_DAYS = ["1998-01-01 00:00:00", "2000-01-01 00:00:00", "2002-01-01 00:00:00"]


def _snapshot_sql(name: str, day: str) -> str:
    return f"""{name} AS (
  SELECT o_custkey, o_orderstatus, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
    FROM orders WHERE o_orderdate < TIMESTAMP '{day}')
  WHERE place = 1)"""


def _apply_sql(name: str, hist: str, snap: str, day: str) -> str:
    differs = (
        "(h.o_orderstatus IS DISTINCT FROM s.o_orderstatus"
        " OR h.o_orderpriority IS DISTINCT FROM s.o_orderpriority)"
    )
    return f"""{name} AS (
  SELECT h.o_custkey, h.o_orderstatus, h.o_orderpriority, h.valid_from,
         CASE WHEN h.valid_to IS NULL AND s.o_custkey IS NOT NULL AND {differs}
              THEN TIMESTAMP '{day}' ELSE h.valid_to END AS valid_to
  FROM {hist} h LEFT JOIN {snap} s ON h.o_custkey = s.o_custkey
  UNION ALL
  SELECT s.o_custkey, s.o_orderstatus, s.o_orderpriority, TIMESTAMP '{day}', NULL
  FROM {snap} s LEFT JOIN {hist} h ON h.o_custkey = s.o_custkey AND h.valid_to IS NULL
  WHERE h.o_custkey IS NULL OR {differs})"""


@_query(f"""WITH
{_snapshot_sql("s1", _DAYS[0])},
{_snapshot_sql("s2", _DAYS[1])},
{_snapshot_sql("s3", _DAYS[2])},
h1 AS (SELECT *, TIMESTAMP '{_DAYS[0]}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM s1),
{_apply_sql("h2", "h1", "s2", _DAYS[1])},
{_apply_sql("h3", "h2", "s3", _DAYS[2])}
SELECT * FROM h3""")
def scd2_apply(spark, sf_dir):
    """Each customer's latest order as seen on three days, kept as history. A snapshot's
    result is written before the next one reads it, as between two runs."""
    orders = _read(spark, sf_dir, "orders")

    def snapshot(day):
        seen = orders.filter(F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz"))
        latest = dedup.latest_by(seen, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
        return latest.select("o_custkey", "o_orderstatus", "o_orderpriority")

    def step(hist, day):
        checked = ["o_orderstatus", "o_orderpriority"]
        return history.scd2_apply(hist, snapshot(day), ["o_custkey"], checked, day)

    first = history.start_history(snapshot(_DAYS[0]), _DAYS[0])
    return step(runtime.written(step(first, _DAYS[1]), "history"), _DAYS[2])


_VERSIONS = """versions AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate AS valid_from,
         lead(o_orderdate) OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate, o_orderkey) AS valid_to
  FROM orders)"""


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )
    return history.from_changes(changes, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@_query(f"""WITH {_VERSIONS}
SELECT o_custkey, o_orderkey, o_orderpriority, valid_from,
       coalesce(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
       valid_to IS NULL AS is_current_record
FROM versions""")
def history_dimension(spark, sf_dir):
    return history.as_dimension(_versions(spark, sf_dir))


def _as_of_sql(comparison: str) -> str:
    return f"""WITH {_VERSIONS}
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_custkey,
       v.o_orderkey AS version_orderkey, v.o_orderpriority AS version_priority, v.valid_from
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN versions v ON v.o_custkey = o.o_custkey AND v.valid_from <= l.l_shipdate
  AND (v.valid_to IS NULL OR l.l_shipdate {comparison} v.valid_to)"""


def _as_of(spark: SparkSession, sf_dir: str, closed: str) -> DataFrame:
    owners = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    shipped = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    versions = _versions(spark, sf_dir).withColumnsRenamed(
        {"o_orderkey": "version_orderkey", "o_orderpriority": "version_priority"}
    )
    joined = history.join_as_of(shipped, versions, ["o_custkey"], "l_shipdate", closed=closed)
    return joined.drop("valid_to")


@_query(_as_of_sql("<"))
def join_as_of(spark, sf_dir):
    return _as_of(spark, sf_dir, "left")


@_query(_as_of_sql("<="))
def join_as_of_between(spark, sf_dir):
    return _as_of(spark, sf_dir, "both")


# --- quality -----------------------------------------------------------------------------


@_query("""
WITH counts AS (
  SELECT 'not_null_l_shipdate' AS "check",
         count(*) FILTER (WHERE l_shipdate IS NULL) AS failing_rows FROM lineitem
  UNION ALL SELECT 'discount_in_range',
         count(*) FILTER (WHERE NOT (l_discount BETWEEN 0 AND 0.05)) FROM lineitem
  UNION ALL SELECT 'max_value_l_quantity', count(*) FILTER (WHERE l_quantity > 45) FROM lineitem
  UNION ALL SELECT 'unique_l_orderkey', (SELECT count(*) FROM (
         SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'relationships_l_orderkey', (SELECT count(*) FROM lineitem
         WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
  UNION ALL SELECT 'relationships_l_suppkey', (SELECT count(*) FROM lineitem
         WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)))
SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM counts""")
def quality_report(spark, sf_dir):
    suppliers = _read(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return quality.report(
        _read(spark, sf_dir, "lineitem"),
        unique_cols=["l_orderkey"],
        not_null_cols=["l_shipdate"],
        expressions={"discount_in_range": "l_discount BETWEEN 0 AND 0.05"},
        max_values={"l_quantity": 45},
        references=[
            ("l_orderkey", _read(spark, sf_dir, "orders"), "o_orderkey"),
            ("l_suppkey", suppliers, "s_suppkey"),
        ],
    )


@_query("""
SELECT * FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def quality_relationships(spark, sf_dir):
    finished = _read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    lines = _read(spark, sf_dir, "lineitem")
    return quality.relationships(lines, "l_orderkey", finished, "o_orderkey")


@_query("SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def quality_unique(spark, sf_dir):
    return quality.unique(_read(spark, sf_dir, "orders"), "o_custkey")


@_query("""
SELECT * FROM (SELECT event_id, user_id,
                      CASE WHEN event_type <> 'error' THEN value END AS reading FROM events)
WHERE reading IS NULL""")
def quality_not_null(spark, sf_dir):
    reading = F.when(F.col("event_type") != "error", F.col("value")).alias("reading")
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", reading)
    return quality.not_null(events, "reading")


@_query("SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)")
def quality_expression(spark, sf_dir):
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return quality.expression(customers, "c_acctbal >= 0")


@_query(f"WITH {_SESSIONS} SELECT * FROM sessions WHERE duration_minutes > 2880")
def quality_realistic_duration(spark, sf_dir):
    return quality.max_value(_sessions(spark, sf_dir), "duration_minutes", 48 * 60)


# --- indicators --------------------------------------------------------------------------

_TOTALS = """count(*) AS sessions,
  CAST(sum(CAST(duration_minutes AS DECIMAL(18, 2))) AS DOUBLE) AS total_value,
  CAST(sum(CAST(duration_minutes AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS mean_value"""
_DAILY = f"""{_SESSIONS},
daily AS (SELECT CAST(date_trunc('day', arrival_time) AS TIMESTAMP) AS period, {_TOTALS}
          FROM sessions GROUP BY 1)"""


@_query(f"WITH {_DAILY} SELECT * FROM daily")
def kpi_daily(spark, sf_dir):
    return kpi.period_totals(_sessions(spark, sf_dir), "arrival_time", "day")


@_query(f"""WITH {_DAILY}
SELECT *, lag(total_value) OVER (ORDER BY period) AS previous,
       round(total_value - lag(total_value) OVER (ORDER BY period), 2) AS change FROM daily""")
def kpi_variance(spark, sf_dir):
    daily = kpi.period_totals(_sessions(spark, sf_dir), "arrival_time", "day")
    return kpi.variance(daily, "period", "total_value")


@_query(f"""WITH {_SESSIONS}
SELECT CAST(hour(arrival_time) AS INTEGER) AS hour_of_day, count(*) AS sessions
FROM sessions GROUP BY 1 ORDER BY sessions DESC, hour_of_day LIMIT 5""")
def kpi_peak_hours(spark, sf_dir):
    return kpi.peak_hours(_sessions(spark, sf_dir), "arrival_time", 5)


@_query(f"""WITH {_REPORT}
SELECT c_mktsegment, count(*) AS sessions FROM report
GROUP BY 1 ORDER BY sessions DESC, c_mktsegment LIMIT 3""")
def kpi_busiest_zones(spark, sf_dir):
    return kpi.top_by_count(_report(spark, sf_dir), ["c_mktsegment"], 3)


@_query(f"""WITH {_SESSIONS}
SELECT user_id, CAST(date_trunc('week', arrival_time) AS TIMESTAMP) AS period,
       count(*) AS sessions
FROM sessions GROUP BY 1, 2""")
def kpi_turnover(spark, sf_dir):
    return kpi.turnover(_sessions(spark, sf_dir), "user_id", "arrival_time", "week")


@_query("""
SELECT l_linestatus, avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) AS share
FROM lineitem GROUP BY 1""")
def kpi_flag_share(spark, sf_dir):
    flagged = _read(spark, sf_dir, "lineitem").select(
        "l_linestatus", flag("l_returnflag", "R").alias("is_returned")
    )
    return kpi.flag_share(flagged, "is_returned", ["l_linestatus"])


@_query(f"""WITH {_REPORT}
SELECT stay_category, count(*) AS sessions,
       CAST(sum(CAST(duration_minutes AS DECIMAL(18, 2))) AS DOUBLE) AS total_minutes
FROM report GROUP BY 1""")
def kpi_stay_shares(spark, sf_dir):
    return kpi.stay_shares(_report(spark, sf_dir))


def _occupancy_sql(source: str, unit: str, key: str = "") -> str:
    lead_key = f"{key}, " if key else ""
    part = f"PARTITION BY {key} " if key else ""
    return f"""moves AS (
  SELECT {lead_key}CAST(date_trunc('{unit}', arrival_time) AS TIMESTAMP) AS period, 1 AS move
  FROM {source}
  UNION ALL
  SELECT {lead_key}CAST(date_trunc('{unit}', departure_time) AS TIMESTAMP), -1 FROM {source}),
occupancy AS (
  SELECT {lead_key}period, count(*) FILTER (WHERE move > 0) AS arrivals,
         CAST(sum(sum(move)) OVER ({part}ORDER BY period) AS BIGINT) AS occupied
  FROM moves GROUP BY {lead_key}period)"""


_OPEN_SESSIONS = _SESSIONS.replace("sessions AS", "stays AS").replace(
    "AND next_type = 'purchase'", "AND (next_type = 'purchase' OR next_ts IS NULL)"
)


@_query(f"""WITH {_OPEN_SESSIONS}, {_occupancy_sql("stays", "hour")}
SELECT * FROM occupancy WHERE period IS NOT NULL""")
def kpi_occupancy(spark, sf_dir):
    """Sessions that have not ended yet count too."""
    sessions = state_sessions(
        _read(spark, sf_dir, "events"), "user_id", "event_type", "ts", "view", "purchase",
        ["event_id"], keep_open=True,
    )
    return kpi.occupancy_over_time(sessions, "arrival_time", "departure_time", "hour")


_ZONE_OCCUPANCY = f"""WITH {_REPORT},
{_occupancy_sql("report", "minute", "c_mktsegment")}"""


@_query(f"{_ZONE_OCCUPANCY} SELECT * FROM occupancy")
def kpi_zone_occupancy(spark, sf_dir):
    return kpi.occupancy_over_time(
        _report(spark, sf_dir), "arrival_time", "departure_time", "minute", ["c_mktsegment"]
    )


@_query(f"""{_ZONE_OCCUPANCY},
capacity AS (SELECT c_mktsegment, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS capacity
             FROM customer GROUP BY 1)
SELECT o.*, c.capacity FROM occupancy o JOIN capacity c USING (c_mktsegment)
WHERE o.occupied > c.capacity""")
def kpi_over_capacity(spark, sf_dir):
    occupancy = kpi_zone_occupancy(spark, sf_dir)
    capacity = (
        _read(spark, sf_dir, "customer")
        .groupBy("c_mktsegment")
        .agg(F.ceil(F.count(F.lit(1)) / 1000).alias("capacity"))
    )
    return kpi.over_capacity(occupancy, capacity, ["c_mktsegment"])


_RULED = f"""{_SESSIONS},
rules AS (
  SELECT p_partkey, 1 AS rule_number, CAST(p_size * 10 AS DOUBLE) AS max_minutes,
         0 AS begins, (p_size % 24) * 60 AS ends, CAST(NULL AS INTEGER) AS day, p_type AS rule_type
  FROM part
  UNION ALL
  SELECT p_partkey, 2, CAST(p_size * 60 AS DOUBLE), (p_size % 24) * 60, 0, p_size % 7, p_brand
  FROM part),
timed AS (
  SELECT *, hour(arrival_time) * 60 + minute(arrival_time) AS m, dayofweek(arrival_time) AS d
  FROM sessions),
ruled AS (
  SELECT * FROM (
    SELECT t.*, r.*, row_number() OVER (PARTITION BY session_id ORDER BY rule_number) AS place
    FROM timed t LEFT JOIN rules r ON t.user_id = r.p_partkey AND (
      (begins < ends AND (day IS NULL OR day = d) AND m >= begins AND m < ends)
      OR (begins >= ends AND (day IS NULL OR day = d) AND m >= begins)
      OR (begins >= ends AND (day IS NULL OR day = (d + 6) % 7) AND m < ends)))
  WHERE place = 1)"""


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part gives its user two rules."""
    hour = F.lpad((F.col("p_size") % 24).cast("string"), 2, "0")
    wide = _read(spark, sf_dir, "part").select(
        "p_partkey",
        (F.col("p_size") * 10).alias("duration1"),
        (F.col("p_size") * 60).alias("duration2"),
        F.lit("00:00").alias("starttime1"),
        F.concat(hour, F.lit(":00")).alias("endtime1"),
        F.concat(hour, F.lit(":00:00")).alias("starttime2"),
        F.lit("00:00").alias("endtime2"),
        (F.col("p_size") % 7).alias("fromday2"),
        F.col("p_type").alias("typedesc1"),
        F.col("p_brand").alias("typedesc2"),
    )
    fields = {
        "max_minutes": ("duration", "int"),
        "start_time": ("starttime", "string"),
        "end_time": ("endtime", "string"),
        "day_range": ("fromday", "string"),
        "type_desc": ("typedesc", "string"),
    }
    return reshape.unpivot_slots(wide, ["p_partkey"], fields, 2, "rule_number", "type_desc")


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with the rule in force at arrival."""
    sessions, rules = _sessions(spark, sf_dir), _rules(spark, sf_dir)
    return kpi.rule_in_force(sessions, rules, "user_id", "arrival_time", "p_partkey")


@_query(f"""WITH {_RULED}
SELECT session_id, user_id, arrival_time, departure_time, duration_minutes, rule_number,
       rule_type, max_minutes, coalesce(duration_minutes > max_minutes, false) AS is_overstay
FROM ruled""")
def kpi_overstay(spark, sf_dir):
    return kpi.overstays(_ruled(spark, sf_dir))


@_query(f"""WITH {_RULED}
SELECT rule_type, count(*) AS sessions,
       CAST(sum(CAST(duration_minutes AS DECIMAL(18, 2))) AS DOUBLE) AS total_minutes
FROM ruled GROUP BY 1""")
def kpi_minutes_by_rule(spark, sf_dir):
    return kpi.minutes_by_rule_type(_ruled(spark, sf_dir))


@_query(f"""WITH {_RULED},
points AS (
  SELECT session_id, user_id, arrival_time, departure_time, arrival_time AS moment FROM sessions
  UNION SELECT session_id, user_id, arrival_time, departure_time, departure_time FROM sessions
  UNION SELECT session_id, user_id, arrival_time, departure_time, edge
  FROM (SELECT s.*, day + to_minutes(m) AS edge
        FROM (SELECT *, unnest(generate_series(date_trunc('day', arrival_time)::TIMESTAMP,
                                               departure_time, INTERVAL 1 DAY)) AS day
              FROM sessions) s
        JOIN (SELECT p_partkey, unnest([begins, ends, 0]) AS m FROM rules
              UNION SELECT DISTINCT user_id, 0 FROM sessions) r ON r.p_partkey = s.user_id)
  WHERE edge > arrival_time AND edge < departure_time),
segments AS (
  SELECT * FROM (
    SELECT session_id, user_id, moment,
           date_diff('microsecond', moment, lead(moment) OVER (PARTITION BY session_id ORDER BY moment))
             AS micros
    FROM points)
  WHERE micros > 0),
held AS (
  SELECT g.*, (SELECT arg_min(rule_type, rule_number) FROM rules r
               WHERE r.p_partkey = g.user_id AND (
                 (begins < ends AND (day IS NULL OR day = dayofweek(moment))
                  AND hour(moment) * 60 + minute(moment) >= begins AND hour(moment) * 60 + minute(moment) < ends)
                 OR (begins >= ends AND (day IS NULL OR day = dayofweek(moment))
                     AND hour(moment) * 60 + minute(moment) >= begins)
                 OR (begins >= ends AND (day IS NULL OR day = (dayofweek(moment) + 6) % 7)
                     AND hour(moment) * 60 + minute(moment) < ends))) AS rule_type
  FROM segments g)
SELECT rule_type, count(*) AS segments, sum(micros)::DOUBLE / 6e7 AS total_minutes
FROM held GROUP BY 1""")
def kpi_minutes_along_stay(spark, sf_dir):
    """Minutes under each rule, a stay being cut where the rule in force changes."""
    return kpi.minutes_along_stay(
        kpi.rules_along_stay(
            _sessions(spark, sf_dir), _rules(spark, sf_dir),
            "user_id", "arrival_time", "departure_time", "p_partkey",
        )
    )


# --- streams -----------------------------------------------------------------------------


def _stream_settings(spark: SparkSession):
    """State is split by the shuffle partitions a query starts with: one per core here."""
    cores = str(max(8, spark.sparkContext.defaultParallelism))
    return runtime.settings(
        spark, **stream_sessions.STATE_STORE, **{"spark.sql.shuffle.partitions": cores}
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    stream = io.read_parquet_stream(spark, path, spark.read.parquet(path).schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained_to(spark: SparkSession, label: str, stream: Callable[[], DataFrame]) -> str:
    """Run a stream to its end into files; gives their folder."""
    base = runtime.workspace(spark, label)
    with _stream_settings(spark):
        io.drain(io.append_to_path(stream(), f"{base}/rows", f"{base}/checkpoint"))
    return f"{base}/rows"


def _drained(spark: SparkSession, label: str, stream: Callable[[], DataFrame]) -> DataFrame:
    """Run a stream to its end into files and read them back."""
    return spark.read.parquet(_drained_to(spark, label, stream))


@_query("""
SELECT CAST(user_id AS INTEGER) AS bay_id, event_type AS status, ts AS event_time,
       CAST(props ->> '$.k' AS INTEGER) AS k
FROM events WHERE event_type <> 'error'""")
def stream_bronze_silver(spark, sf_dir):
    """Change events as JSON files, through a bronze to a silver stream."""
    base = runtime.workspace(spark, "layers")
    landed = _envelopes(_read(spark, sf_dir, "events"))
    landed.write.json(f"{base}/landing")
    bronze, silver = f"{base}/bronze", f"{base}/silver"
    io.drain(
        layers.bronze_stream(
            spark,
            f"{base}/landing",
            landed.schema["after"].dataType,
            bronze,
            f"{base}/checkpoint_bronze",
            sink=io.append_to_path,
        )
    )
    stream = io.read_parquet_stream(spark, bronze, spark.read.parquet(bronze).schema)
    io.drain(
        layers.silver_stream(
            stream,
            silver,
            f"{base}/checkpoint_silver",
            lambda df: layers.silver_rows(df, _FLAT, {"props": "k INT"}),
            sink=io.append_to_path,
        )
    )
    return spark.read.parquet(silver)


@_query("""
SELECT CAST(user_id AS INTEGER) AS bay_id, event_type AS status, ts AS event_time,
       CAST(props ->> '$.k' AS INTEGER) AS k
FROM events WHERE event_type <> 'error'""")
def stream_tables(spark, sf_dir):
    """Change events through a bronze to a silver table, in two runs over several files and
    micro-batches; the second run goes on where the first one stopped."""
    base = runtime.workspace(spark, "tables")
    landed = _envelopes(_read(spark, sf_dir, "events"))
    image = landed.schema["after"].dataType
    bronze, silver = _table_name(spark, "bronze"), _table_name(spark, "silver")
    update = F.col("op") == "u"
    for rows in (landed.filter(update), landed.filter(~update)):
        rows.repartition(3).write.mode("append").json(f"{base}/landing")
        io.drain(
            layers.bronze_stream(
                spark, f"{base}/landing", image, bronze, f"{base}/bronze", max_files=2
            )
        )
        io.drain(
            layers.silver_stream(
                io.read_table_stream(spark, bronze),
                silver,
                f"{base}/silver",
                lambda df: layers.silver_rows(df, _FLAT, {"props": "k INT"}),
            )
        )
    return spark.table(silver)


@_query("SELECT event_id, user_id, event_type FROM events")
def stream_shared_table(spark, sf_dir):
    """Two queries under checkpoints of their own append to one table, each run twice."""
    base, name = runtime.workspace(spark, "shared"), _table_name(spark, "shared")
    for part in (0, 1):
        rows = _event_stream(spark, sf_dir).filter(F.pmod("event_id", F.lit(2)) == part)
        for _ in range(2):
            rows = rows.select("event_id", "user_id", "event_type")
            io.drain(io.append_batches(rows, name, f"{base}/checkpoint-{part}"))
    return spark.table(name).drop("_batch")


@_query("SELECT DISTINCT user_id, ts, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Every event arrives twice; one copy stays."""

    def rows():
        once = _event_stream(spark, sf_dir).select("user_id", "ts", "event_type")
        twice = once.unionByName(_event_stream(spark, sf_dir).select(*once.columns))
        return windows.dedup_stream(twice, ["user_id", "event_type"], "ts", "1 hour")

    return _zoneless(_drained(spark, "dedup", rows), "ts")


_WINDOWS = """windows AS (
  SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, user_id,
         count(*) AS readings, avg(CASE WHEN event_type = 'view' THEN 1.0::DOUBLE ELSE 0 END)
           AS occupied_share
  FROM (SELECT *, unnest([time_bucket(INTERVAL 12 HOUR, ts),
                          time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS window_start
        FROM events)
  GROUP BY ALL
  HAVING window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events))"""


def _occupancy_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.occupancy_windows(
        _event_stream(spark, sf_dir), "ts", ["user_id"], "event_type", "view",
        "1 day", "12 hours", "1 hour",
    )


def _zoneless(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@_query(f"WITH {_WINDOWS} SELECT * FROM windows")
def stream_window(spark, sf_dir):
    """Windows the watermark has closed by the end of the input."""
    rows = _drained(spark, "windows", lambda: _occupancy_stream(spark, sf_dir))
    return _zoneless(rows, "window_start", "window_end")


@_query(f"WITH {_WINDOWS} SELECT * FROM windows WHERE occupied_share >= 0.5")
def stream_alerts(spark, sf_dir):
    rows = _drained(spark, "alerts", lambda: windows.alerts(_occupancy_stream(spark, sf_dir), 0.5))
    return _zoneless(rows, "window_start", "window_end")


@_query(f"""WITH {_WINDOWS}, sides AS (
  SELECT user_id, window_end, occupied_share, occupied_share >= 0.5 AS above,
         lag(occupied_share >= 0.5) OVER (PARTITION BY user_id ORDER BY window_end) AS before
  FROM windows WHERE window_end < (SELECT max(window_end) FROM windows))
SELECT user_id, window_end AS crossed_at, occupied_share, above FROM sides
WHERE above <> coalesce(before, false)""")
def stream_crossings(spark, sf_dir):
    """Moments at which a user's share of a window crosses one half, from the stream of
    closed windows. The last window of all is still younger than the watermark."""
    folder = _drained_to(spark, "windows", lambda: _occupancy_stream(spark, sf_dir))
    schema = spark.read.parquet(folder).schema
    rows = _drained(
        spark,
        "crossings",
        lambda: windows.crossings(
            io.read_parquet_stream(spark, folder, schema),
            ["user_id"], "window_end", "occupied_share", 0.5,
        ),
    )
    return _zoneless(rows, "crossed_at")


@_query(f"""WITH {_SESSIONS}
SELECT * FROM sessions
WHERE departure_time < (SELECT date_trunc('milliseconds', max(ts)) FROM events)
                       - INTERVAL 10 MINUTE""", "stream_sessions")
def drained_sessions(spark, sf_dir):
    """All sessions but those whose end is younger than the watermark."""
    return _drained(
        spark,
        "sessions",
        lambda: stream_sessions.settled_sessions(
            _event_stream(spark, sf_dir), "user_id", "event_type", "ts", "view", "purchase",
            ["event_id"],
        ),
    )
