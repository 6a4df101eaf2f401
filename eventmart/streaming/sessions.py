"""Sessions from a stream of state changes.

A stream cannot look ahead with a window function, and keeping a whole key in one state
object would put a busy key on one task for good. State is therefore held per time slice
and key bucket: it is sorted and emptied when the watermark passes the slice's end, so it
never outgrows a slice, and a busy key moves on to another task with every slice. A closed
slice emits its rows that pair inside it, plus the first and last row of each key;
``sessions`` joins slices end to end from those, two rows per key and slice.

Where a key's rows of one batch fit a task, ``settled_sessions`` is simpler and sooner: one
row of state and the rows younger than the watermark for each key, and every session comes
out as soon as the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.keys import surrogate_key
from eventmart.functions.time import epoch_micros, minutes_between
from eventmart.operators.sessions import with_next
from eventmart.streaming.in_order import SessionSteps
from eventmart.streaming.slice_rows import OUT_NAMES, OUT_TYPES, SliceRows

# Needed by the stateful operator; pass to ``runtime.settings`` around starting the query.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def slice_neighbours(
    df: DataFrame,
    key: str,
    state: str,
    ts: str,
    start: str,
    end: str,
    tie_break: Sequence[str] = (),
    slice_ms: int = 3_600_000,
    buckets: int = 64,
    delay: str = "10 minutes",
) -> DataFrame:
    """Stream of the rows that matter for sessions, slice by slice; append it to a table and
    read that with ``sessions``. ``tie_break`` columns must be whole numbers.

    ``slice_ms`` bounds what one state object holds; ``buckets`` is the number of state
    objects, and so of tasks, that share a slice.
    """
    order = {"__o0": epoch_micros(ts)}
    order |= {f"__o{i}": F.col(c).cast("long") for i, c in enumerate(tie_break, 1)}
    keyed = df.withWatermark(ts, delay).select(
        F.floor(epoch_micros(ts) / F.lit(slice_ms * 1000)).alias("slice"),
        F.pmod(F.hash(key), F.lit(buckets)).alias("__bucket"),
        F.col(ts),
        F.col(key),
        F.col(state).alias("__state"),
        *(c.alias(name) for name, c in order.items()),
    )
    key_type = df.schema[key].dataType
    held = T.StructType([T.StructField(key, key_type), T.StructField("__state", T.StringType())])
    for name in order:
        held = held.add(name, T.LongType())
    fields = zip((key, *OUT_NAMES), (key_type.simpleString(), *OUT_TYPES), strict=True)
    return keyed.groupBy("slice", "__bucket").transformWithState(
        statefulProcessor=SliceRows(held, slice_ms, start, end),
        outputStructType=", ".join(f"`{n}` {t}" for n, t in fields),
        outputMode="Append",
        timeMode="EventTime",
    )


def sessions(
    neighbours: DataFrame,
    key: str,
    start: str,
    end: str,
    names: tuple[str, str] = ("arrival_time", "departure_time"),
    ts_type: str = "timestamp_ntz",
) -> DataFrame:
    """Sessions of all closed slices, from the table ``slice_neighbours`` was appended to."""
    inside = neighbours.filter(~F.col("is_last"))
    edges = neighbours.filter(F.col("is_first") | F.col("is_last")).drop("next_us", "next_state")
    order = edges.withColumn("at", F.timestamp_micros("at_us"))
    across = (
        with_next(order, [key], "at", ["at_us", "state"], ["slice", "place"])
        .filter(F.col("is_last"))
        .withColumnRenamed("next_at_us", "next_us")
    )
    columns = [key, "at_us", "state", "next_us", "next_state"]
    arrival, departure = names
    return (
        inside.select(*columns)
        .unionByName(across.select(*columns))
        .filter((F.col("state") == start) & (F.col("next_state") == end))
        .select(
            F.col(key),
            F.timestamp_micros("at_us").cast(ts_type).alias(arrival),
            F.timestamp_micros("next_us").cast(ts_type).alias(departure),
        )
        .select(
            surrogate_key(key, arrival).alias("session_id"),
            "*",
            minutes_between(arrival, departure).alias("duration_minutes"),
        )
    )


def settled_sessions(
    df: DataFrame,
    key: str,
    state: str,
    ts: str,
    start: str,
    end: str,
    tie_break: Sequence[str] = (),
    delay: str = "10 minutes",
    names: tuple[str, str] = ("arrival_time", "departure_time"),
    ts_type: str = "timestamp_ntz",
) -> DataFrame:
    """Stream of the sessions whose end the watermark has passed; rows as ``state_sessions``.

    Rows of a key are put in order of (``ts``, ``tie_break``) while they are younger than the
    watermark; only the last one behind it is kept. Rows without a time are left out, rows
    later than ``delay`` are dropped. ``tie_break`` columns must be whole numbers.
    """
    order = {"__o0": epoch_micros(ts)}
    order |= {f"__o{i}": F.col(c).cast("long") for i, c in enumerate(tie_break, 1)}
    rows = df.withWatermark(ts, delay).filter(F.col(ts).isNotNull()).select(
        F.col(key), F.col(ts), *(c.alias(n) for n, c in order.items()), F.col(state).alias("__state")
    )
    held = T.StructType([T.StructField(n, T.LongType()) for n in order])
    held = held.add("__state", T.StringType())
    out = [key, "__from_us", "__to_us"]
    key_type = df.schema[key].dataType.simpleString()
    found = rows.groupBy(key).transformWithState(
        statefulProcessor=SessionSteps(held, out, start, end),
        outputStructType=f"`{key}` {key_type}, __from_us bigint, __to_us bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    arrival, departure = names
    spans = found.select(
        key,
        F.timestamp_micros("__from_us").cast(ts_type).alias(arrival),
        F.timestamp_micros("__to_us").cast(ts_type).alias(departure),
    )
    return spans.select(
        surrogate_key(key, arrival).alias("session_id"),
        "*",
        minutes_between(arrival, departure).alias("duration_minutes"),
    )
