"""Duplicate removal, windowed shares and alerts on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.time import epoch_micros
from eventmart.streaming.in_order import CrossingSteps


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival per (keys, ``ts``); state is dropped once the watermark has passed."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def occupancy_windows(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    state: str,
    occupied: str,
    size: str,
    slide: str | None = None,
    delay: str = "10 minutes",
) -> DataFrame:
    """Share of readings in the ``occupied`` state per key and window.

    In append mode a window comes out once the watermark passes its end; later rows for it
    are dropped. Readings are averaged map-side before the shuffle.
    """
    frame = F.window(ts, size, slide) if slide else F.window(ts, size)
    is_occupied = (F.col(state) == F.lit(occupied)).cast("double")
    return (
        df.withWatermark(ts, delay)
        .groupBy(frame.alias("__window"), *keys)
        .agg(F.count(F.lit(1)).alias("readings"), F.avg(is_occupied).alias("occupied_share"))
        .select(
            F.col("__window.start").alias("window_start"),
            F.col("__window.end").alias("window_end"),
            *keys,
            "readings",
            "occupied_share",
        )
    )


def alerts(windows: DataFrame, threshold: float) -> DataFrame:
    """Windows whose occupied share reaches the threshold."""
    return windows.filter(F.col("occupied_share") >= F.lit(threshold))


def crossings(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    threshold: float,
    delay: str = "0 seconds",
) -> DataFrame:
    """Stream of the moments at which ``value`` of a key reaches or falls below ``threshold``.

    Rows of a key are taken in order of ``ts`` once the watermark has passed them. A key's
    first row counts if it lies above; rows with a NULL value or time change nothing. Output:
    keys, ``crossed_at``, value, ``above``. Of rows of a key at one instant the lower value
    comes first.
    """
    rows = df.withWatermark(ts, delay).filter(F.col(ts).isNotNull()).select(
        *keys, ts, epoch_micros(ts).alias("__o0"), F.col(value).cast("double").alias("__value")
    )
    held = T.StructType().add("__o0", T.LongType()).add("__value", T.DoubleType())
    types = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    found = rows.groupBy(*keys).transformWithState(
        statefulProcessor=CrossingSteps(held, [*keys, "__at", "__value", "above"], threshold),
        outputStructType=", ".join([*types, "__at bigint", "__value double", "above boolean"]),
        outputMode="Append",
        timeMode="EventTime",
    )
    at = F.timestamp_micros("__at").alias("crossed_at")
    return found.select(*keys, at, F.col("__value").alias(value), "above")
