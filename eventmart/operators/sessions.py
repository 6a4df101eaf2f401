"""Next row per key, and sessions from adjacent state changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.keys import surrogate_key
from eventmart.functions.time import epoch_micros, minutes_between
from eventmart.operators.skew import in_slices

# Rows of one key within so many seconds are one group of a window.
SLICE_SECONDS = 3_600


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    carry: Sequence[str],
    tie_break: Sequence[str] = (),
    rows_per_slice: int | str | None = "time",
    collapse_copies: bool = False,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Add ``next_<c>`` for each column of ``carry``: its value in the key's next row.

    Order is (``ts``, ``tie_break``), NULL times first. A key is cut at multiples of
    ``slice_seconds``, so that a busy key is spread over tasks; rows are read and shuffled
    once, by key and slice. The last row of a slice finds its successor in a second window
    over the first and last row of each slice of a key, whose number the calendar bounds.

    A number for ``rows_per_slice`` cuts keys above it adaptively instead, for rows that
    crowd into few slices, at the price of two counting passes; ``None`` never cuts. The
    plan is the same at every size of the input, and results do not depend on the slices.

    Time cannot separate exact copies of one row. ``collapse_copies`` keeps one copy of each
    row (of overfull slices, where the cut is adaptive), by an aggregation that starts before
    the shuffle; use it where a copy behind its original changes nothing.
    """
    order = [ts, *tie_break]
    if rows_per_slice is None:
        return _lead(df, keys, order, carry)
    if rows_per_slice == "time":
        rows = df.dropDuplicates() if collapse_copies else df
        return _by_time(rows, keys, order, carry, slice_seconds)
    return _by_count(df, keys, order, carry, rows_per_slice, collapse_copies)


def _by_time(df: DataFrame, keys, order, carry, slice_seconds: int) -> DataFrame:
    number = F.floor(epoch_micros(order[0]) / F.lit(slice_seconds * 1_000_000))
    sliced = df.withColumn("__slice", number)
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order)
    stepped = _lead(
        sliced.withColumns(
            {
                "__first": F.row_number().over(inside) == 1,
                "__last": F.lead(F.lit(True)).over(inside).isNull(),
            }
        ),
        [*keys, "__slice"],
        order,
        carry,
    )
    following = [f"next_{c}" for c in carry]
    # Both branches read the same exchange, which is made once.
    edges = stepped.filter("__first OR __last").drop(*following)
    across = _lead(edges, keys, ["__slice", "__last"], carry).filter("__last")
    columns = [*df.columns, *following]
    return stepped.filter("NOT __last").select(*columns).unionByName(across.select(*columns))


def _by_count(
    df: DataFrame, keys, order, carry, rows_per_slice: int, collapse_copies: bool
) -> DataFrame:
    ts = order[0]
    sliced = in_slices(df, keys, ts, rows_per_slice)

    # First row of each slice, found by partial aggregation over the large keys only, then
    # handed to the slice before it.
    needed = list(dict.fromkeys([*keys, *order, *carry]))
    firsts = (
        sliced.filter("__large")
        .groupBy(*keys, "__slice")
        .agg(F.min_by(F.struct(*needed), F.struct(*order)).alias("__first"))
    )
    by_slice = Window.partitionBy(*keys).orderBy("__slice")
    closing = (
        firsts.withColumn("__before", F.lag("__slice").over(by_slice))
        .withColumn("__place", F.row_number().over(by_slice))
        .filter(F.col("__place") > 1)
        .select("__first.*", F.col("__before").alias("__slice"), F.lit(True).alias("__closing"))
    )
    rows = _rows(df, sliced)
    if collapse_copies:
        dense = sliced.filter("__dense").dropDuplicates()
        rows = _rows(df, sliced.filter("NOT __dense")).unionByName(_rows(df, dense))
    rows = rows.unionByName(closing, allowMissingColumns=True)
    paired = _lead(rows, [*keys, "__slice"], order, carry)
    return paired.filter(~F.col("__closing")).drop("__slice", "__closing")


def _rows(df: DataFrame, sliced: DataFrame) -> DataFrame:
    return sliced.select(*df.columns, "__slice", F.lit(False).alias("__closing"))


def _lead(df: DataFrame, keys, order, carry) -> DataFrame:
    following = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", *(F.lead(c).over(following).alias(f"next_{c}") for c in carry))


def state_sessions(
    df: DataFrame,
    key: str,
    state: str,
    ts: str,
    start: str,
    end: str,
    tie_break: Sequence[str] = (),
    names: tuple[str, str] = ("arrival_time", "departure_time"),
    rows_per_slice: int | str | None = "time",
    keep_open: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per ``start`` state whose very next row of the same key is an ``end`` state.

    A repeated start pairs from its last repeat, any other state in between breaks the pair,
    and a start without a next row gives nothing, or with ``keep_open`` a session whose end
    and duration are NULL. States are filtered only after the next
    row is known: an earlier filter would change which rows are neighbours.

    Output: session_id, key, arrival, departure, duration_minutes, and the ``carry`` columns of
    the start's row.
    """
    rows = df.select(*dict.fromkeys([key, state, ts, *tie_break, *carry]))
    # A copied reading neither starts nor ends a second session, unless start and end agree.
    stepped = with_next(
        rows, [key], ts, [state, ts], tie_break, rows_per_slice, start != end
    )
    arrival, departure = names
    # NULL times come first, so a row with a time has no next row exactly if that has none
    last = F.col(ts).isNotNull() & F.col(f"next_{ts}").isNull()
    paired = (F.col(f"next_{state}") == end) & F.col(f"next_{ts}").isNotNull()
    return (
        stepped.filter((F.col(state) == start) & ((paired | last) if keep_open else paired))
        .select(
            surrogate_key(key, ts).alias("session_id"),
            F.col(key),
            F.col(ts).alias(arrival),
            F.col(f"next_{ts}").alias(departure),
            minutes_between(ts, f"next_{ts}").alias("duration_minutes"),
            *carry,
        )
    )
