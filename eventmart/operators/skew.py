"""Cutting the history of very large keys into time slices.

A window or a key join puts all rows of a key into one task. Where one key may hold a
third of the table, that task never ends. The helpers here find such keys from a
pre-aggregated count and give each an own slice width; all other keys stay in one piece.
Slices only decide where a row is processed, never whether: results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.time import epoch_micros

# Slices per budget of rows, so that a burst this many times denser than the key's
# average still fits into one slice's budget.
DENSITY = 4


def large_keys(
    df: DataFrame, keys: Sequence[str], ts: str, rows_per_slice: int
) -> DataFrame:
    """The keys with more than ``rows_per_slice`` rows and their slice grid.

    Every such key is found; their number is at most rows / ``rows_per_slice``. Columns: ``__k0..``, ``__lo`` (first microsecond),
    ``__width`` (microseconds) and ``__last`` (number of the last slice).
    """
    sizes = df.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(
        F.count(F.lit(1)).alias("__rows"),
        epoch_micros(F.min(ts)).alias("__lo"),
        epoch_micros(F.max(ts)).alias("__hi"),
    )
    key_cols = [f"__k{i}" for i in range(len(keys))]
    pieces = F.expr(f"ceil(__rows * {DENSITY} / {rows_per_slice})")
    return (
        sizes.filter((F.col("__rows") > rows_per_slice) & F.col("__lo").isNotNull())
        .withColumn("__width", F.floor((F.col("__hi") - F.col("__lo")) / pieces) + 1)
        .withColumn("__last", F.floor((F.col("__hi") - F.col("__lo")) / F.col("__width")))
        .select(*key_cols, "__lo", "__width", "__last")
    )


def with_grid(df: DataFrame, keys: Sequence[str], large: DataFrame) -> DataFrame:
    """Add the slice grid of each row's key; NULL grid columns for ordinary keys.

    Whether ``large`` is broadcast is left to its measured size.
    """
    match = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    drop = [f"__k{i}" for i in range(len(keys))]
    return df.join(large, match, "left").drop(*drop)


def in_slices(
    df: DataFrame, keys: Sequence[str], ts: str, rows_per_slice: int
) -> DataFrame:
    """Add ``__slice``, ``__large`` (the key was cut) and ``__dense`` (its slice was cut again).

    A first grid cuts large keys evenly; slices that a burst still left too full get a
    second, finer grid of their own. Slices of a key sort in time order, NULL times first.
    """
    grid = ["__lo", "__width", "__last"]
    even = large_keys(df, keys, ts, rows_per_slice)
    coarse = (
        with_grid(df, keys, even)
        .withColumns({"__coarse": slice_of(ts), "__large": F.col("__lo").isNotNull()})
        .drop(*grid)
    )
    parts = [*keys, "__coarse"]
    bursts = large_keys(coarse.filter("__large"), parts, ts, rows_per_slice)
    return (
        with_grid(coarse, parts, bursts)
        .withColumn("__slice", F.struct("__coarse", slice_of(ts).alias("fine")))
        .withColumn("__dense", F.col("__lo").isNotNull())
        .drop("__coarse", *grid)
    )


def slice_of(ts: str | Column) -> Column:
    """Slice number from the grid columns: 0 for ordinary keys, clipped to the grid for
    times outside it, NULL for a NULL time of a large key."""
    raw = F.floor((epoch_micros(ts) - F.col("__lo")) / F.col("__width")).cast("long")
    clipped = F.when(raw < 0, F.lit(0)).when(raw > F.col("__last"), F.col("__last")).otherwise(raw)
    return F.when(F.col("__lo").isNull(), F.lit(0)).otherwise(clipped).cast("long")
